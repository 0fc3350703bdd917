import zlib

import numpy as np

from millrace.llm import langid
from millrace.llm.queries import QUERIES
from tests.llm.helpers import FOLDER, ODD, documents, with_clashes


def test_held_out_accuracy_on_all_documents(spark):
    rows = QUERIES["op4_language_id"](spark, FOLDER).collect()
    lang = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "lang").collect()}
    assert len(rows) == len(lang)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in rows)
    unseen = [r for r in rows if r["held_out"]]
    assert sum(r["lang_pred"] == lang[r["doc_id"]] for r in unseen) >= 0.98 * len(unseen)
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_presence_counts_each_ngram_once_and_no_ngram_across_texts():
    one = langid.presence([b"ab ab ab", b"ab", b"AB!!", b""])
    assert (one[1] == one[2]).all()
    assert one[3].sum() <= 1
    assert set(np.unique(one)) <= {0, 1}
    assert (langid.presence([b"xy", b"zz"])[0] == langid.presence([b"xy"])[0]).all()
    many = [f"text number {k} " * (k % 7) for k in range(600)]
    assert (np.concatenate([p for _, p in langid.blocks(many)]) == langid.presence([t.encode() for t in many])).all()


def test_odd_rows_clashing_names_and_nothing_to_learn(spark):
    docs = with_clashes(documents(spark, [*ODD, (910, "the one with the other", "en", "s", 1), (911, "le chien dans la maison", "fr", "s", 1), (914, "il est dans le jardin", "fr", "s", 1)]))
    found = langid.identify(docs, langid.train(docs)).select("doc_id", "lang_pred", "score").collect()
    assert len(found) == len(ODD) + 3
    assert all((r["lang_pred"], r["score"]) == ("und", 0) for r in found if r["doc_id"] in (901, 902, 903, 905))
    assert {r["lang_pred"] for r in found} <= {"und", "en", "fr"}
    empty = docs.limit(0)
    model = langid.train(empty)
    assert langid.identify(empty, model).count() == 0
    assert {r["lang_pred"] for r in langid.identify(docs, model).collect()} == {"und"}
