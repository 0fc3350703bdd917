import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from millrace.llm import toxicity
from millrace.llm.queries import QUERIES
from tests.llm.helpers import FOLDER, ODD, documents, with_clashes


def ranking(scores, toxic):
    """The share of pairs of one text of each label that the scores put in order (ties half)."""
    a, b = scores[toxic][:, None], scores[~toxic][None, :]
    return ((a > b) + 0.5 * (a == b)).mean()


@pytest.fixture(scope="module")
def rude(spark):
    """Texts of random words; the toxic ones hold two of eight words that others never have."""
    pick = np.random.default_rng(2)
    rows, labels = [], []
    for k in range(900):
        words = [f"w{x}" for x in pick.zipf(1.3, 120) % 5000]
        toxic = k % 5 == 0
        for at in pick.integers(0, 120, 2) if toxic else ():
            words[at] = f"slur{pick.integers(0, 8)}"
        rows.append((k, " ".join(words), "en" if k % 3 else "fr", "s", 1))
        labels.append((k, int(toxic)))
    return documents(spark, rows), spark.createDataFrame(labels, "doc_id long, toxic int")


def test_held_out_texts_are_told_apart(spark, rude):
    docs, labels = rude
    model = toxicity.train(docs, labels)
    rows = toxicity.flagged(toxicity.judge(docs, model), model).join(labels, "doc_id").where(toxicity.held_out()).collect()
    scores, toxic = np.array([r["score"] for r in rows]), np.array([r["toxic"] == 1 for r in rows])
    assert ranking(scores, toxic) >= 0.95
    guess = scores >= toxicity.CUT
    assert guess[toxic].mean() >= 0.8 and guess[~toxic].mean() <= 0.05
    assert {r["lang"]: r["threshold"] for r in rows} == model.thresholds


def test_many_shards_learn_as_one_does(spark, rude):
    docs, labels = rude
    model = toxicity.train(docs, labels, shard_bytes=80_000)
    rows = toxicity.judge(docs, model).join(labels, "doc_id").where(toxicity.held_out()).collect()
    assert ranking(np.array([r["score"] for r in rows]), np.array([r["toxic"] == 1 for r in rows])) >= 0.9
    again = toxicity.train(docs.repartition(5), labels, shard_bytes=80_000)
    assert np.array_equal(model.table, again.table) and model.thresholds == again.thresholds


def test_every_labelled_text_is_learned_from(spark):
    """Of many texts those whose ids' hashes are greatest, which no sample of 2000 for each label held, and texts of over 5000 words."""
    pick = np.random.default_rng(3)
    ids = spark.range(6000).orderBy(F.xxhash64("id", F.lit(11)), "id").collect()
    rows, labels = [], []
    for k, r in enumerate(ids):
        words = [f"w{x}" for x in pick.integers(0, 40, 6)]
        toxic = k % 2 == 1
        if toxic:
            words[pick.integers(0, 6)] = "late" if k >= 5600 else "slur"
        rows.append((r["id"], " ".join(words), "en", "s", 1))
        labels.append((r["id"], int(toxic)))
    model = toxicity.train(documents(spark, rows), spark.createDataFrame(labels, "doc_id long, toxic int"))
    score = {w: model.scores(toxicity.word_hashes(pa.array([f"w1 w2 {w} w4"])))[0] for w in ("late", "slur", "w3")}
    assert min(score["late"], score["slur"]) > 0.8 and score["w3"] < 0.2
    long = [(k, f"w{k % 5} " * 5100 + ("slur" if k % 2 else ""), "en", "s", 1) for k in range(60)]
    assert toxicity.train(documents(spark, long), spark.createDataFrame([(k, k % 2) for k in range(60)], "doc_id long, toxic int")) is not None


def test_query_scores_all_documents_and_ranks_unseen_ones(spark):
    rows = QUERIES["op11_toxicity"](spark, FOLDER).collect()
    ids = {r["doc_id"] for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id").collect()}
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    assert len(rows) == len(ids) and {r["doc_id"] for r in rows} == ids
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in rows)
    unseen = [r for r in rows if r["held_out"] and r["doc_id"] in labels]
    # 38 toxic texts to learn from, a fifth of the labels at random
    assert ranking(np.array([r["score"] for r in unseen]), np.array([labels[r["doc_id"]] == 1 for r in unseen])) >= 0.7


def test_scores_equal_the_plain_network():
    pick = np.random.default_rng(5)
    texts = ["a b c d e", "x", "", "a a b " * 40, None, "é ü"]
    hashes = toxicity.word_hashes(pa.array(texts, pa.string()))
    many = [*hashes, *[pick.integers(1, 1 << 60, 30).astype(np.uint64) % np.uint64(50) + np.uint64(1) for _ in range(40)]]
    model = toxicity.fitted(many, np.arange(len(many)) % 2 == 0)
    model.shift = 0.4
    found = model.scores(hashes)
    for h, got in zip(hashes, found, strict=True):
        one, two = toxicity.word_rows(h)
        room = np.zeros((max(toxicity.WIDTHS) - 1, toxicity.SIZE))
        x = np.concatenate([model.table[one] + model.table[two], room]) if len(h) else room
        best = []
        for width, f in zip(toxicity.WIDTHS, model.filters, strict=True):
            # an empty text is one place without words; the places behind a text's end are empty too
            places = range(len(h) + len(room))
            padded = np.concatenate([x, np.zeros((width, toxicity.SIZE))])
            best.append(np.max([np.tensordot(padded[p : p + width], f, 2) for p in places], axis=0))
        z = np.maximum(np.concatenate(best) + model.bias, 0) @ model.weights + model.offset + model.shift
        assert got == pytest.approx(1 / (1 + np.exp(-z)), abs=1e-4)


def test_scores_do_not_depend_on_the_batch_and_read_whole_texts():
    pick = np.random.default_rng(6)
    texts = [pick.integers(1, 1 << 60, n).astype(np.uint64) for n in (1, 2, 3, 500, 7)]
    model = toxicity.fitted([t[:20] % np.uint64(9) + np.uint64(1) for t in texts * 4], np.arange(20) % 5 == 3)
    assert np.allclose(model.scores(texts), [model.scores([t])[0] for t in texts])


def test_nothing_to_learn_from_odd_rows_and_clashing_names(spark, rude):
    docs = with_clashes(documents(spark, [*ODD, *ODD]))
    labels = spark.createDataFrame([(901, 1), (904, 1), (None, 0), (905, None), (904, 0)], "doc_id long, toxic int")
    none = toxicity.train(docs, labels)
    assert none is None
    assert [r["score"] for r in toxicity.judge(docs, none).collect()] == [0.0] * 2 * len(ODD)
    found = toxicity.judge(docs, toxicity.train(*rude))
    assert found.count() == 2 * len(ODD) and found.columns.count("score") == 1
    blank = {r["score"] for r in found.where("doc_id in (901, 902, 903, 905) and text is null or trim(text) = ''").collect()}
    assert len(blank) == 1
    assert toxicity.judge(docs.limit(0), none).count() == 0
    assert toxicity.train(docs.limit(0), labels.limit(0)) is None


def test_thresholds_follow_the_language():
    scores, toxic = np.linspace(0, 1, 400), np.linspace(0, 1, 400) > 0.6
    toxic[1::2] = np.linspace(0, 1, 200) > 0.3
    langs = np.array(["de", "fr"] * 200, object)
    model = toxicity.calibrated(toxicity.Model(None, [], None, None, 0.0), scores, toxic, langs)
    assert model.thresholds["fr"] < model.thresholds["de"]
