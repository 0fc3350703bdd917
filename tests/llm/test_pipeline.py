"""Each stage on its own input against what it must keep."""

import random

import pytest

import corpus_pipeline
from millrace.llm.queries import QUERIES
from tests.llm.helpers import DOCS, ODD, documents, spaced, with_clashes
from tests.llm.test_chains import verbatim
from tests.llm.test_jaccard import brute

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def kept(spark):
    """What each stage was given and returned."""
    docs, out = spark.read.parquet(f"{FOLDER}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        new = stage(spark, docs, FOLDER).cache()
        out.append((name, docs, new))
        docs = new
    return out


def test_stages_and_columns(kept):
    assert [n for n, _, _ in kept] == ["language_id", "jaccard_join", "substring_dedup", "decontamination", "bpe"]
    for _, before, after in kept[:-1]:
        assert after.columns == before.columns == [c.split()[0] for c in DOCS.split(", ")]


def ids(df):
    return {r["doc_id"] for r in df.select("doc_id").collect()}


def test_language_keeps_all_texts_with_letters(kept):
    _, before, after = kept[0]
    assert ids(after) == ids(before.where(r"text rlike '\\p{L}'"))


def test_language_rejects_scripts_and_letters_that_no_language_has(spark):
    pick = random.Random(3)
    given = spark.read.parquet(f"{FOLDER}/documents.parquet")
    scripts = {"a-z": (97, 123), "cyrillic": (0x430, 0x450), "greek": (0x3B1, 0x3C9), "arabic": (0x627, 0x64A), "cjk": (0x4E00, 0x5E00), "kana": (0x3042, 0x3090)}
    rows = []
    for name, (lo, hi) in scripts.items():
        # three words of random letters a-z cannot be told from words of a language
        for n in (40, 300, 3000) if name == "a-z" else (3, 40, 300, 3000):
            words = ["".join(chr(pick.randrange(lo, hi)) for _ in range(pick.randint(2, 9))) for _ in range(n)]
            rows.append((10_000 + len(rows), " ".join(words), None, "s", n))
    clean = given.where("lang is not null and n_chars > 100").limit(40).collect()
    # a very long text of one language, and one whose lang is missing
    long = " ".join(r["text"] for r in given.where("lang = 'en'").limit(60).collect()) + " "
    rows += [(20_000, long * 12, None, "s", 1), *[(20_001 + k, r["text"], None, "s", 1) for k, r in enumerate(clean)]]
    found = corpus_pipeline.language(spark, given.unionByName(spark.createDataFrame(rows, given.schema)), FOLDER)
    kept = {r["doc_id"]: r["lang"] for r in found.where("doc_id >= 10000").collect()}
    assert kept == {20_000: "en"} | {20_001 + k: r["lang"] for k, r in enumerate(clean)}


def test_rows_of_one_id_are_kept_by_their_texts(spark):
    text = lambda k: " ".join(f"w{k}x{i}" for i in range(40))
    rows = [(1, text(1), None, None, 1), (1, text(2), None, None, 2), (1, text(2), None, None, 3), (2, text(1) + " more", None, None, 4), (3, text(3), None, None, 5), (None, text(1), None, None, 6), (4, None, None, None, 7), (4, "", None, None, 8)]
    kept = corpus_pipeline.one_of_each_group(spark, documents(spark, rows), FOLDER).collect()
    assert sorted((r["doc_id"] or 0, r["text"] or "") for r in kept) == sorted([(1, text(1)), (1, text(2)), (3, text(3)), (0, text(1)), (4, ""), (4, "")])


def test_one_of_each_group_stays(kept):
    _, before, after = kept[1]
    want = brute([(r["doc_id"], r["text"]) for r in before.collect()])
    assert ids(after) == {i for i, (_, c) in want.items() if i == c}
    assert after.count() == len(ids(after))


def test_repeats_go_and_first_places_and_clean_texts_stay(kept):
    _, before, after = kept[2]
    old = {r["doc_id"]: r["text"] for r in before.collect()}
    new = {r["doc_id"]: r for r in after.collect()}
    assert not verbatim({i: spaced(r["text"]) for i, r in new.items()})
    repeated = verbatim({i: spaced(t) for i, t in old.items()})
    unchanged = [i for i, r in new.items() if r["text"] == old[i]]
    assert len(unchanged) >= 0.9 * len(old) and not set(unchanged) & set(repeated)
    assert all(r["n_chars"] == len(r["text"]) for r in new.values())


def test_no_benchmark_item_is_left(spark, kept):
    _, before, after = kept[3]
    items = [r["text"] for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    holds = {r["doc_id"] for r in before.collect() if any(t in r["text"] for t in items)}
    assert ids(after) == ids(before) - holds


def test_run_gives_the_rows_of_the_stages(spark, kept):
    rows = {r["doc_id"]: r["ids_sha256"] for r in corpus_pipeline.run(spark, FOLDER).collect()}
    assert rows == {r["doc_id"]: r["ids_sha256"] for r in kept[4][2].collect()}
    whole = {r["doc_id"]: r["ids_sha256"] for r in QUERIES["op10_bpe_round_trip"](spark, FOLDER).collect()}
    assert sum(rows[i] == whole[i] for i in rows) >= 0.9 * len(rows)


@pytest.mark.parametrize("stage", range(5))
def test_odd_rows_clashing_names_and_empty_tables(spark, stage):
    docs = with_clashes(documents(spark, ODD))
    step = corpus_pipeline.STAGES[stage][1]
    found = step(spark, docs, FOLDER)
    want = {0: [904, 904, None, 906], 1: [901, 902, 903, 904, None, 905, 906], 2: [r[0] for r in ODD], 3: [r[0] for r in ODD], 4: [r[0] for r in ODD]}[stage]
    assert sorted(r["doc_id"] or 0 for r in found.collect()) == sorted(w or 0 for w in want)
    assert stage == 4 or found.columns == docs.columns
    assert step(spark, docs.limit(0), FOLDER).count() == 0
