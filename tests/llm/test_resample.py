import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from millrace.llm import ranks, resample
from millrace.llm.queries import QUERIES
from millrace.sources.scratch import Scratch
from tests.llm.helpers import FOLDER, ODD, _LOW, documents, with_clashes

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def runs(text, n):
    words = WORD.findall((text or "").translate(_LOW))
    return words, [" ".join(words[i : i + k]) for k in range(1, n + 1) for i in range(len(words) - k + 1)]


def brute(docs, target, n=1, buckets=10_000, percent=10, least=20, seed=2024):
    """(id, n_features, n_words, weight, score, rank) by plain sums."""
    of = {k: (len(runs(t, n)[0]), [zlib.crc32(f.encode()) % buckets for f in runs(t, n)[1]]) for k, t in enumerate(t for _, t in docs)}
    s = Counter(b for _, f in of.values() for b in f)
    t = Counter(zlib.crc32(f.encode()) % buckets for x in target for f in runs(x, n)[1])
    every_s, every_t = sum(s.values()) + buckets, sum(t.values()) + buckets
    gain = [math.floor(1000 * math.log((t[b] + 1) * every_s / ((s[b] + 1) * every_t))) for b in range(buckets)]
    rows = []
    for k, (i, _) in enumerate(docs):
        weight, score = sum(gain[b] for b in of[k][1]), None
        if i is not None:
            h = int(hashlib.sha256(f"{seed}:{i}".encode()).hexdigest()[:8], 16)
            score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([i, len(of[k][1]), of[k][0], weight, score, None])
    fits = sorted([r for r in rows if r[2] >= least and r[0] is not None], key=lambda r: (-r[4], r[0], -r[3]))
    for k, r in enumerate(fits[: len(fits) * percent // 100]):
        r[5] = k + 1
    return sorted(map(tuple, rows), key=str)


def rows_of(df):
    return sorted([tuple(r[c] for c in ("doc_id", "n_features", "n_words", "weight", "score", "rank")) for r in df.collect()], key=str)


def test_query_equals_plain_sums_over_all_documents(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    target = [r["text"] for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    found = QUERIES["op12_importance_resampling"](spark, FOLDER)
    want = [(i, n, w, s, r) for i, n, _, w, s, r in brute(docs, target)]
    assert sorted([tuple(r[c] for c in ("doc_id", "n_features", "weight", "score", "rank")) for r in found.collect()], key=str) == want


def test_longer_runs_odd_rows_and_clashing_names(spark):
    rows = [*ODD, *[(k, f"word {k} of the day " * (k % 9), "en", "s", 1) for k in range(60)], (3, "Three MORE Words " * 30, None, None, None)]
    target = ["the day of the word", "", None, "Ünïcode wörds"]
    docs = with_clashes(documents(spark, rows))
    found = resample.resampled(docs, spark.createDataFrame([(t,) for t in target], "text string"), n=3, buckets=977, percent=30, least_words=5, seed=7)
    assert rows_of(found) == brute([(r[0], r[1]) for r in rows], target, 3, 977, 30, 5, 7)
    assert any(r["rank"] for r in found.collect())


def test_empty_tables(spark):
    docs = documents(spark, ODD)
    none = docs.limit(0)
    assert resample.resampled(none, none).count() == 0
    assert rows_of(resample.resampled(docs, none)) == brute([(r[0], r[1]) for r in ODD], [])


def test_bit_planes_weigh_exactly():
    pick = np.random.default_rng(1)
    gain = pick.integers(-30_000, 30_000, 1000)
    row, bucket = np.sort(pick.integers(0, 7, 5000)), pick.integers(0, 1000, 5000) ** 2 % 1000
    want = np.bincount(row, gain[bucket], minlength=8).astype(np.int64)
    assert (resample.Gains(gain).weights(row, bucket, 8) == want).all()
    assert (resample.Gains(np.zeros(5, np.int64)).weights(row[:0], bucket[:0], 2) == 0).all()


@pytest.mark.parametrize("texts", [["a", "ä ö", "x" * 200 + " y", "", None, "A-B c0"], ["", None], []])
def test_checksums_equal_those_of_the_library(texts):
    for n in (1, 2):
        found = [(row0 + r, b) for row0, row, bucket, _ in resample.features(pa.array(texts, pa.string()), n, 10_000) for r, b in zip(row.tolist(), bucket.tolist(), strict=True)]
        want = [(i, zlib.crc32(f.encode()) % 10_000) for i, t in enumerate(texts) for f in runs(t, n)[1]]
        assert sorted(found) == sorted(want)


def test_places_equal_one_sort(spark):
    df = spark.range(1000).selectExpr("id", "id * 7919 % 31 as v").repartition(7)
    found = ranks.placed(df, [df["v"].desc(), df["id"].asc()], "place", Scratch(spark, "test")).collect()
    want = sorted(((r["v"], r["id"]) for r in found), key=lambda x: (-x[0], x[1]))
    assert [(r["v"], r["id"]) for r in sorted(found, key=lambda r: r["place"])] == want
    assert sorted(r["place"] for r in found) == list(range(1000))
