r"""Importance resampling towards a target distribution, with bit-sliced sums.

Features are all runs of 1 to ``n`` consecutive words, hashed into buckets. A bucket's gain is the logarithm of its share in the target
texts over its share in all documents, as a whole number of thousandths. A document's weight is the sum of its features' gains:
its bucket counts are cut into bit planes, one bit for each bucket, as are the gains of either sign, and the weight is the sum
of popcount(count plane AND gain plane) times the power of two of both planes. That is exact in whole numbers.

Documents are drawn without replacement by Gumbel noise that a hash of the document's id decides: the highest sums of weight and
noise. Bucket counts are made over all documents and all target texts; what reaches the driver is one number for each
bucket. Ranks come from ranges of the scores (``ranks.placed``), not from one window.

Defined cases: null and empty texts have no features and weight 0. A row without id has no score, is not counted among the
candidates and not drawn. Every row is a document of its own, also one that repeats another or its id; equal scores go to the smaller
id, and rows of one id to the larger weight, then in any order. Without target texts all shares of the target are equal. An empty table
gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from millrace.llm import ranks, textops
from millrace.sources.scratch import Scratch

BUCKETS = 10_000
#: Words are runs of digits, letters and all characters beyond ASCII.
_B = np.arange(256)
WORD_BYTES = ((_B >= 48) & (_B <= 57)) | ((_B >= 65) & (_B <= 90)) | ((_B >= 97) & (_B <= 122)) | (_B >= 128)
#: Documents whose planes are held at a time, and the length from which a feature's checksum is made by itself.
BLOCK_ROWS = 256
LONG = 64


def _crc_table() -> np.ndarray:
    crc = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        crc = np.where(crc & 1, (crc >> 1) ^ np.uint32(0xEDB88320), crc >> 1).astype(np.uint32)
    return crc


_CRC = _crc_table()


def checksums(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The CRC-32 of every data[start:end], a byte of all of them at a time."""
    size = ends - starts
    out = np.full(len(starts), 0xFFFFFFFF, np.uint32)
    order = np.argsort(-size, kind="stable")
    order = order[np.searchsorted(-size[order], -LONG) :]
    left = size[order]
    for k in range(int(left[0]) if len(left) else 0):
        live = order[: np.searchsorted(-left, -k)]
        out[live] = _CRC[(out[live] ^ data[starts[live] + k]) & 0xFF] ^ (out[live] >> np.uint32(8))
    out ^= np.uint32(0xFFFFFFFF)
    for i in np.flatnonzero(size > LONG):
        out[i] = zlib.crc32(data[starts[i] : ends[i]].tobytes())
    return out


def features(texts: pa.Array, n: int, buckets: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(first row, row, bucket, words of each row) of slices of the texts; one entry of row and bucket for each feature."""
    for w in textops.words(texts, WORD_BYTES):
        n_words = np.diff(w.first)
        row = np.repeat(np.arange(len(n_words)), n_words)
        # the words of the slice, each followed by one blank, so that a run of words is one stretch of bytes
        size = w.ends - w.starts
        starts = np.cumsum(size + 1) - (size + 1)
        joined = np.full(int((size + 1).sum()), 32, np.uint8)
        at = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
        joined[np.repeat(starts, size) + at] = w.data[np.repeat(w.starts, size) + at]
        rows, found = [], []
        for k in range(n):
            first = np.flatnonzero(row[: len(row) - k] == row[k:]) if k else np.arange(len(row))
            found.append(checksums(joined, starts[first], starts[first + k] + size[first + k]) % np.uint32(buckets))
            rows.append(row[first])
        yield w.row0, np.concatenate(rows), np.concatenate(found).astype(np.int64), n_words


def bucket_counts(docs: DataFrame, n: int = 1, buckets: int = BUCKETS, text: str = "text") -> np.ndarray:
    """How many features of all texts fall into each bucket."""

    def run(batches):
        total = np.zeros(buckets, np.int64)
        for b in batches:
            for _, _, bucket, _ in features(b.column(0), n, buckets):
                total += np.bincount(bucket, minlength=buckets)
        held = np.flatnonzero(total)
        if len(held):
            yield pa.RecordBatch.from_arrays([pa.array(held.astype(np.int32)), pa.array(total[held])], ["bucket", "n"])

    found = docs.select(F.col(text).alias("text")).mapInArrow(textops.tidy(run), "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, np.int64)
    for r in found.collect():  # one row for each bucket at most
        out[r["bucket"]] = r["n"]
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the logarithm of target share over corpus share, rounded down; every bucket counts one more than it holds."""
    size, s_all, t_all = len(corpus), float(corpus.sum() + len(corpus)), float(target.sum() + len(target))
    share = [math.log((float(t + 1) * s_all) / (float(s + 1) * t_all)) for s, t in zip(corpus.tolist(), target.tolist(), strict=True)]
    return np.fromiter((math.floor(1000 * x) for x in share), np.int64, size)


def planes(at: np.ndarray, values: np.ndarray, shape: tuple[int, int]) -> np.ndarray:
    """Bit planes of a sparse table of whole numbers: plane k holds bit k of every place, 64 to a word, row by row."""
    rows, width = shape[0], -(-shape[1] // 64) * 64
    flat = at // shape[1] * width + at % shape[1]
    out = []
    for k in range(max(1, int(values.max(initial=0)).bit_length())):
        bits = np.zeros(rows * width, np.uint8)
        bits[flat[(values >> k) & 1 == 1]] = 1
        out.append(np.packbits(bits).view(np.uint64).reshape(rows, width // 64))
    return np.stack(out)


class Gains:
    """The planes of the positive and of the negative gains."""

    def __init__(self, gain: np.ndarray):
        self.buckets = len(gain)
        every = np.arange(self.buckets)
        self.signed = [(sign, planes(every, np.maximum(sign * gain, 0), (1, self.buckets))[:, 0]) for sign in (1, -1)]

    def weights(self, row: np.ndarray, bucket: np.ndarray, rows: int) -> np.ndarray:
        """The exact weight of every row, given row and bucket of each feature."""
        at, counts = np.unique(row * self.buckets + bucket, return_counts=True)
        out = np.zeros(rows, np.int64)
        for k, own in enumerate(planes(at, counts, (rows, self.buckets))):
            for sign, all_planes in self.signed:
                for j, plane in enumerate(all_planes):
                    out += sign * (np.bitwise_count(own & plane).sum(axis=1, dtype=np.int64) << (k + j))
        return out


def weighed(docs: DataFrame, gain: np.ndarray, n: int = 1, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, n_features, n_words, weight) of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(gain)

    def run(batches):
        own = Gains(shared.value)
        for b in batches:
            for row0, row, bucket, n_words in features(b.column(1), n, own.buckets):
                rows = len(n_words)
                order = np.argsort(row, kind="stable")
                row, bucket = row[order], bucket[order]
                weight = np.zeros(rows, np.int64)
                for lo in range(0, rows, BLOCK_ROWS):
                    hi = min(rows, lo + BLOCK_ROWS)
                    i, j = np.searchsorted(row, [lo, hi])
                    weight[lo:hi] = own.weights(row[i:j] - lo, bucket[i:j], hi - lo)
                total = np.bincount(row, minlength=rows)
                yield pa.RecordBatch.from_arrays([b.column(0).slice(row0, rows), pa.array(total), pa.array(n_words.astype(np.int64)), pa.array(weight)], ["id", "n_features", "n_words", "weight"])

    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text).alias("text")).mapInArrow(textops.tidy(run), "id long, n_features long, n_words long, weight long")


def resampled(
    docs: DataFrame, target: DataFrame, n: int = 1, buckets: int = BUCKETS, percent: int = 10, least_words: int = 20,
    seed: int = 2024, id_col: str = "doc_id", text: str = "text", target_text: str = "text",
) -> DataFrame:
    """(id, n_features, n_words, weight, score, rank) of every document; rank is null where it is not drawn."""
    scratch = Scratch(docs.sparkSession, "resample")
    gain = gains(bucket_counts(docs, n, buckets, text), bucket_counts(target, n, buckets, target_text))
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))
    # the row's place in the written table tells rows apart that agree in everything
    rows = scratch.write(weighed(docs, gain, n, id_col, text).withColumn("score", F.col("weight") + noise).withColumn("row", F.monotonically_increasing_id()), "weighed")
    fits = (F.col("n_words") >= least_words) & F.col("id").isNotNull()
    order = [F.col("score").desc(), F.col("id").asc(), F.col("weight").desc(), F.col("row").asc()]
    candidates = ranks.placed(rows.where(fits), order, "place", scratch)
    drawn = rows.where(fits).count() * percent // 100
    rank = F.when(F.col("place") < drawn, F.col("place") + 1)
    rest = rows.where(~fits).withColumn("rank", F.lit(None).cast("long"))
    return candidates.withColumn("rank", rank).drop("place").unionByName(rest).drop("row").withColumnRenamed("id", id_col)
