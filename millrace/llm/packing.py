"""Packing of token sequences into rows of equal length, for binary output.

Documents are encoded, cut into pieces of at most ``length`` tokens without losing any, and packed best-fit-decreasing: longest
pieces first, each into the row with the least room that still takes it. The row is found in a segment tree over
room sizes, in logarithmic time. A packed row holds its pieces one after another and padding behind; with it come the
cumulative lengths of the pieces and positions that start again at each piece.

Pieces are packed within blocks of about ``BLOCK_TOKENS`` tokens of one task, so memory is bounded and no document is moved
between machines; a block's last rows may have room left. The same input split gives the same rows again after a loss.

Defined cases: a null or empty text has no tokens and stands in no row. A row without id is packed with a null id. Rows may repeat
and are packed each. An empty table gives no rows. Equal lengths are packed in input order. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from millrace.llm import textops
from millrace.llm.bpe import loaded, pieces

LENGTH = 2048
BLOCK_TOKENS = 4_000_000


class Rooms:
    """A segment tree over room sizes 0 to length that knows in which sizes rows are open."""

    def __init__(self, length: int):
        self.leaves = 1
        while self.leaves <= length:
            self.leaves *= 2
        self.open = [0] * (2 * self.leaves)
        self.rows: dict[int, list[int]] = {}

    def put(self, room: int, row: int) -> None:
        self.rows.setdefault(room, []).append(row)
        at = room + self.leaves
        while at:
            self.open[at] += 1
            at //= 2

    def take(self, need: int) -> tuple[int, int] | None:
        """(room, row) of the least room of at least ``need``, no longer open; None if there is none."""
        at = need + self.leaves
        if not self.open[at]:
            while at > 1 and (at % 2 or not self.open[at + 1]):
                at //= 2
            if at <= 1:
                return None
            at += 1
            while at < self.leaves:
                at = 2 * at if self.open[2 * at] else 2 * at + 1
        room = at - self.leaves
        while at:
            self.open[at] -= 1
            at //= 2
        return room, self.rows[room].pop()


def best_fit(sizes: np.ndarray, length: int) -> list[list[int]]:
    """Indices of the pieces of each row."""
    rooms, rows = Rooms(length), []
    for i in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[i])
        if found := rooms.take(size):
            room, row = found
        else:
            room, row = length, len(rows)
            rows.append([])
        rows[row].append(i)
        if room > size:
            rooms.put(room - size, row)
    return rows


def cut(ids: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
    """(document, first token within it, token offset, size) of every piece."""
    out = []
    for d, (lo, hi) in enumerate(zip(at[:-1].tolist(), at[1:].tolist(), strict=True)):
        out += [(d, x - lo, x, min(length, hi - x)) for x in range(lo, hi, length)]
    return np.array(out, np.int64).reshape(-1, 4)


def _packed(docs: list, ids: np.ndarray, at: np.ndarray, length: int, pad: int) -> pa.RecordBatch:
    own = cut(ids, at, length)
    cols: dict[str, list] = {k: [] for k in ("doc_ids", "starts", "cu_seqlens", "n_tokens", "input_ids", "positions")}
    for row in best_fit(own[:, 3], length):
        part = own[row]
        ends = np.cumsum(part[:, 3])
        matrix, places = np.full(length, pad, "<u4"), np.zeros(length, "<u4")
        for (_, _, lo, size), end in zip(part.tolist(), ends.tolist(), strict=True):
            matrix[end - size : end] = ids[lo : lo + size]
            places[end - size : end] = np.arange(size)
        cols["doc_ids"].append([docs[d] for d in part[:, 0]])
        cols["starts"].append(part[:, 1].tolist())
        cols["cu_seqlens"].append([0, *ends.tolist()])
        cols["n_tokens"].append(int(ends[-1]))
        cols["input_ids"].append(matrix.tobytes())
        cols["positions"].append(places.tobytes())
    kinds = [pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.int64(), pa.binary(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(cols.values(), kinds, strict=True)], list(cols))


def pack(docs: DataFrame, path: str, length: int = LENGTH, pad: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Packed rows of the tokens of all whole texts.

    doc_ids and starts name each piece's document and its first token there; input_ids and positions are ``length`` little-endian
    unsigned 32-bit numbers; cu_seqlens begins with 0 and ends with n_tokens, behind which stand pad and 0.
    """

    def run(batches) -> Iterator[pa.RecordBatch]:
        held, ids, sizes, total = [], [], [], 0
        for b in batches:
            for lo, hi in pieces(b.column(1)):
                part = b.slice(lo, hi - lo)
                flat, at = loaded(path).encode(part.column(1).to_pylist())
                held += part.column(0).to_pylist()
                ids.append(flat)
                sizes.append(np.diff(at))
                total += len(flat)
                if total >= BLOCK_TOKENS:
                    yield _block(held, ids, sizes, length, pad)
                    held, ids, sizes, total = [], [], [], 0
        if total:
            yield _block(held, ids, sizes, length, pad)

    kinds = "doc_ids array<long>, starts array<long>, cu_seqlens array<long>, n_tokens long, input_ids binary, positions binary"
    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(textops.tidy(run), kinds)


def _block(held, ids, sizes, length, pad) -> pa.RecordBatch:
    return _packed(held, np.concatenate(ids), np.concatenate([[0], np.cumsum(np.concatenate(sizes))]), length, pad)


def write(packed: DataFrame, path: str) -> None:
    """Store packed rows as Parquet: one row of the id matrix in each row."""
    packed.write.mode("overwrite").parquet(path)
