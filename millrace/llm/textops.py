"""Words and word hashes of many texts at once, as numpy work inside a task.

A batch of texts is taken as the bytes Arrow already holds; only A-Z is lower-cased, and a word is a run of bytes
that are not separators. Slices of about one megabyte keep the temporary arrays small whatever a batch holds.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20

_U = np.uint64
_BYTES = np.arange(256)
LOWER = np.where((_BYTES >= 65) & (_BYTES <= 90), _BYTES + 32, _BYTES).astype(np.uint8)
#: Words are runs without ASCII white space.
SPACED = ~np.isin(_BYTES, [0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D])


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers (the splitmix64 finaliser)."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _powers(base: int, n: int) -> np.ndarray:
    steps = np.full(n, base, dtype=_U)
    steps[0] = 1
    return np.multiply.accumulate(steps)


_BASE = 0x9E3779B97F4A7C15
_TABLE = mixed(np.arange(1, 257, dtype=_U) * _U(_BASE))
_cache: dict[str, np.ndarray] = {}


def _bases(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_cache.get("up", ())) < n:
        size = max(n, SLICE_BYTES)
        _cache["up"], _cache["down"] = _powers(_BASE, size), _powers(pow(_BASE, -1, 1 << 64), size)
    return _cache["up"], _cache["down"]


@dataclass
class Words:
    """Words of a run of rows: ``data`` lower-cased bytes, ``raw`` as given; word i is data[starts[i]:ends[i]].

    Words of row r are those from first[r] to first[r + 1].
    """

    row0: int
    offsets: np.ndarray
    raw: np.ndarray
    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    def hashes(self, data: np.ndarray | None = None) -> np.ndarray:
        """64 bits per word, equal for equal words wherever they stand."""
        data = self.data if data is None else data
        up, down = _bases(len(data) + 1)
        sums = np.zeros(len(data) + 1, dtype=_U)
        np.cumsum(_TABLE[data] * up[: len(data)], out=sums[1:])
        return mixed((sums[self.ends] - sums[self.starts]) * down[self.starts] + (self.ends - self.starts).astype(_U))


def words(texts: pa.Array | pa.ChunkedArray, word_bytes: np.ndarray = SPACED) -> Iterator[Words]:
    """The words of each text, slice by slice; a null text counts as empty. Whole texts, however long."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string())
    n = len(texts)
    if n == 0:
        return
    _, at, body = texts.buffers()
    offsets = np.frombuffer(at, np.int64)[texts.offset : texts.offset + n + 1]
    data = np.frombuffer(body, np.uint8) if body is not None else np.zeros(0, np.uint8)
    row = 0
    while row < n:
        to = int(np.searchsorted(offsets, offsets[row] + SLICE_BYTES, "right")) - 1
        to = min(n, max(row + 1, to))
        off = offsets[row : to + 1] - offsets[row]
        raw = data[offsets[row] : offsets[to]]
        yield _cut(row, off, raw, word_bytes)
        row = to


def _cut(row0: int, off: np.ndarray, raw: np.ndarray, word_bytes: np.ndarray) -> Words:
    size = len(raw)
    inside = word_bytes[raw]
    before = np.zeros(size, bool)
    after = np.zeros(size, bool)
    if size:
        before[1:], after[:-1] = inside[:-1], inside[1:]
        edges = off[(off > 0) & (off < size)]
        before[edges] = False
        after[edges - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return Words(row0, off, raw, LOWER[raw], starts, ends, np.searchsorted(starts, off))


_PLACES = mixed(np.arange(1, 65, dtype=_U))


def grams(hashes: np.ndarray, k: int) -> np.ndarray:
    """One hash for every k consecutive entries, in order."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, _U)
    out = np.zeros(n, _U)
    for j in range(k):
        out += (hashes[j : j + n] ^ _PLACES[j]) * (_PLACES[j + 1] | _U(1))
    return mixed(out)


def folded(hashes: np.ndarray) -> int:
    """One hash of a whole short sequence, of at most 32 entries (for texts with fewer words than a gram)."""
    n = len(hashes)
    padded = np.concatenate([hashes, np.full(33 - n, n, dtype=_U)])
    return int(grams(padded, 33)[0])


def unused(columns: list[str], name: str) -> str:
    """``name``, with underscores before it until no column is called so."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def give_back() -> None:
    """Return memory that is no longer used to the system, so that a worker that waits for its next task is small."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):
        pass  # another C library


def tidy(run: Callable) -> Callable:
    """``run`` over the batches of a task, then ``give_back``."""

    def tidied(batches):
        yield from run(batches)
        give_back()

    return tidied
