"""Byte-pair encoding and decoding of whole texts with a given vocabulary file.

The texts of a batch are cut at spaces where no word can go across, and only stretches not met before are cut into words; the
distinct words not met before are encoded together, and each text's ids are put together from its stretches. Encoding works in rounds over one flat array that holds the symbols of all those words:
every neighbouring pair is looked up by binary search in the sorted pair keys, the pairs of lowest rank in each word
are merged, and rounds go on until no word has a pair left. Rounds are bounded by the longest word, not by the
number of words.

Normalisation, word pattern and special tokens come from the file. The supported kinds are byte-level BPE with or without
an end-of-word suffix, and the normalisers NFC, Lowercase and Replace of white space.

Defined cases: a null or empty text has no ids and decodes to the empty text; null ids decode to the empty text; a
text of special tokens only gives those ids; repeated rows are encoded alike; an empty table gives an empty table;
other columns are kept as they are, but for one of an output's name, which is
replaced.
"""

from __future__ import annotations

import hashlib
import json
import re
import sys
import unicodedata
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, count, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from millrace.llm.textops import unused

#: Words, and stretches between spaces, remembered between batches by one Python worker; beyond this the memory is emptied and filled anew.
REMEMBERED = 400_000
#: Bytes of text handled at once.
TEXT_BYTES = 4 << 20

#: Stands before a special token among the words; no text of UTF-8 holds it.
MARK = "\ud800"
#: Stands before a stretch of text that follows no space.
BEGIN = "\ud801"

#: The printable stand-ins that byte-level vocabularies use for bytes.
_PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]


def byte_letters() -> dict[int, str]:
    out = {b: chr(b) for b in _PRINTABLE}
    rest = (b for b in range(256) if b not in out)
    return out | {b: chr(256 + i) for i, b in enumerate(rest)}


@lru_cache(1)
def _other_numbers() -> str:
    """Numeric characters that are neither letters nor decimal digits."""
    return "".join(c for c in map(chr, range(sys.maxunicode + 1)) if unicodedata.category(c) in ("Nl", "No"))


_SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: A space that a word may go across, as white space or the end follows it, and one that begins a word.
_INNER, _GAP = re.compile(f" (?:[{_SPACE}]|\\Z)"), re.compile(f" (?=[^{_SPACE}])")


def _patterns(pattern: str):
    r"""The word pattern twice: as given, and in the quicker standard module for texts without odd numerals.

    There ``\p{L}`` and ``\p{N}`` are plain classes; patterns with other properties keep to the slower module.
    """
    given = regex.compile(pattern.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}"))
    space = _SPACE
    plain = pattern.replace(r"[^\s\p{L}\p{N}]", rf"(?:_|[^\w{space}])").replace(r"[\p{L}]", r"\p{L}").replace(r"[\p{N}]", r"\p{N}")
    plain = plain.replace(r"\p{L}", r"[^\W\d_]").replace(r"\p{N}", r"\d").replace(r"\s", f"[{space}]").replace(r"\S", f"[^{space}]")
    return given, re.compile(plain) if r"\p" not in plain else given


#: Fixed value: the word pattern of the ByteLevel pre-tokenizer.
BYTE_LEVEL = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Fixed value: the word pattern of the lower-casing vocabulary, none of whose words holds white space.
LETTERS_ONLY = r"""'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"""


class Numbers(defaultdict):
    """A number for every key asked for, in the order of their first times."""

    def __init__(self):
        super().__init__(count().__next__)

    def since(self, n: int) -> list[str]:
        """The keys from number n on."""
        return list(islice(reversed(self), len(self) - n))[::-1]

    def of(self, lists: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """The numbers of all entries one after another, and the length of each list."""
        sizes = np.array([len(x) for x in lists], dtype=np.int64)
        return np.fromiter(map(self.__getitem__, chain.from_iterable(lists)), np.int64, int(sizes.sum())), sizes


class Pairs:
    """Places of 64-bit keys, by hashing: a key that finds its slot taken goes to the next, smaller table."""

    def __init__(self, keys: np.ndarray):
        self.keys, self.tables = keys, []
        left, bits, factor = np.arange(len(keys)), max(4, int(len(keys)).bit_length() + 2), 0x9E3779B97F4A7C15
        while len(left):
            slot = self._slot(keys[left], bits, factor)
            table, times = np.full(1 << bits, -1, np.int32), np.bincount(slot, minlength=1 << bits)
            table[slot] = left
            crowded = times > 1
            self.tables.append((bits, factor, table, crowded))
            left = left[table[slot] != left]
            bits, factor = max(4, int(len(left)).bit_length() + 2), (factor * 0xD1342543DE82EF95 | 1) % (1 << 64)

    @staticmethod
    def _slot(keys: np.ndarray, bits: int, factor: int) -> np.ndarray:
        return ((keys.view(np.uint64) * np.uint64(factor)) >> np.uint64(64 - bits)).view(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The place of each key, or -1."""
        out, rest, asked = np.full(len(keys), -1, np.int32), None, keys
        for bits, factor, table, crowded in self.tables:
            slot = self._slot(asked, bits, factor)
            at = table[slot]
            hit = (at >= 0) & (self.keys[at] == asked)
            if rest is None:
                out = np.where(hit, at, np.int32(-1))
                rest = np.flatnonzero(crowded[slot] & ~hit)
            else:
                out[rest[hit]] = at[hit]
                rest = rest[crowded[slot] & ~hit]
            if not len(rest):
                break
            asked = keys[rest]
        return out


class Sequences:
    """Ids of numbered sequences, one after another."""

    def __init__(self):
        self.flat, self.at = np.zeros(0, np.int32), np.zeros(1, np.int64)

    def add(self, ids: np.ndarray, at: np.ndarray) -> None:
        self.at = np.concatenate([self.at, at[1:] + self.at[-1]])
        self.flat = np.concatenate([self.flat, ids.astype(np.int32)])

    def joined(self, which: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of rows of ``counts`` sequences each, one after another, and where each row's ids begin (with the end)."""
        begin, size = self.at[which], self.at[which + 1] - self.at[which]
        end = np.cumsum(size)
        total = int(end[-1]) if len(end) else 0
        ids = self.flat[np.repeat(begin - (end - size), size) + np.arange(total)]
        return ids, np.concatenate([[0], end])[np.concatenate([[0], np.cumsum(counts)])]


class Bpe:
    """A vocabulary ready for batches of texts."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        if model["type"] != "BPE" or model.get("byte_fallback") or model.get("ignore_merges"):
            raise ValueError(f"{path}: only plain BPE models are supported")
        self.suffix = model.get("end_of_word_suffix") or ""
        vocab: dict[str, int] = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens") or []}
        if any(t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec.get("added_tokens") or []):
            raise ValueError(f"{path}: added tokens that take part in normalisation are not supported")
        self.special_at = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self._steps(spec)

        size = max([*vocab.values(), *self.special.values()]) + 1
        self.token = np.array([""] * size, dtype=object)
        for text, i in (vocab | self.special).items():
            self.token[i] = text
        letters = byte_letters()
        self.first = np.array([vocab.get(letters[b], -1) for b in range(256)], dtype=np.int64)
        self.last = np.array([vocab.get(letters[b] + self.suffix, -1) for b in range(256)], dtype=np.int64)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        cut = len(model.get("continuing_subword_prefix") or "")
        left = np.array([vocab[a] for a, _ in pairs], dtype=np.int64)
        right = np.array([vocab[b] for _, b in pairs], dtype=np.int64)
        made = np.array([vocab[a + b[cut:]] for a, b in pairs], dtype=np.int64)
        self.base = size
        # of a pair that is listed twice the first one counts
        keys, self.rank = np.unique(left * size + right, return_index=True)
        self.pairs, self.made = Pairs(keys), made[self.rank]
        self.byte_of = {c: b for b, c in letters.items()}
        self.byte_decoder = (spec.get("decoder") or {}).get("type") == "ByteLevel"
        self.known, self.ids = Numbers(), Sequences()
        self.stretches, self.stretch_ids = Numbers(), Sequences()

    def _steps(self, spec: dict) -> None:
        norm = spec.get("normalizer")
        steps = norm["normalizers"] if norm and norm["type"] == "Sequence" else [norm] if norm else []
        self.nfc = self.lower = False
        for s in steps:
            if s["type"] == "NFC":
                self.nfc = True
            elif s["type"] == "Lowercase":
                self.lower = True
            elif not (s["type"] == "Replace" and s["pattern"].get("Regex") == r"\s+" and s["content"] == " "):
                raise ValueError(f"normaliser {s['type']} is not supported")
        pre = spec["pre_tokenizer"]
        parts = pre["pretokenizers"] if pre["type"] == "Sequence" else [pre]
        split = next((p for p in parts if p["type"] == "Split"), None)
        level = next(p for p in parts if p["type"] == "ByteLevel")
        if level.get("add_prefix_space"):
            raise ValueError("add_prefix_space is not supported")
        if split and (split["behavior"] != "Removed" or not split["invert"]):
            raise ValueError("only a split that keeps the matches is supported")
        if bool(split) == bool(level.get("use_regex")):
            raise ValueError("one word pattern is expected")
        pattern = split["pattern"]["Regex"] if split else BYTE_LEVEL
        self.given, self.quick = _patterns(pattern)
        # a space before anything but white space begins a word of the one, and stands in no word of the other
        self.at_spaces, self.keeps_all = pattern in (BYTE_LEVEL, LETTERS_ONLY), pattern == BYTE_LEVEL
        self.odd = frozenset(_other_numbers())
        # white space is dropped by a split without it, so replacing runs of it changes nothing there

    def _normal(self, text: str) -> str:
        if text.isascii():
            return text.lower() if self.lower else text
        if self.nfc:
            text = unicodedata.normalize("NFC", text)
        if self.lower:
            text = text.replace("Σ", "σ").lower()  # sigma letter by letter, without the final form
        return text

    def _found(self, text: str) -> list[str]:
        odd = not text.isascii() and not self.odd.isdisjoint(set(text))
        return (self.given if odd else self.quick).findall(text)

    def _stretches(self, text: str) -> list[str]:
        """A text cut where no word goes across; a stretch without BEGIN follows a space. A special token is one by itself."""
        if self.special_at is None or "<" not in text and not any(s in text for s in self.special):
            return self._cut(self._normal(text))
        out: list[str] = []
        for i, part in enumerate(self.special_at.split(text)):
            if i % 2:
                out.append(MARK + part)
            elif part:
                out += self._cut(self._normal(part))
        return out

    def _cut(self, text: str) -> list[str]:
        if not self.at_spaces:
            return [BEGIN + text]
        out = _GAP.split(text) if _INNER.search(text) else text.split(" ")
        out[0] = BEGIN + out[0]
        return out

    def _words(self, stretch: str) -> list[str]:
        """The words of a stretch; a special token stands as a word that no pattern gives."""
        if stretch[:1] == MARK:
            return [stretch]
        return self._found(stretch[1:] if stretch[:1] == BEGIN else " " + stretch)

    def _all_words(self, stretches: list[str]) -> tuple[list[list[str]], np.ndarray]:
        """Lists that hold the words of all stretches in order, and the number of words of each stretch."""
        if not self.keeps_all or any(s[:1] == MARK for s in stretches):
            cut = [self._words(s) for s in stretches]
            return cut, np.array([len(c) for c in cut], np.int64)
        cut, sizes, lo = [], [], 0
        alone = [i for i, s in enumerate(stretches) if s[:1] == BEGIN or not s.isascii() and not self.odd.isdisjoint(s)]
        for i in [*alone, len(stretches)]:
            if lo < i:  # words hold every letter and end where a stretch ends, so their lengths tell whose they are
                words = self.quick.findall(" " + " ".join(stretches[lo:i]))
                ends = np.cumsum(np.fromiter(map(len, stretches[lo:i]), np.int64, i - lo) + 1)
                last = np.searchsorted(np.cumsum(np.fromiter(map(len, words), np.int64, len(words))), ends) + 1
                cut.append(words)
                sizes.append(np.diff(last, prepend=0))
            if i < len(stretches):
                words = self._words(stretches[i])
                cut.append(words)
                sizes.append(np.array([len(words)]))
            lo = i + 1
        return cut, np.concatenate(sizes)

    def merged(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words one after another, and where each word's ids begin (with the end)."""
        raw = [w.encode("utf-8", "replace") for w in words]
        sizes = np.array([len(b) for b in raw], dtype=np.int64)
        data = np.frombuffer(b"".join(raw), np.uint8)
        sym, word = self.first[data], np.repeat(np.arange(len(words)), sizes)
        ends = np.cumsum(sizes)[sizes > 0] - 1
        sym[ends] = self.last[data[ends]]
        keep = sym >= 0
        sym, word = sym[keep], word[keep]
        done_sym, done_word = [], []
        while len(sym):
            key = sym[:-1] * self.base + sym[1:]
            at = self.pairs.find(key)
            rank = np.where((at >= 0) & (word[:-1] == word[1:]), self.rank[at], np.iinfo(np.int64).max)
            best = np.full(len(words), np.iinfo(np.int64).max)
            np.minimum.at(best, word[:-1], rank)
            live = best[word] < np.iinfo(np.int64).max
            if not live.all():  # words that are done leave the array
                done_sym.append(sym[~live])
                done_word.append(word[~live])
            hit = np.flatnonzero((rank == best[word[:-1]]) & live[:-1])
            hit = _apart(hit)
            sym[hit] = self.made[at[hit]]
            live[hit + 1] = False
            sym, word = sym[live], word[live]
        if not done_sym:
            return np.zeros(0, np.int64), np.zeros(len(words) + 1, np.int64)
        sym, word = np.concatenate(done_sym), np.concatenate(done_word)
        order = np.argsort(word, kind="stable")
        return sym[order], np.searchsorted(word[order], np.arange(len(words) + 1))

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after another, and where each text's ids begin (with the end)."""
        if len(self.stretches) > REMEMBERED or not self.at_spaces:  # whole texts are not worth remembering
            self.stretches, self.stretch_ids = Numbers(), Sequences()
        old = len(self.stretches)
        which, sizes = self.stretches.of([self._stretches(t) if t else [] for t in texts])
        if len(self.stretches) > old:
            self.stretch_ids.add(*self._encoded(*self._all_words(self.stretches.since(old))))
        return self.stretch_ids.joined(which, sizes)

    def _encoded(self, cut: list[list[str]], sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of stretches of so many words one after another, and where each stretch's ids begin (with the end)."""
        if len(self.known) > REMEMBERED:
            self.known, self.ids = Numbers(), Sequences()
        old = len(self.known)
        which, _ = self.known.of(cut)
        fresh = self.known.since(old)
        if fresh:
            plain = [w for w in fresh if w[0] != MARK]
            ids, at = self.merged(plain)
            if len(plain) < len(fresh):
                own = iter(np.split(ids, at[1:-1]) if plain else ())
                parts = [np.array([self.special[w[1:]]]) if w[0] == MARK else next(own) for w in fresh]
                ids, at = np.concatenate(parts), np.concatenate([[0], np.cumsum([len(p) for p in parts])])
            self.ids.add(ids, at)
        return self.ids.joined(which, sizes)

    def decode(self, ids: np.ndarray) -> str:
        tokens = self.token[ids]
        if not self.byte_decoder:
            return " ".join(tokens.tolist())
        return _from_letters("".join(tokens.tolist()), self.byte_of)


def _from_letters(text: str, byte_of: dict[str, int]) -> str:
    return bytes(byte_of[c] for c in text).decode("utf-8", "replace")


def _apart(hit: np.ndarray) -> np.ndarray:
    """Of runs of overlapping pairs (equal letters in a row) every second one, from the left."""
    if len(hit) < 2:
        return hit
    starts = np.concatenate([[True], np.diff(hit) != 1])
    run = np.flatnonzero(starts)[np.cumsum(starts) - 1]
    return hit[(np.arange(len(hit)) - run) % 2 == 0]


@lru_cache(4)
def loaded(path: str) -> Bpe:
    return Bpe(path)


def pieces(column: pa.Array) -> Iterator[tuple[int, int]]:
    """Runs of rows of about TEXT_BYTES each."""
    sizes = np.cumsum(pc.binary_length(column).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
    row = 0
    while row < len(column):
        before = sizes[row - 1] if row else 0
        to = max(row + 1, int(np.searchsorted(sizes, before + TEXT_BYTES, "right")))
        yield row, min(to, len(column))
        row = to


def with_columns(df: DataFrame, column: Column | str, kinds: dict[str, T.DataType], made) -> DataFrame:
    """``df`` with columns that ``made(array)`` computes from one column, run of rows by run of rows.

    They replace columns of the same name. Only the one column goes to Python and only the new ones come back.
    """
    shape = T.StructType([T.StructField(n, k) for n, k in kinds.items()])

    def run(values: pa.Array) -> pa.Array:
        if isinstance(values, pa.ChunkedArray):
            values = values.combine_chunks()
        text = pa.types.is_string(values.type) or pa.types.is_large_string(values.type)
        parts = [made(values.slice(lo, hi - lo)) for lo, hi in pieces(values)] if text and len(values) else [made(values)]
        return pa.StructArray.from_arrays([pa.concat_arrays(list(x)) for x in zip(*parts, strict=True)], names=list(kinds))

    # counted as nondeterministic, so that it runs once for all the columns and filters made from it
    computed = F.arrow_udf(run, shape).asNondeterministic()
    taken = {k.lower() for k in kinds}
    kept = [c for c in df.columns if c.lower() not in taken]
    new = unused([*df.columns, *kinds], "computed")
    found = df.select(*[F.col(f"`{c}`") for c in kept], computed(column).alias(new))
    return found.select(*[F.col(f"`{c}`") for c in kept], *[F.col(new)[n].alias(n) for n in kinds])


def encode(df: DataFrame, path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """``df`` with the token ids of every whole text as an array of integers."""

    def made(column):
        flat, at = loaded(path).encode(column.to_pylist())
        return [pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(flat))]

    return with_columns(df, text, {ids: T.ArrayType(T.IntegerType())}, made)


def decode(df: DataFrame, path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """``df`` with the text of an array of ids; special tokens are kept in the text."""

    def made(column):
        bpe = loaded(path)
        return [pa.array([bpe.decode(np.asarray(x, np.int64)) if x is not None else "" for x in column.to_pylist()], pa.string())]

    return with_columns(df, ids, {text: T.StringType()}, made)


def digests(df: DataFrame, path: str, text: str = "text", keep_ids: bool = False) -> DataFrame:
    """``df`` with n_tokens, ids_sha256 and decoded_sha256 of every text: encode and decode in one pass.

    With keep_ids also the ids themselves. The ids are hashed as little-endian unsigned 32-bit integers, the decoded text in UTF-8.
    """

    def made(column):
        bpe = loaded(path)
        flat, at = bpe.encode(column.to_pylist())
        ids = [flat[a:b] for a, b in zip(at[:-1], at[1:], strict=True)]
        kept = [pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(flat))] if keep_ids else []
        return [
            *kept,
            pa.array(np.diff(at)),
            pa.array([hashlib.sha256(x.astype("<u4").tobytes()).hexdigest() for x in ids], pa.string()),
            pa.array([hashlib.sha256(bpe.decode(x).encode()).hexdigest() for x in ids], pa.string()),
        ]

    ids_kind = {"ids": T.ArrayType(T.IntegerType())} if keep_ids else {}
    return with_columns(df, text, ids_kind | {"n_tokens": T.LongType(), "ids_sha256": T.StringType(), "decoded_sha256": T.StringType()}, made)
