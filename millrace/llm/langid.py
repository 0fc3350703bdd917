"""Language identification with string kernels.

The kernel of two texts is the number of n-grams of 1 to 4 bytes that both hold, each counted once (the blended-spectrum
presence kernel), over the root of the product of both texts' own numbers. Runs of ASCII characters other than letters count
as one blank, A-Z as a-z, and n-grams of two bytes or more are hashed into a fixed number of slots.

``LANDMARKS`` training texts of each language stand for all (Nyström): a text's features are its kernels with them, times
the inverse root of their own kernel matrix. Kernel ridge regression, one against the rest for each language, is then a
small linear system, and scoring is a product of presence and landmark matrices for a whole batch of texts.

Training reads at most ``SAMPLE`` texts of each language, chosen by a hash of their id. The model's size is bounded by
these two numbers and the number of languages.

A text is familiar as far as the landmarks of its language hold its n-grams, on average over them and over its pieces of ``PIECE``
bytes. Texts of no learned language are less familiar than nearly all that were learned from: the limit of a language is
``LEAST_SHARE`` of what all but one in a hundred of its training texts reach. A few words alone cannot be told so.

Defined cases: a null text, or one without a letter, is ``und`` with score 0, as is every text if there is nothing to learn
from. The score is the best regression value brought from [-1, 1] to [0, 1]; equal values go to the language first in
order of name. Rows may repeat; other columns are kept, but for those of the outputs' names, which are
replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from millrace.llm import textops
from millrace.llm.bpe import with_columns
from millrace.sources.scratch import Scratch

UNKNOWN = "und"
SAMPLE = 400
LANDMARKS = 24
RIDGE = 0.01
#: Slots for the n-grams of 1, 2, 3 and 4 bytes; powers of two.
SLOTS = (256, 4096, 8192, 8192)
PIECE = 4096
LEAST_SHARE = 0.6
BLOCK_ROWS = 256
BLOCK_BYTES = 1 << 19

_B = np.arange(256)
_LETTER = ((_B >= 65) & (_B <= 90)) | ((_B >= 97) & (_B <= 122)) | (_B >= 128)
_FOLD = np.where(_LETTER, np.where((_B >= 65) & (_B <= 90), _B + 32, _B), 32).astype(np.uint32)
_A_LETTER = regex.compile(r"\p{L}")


def has_letter(text: str | None) -> bool:
    return bool(text) and _A_LETTER.search(text) is not None


def presence(texts: list[bytes]) -> np.ndarray:
    """One row for each text, 1 in the slot of every n-gram it holds."""
    out = np.zeros((len(texts), sum(SLOTS)), np.uint8)
    # a blank on either side, so that first and last n-grams count; three more keep neighbours apart
    data = _FOLD[np.frombuffer(b"".join(b" " + t + b"    " for t in texts), np.uint8)]
    row = np.repeat(np.arange(len(texts)), [len(t) + 5 for t in texts])
    blank = data == 32
    keep = np.ones(len(data), bool)
    keep[1:] = ~(blank[1:] & blank[:-1] & (row[1:] == row[:-1]))
    data, row = data[keep], row[keep]
    code, base = np.zeros(len(data), np.uint32), 0
    for n, slots in enumerate(SLOTS, 1):
        size = len(data) - n + 1
        if size <= 0:
            break
        code = (code[:size] << np.uint32(8)) | data[n - 1 :]
        slot = code if slots == 256 else (code * np.uint32(2654435761)) >> np.uint32(33 - slots.bit_length())
        same = row[:size] == row[n - 1 :]
        out[row[:size][same], base + slot[same]] = 1
        base += slots
    return out


def blocks(texts: list[str | bytes | None]):
    """(first row, presence) of runs of texts."""
    raw = [t if isinstance(t, bytes) else (t or "").encode("utf-8", "replace") for t in texts]
    row = 0
    while row < len(raw):
        to, size = row, 0
        while to < len(raw) and to - row < BLOCK_ROWS and (to == row or size + len(raw[to]) <= BLOCK_BYTES):
            size += len(raw[to])
            to += 1
        yield row, presence(raw[row:to])
        row = to


@dataclass
class Model:
    languages: list[str]
    landmarks: np.ndarray  # slots x landmarks
    sizes: np.ndarray
    weights: np.ndarray  # landmarks x languages
    owners: np.ndarray  # landmarks x languages: 1 / their number for the landmarks of a language
    limits: np.ndarray | None = None  # how familiar a text of each language is at least

    def scores(self, present: np.ndarray) -> np.ndarray:
        return self._values(present)[0]

    def _values(self, present: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(regression values, how familiar) of each text for each language."""
        x = present.astype(np.float32)
        shared, size = x @ self.landmarks, np.maximum(x.sum(axis=1), 1)[:, None]
        return (shared / np.sqrt(size * self.sizes)) @ self.weights, (shared / size) @ self.owners

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        return self.judged(texts)[:2]

    def judged(self, texts: list[str | None], familiar: bool = False) -> tuple[list[str], np.ndarray, np.ndarray]:
        """(language, score, how familiar) of every text; how familiar only if asked for."""
        names, best, near = [UNKNOWN] * len(texts), np.zeros(len(texts)), np.zeros(len(texts))
        if not self.languages:
            return names, best, near
        for row, present in blocks(texts):
            values, known = self._values(present)
            top = values.argmax(axis=1)
            for i, k in enumerate(top):
                if has_letter(texts[row + i]):
                    names[row + i] = self.languages[k]
                    best[row + i] = min(1.0, max(0.0, (float(values[i, k]) + 1) / 2))
                    if familiar:
                        near[row + i] = self._by_pieces(texts[row + i], k, known[i, k])
        return names, best, near

    def _by_pieces(self, text: str, language: int, whole: float) -> float:
        raw = text.encode("utf-8", "replace")
        if len(raw) <= PIECE:
            return float(whole)
        cut = [raw[i : i + PIECE] for i in range(0, len(raw), PIECE)]
        near = np.concatenate([self._values(p)[1][:, language] for _, p in blocks(cut)])
        return float(np.average(near, weights=[len(c) for c in cut]))


def fitted(languages: np.ndarray, present: np.ndarray, landmarks: int = LANDMARKS, ridge: float = RIDGE) -> Model:
    """The model for training texts in a fixed order."""
    names = sorted(set(languages.tolist()))
    if not names:
        return Model([], np.zeros((sum(SLOTS), 0), np.float32), np.zeros(0, np.float32), np.zeros((0, 0), np.float32), np.zeros((0, 0), np.float32))
    chosen = np.concatenate([np.flatnonzero(languages == n)[:landmarks] for n in names])
    marks = present[chosen].astype(np.float32).T.copy()
    sizes = np.maximum(marks.sum(axis=0), 1)
    x = present.astype(np.float32)
    kernel = ((x @ marks) / np.sqrt(np.maximum(x.sum(axis=1), 1)[:, None] * sizes)).astype(np.float64)
    values, vectors = np.linalg.eigh(kernel[chosen])
    root = vectors / np.sqrt(np.maximum(values, 1e-6)) @ vectors.T
    features = kernel @ root
    targets = np.where(languages[:, None] == np.array(names)[None, :], 1.0, -1.0)
    # each language weighs alike, however many texts it has
    weight = np.array([1.0 / (languages == n).sum() for n in languages])[:, None]
    solved = np.linalg.solve(features.T @ (features * weight) + ridge * np.eye(features.shape[1]), features.T @ (targets * weight))
    owners = (languages[chosen][:, None] == np.array(names)[None, :]).astype(np.float32)
    return Model(names, marks, sizes.astype(np.float32), (root @ solved).astype(np.float32), owners / owners.sum(axis=0))


def held_out(id_col: str = "doc_id") -> Column:
    """The third of all ids that training never reads; a row without id is not held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 3 == 1, F.lit(False))


def train(docs: DataFrame, id_col: str = "doc_id", text: str = "text", lang: str = "lang", sample: int = SAMPLE) -> Model:
    """Learn from the texts whose language is known and whose id is not held out; rows without id are told apart by their texts."""
    rows = docs.where(~held_out(id_col) & F.col(lang).isNotNull() & F.col(text).isNotNull())
    counts = {r["lang"]: r["n"] for r in rows.groupBy(F.col(lang).alias("lang")).agg(F.count("*").alias("n")).collect()}
    # about twice the sample of each language by hash, cut to the sample below
    limit = {k: min(1 << 30, int((1 << 30) * 2 * sample / n)) for k, n in counts.items()}
    limits = F.create_map(*[F.lit(x) for pair in limit.items() for x in pair]) if limit else F.create_map(F.lit(""), F.lit(0))
    place = F.pmod(F.xxhash64(F.coalesce(F.col(id_col).cast("string"), F.col(text)), F.lit(4)), F.lit(1 << 30))
    kept = rows.select(F.col(id_col).cast("string").alias("id"), F.col(lang).alias("lang"), place.alias("place"), F.col(text).alias("text"))
    kept = Scratch(docs.sparkSession, "langid").write(kept.where(F.col("place") < limits[F.col("lang")]), "sample")

    def read(batches):
        for b in batches:
            texts = b.column(3).to_pylist()
            ok = [i for i, t in enumerate(texts) if has_letter(t)]
            bits = [x.tobytes() for _, p in blocks([texts[i] for i in ok]) for x in np.packbits(p, axis=1)]
            part = b.select([0, 1, 2]).take(pa.array(ok, pa.int64()))
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(bits, pa.binary())], ["id", "lang", "place", "bits"])

    found = kept.mapInArrow(textops.tidy(read), "id string, lang string, place long, bits binary").toPandas()
    found = found.sort_values(["lang", "place", "id"], kind="stable").groupby("lang", sort=False).head(sample)
    width = sum(SLOTS)
    present = np.stack([np.unpackbits(np.frombuffer(x, np.uint8), count=width) for x in found["bits"]]) if len(found) else np.zeros((0, width), np.uint8)
    model = fitted(found["lang"].to_numpy(str), present)
    if model.languages:
        model.limits = limits_of(kept, model)
    return model


def limits_of(sample: DataFrame, model: Model) -> np.ndarray:
    """The limit of each language from ``sample(lang, text)``, which is bounded."""
    shared = sample.sparkSession.sparkContext.broadcast(model)

    def measure(batches):
        for b in batches:
            texts, langs = b.column(1).to_pylist(), b.column(0).to_pylist()
            names, _, near = shared.value.judged(texts, familiar=True)
            right = [i for i, n in enumerate(names) if n == langs[i]]
            yield pa.RecordBatch.from_arrays([pa.array([names[i] for i in right], pa.string()), pa.array(near[right])], ["lang", "near"])

    found = sample.select("lang", "text").mapInArrow(textops.tidy(measure), "lang string, near double").toPandas()
    own = [np.sort(found["near"][found["lang"] == n].to_numpy()) for n in model.languages]
    return np.array([LEAST_SHARE * v[len(v) // 100] if len(v) else 0.0 for v in own])


def identify(docs: DataFrame, model: Model, text: str = "text", lang_pred: str = "lang_pred", score: str = "score", known: str | None = None) -> DataFrame:
    """``docs`` with the predicted language and its score for every whole text.

    ``known`` names a further column: whether the text is as familiar as texts of that language are.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def made(column):
        m = shared.value
        names, best, near = m.judged(column.to_pylist(), familiar=known is not None)
        found = [pa.array(names, pa.string()), pa.array(best)]
        if known is not None:
            limit = dict(zip(m.languages, m.limits if m.limits is not None else (), strict=False))
            found.append(pa.array([n != UNKNOWN and v >= limit.get(n, 0.0) for n, v in zip(names, near.tolist(), strict=True)], pa.bool_()))
        return found

    return with_columns(docs, text, {lang_pred: T.StringType(), score: T.DoubleType()} | ({known: T.BooleanType()} if known else {}), made)
