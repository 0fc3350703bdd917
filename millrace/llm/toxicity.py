r"""Toxicity by a small convolutional text classifier, trained in numpy.

A word is a run of letters, digits and characters beyond ASCII, A-Z as a-z. Its vector is the sum of two rows of one embedding
table, chosen by two hashes, so that words that share one row seldom share both. For every width in ``WIDTHS`` there
are ``FILTERS`` filters over that many consecutive words; a text's features are each filter's greatest value over the whole
text, and a logistic layer makes the score of them. Training takes scaled steps (Adagrad) over batches of texts; only the words
where a filter is greatest take part in a step. Words that few texts have are not learned from.

For scoring, each filter's part for each embedding row is computed once, so that a text's filters are sums of table rows.

Training reads every whole text of a label whose id is not held out. The texts are dealt by a hash of their id over shards of about
``SHARD_BYTES`` of text, written with four bytes for each word. Tasks learn from their shards, starting from the same network; the changes
of all shards are summed by Spark in whole units, so that their order does not matter, and their means, weighted by the texts, move the network
to where the next round starts. An embedding row takes the mean of the shards that changed it. The driver holds the network, never texts.
There are ``ROUNDS`` rounds, in each of which every text is passed once; a single shard is passed as often at least in one, and more often where it
is short. Rows that surely have no label are left out by a bitmap of hashed ids before they are encoded; it has a fixed size.
How many texts have a word is counted in ``BUCKETS`` buckets over all texts.

Thresholds are calibrated by language: a second network learns from three quarters of the texts and scores the rest, and the threshold of a
language is where the F1 of its labels is greatest, drawn towards that of all languages where it has few texts. These scores are
counted by language to a ``FINE``-th of the logit. The
language only chooses the threshold and never changes a score. Scores are moved on the logit scale so that the best
threshold of all languages together is ``CUT``.

Defined cases: null and empty texts have no words and score as a text in which no filter fires; all scores are 0 if there is nothing to learn
from or if one label is missing. Of labels of one id the greatest counts, labels that are null are not read, and rows that share an id
are texts of their own. Rows may repeat; other columns are kept, but for those of the outputs' names, which are replaced.
"""

from __future__ import annotations

import copy
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from millrace.llm import textops
from millrace.llm.bpe import with_columns
from millrace.llm.resample import WORD_BYTES
from millrace.sources.scratch import Scratch

#: Bytes of text in a shard, about; a task learns from that many words at a time, or twice that where ids are dealt unevenly.
SHARD_BYTES = 24_000_000
SHARD_WORDS = SHARD_BYTES // 6
ROUNDS = 4
BUCKETS = 1 << 20
#: Bits that tell, by a hash of their ids, rows without a label before they are encoded; a join decides for those that are left.
LABEL_BITS = 1 << 24
#: Summed changes are counted in this many units of one.
UNITS = 1 << 24
FINE = 1000
CUT = 0.3
ROWS = 1 << 16
SIZE = 12
WIDTHS = (1, 2, 3)
FILTERS = 12
BATCH = 64
#: Words after which a batch takes no further text.
BATCH_WORDS = 1 << 18
STEPS = 400
PASSES = 30
RATE = 0.05
WORD_RATE = 0.1
#: Vectors start this small, so that words never learned from leave the filters low.
SMALL = 0.05
DECAY = 1e-4
#: Words are learned from if so many texts have them; of those, a text leaves this part out in each step.
LEAST_TEXTS = 3
DROPPED = 0.6
#: Texts of a language that weigh as much as all languages together when its threshold is set.
PRIOR = 50


def word_rows(hashes: np.ndarray) -> list[np.ndarray]:
    """The two embedding rows of each word; row 0 is that of hash 0, no word's."""
    return [(1 + (h % np.uint64(ROWS - 1)).astype(np.int32)) * (hashes != 0) for h in (hashes, hashes >> np.uint64(32))]


def pairs(hashes: np.ndarray) -> np.ndarray:
    """Both embedding rows of each word in 32 bits."""
    one, two = word_rows(hashes)
    return one.astype(np.uint32) | two.astype(np.uint32) << np.uint32(16)


def pair_rows(words: np.ndarray) -> list[np.ndarray]:
    return [(words & np.uint32(ROWS - 1)).astype(np.int32), (words >> np.uint32(16)).astype(np.int32)]


def buckets(words: np.ndarray) -> np.ndarray:
    """The bucket in which each word is counted, from its two rows."""
    x = words * np.uint32(0x9E3779B1)
    x = (x ^ (x >> np.uint32(15))) * np.uint32(0x85EBCA6B)
    return (x >> np.uint32(12)).astype(np.int64) % BUCKETS


@dataclass
class Batch:
    """Texts end to end, with room between them so that no filter reaches from one into the next."""

    one: np.ndarray
    two: np.ndarray
    starts: np.ndarray

    @classmethod
    def of(cls, hashes: list[np.ndarray], rows=word_rows) -> Batch:
        gap = max(WIDTHS) - 1
        size = np.array([len(h) + gap for h in hashes], np.int64)
        starts = np.cumsum(size) - size
        total = int(size.sum())
        one, two = np.zeros(total + gap, np.int32), np.zeros(total + gap, np.int32)
        at = np.concatenate([s + np.arange(len(h)) for s, h in zip(starts, hashes, strict=True)]) if hashes else np.zeros(0, np.int64)
        if hashes:
            one[at], two[at] = rows(np.concatenate(hashes))
        return cls(one, two, starts)


@dataclass
class Model:
    table: np.ndarray  # rows x SIZE; row 0 stays zero
    filters: list[np.ndarray]  # for each width: width x SIZE x FILTERS
    bias: np.ndarray  # one for each filter
    weights: np.ndarray
    offset: float
    shift: float = 0.0
    thresholds: dict[str, float] = field(default_factory=dict)
    threshold: float = CUT
    parts: list[np.ndarray] | None = None

    def scores(self, hashes: list[np.ndarray], rows=word_rows) -> np.ndarray:
        if not hashes:
            return np.zeros(0)
        if self.parts is None:  # each filter's part of every embedding row, made once in a worker
            self.parts = [self.table @ f[k] for f in self.filters for k in range(len(f))]
        b = Batch.of(hashes, rows)
        n, features, part = len(b.one) - max(WIDTHS) + 1, [], 0
        for width in WIDTHS:
            value = np.zeros((n, FILTERS), np.float32)
            for k in range(width):
                value += self.parts[part][b.one[k : k + n]]
                value += self.parts[part][b.two[k : k + n]]
                part += 1
            features.append(np.maximum.reduceat(value, b.starts, axis=0))
        pooled = np.maximum(np.concatenate(features, axis=1) + self.bias, 0)
        return 1 / (1 + np.exp(-np.clip((pooled @ self.weights).astype(np.float64) + self.offset + self.shift, -30, 30)))


def widespread(hashes: list[np.ndarray]) -> list[np.ndarray]:
    """Each text's words, with 0 for those that fewer than ``LEAST_TEXTS`` texts have: they tell of one text, not of its label."""
    flat = np.concatenate(hashes)
    words, place = np.unique(flat, return_inverse=True)
    size = np.array([len(h) for h in hashes])
    once = np.unique(np.repeat(np.arange(len(hashes)), size) * len(words) + place) % max(len(words), 1)
    flat = np.where(np.bincount(once, minlength=len(words))[place] >= LEAST_TEXTS, flat, np.uint64(0))
    return np.split(flat, np.cumsum(size)[:-1])


class Learner:
    """A network and what its steps have to know of those before."""

    def __init__(self, seed: int):
        pick = np.random.default_rng(seed)
        self.model = Model(
            pick.normal(0, SMALL, (ROWS, SIZE)).astype(np.float32),
            [pick.normal(0, 1 / np.sqrt(w * SIZE), (w, SIZE, FILTERS)).astype(np.float32) for w in WIDTHS],
            np.zeros(len(WIDTHS) * FILTERS, np.float32), pick.normal(0, 0.3, len(WIDTHS) * FILTERS).astype(np.float32), 0.0,
        )
        self.seen = np.full(ROWS, 1e-6, np.float32)
        self.squares = [np.full_like(p, 1e-6) for p in self.params()]
        self.offset_square = 1e-6
        self.learned = np.zeros(ROWS, bool)

    def params(self) -> list[np.ndarray]:
        return [*self.model.filters, self.model.bias, self.model.weights]

    def rows(self) -> np.ndarray:
        """Each embedding row with the square of its steps."""
        return np.column_stack([self.model.table, self.seen]).astype(np.float64)

    def rest(self) -> np.ndarray:
        """All that is not of one embedding row, end to end."""
        return np.concatenate([*[p.ravel() for p in [*self.params(), *self.squares]], [self.model.offset, self.offset_square]]).astype(np.float64)

    def move(self, rows: np.ndarray, rest: np.ndarray) -> None:
        """Add changes as ``rows`` and ``rest`` are laid out."""
        self.model.table += rows[:, :SIZE].astype(np.float32)
        self.seen += rows[:, SIZE].astype(np.float32)
        at = 0
        for p in [*self.params(), *self.squares]:
            p += rest[at : at + p.size].reshape(p.shape).astype(np.float32)
            at += p.size
        self.model.offset += float(rest[-2])
        self.offset_square += float(rest[-1])

    def learn(self, words: list[np.ndarray], toxic: np.ndarray, weight: np.ndarray, steps: int, pick: np.random.Generator) -> None:
        """Take so many steps, and as many more as every text needs to be passed once; ``words`` are pairs, 0 is no word."""
        m, params = self.model, self.params()
        order, passed, step = np.zeros(0, np.int64), 0, 0
        while step < steps or passed < len(toxic):
            if len(order) < min(BATCH, len(toxic)):
                order = np.concatenate([order, pick.permutation(len(toxic))])
            taken = [words[i][pick.random(len(words[i])) >= DROPPED] for i in order[:BATCH]]
            size = max(1, int(np.searchsorted(np.cumsum([len(w) for w in taken]), BATCH_WORDS, "right")))
            now, order = order[: len(taken[:size])], order[len(taken[:size]) :]
            step, passed = step + 1, passed + len(now)
            b = Batch.of(taken[:size], pair_rows)
            n = len(b.one) - max(WIDTHS) + 1
            # the filters' parts of each different word of the batch, then sums over its places
            _, first, word = np.unique(b.one.astype(np.int64) * ROWS + b.two, return_index=True, return_inverse=True)
            x = m.table[b.one[first]] + m.table[b.two[first]]
            best, value = [], []
            for width, f in zip(WIDTHS, m.filters, strict=True):
                v = sum((x @ f[k])[word[k : k + n]] for k in range(width))
                at = np.stack([v[lo:hi].argmax(axis=0) + lo for lo, hi in zip(b.starts, [*b.starts[1:], n], strict=True)])
                best.append(at)
                value.append(np.take_along_axis(v, at, axis=0))
            raw = np.concatenate(value, axis=1) + m.bias
            pooled = np.maximum(raw, 0)
            p = 1 / (1 + np.exp(-np.clip(pooled @ m.weights + m.offset, -30, 30)))
            error = ((p - toxic[now]) * weight[now] / len(now)).astype(np.float32)
            back = error[:, None] * m.weights * (raw > 0)
            grads = []
            at_rows, at_grads = [], []
            for i, (width, f) in enumerate(zip(WIDTHS, m.filters, strict=True)):
                own = back[:, i * FILTERS : (i + 1) * FILTERS]
                g = np.zeros_like(f)
                for k in range(width):
                    places = best[i] + k
                    g[k] = np.einsum("bf,bfs->sf", own, x[word[places]])
                    gx = own[:, :, None] * f[k].T[None]
                    at_rows += [b.one[places].ravel(), b.two[places].ravel()]
                    at_grads += [gx.reshape(-1, SIZE)] * 2
                grads.append(g + DECAY * f)
            grads += [back.sum(axis=0), pooled.T @ error + DECAY * m.weights]
            for q, g, s in zip(params, grads, self.squares, strict=True):
                s += g * g
                q -= RATE * g / np.sqrt(s)
            self.offset_square += float(error.sum()) ** 2
            m.offset -= RATE * float(error.sum()) / self.offset_square**0.5
            rows, group = np.unique(np.concatenate(at_rows), return_inverse=True)
            total = np.zeros((len(rows), SIZE), np.float32)
            np.add.at(total, group, np.concatenate(at_grads))
            total[rows == 0] = 0
            self.seen[rows] += (total * total).mean(axis=1)
            m.table[rows] -= WORD_RATE * total / np.sqrt(self.seen[rows])[:, None]
            self.learned[rows] |= rows != 0

    def finished(self) -> Model:
        self.model.table[~self.learned] = 0
        return self.model


def started(seed: int = 11) -> Learner:
    learner = Learner(seed)
    learner.model.table[0] = 0
    return learner


def full_steps(texts: int) -> int:
    """The steps of a single shard: ``STEPS`` or those that many texts need to be passed ``ROUNDS`` times."""
    once = -(-texts // BATCH)
    return max(min(STEPS, PASSES * once), ROUNDS * once)


def weights(toxic: np.ndarray, share: float) -> np.ndarray:
    """Both labels weigh alike where this share of the texts is toxic."""
    return np.where(toxic, 0.5 / share, 0.5 / (1 - share))


def fitted(hashes: list[np.ndarray], toxic: np.ndarray, seed: int = 11) -> Model | None:
    """The network for texts in memory, in a fixed order: a single shard."""
    if not len(toxic) or toxic.all() or not toxic.any():
        return None
    learner = started(seed)
    words = [pairs(h) for h in widespread(hashes)]
    learner.learn(words, toxic, weights(toxic, toxic.mean()), full_steps(len(toxic)), np.random.default_rng(seed))
    return learner.finished()


def best_cut(scores: np.ndarray, toxic: np.ndarray, texts: np.ndarray | None = None) -> float:
    """The threshold of greatest F1, half-way between neighbouring scores; CUT if there are not both labels.

    Each score is that of one text, or of so many ``texts`` of which so many are toxic.
    """
    texts = np.ones(len(scores)) if texts is None else texts
    if not toxic.sum() or toxic.sum() == texts.sum():
        return CUT
    order = np.argsort(-scores, kind="stable")
    hit = np.cumsum(toxic[order])
    f1 = 2 * hit / (np.cumsum(texts[order]) + toxic.sum())
    k = int(f1.argmax())
    below = scores[order[k + 1]] if k + 1 < len(order) else 0.0
    return float((scores[order[k]] + below) / 2)


def logit(p):
    p = np.clip(p, 1e-6, 1 - 1e-6)
    return np.log(p / (1 - p))


def calibrated(model: Model, scores: np.ndarray, toxic: np.ndarray, langs: np.ndarray, texts: np.ndarray | None = None) -> Model:
    """Move scores so that the best threshold of all texts is CUT, and set one threshold for each language.

    Scores of one language are those of one text each, or of ``texts`` as in ``best_cut``.
    """
    texts = np.ones(len(scores)) if texts is None else texts
    every, place = np.unique(scores, return_inverse=True)
    model.shift = float(logit(np.float64(CUT)) - logit(np.float64(best_cut(every, np.bincount(place, toxic), np.bincount(place, texts)))))
    moved = 1 / (1 + np.exp(-(logit(scores) + model.shift)))
    for name in sorted(set(langs.tolist()) - {None}):
        own = langs == name
        n = int(texts[own].sum())
        z = (n * logit(best_cut(moved[own], toxic[own], texts[own])) + PRIOR * logit(np.float64(CUT))) / (n + PRIOR)
        model.thresholds[name] = float(1 / (1 + np.exp(-z)))
    return model


def held_out(id_col: str = "doc_id") -> Column:
    """The quarter of all ids that training never reads; a row without id is not held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == 2, F.lit(False))


def word_hashes(texts: pa.Array) -> list[np.ndarray]:
    out: list[np.ndarray] = []
    for w in textops.words(texts, WORD_BYTES):
        h = w.hashes()
        out += [h[a:b] for a, b in zip(w.first[:-1], w.first[1:], strict=True)]
    return out


def known_labels(labels: DataFrame, id_col: str, label: str) -> DataFrame:
    """(id, toxic): the greatest label of each id."""
    rows = labels.where(F.col(label).isNotNull() & F.col(id_col).isNotNull())
    return rows.groupBy(F.col(id_col).cast("long").alias("id")).agg((F.max(F.col(label).cast("int")) > 0).cast("int").alias("toxic"))


def learnable(rows: DataFrame, known: DataFrame) -> DataFrame:
    """``rows(id, ...)`` that have a label, with toxic and kept: a quarter is kept for calibration."""
    return rows.join(known, "id").withColumn("kept", F.pmod(F.xxhash64("id", F.lit(13)), F.lit(4)) == 3)


def label_bit(id_col: str = "id") -> Column:
    return F.pmod(F.xxhash64(id_col, F.lit(5)), F.lit(LABEL_BITS)).cast("int")


def label_bits(known: DataFrame) -> np.ndarray:
    """The bits of all labelled ids."""
    groups = known.select(label_bit().alias("bit")).groupBy(F.shiftright("bit", 6).alias("group")).agg(F.expr("bit_or(shiftleft(1L, bit % 64))").alias("bits"))
    found = groups.toArrow()
    out = np.zeros(LABEL_BITS // 64, np.int64)
    out[found.column("group").to_numpy()] = found.column("bits").to_numpy()
    return out


def encoded(texts: DataFrame, bits: np.ndarray) -> DataFrame:
    """(id, lang, words) of ``texts(id, lang, text)`` whose bit is set: the pairs of all words, four bytes each."""
    shared = texts.sparkSession.sparkContext.broadcast(bits)

    def run(batches):
        for b in batches:
            at = b.column(3).to_numpy()
            b = b.filter(pa.array((shared.value[at >> 6] >> (at & 63)) & 1 != 0))
            for w in textops.words(b.column(2), WORD_BYTES):
                found = pairs(w.hashes()).astype("<u4")
                part = b.select([0, 1]).slice(w.row0, len(w.first) - 1)
                words = pa.array([found[lo:hi].tobytes() for lo, hi in zip(w.first[:-1], w.first[1:], strict=True)], pa.binary())
                yield pa.RecordBatch.from_arrays([*part.columns, words], ["id", "lang", "words"])

    return texts.select("id", "lang", "text", label_bit()).mapInArrow(textops.tidy(run), "id long, lang string, words binary")


def words_of(column: pa.Array) -> list[np.ndarray]:
    return [np.frombuffer(x, "<u4") for x in column.to_pylist()]


def widespread_buckets(texts: DataFrame) -> np.ndarray:
    """Whether each bucket holds a word of at least ``LEAST_TEXTS`` texts, as far as buckets tell words apart."""

    def run(batches):
        n = np.zeros(BUCKETS, np.int32)
        for b in batches:
            for w in words_of(b.column(0)):
                n[np.unique(buckets(w))] += 1
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(np.minimum(n[at], LEAST_TEXTS))], ["bucket", "n"])

    counted = texts.select("words").mapInArrow(textops.tidy(run), "bucket int, n int").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(BUCKETS, bool)
    out[counted.where(F.col("n") >= LEAST_TEXTS).select("bucket").toArrow().column(0).to_numpy()] = True
    return out


_VALUES = [f"v{i}" for i in range(SIZE + 1)]


def next_round(texts: DataFrame, learners: list[Learner], shares: list[float], common: np.ndarray, shards: int, number: int) -> None:
    """Move the learners by what all shards of ``texts`` teach; the second one learns nothing from texts that are kept."""
    shared = texts.sparkSession.sparkContext.broadcast((learners, np.packbits(common)))

    def run(batches):
        starts, known = shared.value
        known = np.unpackbits(known).astype(bool)
        sums = [(np.zeros((ROWS, SIZE + 1), np.int64), np.zeros(ROWS, np.int64), np.zeros(len(x.rest()), np.int64), [0]) for x in starts]

        def taught(shard, words, toxic, kept):
            words = [np.where(known[buckets(w)], w, np.uint32(0)) for w in words]
            for k, own in enumerate((np.ones(len(kept), bool), ~kept)[: len(starts)]):
                if not own.any():
                    continue
                learner, n = copy.deepcopy(starts[k]), int(own.sum())
                learner.learned[:] = False
                steps = full_steps(n) if shards == 1 else 0
                learner.learn([w for w, o in zip(words, own, strict=True) if o], toxic[own], weights(toxic[own], shares[k]), steps, np.random.default_rng([shard, number]))
                rows, has, rest, total = sums[k]
                at = learner.learned
                rows[at] += n * np.rint((learner.rows()[at] - starts[k].rows()[at]) * UNITS).astype(np.int64)
                has[at] += n
                rest += n * np.rint((learner.rest() - starts[k].rest()) * UNITS).astype(np.int64)
                total[0] += n

        shard, words, toxic, kept, size = None, [], [], [], 0
        for b in batches:
            for s, w, t, c in zip(b.column(0).to_pylist(), words_of(b.column(1)), b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True):
                if words and (s != shard or size >= 2 * SHARD_WORDS):
                    taught(shard, words, np.array(toxic, float), np.array(kept))
                    words, toxic, kept, size = [], [], [], 0
                shard, size = s, size + len(w)
                words.append(w)
                toxic.append(t)
                kept.append(c)
        if words:
            taught(shard, words, np.array(toxic, float), np.array(kept))
        for k, (rows, has, rest, total) in enumerate(sums):
            at = np.flatnonzero(has)
            wide = np.pad(rest, (0, -len(rest) % (SIZE + 1))).reshape(-1, SIZE + 1)
            row = np.concatenate([at, ROWS + np.arange(len(wide))]).astype(np.int32)
            n = np.concatenate([has[at], np.full(len(wide), total[0])])
            v = np.concatenate([rows[at], wide])
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(row), k, np.int32)), pa.array(row), pa.array(n), *[pa.array(x) for x in v.T]], ["learner", "row", "n", *_VALUES])

    kinds = ", ".join(["learner int, row int, n long", *[f"{v} long" for v in _VALUES]])
    changes = texts.select("shard", "words", "toxic", "kept").mapInArrow(textops.tidy(run), kinds).groupBy("learner", "row").agg(*[F.sum(c).alias(c) for c in ["n", *_VALUES]])
    found = changes.toArrow()
    shared.unpersist()
    which, row, n = (found.column(c).to_numpy() for c in ("learner", "row", "n"))
    mean = np.column_stack([found.column(v).to_numpy() for v in _VALUES]) / np.maximum(n, 1)[:, None] / UNITS
    for k, learner in enumerate(learners):
        own = (which == k) & (row < ROWS)
        rows = np.zeros((ROWS, SIZE + 1))
        rows[row[own]] = mean[own]
        learner.learned[row[own]] = True
        own = (which == k) & (row >= ROWS)
        rest = mean[own][np.argsort(row[own])].ravel()
        learner.move(rows, rest[: len(learner.rest())] if len(rest) else np.zeros(len(learner.rest())))


def kept_scores(texts: DataFrame, model: Model) -> pa.Table:
    """(lang, fine, texts, toxic): how many of the kept texts of a language have a score, to a ``FINE``-th of the logit."""
    shared = texts.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for b in batches:
            words, lo = words_of(b.column(2)), 0
            ends, out = np.cumsum([len(w) for w in words]), []
            while lo < len(words):
                hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + BATCH_WORDS, "right")))
                out.append(shared.value.scores(words[lo:hi], pair_rows))
                lo = hi
            scores = np.concatenate(out) if out else np.zeros(0)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(np.rint(logit(scores) * FINE).astype(np.int32))], ["lang", "toxic", "fine"])

    scored = texts.where("kept").select("lang", "toxic", "words").mapInArrow(textops.tidy(run), "lang string, toxic int, fine int")
    return scored.groupBy("lang", "fine").agg(F.count(F.lit(1)).alias("texts"), F.sum("toxic").alias("toxic")).orderBy("lang", "fine").toArrow()


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", lang: str | None = "lang", label: str = "toxic", shard_bytes: int = SHARD_BYTES) -> Model | None:
    """Learn from all labelled texts whose id is not held out; None if there are no texts of both labels."""
    scratch = Scratch(docs.sparkSession, "toxicity")
    # written, so that its size is known when the joins with it are planned
    known = scratch.write(known_labels(labels, id_col, label), "known")
    lang_of = F.col(lang).cast("string") if lang else F.lit(None).cast("string")
    rows = docs.where(~held_out(id_col) & F.col(id_col).isNotNull() & F.col(text).isNotNull())
    rows = rows.select(F.col(id_col).cast("long").alias("id"), lang_of.alias("lang"), F.col(text).alias("text"))
    sizes = learnable(rows.select("id", F.octet_length("text").cast("long").alias("bytes")), known)
    sizes = sizes.groupBy("kept", "toxic").agg(F.count(F.lit(1)).alias("n"), F.sum("bytes").alias("bytes")).collect()
    counts = [{v: sum(r["n"] for r in sizes if r["toxic"] == v and r["kept"] in parts) for v in (0, 1)} for parts in ((True, False), (False,))]
    if not all(counts[0].values()):
        scratch.release()
        return None
    both = 2 if all(counts[1].values()) and any(r["kept"] for r in sizes) else 1
    shards = max(1, -(-sum(r["bytes"] for r in sizes) // shard_bytes))
    # encoded before they are joined, so that no shuffle holds texts
    found = learnable(encoded(rows, label_bits(known)), known).withColumn("shard", F.pmod(F.xxhash64("id", F.lit(17)), F.lit(shards)).cast("int"))
    dealt = found.repartitionById(shards, F.col("shard")).sortWithinPartitions("shard", F.xxhash64("id", F.lit(11)), "id", "lang", "words")
    texts = scratch.write(dealt, "texts")
    common = widespread_buckets(texts)
    learners = [started() for _ in range(both)]
    shares = [c[1] / (c[0] + c[1]) for c in counts]
    for number in range(ROUNDS if shards > 1 else 1):
        next_round(texts, learners, shares, common, shards, number)
    model = learners[0].finished()
    if both == 2:
        kept = kept_scores(texts, learners[1].finished())
        scores = 1 / (1 + np.exp(-kept.column("fine").to_numpy() / FINE))
        model = calibrated(model, scores, kept.column("toxic").to_numpy().astype(float), kept.column("lang").to_numpy(), kept.column("texts").to_numpy().astype(float))
    scratch.release()
    return model


def judge(docs: DataFrame, model: Model | None, text: str = "text", score: str = "score") -> DataFrame:
    """``docs`` with the score of every whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def made(column):
        if shared.value is None:
            return [pa.array(np.zeros(len(column)))]
        out = []
        for w in textops.words(column, WORD_BYTES):
            h = w.hashes()
            out.append(shared.value.scores([h[a:b] for a, b in zip(w.first[:-1], w.first[1:], strict=True)]))
        return [pa.array(np.concatenate(out) if out else np.zeros(0))]

    return with_columns(docs, text, {score: T.DoubleType()}, made)


def flagged(scored: DataFrame, model: Model | None, lang: str = "lang", score: str = "score", threshold: str = "threshold", flag: str = "flagged") -> DataFrame:
    """``scored`` with the threshold of each row's language (that of all for others) and whether the score reaches it."""
    known = model.thresholds if model else {}
    cut = F.lit(model.threshold if model else CUT)
    for name, value in known.items():
        cut = F.when(F.col(lang) == name, F.lit(value)).otherwise(cut)
    return scored.withColumns({threshold: cut}).withColumn(flag, F.col(score) >= F.col(threshold))
