"""Documents that hold benchmark questions, whole or in good part, also with other numbers, names or units.

Words are runs of letters and digits; everything else only separates them. A run of numbers is the placeholder NUM, a unit right
after a number is UNIT, and a word that begins with a capital can be NAME; all other words stand for themselves with
A-Z as a-z. ``WINDOW`` words in a row are a window. Whether a capital is a name cannot be told for sure (it may open a sentence,
or the copy may be in other case), so windows are read in several ways: an item's windows with every choice of its capitals as names
or plain words, a document's with all capitals as names, with only those that open no sentence, and with none. A
window with fewer than ``PLAIN_WINDOW`` plain words is not dropped but read once more, by its exact words and values.

Windows of the documents are joined with those of the benchmark by hash. A filter of fixed size (``FILTER_BITS``), built
from all benchmark windows, keeps the others from being shuffled; it decides nothing. Hits of a document and an item whose
diagonals lie within ``SHIFT`` words of each other belong together. Their slots must be consistent: each value of the item stands
for one value of the document and the other way round. A diagonal whose numbers, units or names inside sentences contradict each
other does not count; of other capitals that do, and of diagonals that do, the pairs in most windows count.

A document is contaminated by an item if consistent windows hold ``COVERED`` of the item's words, and at least ``LEAST`` of them
(all, if it has fewer), of which at least ``PLAIN`` are equal words and no numbers, units or names. An item with too few such
words has to be held by ``EXACT`` words (all, if it has fewer), all of them equal.

Defined cases: null or empty documents and items match nothing, and neither do items of fewer than ``WINDOW`` words, which cannot be
told from chance. Rows that share an id are one document or item; rows without id match nothing. Empty tables give an
empty result. Other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from millrace.llm import textops
from millrace.llm.jaccard import lists, signed
from millrace.sources.scratch import Scratch

WINDOW = 5
PLAIN_WINDOW = 3
PLAIN = 5
LEAST = 10
COVERED = 0.5
EXACT = 20
#: Words that may be put in or left out between two parts of a copy.
SHIFT = 16
FILTER_BITS = 1 << 24

#: Units that follow a number.
UNITS = (
    "mm cm m km inch inches foot feet ft yard yards yd mile miles mi mg g kg gram grams kilogram kilograms ton tons lb lbs pound pounds oz "
    "ml l litre litres liter liters gallon gallons s sec second seconds min minute minutes h hr hour hours day days week weeks month months "
    "year years mph kmh kph hz khz mhz ghz w kw kwh j kj cal kcal v mv a ma pa kpa k c f usd eur gbp dollar dollars euro euros cent cents "
    "percent degree degrees byte bytes kb mb gb tb"
).split()

_B = np.arange(256)
_DIGIT = (_B >= 48) & (_B <= 57)
_WORD = _DIGIT | ((_B >= 65) & (_B <= 90)) | ((_B >= 97) & (_B <= 122)) | (_B >= 128)
_STOP = np.isin(_B, [ord(c) for c in ".!?\n\r:"])
_NUM, _UNIT, _NAME = textops.mixed(np.array([11, 12, 13], np.uint64))


def hashed(words: list[str]) -> np.ndarray:
    w = next(textops.words(pa.array([" ".join(words)]), _WORD))
    return w.hashes()


_UNIT_HASHES = np.sort(hashed(UNITS))


_SALT = textops.mixed(np.array([21], np.uint64))[0]


def canonical(w: textops.Words) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(words, values, capital, opens, first): words with NUM and UNIT put in, given word hashes, whether a word begins with a
    capital and whether it opens a sentence; one entry for each run of numbers."""
    plain = w.hashes()
    n = len(plain)
    first_of_row = np.zeros(n + 1, bool)
    first_of_row[w.first[:-1]] = True
    first_of_row = first_of_row[:n]
    number = _DIGIT[w.raw[w.starts]]
    after = np.concatenate([[False], number[:-1]]) & ~first_of_row
    at = np.minimum(np.searchsorted(_UNIT_HASHES, plain), len(_UNIT_HASHES) - 1)
    unit = after & (_UNIT_HASHES[at] == plain)
    lead = w.raw[w.starts]
    second = w.raw[np.minimum(w.starts + 1, max(len(w.raw) - 1, 0))] if n else lead
    capital = ((lead >= 65) & (lead <= 90)) | ((lead == 0xC3) & (second >= 0x80) & (second <= 0x9E))
    capital &= ~number & ~unit
    stops = np.concatenate([[0], np.cumsum(_STOP[w.raw])])
    before = np.concatenate([[0], w.ends[:-1]]) if n else w.ends
    opens = first_of_row | (stops[w.starts] > stops[before])
    words = np.where(number, _NUM, np.where(unit, _UNIT, plain))
    keep = ~(number & after)
    values = plain.copy()
    if not keep.all():  # the parts of a run of numbers are one value
        group = np.cumsum(keep) - 1
        values = np.zeros(int(keep.sum()), np.uint64)
        np.add.at(values, group, textops.mixed(plain + np.arange(n, dtype=np.uint64) - np.flatnonzero(keep)[group].astype(np.uint64)))
        values = np.where((number | unit)[keep], values, plain[keep])
    first = np.concatenate([[0], np.cumsum(keep)])[w.first]
    return words[keep], values, capital[keep], opens[keep], first


def _read(words: np.ndarray, values: np.ndarray, name: np.ndarray | bool):
    """(hash, counted) of each window with the words of ``name`` as names; counted if enough of it is plain."""
    slots = (words != values) | name
    h = textops.grams(np.where(name, _NAME, words), WINDOW)
    plain = np.concatenate([[0], np.cumsum(~slots)])
    return h, plain[WINDOW:][: len(h)] - plain[: len(h)] >= PLAIN_WINDOW


def _inside(first: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, whole): the row of each of n windows and whether it ends in that row."""
    row = np.searchsorted(first, np.arange(n), "right") - 1
    return row, np.arange(n) + WINDOW <= first[np.minimum(row + 1, len(first) - 1)]


def _emitted(ids, row, position, h, at, values):
    """Rows (id, pos, h, words): words are the given words of the window."""
    own = values[at[:, None] + np.arange(WINDOW)]
    return [ids.take(pa.array(row)), pa.array(position.astype(np.int32)), pa.array(signed(h)), lists([signed(x) for x in own], pa.int64())]


_HITS = "id long, pos int, h long, words array<long>"


def benchmark_windows(items: DataFrame) -> DataFrame:
    """(id, pos, h, words, n, slots): all windows of all items in all readings, n being the number of the item's words.

    Bit k of slots tells whether word k of the window is a number, a unit or a name inside a sentence.
    """

    def run(batches):
        for b in batches:
            ids = b.column(0)
            for w in textops.words(b.column(1), _WORD):
                words, values, capital, opens, first = canonical(w)
                if len(words) < WINDOW:
                    continue
                row, whole = _inside(first, len(words) - WINDOW + 1)
                found = [(textops.grams(values, WINDOW) ^ _SALT, whole)]
                bits = 1 << np.arange(WINDOW)
                seen = np.lib.stride_tricks.sliding_window_view(capital, WINDOW) @ bits
                slots = np.lib.stride_tricks.sliding_window_view((words != values) | (capital & ~opens), WINDOW) @ bits
                for mask in range(1 << WINDOW):  # the places of a window that are read as names, if they are capitals there
                    if not (fits := whole & (seen & mask == mask)).any():
                        continue
                    windows = np.flatnonzero(fits)
                    at = windows[:, None] + np.arange(WINDOW)
                    name = (mask >> np.arange(WINDOW) & 1).astype(bool)[None, :]
                    plain = ((words[at] == values[at]) & ~name).sum(axis=1) >= PLAIN_WINDOW
                    flat = np.where(name, _NAME, words[at]).ravel()
                    h = np.zeros(len(words) - WINDOW + 1, np.uint64)
                    h[windows] = textops.grams(flat, WINDOW)[::WINDOW]
                    ok = np.zeros(len(h), bool)
                    ok[windows[plain]] = True
                    found.append((h, ok))
                for h, ok in found:
                    at = np.flatnonzero(ok)
                    if len(at):
                        columns = _emitted(ids, w.row0 + row[at], at - first[row[at]], h[at], at, values)
                        count = np.diff(first)[row[at]].astype(np.int32)
                        yield pa.RecordBatch.from_arrays([*columns, pa.array(count), pa.array(slots[at].astype(np.int32))], ["id", "pos", "h", "words", "n", "slots"])

    return items.select("id", "text").where("id is not null").mapInArrow(textops.tidy(run), _HITS + ", n int, slots int")


def bit_filter(hashes: DataFrame) -> np.ndarray:
    """FILTER_BITS bits, set where a hash of ``hashes(h)`` falls. At most FILTER_BITS / 64 numbers reach the driver."""
    bit = F.pmod(F.col("h"), F.lit(FILTER_BITS))
    rows = hashes.select(F.floor(bit / 64).cast("int").alias("word"), F.expr(f"shiftleft(1L, cast(pmod(pmod(h, {FILTER_BITS}), 64) as int))").alias("one"))
    found = rows.groupBy("word").agg(F.bit_or("one").alias("bits")).toPandas()
    out = np.zeros(FILTER_BITS // 64, np.int64)
    out[found["word"].to_numpy()] = found["bits"].to_numpy()
    return np.unpackbits(out.view(np.uint8), bitorder="little").view(bool) if len(found) else np.zeros(FILTER_BITS, bool)


def document_hits(docs: DataFrame, shared) -> DataFrame:
    """(id, pos, h, words) of the documents' windows that pass the filter."""

    def run(batches):
        bits = np.unpackbits(np.frombuffer(shared.value, np.uint8)).view(bool)
        for b in batches:
            ids = b.column(0)
            for w in textops.words(b.column(1), _WORD):
                words, values, capital, opens, first = canonical(w)
                if len(words) < WINDOW:
                    continue
                row, whole = _inside(first, len(words) - WINDOW + 1)
                readings = [_read(words, values, name) for name in (capital, capital & ~opens, np.zeros(len(words), bool))]
                readings.append((textops.grams(values, WINDOW) ^ _SALT, whole))
                for k, (h, ok) in enumerate(readings):
                    ok = ok & whole & bits[(h % np.uint64(FILTER_BITS)).astype(np.int64)]
                    for other, _ in readings[:k]:
                        ok &= h != other
                    at = np.flatnonzero(ok)
                    if len(at):
                        yield pa.RecordBatch.from_arrays(_emitted(ids, w.row0 + row[at], at - first[row[at]], h[at], at, values), ["id", "pos", "h", "words"])

    return docs.select("id", "text").where("id is not null").mapInArrow(textops.tidy(run), _HITS)


def one_to_one(pairs: np.ndarray) -> bool:
    n = len(np.unique(pairs, axis=0))
    return n == len(np.unique(pairs[:, 0])) == len(np.unique(pairs[:, 1]))


def matched(diagonals: np.ndarray, at: np.ndarray, theirs: np.ndarray, own: np.ndarray, slots: np.ndarray, n: int) -> tuple[int, bool] | None:
    """(words of an item of n words that consistent windows hold, whether all are its own), if these are enough.

    Window i stands at at[i] in the item and diagonals[i] further on in the document; theirs[i] and own[i] are its words there,
    and slots[i] tells which are numbers, units or names.
    """
    best = None
    need = max(COVERED * n, min(n, LEAST))
    order = np.lexsort((at, diagonals))
    diagonals, at, theirs, own, slots = diagonals[order], at[order], theirs[order], own[order], slots[order]
    if len(at) * WINDOW < need:
        return None
    edges = [0, *(np.flatnonzero(np.diff(diagonals)) + 1), len(at)]
    sound = np.ones(len(at), bool)
    for x, y in zip(edges, edges[1:]):
        if slots[x:y].any():
            sound[x:y] = one_to_one(np.stack([theirs[x:y][slots[x:y]], own[x:y][slots[x:y]]], axis=1))
    diagonals, at, theirs, own, slots = diagonals[sound], at[sound], theirs[sound], own[sound], slots[sound]
    if not len(at):
        return None
    places = np.flatnonzero(np.concatenate([[True], np.diff(diagonals) > 0]))
    ends = np.searchsorted(diagonals, diagonals[places] + SHIFT, "right")
    for x, y in zip(places, ends, strict=True):
        held = np.zeros(n, bool)
        held[(at[x:y, None] + np.arange(WINDOW)).ravel()] = True
        if held.sum() < need:
            continue
        pairs, inverse, votes = np.unique(np.stack([theirs[x:y].ravel(), own[x:y].ravel()], axis=1), axis=0, return_inverse=True, return_counts=True)
        given, taken, good = set(), set(), np.zeros(len(pairs), bool)
        for k in sorted(range(len(pairs)), key=lambda k: (-votes[k], pairs[k, 0] != pairs[k, 1], k)):
            i, d = pairs[k].tolist()
            if i not in given and d not in taken:
                given.add(i)
                taken.add(d)
                good[k] = True
        ok = good[inverse.reshape(y - x, WINDOW)].all(axis=1)
        where = at[x:y][ok, None] + np.arange(WINDOW)
        held[:] = False
        held[where.ravel()] = True
        equal = np.zeros(n, bool)
        same = theirs[x:y][ok] == own[x:y][ok]
        equal[where[same & ~slots[x:y][ok]]] = True
        if held.sum() >= need and (equal.sum() >= PLAIN or (same.all() and held.sum() >= min(n, EXACT))):
            found = (int(held.sum()), bool(same.all()))
            best = max(best, found) if best else found
            if best == (n, True):
                return best
    return best


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", item_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(doc_id, item_id, n_hits, n_windows, same_values): the documents that hold an item, and how much of it.

    n_hits is the number of the item's words that are held and n_windows that of all its words; same_values tells whether all
    of them have the item's own values.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "templates")
    docs = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    items = benchmark.select(F.col(item_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    known = scratch.write(benchmark_windows(items).distinct(), "benchmark")
    shared = spark.sparkContext.broadcast(np.packbits(bit_filter(known.select("h"))).tobytes())
    hits = scratch.write(document_hits(docs, shared), "hits")

    theirs = known.select(F.col("id").alias("item"), F.col("pos").alias("ipos"), "h", F.col("words").alias("iwords"), "n", "slots")
    both = hits.join(theirs, "h").select("id", "item", "n", F.struct((F.col("pos") - F.col("ipos")).alias("diagonal"), "ipos", "iwords", "words", "slots").alias("hit"))
    # an item's hits in one document; too few windows for the words needed are told before they are gathered
    per_item = both.groupBy("id", "item").agg(F.max("n").alias("n"), F.collect_set("hit").alias("hits"))
    enough = per_item.where((F.size("hits") * WINDOW >= COVERED * F.col("n")) & (F.size("hits") * WINDOW >= F.least("n", F.lit(LEAST))))

    def run(batches):
        for batch in batches:
            out = []
            sizes = batch.column(2).to_pylist()
            for k, (doc, item) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)):
                h = batch.column(3)[k].values
                iwords, words = (h.field(f).flatten().to_numpy().reshape(-1, WINDOW) for f in ("iwords", "words"))
                found = matched(h.field("diagonal").to_numpy().astype(np.int64), h.field("ipos").to_numpy(), iwords, words, (h.field("slots").to_numpy()[:, None] >> np.arange(WINDOW) & 1).astype(bool), sizes[k])
                if found:
                    out.append((doc, item, found[0], sizes[k], found[1]))
            yield pa.RecordBatch.from_arrays([pa.array([o[k] for o in out], t) for k, t in enumerate([pa.int64()] * 4 + [pa.bool_()])], [id_col, item_col, "n_hits", "n_windows", "same_values"])

    return enough.mapInArrow(textops.tidy(run), f"`{id_col}` long, `{item_col}` long, n_hits long, n_windows long, same_values boolean")
