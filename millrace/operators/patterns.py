"""Row patterns with alternatives, options and counts, matched along the order of a key by an automaton.

A pattern such as ``signup (view | click){1,3} purchase? error*`` has one position for each value in it, and a state is the set of
positions at which a match may stand (a position automaton: no empty steps). Along with each position goes the earliest row
with which such a match began.

What a stretch of rows does to a state is known without knowing the state: for each position, the positions it leads to, and the
matches that begin inside. These effects compose, so a key that is too large for one task is cut into ordered buckets, each bucket
is reduced to its effect, the effects are composed along the key, and each bucket is then matched from the state in which it
begins. The state of a pattern is as small as the pattern.
"""

from __future__ import annotations

import pickle
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from millrace.functions.ordered import HOT_ROWS, Hot, bucketed, hot_keys
from millrace.sources.scratch import Scratch

_TOKEN = re.compile(r"\s*(?:([A-Za-z_][\w.:-]*)|([()|?*+])|\{(\d+)(,)?(\d*)\})")


class Pattern:
    """The positions of a pattern: where matches begin and end, and what may follow each."""

    def __init__(self, text: str):
        self.symbols: list[str] = []
        self.follow: list[set[int]] = []
        self._text, self._at = text, 0
        node = self._either()
        if self._peek() or not node:
            raise ValueError(f"not a pattern from {self._at}: {text}")
        _, self.first, self.last = self._placed(node)
        self.alphabet = sorted(set(self.symbols))
        number = {s: i for i, s in enumerate(self.alphabet)}
        #: for each value the positions it may take, each with the positions before it
        self.before: list[list[tuple[int, list[int], bool]]] = [[] for _ in self.alphabet]
        for q, s in enumerate(self.symbols):
            self.before[number[s]].append((q, [p for p in range(len(self.symbols)) if q in self.follow[p]], q in self.first))

    # reading: alternatives of sequences of values with quantifiers

    def _peek(self) -> re.Match | None:
        m = _TOKEN.match(self._text, self._at)
        if m is None and self._text[self._at :].strip():
            raise ValueError(f"not a pattern from {self._at}: {self._text}")
        return m

    def _either(self) -> tuple:
        options = [self._sequence()]
        while (m := self._peek()) and m[2] == "|":
            self._at = m.end()
            options.append(self._sequence())
        return options[0] if len(options) == 1 else ("or", options)

    def _sequence(self) -> tuple:
        parts = []
        while (m := self._peek()) and (m[1] or m[2] == "("):
            self._at = m.end()
            if m[1]:
                node = ("value", m[1])
            else:
                node = self._either()
                if not ((m := self._peek()) and m[2] == ")"):
                    raise ValueError(f"an open bracket: {self._text}")
                self._at = m.end()
            while (m := self._peek()) and (m[3] or m[2] in ("?", "*", "+")):
                self._at = m.end()
                least, most = {"?": (0, 1), "*": (0, None), "+": (1, None)}.get(m[2]) or (int(m[3]), (int(m[5]) if m[5] else None) if m[4] else int(m[3]))
                if most is not None and (most < least or most == 0):
                    raise ValueError(f"a count that nothing meets: {self._text}")
                node = ("times", node, least, most)
            parts.append(node)
        if not parts:
            raise ValueError(f"an empty part at {self._at}: {self._text}")
        return parts[0] if len(parts) == 1 else ("then", parts)

    # placing: (may be empty, positions it begins with, positions it ends with)

    def _placed(self, node: tuple) -> tuple[bool, set[int], set[int]]:
        if node[0] == "value":
            self.symbols.append(node[1])
            self.follow.append(set())
            own = {len(self.symbols) - 1}
            return False, own, set(own)
        if node[0] == "or":
            parts = [self._placed(n) for n in node[1]]
            return any(e for e, _, _ in parts), set().union(*[f for _, f, _ in parts]), set().union(*[z for _, _, z in parts])
        if node[0] == "then":
            return self._chained([self._placed(n) for n in node[1]])
        _, inner, least, most = node
        parts = [self._placed(inner) for _ in range(max(least, 1) if most is None else most)]
        if most is None:
            _, first, last = parts[-1]
            self._link(last, first)
        return self._chained([(e or i >= least, f, z) for i, (e, f, z) in enumerate(parts)])

    def _chained(self, parts: list) -> tuple[bool, set[int], set[int]]:
        empty, first, last = parts[0]
        first, last = set(first), set(last)
        for e, f, z in parts[1:]:
            self._link(last, f)
            first |= f if empty else set()
            last = z | (last if e else set())
            empty = empty and e
        return empty, first, last

    def _link(self, last: set[int], first: set[int]) -> None:
        for p in last:
            self.follow[p] |= first

    # matching

    def step(self, state: dict, symbol: int, here: tuple) -> dict:
        """The state after one more row; ``here`` stands for that row if a match begins with it."""
        new = {}
        for q, before, begins in self.before[symbol] if symbol >= 0 else ():
            starts = [state[p] for p in before if p in state]
            if begins:
                starts.append(here)
            if starts:
                new[q] = min(starts, key=lambda s: s[:2])
        return new

    def found(self, state: dict) -> tuple | None:
        """The earliest row with which a match began that ends here."""
        return min((s for q, s in state.items() if q in self.last), key=lambda s: s[:2], default=None)

    def moved(self, places: frozenset[int], symbol: int) -> frozenset[int]:
        return frozenset(q for q, before, _ in self.before[symbol] if not places.isdisjoint(before)) if symbol >= 0 else frozenset()


def matches(df: DataFrame, keys: list[str], ts: str, tie: str, column: str, pattern: str, hot_rows: int = HOT_ROWS, hot: Hot | None = None) -> DataFrame:
    """(keys, match_start, first_row, match_end, last_row): for every row with which a match ends, the longest that does.

    Matches are runs of consecutive rows of a key, in the order of ``ts`` and ``tie``, and hold at least one row. Values that
    are not in the pattern, and nulls, end every match. Rows that agree in order and tie have no order among themselves.
    """
    pat = Pattern(pattern)
    hot = hot or hot_keys(df, keys, hot_rows)
    value = F.coalesce(F.array_position(F.array(*[F.lit(s) for s in pat.alphabet]), F.col(column).cast("string")) - 1, F.lit(-1)).cast("int")
    rows = df.select(*keys, ts, tie, value.alias("__symbol"))
    none = F.lit(None).cast("binary").alias("__state")
    if hot.keys is None:
        rows = rows.withColumns({"__bucket": F.lit(0), "__same": F.lit(0).cast("long")}).select("*", none)
    else:
        rows = Scratch(df.sparkSession, "patterns").write(bucketed(rows, keys, hot, ts, tie).select("*", none), "rows")
        rows = rows.unionByName(_begun(rows, keys, ts, tie, pat), allowMissingColumns=True)
    kinds = {f.name: f.dataType for f in df.schema.fields}
    shape = T.StructType([*[T.StructField(k, kinds[k]) for k in keys], T.StructField("match_start", kinds[ts]), T.StructField("first_row", kinds[tie]), T.StructField("match_end", kinds[ts]), T.StructField("last_row", kinds[tie])])
    n = len(keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, state, count = None, {}, 0
        for b in batches:
            columns = [b.column(i).to_pylist() for i in range(b.num_columns)]
            at, out = [], []
            times, ties, symbols, buckets, states = columns[n : n + 5]
            for i in range(b.num_rows):
                own = (*[c[i] for c in columns[:n]], buckets[i])
                if own != group:
                    group, state, count = own, {}, 0
                if states[i] is not None:
                    state = pickle.loads(states[i])
                    continue
                state = pat.step(state, symbols[i], (buckets[i], count, times[i], ties[i])) if symbols[i] >= 0 else {}
                count += 1
                if state and (start := pat.found(state)):
                    at.append(i)
                    out.append(start)
            if at:
                picked = b.take(pa.array(at))
                starts = [pa.array([s[k] for s in out], picked.schema.field(n + k - 2).type) for k in (2, 3)]
                yield pa.RecordBatch.from_arrays([*picked.columns[:n], *starts, picked.column(n), picked.column(n + 1)], [*keys, "match_start", "first_row", "match_end", "last_row"])

    placed = rows.select(*keys, ts, tie, "__symbol", "__bucket", "__state", "__same").repartition(*keys, "__bucket")
    return placed.sortWithinPartitions(*keys, "__bucket", F.col("__state").isNull(), ts, tie, "__same").mapInArrow(run, shape)


def _begun(rows: DataFrame, keys: list[str], ts: str, tie: str, pat: Pattern) -> DataFrame:
    """(keys, __bucket, __state): the state in which each bucket but the first of a key begins."""
    n = len(keys)
    kinds = {f.name: f.dataType for f in rows.schema.fields}
    own = [T.StructField(k, kinds[k]) for k in keys]
    effect_shape = T.StructType([*own, T.StructField("__bucket", T.IntegerType()), T.StructField("effect", T.BinaryType())])
    state_shape = T.StructType([*own, T.StructField("__bucket", T.IntegerType()), T.StructField("__state", T.BinaryType())])

    def effects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, state, count, reach, moves = None, {}, 0, {}, {}
        done = []

        def record():
            if group is not None:
                done.append((*group, pickle.dumps(({p: sorted(q) for p, q in reach.items()}, state))))

        for b in batches:
            columns = [b.column(i).to_pylist() for i in range(b.num_columns)]
            times, ties, symbols, buckets = columns[n : n + 4]
            for i in range(b.num_rows):
                now = (*[c[i] for c in columns[:n]], buckets[i])
                if now != group:
                    record()
                    group, state, count = now, {}, 0
                    reach = {p: frozenset([p]) for p in range(len(pat.symbols))}
                symbol = symbols[i]
                state = pat.step(state, symbol, (buckets[i], count, times[i], ties[i]))
                count += 1
                if reach:
                    new = {}
                    for p, places in reach.items():
                        key = (places, symbol)
                        if key not in moves:
                            moves[key] = pat.moved(places, symbol)
                        if moves[key]:
                            new[p] = moves[key]
                    reach = new
            if len(done) > 1000:
                yield _batch(done, effect_shape)
                done.clear()
        record()
        if done:
            yield _batch(done, effect_shape)

    def composed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, state, done = None, {}, []
        for b in batches:
            columns = [b.column(i).to_pylist() for i in range(b.num_columns)]
            for i in range(b.num_rows):
                now = tuple(c[i] for c in columns[:n])
                if now != group:
                    group, state = now, {}
                elif state:
                    done.append((*now, columns[n][i], pickle.dumps(state)))
                reach, inside = pickle.loads(columns[n + 1][i])
                new = dict(inside)
                for p, start in state.items():
                    for q in reach.get(p, ()):
                        if q not in new or start[:2] < new[q][:2]:
                            new[q] = start
                state = new
        if done:
            yield _batch(done, state_shape)

    in_order = rows.select(*keys, ts, tie, "__symbol", F.col("__bucket").cast("int").alias("__bucket"), "__same").repartition(*keys, "__bucket")
    found = in_order.sortWithinPartitions(*keys, "__bucket", ts, tie, "__same").mapInArrow(effects, effect_shape)
    # one row for each bucket of a key
    return found.repartition(*keys).sortWithinPartitions(*keys, "__bucket").mapInArrow(composed, state_shape)


def _batch(rows: list[tuple], shape: T.StructType) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], to_arrow_type(f.dataType)) for i, f in enumerate(shape.fields)], shape.names)
