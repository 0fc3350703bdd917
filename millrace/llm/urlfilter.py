r"""URL filtering by rules, and by a classifier where no rule fits.

A rule names a host (with all its subdomains) and the beginning of a path; the longest fitting one decides. Other URLs are
judged by logistic regression on hashed character n-grams (3 to 5 characters, the ends marked) of host and path, learned
from a small table of labelled URLs. Without such a table, the URLs that rules decide are its source: at most
``SAMPLE`` different ones of each verdict, chosen by a hash of the URL.

Defined cases: a null URL or one without ``://`` has empty host and path and fits no rule; the classifier then sees
the marks alone. With labels of one verdict only that verdict is given; with none at all the verdict is allow. Rows may
repeat; other columns are kept, but for those of the outputs' names, which are replaced.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

SAMPLE = 2000
SLOTS = 1 << 16
STEPS = 150
RIDGE = 1e-3

#: The rules of the query.
RULES = (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/"))

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def parts(pages: DataFrame, url: str = "url") -> DataFrame:
    """``pages`` with host and path."""
    taken = [c for c in pages.columns if c.lower() not in ("host", "path")]
    given = F.col(url)
    # (?s) as a URL may hold line breaks; the first :// counts
    pieces = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    host = F.translate(F.coalesce(F.regexp_extract(given, pieces, 1), F.lit("")), _UPPER, _LOWER)
    return pages.select(*taken, host.alias("host"), F.coalesce(F.regexp_extract(given, pieces, 2), F.lit("")).alias("path"))


def rule_for(rules: tuple[tuple[str, str], ...]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits host and path; nulls if none does. Of equal rules the first counts."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, name in sorted(reversed(rules), key=lambda r: len(r[1])):
        host, start = name.split("/", 1)
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith("/" + start)
        rule, verdict = F.when(fits, name).otherwise(rule), F.when(fits, kind).otherwise(verdict)
    return rule, verdict


def slots(host: str, path: str) -> np.ndarray:
    """The distinct slots of the n-grams of a URL."""
    out = set()
    for mark, text in (("h", f"^{host}$"), ("p", f"^{path}$")):
        for n in (3, 4, 5):
            out.update(zlib.crc32(f"{mark}{text[i : i + n]}".encode("utf-8", "replace")) % SLOTS for i in range(max(1, len(text) - n + 1)))
    return np.fromiter(out, np.int64, len(out))


def features(hosts: list[str], paths: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, slot, weight): each row's slots weigh 1 / root of their number."""
    own = [slots(h, p) for h, p in zip(hosts, paths, strict=True)]
    sizes = np.array([len(x) for x in own], np.int64)
    flat = np.concatenate(own) if own else np.zeros(0, np.int64)
    return np.repeat(np.arange(len(own)), sizes), flat, np.repeat(1 / np.sqrt(np.maximum(sizes, 1)), sizes)


@dataclass
class Model:
    weights: np.ndarray
    bias: float

    def block(self, hosts: list[str], paths: list[str]) -> np.ndarray:
        """The probability of block."""
        row, slot, value = features(hosts, paths)
        z = np.bincount(row, self.weights[slot] * value, minlength=len(hosts)) + self.bias
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fitted(hosts: list[str], paths: list[str], blocked: np.ndarray) -> Model:
    """Logistic regression by accelerated gradient steps; both verdicts weigh alike."""
    weights = np.zeros(SLOTS)
    n_block = int(blocked.sum())
    if n_block in (0, len(blocked)):
        return Model(weights, 30.0 if n_block else -30.0)
    row, slot, value = features(hosts, paths)
    share = np.where(blocked, 0.5 / n_block, 0.5 / (len(blocked) - n_block))
    bias, look, look_bias, rate = 0.0, weights, 0.0, 4.0
    for step in range(1, STEPS + 1):
        z = np.bincount(row, look[slot] * value, minlength=len(blocked)) + look_bias
        error = (1 / (1 + np.exp(-z)) - blocked) * share
        new = look - rate * (np.bincount(slot, error[row] * value, minlength=SLOTS) + RIDGE * look)
        new_bias = look_bias - rate * float(error.sum())
        push = (step - 1) / (step + 2)
        look, look_bias = new + push * (new - weights), new_bias + push * (new_bias - bias)
        weights, bias = new, new_bias
    return Model(weights, bias)


def train(labelled: DataFrame, url: str = "url", verdict: str = "verdict", sample: int = SAMPLE) -> Model:
    """Learn from labelled(url, verdict); verdicts other than allow and block are not read."""
    rows = parts(labelled.select(F.col(url).alias("url"), F.col(verdict).alias("verdict"))).select("host", "path", "verdict")
    rows = rows.where(F.col("verdict").isin("allow", "block"))
    place = F.xxhash64("host", "path")
    found = [rows.where(F.col("verdict") == v).groupBy("host", "path").agg(F.lit(v).alias("verdict")).orderBy(place, "host", "path").limit(sample).toPandas() for v in ("allow", "block")]
    hosts, paths = [h for f in found for h in f["host"]], [p for f in found for p in f["path"]]
    return fitted(hosts, paths, np.concatenate([np.zeros(len(found[0]), bool), np.ones(len(found[1]), bool)]))


def judge(pages: DataFrame, url: str = "url", rules=RULES, labelled: DataFrame | None = None) -> DataFrame:
    """``pages`` with host, path, rule, verdict and p_block (the classifier's probability; null where a rule decides)."""
    rule, verdict = rule_for(rules)
    named = [c for c in pages.columns if c.lower() not in ("host", "path", "rule", "verdict", "p_block")]
    ruled = parts(pages.select(*named), url).withColumns({"rule": rule, "verdict": verdict})
    model = train(ruled.where("verdict is not null") if labelled is None else labelled, url)
    shared = pages.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for b in batches:
            names = b.schema.names
            given = b.column(names.index("verdict")).to_pylist()
            open_ = [i for i, v in enumerate(given) if v is None]
            hosts, paths = b.column(names.index("host")).to_pylist(), b.column(names.index("path")).to_pylist()
            p = shared.value.block([hosts[i] for i in open_], [paths[i] for i in open_])
            chance: list[float | None] = [None] * len(given)
            for i, x in zip(open_, p.tolist(), strict=True):
                chance[i], given[i] = x, "block" if x >= 0.5 else "allow"
            arrays = [c if n != "verdict" else pa.array(given, pa.string()) for n, c in zip(names, b.columns, strict=True)]
            yield pa.RecordBatch.from_arrays([*arrays, pa.array(chance, pa.float64())], [*names, "p_block"])

    return ruled.mapInArrow(run, T.StructType([*ruled.schema.fields, T.StructField("p_block", T.DoubleType())]))
