"""Runs of rows in levels of size, merged as they grow: what a stream leaves behind, for readers that come at any time.

Each batch adds one run. Runs of about the same size, four to a level, are merged into one, so the runs that are live, and
with them the files that a reader opens, number about the logarithm of the rows, however many batches there were.
A manifest names the live runs and the last batch of each writer: a batch that is replayed finds itself done, a run that was written
but never named is no part of any reading, and old runs stay until ``expire``, so that readers that began earlier can end.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from millrace.sources.manifests import Manifests

#: Runs of one level that are merged into one; each level holds runs this many times as large.
FAN = 4
DAY = 86_400


def level_of(rows: int) -> int:
    level = 0
    while rows >= FAN:
        rows, level = rows // FAN, level + 1
    return level


class Levels:
    """The runs under a folder; ``merge`` reduces the rows of several runs to those that count."""

    def __init__(self, spark: SparkSession, folder: str, schema: T.StructType, merge: Callable[[DataFrame], DataFrame]):
        self.spark, self.folder, self.schema, self.merge = spark, folder, schema, merge
        self.manifests = Manifests(spark, folder)

    def state(self) -> dict:
        return {"runs": [], "writers": {}} | self.manifests.latest()[1]

    def has(self, writer: str, batch: int) -> bool:
        return self.state()["writers"].get(writer, -1) >= batch

    def append(self, rows: DataFrame, writer: str, batch: int) -> None:
        """Add a batch as one run, unless it is there already, then merge what has become too many."""
        if self.has(writer, batch):
            return
        self.commit(writer, batch, self.write(rows.select(*self.schema.names)))
        self.compact()

    def write(self, rows: DataFrame) -> dict:
        """A run that no manifest names yet."""
        path = f"runs/{uuid.uuid4().hex}"
        rows.write.parquet(f"{self.folder}/{path}")
        return {"path": path, "rows": self.open([path]).count()}

    def commit(self, writer: str, batch: int, run: dict, **more) -> dict:
        def change(state: dict) -> dict | None:
            state = {"runs": [], "writers": {}} | state
            if state["writers"].get(writer, -1) >= batch:
                return None
            runs = [*state["runs"], run] if run["rows"] else state["runs"]
            return state | {"runs": runs, "writers": state["writers"] | {writer: batch}} | more

        return self.manifests.update(change)

    def compact(self) -> None:
        while (some := self._crowded()) is not None:
            merged = self.write(self.merge(self.open([r["path"] for r in some])).select(*self.schema.names))
            self.manifests.update(lambda state: self._replaced(state, some, merged))

    def _crowded(self) -> list[dict] | None:
        by: dict[int, list[dict]] = {}
        for run in self.state()["runs"]:
            by.setdefault(level_of(run["rows"]), []).append(run)
        return next((by[k] for k in sorted(by) if len(by[k]) >= FAN), None)

    @staticmethod
    def _replaced(state: dict, old: list[dict], new: dict) -> dict | None:
        gone = {r["path"] for r in old}
        if not gone <= {r["path"] for r in state["runs"]}:
            return None  # another writer merged some of them
        return state | {"runs": [r for r in state["runs"] if r["path"] not in gone] + [new]}

    def open(self, paths: list[str]) -> DataFrame:
        reader = self.spark.read.schema(self.schema)
        return reader.parquet(*[f"{self.folder}/{p}" for p in paths]) if paths else self.spark.createDataFrame([], self.schema)

    def read(self) -> DataFrame:
        """The rows of all live runs, not merged among each other."""
        return self.open([r["path"] for r in self.state()["runs"]])

    def expire(self, seconds: float = 7 * DAY) -> None:
        """Remove what readers that began in the last ``seconds`` cannot be reading: runs that only older versions name,
        those versions, and runs of that age that no version names."""
        versions = self.manifests.versions()
        folders = {v: {"/".join(p.split("/")[:2]) for p in self._named(self.manifests.read(v))} for v in versions}
        # a version is read until a while after the next one has come
        kept = [v for v, after in zip(versions, [*versions[1:], None], strict=True) if after is None or self.manifests.age(after) < seconds]
        live = {f for v in kept for f in folders[v]}
        named = {f for v in versions for f in folders[v]}
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(f"{self.folder}/runs")
        files = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        now = jvm.java.lang.System.currentTimeMillis()
        for found in files.listStatus(path) if files.exists(path) else ():
            name = f"runs/{found.getPath().getName()}"
            if name not in live and (name in named or now - found.getModificationTime() >= seconds * 1000):
                files.delete(found.getPath(), True)
        self.manifests.forget(kept[0] if kept else 0)

    @staticmethod
    def _named(state: dict) -> list[str]:
        return [r["path"] for r in state.get("runs", [])] + ([state["open"]] if state.get("open") else [])
