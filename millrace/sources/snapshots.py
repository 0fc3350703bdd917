"""Versioned snapshots: readers see a whole generation or the one before it, whoever publishes at the same time."""

from __future__ import annotations

import uuid
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.sources.manifests import Conflict, Manifests

META = "number long, version string, total_items long, order_by string, detail boolean, cached_at timestamp_ntz"
DAY = 86_400


def publish_snapshot(
    df: DataFrame, path: str, cached_at: datetime, order_by: str = "id", detail: bool = True, after: int | None = None
) -> str:
    """Write the items of a new generation, then name them in the next manifest.

    The manifest is what makes a generation visible: a failure half way leaves the earlier ones in place, and of two publishers
    at once each gives a whole generation, numbered in the order in which they were named. A publisher whose items follow from a
    generation it has read passes that one's number as ``after`` (-1 for none): if another has come since, its own is not
    named, its items go, and it gets a ``Conflict``.
    """
    spark = df.sparkSession
    version = uuid.uuid4().hex
    items = f"{path}/items/{version}"
    df.write.parquet(items)
    total = spark.read.schema(df.schema).parquet(items).count()
    row = {"version": version, "total_items": total, "order_by": order_by, "detail": detail, "cached_at": cached_at.isoformat()}

    def named(state: dict) -> dict:
        number = state.get("number", -1)
        if after is not None and after != number:
            raise Conflict(f"generation {number} has come after {after}")
        return state | {"number": number + 1, "generations": [*state.get("generations", []), row | {"number": number + 1}]}

    try:
        Manifests(spark, path).update(named)
    except Conflict:
        _remove(spark, items)
        raise
    return version


def generations(spark: SparkSession, path: str) -> list[dict]:
    """What the newest manifest says of every generation that is kept, oldest first."""
    found = Manifests(spark, path).latest()[1].get("generations", [])
    return [g | {"cached_at": datetime.fromisoformat(g["cached_at"])} for g in found]


def snapshot_meta(spark: SparkSession, path: str) -> DataFrame:
    """The generations as rows."""
    names = [c.split()[0] for c in META.split(", ")]
    return spark.createDataFrame([tuple(g[n] for n in names) for g in generations(spark, path)], META)


def load_snapshot(
    spark: SparkSession,
    path: str,
    as_of: datetime,
    ttl_seconds: float,
    require_detail: bool = True,
) -> DataFrame | None:
    """The newest generation that is still fresh at ``as_of``, else None; of equal times the one named last."""
    oldest = as_of - timedelta(seconds=ttl_seconds)
    fresh = [g for g in generations(spark, path) if g["cached_at"] >= oldest and (g["detail"] or not require_detail)]
    newest = max(fresh, key=lambda g: (g["cached_at"], g["number"]), default=None)
    return None if newest is None else spark.read.parquet(f"{path}/items/{newest['version']}")


def expire_snapshots(spark: SparkSession, path: str, before: datetime, spare_seconds: float = DAY) -> None:
    """Stop naming generations from before a time, but for the newest of each kind, and remove what nobody can be reading.

    The items of a generation stay for ``spare_seconds`` after it was last named, so that readers that began earlier
    can end. Items that were never named go after that time too.
    """
    log = Manifests(spark, path)

    def fewer(state: dict) -> dict | None:
        all_ = state.get("generations", [])
        last = {g["detail"]: g["number"] for g in sorted(all_, key=lambda g: (g["cached_at"], g["number"]))}
        kept = [g for g in all_ if datetime.fromisoformat(g["cached_at"]) >= before or last[g["detail"]] == g["number"]]
        return None if len(kept) == len(all_) else state | {"generations": kept}

    log.update(fewer)
    versions = log.versions()
    spared = [v for v, then in zip(versions, [*versions[1:], None], strict=True) if then is None or log.age(then) < spare_seconds]
    live = {g["version"] for v in spared for g in log.read(v).get("generations", [])}
    named = {g["version"] for v in versions for g in log.read(v).get("generations", [])}
    root = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/items")
    files = root.getFileSystem(spark._jsc.hadoopConfiguration())
    now = spark._jvm.java.lang.System.currentTimeMillis()
    for found in files.listStatus(root) if files.exists(root) else ():
        version = found.getPath().getName()
        if version not in live and (version in named or now - found.getModificationTime() >= spare_seconds * 1000):
            files.delete(found.getPath(), True)
    log.forget(spared[0] if spared else 0)


def _remove(spark: SparkSession, folder: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(folder)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
