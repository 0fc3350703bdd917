"""Continuous loads: incremental append, deferred merge, rolling aggregates, run status.

Every sink is idempotent per batch: a manifest names the last batch of each writer (its checkpoint folder), so a replay after
a failure adds nothing twice. Sinks that keep states merge their runs as they grow (``levels``).
"""

from __future__ import annotations

import uuid

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from millrace.operators.runs import KNOWN_STATUSES, TERMINAL
from millrace.operators.windows import latest_per_key
from millrace.streaming.levels import Levels

# Bounds of the wait for a run, in seconds.
WAIT_SECONDS, WAIT_LEAST, WAIT_MOST = 1800, 30, 3600


def file_stream(spark: SparkSession, folder: str, schema: T.StructType, pattern: str = "*.parquet", files_per_batch: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema).option("pathGlobFilter", pattern)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


def stream_incremental(stream: DataFrame, sink: str, checkpoint: str) -> StreamingQuery:
    """Append what is new since the last run, then stop."""
    return (
        stream.writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .option("path", sink)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )


def stream_deferred_merge(
    stream: DataFrame, target: str, keys: list[str], ts: str, tie: str | None, checkpoint: str
) -> StreamingQuery:
    """Each batch stores only its newest row per key; the merge with the target is deferred to reading.

    So a batch costs what it holds, and its share of merging runs of its own size: a row is rewritten about as often as
    the logarithm of the rows that came, whatever the size of the target.
    """

    levels = _merged(stream.sparkSession, target, stream.schema, keys, ts, tie)

    def store(batch: DataFrame, batch_id: int) -> None:
        levels.append(latest_per_key(batch, keys, ts, tie), checkpoint, batch_id)

    return stream.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def _merged(spark: SparkSession, target: str, schema: T.StructType, keys: list[str], ts: str, tie: str | None) -> Levels:
    return Levels(spark, target, schema, lambda rows: latest_per_key(rows, keys, ts, tie))


def read_merged(
    spark: SparkSession, target: str, schema: T.StructType, keys: list[str], ts: str, tie: str | None, base: DataFrame | None = None
) -> DataFrame:
    """Newest row per key over the base and all live runs."""
    rows = _merged(spark, target, schema, keys, ts, tie).read()
    if base is not None:
        rows = base.select(*schema.names).unionByName(rows)
    return latest_per_key(rows, keys, ts, tie)


def rolling_aggregate(
    stream: DataFrame, ts: str, keys: list[str], aggs: dict[str, str], length: str, slide: str | None = None, late: str = "1 hour"
) -> DataFrame:
    """Tumbling or sliding windows; rows later than the watermark are dropped.

    Works on a stream and, for a full rebuild, on a plain frame.
    """
    event_time = F.col(ts).cast("timestamp")
    marked = stream.withColumn("__ts", event_time).withWatermark("__ts", late)
    window = F.window("__ts", length, slide) if slide else F.window("__ts", length)
    out = marked.groupBy(window.alias("w"), *keys).agg(*[F.expr(e).alias(n) for n, e in aggs.items()])
    names = {"window_start": F.col("w.start").cast("timestamp_ntz"), "window_end": F.col("w.end").cast("timestamp_ntz")}
    return out.select(*[c.alias(n) for n, c in names.items()], *keys, *aggs)


def _windows(spark: SparkSession, sink: str, schema: T.StructType, keys: list[str]) -> Levels:
    full = T.StructType([*schema.fields, T.StructField("batch", T.LongType())])
    return Levels(spark, sink, full, lambda rows: latest_per_key(rows, ["window_start", *keys], "batch"))


def stream_rolling_aggregate(aggregate: DataFrame, sink: str, checkpoint: str, keys: list[str], late: str = "1 hour") -> StreamingQuery:
    """Update mode: each batch stores the windows it changed; ``read_rolling`` takes the newest state.

    Windows that may still change stay in one small table, rewritten by each batch. Those that ended ``late`` before the
    beginning of the newest window of earlier batches move to closed runs, which later batches do not touch. ``late`` should be that
    of the aggregate; if it is less, a window that changes after it was closed is stored again, and the newest state still counts.
    """
    spark = aggregate.sparkSession
    levels = _windows(spark, sink, aggregate.schema, keys)

    def store(batch: DataFrame, batch_id: int) -> None:
        if levels.has(checkpoint, batch_id):
            return
        state = levels.state()
        # batches are numbered on across writers, so that the newest state of a window is that stored last
        number = state.get("number", -1) + 1
        now = levels.open([state["open"]]) if state.get("open") else None
        new = batch.withColumn("batch", F.lit(number).cast("long")).select(*levels.schema.names)
        rows = latest_per_key(now.unionByName(new) if now is not None else new, ["window_start", *keys], "batch")
        until = F.expr(f"TIMESTAMP_NTZ '{state['newest']}' - INTERVAL {late}") if state.get("newest") else F.lit(None).cast("timestamp_ntz")
        path = f"runs/{uuid.uuid4().hex}"
        rows.withColumn("closed", F.coalesce(F.col("window_end") <= until, F.lit(False))).write.partitionBy("closed").parquet(f"{sink}/{path}")
        stored = spark.read.schema(T.StructType([*levels.schema.fields, T.StructField("closed", T.BooleanType())])).parquet(f"{sink}/{path}")
        n_open, n_closed, newest = stored.agg(F.count_if(~F.col("closed")), F.count_if("closed"), F.max("window_start").cast("string")).first()
        run = {"path": f"{path}/closed=true", "rows": n_closed}
        newest = max(x for x in (newest, state.get("newest"), "") if x is not None) or None
        levels.commit(checkpoint, batch_id, run, open=f"{path}/closed=false" if n_open else None, number=number, newest=newest)
        levels.compact()

    return (
        aggregate.writeStream.foreachBatch(store)
        .outputMode("update")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_rolling(spark: SparkSession, sink: str, schema: T.StructType, keys: list[str], closed: bool = True) -> DataFrame:
    """The newest state of every window; without ``closed`` only of those that may still change, from their one table."""
    levels = _windows(spark, sink, schema, keys)
    state = levels.state()
    paths = [r["path"] for r in state["runs"]] if closed else []
    return latest_per_key(levels.open([*paths, *([state["open"]] if state.get("open") else [])]), ["window_start", *keys], "batch").drop("batch")


#: States that all runs share, each with the runs of some ids.
GROUPS = 1024


def run_states(status_stream: DataFrame, timeout_seconds: int = WAIT_SECONDS, late: str = "1 hour") -> DataFrame:
    """States of runs as they change, from a stream of (run_id, ts, status): run_id, started, updated, status, terminal, timed_out.

    A run that has not ended when the watermark passes its start plus the timeout gives one row with ``timed_out``, by a timer and
    without a further event. What is kept of a run ends with that row, or, after a terminal status, as soon as the watermark has
    passed it, when no earlier event can come any more. So the kept runs are those of the last ``late`` and those
    that wait. Equal times go to the greater status. Unknown statuses are not read; a null run is a run of its own.

    Runs share ``GROUPS`` states by a hash of their ids, null runs one more, so that a batch calls Python once for a group
    and not once for a run. A group's timer is that of its run that is due first.
    """
    _check_timeout(timeout_seconds)
    known = status_stream.filter(F.col("status").isin(*KNOWN_STATUSES)).select("run_id", F.col("ts").cast("timestamp").alias("ts"), "status")
    kind = known.schema["run_id"].dataType
    group = F.when(F.col("run_id").isNull(), -1).otherwise(F.pmod(F.xxhash64("run_id"), F.lit(GROUPS)))
    # as text, since integers beside a null would become floats in pandas
    text = F.base64("run_id") if isinstance(kind, T.BinaryType) else F.col("run_id").cast("string")
    known = known.select(group.cast("int").alias("group"), text.alias("run"), F.unix_micros("ts").alias("at"), "status", "ts")

    def advance(key, batches, state):
        mark = state.getCurrentWatermarkMs()
        runs = {run: kept for run, *kept in zip(*state.get, strict=True)} if state.exists else {}
        changed, out = {}, []
        for rows in batches if not state.hasTimedOut else ():
            if rows["at"].isna().any():
                raise ValueError("a status has no time")
            for run, at, new in zip(rows["run"].tolist(), rows["at"].tolist(), rows["status"].tolist(), strict=True):
                run = None if key[0] == -1 else run
                started, updated, status, _ = runs.get(run, (at, None, "", 0))
                if updated is None or (at, new) > (updated, status):
                    updated, status = at, new
                runs[run] = changed[run] = [min(started, at), updated, status, 0]
        for run, kept in changed.items():
            started, updated, status, _ = kept
            due = updated if status in TERMINAL else started + timeout_seconds * 1_000_000
            kept[3] = max(due // 1000, mark + 1)
            out.append((run, started, updated, status, status in TERMINAL, False))
        for run in [run for run, kept in runs.items() if kept[3] < mark]:
            started, updated, status, _ = runs.pop(run)
            if status not in TERMINAL:
                out.append((run, started, updated, status, False, True))
        if runs:
            state.update((list(runs), *map(list, zip(*runs.values(), strict=True))))
            state.setTimeoutTimestamp(min(kept[3] for kept in runs.values()))
        elif state.exists:
            state.remove()
        if out:
            yield pd.DataFrame(out, columns=["run", "started", "updated", "status", "terminal", "timed_out"])

    out = known.withWatermark("ts", late).groupBy("group").applyInPandasWithState(
        advance,
        "run string, started long, updated long, status string, terminal boolean, timed_out boolean",
        "run array<string>, started array<long>, updated array<long>, status array<string>, due array<long>",
        "update",
        "EventTimeTimeout",
    )
    run = (F.unbase64("run") if isinstance(kind, T.BinaryType) else F.col("run").cast(kind)).alias("run_id")
    time = lambda c: F.timestamp_micros(c).cast("timestamp_ntz").alias(c)
    return out.select(run, time("started"), time("updated"), "status", "terminal", "timed_out")


def _states(spark: SparkSession, sink: str, schema: T.StructType) -> Levels:
    full = T.StructType([*schema.fields, T.StructField("batch", T.LongType())])
    return Levels(spark, sink, full, _newest_state)


def _newest_state(rows: DataFrame) -> DataFrame:
    """One row of each run: its first start and what was said last."""
    last = F.max_by(F.struct("updated", "status", "terminal", "timed_out", "batch"), F.struct("updated", "batch"))
    return rows.groupBy("run_id").agg(F.min("started").alias("started"), last.alias("s")).select("run_id", "started", "s.*")


def stream_run_status(states: DataFrame, sink: str, checkpoint: str) -> StreamingQuery:
    """Store what ``run_states`` gives; each batch adds the runs it changed."""
    levels = _states(states.sparkSession, sink, states.schema)

    def store(batch: DataFrame, batch_id: int) -> None:
        levels.append(batch.withColumn("batch", F.lit(batch_id).cast("long")), checkpoint, batch_id)

    return states.writeStream.foreachBatch(store).outputMode("update").option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def read_run_status(spark: SparkSession, sink: str, schema: T.StructType) -> DataFrame:
    return _newest_state(_states(spark, sink, schema).read()).drop("batch")


def with_timeout(states: DataFrame, as_of: str, timeout_seconds: int = WAIT_SECONDS) -> DataFrame:
    """Set ``terminal`` and ``timed_out`` as of a moment: still unfinished when start plus timeout has passed."""
    _check_timeout(timeout_seconds)
    seconds = timeout_seconds
    terminal = F.col("status").isin(*TERMINAL)
    deadline = F.col("started") + F.expr(f"INTERVAL '{seconds}' SECOND")
    now = F.expr(f"TIMESTAMP_NTZ '{as_of}'")
    return states.withColumns({"terminal": terminal, "timed_out": ~terminal & (deadline < now)})


def _check_timeout(seconds: int) -> None:
    if not WAIT_LEAST <= seconds <= WAIT_MOST:
        raise ValueError(f"the timeout must be from {WAIT_LEAST} to {WAIT_MOST} seconds")
