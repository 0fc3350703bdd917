"""Streams: late data, replay of a batch, several batches, sliding windows, timeouts."""

import math
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from millrace.operators.windows import latest_per_key
from millrace.sources.manifests import Manifests
from millrace.streaming import streams
from millrace.streaming.levels import FAN, Levels

SHAPE = "k int, ts timestamp_ntz, v int, i int"


def at(hour, minute=0):
    return datetime(2024, 1, 1, hour, minute)


def write(spark, folder, rows, name):
    spark.createDataFrame(rows, SHAPE).coalesce(1).write.mode("append").parquet(f"{folder}/{name}")


def source(spark, folder):
    # One folder per write, so every file is its own batch.
    return streams.file_stream(spark, f"{folder}/*", spark.createDataFrame([], SHAPE).schema, files_per_batch=1)


def test_incremental_picks_up_only_new_files(spark, tmp_path):
    src, sink, mark = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "mark")
    write(spark, src, [(1, at(1), 1, 1)], "a")
    streams.stream_incremental(source(spark, src), sink, mark).awaitTermination()
    write(spark, src, [(2, at(2), 1, 2)], "b")
    for _ in range(2):
        streams.stream_incremental(source(spark, src), sink, mark).awaitTermination()
    assert sorted(r["k"] for r in spark.read.parquet(sink).collect()) == [1, 2]


def test_deferred_merge_over_batches_and_replay(spark, tmp_path):
    src, target, mark = str(tmp_path / "in"), str(tmp_path / "t"), str(tmp_path / "mark")
    write(spark, src, [(1, at(1), 10, 1), (1, at(2), 11, 2), (2, at(1), 20, 3)], "a")
    write(spark, src, [(2, at(0), 19, 4), (3, at(1), 30, 5)], "b")
    rows = source(spark, src)
    streams.stream_deferred_merge(rows, target, ["k"], "ts", "i", mark).awaitTermination()
    base = spark.createDataFrame([(9, at(0), 90, 0), (1, at(0), 1, 0)], SHAPE)

    def merged():
        return sorted((r["k"], r["v"]) for r in streams.read_merged(spark, target, rows.schema, ["k"], "ts", "i", base).collect())

    assert merged() == [(1, 11), (2, 20), (3, 30), (9, 90)]
    # A replay of everything under a new checkpoint writes the same batches again.
    streams.stream_deferred_merge(rows, target, ["k"], "ts", "i", mark + "2").awaitTermination()
    assert merged() == [(1, 11), (2, 20), (3, 30), (9, 90)]


def test_rows_behind_the_watermark_are_dropped(spark, tmp_path):
    src, sink, mark = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "mark")
    for name, rows in (("a", [(1, at(1), 1, 1), (1, at(12), 1, 2)]), ("b", [(1, at(13), 5, 3)]), ("c", [(1, at(1, 30), 100, 4), (1, at(12, 30), 7, 5)])):
        write(spark, src, rows, name)
        agg = streams.rolling_aggregate(source(spark, src), "ts", ["k"], {"total": "sum(v)"}, "1 hour", late="2 hours")
        streams.stream_rolling_aggregate(agg, sink, mark, ["k"], "2 hours").awaitTermination()
    found = {r["window_start"].hour: r["total"] for r in streams.read_rolling(spark, sink, agg.schema, ["k"]).collect()}
    assert found == {1: 1, 12: 8, 13: 5}


def test_sliding_windows_on_a_plain_frame(spark):
    df = spark.createDataFrame([(1, at(1, 30), 1, 1)], SHAPE)
    found = streams.rolling_aggregate(df, "ts", ["k"], {"n": "count(*)"}, "2 hours", "1 hour")
    assert sorted(r["window_start"].hour for r in found.collect()) == [0, 1]


def statuses(spark, folder):
    names = F.element_at(F.array(F.lit("waitingToRun"), F.lit("running"), F.lit("completed"), F.lit("odd")), F.col("v"))
    return source(spark, folder).select(F.col("k").alias("run_id"), "ts", names.alias("status"))


def status_of(spark, sink, states):
    rows = streams.read_run_status(spark, sink, states.schema).collect()
    return {r["run_id"]: (r["started"].hour, r["status"], r["terminal"], r["timed_out"]) for r in rows}


def test_run_status_over_batches_and_timeout(spark, tmp_path):
    src, sink, mark = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "mark")
    write(spark, src, [(1, at(1), 1, 1), (2, at(1), 2, 2), (3, at(10, 50), 1, 3)], "a")
    write(spark, src, [(1, at(10, 40), 3, 4), (2, at(10, 45), 4, 5)], "b")
    states = streams.run_states(statuses(spark, src))
    streams.stream_run_status(states, sink, mark).awaitTermination()
    assert status_of(spark, sink, states) == {1: (1, "completed", True, False), 2: (1, "running", False, True), 3: (10, "waitingToRun", False, False)}
    rows = streams.read_run_status(spark, sink, states.schema)
    found = {r["run_id"]: (r["status"], r["terminal"], r["timed_out"]) for r in streams.with_timeout(rows, "2024-01-01 11:00:00").collect()}
    assert found == {1: ("completed", True, False), 2: ("running", False, True), 3: ("waitingToRun", False, False)}
    short = streams.with_timeout(rows, "2024-01-01 11:00:00", timeout_seconds=30)
    assert short.filter("run_id = 3 AND timed_out").count() == 1
    for seconds in (29, 3601):
        with pytest.raises(ValueError):
            streams.with_timeout(rows, "2024-01-01 11:00:00", timeout_seconds=seconds)
        with pytest.raises(ValueError):
            streams.run_states(statuses(spark, src), seconds)


def test_states_of_runs_end_and_a_timer_fires_without_an_event(spark, tmp_path):
    src, sink, mark = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "mark")
    kept = []
    for hour in range(1, 9):
        # each hour starts ten runs and ends nine of them; the tenth says nothing more
        rows = [(10 * hour + k, at(hour, 1), 1, 0) for k in range(10)] + [(10 * hour + k, at(hour, 9), 3, 0) for k in range(9)]
        write(spark, src, rows, f"h{hour}")
        states = streams.run_states(statuses(spark, src), 600, late="10 minutes")
        query = streams.stream_run_status(states, sink, mark)
        query.awaitTermination()
        kept.append(max(p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress[-1:]))
    assert max(kept) <= 20
    found = status_of(spark, sink, states)
    assert len(found) == 80
    for run, (hour, status, terminal, timed_out) in found.items():
        assert hour == run // 10
        assert (status, terminal, timed_out) == (("waitingToRun", False, hour < 8) if run % 10 == 9 else ("completed", True, False)), run


def test_an_event_that_comes_out_of_order_does_not_open_an_ended_run(spark, tmp_path):
    src, sink, mark = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "mark")
    for name, rows in (("a", [(1, at(1), 1, 1), (1, at(2), 3, 2)]), ("b", [(1, at(1, 30), 2, 3)]), ("c", [(2, at(9), 1, 4)]), ("d", [(1, at(1, 40), 2, 5)])):
        write(spark, src, rows, name)
    states = streams.run_states(statuses(spark, src), late="1 hour")
    streams.stream_run_status(states, sink, mark).awaitTermination()
    assert status_of(spark, sink, states)[1] == (1, "completed", True, False)


def test_runs_share_states_and_keep_their_own_timers(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(streams, "GROUPS", 4)
    src, sink, mark = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "mark")
    far = 2**60  # beyond what a float keeps apart
    write(spark, src, [(k, at(1, k % 50), 1, 0) for k in range(300)] + [(None, at(1), 1, 0)], "a")
    write(spark, src, [(k, at(1, 59), 3, 0) for k in range(0, 300, 2)] + [(300, at(1, 59), 2, 0)], "b")
    states = streams.run_states(statuses(spark, src).withColumn("run_id", F.col("run_id") + far), 600, late="1 minute")
    query = streams.stream_run_status(states, sink, mark)
    query.awaitTermination()
    assert max(p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress) <= 5
    found = status_of(spark, sink, states)
    want = {far + k: (1, "completed", True, False) if k % 2 == 0 else (1, "waitingToRun", False, k % 50 < 48) for k in range(300)}
    assert found == want | {far + 300: (1, "running", False, False), None: (1, "waitingToRun", False, True)}


def levels_of(spark, folder, schema):
    return Levels(spark, str(folder), schema, lambda rows: latest_per_key(rows, ["k"], "ts", "i"))


def test_runs_stay_few_and_the_newest_rows_remain(spark, tmp_path):
    schema = spark.createDataFrame([], SHAPE).schema
    levels = levels_of(spark, tmp_path / "t", schema)
    for b in range(20):
        levels.append(spark.createDataFrame([(k, at(b % 5, b), b, 0) for k in range(b, b + 6)], SHAPE), "w", b)
        assert len(levels.state()["runs"]) <= (FAN - 1) * (math.log(6 * (b + 1), FAN) + 1)
    want = {}
    for b in range(20):
        for k in range(b, b + 6):
            want[k] = max(want.get(k, (at(0), -1)), (at(b % 5, b), b))
    read = lambda: {r["k"]: (r["ts"], r["v"]) for r in levels.merge(levels.read()).collect()}
    assert read() == want
    levels.append(spark.createDataFrame([(0, at(23), 99, 0)], SHAPE), "w", 19)  # a replay
    assert read() == want
    open_reader = levels.read()
    levels.expire()
    assert open_reader.count() > 0 and len(levels.manifests.versions()) > 1
    levels.expire(seconds=0)
    assert read() == want and len(levels.manifests.versions()) == 1
    assert len(list((tmp_path / "t" / "runs").iterdir())) == len(levels.state()["runs"])


@pytest.mark.parametrize("when", ["append", "merge"])
def test_a_crash_between_writing_and_naming_loses_nothing(spark, tmp_path, monkeypatch, when):
    schema = spark.createDataFrame([], SHAPE).schema
    levels = levels_of(spark, tmp_path / "t", schema)
    batch = lambda b: spark.createDataFrame([(b, at(1), b, 0)], SHAPE)
    for b in range(FAN - 1):
        levels.append(batch(b), "w", b)
    commit, left = Manifests.commit, [0 if when == "append" else 1]

    def broken(self, version, state):
        if left[0] == 0:
            raise RuntimeError("lost")
        left[0] -= 1
        return commit(self, version, state)

    monkeypatch.setattr(Manifests, "commit", broken)
    with pytest.raises(RuntimeError):
        levels.append(batch(FAN - 1), "w", FAN - 1)
    monkeypatch.setattr(Manifests, "commit", commit)
    assert sorted(r["k"] for r in levels.read().collect()) == list(range(FAN - 1 if when == "append" else FAN))
    levels.append(batch(FAN - 1), "w", FAN - 1)  # the replay
    levels.compact()
    assert len(levels.state()["runs"]) == 1
    assert sorted(r["k"] for r in levels.read().collect()) == list(range(FAN))


def test_writers_at_once_lose_nothing(spark, tmp_path):
    schema = spark.createDataFrame([], SHAPE).schema

    def write_many(name, first):
        own = levels_of(spark, tmp_path / "t", schema)
        for b in range(5):
            own.append(spark.createDataFrame([(first + b, at(1), b, 0)], SHAPE), name, b)

    with ThreadPoolExecutor(2) as pool:
        list(pool.map(write_many, ["x", "y"], [0, 100]))
    levels = levels_of(spark, tmp_path / "t", schema)
    assert sorted(r["k"] for r in levels.merge(levels.read()).collect()) == [*range(5), *range(100, 105)]
    assert levels.state()["writers"] == {"x": 4, "y": 4}


def test_a_taken_version_is_not_overwritten(spark, tmp_path):
    one, two = Manifests(spark, str(tmp_path / "m")), Manifests(spark, str(tmp_path / "m"))
    assert one.latest() == (-1, {})
    assert one.commit(0, {"a": 1}) and not two.commit(0, {"a": 2})
    assert two.latest() == (0, {"a": 1})
    assert two.update(lambda s: s | {"b": 3}) == {"a": 1, "b": 3} and one.latest()[0] == 1


def test_closed_windows_are_not_touched_again(spark, tmp_path):
    src, sink, mark = str(tmp_path / "in"), tmp_path / "out", str(tmp_path / "mark")
    for hour in range(1, 13):
        write(spark, src, [(1, at(hour), hour, 1), (2, at(hour, 30), 1, 2), *([(1, at(hour - 1, 50), 100, 3)] if hour > 1 else [])], f"h{hour:02}")
        agg = streams.rolling_aggregate(source(spark, src), "ts", ["k"], {"total": "sum(v)"}, "1 hour", late="1 hour")
        streams.stream_rolling_aggregate(agg, str(sink), mark, ["k"]).awaitTermination()
    rows = streams.read_rolling(spark, str(sink), agg.schema, ["k"])
    want = {(h, 1): h + (100 if h < 12 else 0) for h in range(1, 13)} | {(h, 2): 1 for h in range(1, 13)}
    assert {(r["window_start"].hour, r["k"]): r["total"] for r in rows.collect()} == want
    still = streams.read_rolling(spark, str(sink), agg.schema, ["k"], closed=False)
    assert {r["window_start"].hour for r in still.collect()} <= {10, 11, 12}
    assert len(still.inputFiles()) <= 8 and not any("closed=true" in f for f in still.inputFiles())
    assert len(Manifests(spark, str(sink)).latest()[1]["runs"]) <= 2 * (FAN - 1)
