"""Snapshots, redaction, reshaping and listings."""

import json
import random
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from millrace.sources import catalog, reshape, secrets, snapshots
from millrace.sources.manifests import Conflict
from millrace.sources.scratch import Scratch, checkpoint_root

NOON = datetime(2024, 1, 1, 12, 0)


def test_checkpoint_root_comes_from_the_session(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    assert checkpoint_root(spark) == (named or spark.sparkContext.getCheckpointDir())


def test_snapshot_freshness_and_generations(spark, tmp_path):
    folder = str(tmp_path / "snap")
    assert snapshots.load_snapshot(spark, folder, NOON, 60) is None
    snapshots.publish_snapshot(spark.range(3), folder, datetime(2024, 1, 1, 11, 0))
    snapshots.publish_snapshot(spark.range(5), folder, datetime(2024, 1, 1, 11, 45))
    assert snapshots.load_snapshot(spark, folder, NOON, 1800).count() == 5
    assert snapshots.load_snapshot(spark, folder, NOON, 60) is None
    snapshots.publish_snapshot(spark.range(9), folder, datetime(2024, 1, 1, 11, 59), detail=False)
    assert snapshots.load_snapshot(spark, folder, NOON, 1800).count() == 5
    assert snapshots.load_snapshot(spark, folder, NOON, 1800, require_detail=False).count() == 9


def test_failed_publish_leaves_the_old_generation(spark, tmp_path):
    folder = str(tmp_path / "snap")
    snapshots.publish_snapshot(spark.range(3), folder, NOON)
    broken = spark.range(4).select(F.when(F.col("id") == 3, F.raise_error(F.lit("boom")).cast("long")).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="boom"):
        snapshots.publish_snapshot(broken, folder, NOON)
    assert snapshots.load_snapshot(spark, folder, NOON, 60).count() == 3
    assert snapshots.snapshot_meta(spark, folder).count() == 1


def test_publishers_at_once_do_not_mix(spark, tmp_path):
    folder = str(tmp_path / "snap")
    snapshots.publish_snapshot(spark.range(1), folder, NOON)

    def publish(k):
        return snapshots.publish_snapshot(spark.range(10 * k, 10 * k + 10), folder, NOON)

    with ThreadPoolExecutor(3) as pool:
        versions = list(pool.map(publish, [1, 2, 3]))
    found = snapshots.generations(spark, folder)
    assert [g["number"] for g in found] == [0, 1, 2, 3] and {g["version"] for g in found[1:]} == set(versions)
    rows = sorted(r["id"] for r in snapshots.load_snapshot(spark, folder, NOON, 60).collect())
    assert rows in [list(range(10 * k, 10 * k + 10)) for k in (1, 2, 3)]
    assert rows[0] // 10 == versions.index(found[-1]["version"]) + 1


def test_a_publisher_that_read_an_older_generation_is_refused(spark, tmp_path):
    folder = str(tmp_path / "snap")
    snapshots.publish_snapshot(spark.range(1), folder, NOON, after=-1)
    seen = snapshots.generations(spark, folder)[-1]["number"]
    snapshots.publish_snapshot(spark.range(2), folder, NOON, after=seen)
    with pytest.raises(Conflict):
        snapshots.publish_snapshot(spark.range(3), folder, NOON, after=seen)
    assert snapshots.load_snapshot(spark, folder, NOON, 60).count() == 2
    assert len(list((tmp_path / "snap" / "items").iterdir())) == 2


def test_expiry_spares_readers_and_the_newest(spark, tmp_path):
    folder = str(tmp_path / "snap")
    publish = lambda hour, detail: snapshots.publish_snapshot(spark.range(hour), folder, datetime(2024, 1, 1, hour), detail=detail)
    for hour, detail in ((1, False), (2, True), (3, True)):
        publish(hour, detail)
    reader = snapshots.load_snapshot(spark, folder, datetime(2024, 1, 1, 3), 60)
    publish(4, False)
    publish(11, True)
    snapshots.expire_snapshots(spark, folder, datetime(2024, 1, 1, 10))
    assert [g["total_items"] for g in snapshots.generations(spark, folder)] == [4, 11]
    assert reader.count() == 3
    snapshots.expire_snapshots(spark, folder, datetime(2024, 1, 1, 10), spare_seconds=0)
    assert len(list((tmp_path / "snap" / "items").iterdir())) == 2
    assert snapshots.load_snapshot(spark, folder, NOON, 7200).count() == 11


def test_credentials_go_at_any_depth(spark):
    df = spark.sql(
        """SELECT 1 AS id, 'x' AS gitToken, named_struct('accessToken', 'x', 'keep', array(named_struct('snowflakePassword', 'x', 'b', 2))) AS s,
           map('userCredentials', 'x', 'ok', 'y') AS m, cast(null as struct<accessToken:string,z:int>) AS n"""
    )
    out = secrets.drop_credential_fields(df)
    assert out.columns == ["id", "s", "m", "n"]
    row = out.first()
    assert row["s"].asDict(True) == {"keep": [{"b": 2}]} and row["m"] == {"ok": "y"} and row["n"] is None


def test_redaction(spark):
    docs = [
        {"api_key": "k", "APIKey": "", "deep": [{"Refresh-Token": "t", "n": 1}]},
        {"name": "access_token", "detail": "secret", "other": "fine"},
        {"name": "plain", "detail": "kept", "password": 5},
    ]
    df = spark.createDataFrame([(i, json.dumps(d)) for i, d in enumerate(docs)] + [(3, "not json"), (4, None)], "id int, doc string")
    out = {r["id"]: r for r in secrets.redact_sensitive(df, "doc").collect()}
    assert json.loads(out[0]["doc"]) == {"api_key": "<redacted>", "APIKey": "", "deep": [{"Refresh-Token": "<redacted>", "n": 1}]}
    assert json.loads(out[1]["doc"])["detail"] == "<redacted>" and json.loads(out[1]["doc"])["other"] == "fine"
    assert [out[i]["did_redact"] for i in range(5)] == [True, True, False, False, False]
    assert out[3]["doc"] == "not json" and out[4]["doc"] is None


def redacted(value):
    """The rules on parsed JSON, as a plain walk."""
    if isinstance(value, list):
        return [redacted(v) for v in value]
    if not isinstance(value, dict):
        return value
    plain = lambda k: k.lower().replace("_", "").replace("-", "")
    named = isinstance(value.get("name"), str) and plain(value["name"]) in secrets.SENSITIVE_KEYS
    hit = lambda k, v: isinstance(v, str) and v and (plain(k) in secrets.SENSITIVE_KEYS or (named and k == "detail"))
    return {k: secrets.REDACTED if hit(k, v) else redacted(v) for k, v in value.items()}


def test_redaction_of_long_deep_and_random_documents(spark):
    pick = random.Random(4)

    def made(depth):
        if depth == 0 or pick.random() < 0.2:
            return pick.choice([1, None, "x", "", 'a "quoted" {text}', "\\", "token", True, "naïve"])
        if pick.random() < 0.3:
            return [made(depth - 1) for _ in range(pick.randint(0, 4))]
        keys = pick.sample(["name", "detail", "token", "API-Key", "other", "more", "names", 'de"tail'], pick.randint(0, 6))
        return {k: pick.choice(["token", "PAT", "plain", ""]) if k == "name" and pick.random() < 0.7 else made(depth - 1) for k in keys}

    deep = {"detail": "gone", "inner": {"detail": "kept", "name": "plain"}}
    for k in range(12):
        deep = {"detail": f"secret {k}", "x": [deep, {"y": "}"}], "name": "Pass-Phrase" if k % 2 else "open"}
    docs = [
        {"name": "token", "v": [1] * 200_000, "detail": "x"}, {"detail": "x", "v": ["}"] * 50_000, "name": "token"},
        {"name": "token", "v": [{"name": "pat", "detail": "y"}] * 3000, "detail": "x" * 100_000}, deep, *[made(6) for _ in range(300)],
    ]
    rows = [(i, json.dumps(d, indent=i % 3 or None, ensure_ascii=bool(i % 2))) for i, d in enumerate(docs)]
    out = {r["id"]: r for r in secrets.redact_sensitive(spark.createDataFrame(rows, "id int, doc string"), "doc").collect()}
    for i, d in enumerate(docs):
        assert json.loads(out[i]["doc"]) == redacted(d), i
        assert out[i]["did_redact"] == (redacted(d) != d)
        if not out[i]["did_redact"]:
            assert out[i]["doc"] == rows[i][1]


def test_redaction_of_parts_of_documents(spark):
    parts = [
        ('"x":1},{"detail":"a","name":"token","v":{"n', '"x":1},{"detail":"<redacted>","name":"token","v":{"n'),
        ('"name":"pat"}, "detail":"b"', '"name":"pat"}, "detail":"<redacted>"'),
        ('{"name":"token","detail":"cut', '{"name":"token","detail":"cut'),
        ('}}{"name":"secret"}{"detail":"c"}', '}}{"name":"secret"}{"detail":"c"}'),
    ]
    df = spark.createDataFrame([(i, p[0]) for i, p in enumerate(parts)], "id int, doc string")
    assert [r["doc"] for r in secrets.redact_sensitive(df, "doc").orderBy("id").collect()] == [p[1] for p in parts]


def test_reshape_rejects_other_directions(spark):
    with pytest.raises(ValueError):
        reshape.reshape_nodes(spark.range(1), "sideways")


def test_scan_nodes_from_files(spark, tmp_path):
    doc = {
        "workspaceID": "w",
        "id": "n1",
        "name": "N1",
        "nodeType": "Stage",
        "metadata": {
            "columns": [
                {"columnID": "c1", "name": "A", "sources": [{"columnReferences": [{"nodeID": "up", "columnID": "u1"}, {"sourceNodeID": "up", "sourceColumnID": "u2"}, {"nodeID": "up"}]}]},
                {"id": "c2", "name": "B"},
                {"name": "no id"},
                {"id": "c4"},
            ]
        },
    }
    (tmp_path / "nodes.json").write_text(json.dumps(doc) + "\n" + json.dumps({"id": "x"}) + "\n")
    nodes, columns, refs = catalog.scan_nodes(spark, str(tmp_path))
    assert [r["id"] for r in nodes.collect()] == ["n1"]
    assert sorted((r["column_id"], r["name"], r["ordinal"]) for r in columns.collect()) == [("c1", "A", 0), ("c2", "B", 1)]
    assert sorted((r["src_node"], r["src_column"]) for r in refs.collect()) == [("up", "u1"), ("up", "u2")]


def test_keyset_pages_cover_everything(spark):
    df, seen, cursor = spark.range(25), [], None
    while page := [r["id"] for r in catalog.list_entities(df, "id", "asc", cursor, 10).collect()]:
        seen += page
        cursor = page[-1]
    assert seen == list(range(25))
    assert catalog.get_entity(df, "id", 7).count() == 1


def test_scratch_release(spark):
    scratch = Scratch(spark, "test")
    assert scratch.write(spark.range(3), "t").count() == 3
    scratch.release()
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        spark.read.parquet(f"{scratch.path}/t").count()
