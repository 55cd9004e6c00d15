"""Partition values that folder names cannot hold, and times in other zones."""

import os
import time
from datetime import datetime

import pytest

from veiledlake.plans.curate import MergeOptions, run_curate
from veiledlake.policy import DatasetPolicy
from veiledlake.sinks.curated import BucketTable, PartitionedTable

POLICY = DatasetPolicy("t", keys=("st", "id"), partitions=("st",))
LAYOUT = "op string, st string, id int, v string, dms_commit_ts timestamp"


def target(spark, kind, path, name, by=("st",), keys=("st", "id")):
    if kind == "buckets":
        return BucketTable(spark, str(path), keys)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    return PartitionedTable(spark, name, str(path), list(by))


def batch(spark, *rows):
    return spark.createDataFrame([("U", *r, datetime(2024, 1, 1)) for r in rows], LAYOUT)


@pytest.mark.parametrize("kind", ["buckets", "partitioned"])
def test_blank_and_marked_values_stay(spark, tmp_path, kind):
    table = target(spark, kind, tmp_path / "t", f"blank_{kind}")
    first = [("", 1, "a"), (None, 1, "n"), ("x=/ y", 1, "s"), ("__blank__", 1, "m"), ("__blank__z", 2, "z")]
    run_curate(batch(spark, *first), POLICY, table)
    run_curate(batch(spark, ("", 1, "A2"), ("__blank__", 1, "M2")), POLICY, table)
    found = sorted((r["st"] is None, r["st"] or "", r["id"], r["v"]) for r in table.read().collect())
    assert found == [
        (False, "", 1, "A2"),
        (False, "__blank__", 1, "M2"),
        (False, "__blank__z", 2, "z"),
        (False, "x=/ y", 1, "s"),
        (True, "", 1, "n"),
    ]
    assert table.read().filter("st = ''").count() == 1


@pytest.mark.parametrize("kind", ["buckets", "partitioned"])
def test_times_stay_in_any_machine_zone(spark, tmp_path, kind, monkeypatch):
    policy = DatasetPolicy("t", keys=("id",), partitions=("at",))
    table = target(spark, kind, tmp_path / "t", f"zones_{kind}", ["at"], ["id"])
    rows = spark.sql("select 'U' op, id, v, timestamp'2024-01-01 03:00:00' + make_interval(0, 0, 0, 0, id) at, "
                     "timestamp'2024-01-01' dms_commit_ts from values (1, 'a'), (2, 'b') as t(id, v)")
    monkeypatch.setenv("TZ", "America/New_York")
    time.tzset()
    try:
        run_curate(rows, policy, table)
        run_curate(rows.filter("id = 2"), policy, table)
        found = table.read().selectExpr("id", "cast(at as string) at").collect()
    finally:
        monkeypatch.delenv("TZ")
        os.environ.setdefault("TZ", "UTC")
        time.tzset()
    assert sorted(map(tuple, found)) == [(1, "2024-01-01 04:00:00"), (2, "2024-01-01 05:00:00")]


def test_many_partitions_switch_move_and_go(spark, tmp_path):
    policy = DatasetPolicy("t", keys=("id",), partitions=("st",))
    table = target(spark, "partitioned", tmp_path / "t", "many_partitions")
    run_curate(batch(spark, *((f"p{i}", i, "a") for i in range(450))), policy, table)
    moved = batch(spark, *((f"p{i + 1}", i, "b") for i in range(0, 20, 2)))
    run_curate(moved, policy, table, MergeOptions())
    found = {r["id"]: (r["st"], r["v"]) for r in table.read().collect()}
    assert found == {i: (f"p{i + 1}", "b") if i < 20 and i % 2 == 0 else (f"p{i}", "a") for i in range(450)}
    assert spark.sql("SHOW PARTITIONS many_partitions").count() == 440
    assert not list((tmp_path / "t").glob("st=p0/*")) and list((tmp_path / "t").glob("st=p1/*"))


def test_touched_partitions_prune_the_scan(spark, tmp_path):
    """No list of partitions reaches the driver: what is touched is a table that prunes at run time."""
    table = target(spark, "partitioned", tmp_path / "t", "pruned")
    run_curate(batch(spark, *((f"p{i}", i, "a") for i in range(20))), POLICY, table)
    run_curate(batch(spark, ("p3", 3, "b"), (None, 4, "n")), POLICY, table)
    touched = table.touched(batch(spark, ("p3", 3, "c"), (None, 4, "m")), ["st", "id"])
    touched.write.parquet(str(tmp_path / "touched"))
    read = table.read(spark.read.schema(touched.schema).parquet(str(tmp_path / "touched")))
    assert sorted(map(str, read.select("st", "v").collect())) == ["Row(st='p3', v='b')", "Row(st=None, v='n')"]
    assert "dynamicpruning" in read._jdf.queryExecution().executedPlan().toString()
    assert table.keeps_place(["ST", "id"]) and not table.keeps_place(["id"])
