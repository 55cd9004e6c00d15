import random
import re
from datetime import UTC, datetime, timedelta
from functools import partial

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from veiledlake.operators.latest import latest_per_key, order_latest_first
from veiledlake.operators.sizes import BROADCAST_BYTES, memory_size
from veiledlake.operators.profile import duplicate_profile, preview
from veiledlake.operators.upsert import match_rows, matched, split_by_keys, upsert
from veiledlake.plans.curate import CurateReport, MergeOptions, curate, run_curate
from veiledlake.policy import DatasetPolicy
from veiledlake.sinks.curated import BucketTable, MergeTable, PartitionedTable

DAY = datetime(2024, 1, 1, tzinfo=UTC).replace(tzinfo=None)
T = [DAY + timedelta(days=i) for i in range(5)]
VERSIONS = "k int, v string, insrt_ts timestamp, dms_commit_ts timestamp"


def test_missing_time_wins_unless_told_otherwise(spark, rows):
    df = spark.createDataFrame([(1, "old", None, T[0]), (1, "new", T[1], T[1])], VERSIONS)
    assert rows(latest_per_key(df, ["k"]), "v") == [("old",)]
    assert rows(latest_per_key(df, ["k"], nulls="last"), "v") == [("new",)]


def test_equal_insert_time_goes_to_later_commit(spark, rows):
    df = spark.createDataFrame([(1, "b", T[0], T[1]), (1, "a", T[0], T[2])], VERSIONS)
    assert rows(latest_per_key(df, ["K"]), "v") == [("a",)]


def test_time_column_precedence(spark, rows):
    df = spark.createDataFrame([(1, "x", T[0], T[4]), (1, "y", T[1], T[0])], VERSIONS)
    assert rows(latest_per_key(df, ["k"]), "v") == [("y",)]
    assert rows(latest_per_key(df.drop("insrt_ts"), ["k"]), "v") == [("x",)]
    assert rows(latest_per_key(df, ["k"], order_by="DMS_COMMIT_TS"), "v") == [("x",)]


def test_rows_without_times_and_without_other_columns(spark, rows):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, None)], "k int, v string")
    assert rows(latest_per_key(df, ["k"])) == [(1, "b"), (2, None)]
    assert rows(latest_per_key(df.select("k"), ["k"])) == [(1,), (2,)]


def test_map_columns_are_carried_along(spark):
    df = spark.sql("select * from values (1, map('a', 1), 1), (1, map('a', 2), 2) t(k, m, n)")
    assert latest_per_key(df, ["k"]).first()["m"] == {"a": 2}


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 2), st.integers(0, 2)), min_size=1, max_size=30), st.randoms())
def test_winner_does_not_depend_on_order_or_partitions(spark, versions, rng):
    layout = "k int, dms_commit_ts int, v int"
    shuffled = rng.sample(versions, len(versions))
    a = latest_per_key(spark.createDataFrame(versions, layout).repartition(3), ["k"])
    b = latest_per_key(spark.createDataFrame(shuffled, layout).coalesce(1), ["k"])
    best = {}
    for k, t, v in versions:
        best[k] = max(best.get(k, (t, v)), (t, v))
    expected = sorted((k, *tv) for k, tv in best.items())
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect())) == expected


def test_hot_key_is_cut_before_the_shuffle(spark):
    df = spark.range(0, 60000, 1, 4).select(
        F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"), F.col("id").alias("dms_commit_ts")
    )
    done = latest_per_key(df, ["k"])
    plan = done._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")
    assert done.filter("k = -1").first()["dms_commit_ts"] == 59997
    assert done.count() == 40001


def test_profile_preview_and_order(spark, rows):
    df = spark.createDataFrame([(1, T[0]), (1, None), (2, T[1])], "k int, t timestamp")
    assert rows(duplicate_profile(df, ["k"])) == [(3, 2, 1)]
    assert rows(duplicate_profile(df.filter("k > 5"), ["k"])) == [(0, 0, 0)]
    assert [r["t"] for r in order_latest_first(df, "t", ["k"]).collect()] == [None, T[1], T[0]]
    assert preview(df, ["k", "t"], 2).count() == 2


ROW = "k int, j int, v string, op string, t int"


def frame(spark, *data):
    return spark.createDataFrame(list(data), ROW)


def test_upsert_replaces_and_inserts(spark, rows):
    base = frame(spark, (1, 1, "a", "I", 1), (2, 1, "b", "I", 1))
    batch = frame(spark, (2, 1, "B", "U", 2), (3, 1, "C", "I", 2))
    assert rows(upsert(base, batch, ["k", "j"]), "k", "v") == [(1, "a"), (2, "B"), (3, "C")]
    assert rows(match_rows(base, batch, ["k", "j"]), "v", "new_v") == [("b", "B")]
    assert rows(matched(base, batch, ["k", "j"]), "v") == [("b",)]


def test_null_key_parts(spark, rows):
    base = frame(spark, (None, 1, "a", "I", 1), (1, 1, "b", "I", 1))
    batch = frame(spark, (None, 1, "A", "I", 2))
    assert rows(upsert(base, batch, ["k", "j"]), "v") == [("A",), ("a",), ("b",)]
    assert rows(upsert(base, batch, ["k", "j"], null_safe=True), "v") == [("A",), ("b",)]


def test_deletes(spark, rows):
    base = frame(spark, (1, 1, "a", "I", 1), (2, 1, "b", "I", 1))
    batch = frame(spark, (1, 1, "a", "D", 2), (3, 1, "c", None, 2))
    assert rows(upsert(base, batch, ["k", "j"]), "k", "op") == [(1, "D"), (2, "I"), (3, None)]
    assert rows(upsert(base, batch, ["k", "j"], apply_deletes=True), "k") == [(2,), (3,)]


def test_late_rows(spark, rows):
    base = frame(spark, (1, 1, "new", "I", 5), (2, 1, "same", "I", 5), (3, 1, "none", "I", None))
    batch = frame(spark, (1, 1, "late", "U", 4), (2, 1, "SAME", "U", 5), (3, 1, "x", "U", 9), (4, 1, "add", "I", 1))
    assert ("late",) in rows(upsert(base, batch, ["k", "j"]), "v")
    kept = upsert(base, batch, ["k", "j"], only_if_newer="t")
    assert rows(kept, "v") == [("SAME",), ("add",), ("new",), ("none",)]


def test_columns_are_matched_by_name(spark, rows):
    base = spark.createDataFrame([(1, "a", 5)], "k int, v string, n long")
    batch = spark.createDataFrame([("b", 1, 0, 7)], "V string, K int, extra int, n int")
    merged = upsert(base, batch, ["k"])
    assert merged.dtypes == base.dtypes and rows(merged) == [(1, "b", 7)]
    with pytest.raises(ValueError, match="lack"):
        upsert(base, batch.drop("n"), ["k"])
    assert rows(upsert(base, batch.drop("n"), ["k"], missing="null")) == [(1, "b", None)]


@settings(max_examples=8, deadline=None)
@given(
    st.dictionaries(st.integers(0, 9), st.integers(0, 99), max_size=10),
    st.dictionaries(st.integers(0, 9), st.integers(0, 99), max_size=10),
)
def test_upsert_is_dict_update_and_idempotent(spark, base, batch):
    a = spark.createDataFrame(list(base.items()), "k int, v int")
    b = spark.createDataFrame(list(batch.items()), "k int, v int")
    once = upsert(a, b, ["k"])
    assert dict(map(tuple, once.collect())) == base | batch
    assert dict(map(tuple, upsert(once, b, ["k"]).collect())) == base | batch


POLICY = DatasetPolicy("t", keys=("k",), partitions=("st",))
LAYOUT = "k int, st string, v string, dms_commit_ts int"


@pytest.fixture(params=["buckets", "partitioned"])
def table(request, spark, tmp_path):
    if request.param == "buckets":
        return BucketTable(spark, f"{tmp_path}/t", ["k"])
    name = f"t_{random.randrange(10**12)}"
    return PartitionedTable(spark, name, f"{tmp_path}/t", ["st"])


def test_tables_follow_the_merged_rows(spark, table, rows):
    def run(*data, **options):
        batch = spark.createDataFrame(list(data), LAYOUT)
        return run_curate(batch, POLICY, table, MergeOptions(**options)).written

    assert not run()
    assert not table.exists()
    assert run((1, "01", "a", 1), (1, "01", "b", 2), (2, "10", "c", 1), (4, None, "n", 1))
    assert rows(table.read(), "k", "st", "v") == [(1, "01", "b"), (2, "10", "c"), (4, None, "n")]
    assert run((2, "01", "moved", 3), (3, "it's 5%/x", "d", 3), (4, None, "N", 3))
    assert rows(table.read(), "k", "st", "v") == [
        (1, "01", "b"),
        (2, "01", "moved"),
        (3, "it's 5%/x", "d"),
        (4, None, "N"),
    ]
    assert not run()
    again = spark.createDataFrame([(None, "01", "no key", 9)], LAYOUT)
    for number in (7, 7, 6):
        report = run_curate(again, POLICY, table, batch_id=("reader", number))
    assert not report.written
    assert table.read().filter("k is null").count() == 1
    run_curate(again, POLICY, table, batch_id=("other", 0))
    assert table.read().filter("k is null").count() == 2
    assert run((1, "01", "late", 0), only_if_newer="dms_commit_ts")
    assert (1, "01", "b") in rows(table.read(), "k", "st", "v")
    assert table.read().filter("k is not null").count() == 4


def test_untouched_partitions_keep_their_files(spark, tmp_path):
    table = PartitionedTable(spark, f"t_{random.randrange(10**12)}", f"{tmp_path}/t", ["st"])
    policy = DatasetPolicy("t", keys=("k", "st"), partitions=("st",))
    run_curate(spark.createDataFrame([(1, "a", "x", 1), (2, "b", "y", 1)], LAYOUT), policy, table)
    before = set(table.read().filter("st = 'b'").inputFiles())
    run_curate(spark.createDataFrame([(1, "a", "X", 2)], LAYOUT), policy, table)
    assert set(table.read().filter("st = 'b'").inputFiles()) == before
    pruned = table.read().filter("st = 'b'")._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*st#", pruned)
    run_curate(spark.createDataFrame([(2, "b", "Y", 3)], LAYOUT), policy, table)
    assert sorted(r["v"] for r in table.read().collect()) == ["X", "Y"]


def files(folder):
    return {p: p.stat().st_mtime_ns for p in folder.glob("buckets=*/*/*/*.parquet")}


def test_small_batch_rewrites_its_buckets_only(spark, tmp_path, rows):
    table = BucketTable(spark, f"{tmp_path}/t", ["k"], buckets=16)
    first = [(n, "01", "v", n) for n in range(200)] + [(None, "01", "alone", 1)]
    assert run_curate(spark.createDataFrame(first, LAYOUT), POLICY, table, batch_id=("reader", 0)).written
    before = files(tmp_path / "t")
    assert len({p.parts[-3] for p in before}) == 17  # and one for rows without a key
    batch = spark.createDataFrame([(7, "02", "new", 300), (None, "02", "alone", 2)], LAYOUT)
    assert run_curate(batch, POLICY, table, batch_id=("reader", 1)).written
    after = files(tmp_path / "t")
    assert len({p.parts[-3] for p in before.keys() - after.keys()}) == 1
    assert {p.parts[-3] for p in after.keys() - before.keys()} == {"_bucket=-1", (before.keys() - after.keys()).pop().parts[-3]}
    assert all(after[p] == before[p] for p in before.keys() & after.keys())
    expected = [(n, "02" if n == 7 else "01") for n in range(200)] + [(None, "01"), (None, "02")]
    assert rows(table.read(), "k", "st") == sorted(expected, key=lambda r: [(v is None, str(v)) for v in r])
    again = BucketTable(spark, f"{tmp_path}/t", ["k"], buckets=99)
    assert again.buckets == 16 and again.has_applied(("reader", 1)) and not again.has_applied(("reader", 2))
    assert table.read().dtypes == [("k", "int"), ("st", "string"), ("v", "string"), ("dms_commit_ts", "int")]


def test_scan_of_a_merge_is_pruned_while_it_runs(spark, tmp_path):
    table = BucketTable(spark, f"{tmp_path}/t", ["k"], buckets=16)
    run_curate(spark.createDataFrame([(n, "01", "v", n) for n in range(200)], LAYOUT), POLICY, table)
    plans = []

    def merged(base, rows):
        plans.append(base._jdf.queryExecution().executedPlan().toString())
        return base.filter("k <> 7").unionByName(rows)

    batch = spark.createDataFrame([(7, "02", "new", 300)], LAYOUT)
    table.merge(batch, merged, null_safe=True)
    assert "dynamicpruning" in plans[0]
    assert table.read().count() == 200


def test_repeat_of_a_half_done_merge(spark, tmp_path, rows):
    """A run that fails before its batch is noted is repeated: no row is lost or doubled, null keys included."""
    table = BucketTable(spark, f"{tmp_path}/t", ["k"])
    run_curate(spark.createDataFrame([(1, "01", "a", 1)], LAYOUT), POLICY, table, batch_id=("r", 0))
    batch = spark.createDataFrame([(1, "01", "b", 2), (2, "01", "c", 2), (None, "01", "n", 2)], LAYOUT)
    note = BucketTable.note_applied
    for fail in (True, True, False):
        table.note_applied = (lambda batch: 1 / 0) if fail else (lambda batch: note(table, batch))
        try:
            run_curate(batch, POLICY, table, batch_id=("r", 1))
        except ZeroDivisionError:
            assert fail
    assert rows(table.read(), "k", "v") == [(1, "b"), (2, "c"), (None, "n")]
    assert not run_curate(batch, POLICY, table, batch_id=("r", 1)).written


def test_null_keys_move_into_buckets_once_they_match(spark, tmp_path, rows):
    table = BucketTable(spark, f"{tmp_path}/t", ["k"])
    for n in (1, 2):
        run_curate(spark.createDataFrame([(None, "01", f"n{n}", n), (n, "01", "v", n)], LAYOUT), POLICY, table)
    assert rows(table.read(), "k", "v") == [(1, "v"), (2, "v"), (None, "n1"), (None, "n2")]
    one = spark.createDataFrame([(None, "01", "n3", 3)], LAYOUT)
    run_curate(one, POLICY, table, MergeOptions(null_safe=True))
    assert rows(table.read(), "k", "v") == [(1, "v"), (2, "v"), (None, "n3")]


def test_buckets_follow_the_types_of_the_table(spark, tmp_path, rows):
    table = BucketTable(spark, f"{tmp_path}/t", ["k"])
    run_curate(spark.createDataFrame([(n, "01", "a", 1) for n in range(50)], LAYOUT), POLICY, table)
    wide = spark.createDataFrame([(n, "01", "b", 2) for n in range(50)], LAYOUT.replace("k int", "k long"))
    run_curate(wide, POLICY, table)
    assert rows(table.read().groupBy("v").count()) == [("b", 50)]
    with pytest.raises(ValueError, match="_live"):
        run_curate(wide.withColumn("_live", F.lit(1)), POLICY, table)


@pytest.mark.parametrize("partitions", [(), ("st",)])
def test_catalog_entry_follows_the_table(spark, tmp_path, rows, partitions):
    table, name = BucketTable(spark, f"{tmp_path}/t", ["k"]), f"entry_{len(partitions)}"
    policy = DatasetPolicy("t", keys=("k",), partitions=partitions)
    for n in (1, 2):
        run_curate(spark.createDataFrame([(n, f"0{n}", "v", n)], LAYOUT), policy, table)
        assert len(table.register(name)) == (4 if n == 1 else 0)
        assert rows(spark.table(name), "k", "st") == [(i, f"0{i}") for i in range(1, n + 1)]


def test_pure_plan_equals_job(spark, tmp_path, rows):
    base = spark.createDataFrame([(1, "x", "a", 1), (2, "x", "b", 1)], LAYOUT)
    batch = spark.createDataFrame([(2, "y", "c", 2), (2, "y", "d", 3), (None, "y", "e", 1)], LAYOUT)
    table = BucketTable(spark, f"{tmp_path}/t", ["k"])
    assert run_curate(base, POLICY, table) == CurateReport(True, 2, 2, 0)
    report = run_curate(batch, POLICY, table)
    assert report == CurateReport(True, 3, 2, 1) and report.duplicates == 1
    assert rows(curate(base, batch, POLICY)) == rows(table.read())
    assert rows(curate(None, batch, POLICY), "v") == [("d",), ("e",)]


def test_large_base_is_not_shuffled_for_a_small_batch(spark, tmp_path):
    spark.range(100000).select("id", F.col("id").alias("v")).write.parquet(f"{tmp_path}/base")
    base = spark.read.parquet(f"{tmp_path}/base")
    spark.range(10).select("id", F.col("id").alias("v")).write.parquet(f"{tmp_path}/batch")
    batch = spark.read.parquet(f"{tmp_path}/batch")
    size = memory_size(base.schema, ["id", "v"])
    assert batch.select(size).first()[0] == 480 and base.select(size).first()[0] == 4800000
    nested = base.withColumn("a", F.array("id"))
    assert nested.select(memory_size(nested.schema, ["a"])).first()[0] > BROADCAST_BYTES
    assert base.filter("id < 0").select(size).first()[0] == 0
    for newer in (None, "v"):
        merged = upsert(base, batch, ["id"], small=True, only_if_newer=newer)
        plan = merged._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan


@pytest.mark.parametrize("bits", [3, 27])
@pytest.mark.parametrize("newer", [None, "t"])
@pytest.mark.parametrize("null_safe", [False, True])
def test_key_bits_lose_no_match(spark, monkeypatch, rows, bits, newer, null_safe):
    """With few bits nearly every row passes by chance; the result stays."""
    rng = random.Random(bits)
    layout = "a int, b string, t int, op string"
    keys = [(a, b) for a in [*range(30), None] for b in ("x", "y", None)]
    base = [(a, b, rng.randint(0, 3), "I") for a, b in keys if rng.random() < 0.7]
    batch = [(a, b, rng.randint(0, 3), "U") for a, b in keys if rng.random() < 0.4]
    left, right = spark.createDataFrame(base, layout), spark.createDataFrame(batch, layout)
    right = right.withColumn("a", F.col("a").cast("long"))
    split = split_by_keys(left, right, ["a", "b"], null_safe, bits)
    new = {r[:2]: r for r in batch if null_safe or None not in r[:2]}
    assert {r[:2] for r in rows(split[0])} >= {r[:2] for r in base if r[:2] in new}
    assert split[0].count() + split[1].count() == len(base)
    monkeypatch.setattr("veiledlake.operators.upsert.split_by_keys", partial(split_by_keys, bits=bits))
    stays = {r[:2]: r for r in base if r[:2] in new and newer and r[2] > new[r[:2]][2]}
    want = [r for r in base if r[:2] not in new or r[:2] in stays] + [r for r in batch if r[:2] not in stays]
    found = upsert(left, right, ["a", "b"], null_safe=null_safe, only_if_newer=newer)
    assert rows(found) == sorted(want, key=lambda r: [(v is None, str(v)) for v in r])


def test_large_batch_shuffles_only_rows_that_may_match(spark, tmp_path):
    spark.range(100_000).selectExpr("id", "repeat('x', 50) v").write.parquet(f"{tmp_path}/base")
    spark.range(0, 100_000, 50).selectExpr("id", "'new' v").write.parquet(f"{tmp_path}/batch")
    base, batch = spark.read.parquet(f"{tmp_path}/base"), spark.read.parquet(f"{tmp_path}/batch")
    maybe, sure = split_by_keys(base, batch, ["id"])
    assert maybe.count() in range(2000, 2100) and maybe.count() + sure.count() == 100_000
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plan = upsert(base, batch, ["id"])._jdf.queryExecution().executedPlan().toString()
        assert upsert(base, batch, ["id"]).count() == 100_000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    # One exchange of table rows, behind the look-up in the bits; the rows that surely match nothing have none.
    kept, rest = plan.split("SortMergeJoin")[1].split("Union")[0], plan
    assert "getbit" in kept and rest.count("Exchange hashpartitioning(id") == 1
    assert "BroadcastExchange" in rest


@pytest.mark.parametrize(
    "options",
    [{}, {"null_safe": True, "apply_deletes": True, "only_if_newer": "dms_commit_ts"}],
)
def test_merge_statement_is_valid_up_to_the_format(spark, options):
    """No format with MERGE is at hand: Parquet must be what it fails on, and only then."""
    table = MergeTable(spark, f"t_{random.randrange(10**12)}", "parquet")
    layout = f"{LAYOUT}, op string"
    policy = DatasetPolicy("t", keys=("k",), partitions=("st",))
    run_curate(spark.createDataFrame([(1, "01", "a", 1, "I")], layout), policy, table)
    assert table.read().count() == 1
    batch = spark.createDataFrame([(1, "01", "b", 2, "U")], layout)
    with pytest.raises(Exception, match="does not support MERGE"):
        run_curate(batch, policy, table, MergeOptions(**options))


def test_tables_may_become_empty_and_fill_again(spark, table, rows):
    layout = f"{LAYOUT}, op string"
    options = MergeOptions(apply_deletes=True)

    def run(*data):
        run_curate(spark.createDataFrame(list(data), layout), POLICY, table, options)

    run((1, "01", "gone", 1, "D"))
    assert table.exists() and table.read().isEmpty()
    run((1, "01", "a", 2, "I"), (2, "02", "b", 2, "I"))
    assert rows(table.read(), "k", "st") == [(1, "01"), (2, "02")]
    run((1, "01", "a", 3, "D"), (2, "01", "b", 3, "D"))
    assert table.read().isEmpty()
    run((3, "02", "c", 4, "I"))
    assert rows(table.read(), "k", "st", "v") == [(3, "02", "c")]


def test_partitions_of_other_types(spark, tmp_path, rows):
    layout = "k int, d date, n int, b boolean, dms_commit_ts int"
    table = PartitionedTable(
        spark, f"t_{random.randrange(10**12)}", f"{tmp_path}/t", ["d", "n", "b"]
    )
    policy = DatasetPolicy("t", keys=("k",), partitions=("d", "n", "b"))
    day = [DAY.date() + timedelta(days=i) for i in range(3)]
    first = [(1, day[0], 1, True, 1), (2, day[1], 2, False, 1), (3, None, None, None, 1)]
    run_curate(spark.createDataFrame(first, layout), policy, table)
    second = [(1, day[2], 7, False, 2), (3, day[0], 1, True, 2)]
    run_curate(spark.createDataFrame(second, layout), policy, table)
    expected = [(1, day[2], 7, False), (2, day[1], 2, False), (3, day[0], 1, True)]
    assert rows(table.read(), "k", "d", "n", "b") == expected
    assert spark.sql(f"show partitions {table.name}").count() == 3
