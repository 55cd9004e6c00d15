import re
import time
from datetime import UTC, datetime

import pytest
from pyspark.sql import functions as F

from veiledlake.operators.vault import (
    SCHEMA,
    BatchTokens,
    absent_values,
    batch_values,
    find_tokens,
    resolve_conflicts,
    tokenise_from_vault,
)
from veiledlake.plans.clean import run_clean
from veiledlake.policy import DatasetPolicy
from veiledlake.sources.vault import Vault

T1, T2 = datetime(2024, 1, 1, tzinfo=UTC), datetime(2024, 1, 2, tzinfo=UTC)
CELLS = "pii_type string, pii_value string, cells long"


@pytest.fixture
def vault(spark, tmp_path):
    return Vault(spark, f"{tmp_path}/vault")


def test_batch_values_are_distinct_by_type_and_not_blank(spark, rows):
    df = spark.createDataFrame(
        [("1234", 1234, "Doe"), ("1234", None, ""), (None, 5, "Doe")], "a string, b int, c string"
    )
    found = batch_values(df, {"a": "ssn", "b": "case_id", "c": "person_nm"})
    assert rows(found) == [
        ("case_id", "1234", 1),
        ("case_id", "5", 1),
        ("person_nm", "Doe", 2),
        ("ssn", "1234", 2),
    ]


def test_lookup_and_absent(spark, rows):
    values = spark.createDataFrame([("ssn", "1", 1), ("ssn", "2", 1)], CELLS)
    held = spark.createDataFrame([("ssn", "1", "t", T1), ("fein", "2", "u", T1)], SCHEMA)
    assert rows(absent_values(values, held)) == [("ssn", "2")]
    assert rows(find_tokens(values, held)) == [("ssn", "1", "t", 1), ("ssn", "2", None, 1)]


def test_earliest_entry_wins_a_conflict(spark, rows):
    held = spark.createDataFrame(
        [("ssn", "1", "a", T2), ("ssn", "1", "c", T1), ("ssn", "1", "b", T1), ("ssn", "2", "z", T2)],
        SCHEMA,
    )
    assert rows(resolve_conflicts(held), "pii_value", "token") == [("1", "b"), ("2", "z")]
    values = spark.createDataFrame([("ssn", "1", 7)], CELLS)
    assert rows(find_tokens(values, held)) == [("ssn", "1", "b", 7)]


def test_tokens_are_random_stable_and_one_per_value(spark, vault, tmp_path):
    pii = {"ssn": "ssn", "case": "case_id"}
    df = spark.createDataFrame([("1234", "1234"), ("1234", None), ("99", "")], "ssn string, case string")
    first = {tuple(r)[:2]: r["token"] for r in vault.tokens_for(df, pii, T1, f"{tmp_path}/a").tokens.collect()}
    more = df.unionAll(spark.createDataFrame([("5", "6")], df.schema))
    again = {tuple(r)[:2]: r["token"] for r in vault.tokens_for(more, pii, T2, f"{tmp_path}/b").tokens.collect()}
    assert set(first) == {("ssn", "1234"), ("ssn", "99"), ("case_id", "1234")}
    assert first.items() <= again.items() and len(again) == 5
    assert len(set(again.values())) == 5
    assert all(len(t) == 64 and int(t, 16) >= 0 for t in again.values())
    assert vault.read().count() == 5
    other = Vault(spark, f"{tmp_path}/other").tokens_for(df, pii, T1, f"{tmp_path}/c")
    assert not set(first.values()) & {r["token"] for r in other.tokens.collect()}


def test_read_back_opens_only_new_files(spark, vault, tmp_path):
    assert vault.last_change(["ssn"]) == 0
    entry = spark.createDataFrame([("ssn", "1", "t", T1)], SCHEMA)
    vault.add(entry)
    first = vault.last_change(["ssn", "fein"])
    time.sleep(1.1)
    vault.add(spark.createDataFrame([("ssn", "2", "u", T1), ("fein", "3", "v", T1)], SCHEMA))
    assert vault.last_change(["ssn"]) > first > vault.last_change(["email"]) == 0
    later = vault.read(["ssn"], since=first + 1)
    assert [r["pii_value"] for r in later.collect()] == ["2"]
    assert vault.read(["ssn"], since=first).count() == 2
    scan = later._jdf.queryExecution().executedPlan().collectLeaves().apply(0)
    assert scan.metrics().get("numFiles").get().value() == 1


def test_entry_another_run_added_meanwhile_is_respected(spark, vault, tmp_path, monkeypatch):
    """The token of the earlier entry is used, though this run made one of its own."""
    df = spark.createDataFrame([("1",), ("2",)], "ssn string")
    real = Vault.add

    def add_after_another_run(self, entries):
        real(self, spark.createDataFrame([("ssn", "1", "theirs", T1)], SCHEMA))
        real(self, entries)

    monkeypatch.setattr(Vault, "add", add_after_another_run)
    tokens = vault.tokens_for(df, {"ssn": "ssn"}, T2, f"{tmp_path}/work").tokens
    found = {r["pii_value"]: r["token"] for r in tokens.collect()}
    assert found["1"] == "theirs" and len(found["2"]) == 64


ROWS = [(i, None if i % 7 == 0 else "hot" if i % 3 else f"v{i % 11}", i % 5) for i in range(2000)]


@pytest.mark.parametrize("limit", [1 << 20, 1000, 0])
@pytest.mark.parametrize("blank", ["empty", "null"])
def test_both_join_strategies_give_the_same(spark, tmp_path, limit, blank):
    df = spark.createDataFrame(ROWS, "id int, name string, n int").repartition(4)
    pii = {"name": "person_nm", "n": "case_id"}
    vault = Vault(spark, f"{tmp_path}/vault", blank)
    batch = vault.tokens_for(df, pii, T1, f"{tmp_path}/work")
    assert set(batch.bytes_by_type) == {"person_nm", "case_id"}
    assert batch.cells == sum(r[1] is not None for r in ROWS) + len(ROWS)
    known = {tuple(r)[:2]: r["token"] for r in batch.tokens.collect()}
    done = tokenise_from_vault(df, pii, batch, broadcast_bytes=limit, hot_share=0.1)
    assert done.columns == df.columns
    none = "" if blank == "empty" else None
    expected = [
        (i, none if name is None else known["person_nm", name], known["case_id", str(n)])
        for i, name, n in ROWS
    ]
    assert sorted(tuple(r) for r in done.collect()) == sorted(expected)
    added = tokenise_from_vault(df, pii, batch, suffix="_hash", broadcast_bytes=limit)
    assert added.columns == ["id", "name", "n", "name_hash", "n_hash"]
    assert added.select("id", "name", "n").exceptAll(df).isEmpty()
    kept = added.select("id", "name_hash", "n_hash")
    assert sorted(tuple(r) for r in kept.collect()) == sorted(expected)


def test_value_without_token_raises(spark):
    tokens = spark.createDataFrame([("ssn", "1", "t", 1)], "pii_type string, pii_value string, token string, cells long")
    df = spark.createDataFrame([("1",), ("2",)], "ssn string")
    for limit in (1 << 20, 0):
        done = tokenise_from_vault(df, {"ssn": "ssn"}, BatchTokens(tokens, 1, {"ssn": 200}), broadcast_bytes=limit)
        with pytest.raises(Exception, match="no token for a value of ssn"):
            done.collect()


def test_shuffled_join_spreads_hot_and_blank_rows(spark, tmp_path):
    """No join partition may hold the rows of the hot value, nor all blank rows."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        value = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.concat(F.lit("v"), F.col("id")))
        df = spark.range(0, 30000, 1, 4).select("id", value.alias("name"))
        pii = {"name": "person_nm"}
        batch = Vault(spark, f"{tmp_path}/vault").tokens_for(df, pii, T1, f"{tmp_path}/work")
        done = tokenise_from_vault(df, pii, batch, broadcast_bytes=0, hot_share=0.1)
        sizes = [r["count"] for r in done.groupBy(F.spark_partition_id()).count().collect()]
        plan = done._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10485760")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert "SortMergeJoin" in plan and sum(sizes) == 30000
    assert len(sizes) == 16 and max(sizes) < 2 * 30000 / 16


def large_batch(spark, n=400):
    """Rows with a wide column and three large PII columns, two of them of one type; nulls, blanks, repeated rows."""
    df = spark.range(0, n, 1, 4).select(
        (F.col("id") % 150).alias("id"),
        F.repeat((F.col("id") % 150).cast("string"), 20).alias("payload"),
        F.when(F.col("id") % 7 > 0, F.concat(F.lit("a"), F.col("id") % 150)).alias("a"),
        F.when(F.col("id") % 5 == 0, "").otherwise((F.col("id") % 50).cast("string")).alias("b"),
        F.when(F.col("id") % 7 > 0, (F.col("id") % 30).cast("string")).alias("c"),
    )
    pii = {"a": "person_nm", "b": "ssn", "c": "ssn"}
    tokens = batch_values(df, pii).select(
        "*", F.concat_ws("/", "pii_type", "pii_value").alias("token")
    )
    return df, pii, BatchTokens(tokens, 3 * n, dict.fromkeys(["person_nm", "ssn"], 10**9))


def test_cells_of_several_large_columns_meet_their_tokens(spark, rows):
    df, pii, batch = large_batch(spark)

    def expected(c, t):
        blank = F.col(c).isNull() | (F.col(c) == "")
        return F.when(blank, "").otherwise(F.concat_ws("/", F.lit(t), F.col(c))).alias(c)

    wanted = rows(df.select("id", "payload", *(expected(c, t) for c, t in pii.items())))
    for share in (1, 1 / 100):
        done = tokenise_from_vault(df, pii, batch, broadcast_bytes=0, hot_share=share)
        assert rows(done) == wanted
    added = tokenise_from_vault(df, pii, batch, suffix="_hash", broadcast_bytes=0, hot_share=1)
    assert rows(added.drop("a_hash", "b_hash", "c_hash")) == rows(df)
    assert rows(added.select("id", "payload", "a_hash", "b_hash", "c_hash")) == wanted
    gone = BatchTokens(batch.tokens.filter("pii_value <> '7'"), batch.cells, batch.bytes_by_type)
    with pytest.raises(Exception, match="no token for a value of [bc]"):
        tokenise_from_vault(df, pii, gone, broadcast_bytes=0, hot_share=1).collect()
    assert rows(tokenise_from_vault(df.limit(0), pii, batch, broadcast_bytes=0)) == []


def test_wide_rows_are_shuffled_once_for_all_large_columns(spark):
    df, pii, batch = large_batch(spark)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        done = tokenise_from_vault(df, pii, batch, broadcast_bytes=0)
        query = done._jdf.queryExecution()
        plan = query.explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10485760")
    shuffles = re.findall(r"\) Exchange\nInput \[\d+\]: \[(.*)\]", plan)
    assert len(shuffles) > 2 and sum("payload#" in columns for columns in shuffles) == 1


def test_no_value_in_clear_and_joins_survive(spark, vault, tmp_path):
    people = DatasetPolicy("people", keys=("ssn",), pii={"ssn": "ssn", "lnm": "person_nm"})
    cases = DatasetPolicy("cases", keys=("id",), pii={"owner_ssn": "ssn"}, strips={"owner_ssn": ("-",)})
    p = spark.createDataFrame([(f"90000{i}", f"Name{i % 3}") for i in range(50)], "ssn string, lnm string")
    c = spark.createDataFrame([(i, f"900-00{i % 50}") for i in range(200)], "id int, owner_ssn string")
    run_clean(p, people, f"{tmp_path}/p", vault)
    run_clean(c, cases, f"{tmp_path}/c", vault)
    p2, c2 = spark.read.parquet(f"{tmp_path}/p"), spark.read.parquet(f"{tmp_path}/c")
    assert c2.join(p2, c2["owner_ssn"] == p2["ssn"]).count() == 200
    assert p2.select("lnm").distinct().count() == 3
    assert p2.join(p, "ssn").count() == 0 and p2.join(p, "lnm").count() == 0


def test_work_folder_with_clear_values_is_deleted(spark, vault, tmp_path, monkeypatch):
    from veiledlake import storage

    monkeypatch.setattr(storage, "work_folder", lambda _: f"{tmp_path}/work")
    policy = DatasetPolicy("p", pii={"ssn": "ssn"})
    run_clean(spark.createDataFrame([("1",)], "ssn string"), policy, f"{tmp_path}/p", vault)
    assert not (tmp_path / "work").exists()


def test_batch_with_blank_values_only(spark, vault, tmp_path):
    policy = DatasetPolicy("p", pii={"ssn": "ssn"})
    blank = spark.createDataFrame([(None, 1), ("", 2)], "ssn string, n int").repartition(2)
    report = run_clean(blank, policy, f"{tmp_path}/p", vault)
    assert (report.rows, report.blanks) == (2, {"ssn": 2})
    assert [r["ssn"] for r in spark.read.parquet(f"{tmp_path}/p").collect()] == ["", ""]
    assert vault.read().isEmpty()
