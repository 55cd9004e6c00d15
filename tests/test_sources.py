import pytest

from veiledlake.operators.vault import SCHEMA
from veiledlake.plans.fan_out import for_each_dataset
from veiledlake.policy import DatasetPolicy
from veiledlake.sinks.catalog import declare_table, sync_catalog
from veiledlake.sinks.clean import append_parquet
from veiledlake.sources.batch import fan_out, read_requirements, scan_dataset, select_tables
from veiledlake.sources.incremental import read_new
from veiledlake.storage import create_text, read_text, work_folder


def test_scan_by_table_or_path(spark, tmp_path, rows):
    spark.createDataFrame([(1, "01")], "a int, st string").write.partitionBy("st").parquet(f"{tmp_path}/t")
    assert rows(scan_dataset(spark, path=f"{tmp_path}/t", schema="a int, st string")) == [(1, "01")]
    declare_table(spark, "scanned", "a int, st string", f"{tmp_path}/t", ("st",))
    assert rows(scan_dataset(spark, table="scanned")) == [(1, "01")]
    with pytest.raises(ValueError):
        scan_dataset(spark)


def test_scan_reads_only_needed_columns_and_pushes_filters(spark, tmp_path):
    spark.range(10).selectExpr("id", "id as a", "id as b").write.parquet(f"{tmp_path}/t")
    df = scan_dataset(spark, path=f"{tmp_path}/t").filter("a > 3").select("id")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<id:bigint,a:bigint>" in plan and "GreaterThan(a,3)" in plan


SHEET = (
    "Approved requirements,,,,\n"
    "Schema,No,Table,Column,Final De-ID Requirement\n"
    'desk,1,card,card_nm,Exclude\ndesk,2,card,"a, b",\n'
)


def test_requirement_sheet_with_banner(spark, tmp_path, rows):
    (tmp_path / "sheet.csv").write_text(SHEET)
    found = read_requirements(spark, f"{tmp_path}/sheet.csv")
    assert found.columns == ["schema", "table", "column", "requirement"]
    assert rows(found) == [("desk", "card", "a, b", None), ("desk", "card", "card_nm", "Exclude")]
    (tmp_path / "plain.csv").write_text(SHEET.split("\n", 1)[1])
    assert rows(read_requirements(spark, f"{tmp_path}/plain.csv", banner=False)) == rows(found)
    with pytest.raises(ValueError, match="Schema"):
        read_requirements(spark, f"{tmp_path}/plain.csv")


def test_sheets_with_columns_in_another_order(spark, tmp_path, rows):
    """Headings go by their place in each file; a row of data may hold some of their words."""
    (tmp_path / "s").mkdir()
    (tmp_path / "s/a.csv").write_text("One,,\nSchema,Table,Column,Final De-ID Requirement\ns,Table,Column,Hash\n")
    (tmp_path / "s/b.csv").write_text(
        "Two, by others\nNo,Final De-ID Requirement,Column,Table,Schema,Remark\n"
        '1,,"c, d",t,s,\n2,Exclude,Schema,Table,s,"Column, Final De-ID Requirement"\n'
    )
    (tmp_path / "s/c.csv").write_text("Three\n")
    (tmp_path / "s/d.csv").write_text("")
    wanted = [("s", "Table", "Column", "Hash"), ("s", "Table", "Schema", "Exclude"), ("s", "t", "c, d", None)]
    assert sorted(rows(read_requirements(spark, f"{tmp_path}/s")), key=str) == sorted(wanted, key=str)
    (tmp_path / "s/e.csv").write_text("Four\nSchema,Table,Column\ns,t,c\n")
    with pytest.raises(ValueError, match="e.csv lacks the headings .*Final De-ID Requirement"):
        read_requirements(spark, f"{tmp_path}/s")


def test_select_and_fan_out(spark, rows):
    tables = spark.createDataFrame([("desk", "a"), ("desk", "b_ref"), ("comm", "a")], "schema string, table string")
    assert rows(select_tables(tables, "desk", "%_ref")) == [("desk", "b_ref")]
    assert len(rows(select_tables(tables, "desk"))) == 2
    policies = spark.createDataFrame([("desk_a", 1), ("comm_a", 2), ("comm_x", 3)], "dataset string, n int")
    assert rows(fan_out(tables, policies), "dataset", "n") == [("comm_a", 2), ("desk_a", 1)]


def test_each_file_is_read_once(spark, tmp_path):
    seen = []

    def run():
        def handle(batch, reader, number):
            seen.append((reader, number, sorted(r["id"] for r in batch.collect())))

        read_new(spark, f"{tmp_path}/in", "id long", f"{tmp_path}/cp", handle)

    spark.range(3).coalesce(1).write.parquet(f"{tmp_path}/in")
    run()
    run()
    spark.range(3, 5).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    run()
    assert [s[1:] for s in seen] == [(0, [0, 1, 2]), (1, [3, 4])]
    assert len({s[0] for s in seen}) == 1


def test_failed_batch_is_handed_over_again(spark, tmp_path):
    spark.range(3).write.parquet(f"{tmp_path}/in")
    seen = []

    def handle(batch, reader, number):
        seen.append((reader, number, batch.count()))
        if len(seen) == 1:
            raise RuntimeError("lost")

    for _ in range(2):
        try:
            read_new(spark, f"{tmp_path}/in", "id long", f"{tmp_path}/cp", handle)
        except Exception as error:
            assert "lost" in str(error)
    assert len(seen) == 2 and seen[0] == seen[1] and seen[0][1:] == (0, 3)


def test_append_registers_table_and_new_partitions(spark, tmp_path, rows):
    for st in ("01", "02"):
        df = spark.createDataFrame([(1, st)], "a int, st string")
        append_parquet(df, f"{tmp_path}/t", ["st"], "appended")
    assert rows(spark.table("appended")) == [(1, "01"), (1, "02")]
    assert rows(spark.sql("show partitions appended")) == [("st=01",), ("st=02",)]
    assert all(f.endswith(".snappy.parquet") for f in spark.table("appended").inputFiles())


def test_large_partition_is_written_by_several_tasks(spark, tmp_path):
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64KB")
    try:
        df = spark.range(0, 200000, 1, 8).selectExpr("uuid() as v", "if(id % 10 < 9, 'big', 'small') as st")
        append_parquet(df, f"{tmp_path}/t", ["st"])
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    big = list((tmp_path / "t" / "st=big").glob("*.parquet"))
    assert len(big) > 4


def test_catalog_follows_the_files(spark, tmp_path, rows):
    path = f"{tmp_path}/t"
    spark.createDataFrame([(1, "x", "01")], "a int, b string, st string").write.partitionBy("st").parquet(path)
    assert len(sync_catalog(spark, "crawled", path, ("st",))) == 3
    assert sync_catalog(spark, "crawled", path, ("st",)) == []
    spark.createDataFrame([(1, 2.5, "02")], "a long, c double, st string").write.mode("overwrite").partitionBy(
        "st"
    ).parquet(path)
    changes = sync_catalog(spark, "crawled", path, ("st",))
    found = sorted((r["column"], r["change"]) for r in changes)
    assert found == [("a", "retyped"), ("b", "removed"), ("c", "added")]
    assert rows(spark.table("crawled"), "a", "c") == [(1, 2.5)]


def test_fan_out_keeps_going_after_a_failure():
    def job(policy):
        if policy.table == "b":
            raise RuntimeError("no luck")
        return policy.table.upper()

    done = for_each_dataset([DatasetPolicy(t) for t in "abc"], job, workers=2)
    assert done["a"] == "A" and done["c"] == "C" and isinstance(done["b"], RuntimeError)


def test_work_folder_follows_the_session(spark):
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is not None:
        assert work_folder(spark).startswith(base.rstrip("/"))
    assert work_folder(spark) != work_folder(spark)


def test_small_files_are_never_replaced(spark, tmp_path):
    create_text(spark, f"{tmp_path}/d/x", "größe")
    assert read_text(spark, f"{tmp_path}/d/x") == "größe"
    with pytest.raises(FileExistsError):
        create_text(spark, f"{tmp_path}/d/x", "b")


def test_vault_layout_is_plain_parquet():
    assert SCHEMA.split(", ")[:2] == ["pii_type string", "pii_value string"]
