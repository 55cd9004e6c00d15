"""Reading, incremental reading, and writing."""

from __future__ import annotations

import uuid
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veiledlake.catalogue.inputs import (
    COLUMNS_SQL,
    FEED_SQL,
    TABLES_SQL,
    TOKENS,
    column_list,
    columns,
    feed,
    first_load,
    hmac_sql,
    increment,
    latest_sql,
    read,
    requirements,
    tables,
)
from veiledlake.catalogue.registry import query
from veiledlake.operators.feed import count_operations, stamp_full_load
from veiledlake.operators.governance import policy_with_keys
from veiledlake.plans.curate import run_curate
from veiledlake.policy import DatasetPolicy
from veiledlake.sinks.catalog import sync_catalog
from veiledlake.sinks.clean import append_parquet
from veiledlake.sinks.curated import BucketTable, PartitionedTable
from veiledlake.sources.batch import fan_out, read_requirements, scan_dataset, select_tables
from veiledlake.sources.incremental import read_new
from veiledlake.storage import work_folder
from veiledlake.streaming.jobs import read_clean, stream_clean, stream_curate

ORDERS = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority"
CUSTOMER = "c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment"


@query(f"select {ORDERS} from orders", name="scan_dataset")
def scan_orders(spark: SparkSession, sf: str) -> DataFrame:
    schema = read(spark, sf, "orders").schema
    return scan_dataset(spark, path=f"{sf}/orders.parquet", schema=schema)


@query(f"select {ORDERS}, case when o_orderstatus is not distinct from 'F' then 1 else 2 end as run_no from orders")
def incremental_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Two files drops, three runs: each row must be read by the run after its drop, once."""
    orders = read(spark, sf, "orders")
    folder = work_folder(spark)

    def read_drop(run_no: int) -> None:
        def handle(batch: DataFrame, reader: str, number: int) -> None:
            target = f"{folder}/seen/run_no={run_no}/batch={reader}-{number}"
            batch.write.mode("overwrite").parquet(target)

        read_new(spark, f"{folder}/landing", orders.schema, f"{folder}/checkpoint", handle)

    orders.filter("o_orderstatus <=> 'F'").write.parquet(f"{folder}/landing")
    read_drop(1)
    orders.filter("not o_orderstatus <=> 'F'").write.mode("append").parquet(f"{folder}/landing")
    read_drop(2)
    read_drop(3)
    return spark.read.parquet(f"{folder}/seen").drop("batch")


@query(f"select op, count(*) as n_rows from ({FEED_SQL}) group by op")
def cdc_feed_read(spark: SparkSession, sf: str) -> DataFrame:
    return count_operations(feed(spark, sf))


@query(
    f"select 'I' as op, {CUSTOMER}, 1704067200::bigint as commit_epoch from customer",
    name="stamp_full_load",
)
def stamp_customers(spark: SparkSession, sf: str) -> DataFrame:
    stamped = stamp_full_load(read(spark, sf, "customer"), datetime(2024, 1, 1, tzinfo=UTC))
    epoch = F.unix_timestamp("dms_commit_ts").alias("commit_epoch")
    return stamped.select("op", *CUSTOMER.split(", "), epoch)


@query(
    f"""select * from ({TABLES_SQL}) where schema = 'area3' and "table" like 'c%'""",
    name="select_tables",
)
def select_schema_tables(spark: SparkSession, sf: str) -> DataFrame:
    return select_tables(tables(spark, sf), "area3", "c%")


@query(f"""
    select t.schema || '_' || t."table" as dataset, t.schema, t."table", n_keys
    from ({TABLES_SQL}) t join (
        select schema, "table", count(pk_position) as n_keys from ({COLUMNS_SQL})
        group by all having count(pk_position) > 0) using (schema, "table")""")
def fan_out_plan(spark: SparkSession, sf: str) -> DataFrame:
    keyed = policy_with_keys(columns(spark, sf), requirements(spark, sf))
    policies = keyed.select(F.concat_ws("_", "schema", "table").alias("dataset"), "n_keys")
    return fan_out(tables(spark, sf), policies)


@query(
    f'select schema, "table", "column", requirement from ({COLUMNS_SQL})',
    name="read_requirements",
)
def read_requirement_sheet(spark: SparkSession, sf: str) -> DataFrame:
    """Sheets by area, each below a banner of its own and with its columns in another order."""
    folder, listed = work_folder(spark), column_list(spark, sf)
    values = {
        "No": F.col("ordinal").cast("string"),
        "Schema": F.col("schema"),
        "Table": F.col("table"),
        "Column": F.col("column"),
        "Final De-ID Requirement": F.col("requirement"),
    }
    headings = spark.range(1).select(F.lit(0).alias("place"), *(F.lit(h).alias(h) for h in values))
    for sheet, order in enumerate([list(values), [*reversed(values)]]):
        rows = listed.filter(F.pmod("ordinal", F.lit(2)) == sheet)
        rows = rows.select(F.lit(1).alias("place"), *(v.alias(h) for h, v in values.items()))
        # The heading of the file is the banner, and the headings are its first row.
        filed = headings.unionByName(rows).coalesce(1).sortWithinPartitions("place").select(*order)
        titled = filed.toDF(f"Approved {sheet}", *(f"note {i}" for i in range(1, len(order))))
        titled.write.option("header", True).csv(f"{folder}/{sheet}")
    return read_requirements(spark, f"{folder}/*")


@query(f"select {CUSTOMER} from customer")
def clean_append_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    customer, folder = read(spark, sf, "customer"), work_folder(spark)
    owing = F.coalesce(F.col("c_acctbal") < 0, F.lit(False))
    append_parquet(customer.filter(owing), folder, ["c_mktsegment"])
    append_parquet(customer.filter(~owing), folder, ["c_mktsegment"])
    return spark.read.schema(customer.schema).parquet(folder)


@query(f"select {CUSTOMER} from customer")
def catalog_register(spark: SparkSession, sf: str) -> DataFrame:
    customer, name = read(spark, sf, "customer"), f"customer_{uuid.uuid4().hex}"
    folder = work_folder(spark)
    owing = F.coalesce(F.col("c_acctbal") < 0, F.lit(False))
    append_parquet(customer.filter(owing), folder, ["c_nationkey"], name)
    append_parquet(customer.filter(~owing), folder, ["c_nationkey"], name)
    return scan_dataset(spark, table=name)


@query(f"""
    select {ORDERS}, case when o_orderstatus is distinct from 'F' then upper(o_orderpriority) end
        as urgency
    from orders""")
def catalog_sync(spark: SparkSession, sf: str) -> DataFrame:
    """Files of a second schema arrive; the catalog entry that follows them shows the new column of all."""
    folder, name = work_folder(spark), f"orders_{uuid.uuid4().hex}"
    orders, done = read(spark, sf, "orders"), F.col("o_orderstatus").eqNullSafe("F")
    orders.filter(done).write.parquet(folder)
    sync_catalog(spark, name, folder)
    later = orders.filter(~done).withColumn("urgency", F.upper("o_orderpriority"))
    later.write.mode("append").parquet(folder)
    changes = sync_catalog(spark, name, folder)
    if [(r["column"], r["change"]) for r in changes] != [("urgency", "added")]:
        raise AssertionError(f"the entry changed by {changes}")
    return scan_dataset(spark, table=name)


@query(f"select {ORDERS} from orders")
def empty_batch_guard(spark: SparkSession, sf: str) -> DataFrame:
    """An empty batch leaves a table as it is."""
    orders, target = read(spark, sf, "orders"), BucketTable(spark, work_folder(spark), ["o_orderkey"])
    policy = DatasetPolicy("orders", keys=("o_orderkey",))
    run_curate(orders, policy, target)
    if run_curate(orders.filter("o_orderkey < 0"), policy, target).written:
        raise AssertionError("an empty batch was written")
    return target.read()


@query(f"select {CUSTOMER} from customer")
def curated_first_load(spark: SparkSession, sf: str) -> DataFrame:
    target = BucketTable(spark, work_folder(spark), ["c_custkey"])
    run_curate(read(spark, sf, "customer"), DatasetPolicy("customer", ("c_custkey",)), target)
    return target.read()


@query(latest_sql(FEED_SQL))
def curated_first_load_partitioned(spark: SparkSession, sf: str) -> DataFrame:
    policy = DatasetPolicy("feed", ("l_orderkey", "l_linenumber"), ("op",))
    target = PartitionedTable(spark, f"feed_{uuid.uuid4().hex}", work_folder(spark), ["op"])
    run_curate(feed(spark, sf), policy, target)
    return target.read()


LINE_POLICY = DatasetPolicy(
    "lines",
    keys=("l_orderkey", "l_linenumber"),
    partitions=("l_linestatus",),
    pii={"l_suppkey": "case_id", "l_partkey": "fein"},
    drops=("l_tax", "l_discount"),
)
CLEAN_LINES_SQL = f"""
    select op, l_orderkey, l_linenumber, {hmac_sql("fein", "l_partkey")} as l_partkey,
           {hmac_sql("case_id", "l_suppkey")} as l_suppkey, l_quantity, l_extendedprice,
           l_linestatus, dms_commit_ts
    from ({FEED_SQL})"""



@query(CLEAN_LINES_SQL, name="stream_clean")
def stream_clean_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Clean files as they arrive, in several runs; each row must come out once."""
    changes, folder = feed(spark, sf), work_folder(spark)

    def run() -> None:
        stream_clean(
            spark,
            f"{folder}/landing",
            changes.schema,
            LINE_POLICY,
            f"{folder}/clean",
            f"{folder}/checkpoint",
            TOKENS,
        )

    for part in (first_load(changes), increment(changes)):
        part.write.mode("append").parquet(f"{folder}/landing")
        run()
    run()
    stored = spark.read.parquet(f"{folder}/clean").drop("ingest_batch").schema
    return read_clean(spark, f"{folder}/clean", stored).drop("rec_ingested_dt")


LATEST_OF_DROPS_SQL = f"""
    with two as (select * from ({FEED_SQL})),
    base as ({latest_sql("select * from two where l_linestatus is not distinct from 'F'")}),
    new as ({latest_sql("select * from two where l_linestatus is distinct from 'F'")})
    select * from new
    union all
    select base.* from base anti join new using (l_orderkey, l_linenumber)"""


@query(LATEST_OF_DROPS_SQL)
def stream_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """Merge files as they arrive; the later drop wins."""
    changes, folder = feed(spark, sf), work_folder(spark)
    policy = DatasetPolicy("feed", ("l_orderkey", "l_linenumber"))
    target = BucketTable(spark, f"{folder}/curated", policy.keys)

    def run() -> None:
        stream_curate(
            spark, f"{folder}/landing", changes.schema, policy, target, f"{folder}/checkpoint"
        )

    for drop, part in enumerate((first_load(changes), increment(changes))):
        part.write.mode("append").parquet(f"{folder}/landing/ingest_batch={drop}")
        run()
    run()
    return target.read()
