"""Column steps and the whole clean hop."""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veiledlake.catalogue.inputs import TOKENS, hmac_sql, read
from veiledlake.catalogue.registry import query
from veiledlake.operators.latest import latest_per_key
from veiledlake.operators.shape import (
    exclude_columns,
    mask_dates,
    parse_dates,
    parse_timestamps,
    rename_columns,
    stamp_ingestion,
    strip_characters,
)
from veiledlake.plans.clean import clean, protect
from veiledlake.policy import DatasetPolicy

RUN_TS = datetime(2024, 6, 1, 6, 0, tzinfo=UTC)
RUN_EPOCH = 1717221600


@query("""
    select o_orderkey as order_id, o_custkey, o_orderstatus as status, o_totalprice, o_orderdate,
           o_orderpriority
    from orders""",
    name="rename_columns")
def rename_order_columns(spark: SparkSession, sf: str) -> DataFrame:
    renames = {"o_orderkey": "order_id", "O_ORDERSTATUS": "status", "absent": "x"}
    return rename_columns(read(spark, sf, "orders"), renames)


@query("select doc_id, lang, source, n_chars from documents", name="exclude_columns")
def exclude_free_text(spark: SparkSession, sf: str) -> DataFrame:
    return exclude_columns(read(spark, sf, "documents"), ["TEXT", "absent"])


@query("""
    select o_orderkey, regexp_replace(regexp_replace(o_orderpriority, ' ', '', 'g'), '-', '', 'g')
        as o_orderpriority
    from orders""",
    name="strip_characters")
def strip_priority(spark: SparkSession, sf: str) -> DataFrame:
    orders = read(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    return strip_characters(orders, {"o_orderpriority": [" ", "-"]})


@query("""
    select o_orderkey, case when o_orderstatus <> 'P' then o_orderdate::date end as o_orderdate
    from orders""",
    name="parse_dates")
def parse_order_dates(spark: SparkSession, sf: str) -> DataFrame:
    """Dates as text, those of pending orders in another format, which gives null."""
    day = F.when(F.col("o_orderstatus") == "P", F.date_format("o_orderdate", "dd/MM/yyyy"))
    text = day.otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    orders = read(spark, sf, "orders").select("o_orderkey", text.alias("o_orderdate"))
    return parse_dates(orders, {"O_ORDERDATE": "yyyy-MM-dd", "absent": "yyyy"})


@query("""
    select event_id, case when event_type <> 'error' then date_trunc('second', ts) end as ts
    from events""",
    name="parse_timestamps")
def parse_event_times(spark: SparkSession, sf: str) -> DataFrame:
    text = F.when(F.col("event_type") == "error", F.date_format("ts", "HH:mm yyyy")).otherwise(
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    )
    events = read(spark, sf, "events").select("event_id", text.alias("ts"))
    parsed = parse_timestamps(events, {"ts": "yyyy-MM-dd HH:mm:ss"})
    return parsed.withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@query(f"select event_id, user_id, {RUN_EPOCH}::bigint as ingested_epoch from events")
def audit_stamp(spark: SparkSession, sf: str) -> DataFrame:
    stamped = stamp_ingestion(read(spark, sf, "events"), RUN_TS)
    epoch = F.unix_timestamp("rec_ingested_dt").alias("ingested_epoch")
    return stamped.select("event_id", "user_id", epoch)


@query("select o_orderkey, date_trunc('month', o_orderdate)::date as o_orderdate from orders")
def mask_date_month(spark: SparkSession, sf: str) -> DataFrame:
    orders = read(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    return mask_dates(orders, ["o_orderdate"])


@query("select o_orderkey, date_trunc('decade', o_orderdate)::date as o_orderdate from orders")
def mask_date_decade(spark: SparkSession, sf: str) -> DataFrame:
    orders = read(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    return mask_dates(orders, ["o_orderdate"], keep="decade")


@query("select o_orderkey, date_trunc('year', o_orderdate)::date as o_orderdate from orders")
def mask_date_year(spark: SparkSession, sf: str) -> DataFrame:
    orders = read(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    return mask_dates(orders, ["o_orderdate"], keep="year")


@query(f"""
    select o_orderkey, {hmac_sql("case_id", "o_custkey")} as o_custkey, o_orderstatus,
           o_totalprice, date_trunc('month', o_orderdate)::date as o_orderdate, o_orderpriority
    from orders""")
def apply_pii_policy(spark: SparkSession, sf: str) -> DataFrame:
    policy = DatasetPolicy("orders", pii={"o_custkey": "case_id", "o_orderdate": "dob"})
    return protect(read(spark, sf, "orders"), policy, TOKENS)


ORDER_POLICY = DatasetPolicy(
    "orders",
    keys=("order_id",),
    renames={"o_orderkey": "order_id"},
    drops=("o_totalprice",),
    strips={"o_orderpriority": ("[0-9]", "-", " ")},
    dates={"paid": "yyyy-MM-dd"},
    pii={"o_custkey": "case_id", "o_orderpriority": "user_cd", "o_orderdate": "dob"},
)


@query(f"""
    select o_orderkey as order_id, {hmac_sql("case_id", "o_custkey")} as o_custkey, o_orderstatus,
           date_trunc('month', o_orderdate)::date as o_orderdate,
           {hmac_sql("user_cd", "regexp_replace(o_orderpriority, '[0-9]|-| ', '', 'g')")}
               as o_orderpriority,
           case when o_orderstatus <> 'P' then o_orderdate::date end as paid,
           {RUN_EPOCH}::bigint as ingested_epoch
    from orders""")
def clean_dataset(spark: SparkSession, sf: str) -> DataFrame:
    """All steps of the clean hop on one table, in one plan without a shuffle."""
    day = F.when(F.col("o_orderstatus") == "P", F.lit("pending"))
    paid = day.otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    orders = read(spark, sf, "orders").withColumn("paid", paid)
    cleaned = clean(orders, ORDER_POLICY, TOKENS, RUN_TS)
    epoch = F.unix_timestamp("rec_ingested_dt")
    return cleaned.withColumn("ingested_epoch", epoch).drop("rec_ingested_dt")


LINE_POLICY = DatasetPolicy(
    "lineitem",
    keys=("l_orderkey", "l_linenumber"),
    pii={"l_suppkey": "case_id", "shipped": "dob"},
    drops=("l_tax",),
)


@query(f"""
    select l_orderkey, l_partkey, {hmac_sql("case_id", "l_suppkey")} as l_suppkey, l_linenumber,
           l_quantity, l_extendedprice, l_discount, l_returnflag, l_linestatus, l_shipdate,
           date_trunc('month', l_shipdate)::date as shipped
    from lineitem
    qualify row_number() over (
        partition by l_orderkey, l_linenumber
        order by l_shipdate desc nulls first, l_partkey desc nulls last,
            {hmac_sql("case_id", "l_suppkey")} desc nulls last, l_quantity desc nulls last,
            l_extendedprice desc nulls last, l_discount desc nulls last,
            l_returnflag desc nulls last, l_linestatus desc nulls last) = 1""")
def clean_latest(spark: SparkSession, sf: str) -> DataFrame:
    """Both hops on line items: clean them, then keep the latest row of each key."""
    lines = read(spark, sf, "lineitem").withColumn("shipped", F.col("l_shipdate"))
    cleaned = clean(lines, LINE_POLICY, TOKENS, RUN_TS).drop("rec_ingested_dt")
    return latest_per_key(cleaned, LINE_POLICY.keys, "l_shipdate")
