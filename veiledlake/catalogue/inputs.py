"""Inputs the test tables do not hold as such, each as a DataFrame and as SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from veiledlake.functions.tokens import KeyedTokens

TOKEN_KEY = "a key for trials, never for real data"
TOKENS = KeyedTokens(TOKEN_KEY)


def read(spark: SparkSession, sf: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{table}.parquet")


def hmac_sql(pii_type: str, value: str) -> str:
    """SQL for the keyed token of a value, empty for a blank one."""
    key = TOKEN_KEY.encode().ljust(64, b"\0")
    inner = bytes(b ^ 0x36 for b in key).hex()
    outer = bytes(b ^ 0x5C for b in key).hex()
    text = f"({value})::varchar"
    digest = f"sha256(unhex('{inner}') || encode('{pii_type}:' || {text}))"
    return (
        f"case when {text} is null or {text} = '' then '' "
        f"else sha256(unhex('{outer}') || unhex({digest})) end"
    )


# Line items as a change feed: the return flag is the operation, the ship date
# the commit time. A third of the line numbers is left out of NULL_KEY_FEED.
FEED_COLUMNS = (
    "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, "
    "l_discount, l_tax, l_linestatus"
)
FEED_SQL = f"""
    select case l_returnflag when 'A' then 'I' when 'N' then 'U' else 'D' end as op,
           {FEED_COLUMNS}, l_shipdate as dms_commit_ts
    from lineitem"""
FEED_KEY = ["l_orderkey", "l_linenumber"]
NULL_KEY_FEED_SQL = FEED_SQL.replace(
    "l_orderkey, l_linenumber,",
    "l_orderkey, case when l_returnflag <> 'R' then l_linenumber end as l_linenumber,",
)


def feed(spark: SparkSession, sf: str) -> DataFrame:
    op = F.when(F.col("l_returnflag") == "A", "I").when(F.col("l_returnflag") == "N", "U")
    return read(spark, sf, "lineitem").select(
        op.otherwise("D").alias("op"),
        *FEED_COLUMNS.split(", "),
        F.col("l_shipdate").alias("dms_commit_ts"),
    )


def null_key_feed(spark: SparkSession, sf: str) -> DataFrame:
    return feed(spark, sf).withColumn(
        "l_linenumber", F.when(F.col("op") != "D", F.col("l_linenumber"))
    )


def first_load(changes: DataFrame) -> DataFrame:
    return changes.filter("l_linestatus <=> 'F'")


def increment(changes: DataFrame) -> DataFrame:
    """All that ``first_load`` leaves."""
    return changes.filter("not l_linestatus <=> 'F'")


def latest_sql(source: str, key: str = "l_orderkey, l_linenumber") -> str:
    """SQL for the latest feed row per key."""
    return f"""
    select * from ({source}) qualify row_number() over (
        partition by {key}
        order by dms_commit_ts desc nulls first, op desc nulls last,
            l_partkey desc nulls last, l_suppkey desc nulls last, l_quantity desc nulls last,
            l_extendedprice desc nulls last, l_discount desc nulls last, l_tax desc nulls last,
            l_linestatus desc nulls last) = 1"""


def halves_sql(source: str = FEED_SQL) -> str:
    """SQL for the first load and the increment, one row per key each."""
    base = latest_sql(f"select * from ({source}) where l_linestatus is not distinct from 'F'")
    new = latest_sql(f"select * from ({source}) where l_linestatus is distinct from 'F'")
    return f"with base as ({base}), new as ({new})"


# A column list with one row per order: the customer is the table, the last digit
# of its key the schema. The priority names the column, the month gives its type.
# Columns of pending orders form the key; finished and open ones must be hashed
# or excluded.
NAMES = {
    "1-URGENT": "ssn",
    "2-HIGH": "emailaddr_txt",
    "3-MEDIUM": "ssn_id",
    "4-NOT SPECIFIED": "lnm",
    "5-LOW": "user_cd",
}
TYPES = (
    "bigint",
    "integer",
    "smallint",
    "bigserial",
    "numeric(12,2)",
    "numeric(8)",
    "numeric(14,0)",
    "character varying(30)",
    "timestamp(6)",
    "date",
    "decimal(9, 2)",
    "text",
)
COLUMNS_SQL = f"""
    select 'area' || right(o_custkey::varchar, 1) as schema, 'c' || o_custkey as "table",
           o_orderkey + 1 as ordinal,
           case o_orderpriority {" ".join(f"when '{p}' then '{n}'" for p, n in NAMES.items())} end
               || '_' || o_orderkey as "column",
           ({list(TYPES)})[month(o_orderdate)] as source_type,
           case when o_orderstatus = 'P' then o_orderkey + 1 end as pk_position,
           o_orderdate as since,
           case when o_totalprice < 50000 then null when o_totalprice > 450000 then 'Mask'
                when o_orderstatus = 'F' then 'Hash' when o_orderstatus = 'O' then 'Exclude'
                else 'None Required' end as requirement
    from orders"""
TABLES_SQL = """
    select 'area' || right(c_custkey::varchar, 1) as schema, 'c' || c_custkey as "table"
    from customer"""


def column_list(spark: SparkSession, sf: str) -> DataFrame:
    prefix, kind = F.lit(None).cast("string"), F.lit(None).cast("string")
    for priority, name in NAMES.items():
        prefix = F.when(F.col("o_orderpriority") == priority, name).otherwise(prefix)
    kind = F.element_at(F.array(*(F.lit(t) for t in TYPES)), F.month("o_orderdate"))
    requirement = (
        F.when(F.col("o_totalprice") < 50000, F.lit(None).cast("string"))
        .when(F.col("o_totalprice") > 450000, "Mask")
        .when(F.col("o_orderstatus") == "F", "Hash")
        .when(F.col("o_orderstatus") == "O", "Exclude")
        .otherwise("None Required")
    )
    place = F.col("o_orderkey") + 1
    return read(spark, sf, "orders").select(
        *table_of("o_custkey"),
        place.alias("ordinal"),
        F.concat_ws("_", prefix, "o_orderkey").alias("column"),
        kind.alias("source_type"),
        F.when(F.col("o_orderstatus") == "P", place).alias("pk_position"),
        F.col("o_orderdate").alias("since"),
        requirement.alias("requirement"),
    )


def columns(spark: SparkSession, sf: str) -> DataFrame:
    return column_list(spark, sf).drop("since", "requirement")


def requirements(spark: SparkSession, sf: str) -> DataFrame:
    return column_list(spark, sf).select("schema", "table", "column", "requirement")


def tables(spark: SparkSession, sf: str) -> DataFrame:
    return read(spark, sf, "customer").select(*table_of("c_custkey"))


def table_of(customer: str) -> list[Column]:
    digit = F.right(F.col(customer).cast("string"), F.lit(1))
    return [
        F.concat(F.lit("area"), digit).alias("schema"),
        F.concat(F.lit("c"), customer).alias("table"),
    ]
