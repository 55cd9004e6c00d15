"""Tokens: keyed, and random from a vault.

Random tokens differ from run to run, so the vault queries return what must
hold for any tokens: how many there are, and what can be joined through them.
"""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veiledlake.catalogue.inputs import TOKENS, hmac_sql, read
from veiledlake.catalogue.registry import query
from veiledlake.operators.shape import tokenise_keyed
from veiledlake.operators.vault import (
    absent_values,
    batch_values,
    find_tokens,
    resolve_conflicts,
    tokenise_from_vault,
)
from veiledlake.plans.clean import run_clean
from veiledlake.policy import DatasetPolicy
from veiledlake.sources.vault import Vault
from veiledlake.storage import work_folder

RUN_TS = datetime(2024, 6, 1, 6, 0, tzinfo=UTC)

# A vault that holds the customers without debts, under their keyed tokens.
VAULT_SQL = f"""
    select 'case_id' as pii_type, c_custkey::varchar as pii_value,
           {hmac_sql("case_id", "c_custkey")} as token
    from customer where c_acctbal >= 0"""
ORDER_VALUES_SQL = """
    select 'case_id' as pii_type, o_custkey::varchar as pii_value, count(*) as cells
    from orders group by o_custkey"""


def customer_vault(spark: SparkSession, sf: str) -> DataFrame:
    holders = read(spark, sf, "customer").filter("c_acctbal >= 0")
    return holders.select(
        F.lit("case_id").alias("pii_type"),
        F.col("c_custkey").cast("string").alias("pii_value"),
        TOKENS.column(F.col("c_custkey"), "case_id").alias("token"),
        F.lit(RUN_TS).alias("created_ts"),
    )


def order_values(spark: SparkSession, sf: str) -> DataFrame:
    return batch_values(read(spark, sf, "orders"), {"o_custkey": "case_id"})


@query(f"""
    select pii_type, pii_value, cells, token
    from ({ORDER_VALUES_SQL}) left join ({VAULT_SQL}) using (pii_type, pii_value)""")
def token_lookup(spark: SparkSession, sf: str) -> DataFrame:
    return find_tokens(order_values(spark, sf), customer_vault(spark, sf))


@query(f"""
    select pii_type, pii_value from ({ORDER_VALUES_SQL})
    anti join ({VAULT_SQL}) using (pii_type, pii_value)""")
def vault_insert_if_absent(spark: SparkSession, sf: str) -> DataFrame:
    return absent_values(order_values(spark, sf), customer_vault(spark, sf))


@query("""
    select 'case_id' as pii_type, l_suppkey::varchar as pii_value,
           sha256(l_partkey::varchar) as token, l_shipdate as created_ts
    from lineitem
    qualify row_number() over (
        partition by l_suppkey order by l_shipdate, sha256(l_partkey::varchar)) = 1""")
def vault_resolve_conflicts(spark: SparkSession, sf: str) -> DataFrame:
    """Every line item claims its own token for its supplier; the earliest counts."""
    vault = read(spark, sf, "lineitem").select(
        F.lit("case_id").alias("pii_type"),
        F.col("l_suppkey").cast("string").alias("pii_value"),
        F.sha2(F.col("l_partkey").cast("string"), 256).alias("token"),
        F.col("l_shipdate").alias("created_ts"),
    )
    return resolve_conflicts(vault)


@query("""
    select pii_type, pii_value, 1::bigint as entries, 64 as token_length, true as is_hex from (
        select distinct 'person_nm' as pii_type, c_name as pii_value from customer
        union all
        select distinct 'case_id', c_custkey::varchar from customer)""")
def token_new_values(spark: SparkSession, sf: str) -> DataFrame:
    """One entry for each value after two runs, and a token of 64 hex digits."""
    folder = work_folder(spark)
    vault = Vault(spark, f"{folder}/vault")
    pii = {"c_name": "person_nm", "c_custkey": "case_id"}
    for run in range(2):
        vault.tokens_for(read(spark, sf, "customer"), pii, RUN_TS, f"{folder}/work{run}")
    return (
        vault.read()
        .groupBy("pii_type", "pii_value")
        .agg(
            F.count(F.lit(1)).alias("entries"),
            F.max(F.length("token")).alias("token_length"),
            F.every(F.col("token").rlike("^[0-9a-f]{64}$")).alias("is_hex"),
        )
    )


@query("""
    select o_custkey::varchar as pii_value, true as same_token
    from orders where o_orderstatus = 'F' group by o_custkey""")
def tokenise_stable(spark: SparkSession, sf: str) -> DataFrame:
    """Tokens of finished orders' customers stay when all orders follow."""
    folder, orders = work_folder(spark), read(spark, sf, "orders")
    vault, pii = Vault(spark, f"{folder}/vault"), {"o_custkey": "case_id"}
    done = orders.filter("o_orderstatus = 'F'")
    first = vault.tokens_for(done, pii, RUN_TS, f"{folder}/first").tokens
    second = vault.tokens_for(orders, pii, RUN_TS, f"{folder}/second").tokens
    later = second.select("pii_value", F.col("token").alias("later"))
    same = F.col("token") == F.col("later")
    return first.join(later, "pii_value", "left").select("pii_value", same.alias("same_token"))


# Part of the customers is blank: null for pending orders, empty for cheap ones.
BLANKS_SQL = """
    case when o_orderstatus = 'P' then null when o_totalprice < 100000 then ''
         else o_custkey::varchar end"""


@query(f"select o_orderkey, {hmac_sql('ssn', BLANKS_SQL)} as ssn from orders")
def token_blank_rule(spark: SparkSession, sf: str) -> DataFrame:
    ssn = F.when(F.col("o_orderstatus") == "P", F.lit(None).cast("string"))
    ssn = ssn.when(F.col("o_totalprice") < 100000, "").otherwise(F.col("o_custkey").cast("string"))
    orders = read(spark, sf, "orders").select("o_orderkey", ssn.alias("ssn"))
    return tokenise_keyed(orders, {"ssn": "ssn"}, TOKENS)


@query(f"""
    select c_custkey, {hmac_sql("person_nm", "c_name")} as c_name, c_nationkey, c_acctbal,
           c_mktsegment, {hmac_sql("case_id", "c_custkey")} as c_custkey_token
    from customer""",
    name="tokenise_keyed")
def tokenise_keyed_customers(spark: SparkSession, sf: str) -> DataFrame:
    customer = tokenise_keyed(read(spark, sf, "customer"), {"c_name": "person_nm"}, TOKENS)
    return tokenise_keyed(customer, {"c_custkey": "case_id"}, TOKENS, suffix="_token")


@query("""
    select c_nationkey, count(*) as n_orders, sum(o_totalprice)::decimal(18, 2) as total
    from orders join customer on o_custkey = c_custkey group by c_nationkey""")
def token_join_integrity(spark: SparkSession, sf: str) -> DataFrame:
    """Two datasets cleaned in runs of their own still join, now on random tokens."""
    folder = work_folder(spark)
    vault = Vault(spark, f"{folder}/vault")
    orders = DatasetPolicy("orders", pii={"o_custkey": "case_id"})
    customer = DatasetPolicy("customer", pii={"c_custkey": "case_id", "c_name": "person_nm"})
    for policy in (orders, customer):
        run_clean(read(spark, sf, policy.table), policy, f"{folder}/{policy.table}", vault)
    customer = spark.read.parquet(f"{folder}/customer")
    price = F.col("o_totalprice").cast("decimal(18,2)")
    # Summed per token before the join, so that no customer's orders meet in one task.
    per_token = (
        spark.read.parquet(f"{folder}/orders")
        .groupBy("o_custkey")
        .agg(F.count(F.lit(1)).alias("n_orders"), F.sum(price).alias("total"))
    )
    joined = per_token.join(customer, per_token["o_custkey"] == customer["c_custkey"])
    return joined.groupBy("c_nationkey").agg(
        F.sum("n_orders").alias("n_orders"), F.sum("total").cast("decimal(18,2)").alias("total")
    )


@query("""
    select what, raw, count(*) as n_rows, case when raw is null then 0::bigint else 1 end as n_tokens
    from (select 'flag' as what, l_returnflag as raw from lineitem
          union all
          select 'supplier', case when l_linenumber > 1 then l_suppkey::varchar end from lineitem)
    group by what, raw""")
def tokenise_shuffled(spark: SparkSession, sf: str) -> DataFrame:
    """Vault tokens joined by shuffle, with hot values and blanks: each value has one token."""
    folder = work_folder(spark)
    supplier = F.when(F.col("l_linenumber") > 1, F.col("l_suppkey").cast("string"))
    lines = read(spark, sf, "lineitem").select(
        F.col("l_returnflag").alias("raw_flag"),
        F.col("l_returnflag").alias("flag"),
        supplier.alias("raw_supplier"),
        supplier.alias("supplier"),
    )
    pii = {"flag": "user_cd", "supplier": "case_id"}
    batch = Vault(spark, f"{folder}/vault").tokens_for(lines, pii, RUN_TS, f"{folder}/work")
    done = tokenise_from_vault(lines, pii, batch, broadcast_bytes=0, hot_share=0.05)
    cells = [
        F.struct(F.lit(c).alias("what"), F.col(f"raw_{c}").alias("raw"), F.col(c).alias("token"))
        for c in pii
    ]
    pairs = F.inline(F.array(*cells))
    per_token = done.select(pairs).groupBy("what", "raw", "token").agg(F.count(F.lit(1)).alias("n"))
    return per_token.groupBy("what", "raw").agg(
        F.sum("n").alias("n_rows"), F.count_if(F.col("token") != "").alias("n_tokens")
    )
