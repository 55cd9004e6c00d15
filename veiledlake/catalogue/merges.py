"""One row per key, and upserts."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from veiledlake.catalogue.inputs import (
    FEED_KEY,
    FEED_SQL,
    NULL_KEY_FEED_SQL,
    feed,
    first_load,
    halves_sql,
    increment,
    latest_sql,
    null_key_feed,
    read,
)
from veiledlake.catalogue.registry import query
from veiledlake.operators.latest import latest_per_key, order_latest_first
from veiledlake.operators.profile import duplicate_profile, preview
from veiledlake.operators.upsert import match_rows, upsert
from veiledlake.plans.curate import MergeOptions, curate, run_curate
from veiledlake.policy import DatasetPolicy
from veiledlake.sinks.curated import BucketTable, PartitionedTable
from veiledlake.storage import work_folder

POLICY = DatasetPolicy("feed", keys=tuple(FEED_KEY))

UPSERT_SQL = f"""{halves_sql()}
    select * from new
    union all
    select base.* from base anti join new using (l_orderkey, l_linenumber)"""


def halves(changes: DataFrame) -> tuple[DataFrame, DataFrame]:
    parts = (first_load(changes), increment(changes))
    return tuple(latest_per_key(part, FEED_KEY) for part in parts)


@query("""
    select count(*) as total_rows, count(distinct (l_orderkey, l_linenumber)) as distinct_keys,
           count(*) - count(distinct (l_orderkey, l_linenumber)) as duplicate_rows
    from lineitem""",
    name="duplicate_profile")
def batch_profile(spark: SparkSession, sf: str) -> DataFrame:
    return duplicate_profile(read(spark, sf, "lineitem"), FEED_KEY)


@query(latest_sql(FEED_SQL), name="latest_per_key")
def latest_lines(spark: SparkSession, sf: str) -> DataFrame:
    return latest_per_key(feed(spark, sf), FEED_KEY)


@query("""
    select * from events
    qualify row_number() over (
        partition by user_id, event_type order by ts desc, event_id desc) = 1""")
def latest_events(spark: SparkSession, sf: str) -> DataFrame:
    return latest_per_key(read(spark, sf, "events"), ["user_id", "event_type"], "ts")


@query("select * from events order by ts desc nulls first, event_id")
def order_desc_nulls_first(spark: SparkSession, sf: str) -> DataFrame:
    return order_latest_first(read(spark, sf, "events"), "ts", ["event_id"])


@query("select * from orders order by o_orderdate, o_orderkey limit 4", name="preview")
def preview_orders(spark: SparkSession, sf: str) -> DataFrame:
    return preview(read(spark, sf, "orders"), ["o_orderdate", "o_orderkey"])


@query(f"""{halves_sql()}
    select l_orderkey, l_linenumber, base.l_quantity, new.l_quantity as new_l_quantity,
           new.dms_commit_ts as new_dms_commit_ts
    from base join new using (l_orderkey, l_linenumber)""")
def merge_match_rows(spark: SparkSession, sf: str) -> DataFrame:
    base, new = halves(feed(spark, sf))
    kept = ["l_orderkey", "l_linenumber", "l_quantity"]
    pairs = match_rows(base.select(*kept), new.select(*kept, "dms_commit_ts"), FEED_KEY)
    return pairs.drop("new_l_orderkey", "new_l_linenumber")


@query(UPSERT_SQL)
def upsert_all(spark: SparkSession, sf: str) -> DataFrame:
    changes = feed(spark, sf)
    return curate(halves(changes)[0], increment(changes), POLICY)


@query(f"select op, count(*) as n_rows from ({UPSERT_SQL}) group by op")
def upsert_soft_delete(spark: SparkSession, sf: str) -> DataFrame:
    """Deleted rows stay in the table, marked."""
    merged = curate(halves(feed(spark, sf))[0], increment(feed(spark, sf)), POLICY)
    return merged.groupBy("op").count().withColumnRenamed("count", "n_rows")


@query(f"""{halves_sql()}
    select * from new where op <> 'D'
    union all
    select base.* from base anti join new using (l_orderkey, l_linenumber)""")
def upsert_apply_deletes(spark: SparkSession, sf: str) -> DataFrame:
    base, new = halves(feed(spark, sf))
    return upsert(base, new, FEED_KEY, apply_deletes=True)


NEWER_SQL = f"""{halves_sql()}
    select * from new where not exists (
        from base where base.l_orderkey = new.l_orderkey
            and base.l_linenumber = new.l_linenumber and base.dms_commit_ts > new.dms_commit_ts)
    union all
    select * from base where not exists (
        from new where base.l_orderkey = new.l_orderkey
            and base.l_linenumber = new.l_linenumber and new.dms_commit_ts >= base.dms_commit_ts)"""


@query(NEWER_SQL)
def upsert_only_if_newer(spark: SparkSession, sf: str) -> DataFrame:
    base, new = halves(feed(spark, sf))
    return upsert(base, new, FEED_KEY, only_if_newer="dms_commit_ts")


@query(f"""{halves_sql(NULL_KEY_FEED_SQL)}
    select * from new
    union all
    select * from base where not exists (
        from new where base.l_orderkey = new.l_orderkey
            and base.l_linenumber = new.l_linenumber)""")
def upsert_null_keys(spark: SparkSession, sf: str) -> DataFrame:
    """Rows with a null key part match nothing; a third of the feed has one."""
    base, new = halves(null_key_feed(spark, sf))
    return upsert(base, new, FEED_KEY)


@query(f"""{halves_sql(NULL_KEY_FEED_SQL)}
    select * from new
    union all
    select * from base where not exists (
        from new where base.l_orderkey = new.l_orderkey
            and base.l_linenumber is not distinct from new.l_linenumber)""")
def upsert_null_safe(spark: SparkSession, sf: str) -> DataFrame:
    base, new = halves(null_key_feed(spark, sf))
    return upsert(base, new, FEED_KEY, null_safe=True)


@query(UPSERT_SQL)
def curate_dataset(spark: SparkSession, sf: str) -> DataFrame:
    """The whole curate hop in a table by buckets: first load, increment, and a repeat of it."""
    changes, target = feed(spark, sf), BucketTable(spark, work_folder(spark), FEED_KEY)
    run_curate(first_load(changes), POLICY, target, batch_id=("trial", 0))
    for _ in range(2):
        run_curate(increment(changes), POLICY, target, batch_id=("trial", 1))
    return target.read()


@query(UPSERT_SQL)
def curate_partitions(spark: SparkSession, sf: str) -> DataFrame:
    """The same in a table that rewrites only touched partitions, between which rows move."""
    changes, folder = feed(spark, sf), work_folder(spark)
    policy = DatasetPolicy("feed", keys=tuple(FEED_KEY), partitions=("op",))
    target = PartitionedTable(spark, f"feed_{uuid.uuid4().hex}", folder, policy.partitions)
    for part in (first_load(changes), increment(changes)):
        run_curate(part, policy, target)
    return target.read()


@query(NEWER_SQL)
def curate_late_data(spark: SparkSession, sf: str) -> DataFrame:
    """Rows that arrive late do not replace newer ones."""
    changes, target = feed(spark, sf), BucketTable(spark, work_folder(spark), FEED_KEY)
    options = MergeOptions(only_if_newer="dms_commit_ts")
    for part in (first_load(changes), increment(changes)):
        run_curate(part, POLICY, target, options)
    return target.read()
