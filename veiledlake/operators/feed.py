"""Change-data feeds."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def stamp_full_load(df: DataFrame, commit_ts: datetime | None = None) -> DataFrame:
    """Mark rows of a full load as inserts, ``op`` first.

    The commit time is last; it is left out for sources that do not record it.
    """
    df = df.select(F.lit("I").alias("op"), "*")
    if commit_ts is None:
        return df
    return df.withColumn("dms_commit_ts", F.lit(commit_ts).cast("timestamp"))


def count_operations(feed: DataFrame) -> DataFrame:
    return feed.groupBy("op").agg(F.count(F.lit(1)).alias("n_rows"))
