"""Counts that describe a batch."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def duplicate_profile(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: rows, distinct keys, and rows beyond the first of their key."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_rows"),
        F.count(F.lit(1)).alias("distinct_keys"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicate_rows"),
    )


def preview(df: DataFrame, order_by: Sequence[str], n: int = 4) -> DataFrame:
    """The first rows in a stated order."""
    return df.orderBy(*order_by).limit(n)
