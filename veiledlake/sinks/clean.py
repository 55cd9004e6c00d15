"""Append-only Parquet."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def append_parquet(
    df: DataFrame,
    path: str,
    partitions: Sequence[str] = (),
    table: str | None = None,
    mode: str = "append",
) -> None:
    """Append Snappy Parquet, and register table and new partitions if a name is given."""
    writer = laid_out(df, partitions).write.mode(mode).format("parquet")
    # An overwrite always replaces the whole folder, whatever the session's setting.
    writer = writer.option("compression", "snappy").option("partitionOverwriteMode", "static")
    if partitions:
        writer = writer.partitionBy(*partitions)
    if table is None:
        writer.save(path)
    else:
        writer.option("path", path).saveAsTable(table)


def laid_out(df: DataFrame, partitions: Sequence[str]) -> DataFrame:
    """Bring rows of a partition together, so that each gets few files.

    Rebalancing, unlike a plain repartition, splits a partition that holds
    much of the data over several tasks.
    """
    return df.hint("rebalance", *(F.col(c) for c in partitions)) if partitions else df
