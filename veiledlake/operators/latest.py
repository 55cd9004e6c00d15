"""One row per primary key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType, VariantType

# The columns that order versions of a row, best first.
TIME_COLUMNS = ("insrt_ts", "dms_commit_ts", "rec_ingested_dt")


def recency(
    df: DataFrame, keys: Sequence[str], order_by: str | None = None, nulls: str = "first"
) -> list[Column]:
    """Sort order that puts the winning row of a key first.

    The leading column is ``order_by``, or the first time column the rows
    have, latest first; a missing time wins unless ``nulls`` is ``last``. Ties
    go to the later of the other time columns, then to the greater of all
    other columns, so that the winner does not depend on the input order.
    """
    if nulls not in ("first", "last"):
        raise ValueError("nulls must be 'first' or 'last'")
    actual = {c.lower(): c for c in df.columns}
    if order_by is not None and order_by.lower() not in actual:
        raise ValueError(f"no column {order_by}")
    wanted = ([order_by] if order_by else []) + list(TIME_COLUMNS)
    times = list(dict.fromkeys(actual[c.lower()] for c in wanted if c.lower() in actual))
    taken = {k.lower() for k in keys} | {t.lower() for t in times}
    others = [
        f.name
        for f in df.schema.fields
        if f.name.lower() not in taken and _is_ordered(f.dataType)
    ]
    lead = [
        F.col(c).desc_nulls_first() if nulls == "first" else F.col(c).desc_nulls_last()
        for c in times[:1]
    ]
    return lead + [F.col(c).desc_nulls_last() for c in [*times[1:], *others]]


def latest_per_key(
    df: DataFrame, keys: Sequence[str], order_by: str | None = None, nulls: str = "first"
) -> DataFrame:
    """Keep the latest row of each key.

    Spark limits each key to one row before the shuffle (``WindowGroupLimit``
    in the plan), so a key that holds much of the input does not end up in one task.
    """
    if not keys:
        raise ValueError("the rows need a key")
    order = recency(df, keys, order_by, nulls)
    if not order:  # every column is a key column
        return df.dropDuplicates(list(keys))
    first = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", first).filter("_rank = 1").drop("_rank")


def order_latest_first(df: DataFrame, column: str, keys: Sequence[str]) -> DataFrame:
    """Sort all rows by a time, missing times first.

    The keys break ties, which also lets the range shuffle split rows that
    share one time over many tasks.
    """
    return df.orderBy(F.col(column).desc_nulls_first(), *keys)


def _is_ordered(kind: DataType) -> bool:
    if isinstance(kind, ArrayType):
        return _is_ordered(kind.elementType)
    if isinstance(kind, StructType):
        return all(_is_ordered(f.dataType) for f in kind.fields)
    return not isinstance(kind, (MapType, VariantType))
