"""Replace matched rows, insert the others."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

OP = "op"
DELETE = "D"
# Bits of the table of a batch's keys: 16 MB, whatever the batch.
KEY_BITS = 27


def align(df: DataFrame, schema: StructType, missing: str = "error") -> DataFrame:
    """Bring rows to a table's columns and types, by name and ignoring case.

    Columns the table lacks are left out. Columns the rows lack raise, or are
    filled with null when ``missing`` is ``null``.
    """
    if missing not in ("error", "null"):
        raise ValueError("missing must be 'error' or 'null'")
    actual = {f.name.lower(): f for f in df.schema.fields}
    absent = [f.name for f in schema.fields if f.name.lower() not in actual]
    if absent and missing == "error":
        raise ValueError(f"rows lack the table's columns {absent}")

    def aligned(wanted: StructField) -> Column:
        found = actual.get(wanted.name.lower())
        if found is None:
            return F.lit(None).cast(wanted.dataType).alias(wanted.name)
        column = F.col(found.name)
        if found.dataType != wanted.dataType:
            column = column.cast(wanted.dataType)
        return column.alias(wanted.name)

    return df.select(*(aligned(f) for f in schema.fields))


def upsert(
    base: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    *,
    null_safe: bool = False,
    apply_deletes: bool = False,
    only_if_newer: str | None = None,
    missing: str = "error",
    batch_keys: DataFrame | None = None,
    small: bool = False,
) -> DataFrame:
    """The table after a batch with one row per key has been merged into it.

    A batch row replaces the table row with its key, or is added. Rows with a
    null key part match nothing and are always added, unless ``null_safe``. Deleted rows stay as
    rows marked ``D``, unless ``apply_deletes``. The batch wins even if older,
    unless ``only_if_newer`` names the time column to compare; a null time on
    either side then leaves the table row. With it the table, too, is taken to
    have one row per key.

    ``batch_keys``, if given, holds the batch's keys at less cost than the
    batch itself; it is not used with ``only_if_newer``. ``small`` states that
    the keys were measured to fit in memory (see ``memory_size``): they are
    then broadcast, and the table is not shuffled.

    A batch with more keys is told by a table of bits of fixed size, set at the
    hashes of its keys (see ``split_by_keys``). Only table rows that may match
    are shuffled; a row that passes by chance is compared like the others.
    """
    batch = align(batch, base.schema, missing)
    if only_if_newer is not None and not small:
        maybe, sure = split_by_keys(base, batch, keys, null_safe)
        return _upsert_newer(maybe, batch, keys, only_if_newer, null_safe, apply_deletes).unionByName(sure)
    newer = stale = None
    if only_if_newer is not None:
        newer = F.col(_other(only_if_newer)) >= F.col(only_if_newer)
        stale = F.coalesce(F.col(only_if_newer) < F.col(_other(only_if_newer)), F.lit(True))
        columns = list(dict.fromkeys([*keys, only_if_newer]))
        new_keys = batch.select(*columns)
    else:
        new_keys = batch.select(*keys) if batch_keys is None else batch_keys.select(*keys)
    if small:
        new_keys = F.broadcast(new_keys)

    if small:
        kept = _unmatched(base, new_keys, keys, newer, null_safe)
    else:
        maybe, sure = split_by_keys(base, new_keys, keys, null_safe)
        kept = _unmatched(maybe, new_keys, keys, newer, null_safe).unionByName(sure)
    if stale is not None:
        times = matched(base.select(*columns), batch, keys, null_safe, small)
        batch = _unmatched(batch, times, keys, stale, null_safe)
    return kept.unionByName(without_deletes(batch) if apply_deletes else batch)


def split_by_keys(
    base: DataFrame, batch: DataFrame, keys: Sequence[str], null_safe: bool = False, bits: int = KEY_BITS
) -> tuple[DataFrame, DataFrame]:
    """Table rows whose key may be in a batch, and those whose key surely is not.

    Hashes of the batch's keys set bits in a table of 2 ** ``bits`` bits, one row
    of 4 KB for each 32,768 of them, which is broadcast. Rows with a null key part
    surely match nothing, unless nulls match each other.
    """
    bucket, held, place = _other("bucket"), _other("bits"), _other("place")
    batch = align(batch.select(*keys), base.select(*keys).schema)

    def placed(df: DataFrame) -> DataFrame:
        hashed = F.xxhash64(*keys).bitwiseAND(F.lit((1 << bits) - 1)) + 1
        return df.withColumn(place, hashed).withColumn(bucket, F.bitmap_bucket_number(place))

    table = placed(batch).groupBy(bucket).agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias(held))
    at = F.bitmap_bit_position(place)
    byte = F.substring(held, (F.shiftright(at, 3) + 1).cast("int"), F.lit(1))
    is_set = F.getbit(F.conv(F.hex(byte), 16, 10).cast("int"), F.pmod(at, F.lit(8)).cast("int")) == 1
    may = F.coalesce(is_set, F.lit(False))
    if not null_safe:
        may = may & reduce(and_, (F.col(k).isNotNull() for k in keys))
    told = placed(base).join(F.broadcast(table), bucket, "left")
    return told.filter(may).select(*base.columns), told.filter(~may).select(*base.columns)


def _upsert_newer(
    base: DataFrame, batch: DataFrame, keys: Sequence[str], time: str, null_safe: bool, apply_deletes: bool
) -> DataFrame:
    """Of the table row and the batch row of a key the one that holds: one shuffle for both sides.

    The later row wins, and the batch row if both are as late. A null time on either side leaves the table
    row. Only the first row of a key in each task is shuffled. Rows of the batch with a null key part stay out of
    it, unless nulls match each other.
    """
    null_key = reduce(or_, (F.col(k).isNull() for k in keys))
    side, place = _other("side"), _other("place")
    both = base.withColumn(side, F.lit(0)).unionByName(batch.withColumn(side, F.lit(1)))
    compared = both if null_safe else both.filter(~null_key)
    untimed = F.col(time).isNull() & (F.col(side) == 0)
    window = Window.partitionBy(*keys).orderBy(untimed.desc(), F.col(time).desc_nulls_last(), F.col(side).desc())
    found = compared.withColumn(place, F.row_number().over(window)).filter(F.col(place) == 1).drop(place)
    if not null_safe:
        found = found.unionByName(both.filter(null_key))
    if apply_deletes:
        found = found.filter((F.col(side) == 0) | ~F.col(OP).eqNullSafe(DELETE))
    return found.drop(side)


def without_deletes(df: DataFrame) -> DataFrame:
    """Rows whose change is not a delete."""
    return df.filter(~F.col(OP).eqNullSafe(DELETE))


def match_rows(
    base: DataFrame, batch: DataFrame, keys: Sequence[str], null_safe: bool = False
) -> DataFrame:
    """Table rows with the batch row of the same key; batch columns get the prefix ``new_``."""
    batch = batch.toDF(*(f"new_{c}" for c in batch.columns))
    return base.join(batch, _same_key(keys, "new_", null_safe))


def matched(
    base: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    null_safe: bool = False,
    small: bool = False,
) -> DataFrame:
    """Table rows whose key occurs in the batch."""
    batch = batch.select(*keys).toDF(*(f"new_{k}" for k in keys))
    if small:
        batch = F.broadcast(batch)
    return base.join(batch, _same_key(keys, "new_", null_safe), "left_semi")


def _unmatched(
    df: DataFrame,
    other: DataFrame,
    keys: Sequence[str],
    also: Column | None = None,
    null_safe: bool = False,
) -> DataFrame:
    """Rows that match no row of ``other``. ``also`` may speak of its columns as ``_other``."""
    other = other.toDF(*(_other(c) for c in other.columns))
    condition = _same_key(keys, _other(""), null_safe)
    return df.join(other, condition if also is None else condition & also, "left_anti")


def _same_key(keys: Sequence[str], prefix: str, null_safe: bool) -> Column:
    pairs = ((F.col(k), F.col(prefix + k)) for k in keys)
    return reduce(and_, (a.eqNullSafe(b) if null_safe else a == b for a, b in pairs))


def _other(column: str) -> str:
    return f"_other_{column}"
