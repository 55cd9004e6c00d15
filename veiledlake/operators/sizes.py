"""Measuring what is to be broadcast."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, DataType, NumericType, StringType, StructType

# Tables up to this size are broadcast once measured.
BROADCAST_BYTES = 64 << 20
FIXED = ("boolean", "date", "timestamp", "timestamp_ntz")
# Taken for a value whose size cannot be told.
UNKNOWN = BROADCAST_BYTES + 1


def memory_size(schema: StructType, columns: Sequence[str]) -> Column:
    """An aggregate: bytes that columns take in memory, rather over- than underestimated."""
    size = F.lit(16).cast("long")
    for c in columns:
        size = size + _value_size(c, schema[c].dataType)
    return F.coalesce(F.sum(size), F.lit(0))


def _value_size(column: str, kind: DataType) -> Column:
    if isinstance(kind, (StringType, BinaryType)):
        return F.coalesce(F.octet_length(column), F.lit(0)) + 16
    if isinstance(kind, NumericType) or kind.typeName() in FIXED:
        return F.lit(16)
    return F.lit(UNKNOWN)

