"""Clean-up, parsing and masking expressions."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def strip_patterns(col: Column, patterns: Iterable[str]) -> Column:
    """Remove every match of each pattern, one pattern after the other."""
    for pattern in patterns:
        col = F.regexp_replace(col, pattern, "")
    return col


def parse_date(col: Column, fmt: str) -> Column:
    """Text to date; text that does not fit the format becomes null."""
    return F.try_to_date(col, fmt)


def parse_timestamp(col: Column, fmt: str) -> Column:
    """Text to timestamp; text that does not fit the format becomes null."""
    return F.try_to_timestamp(col, F.lit(fmt))


def mask_month(col: Column) -> Column:
    """First day of the date's month."""
    return F.trunc(col.try_cast("date"), "MM")


def mask_year(col: Column) -> Column:
    """First day of the date's year."""
    return F.trunc(col.try_cast("date"), "YYYY")


def mask_decade(col: Column) -> Column:
    """First day of the date's decade."""
    year = F.year(col.try_cast("date"))
    return F.make_date(year - F.pmod(year, F.lit(10)), F.lit(1), F.lit(1))


MASKS = {"month": mask_month, "year": mask_year, "decade": mask_decade}


def is_blank(col: Column) -> Column:
    return col.isNull() | (col.cast("string") == "")
