"""Rules that read a column's name or source type."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Name part -> PII type. When several parts occur, the last rule counts.
NAME_RULES = (
    (("email",), "email"),
    (("ssn",), "ssn"),
    (("_id",), "case_id"),
    (("fein",), "fein"),
    (("fnm", "mnm", "lnm"), "person_nm"),
    (("phone", "phnnum_txt"), "phone_num"),
)


def pii_type_of(name: Column) -> Column:
    """PII type a column name points to; null when no rule matches."""
    found = F.lit(None).cast("string")
    for parts, pii_type in NAME_RULES:
        hit = F.lit(False)
        for part in parts:
            hit = hit | name.contains(part)
        found = F.when(hit, F.lit(pii_type)).otherwise(found)
    return found


def catalog_type_of(source_type: Column, legacy: bool = False) -> Column:
    """Catalog type of a database type.

    By default wide integers stay wide, and small integers and decimals keep
    their type. ``legacy`` narrows every integer to ``int`` and turns decimals
    into text.
    """
    if legacy:
        return (
            F.when(source_type.contains("date"), "date")
            .when(source_type.contains("timestamp"), "timestamp")
            .when(source_type.contains("bigserial") | source_type.contains("int"), "int")
            .otherwise("string")
        )
    t = F.regexp_replace(F.lower(source_type), " ", "")
    precision = F.regexp_extract(t, r"\((\d+)", 1)
    digits = F.when(precision != "", precision.cast("int"))
    whole = t.rlike(r"^num(eric|ber)\(\d+(,0)?\)$")
    exact = t.rlike(r"^(numeric|number|decimal)\(\d+(,\d+)?\)$") & (digits <= 38)
    return (
        F.when(t.startswith("timestamp"), "timestamp")
        .when(t == "date", "date")
        .when(t.isin("bigint", "bigserial"), "bigint")
        .when(t.isin("smallint", "smallserial"), "smallint")
        .when(t.isin("int", "integer", "serial"), "int")
        .when(whole & (digits <= 10), "int")
        .when(whole & (digits <= 18), "bigint")
        .when(exact, F.regexp_replace(t, "^(numeric|number)", "decimal"))
        .otherwise("string")
    )
