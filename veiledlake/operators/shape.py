"""Column steps of the clean hop."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Mapping
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from veiledlake.functions.columns import (
    MASKS,
    is_blank,
    parse_date,
    parse_timestamp,
    strip_patterns,
)
from veiledlake.functions.tokens import KeyedTokens
from veiledlake.policy import DatasetPolicy, PolicyError

INGESTED = "rec_ingested_dt"


def rename_columns(df: DataFrame, renames: Mapping[str, str]) -> DataFrame:
    """Rename columns, all at once; names that are not there are ignored."""
    new_names = {old.lower(): new for old, new in renames.items()}
    names = [new_names.get(c.lower(), c) for c in df.columns]
    twice = sorted(n for n, times in Counter(n.lower() for n in names).items() if times > 1)
    if twice:
        raise PolicyError(f"renaming would repeat columns {twice}")
    return df.toDF(*names) if names != df.columns else df


def exclude_columns(df: DataFrame, drops: Iterable[str]) -> DataFrame:
    """Drop columns, ignoring case and names that are not there."""
    return df.drop(*drops)


def strip_characters(df: DataFrame, strips: Mapping[str, Iterable[str]]) -> DataFrame:
    return df.withColumns({c: strip_patterns(F.col(c), p) for c, p in strips.items()})


def parse_dates(df: DataFrame, formats: Mapping[str, str]) -> DataFrame:
    """Parse text columns to dates; a column that is no text is cast. Absent columns are ignored."""
    return df.withColumns(
        {
            c: parse_date(F.col(c), fmt) if _is_text(df, c) else F.col(c).cast("date")
            for c, fmt in _present(df, formats).items()
        }
    )


def parse_timestamps(df: DataFrame, formats: Mapping[str, str]) -> DataFrame:
    """Parse text columns to timestamps, by the same rules."""
    return df.withColumns(
        {
            c: parse_timestamp(F.col(c), fmt) if _is_text(df, c) else F.col(c).cast("timestamp")
            for c, fmt in _present(df, formats).items()
        }
    )


def stamp_ingestion(df: DataFrame, run_ts: datetime | None = None) -> DataFrame:
    """Add the ingestion time: one value for the whole run."""
    return df.withColumn(INGESTED, F.current_timestamp() if run_ts is None else F.lit(run_ts))


def mask_dates(df: DataFrame, columns: Iterable[str], keep: str = "month") -> DataFrame:
    """Reduce dates to the start of their month, year or decade."""
    return df.withColumns({c: MASKS[keep](F.col(c)) for c in columns})


def tokenise_keyed(
    df: DataFrame, pii: Mapping[str, str], tokens: KeyedTokens, suffix: str = ""
) -> DataFrame:
    """Replace PII columns by keyed tokens, or add them under a suffix."""
    return df.withColumns({c + suffix: tokens.column(F.col(c), t) for c, t in pii.items()})


def prepare(
    df: DataFrame, policy: DatasetPolicy, strict: bool = True
) -> tuple[DataFrame, DatasetPolicy]:
    """Rename, drop and strip. Returns the rows with the policy matched to their columns."""
    df = rename_columns(df, policy.renames)
    policy = policy.resolve(df.columns, strict)
    return df.transform(exclude_columns, policy.drops).transform(
        strip_characters, policy.strips
    ), policy


def parse_and_stamp(
    df: DataFrame, policy: DatasetPolicy, run_ts: datetime | None = None
) -> DataFrame:
    """Parse dates and timestamps, then stamp the run."""
    return (
        df.transform(parse_dates, policy.dates)
        .transform(parse_timestamps, policy.timestamps)
        .transform(stamp_ingestion, run_ts)
    )


def shape_counts(df: DataFrame, policy: DatasetPolicy) -> dict[str, Column]:
    """What to count on prepared rows: rows, blanks, and texts that are read as no date.

    These are texts to be parsed, and texts that a mask has to read.
    """
    counts = {"rows": F.count(F.lit(1))}
    for c in policy.token_columns:
        counts[f"blank {c}"] = F.count_if(is_blank(F.col(c)))
    for formats, parse in ((policy.dates, parse_date), (policy.timestamps, parse_timestamp)):
        for c, fmt in _present(df, formats).items():
            if _is_text(df, c):
                unfit = F.col(c).isNotNull() & parse(F.col(c), fmt).isNull()
                counts[f"unparsed {c}"] = F.count_if(unfit)
    for c in policy.masked_columns:
        if f"unparsed {c}" not in counts and _is_text(df, c):
            unread = ~is_blank(F.col(c)) & MASKS["month"](F.col(c)).isNull()
            counts[f"unparsed {c}"] = F.count_if(unread)
    return counts


def _is_text(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, StringType)


def _present(df: DataFrame, formats: Mapping[str, str]) -> dict[str, str]:
    actual = {c.lower(): c for c in df.columns}
    return {actual[c.lower()]: fmt for c, fmt in formats.items() if c.lower() in actual}
