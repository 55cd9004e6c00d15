"""First hop: change-data rows to de-identified rows."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from datetime import UTC, datetime

from pyspark.sql import DataFrame, Observation

from veiledlake.functions.tokens import KeyedTokens
from veiledlake.operators.shape import (
    mask_dates,
    parse_and_stamp,
    prepare,
    shape_counts,
    tokenise_keyed,
)
from veiledlake.operators.vault import BatchTokens, tokenise_from_vault
from veiledlake.policy import DatasetPolicy
from veiledlake.sinks.clean import append_parquet
from veiledlake.sources.vault import Vault
from veiledlake.storage import scratch


def clean(
    df: DataFrame,
    policy: DatasetPolicy,
    tokens: KeyedTokens | BatchTokens,
    run_ts: datetime | None = None,
    keep: str = "month",
    strict: bool = True,
) -> DataFrame:
    """Rename, drop, strip, parse, stamp, then mask and tokenise: one plan.

    With keyed tokens the plan has no shuffle.
    """
    df, policy = prepare(df, policy, strict)
    return protect(parse_and_stamp(df, policy, run_ts), policy, tokens, keep)


def protect(
    df: DataFrame, policy: DatasetPolicy, tokens: KeyedTokens | BatchTokens, keep: str = "month"
) -> DataFrame:
    """Apply the PII rules: token types to tokens, dates to their masked form."""
    if isinstance(tokens, KeyedTokens):
        df = tokenise_keyed(df, policy.token_columns, tokens)
    elif policy.token_columns:
        df = tokenise_from_vault(df, policy.token_columns, tokens)
    return mask_dates(df, policy.masked_columns, keep)


@dataclass(frozen=True)
class CleanReport:
    """What a run did, counted while it wrote."""

    rows: int
    blanks: Mapping[str, int]  # null or empty values, by tokenised column
    unparsed: Mapping[str, int]  # texts that fit no date format, by parsed column


def run_clean(
    raw: DataFrame,
    policy: DatasetPolicy,
    path: str,
    tokens: KeyedTokens | Vault,
    *,
    run_ts: datetime | None = None,
    table: str | None = None,
    mode: str = "append",
    keep: str = "month",
    strict: bool = True,
) -> CleanReport:
    """Clean new rows and append them to the dataset. An empty batch writes nothing."""
    prepared, policy = prepare(raw, policy, strict)
    counts = shape_counts(prepared, policy)
    found = dict.fromkeys(counts, 0)
    if not raw.isEmpty():
        run_ts = run_ts or datetime.now(UTC)
        observed = Observation()
        counted = prepared.observe(observed, *(c.alias(name) for name, c in counts.items()))
        with scratch(raw.sparkSession) as work:
            batch = tokens
            if isinstance(tokens, Vault):
                values = parse_and_stamp(prepared, policy, run_ts)
                batch = tokens.tokens_for(values, policy.token_columns, run_ts, work)
            rows = protect(parse_and_stamp(counted, policy, run_ts), policy, batch, keep)
            append_parquet(rows, path, policy.partitions, table, mode)
        found = observed.get
    return CleanReport(found["rows"], _by_column(found, "blank "), _by_column(found, "unparsed "))


def _by_column(found: Mapping[str, int], what: str) -> dict[str, int]:
    return {name.removeprefix(what): n for name, n in found.items() if name.startswith(what)}
