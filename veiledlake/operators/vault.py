"""Random tokens kept in a vault table.

The vault maps (``pii_type``, ``pii_value``) to one token. All datasets share
it, so that equal values of a type get equal tokens everywhere. Work is done
on the distinct values of a batch, never per row.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veiledlake.functions.columns import is_blank
from veiledlake.functions.tokens import blank_token, salted_token
from veiledlake.operators.sizes import BROADCAST_BYTES

SCHEMA = "pii_type string, pii_value string, token string, created_ts timestamp"
KEY = ["pii_type", "pii_value"]

# What a token takes in memory, with its share of the table around it.
TOKEN_BYTES = 128
# A value is hot when it holds more than this share of the batch's PII cells. So at
# most 100,000 values are hot. Values are looked up by digests of a fixed size, and
# what is broadcast for the hot ones stays below 20 MB, however long they are.
HOT_SHARE = 1 / 100_000
# Over how many join keys for each task rows that need no lookup are spread.
SPREAD = 64
# Columns added for a while; no dataset should use such names.
HELPER = "__vault_"


def batch_values(df: DataFrame, pii: Mapping[str, str]) -> DataFrame:
    """Distinct non-blank values by type, with the number of cells that hold each."""
    cells = F.array(
        *(
            F.struct(F.lit(t).alias("pii_type"), F.col(c).cast("string").alias("pii_value"))
            for c, t in pii.items()
        )
    )
    return (
        df.select(F.inline(cells))
        .filter(~is_blank(F.col("pii_value")))
        .groupBy(*KEY)
        .agg(F.count(F.lit(1)).alias("cells"))
    )


def value_sizes(types: Iterable[str]) -> dict[str, Column]:
    """Aggregates over batch values: cells in all, and bytes with their tokens by type."""
    row_bytes = F.octet_length("pii_value") + F.lit(TOKEN_BYTES)
    sizes = {"cells": F.coalesce(F.sum("cells"), F.lit(0))}
    for t in types:
        of_type = F.when(F.col("pii_type") == t, row_bytes)
        sizes[f"bytes {t}"] = F.coalesce(F.sum(of_type), F.lit(0))
    return sizes


def absent_values(values: DataFrame, vault: DataFrame) -> DataFrame:
    """Values the vault does not hold yet."""
    return values.select(*KEY).join(vault.select(*KEY), KEY, "left_anti")


def resolve_conflicts(vault: DataFrame) -> DataFrame:
    """One token per key: the earliest, and the least of equally early ones."""
    first = F.min(F.struct("created_ts", "token"))
    return vault.groupBy(*KEY).agg(first.alias("first")).select(
        *KEY, "first.token", "first.created_ts"
    )


def find_tokens(values: DataFrame, vault: DataFrame, small: bool = False) -> DataFrame:
    """Values with their one token, conflicts resolved, null where the vault holds none.

    Values and vault are shuffled once, for the join and the aggregation.
    ``small`` states that the values were measured to fit in memory: the vault
    is then cut down to them first, without a shuffle.
    """
    if small:
        vault = vault.join(F.broadcast(values.select(*KEY)), KEY, "left_semi")
    first = F.min(F.struct("created_ts", "token"))
    return (
        values.join(vault, KEY, "left")
        .groupBy(*KEY)
        .agg(first.alias("first"), F.max("cells").alias("cells"))
        .select(*KEY, "first.token", "cells")
    )


def with_fresh_tokens(found: DataFrame) -> DataFrame:
    """Add a random token where there is none yet, as ``fresh``. Write the result before use."""
    fresh = F.when(F.col("token").isNull(), salted_token(F.col("pii_value")))
    return found.withColumn("fresh", fresh)


def new_entries(marked: DataFrame, created_ts: datetime) -> DataFrame:
    """The vault rows to add, from written fresh tokens."""
    return marked.filter("token is null").select(
        *KEY, F.col("fresh").alias("token"), F.lit(created_ts).cast("timestamp").alias("created_ts")
    )


@dataclass(frozen=True)
class BatchTokens:
    """The tokens of a batch's values, and how to join them to its rows."""

    tokens: DataFrame  # pii_type, pii_value, token, cells
    cells: int  # in all
    bytes_by_type: Mapping[str, int]
    blank: str = "empty"  # what null and empty values become

    def of_type(self, pii_type: str) -> DataFrame:
        return self.tokens.filter(F.col("pii_type") == pii_type)


def tokenise_from_vault(
    df: DataFrame,
    pii: Mapping[str, str],
    batch: BatchTokens,
    *,
    suffix: str = "",
    broadcast_bytes: int = BROADCAST_BYTES,
    hot_share: float = HOT_SHARE,
) -> DataFrame:
    """Replace PII columns by their vault tokens, or add them under a suffix.

    Types whose tokens together take up to ``broadcast_bytes``, the smallest
    first, are joined by broadcast. The cells of all other columns are looked up
    in one shuffle of narrow rows, and the rows themselves are shuffled once,
    however many such columns there are. No value holds many rows in it: the hot
    values, few by definition, are looked up by broadcast first, and rows already
    settled (hot or blank in each column) are spread evenly.

    The spread follows the row's position, which a retried task repeats only
    when ``df`` reads files without a shuffle in between, as the clean hop does.
    """
    columns = [*df.columns, *(c + suffix for c in pii if suffix)]
    small, held = set(), 0
    for t in sorted(set(pii.values()), key=lambda t: (batch.bytes_by_type.get(t, 0), t)):
        held += batch.bytes_by_type.get(t, 0)
        if held <= broadcast_bytes:
            small.add(t)
    is_hot = F.col("cells") > batch.cells * hot_share
    values = {c: F.col(c).cast("string") for c in pii}
    found = {c: [f"{HELPER}token_{i}"] for i, c in enumerate(pii)}
    for c, t in pii.items():
        tokens = batch.of_type(t)
        df = _look_up(df, values[c], tokens if t in small else tokens.filter(is_hot), found[c][0])
    large = {c: t for c, t in pii.items() if t not in small}
    if large:
        unsettled = {c: ~is_blank(values[c]) & F.col(found[c][0]).isNull() for c in large}
        digests = {c: F.when(unsettled[c], _digest(values[c])) for c in large}
        cold = batch.tokens.filter(F.col("pii_type").isin(sorted(set(large.values()))) & ~is_hot)
        names = {c: f"{HELPER}cold_{i}" for i, c in enumerate(large)}
        df = _look_up_by_shuffle(df, large, digests, cold, names)
        for c in large:
            found[c].append(names[c])
    done = {}
    for c in pii:
        # A value without a token must never be passed on in clear, nor get lost.
        missing = F.raise_error(F.lit(f"no token for a value of {c}"))
        token = F.coalesce(*(F.col(name) for name in found[c]), missing)
        done[c + suffix] = F.when(is_blank(values[c]), blank_token(batch.blank)).otherwise(token)
    return df.withColumns(done).select(*columns)


def _look_up(df: DataFrame, value: Column, tokens: DataFrame, name: str) -> DataFrame:
    """Add the token of a value from a small table."""
    tokens = tokens.select(
        _digest(F.col("pii_value")).alias(f"{HELPER}value"), F.col("token").alias(name)
    )
    found = df.join(F.broadcast(tokens), _digest(value) == F.col(f"{HELPER}value"), "left")
    return found.drop(f"{HELPER}value")


def _digest(value: Column) -> Column:
    """A value as a join key: as long for every value, and nothing in clear is shuffled."""
    return F.unhex(F.sha2(value, 256))


def _look_up_by_shuffle(
    df: DataFrame,
    large: Mapping[str, str],
    digests: Mapping[str, Column],
    tokens: DataFrame,
    names: Mapping[str, str],
) -> DataFrame:
    """Add the tokens of digests from a large table, by column; a null digest needs none.

    Rows meet their tokens by the digest of all their digests: it follows from the
    row alone, so a retried task makes the same keys, and equal rows share one.
    """
    key = _row_key(list(digests.values()))
    found = _tokens_by_row(df.select(key.alias(f"{HELPER}key"), *_named(digests, names)), large, tokens, names)
    keys = SPREAD * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(keys))
    # A digest has 32 bytes, and the other kind of key is shorter.
    spread = F.concat(F.lit("s"), spread).cast("binary")
    df = df.withColumn(f"{HELPER}row_key", F.coalesce(key, spread))
    return df.join(found, F.col(f"{HELPER}row_key") == F.col(f"{HELPER}key"), "left")


def _row_key(digests: list[Column]) -> Column:
    """One digest of several, null if all are null."""
    if len(digests) == 1:
        return digests[0]
    none = F.lit(bytearray(32))
    joined = F.concat(*(F.coalesce(d, none) for d in digests))
    return F.when(F.coalesce(*digests).isNotNull(), F.unhex(F.sha2(joined, 256)))


def _named(columns: Mapping[str, Column], names: Mapping[str, str]) -> list[Column]:
    return [column.alias(names[c]) for c, column in columns.items()]


def _tokens_by_row(
    rows: DataFrame, large: Mapping[str, str], tokens: DataFrame, names: Mapping[str, str]
) -> DataFrame:
    """One row per key with the token of each digest: cells of all columns go through one join."""
    tokens = tokens.select("pii_type", _digest(F.col("pii_value")).alias("digest"), "token")
    key = f"{HELPER}key"
    if len(large) == 1:
        (name,) = names.values()
        return tokens.select(F.col("digest").alias(key), F.col("token").alias(name))
    cells = F.array(
        *(
            F.struct(F.lit(i).alias("at"), F.lit(t).alias("pii_type"), F.col(names[c]).alias("digest"))
            for i, (c, t) in enumerate(large.items())
        )
    )
    cells = rows.select(key, F.inline(cells)).filter(F.col("digest").isNotNull())
    of_column = [
        F.max(F.when(F.col("at") == i, F.col("token"))).alias(names[c]) for i, c in enumerate(large)
    ]
    return cells.join(tokens, ["pii_type", "digest"]).groupBy(key).agg(*of_column)
