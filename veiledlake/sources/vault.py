"""The vault table on storage."""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager
from datetime import UTC, datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from veiledlake.functions.tokens import checked_blank
from veiledlake.operators.sizes import BROADCAST_BYTES
from veiledlake.operators.vault import (
    KEY,
    SCHEMA,
    BatchTokens,
    batch_values,
    find_tokens,
    new_entries,
    value_sizes,
    with_fresh_tokens,
)
from veiledlake.policy import TOKEN_TYPES
from veiledlake.sinks.clean import append_parquet
from veiledlake.storage import children, create_exclusive, delete, exists, newest, read_text

REST = ("pii_value", "token", "created_ts")


class VaultBusyError(RuntimeError):
    """Another run holds the vault."""


class Vault:
    """Values in clear with their tokens, as Parquet partitioned by type.

    One run at a time looks up and adds entries: two that add the same value at
    once could each use a token of their own. A lock file sees to that. A run
    that finds it taken waits up to ``wait`` seconds and then fails; a lock that
    a dead run has left is removed with ``break_lock``. Keep the folder away
    from everything the tokens are meant to protect.
    """

    def __init__(
        self, spark: SparkSession, path: str, blank: str = "empty", wait: float = 0
    ) -> None:
        self.spark = spark
        self.path = path
        self.blank = checked_blank(blank)
        self.wait = wait
        self.lock_path = f"{path.rstrip('/')}/_lock"

    @contextmanager
    def locked(self) -> Iterator[None]:
        """Hold the vault's lock: no other run looks up or adds entries meanwhile."""
        mine = json.dumps(
            {
                "owner": uuid.uuid4().hex,
                "application": self.spark.sparkContext.applicationId,
                "since": datetime.now(UTC).isoformat(),
            }
        )
        give_up = time.monotonic() + self.wait
        while not create_exclusive(self.spark, self.lock_path, mine):
            if time.monotonic() >= give_up:
                raise VaultBusyError(f"{self.path} is in use by {self.lock_holder()}")
            time.sleep(min(1.0, max(self.wait / 10, 0.05)))
        try:
            yield
        finally:
            if self.lock_holder() == mine:
                delete(self.spark, self.lock_path)

    def lock_holder(self) -> str | None:
        """Owner, application and time of the lock, if it is taken."""
        try:
            return read_text(self.spark, self.lock_path)
        except Exception:
            if exists(self.spark, self.lock_path):
                raise
            return None

    def break_lock(self) -> None:
        """Remove a lock whose run is dead. Make sure that it is."""
        delete(self.spark, self.lock_path)

    def read(self, types: Sequence[str] = TOKEN_TYPES, since: int | None = None) -> DataFrame:
        """Entries of some types, or only those in files as new as a change time."""
        if not any(n.startswith("pii_type=") for n in children(self.spark, self.path)):
            nothing = F.from_json(F.lit("{}"), SCHEMA)
            return self.spark.range(0).select(nothing.alias("entry")).select("entry.*")
        entries = self.spark.read.schema(SCHEMA).parquet(self.path)
        if since is not None:  # checked against the list of files: the others are not opened
            changed = F.col("_metadata.file_modification_time")
            entries = entries.filter(changed >= F.timestamp_millis(F.lit(since)))
        return entries.filter(F.col("pii_type").isin(list(types))).select("pii_type", *REST)

    def add(self, entries: DataFrame) -> None:
        append_parquet(entries, self.path, ["pii_type"])

    def last_change(self, types: Sequence[str]) -> int:
        """When a file of these types was last added, 0 if there is none."""
        folders = [f"{self.path}/pii_type={t}" for t in types]
        return max((newest(self.spark, folder) for folder in folders), default=0)

    def tokens_for(
        self, df: DataFrame, pii: Mapping[str, str], run_ts: datetime, work: str
    ) -> BatchTokens:
        """Tokens of all values in the rows, created where there are none, under the vault's lock.

        ``work`` is a folder for the batch's values in clear; delete it once
        the tokens are joined. Fresh tokens are written before anything reads
        them, so a lost executor can never lead to a second token. They are
        used only as read back from the vault.
        """
        with self.locked():
            return self._tokens_for(df, pii, run_ts, work)

    def _tokens_for(
        self, df: DataFrame, pii: Mapping[str, str], run_ts: datetime, work: str
    ) -> BatchTokens:
        types = sorted(set(pii.values()))
        seen, looked_up = Observation(), Observation()
        sizes = [size.alias(name) for name, size in value_sizes(types).items()]
        values = batch_values(df, pii).observe(seen, *sizes)
        values.write.mode("overwrite").parquet(f"{work}/values")
        values = self.spark.read.parquet(f"{work}/values")
        bytes_by_type = {t: seen.get[f"bytes {t}"] for t in types}
        small = sum(bytes_by_type.values()) <= BROADCAST_BYTES

        since = self.last_change(types)
        found = find_tokens(values, self.read(types), small)
        is_absent = F.col("token").isNull()
        found = found.observe(looked_up, F.count_if(is_absent).alias("absent"))
        with_fresh_tokens(found).write.mode("overwrite").parquet(f"{work}/found")
        marked = self.spark.read.parquet(f"{work}/found")
        tokens = marked.filter(~is_absent).drop("fresh")
        if looked_up.get["absent"]:
            self.add(new_entries(marked, run_ts))
            absent = marked.filter(is_absent).select(*KEY, "cells")
            added = find_tokens(absent, self.read(types, since), small)
            added.write.mode("overwrite").parquet(f"{work}/added")
            tokens = tokens.unionByName(self.spark.read.parquet(f"{work}/added"))
        return BatchTokens(tokens, seen.get["cells"], bytes_by_type, self.blank)
