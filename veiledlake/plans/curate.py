"""Second hop: de-identified rows to one current row per key."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from veiledlake.operators.latest import latest_per_key
from veiledlake.operators.sizes import BROADCAST_BYTES, memory_size
from veiledlake.operators.upsert import upsert, without_deletes
from veiledlake.policy import DatasetPolicy
from veiledlake.sinks.curated import Batch, BucketTable, MergeTable, PartitionedTable
from veiledlake.storage import scratch


@dataclass(frozen=True)
class MergeOptions:
    """How a batch is merged; the defaults are the plain upsert.

    ``order_by`` and ``nulls`` choose the winner within the batch. ``null_safe``
    lets null key parts match each other. ``apply_deletes`` removes rows whose
    latest change is a delete. ``only_if_newer`` names a time column, and lets
    a batch row replace a table row only if it is not older. ``missing`` says
    what happens when the batch lacks table columns: ``error`` or ``null``.
    """

    order_by: str | None = None
    nulls: str = "first"
    null_safe: bool = False
    apply_deletes: bool = False
    only_if_newer: str | None = None
    missing: str = "error"


PLAIN = MergeOptions()
Target = BucketTable | PartitionedTable | MergeTable


def curate(
    base: DataFrame | None, batch: DataFrame, policy: DatasetPolicy, options: MergeOptions = PLAIN
) -> DataFrame:
    """The table after a batch: latest row per key, merged into ``base`` if there is one."""
    policy = policy.resolve(batch.columns)
    latest = latest_per_key(batch, policy.keys, options.order_by, options.nulls)
    # The distinct keys come from the batch, as that needs no sort by recency.
    return merge(base, latest, policy, options, batch.select(*policy.keys).distinct())


def merge(
    base: DataFrame | None,
    latest: DataFrame,
    policy: DatasetPolicy,
    options: MergeOptions = PLAIN,
    batch_keys: DataFrame | None = None,
    small: bool = False,
) -> DataFrame:
    """Merge rows that are already one per key."""
    if base is None:
        return without_deletes(latest) if options.apply_deletes else latest
    return upsert(
        base,
        latest,
        policy.keys,
        null_safe=options.null_safe,
        apply_deletes=options.apply_deletes,
        only_if_newer=options.only_if_newer,
        missing=options.missing,
        batch_keys=batch_keys,
        small=small,
    )


@dataclass(frozen=True)
class CurateReport:
    """What a run did, counted while it wrote."""

    written: bool
    rows: int = 0  # in the batch
    latest: int = 0  # after keeping one per key
    null_keys: int = 0  # of these, with a null key part

    @property
    def duplicates(self) -> int:
        return self.rows - self.latest


def run_curate(
    batch: DataFrame,
    policy: DatasetPolicy,
    target: Target,
    options: MergeOptions = PLAIN,
    batch_id: Batch | None = None,
) -> CurateReport:
    """Merge a batch into a curated table.

    An empty batch, or one the table has already taken, writes nothing. For a
    merge the latest rows go to a work folder first, as they are read more
    than once. So they do when deletes are dropped: counts made on the way to
    an empty result would be lost.
    """
    if batch.isEmpty():
        return CurateReport(False)
    if batch_id is not None and target.has_applied(batch_id):
        return CurateReport(False)
    policy = policy.resolve(batch.columns)
    taken, kept = Observation(), Observation()
    null_key = reduce(or_, (F.col(k).isNull() for k in policy.keys))
    latest = latest_per_key(
        batch.observe(taken, F.count(F.lit(1)).alias("rows")),
        policy.keys,
        options.order_by,
        options.nulls,
    ).observe(
        kept,
        F.count(F.lit(1)).alias("rows"),
        F.count_if(null_key).alias("null_keys"),
        memory_size(batch.schema, _compared(policy, options)).alias("key_bytes"),
    )
    if target.exists() or options.apply_deletes or isinstance(target, BucketTable):
        _merge_into(target, latest, kept, policy, options, batch_id)
    else:
        _first_load(target, latest, policy)
    if batch_id is not None:
        target.note_applied(batch_id)
    return CurateReport(True, taken.get["rows"], kept.get["rows"], kept.get["null_keys"])


def _first_load(target: PartitionedTable | MergeTable, rows: DataFrame, policy: DatasetPolicy) -> None:
    if isinstance(target, PartitionedTable):
        target.create(rows.schema)
        target.replace(rows)
    else:
        target.create(rows, policy.partitions)


def _merge_into(
    target: Target,
    latest: DataFrame,
    measured: Observation,
    policy: DatasetPolicy,
    options: MergeOptions,
    batch_id: Batch | None,
) -> None:
    spark = latest.sparkSession
    with scratch(spark) as work:
        latest.write.parquet(f"{work}/latest")
        latest = spark.read.schema(latest.schema).parquet(f"{work}/latest")
        small = measured.get["key_bytes"] <= BROADCAST_BYTES
        if isinstance(target, BucketTable):

            def merged(base: DataFrame | None, rows: DataFrame) -> DataFrame:
                return merge(base, rows, policy, options, small=small)

            nulls = measured.get["null_keys"] > 0
            target.merge(latest, merged, null_safe=options.null_safe, null_keys=nulls, batch=batch_id)
        elif not target.exists():
            _first_load(target, merge(None, latest, policy, options), policy)
        elif isinstance(target, MergeTable):
            target.merge(
                latest,
                policy.keys,
                null_safe=options.null_safe,
                apply_deletes=options.apply_deletes,
                only_if_newer=options.only_if_newer,
                missing=options.missing,
            )
        else:
            found = target.touched(latest, policy.keys, options.null_safe, small)
            found.write.parquet(f"{work}/touched")
            touched = spark.read.schema(found.schema).parquet(f"{work}/touched")
            rows = merge(target.read(touched), latest, policy, options, small=small)
            target.replace(rows, touched, options.apply_deletes or not target.keeps_place(policy.keys))


def _compared(policy: DatasetPolicy, options: MergeOptions) -> list[str]:
    """The columns of a batch that are compared with the table."""
    return [*policy.keys, *([options.only_if_newer] if options.only_if_newer else [])]
