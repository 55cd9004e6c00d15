"""Process what arrived since the last run, then stop."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType

from veiledlake.functions.tokens import KeyedTokens
from veiledlake.plans.clean import CleanReport, clean, run_clean
from veiledlake.plans.curate import PLAIN, CurateReport, MergeOptions, Target, run_curate
from veiledlake.policy import DatasetPolicy
from veiledlake.sources.incremental import read_new
from veiledlake.sources.vault import Vault

BATCH = "ingest_batch"


def stream_clean(
    spark: SparkSession,
    raw_path: str,
    schema: StructType | str,
    policy: DatasetPolicy,
    clean_path: str,
    checkpoint: str,
    tokens: KeyedTokens | Vault,
    *,
    keep: str = "month",
    strict: bool = True,
    **options,
) -> list[CleanReport]:
    """Clean new raw files, each batch into a folder of its own; return what each batch counted.

    A batch that is repeated after a failure overwrites its folder, so every
    raw row ends up in the clean table once.
    """

    reports = []

    def handle(batch: DataFrame, reader: str, number: int) -> None:
        folder = f"{clean_path.rstrip('/')}/{BATCH}={reader}-{number}"
        reports.append(
            run_clean(batch, policy, folder, tokens, mode="overwrite", keep=keep, strict=strict)
        )

    read_new(spark, raw_path, schema, checkpoint, handle, **options)
    return reports


def clean_schema(
    spark: SparkSession,
    schema: StructType | str,
    policy: DatasetPolicy,
    with_batch: bool = False,
    strict: bool = True,
) -> StructType:
    """The columns ``stream_clean`` writes for raw columns."""
    # Any key will do: only the types count.
    cleaned = clean(spark.createDataFrame([], schema), policy, KeyedTokens(bytes(16)), strict=strict)
    return _with_batch(cleaned.schema) if with_batch else cleaned.schema


def read_clean(spark: SparkSession, clean_path: str, schema: StructType) -> DataFrame:
    """All rows ``stream_clean`` wrote."""
    return spark.read.schema(_with_batch(schema)).parquet(clean_path).drop(BATCH)


def stream_curate(
    spark: SparkSession,
    clean_path: str,
    schema: StructType,
    policy: DatasetPolicy,
    target: Target,
    checkpoint: str,
    merge: MergeOptions = PLAIN,
    **options,
) -> list[CurateReport]:
    """Merge new clean files into the curated table; return what each batch counted.

    A repeated batch changes nothing.
    """
    reports = []

    def handle(batch: DataFrame, reader: str, number: int) -> None:
        reports.append(run_curate(batch.drop(BATCH), policy, target, merge, (reader, number)))

    read_new(spark, clean_path, _with_batch(schema), checkpoint, handle, **options)
    return reports


def _with_batch(schema: StructType) -> StructType:
    return StructType([*schema.fields, StructField(BATCH, StringType())])
