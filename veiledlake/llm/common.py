"""Pieces that several operators share."""

from __future__ import annotations

import string
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veiledlake import storage
from veiledlake.operators.sizes import BROADCAST_BYTES, memory_size

# Whether a query removes its shuffle files at its end.
CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
READ_ROWS = "spark.sql.parquet.columnarReaderBatchSize"
# Rows that Python adds columns to at once, and rows of texts that a task decodes at once.
SLICE = 1000
# A key is hot with one part in so many of all rows.
HOT = 10_000
SPACE_WORDS = r"[^\x20\x09-\x0D]+"
PLAIN_WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship(spark: SparkSession) -> None:
    """Let Python on the executors import the library, wherever the driver has it from. Once a session."""
    context, package = spark.sparkContext, Path(__file__).parent.parent
    if getattr(context, "_shipped_library", False) or not package.is_dir():
        return
    archive = Path(tempfile.mkdtemp(prefix="library-"), "veiledlake.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, Path(package.name, file.relative_to(package)))
    context.addPyFile(str(archive))
    context._shipped_library = True


def small_batches(spark: SparkSession) -> None:
    """Let Python get at most `SLICE` rows at once from now on: whole texts of more rows are held on both sides, for each task.

    It holds for what the session plans later, also by itself, as results are computed only when they are used.
    """
    if not 0 < int(spark.conf.get(ARROW_ROWS)) <= SLICE:
        spark.conf.set(ARROW_ROWS, str(SLICE))
    small_reads(spark)


def small_reads(spark: SparkSession) -> None:
    """Let a task decode at most `SLICE` rows of a Parquet file at once from now on, as texts of Spark's 4,096 fill tens of MB."""
    if int(spark.conf.get(READ_ROWS)) > SLICE:
        spark.conf.set(READ_ROWS, str(SLICE))


def lower_ascii(text: str) -> Column:
    """A-Z in lower case, all else as it is; null is the empty text.

    `lower` does this for plain ASCII and is much faster than `translate`.
    """
    c = F.coalesce(F.col(text), F.lit(""))
    plain = F.octet_length(c) == F.length(c)
    return F.when(plain, F.lower(c)).otherwise(F.translate(c, string.ascii_uppercase, string.ascii_lowercase))


def words(text: str, pattern: str) -> Column:
    return F.regexp_extract_all(lower_ascii(text), F.lit(pattern), F.lit(0))


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Names for helper columns that the table does not have."""
    taken, found = {c.lower() for c in df.columns}, []
    for name in names:
        while (name := f"_{name}").lower() in taken:
            pass
        taken.add(name.lower())
        found.append(name)
    return found


def settled(df: DataFrame) -> DataFrame:
    """Written to the folder that the cluster shares: executors may be lost, and nothing is computed twice.

    The folder goes with the session. The shuffles behind it go at once, as nothing needs them any more.
    """
    spark, folder = df.sparkSession, storage.work_folder(df.sparkSession)
    before = spark.conf.get(CLEAN_UP)
    spark.conf.set(CLEAN_UP, "true")
    try:
        df.write.option("compression", "zstd").parquet(folder)
    finally:
        spark.conf.set(CLEAN_UP, before)
    return spark.read.schema(df.schema).parquet(folder)


def add_columns(df: DataFrame, inputs: list[str | Column], added: str, make: Callable) -> DataFrame:
    """All rows and columns, and those of the schema `added`, which `make` gives for the inputs of an Arrow batch.

    Everything is computed once, whatever is done with the columns. All columns of the table pass through Python, so
    select what is needed first. Columns of the same names are replaced.
    """
    kind = T.StructType.fromDDL(added)
    kept = df.drop(*kind.names)
    n = len(kept.columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, SLICE):
                batch = whole.slice(start, SLICE)
                columns = [*batch.columns[:n], *make(*batch.columns[n:])]
                yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names[:n], *kind.names])

    names = fresh(df, *(f"in{i}" for i in range(len(inputs))))
    columns = [F.col(c) if isinstance(c, str) else c for c in inputs]
    ready = df.withColumns(dict(zip(names, columns, strict=True)))
    return ready.select(*kept.columns, *names).mapInArrow(run, T.StructType(kept.schema.fields + kind.fields))


def sample_of(rows: DataFrame, text: str, most: int) -> DataFrame:
    """At most so many rows, the first by a hash of their text; all rows are counted, and few are sorted.

    Twice the rows wanted fall below the bound on the hash, so that copies of one text do not leave too few.
    """
    place, found = F.xxhash64(text), rows.count()
    if found > 2 * most:
        rows = rows.where(F.pmod(place, F.lit(1 << 30)) < (1 << 30) * 2 * most / found)
    return rows.withColumn("_place", place).orderBy("_place").limit(most).drop("_place")


def is_small(df: DataFrame, most: int = BROADCAST_BYTES) -> bool:
    """Whether a settled table, as measured, is within a bound for broadcasts: the library's, or a smaller one."""
    return df.agg(memory_size(df.schema, df.columns)).first()[0] <= most


def broadcast_if_small(df: DataFrame, most: int = BROADCAST_BYTES) -> DataFrame:
    """A settled table, marked for broadcast if its measured size is within the bound.

    Beyond the bound the join shuffles both sides, and splits what is skewed.
    """
    return F.broadcast(df) if is_small(df, most) else df


def bit_table(place: Column, rows: DataFrame, bits: int) -> np.ndarray:
    """A table of 2 ** `bits` bits, set at the last bits of a number of each row: its size is fixed, whatever the rows.

    It tells which keys surely are in no row. Others are looked up in full later, so a full table costs work only.
    """
    at = place.bitwiseAND(F.lit((1 << bits) - 1)) + 1
    buckets = (
        rows.select(F.bitmap_bucket_number(at).alias("bucket"), F.bitmap_bit_position(at).alias("bit"))
        .groupBy("bucket")
        .agg(F.bitmap_construct_agg("bit").alias("bits"))
        .collect()
    )
    table = np.zeros((1 << bits) // 8, np.uint8)
    for row in buckets:
        found = np.frombuffer(bytes(row["bits"]), np.uint8)
        start = (row["bucket"] - 1) * len(found)
        table[start : start + len(found)] = found
    return table


def is_set(table: np.ndarray, places: np.ndarray) -> np.ndarray:
    at = places.view(np.uint64) & np.uint64(8 * len(table) - 1)
    return (table[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1


def join_by_weight(
    rows: DataFrame, keyed: DataFrame, on: list[str], weight: str, most: int = BROADCAST_BYTES
) -> DataFrame:
    """Rows with what `keyed` holds for their key; both tables are settled, and `keyed` has one row per key.

    A `keyed` of up to `most` bytes is broadcast. Otherwise the keys with more than one `HOT`th of the weight, of which there are fewer
    than `HOT`, are broadcast, and only the rows of the other keys are shuffled: no task gets a hot key.
    """
    columns = [*rows.columns, *(c for c in keyed.columns if c not in on and c != weight)]
    light = keyed.drop(weight)
    if is_small(light, most):
        return rows.join(F.broadcast(light), on).select(columns)
    bound = keyed.agg(F.sum(weight)).first()[0] / HOT
    hot = keyed.where(F.col(weight) > bound).drop(weight)
    cold = keyed.where(F.col(weight) <= bound).drop(weight)
    rest = rows.join(F.broadcast(hot.select(*on)), on, "left_anti")
    return rows.join(F.broadcast(hot), on).select(columns).union(rest.join(cold, on).select(columns))
