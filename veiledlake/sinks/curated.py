"""Curated tables: one row per key, replaced by bucket of the key or by partition.

Parquet has no MERGE, so what a merge touches is read, merged and overwritten.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from functools import reduce
from operator import and_, or_
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from veiledlake.operators.upsert import DELETE, OP, align, matched
from veiledlake.sinks.clean import laid_out
from veiledlake.storage import children, delete

Batch = tuple[str, int]  # reader id and batch number

# What blank text in a partition column is stored as: a folder name cannot be blank,
# and Spark would read null. Text that begins like this is stored with one more in front.
BLANK = "__blank__"
# Partitions that one catalog statement drops.
STATEMENT = 200
OVERWRITE = "spark.sql.sources.partitionOverwriteMode"
# Buckets of a new table: a merge of few keys rewrites few of them.
BUCKETS = 16
BUCKET, PART, LIVE = HELPERS = ("_bucket", "_part", "_live")
PLACE = (BUCKET, PART)
# The part of rows with a key, and the bucket of rows without.
KEYED, ALONE = "keyed", -1
ROWS, APPLIED = "buckets=", "applied"


def stored(df: DataFrame, partitions: Sequence[str]) -> DataFrame:
    """Rows as they are written, with text that a partition can hold."""
    return _recoded(
        df,
        partitions,
        lambda c: F.when(c == "", BLANK).when(c.startswith(BLANK), F.concat(F.lit(BLANK), c)).otherwise(c),
    )


def shown(df: DataFrame, partitions: Sequence[str]) -> DataFrame:
    """Rows as they were before ``stored``."""
    rest = F.lit(len(BLANK) + 1)
    return _recoded(
        df,
        partitions,
        lambda c: F.when(c.startswith(BLANK), F.substring(c, rest, F.length(c))).otherwise(c),
    )


def _recoded(df: DataFrame, partitions: Sequence[str], code: Callable[[Column], Column]) -> DataFrame:
    wanted = {p.lower() for p in partitions}
    texts = [f.name for f in df.schema.fields if f.name.lower() in wanted and isinstance(f.dataType, StringType)]
    return df.withColumns({c: code(F.col(c)) for c in texts})


class BucketTable:
    """A Parquet folder partitioned by buckets of the key: a merge reads and writes only the buckets of its keys.

    ``_bucket`` is a hash of the key by the number of buckets, and Spark's dynamic
    partition overwrite replaces the buckets written. Rows with a null key part
    match nothing; each batch puts its own into a partition of its own, so they
    are never rewritten, and a repeated batch replaces them. A bucket written
    holds one more row that is not shown, so a bucket left without rows is
    replaced as well. Last comes a note of the reader's batch.

    Merging the same batch again gives the same rows, so a run that failed half-way is
    repeated. One writer at a time; a reader may see part of a merge.
    """

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], buckets: int = BUCKETS) -> None:
        self.spark = spark
        self.path = path.rstrip("/")
        self.keys = list(keys)
        self.buckets = next((int(n.removeprefix(ROWS)) for n in self._folders()), buckets)

    def exists(self) -> bool:
        return bool(self._folders())

    def read(self) -> DataFrame:
        if not self.exists():
            raise FileNotFoundError(f"no table in {self.path}")
        return self._stored().filter(LIVE).drop(*HELPERS)

    def has_applied(self, batch: Batch) -> bool:
        if not children(self.spark, f"{self.path}/{APPLIED}"):
            return False
        noted = self.spark.read.schema("number long, reader string").parquet(f"{self.path}/{APPLIED}")
        last = noted.filter(F.col("reader") == batch[0]).agg(F.max("number")).first()[0]
        return last is not None and last >= batch[1]

    def note_applied(self, batch: Batch) -> None:
        noted = self.spark.range(batch[1], batch[1] + 1, 1, 1).toDF("number").withColumn("reader", F.lit(batch[0]))
        _overwrite(noted, f"{self.path}/{APPLIED}", ["reader"])

    def merge(
        self,
        latest: DataFrame,
        merged: Callable[[DataFrame | None, DataFrame], DataFrame],
        *,
        null_safe: bool = False,
        null_keys: bool = True,
        batch: Batch | None = None,
    ) -> None:
        """Merge a batch with one row per key; ``merged`` gives the rows after it, from those there and those of the batch.

        ``null_keys`` false states that no row of the batch has a null key part.

        With ``null_safe`` such rows are bucketed like the others, and those that earlier batches kept by themselves are moved into the buckets.
        """
        clash = {c.lower() for c in latest.columns} & set(HELPERS)
        if clash:
            raise ValueError(f"the table needs the names {sorted(clash)} itself")
        null_key = reduce(or_, (F.col(k).isNull() for k in self.keys))
        keyed = latest if null_safe or not null_keys else latest.filter(~null_key)
        stored = self._stored() if self.exists() else None
        # Buckets are those of the table's types.
        new = keyed.select(*self.keys)
        new = new if stored is None else align(new, stored.select(*self.keys).schema)
        touched = self._placed(new).select(*PLACE).distinct()
        base = None
        if stored is not None:
            if null_safe:
                alone = stored.filter(F.col(BUCKET) == ALONE).select(*PLACE).distinct()
                touched = touched.unionByName(alone)
            # A count is asked for so that the scan is pruned while it runs: Spark wants a filter on the small side.
            wanted = touched.groupBy(*PLACE).count().filter("count > 0").drop("count")
            base = stored.join(F.broadcast(wanted), list(PLACE), "left_semi").filter(LIVE).drop(*HELPERS)
        rows = self._placed(merged(base, keyed)).withColumn(LIVE, F.lit(True))
        if null_keys and not null_safe:
            none = None if base is None else base.filter(F.lit(False))
            alone = merged(none, latest.filter(null_key))
            name = uuid.uuid4().hex if batch is None else f"{batch[0]}-{batch[1]}"
            alone = alone.withColumns({BUCKET: F.lit(ALONE), PART: F.lit(f"batch {name}"), LIVE: F.lit(True)})
            rows = rows.unionByName(alone)
        marks = touched.withColumn(LIVE, F.lit(False))
        rows = laid_out(rows.unionByName(marks, allowMissingColumns=True), PLACE)
        _overwrite(rows, f"{self.path}/{ROWS}{self.buckets}", PLACE)

    def register(self, name: str) -> list[Row]:
        """Point a catalog entry, a view, to the table; return its columns if it is new or they changed."""
        columns = [Row(column=c, kind=t) for c, t in self.read().dtypes]
        old = []
        if self.spark.catalog.tableExists(name):
            old = [Row(column=c, kind=t) for c, t in self.spark.table(name).dtypes]
        if columns == old:
            return []
        names = ", ".join(_quoted(c.column) for c in columns)
        source = f"parquet.{_quoted(f'{self.path}/{ROWS}{self.buckets}')}"
        self.spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT {names} FROM {source} WHERE {LIVE}")
        return columns

    def _folders(self) -> list[str]:
        return [n for n in children(self.spark, self.path) if n.startswith(ROWS)]

    def _stored(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/{ROWS}{self.buckets}")

    def _placed(self, df: DataFrame) -> DataFrame:
        bucket = F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")
        return df.withColumns({BUCKET: bucket, PART: F.lit(KEYED)})


class PartitionedTable:
    """A catalog table by partition, of which a merge reads and writes only what it touches.

    What is touched stays a table: it prunes the scan while it runs, and Spark's
    dynamic partition overwrite replaces the partitions. Each partition switches in
    one step; the table as a whole does not. A run that failed in between is
    repeated: merging the same batch again gives the same rows, except that
    rows with a null key part, which match nothing, may come twice.
    """

    def __init__(
        self, spark: SparkSession, name: str, path: str, partitions: Sequence[str]
    ) -> None:
        if not partitions:
            raise ValueError("the table needs partition columns")
        self.spark = spark
        self.name = name
        self.path = path.rstrip("/")
        self.partitions = list(partitions)

    def exists(self) -> bool:
        return self.spark.catalog.tableExists(self.name)

    def has_applied(self, batch: Batch) -> bool:
        return _noted_batch(self.spark, self.name, batch)

    def note_applied(self, batch: Batch) -> None:
        _note_batch(self.spark, self.name, batch)

    def read(self, only: DataFrame | None = None) -> DataFrame:
        """The table, or those of its partitions that ``only`` lists; the others are not scanned."""
        table = self.spark.table(self.name)
        if only is not None:
            # The filter on the count is what lets Spark prune partitions while it runs.
            wanted = stored(only, self.partitions).filter("touched_rows > 0")
            wanted = wanted.toDF(*(f"_only_{c}" for c in only.columns))
            same = reduce(and_, (_no_null(p) == _no_null(f"_only_{p}") for p in self.partitions))
            table = table.join(F.broadcast(wanted), same, "left_semi")
        return shown(table, self.partitions)

    def touched(
        self, batch: DataFrame, keys: Sequence[str], null_safe: bool = False, small: bool = False
    ) -> DataFrame:
        """Partitions a batch changes: where its rows go, and where their old versions lie, with their number.

        It has no more rows than the catalog lists partitions and the batch brings new ones.
        """
        found = batch.select(*self.partitions)
        if not self.keeps_place(keys):
            old = matched(self.read(), batch, keys, null_safe, small)
            found = found.unionByName(old.select(*self.partitions))
        return found.groupBy(*self.partitions).agg(F.count(F.lit(1)).alias("touched_rows"))

    def keeps_place(self, keys: Sequence[str]) -> bool:
        """Whether a key stays in its partition."""
        known = {k.lower() for k in keys}
        return all(p.lower() in known for p in self.partitions)

    def create(self, schema: StructType) -> None:
        columns = ", ".join(f"{_quoted(f.name)} {f.dataType.simpleString()}" for f in schema.fields)
        by = ", ".join(_quoted(p) for p in self.partitions)
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.name} ({columns}) USING parquet "
            f"PARTITIONED BY ({by}) LOCATION {_literal(self.path)}"
        )

    def replace(self, df: DataFrame, touched: DataFrame | None = None, moves: bool = True) -> None:
        """Make rows the whole content of the touched partitions; the others stay.

        Spark overwrites the partitions that get rows. Touched ones that get none any more, which
        happens only if rows may move or go (``moves``), are dropped after that: only these are listed.
        """
        emptied = []
        if touched is not None and moves:
            left = df.select(*self.partitions).distinct().toDF(*(f"_left_{p}" for p in self.partitions))
            same = reduce(and_, (F.col(p).eqNullSafe(F.col(f"_left_{p}")) for p in self.partitions))
            texts = [F.col(p).cast("string").alias(p) for p in self.partitions]
            emptied = stored(touched.join(left, same, "left_anti"), self.partitions).select(*texts).collect()
        rows = laid_out(stored(df, self.partitions), self.partitions)
        conf = df.sparkSession.conf  # a stream's batches have a session of their own
        before = conf.get(OVERWRITE)
        conf.set(OVERWRITE, "dynamic")
        try:
            rows.select(*self.spark.table(self.name).columns).write.mode("overwrite").insertInto(self.name)
        finally:
            conf.set(OVERWRITE, before)
        self._drop(emptied)

    def _drop(self, emptied: list[Row]) -> None:
        for i in range(0, len(emptied), STATEMENT):
            some = emptied[i : i + STATEMENT]
            files = self.spark.table(self.name).filter(self._in(some)).inputFiles()
            specs = ", ".join(f"PARTITION ({self._spec(row)})" for row in some)
            self.spark.sql(f"ALTER TABLE {self.name} DROP IF EXISTS {specs}")
            for folder in {unquote(f.rpartition("/")[0]) for f in files}:
                delete(self.spark, folder)

    def _spec(self, values: Sequence) -> str:
        pairs = zip(self.partitions, values, strict=True)
        return ", ".join(f"{_quoted(p)} = {_literal(v)}" for p, v in pairs)

    def _in(self, rows: list[Row]) -> Column:
        """Rows' partition is one of those given; halved again and again to keep the tree flat."""
        if not rows:
            return F.lit(False)
        if len(rows) > 1:
            half = len(rows) // 2
            return self._in(rows[:half]) | self._in(rows[half:])
        parts = [
            F.col(p).isNull() if v is None else F.col(p).cast("string") == F.lit(v)
            for p, v in zip(self.partitions, rows[0], strict=True)
        ]
        return reduce(and_, parts)


class MergeTable:
    """A catalog table whose format supports MERGE, such as Delta: merged in one transaction."""

    def __init__(self, spark: SparkSession, name: str, table_format: str = "delta") -> None:
        self.spark = spark
        self.name = name
        self.table_format = table_format

    def exists(self) -> bool:
        return self.spark.catalog.tableExists(self.name)

    def has_applied(self, batch: Batch) -> bool:
        return _noted_batch(self.spark, self.name, batch)

    def note_applied(self, batch: Batch) -> None:
        _note_batch(self.spark, self.name, batch)

    def read(self) -> DataFrame:
        return self.spark.table(self.name)

    def create(self, df: DataFrame, partitions: Sequence[str] = ()) -> None:
        writer = laid_out(df, partitions).write.format(self.table_format)
        if partitions:
            writer = writer.partitionBy(*partitions)
        writer.saveAsTable(self.name)

    def merge(
        self,
        batch: DataFrame,
        keys: Sequence[str],
        *,
        null_safe: bool = False,
        apply_deletes: bool = False,
        only_if_newer: str | None = None,
        missing: str = "error",
    ) -> None:
        """Merge a batch with one row per key, by the same rules as ``upsert``."""
        batch = align(batch, self.read().schema, missing)
        pairs = [(F.col(f"{self.name}.{k}"), batch[k]) for k in keys]
        same = reduce(and_, (a.eqNullSafe(b) if null_safe else a == b for a, b in pairs))
        merging = batch.mergeInto(self.name, same)
        newer = F.lit(True)
        if only_if_newer is not None:
            newer = batch[only_if_newer] >= F.col(f"{self.name}.{only_if_newer}")
        if apply_deletes:
            deleted = batch[OP].eqNullSafe(DELETE)
            merging = merging.whenMatched(newer & deleted).delete()
            merging = merging.whenMatched(newer).updateAll().whenNotMatched(~deleted).insertAll()
        else:
            merging = merging.whenMatched(newer).updateAll().whenNotMatched().insertAll()
        merging.merge()


def _no_null(partition: str) -> Column:
    """A partition's value as stored, or a text that is none: pruning while a query runs takes plain equality only."""
    return F.coalesce(F.col(partition).cast("string"), F.lit(f"{BLANK}null"))


def _overwrite(df: DataFrame, path: str, by: Sequence[str]) -> None:
    """Replace the partitions that get rows, and leave the others."""
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.option("compression", "snappy").partitionBy(*by).parquet(path)


def _noted_batch(spark: SparkSession, table: str, batch: Batch) -> bool:
    """Whether a table's properties say that it has taken a reader's batch."""
    if not spark.catalog.tableExists(table):
        return False
    properties = spark.sql(f"SHOW TBLPROPERTIES {table}")
    noted = properties.filter(F.col("key") == f"applied.{batch[0]}").collect()
    return bool(noted) and int(noted[0]["value"]) >= batch[1]


def _note_batch(spark: SparkSession, table: str, batch: Batch) -> None:
    name = _literal(f"applied.{batch[0]}")
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ({name} = '{batch[1]}')")


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _literal(value) -> str:
    if value is None:
        return "null"
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    if isinstance(value, (bool, int, float)):
        return str(value).lower()
    return f"'{value}'"
