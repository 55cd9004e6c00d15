"""Catalog entries for tables that lie on storage."""

from __future__ import annotations

from pyspark.sql import Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from veiledlake.operators.governance import schema_columns, schema_drift


def declare_table(
    spark: SparkSession, name: str, ddl: str, path: str, partitions: tuple[str, ...] = ()
) -> None:
    """Register Parquet files under a name, if it is not taken."""
    by = f"PARTITIONED BY ({', '.join(f'`{p}`' for p in partitions)}) " if partitions else ""
    location = path.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({ddl}) USING parquet {by}LOCATION '{location}'")
    if partitions:
        spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")


def sync_catalog(
    spark: SparkSession,
    name: str,
    path: str,
    partitions: tuple[str, ...] = (),
    schema: StructType | None = None,
) -> list[Row]:
    """Make a catalog entry agree with the files, and return the columns that changed.

    All files are read for their schemas, unless ``schema`` states the result.
    Columns that are gone leave the entry as well, and an entry for another
    folder moves to this one. New columns and a new folder change the entry in
    place, so that readers always find it; only columns that are gone or have
    another type, or partitions that move, take a new entry. Files stay.
    """
    reader = spark.read.option("mergeSchema", "true")
    found = (reader if schema is None else reader.schema(schema)).parquet(path)
    columns = schema_columns(found, "", name)
    if spark.catalog.tableExists(name):
        drift = schema_drift(schema_columns(spark.table(name), "", name), columns)
    else:
        drift = columns.select(
            "schema",
            "table",
            "column",
            F.lit(None).cast("string").alias("declared_type"),
            F.col("catalog_type").alias("found_type"),
            F.lit("added").alias("change"),
        )
    changes = drift.collect()
    kinds = {f.name: f.dataType.simpleString() for f in found.schema.fields}
    known = spark.catalog.tableExists(name)
    moved = known and location(spark, name) != _qualified(spark, path)
    # Known partitions keep their folders, so an entry with partitions does not move in place.
    if not known or (moved and partitions) or not _can_alter(spark, name, changes, partitions):
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        ddl = ", ".join(f"`{c}` {kind}" for c, kind in kinds.items())
        declare_table(spark, name, ddl, path, partitions)
        return changes
    added = [r["column"] for r in changes]
    if added:
        columns = ", ".join(f"`{c}` {kinds[c]}" for c in added)
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({columns})")
    if moved:
        where = path.replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{where}'")
        spark.catalog.refreshTable(name)
    if partitions:
        spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
    return changes


def _can_alter(
    spark: SparkSession, name: str, changes: list[Row], partitions: tuple[str, ...]
) -> bool:
    """Whether an entry can change in place: columns are only added, and it has the same partitions."""
    columns = spark.catalog.listColumns(name)
    same = [c.name for c in columns if c.isPartition] == list(partitions)
    added = all(r["change"] == "added" and r["column"] not in partitions for r in changes)
    return same and added


def location(spark: SparkSession, name: str) -> str:
    """The folder a catalog entry points to."""
    details = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").filter("col_name = 'Location'")
    return details.first()["data_type"]


def _qualified(spark: SparkSession, path: str) -> str:
    """A path as the catalog would show it."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.makeQualified(target).toString()
