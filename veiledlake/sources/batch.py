"""Whole-table reads."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# The headings of a requirement sheet, and our column names.
SHEET_HEADINGS = {
    "Schema": "schema",
    "Table": "table",
    "Column": "column",
    "Final De-ID Requirement": "requirement",
}


def scan_dataset(
    spark: SparkSession,
    table: str | None = None,
    path: str | None = None,
    schema: StructType | str | None = None,
) -> DataFrame:
    """Read one dataset from the catalog, or from a Parquet folder.

    A schema keeps the types of partition columns such as ``01`` as stated.
    """
    if (table is None) == (path is None):
        raise ValueError("give either a table or a path")
    if table is not None:
        return spark.table(table)
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def read_requirements(
    spark: SparkSession, path: str, banner: bool = True, multi_line: bool = False
) -> DataFrame:
    """Read a requirement sheet exported as CSV: schema, table, column, requirement.

    With ``banner`` a title line stands above the headings of each file. Title
    and order of the columns may differ between files: a file's headings are
    its first row below the title, whatever it says, and its columns are found
    by them; others are ignored. A later row that repeats all of its file's
    headings is no requirement and is left out too. A file without rows gives
    none. ``multi_line`` is for cells that hold line breaks, and reads each
    file in one task.
    """
    lines = spark.read.text(path)
    headed = reduce(and_, (F.contains("value", F.lit(h)) for h in SHEET_HEADINGS))
    commas = F.length("value") - F.length(F.replace("value", F.lit(","), F.lit("")))
    width = lines.agg(F.max(F.when(headed, commas + 1))).first()[0] or len(SHEET_HEADINGS)
    layout = ", ".join(f"c{i} string" for i in range(width))
    reader = spark.read.schema(layout).option("multiLine", multi_line).option("header", banner)
    rows = reader.csv(path).select(
        F.array(*(f"c{i}" for i in range(width))).alias("cells"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
    )
    # The rows of a file's first block stand in order in one task.
    place = F.monotonically_increasing_id()
    heads = (
        rows.withColumn("place", place)
        .filter("start = 0")
        .groupBy("file")
        .agg(F.min_by("cells", "place").alias("headings"))
    )
    wanted = F.array(*(F.lit(h) for h in SHEET_HEADINGS))
    absent = heads.select("file", F.array_except(wanted, "headings").alias("absent"))
    lacking = absent.filter(F.size("absent") > 0).first()
    if lacking:
        raise ValueError(f"the sheet {lacking['file']} lacks the headings {sorted(lacking['absent'])}")
    cells = rows.join(heads, "file").filter(~F.col("cells").eqNullSafe(F.col("headings")))
    return cells.select(
        *(
            F.element_at("cells", F.array_position("headings", F.lit(h)).cast("int")).alias(name)
            for h, name in SHEET_HEADINGS.items()
        )
    )


def select_tables(tables: DataFrame, schema: str, pattern: str = "%") -> DataFrame:
    """Tables of one schema whose name matches a LIKE pattern."""
    return tables.filter((F.col("schema") == schema) & F.col("table").like(pattern))


def fan_out(tables: DataFrame, policies: DataFrame) -> DataFrame:
    """Scheduled tables with their policy, by the dataset name ``schema_table``."""
    named = tables.select(F.concat_ws("_", "schema", "table").alias("dataset"), "schema", "table")
    return named.join(policies, "dataset")
