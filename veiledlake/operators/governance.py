"""Building and checking policies from column lists and approved requirements.

Two tables drive this: ``columns`` (schema, table, ordinal, column,
source_type, pk_position) and ``requirements`` (schema, table, column,
requirement). Results are long: one row per table, rule and column, never a
list per table, so a table with very many columns is still spread over tasks.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veiledlake.functions.naming import catalog_type_of, pii_type_of
from veiledlake.policy import DatasetPolicy

TABLE = ["schema", "table"]
COLUMN = [*TABLE, "column"]

# What a requirement sheet may say; an empty cell is fine as well.
REQUIREMENTS = ("None Required", "Hash", "Exclude")


def requirements_for_table(requirements: DataFrame, schema: str, table: str) -> DataFrame:
    return requirements.filter((F.col("schema") == schema) & (F.col("table") == table))


def requirement_values(requirements: DataFrame) -> DataFrame:
    return requirements.select("requirement").distinct()


def requirement_diff(requirements: DataFrame) -> DataFrame:
    """Known values never used (``unused``), and values the sheet should not hold (``unknown``)."""
    known = F.explode(F.array(*(F.lit(r) for r in (*REQUIREMENTS, None)))).alias("requirement")
    known = requirements.sparkSession.range(1).select(
        known, F.lit(True).alias("is_known"), F.lit(False).alias("is_used")
    )
    used = requirement_values(requirements).select(
        "requirement", F.lit(False).alias("is_known"), F.lit(True).alias("is_used")
    )
    both = known.unionAll(used).groupBy("requirement")
    flags = both.agg(F.bool_or("is_known").alias("is_known"), F.bool_or("is_used").alias("is_used"))
    return flags.filter("is_known <> is_used").select(
        F.when(F.col("is_known"), "unused").otherwise("unknown").alias("side"), "requirement"
    )


def single_schema_check(columns: DataFrame) -> DataFrame:
    """One row: how many schemas a column list covers, and whether it is exactly one.

    Rows without a schema count as one of their own, and no schema is never a single one.
    """
    found = columns.select("schema").distinct()
    return found.agg(
        F.count(F.lit(1)).alias("n_schemas"),
        ((F.count(F.lit(1)) == 1) & F.bool_and(F.col("schema").isNotNull())).alias("is_single"),
    )


def table_column_counts(tables: DataFrame, columns: DataFrame) -> DataFrame:
    """Number of columns of each table, zero included."""
    counts = columns.groupBy(*TABLE).agg(F.count(F.lit(1)).alias("n_columns"))
    return tables.join(counts, TABLE, "left").select(
        *TABLE, F.coalesce("n_columns", F.lit(0)).alias("n_columns")
    )


def empty_table_check(tables: DataFrame, columns: DataFrame) -> DataFrame:
    """Tables without columns, which must not be processed."""
    return table_column_counts(tables, columns).filter("n_columns = 0").select(*TABLE)


def map_source_types(columns: DataFrame, legacy: bool = False) -> DataFrame:
    return columns.withColumn("catalog_type", catalog_type_of(F.col("source_type"), legacy))


def augment_schema(
    columns: DataFrame, commit_time_schemas: Iterable[str]
) -> DataFrame:
    """Add the feed's own columns to each table: ``op`` first, the commit time last if recorded.

    ``commit_time_schemas`` are the source schemas whose feeds record it.
    """
    last = columns.groupBy(*TABLE).agg(F.max("ordinal").alias("last"))
    added = F.array(
        F.struct(
            F.lit(0).alias("ordinal"), F.lit("op").alias("column"), F.lit("string").alias("t")
        ),
        F.struct(
            (F.col("last") + 1).alias("ordinal"),
            F.lit("dms_commit_ts").alias("column"),
            F.lit("timestamp").alias("t"),
        ),
    )
    extra = (
        last.select(*TABLE, F.inline(added))
        .filter((F.col("column") == "op") | F.col("schema").isin(list(commit_time_schemas)))
        .withColumnRenamed("t", "source_type")
    )
    own = columns.select(*TABLE, "ordinal", "column", "source_type")
    return own.unionByName(extra)


def catalog_schema(
    columns: DataFrame,
    commit_time_schemas: Iterable[str],
    legacy: bool = False,
) -> DataFrame:
    """The columns and types to declare for each raw table."""
    return map_source_types(augment_schema(columns, commit_time_schemas), legacy).select(
        *TABLE, "ordinal", "column", "catalog_type"
    )


def table_ddl(catalog: DataFrame, schema: str, table: str) -> str:
    """One table's columns as DDL text, in order."""
    rows = catalog.filter((F.col("schema") == schema) & (F.col("table") == table))
    ordered = rows.orderBy("ordinal").select("column", "catalog_type").collect()
    return ", ".join(f"`{r['column']}` {r['catalog_type']}" for r in ordered)


def classify_columns(columns: DataFrame) -> DataFrame:
    """Columns whose name points to a PII type."""
    found = columns.withColumn("pii_type", pii_type_of(F.col("column")))
    return found.filter(F.col("pii_type").isNotNull())


def policy_columns(requirements: DataFrame) -> DataFrame:
    """Columns to exclude and columns to hash, each once."""
    rule = F.lower("requirement")
    return (
        requirements.select(*COLUMN, rule.alias("rule"))
        .filter(F.col("rule").isin("exclude", "hash"))
        .distinct()
    )


def primary_keys(columns: DataFrame) -> DataFrame:
    """Key columns of each table with their place in the key."""
    keys = columns.filter(F.col("pk_position").isNotNull())
    return keys.select(*TABLE, F.col("pk_position").alias("position"), "column")


def build_policy(columns: DataFrame, requirements: DataFrame) -> DataFrame:
    """The rules of each table: its key, its PII columns by type, its dropped columns.

    A table without requirements still gets its key. A column to hash whose
    name points to no type gets no rule; ``policy_gaps`` reports it.
    """
    pii_type = F.when(F.col("rule") == "hash", pii_type_of(F.col("column")))
    marked = policy_columns(requirements).select(
        *TABLE,
        F.when(F.col("rule") == "hash", "pii").otherwise("exclude").alias("rule"),
        F.lit(None).cast("int").alias("position"),
        "column",
        pii_type.alias("pii_type"),
    )
    marked = marked.filter((F.col("rule") == "exclude") | F.col("pii_type").isNotNull())
    rules = (
        primary_keys(columns)
        .select(*TABLE, F.lit("key").alias("rule"), "position", "column")
        .withColumn("pii_type", F.lit(None).cast("string"))
        .unionByName(marked)
    )
    # Only tables with a key are datasets. They are one row each, and nothing is aggregated
    # after the join, so the adaptive plan splits the rules of a table with very many columns.
    datasets = primary_keys(columns).select(*TABLE).distinct()
    name = F.concat_ws("_", "schema", "table")
    return rules.join(datasets, TABLE, "left_semi").select(
        name.alias("dataset"),
        F.concat_ws("/", "schema", name).alias("folder"),
        "rule",
        "position",
        "column",
        "pii_type",
    )


def load_policies(rules: DataFrame, datasets: Iterable[str]) -> dict[str, DatasetPolicy]:
    """Policies of the named datasets, for running them."""
    wanted = rules.filter(F.col("dataset").isin(list(datasets)))
    found: dict[str, list] = {}
    for row in wanted.orderBy("dataset", "rule", "position", "column").collect():
        found.setdefault(row["dataset"], []).append(row)
    return {
        name: DatasetPolicy(
            table=name,
            folder=rows[0]["folder"],
            keys=tuple(r["column"] for r in rows if r["rule"] == "key"),
            pii={r["column"]: r["pii_type"] for r in rows if r["rule"] == "pii"},
            drops=tuple(r["column"] for r in rows if r["rule"] == "exclude"),
        )
        for name, rows in found.items()
    }


def policy_with_keys(columns: DataFrame, requirements: DataFrame) -> DataFrame:
    """Per table with a key: how many key, excluded and hashed columns it has."""
    keys = primary_keys(columns).groupBy(*TABLE).agg(F.count(F.lit(1)).alias("n_keys"))
    marked = (
        policy_columns(requirements)
        .groupBy(*TABLE)
        .agg(
            F.count_if(F.col("rule") == "exclude").alias("n_excluded"),
            F.count_if(F.col("rule") == "hash").alias("n_hashed"),
        )
    )
    return keys.join(marked, TABLE, "left").na.fill(0, ["n_excluded", "n_hashed"])


def policy_gaps(columns: DataFrame, requirements: DataFrame) -> DataFrame:
    """Columns that may stay in clear by mistake.

    ``no type``: to be hashed, but the name points to no type.
    ``in clear``: the name points to a type, but nothing hashes or excludes it.
    """
    marked = policy_columns(requirements)
    hashed = marked.filter("rule = 'hash'")
    untyped = hashed.filter(pii_type_of(F.col("column")).isNull())
    clear = classify_columns(columns).join(marked.select(*COLUMN).distinct(), COLUMN, "left_anti")
    none = F.lit(None).cast("string")
    return untyped.select(*COLUMN, F.lit("no type").alias("gap"), none.alias("pii_type")).unionAll(
        clear.select(*COLUMN, F.lit("in clear").alias("gap"), "pii_type").distinct()
    )


def policy_mismatch(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rules of two hops that differ: on one side only, or in letter case, place or type."""
    a = left.select("dataset", "rule", *_named("left"))
    b = right.select("dataset", "rule", *_named("right"))
    both = a.withColumn("name", F.lower("left_column")).join(
        b.withColumn("name", F.lower("right_column")), ["dataset", "rule", "name"], "full_outer"
    )
    difference = (
        F.when(F.col("right_column").isNull(), "left only")
        .when(F.col("left_column").isNull(), "right only")
        .when(F.col("left_column") != F.col("right_column"), "letter case")
        .when(_differs("position"), "position")
        .when(_differs("pii_type"), "pii type")
    )
    return (
        both.withColumn("difference", difference)
        .filter(F.col("difference").isNotNull())
        .select("dataset", "rule", "left_column", "right_column", "difference")
    )


def schema_drift(declared: DataFrame, found: DataFrame) -> DataFrame:
    """Columns added, removed or retyped since they were declared."""
    old = declared.select(*COLUMN, F.col("catalog_type").alias("declared_type"))
    new = found.select(*COLUMN, F.col("catalog_type").alias("found_type"))
    change = (
        F.when(F.col("declared_type").isNull(), "added")
        .when(F.col("found_type").isNull(), "removed")
        .when(F.col("declared_type") != F.col("found_type"), "retyped")
    )
    return (
        old.join(new, COLUMN, "full_outer")
        .withColumn("change", change)
        .filter(F.col("change").isNotNull())
    )


def schema_columns(df: DataFrame, schema: str, table: str) -> DataFrame:
    """The columns a table really has."""
    rows = [
        F.struct(
            F.lit(schema).alias("schema"),
            F.lit(table).alias("table"),
            F.lit(i).alias("ordinal"),
            F.lit(f.name).alias("column"),
            F.lit(f.dataType.simpleString()).alias("catalog_type"),
        )
        for i, f in enumerate(df.schema.fields)
    ]
    return df.sparkSession.range(1).select(F.inline(F.array(*rows)))


def _named(side: str) -> list[Column]:
    return [F.col(c).alias(f"{side}_{c}") for c in ("column", "position", "pii_type")]


def _differs(column: str) -> Column:
    return ~F.col(f"left_{column}").eqNullSafe(F.col(f"right_{column}"))
