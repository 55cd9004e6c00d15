"""Policies built and checked over a column list with one row per order."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veiledlake.catalogue.inputs import (
    COLUMNS_SQL,
    TABLES_SQL,
    column_list,
    columns,
    requirements,
    tables,
)
from veiledlake.catalogue.registry import query
from veiledlake.operators import governance as g

PII_SQL = """
    case when "column" like '%phone%' or "column" like '%phnnum_txt%' then 'phone_num'
         when "column" like '%fnm%' or "column" like '%mnm%' or "column" like '%lnm%'
             then 'person_nm'
         when "column" like '%fein%' then 'fein'
         when "column" like '%\\_id%' escape '\\' then 'case_id'
         when "column" like '%ssn%' then 'ssn'
         when "column" like '%email%' then 'email' end"""
LEGACY_SQL = """
    case when source_type like '%date%' then 'date'
         when source_type like '%timestamp%' then 'timestamp'
         when source_type like '%int%' or source_type like '%bigserial%' then 'int'
         else 'string' end"""
STATED_SQL = """
    case source_type
         when 'bigint' then 'bigint' when 'bigserial' then 'bigint' when 'integer' then 'int'
         when 'smallint' then 'smallint' when 'numeric(12,2)' then 'decimal(12,2)'
         when 'numeric(8)' then 'int' when 'numeric(14,0)' then 'bigint'
         when 'timestamp(6)' then 'timestamp' when 'date' then 'date'
         when 'decimal(9, 2)' then 'decimal(9,2)' else 'string' end"""
RULES_SQL = f"""
    with c as ({COLUMNS_SQL}),
    rules as (
        select schema, "table", 'key' as rule, pk_position as position, "column",
               null::varchar as pii_type
        from c where pk_position is not null
        union all
        select schema, "table", 'exclude', null, "column", null from c
        where requirement = 'Exclude'
        union all
        select schema, "table", 'pii', null, "column", {PII_SQL} from c
        where requirement = 'Hash' and {PII_SQL} is not null),
    policy as (
        select schema || '_' || "table" as dataset,
               schema || '/' || schema || '_' || "table" as folder, rule, position, "column",
               pii_type
        from rules where (schema, "table") in (
            select (schema, "table") from c where pk_position is not null))"""


@query(f"""
    select schema, "table", "column", requirement from ({COLUMNS_SQL})
    where schema = 'area2' and "table" = 'c82'""")
def requirements_for_table(spark: SparkSession, sf: str) -> DataFrame:
    return g.requirements_for_table(requirements(spark, sf), "area2", "c82")


@query(f"select distinct requirement from ({COLUMNS_SQL})")
def requirement_values(spark: SparkSession, sf: str) -> DataFrame:
    return g.requirement_values(requirements(spark, sf))


@query(f"""
    with known as (select unnest(['None Required', 'Hash', 'Exclude', null]) as requirement),
    found as (select distinct requirement from ({COLUMNS_SQL}))
    select 'unused' as side, requirement from (from known except from found)
    union all
    select 'unknown', requirement from (from found except from known)""")
def requirement_diff(spark: SparkSession, sf: str) -> DataFrame:
    return g.requirement_diff(requirements(spark, sf))


@query(f"""
    select count(*) as n_schemas, count(*) = 1 and bool_and(schema is not null) as is_single
    from (select distinct schema from ({COLUMNS_SQL}))""")
def single_schema_check(spark: SparkSession, sf: str) -> DataFrame:
    return g.single_schema_check(columns(spark, sf))


@query(f"""
    select t.schema, t."table", count(c."column") as n_columns
    from ({TABLES_SQL}) t left join ({COLUMNS_SQL}) c using (schema, "table") group by all""")
def table_column_counts(spark: SparkSession, sf: str) -> DataFrame:
    return g.table_column_counts(tables(spark, sf), columns(spark, sf))


@query(f"""
    select schema, "table" from ({TABLES_SQL}) t
    anti join (from ({COLUMNS_SQL}) where requirement is not null) using (schema, "table")""")
def empty_table_check(spark: SparkSession, sf: str) -> DataFrame:
    """Tables none of whose columns carries a requirement."""
    ruled = requirements(spark, sf).filter("requirement is not null")
    return g.empty_table_check(tables(spark, sf), ruled)


@query(f"""
    select distinct schema, "table", "column", lower(requirement) as rule from ({COLUMNS_SQL})
    where lower(requirement) in ('exclude', 'hash')""")
def policy_columns(spark: SparkSession, sf: str) -> DataFrame:
    return g.policy_columns(requirements(spark, sf))


@query(f"""
    select schema, "table", pk_position as position, "column" from ({COLUMNS_SQL})
    where pk_position is not null""")
def primary_keys(spark: SparkSession, sf: str) -> DataFrame:
    return g.primary_keys(columns(spark, sf))


@query(f"""
    select schema, "table", "column", source_type, {STATED_SQL} as catalog_type
    from ({COLUMNS_SQL})""")
def map_source_types(spark: SparkSession, sf: str) -> DataFrame:
    return g.map_source_types(columns(spark, sf).drop("ordinal", "pk_position"))


@query(f"""
    select schema, "table", "column", source_type, {LEGACY_SQL} as catalog_type
    from ({COLUMNS_SQL})""")
def map_source_types_legacy(spark: SparkSession, sf: str) -> DataFrame:
    return g.map_source_types(columns(spark, sf).drop("ordinal", "pk_position"), legacy=True)


AUGMENTED_SQL = f"""
    select schema, "table", ordinal, "column", source_type from c
    union all
    select distinct schema, "table", 0, 'op', 'string' from c
    union all
    select schema, "table", max(ordinal) + 1, 'dms_commit_ts', 'timestamp' from c
    where schema in ('area1', 'area7') group by all"""


@query(f"with c as ({COLUMNS_SQL}) {AUGMENTED_SQL}")
def augment_schema(spark: SparkSession, sf: str) -> DataFrame:
    return g.augment_schema(columns(spark, sf), ["area1", "area7"])


@query(f"""
    with c as ({COLUMNS_SQL})
    select schema, "table", ordinal, "column", {STATED_SQL.replace("when 'timestamp(6)'",
        "when 'timestamp' then 'timestamp' when 'timestamp(6)'")} as catalog_type
    from ({AUGMENTED_SQL})""")
def catalog_schema(spark: SparkSession, sf: str) -> DataFrame:
    return g.catalog_schema(columns(spark, sf), ["area1", "area7"])


@query(f"""
    select schema, "table", "column", {PII_SQL} as pii_type from ({COLUMNS_SQL})
    where {PII_SQL} is not null""")
def classify_columns(spark: SparkSession, sf: str) -> DataFrame:
    return g.classify_columns(columns(spark, sf).select("schema", "table", "column"))


@query(f"{RULES_SQL} select * from policy")
def build_policy(spark: SparkSession, sf: str) -> DataFrame:
    return g.build_policy(columns(spark, sf), requirements(spark, sf))


@query(f"""
    select schema, "table", count(pk_position) as n_keys,
           count(*) filter (requirement = 'Exclude') as n_excluded,
           count(*) filter (requirement = 'Hash') as n_hashed
    from ({COLUMNS_SQL}) group by all having count(pk_position) > 0""")
def policy_with_keys(spark: SparkSession, sf: str) -> DataFrame:
    return g.policy_with_keys(columns(spark, sf), requirements(spark, sf))


@query(f"""
    with c as ({COLUMNS_SQL})
    select schema, "table", "column", 'no type' as gap, null::varchar as pii_type from c
    where requirement = 'Hash' and {PII_SQL} is null
    union all
    select schema, "table", "column", 'in clear', {PII_SQL} from c
    where coalesce(requirement not in ('Hash', 'Exclude'), true) and {PII_SQL} is not null""")
def policy_gaps(spark: SparkSession, sf: str) -> DataFrame:
    return g.policy_gaps(columns(spark, sf), requirements(spark, sf))


@query(f"""{RULES_SQL},
    other as (
        select dataset, rule,
               case when rule = 'key' then upper("column") else "column" end as "column",
               case when position > 5000 then position + 1 else position end as position,
               case when pii_type = 'ssn' then 'case_id' else pii_type end as pii_type
        from policy where pii_type is null or pii_type <> 'email')
    select coalesce(p.dataset, o.dataset) as dataset, coalesce(p.rule, o.rule) as rule,
           p."column" as left_column, o."column" as right_column,
           case when o."column" is null then 'left only' when p."column" is null then 'right only'
                when p."column" <> o."column" then 'letter case'
                when p.position is distinct from o.position then 'position'
                when p.pii_type is distinct from o.pii_type then 'pii type' end as difference
    from policy p full join other o
        on p.dataset = o.dataset and p.rule = o.rule and lower(p."column") = lower(o."column")
    where difference is not null""")
def policy_mismatch(spark: SparkSession, sf: str) -> DataFrame:
    """Built rules against a copy with keys in capitals, a type changed and one left out."""
    rules = g.build_policy(columns(spark, sf), requirements(spark, sf))
    kind = F.col("pii_type")
    other = rules.filter(kind.isNull() | (kind != "email")).select(
        "dataset",
        "rule",
        F.when(F.col("rule") == "key", F.upper("column"))
        .otherwise(F.col("column"))
        .alias("column"),
        F.when(F.col("position") > 5000, F.col("position") + 1)
        .otherwise(F.col("position"))
        .alias("position"),
        F.when(kind == "ssn", "case_id").otherwise(kind).alias("pii_type"),
    )
    return g.policy_mismatch(rules, other)


@query(f"""
    with c as ({COLUMNS_SQL}),
    old as (select *, {STATED_SQL} as t from c where since < timestamp '2000-01-01'),
    new as (select *, {LEGACY_SQL} as t from c where since >= timestamp '1996-01-01')
    select schema, "table", "column", old.t as declared_type, new.t as found_type,
           case when old.t is null then 'added' when new.t is null then 'removed'
                else 'retyped' end as change
    from old full join new using (schema, "table", "column")
    where old.t is distinct from new.t""")
def schema_drift(spark: SparkSession, sf: str) -> DataFrame:
    """Columns known before 2000 against those of later years and narrower types."""
    listed = column_list(spark, sf)
    old = g.map_source_types(listed.filter("since < timestamp_ntz '2000-01-01 00:00:00'"))
    later = listed.filter("since >= timestamp_ntz '1996-01-01 00:00:00'")
    new = g.map_source_types(later, legacy=True)
    return g.schema_drift(old, new)
