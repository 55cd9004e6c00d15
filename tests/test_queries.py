"""Every query against its SQL, on the smallest test tables."""

import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract
from veiledlake import catalogue

SF = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
)
TYPES = {
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "decimal(18,2)": "DECIMAL(18,2)",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
}
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES.split():
        connection.execute(f"create view {table} as select * from '{SF}/{table}.parquet'")
    return connection


def plain(row):
    return tuple(round(v, 6) if isinstance(v, float) else v for v in row)


def order(row):
    return [(v is None, str(v)) for v in row]


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query_equals_sql(spark, duck, name):
    df = contract.queries()[name](spark, SF)
    columns = sorted(df.columns)
    found = sorted((plain(r) for r in df.select(*columns).collect()), key=order)
    relation = duck.sql(contract.oracle_sql()[name])
    assert sorted(relation.columns) == columns
    types = dict(zip(relation.columns, map(str, relation.types), strict=True))
    assert {c: TYPES.get(t, t) for c, t in df.dtypes} == types
    quoted = ", ".join(f'"{c}"' for c in columns)
    assert found == sorted((plain(r) for r in relation.project(quoted).fetchall()), key=order)


def test_flagship(spark):
    assert contract.entry(spark).count() > 0


@pytest.mark.parametrize("missing", ["corpus_pipeline", "veiledlake.llm", "public_tokenizers", "xxhash", "numpy"])
def test_other_queries_stay_without_a_library(missing):
    """Whatever the training-data operators lack, the queries of the two hops are there."""
    code = f"import sys; sys.modules[{missing!r}] = None; import __spark_entry__ as e; print(*e.queries()); e.oracle_sql()"
    found = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True).stdout.split()
    assert set(found) >= set(catalogue.QUERIES)
