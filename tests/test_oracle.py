"""Every registered query against its SQL in DuckDB, and the shape of its plan."""

from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry_points
from conftest import SMALL

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def oracle():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    return connection


def bag(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(row[i] for i in order) for row in data)


OWN = list(entry_points._QUERIES)


@pytest.mark.parametrize("name", OWN)
def test_query_matches_oracle(spark, oracle, name):
    df = entry_points.queries()[name](spark, SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for node in ("Python", "InPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in plan
    result = oracle.execute(entry_points.oracle_sql()[name])
    columns = [d[0] for d in result.description]
    assert sorted(columns) == sorted(df.columns)
    got = bag(df.columns, df.collect())
    assert got == bag(columns, result.fetchall())
    assert got


LARGE = ["enrich_left", "restrict_inner", "block_nullsafe", "generate_id", "checkbox_unpivot", "label_dim", "flagship"]


@pytest.mark.parametrize("name", LARGE)
def test_joins_of_large_inputs_match_too(spark, oracle, small_limits, monkeypatch, name):
    from mapweave.operators import skew

    monkeypatch.setattr(skew, "ROWS_PER_SLICE", 50)
    test_query_matches_oracle(spark, oracle, name)


def test_entry_is_the_flagship_on_the_smallest_tables(spark):
    assert entry_points.entry(spark).columns == ["rid", "tag", "gid", "label", "nation"]
    assert set(OWN) <= set(entry_points.queries()) & set(entry_points.oracle_sql())
