"""Every registered query against its SQL twin in DuckDB, on the smallest driver tables."""

import duckdb
import pytest

from claimloom.plans import catalogue

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return connection


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    tidy = lambda v: round(v, 9) if isinstance(v, float) else v
    return sorted((tuple(tidy(r[k]) for k in order) for r in rows), key=str)


@pytest.mark.parametrize("name", sorted(catalogue.oracle_sql()))
def test_query_equals_its_twin(spark, duck, name):
    frame = catalogue.queries()[name](spark, SF)
    result = duck.execute(catalogue.oracle_sql()[name])
    columns = [c[0] for c in result.description]
    assert sorted(columns) == sorted(frame.columns)
    assert rows_of(frame.columns, frame.collect()) == rows_of(columns, result.fetchall())


def test_every_query_has_a_twin():
    assert set(catalogue.queries()) == set(catalogue.oracle_sql())


def test_pairs_of_an_identity_are_not_broadcast(spark):
    """Few rows become many pairs: a group is met in 64 cells, in as many tasks as Spark is set to."""
    found = catalogue.queries()["same_identity"](spark, SF)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
    assert found.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))
