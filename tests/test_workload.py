"""Every named query with an SQL equivalent gives the same rows at the smallest scale."""

import pathlib

import duckdb
import pytest
from conftest import SF

import __spark_entry__ as driver
from sensorloom.workload import QUERIES, SQL
from tools.check_queries import rows_of, type_names


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in pathlib.Path(SF).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def test_only_model_queries_lack_sql():
    assert set(QUERIES) - set(SQL) == {
        "trained_metrics", "production_scores", "stream_scores", "feature_importances", "shapley_values"}


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    cursor = duck.execute(SQL[name])
    columns = [c[0] for c in cursor.description]
    types, expected = type_names(df, cursor)
    assert types == expected
    assert rows_of(df.columns, df.collect()) == rows_of(columns, cursor.fetchall())


def test_the_entry_offers_all_of_them():
    assert QUERIES.items() <= driver.queries().items() and SQL.items() <= driver.oracle_sql().items()


def test_entry_has_rows(spark):
    assert driver.entry(spark).columns == ["id", "status", "window_start", "mean_velocity"]
    assert driver.entry(spark).count() > 0
