"""Every query against its SQL in DuckDB on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__
from docquarry import catalog

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in os.listdir(SF):
        connection.sql(f"create view {file.removesuffix('.parquet')} as select * from '{SF}/{file}'")
    return connection


@pytest.mark.parametrize("name", sorted(__spark_entry__.oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    frame = __spark_entry__.queries()[name](spark, SF)
    relation = duck.sql(__spark_entry__.oracle_sql()[name])
    assert sorted(relation.columns) == sorted(frame.columns)
    order = [relation.columns.index(c) for c in frame.columns]
    expected = sorted((tuple(r[i] for i in order) for r in relation.fetchall()), key=repr)
    assert sorted((tuple(r) for r in frame.collect()), key=repr) == expected


@pytest.mark.parametrize("name", sorted(set(catalog.queries()) - set(catalog.oracle_sql())))
def test_query_without_sql_gives_rows(spark, name):
    assert catalog.queries()[name](spark, SF).count() > 0


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0


def test_names_are_unique():
    assert sum(len(m.QUERIES) for m in catalog.MODULES) == len(catalog.queries())
    assert all(set(m.ORACLES) <= set(m.QUERIES) for m in catalog.MODULES)
