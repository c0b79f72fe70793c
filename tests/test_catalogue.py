"""Every query against its SQL on the smallest tables."""

import math
import os

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from labeltext.plans.catalogue import QUERIES
from labeltext.plans.catalogue_sql import ORACLE

FOLDER = os.environ.get("CATALOGUE_DIR", "/root/testdata/sf0.001")
TABLES = ("orders", "lineitem", "events", "documents", "labels", "conversations")
# Queries whose results come from an iterative optimiser have no SQL; test_models covers them.
WITHOUT_SQL = {"train_four_models", "cross_slice_eval", "parameter_sweep"}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection


def normal(rows):
    def value(v):
        return None if isinstance(v, float) and math.isnan(v) else v

    return sorted((tuple(value(v) for v in r) for r in rows), key=repr)


def test_every_query_has_sql_or_a_reason():
    assert set(QUERIES) - set(ORACLE) == WITHOUT_SQL
    assert set(QUERIES) <= set(queries()) and set(ORACLE) <= set(oracle_sql()) <= set(queries())


def test_entry(spark):
    assert entry(spark).count() == 1


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, duck, name):
    result = QUERIES[name](spark, FOLDER)
    columns = sorted(result.columns)
    found = normal(tuple(r) for r in result.select(*columns).collect())
    cursor = duck.execute(ORACLE[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    assert found == normal(tuple(r[i] for i in order) for r in cursor.fetchall())
