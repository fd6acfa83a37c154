"""Every registered query beside its SQL, over the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as contract
from check import TABLES, normal
from marquee.plans import registry

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="tables not here")


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{FOLDER}/{t}.parquet')")
    return connection


def test_only_trained_models_go_without_sql():
    assert contract.oracle_sql().keys() <= contract.queries().keys()
    assert registry.QUERIES.keys() - registry.ORACLES.keys() == {"als_recommend", "als_evaluate"}


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_query_equals_sql(spark, db, name):
    got = contract.queries()[name](spark, FOLDER).toPandas()
    want = db.execute(contract.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert normal(got) == normal(want)


def test_entry(spark):
    assert contract.entry(spark).count() > 0
