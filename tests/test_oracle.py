"""Every query of the workload against its SQL."""

import pytest
from oracle import compare, connect

import __spark_entry__ as entry
from workload import all_queries, all_sql

FOLDER = "/root/testdata/sf0.001"
SQL = all_sql()


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def test_every_query_has_sql():
    assert set(SQL) == set(all_queries())
    assert set(SQL) <= set(entry.oracle_sql()) and set(all_queries()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_query_matches_sql(spark, con, name):
    same_columns, extra, missing, _ = compare(all_queries()[name](spark, FOLDER), con, SQL[name])
    assert same_columns and not extra and not missing, (extra, missing)


def test_flagship(spark):
    assert entry.entry(spark).count() > 0


def test_day_replaced_by_nothing_writes_all_days(spark, monkeypatch):
    from workload import loads

    paths = []
    monkeypatch.setattr(loads, "scratch_path", lambda *given, real=loads.scratch_path: paths.append(real(*given)) or paths[-1])
    loads.day_replaced_by_nothing(spark, "/root/testdata/sf0.001")
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    want = orders.where("cast(o_orderdate as date) <> date'1998-07-27'").count()
    assert spark.read.schema(orders.schema).parquet(paths[0]).count() == want
