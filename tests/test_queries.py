"""Every registered query against its SQL on the small tables."""

import math

import duckdb
import pytest

import __spark_entry__ as driver
from bronzeway.plans.roles import TABLES

SF_DIR = "/root/testdata/sf0.001"
from bronzeway.plans.oracles import ORACLES  # noqa: E402
from bronzeway.plans.queries import QUERIES  # noqa: E402


@pytest.fixture(scope="module")
def oracle():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


def comparable(names, rows):
    def text(value):
        if isinstance(value, float):
            return "nan" if math.isnan(value) else repr(round(value, 6))
        return repr(value)

    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(text(row[i]) for i in order) for row in rows)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, oracle, name):
    got = QUERIES[name](spark, SF_DIR)
    expected = oracle.execute(ORACLES[name])
    names = [d[0] for d in expected.description]
    assert sorted(got.columns) == sorted(names)
    rows = comparable(got.columns, [tuple(r) for r in got.collect()])
    assert rows == comparable(names, expected.fetchall())
    assert rows


def test_all_have_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(driver.queries()) and set(ORACLES) <= set(driver.oracle_sql())


def test_a_callers_session_keeps_its_settings(spark):
    before = dict(spark.conf.getAll)
    QUERIES["kpi_cards"](spark, SF_DIR).collect()
    assert dict(spark.conf.getAll) == before


def test_the_rollup_reduces(spark):
    rows = QUERIES["gold_rollup"](spark, "/root/testdata/sf0.01").collect()
    assert 10 * len(rows) <= 60_000 and any(r.QT_TOTAL_MORTOS is None and r.QT_ACIDENTES > 10 for r in rows)


def test_entry(spark):
    assert driver.entry(spark).count() > 0
