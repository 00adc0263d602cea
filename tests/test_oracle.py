"""Every query of the gallery gives the rows, names and types of its SQL on DuckDB."""

import os

import pytest

import __spark_entry__ as entry
from compare import connect, differences
from relweave.gallery import QUERIES

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")
SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(n for n, q in QUERIES.items() if q.sql))
def test_same_as_sql(spark, duck, name):
    assert differences(entry.queries()[name](spark, FOLDER), duck, SQL[name]) == []


def test_comparison_notices_a_difference(spark, duck):
    ours = entry.queries()["group_count"](spark, FOLDER)
    assert differences(ours, duck, SQL["group_count"].replace("count(*)", "count(*) + 1"))
    assert differences(ours, duck, SQL["group_count"].replace("count(*)", "CAST(count(*) AS INTEGER)"))
    assert differences(ours, duck, SQL["group_count"] + " LIMIT 2")


def test_entry(spark):
    assert entry.entry(spark).columns == ["date", "avg_temperature", "weather_description", "city_id"]
    assert entry.entry(spark).count() > 0
