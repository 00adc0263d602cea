"""Physical plans: built-in expressions only, filters and columns pushed to the scan, no needless shuffle."""

import re

import pytest

import __spark_entry__ as entry
from relweave.gallery import QUERIES, Tables
from relweave.operators import joins as J

FOLDER = "/root/testdata/sf0.001"
WRITERS = {n for n in QUERIES if n.startswith("load_") or n.endswith("_roundtrip")}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def plans(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    yield {n: plan(q(spark, FOLDER)) for n, q in entry.queries().items() if n in QUERIES and n not in WRITERS}
    spark.conf.unset("spark.sql.maxMetadataStringLength")


def test_no_python_workers(plans):
    for name, text in plans.items():
        assert not re.search(r"BatchEvalPython|ArrowEvalPython|MapInPandas|FlatMapGroups|PythonUDF", text), name


def test_no_cross_joins(plans):
    for name, text in plans.items():
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, name


def test_no_single_partition_shuffle_of_rows(plans):
    # allowed: global aggregates of already reduced rows, and the running sum over partition sizes
    for name, text in plans.items():
        lines = text.splitlines()
        for i, line in enumerate(lines):
            if "Exchange SinglePartition" in line:
                below = " ".join(lines[i + 1:i + 4])
                assert re.search(r"partial_|LocalLimit|_part#|_rows#", below), (name, below)


def test_row_local_queries_do_not_shuffle(plans):
    local = ["attributes_flatten", "hours_split", "clean_bool", "clean_string", "clean_int", "parse_ts", "slugify", "hash_key", "parse_categories",
             "split_explode_years", "split_explode_ts", "businesses_table", "map_to_columns", "users_table", "reviews_table", "conform_schema"]
    for name in local:
        assert "Exchange hashpartitioning" not in plans[name], name


def test_filters_and_columns_reach_the_scan(plans):
    scan = plans["filter_eq"]
    assert "EqualTo(o_orderstatus,F)" in scan and "EqualTo(o_orderpriority,2-HIGH)" in scan
    assert "o_orderdate" not in scan.split("ReadSchema")[1]
    assert "In(c_mktsegment, [BUILDING,MACHINERY])" in plans["filter_isin"]
    assert "GreaterThanOrEqual(ts" in plans["check_interval"]
    assert re.search(r"ReadSchema: struct<l_orderkey:bigint,l_linenumber:int>", plans["pk_duplicates"])
    assert re.search(r"ReadSchema: struct<ts:timestamp_ntz,event_type:string,value:double>", plans["wide_to_daily_mean"])


def test_one_scan_for_all_series(plans):
    assert plans["wide_to_daily_mean"].count("FileScan") == 1
    assert plans["profile_nulls"].count("FileScan") == 1
    assert plans["check_interval"].count("FileScan") == 1


def test_top_k_is_cut_before_the_shuffle(plans):
    assert "WindowGroupLimit" in plans["topk_per_group"].split("Exchange")[-1]
    assert "TakeOrderedAndProject" in plans["topk"]


def test_upsert_does_not_shuffle_the_target_for_a_small_batch(spark):
    t = Tables(spark, FOLDER)
    batch = t.orders.where("o_orderkey < 50")
    text = plan(J.newest_wins(t.orders, batch, ["o_orderkey"], "o_orderdate"))
    kept_target = text.split("Union")[1].split("BroadcastExchange")[0]
    assert "BroadcastHashJoin" in kept_target and "Exchange hashpartitioning" not in kept_target


def test_a_dimension_made_by_a_join_is_broadcast_only_within_the_threshold(spark, plans):
    assert "Exchange hashpartitioning" not in plans["weather_at_event"]
    assert plans["weather_at_event"].count("BroadcastHashJoin") == 3
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "100")
    try:
        t = Tables(spark, FOLDER)
        assert "BroadcastExchange" not in plan(QUERIES["weather_at_event"].run(t))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
