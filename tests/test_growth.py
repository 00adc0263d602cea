"""Keys, dependencies, samples, states and rejects on small tables, against plain recomputation."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from relweave.gallery import QUERIES, Tables
from relweave.operators import aggregate as A
from relweave.operators import dimension as D
from relweave.operators import quality as Q
from relweave.plans import analytics
from relweave.sources import read_json_split

RNG = random.Random(3)


def table(spark, n=300):
    data = [(RNG.choice([None, 1, 2, 3]), RNG.choice([None, "x", "y"]), i % 60, i // 60, RNG.choice([0.0, 1.5])) for i in range(n)]
    return spark.createDataFrame(data, "a int, b string, c int, `d.e` int, f double"), data


def smallest_keys(data, names, width):
    found = []
    for n in range(1, width + 1):
        for s in itertools.combinations(range(len(names)), n):
            if len({tuple(r[i] for i in s) for r in data}) == len(data) and not any(set(k) <= set(s) for k in found):
                found.append(s)
    return sorted((",".join(names[i] for i in s), len(s)) for s in found)


def test_candidate_keys_equal_brute_force(spark, rows):
    df, data = table(spark)
    names = ["a", "b", "c", "d.e", "f"]
    assert rows(Q.candidate_keys(df, names, 3)) == smallest_keys(data, names, 3) == [("c,d.e", 2)]
    nulls = [(None, 1), (1, None), (None, None), (1, 1)]
    assert rows(Q.candidate_keys(spark.createDataFrame(nulls, "x int, y int"), ["x", "y"])) == [("x,y", 2)]
    assert rows(Q.candidate_keys(df.limit(0), ["a", "b"])) == [("a", 1), ("b", 1)]
    assert rows(Q.candidate_keys(df.unionAll(df), ["c", "d.e"])) == []


def test_column_sets_with_many_equal_rows_are_not_grouped_whole(spark, rows, monkeypatch):
    whole, grouped = Q._repeated, []
    monkeypatch.setattr(Q, "_repeated", lambda df, sets: grouped.extend(sets) or whole(df, sets))
    df = spark.range(6000).selectExpr("id a", "id div 2 b", "id % 2 c", "if(id = 7, 9, id) d", "if(id % 2 = 0, null, id) e", "id div 3 * 1.5D f")
    names = ["a", "b", "c", "d", "e", "f"]
    data = [tuple(r) for r in df.collect()]
    assert rows(Q.candidate_keys(df, names, 2)) == smallest_keys(data, names, 2)
    assert not {("b",), ("f",), ("c", "f")} & set(grouped)  # equal rows in every part
    assert ("d",) in grouped and ("a", "b") not in grouped  # two equal rows in all; a key in it
    nulls = spark.createDataFrame([(None, 0.0), (None, -0.0), (1, float("nan")), (2, float("nan"))], "x int, y double")
    assert rows(Q.candidate_keys(nulls, ["x", "y"], 2)) == []


def test_dependency_violations_equal_brute_force(spark, rows):
    df, data = table(spark)
    names = ["b", "c", "d.e", "f"]
    groups = {}
    for r in data:
        groups.setdefault(r[0], []).append(r)
    expected = [(n, len(groups), sum(len({r[i + 1] for r in g}) > 1 for g in groups.values())) for i, n in enumerate(names)]
    assert rows(Q.dependency_violations(df, ["a"])) == sorted(expected)
    assert rows(Q.dependency_violations(df, ["c", "d.e"], ["a", "b"])) == [("a", 300, 0), ("b", 300, 0)]
    assert rows(Q.dependency_violations(df.limit(0), ["a"], ["b"])) == [("b", 0, 0)]


def test_a_sample_does_not_depend_on_the_partitions(spark, rows):
    df, data = table(spark, 500)
    one = rows(Q.sample_rows(df, 20))
    assert len(one) == 20 and set(one) <= set(data)
    assert rows(Q.sample_rows(df.repartition(7), 20)) == one == rows(Q.sample_rows(df.orderBy(F.desc("c")), 20))
    assert len(rows(Q.sample_rows(df.limit(3), 20))) <= 3 and rows(Q.sample_rows(df.limit(0), 5)) == []
    assert Q.sample_rows(df, 5).schema.simpleString() == df.schema.simpleString()


def test_profile_sample_is_one_scan(spark):
    query = QUERIES["profile_sample"].run(Tables(spark, "/root/testdata/sf0.001"))
    assert query.count() == 20
    assert query._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1


def test_states_merge_to_the_mean_of_all_rows(spark, rows):
    data = [(RNG.choice(["x", "y", None]), RNG.choice([None, 0.1, 2.25, 7.3])) for _ in range(200)] + [("only null", None)]
    df = spark.createDataFrame(data, "g string, v double")
    whole = rows(A.means(A.mean_state(df, ["g"], "v"), "m"))
    state = A.mean_state(df.limit(0), ["g"], "v")
    for start in range(0, len(data), 67):
        state = A.merge_means(state, spark.createDataFrame(data[start : start + 67], df.schema), ["g"], "v")
    assert rows(A.means(state, "m")) == whole
    assert ("only null", None, 0) in whole


def test_bringing_a_mean_up_to_date_reads_state_and_new_rows_only(spark, fresh):
    paths = {}
    for name in ("old", "delta"):
        paths[name] = fresh(name)
        spark.createDataFrame([("x", 1.0)], "g string, v double").write.parquet(paths[name])
    A.mean_state(spark.read.parquet(paths["old"]), ["g"], "v").write.parquet(fresh("state"))
    merged = A.merge_means(spark.read.parquet(fresh("state")), spark.read.parquet(paths["delta"]), ["g"], "v")
    scanned = {f.rsplit("/", 2)[-2] for f in merged.inputFiles()}
    assert scanned == {"state", "delta"}


def test_issued_keys_stay(spark, rows):
    names = spark.createDataFrame([("b", 1), ("d", 1), ("b", 1), (None, 2)], "n string, m int")
    first = D.extract_dimension(names, ["n", "m"], "id", style="dense")
    more = spark.createDataFrame([("a", 1), ("b", 1), (None, 2), ("c", 5), ("a", 1)], "n string, m int")
    second = D.extend_keys(first, more, ["n", "m"], "id")
    before, after = {r[:2]: r[2] for r in rows(first)}, {r[:2]: r[2] for r in rows(second)}
    assert {k: after[k] for k in before} == before
    assert after == {**before, ("a", 1): 4, ("c", 5): 5}
    assert rows(D.extend_keys(second, more, ["n", "m"], "id")) == rows(second)
    empty = first.limit(0)
    assert rows(D.extend_keys(empty, names, ["n", "m"], "id")) == rows(first)


@pytest.mark.parametrize("ends", ["", "\n"])
def test_rejected_lines_and_rows_are_all_lines(spark, rows, tmp_path, ends):
    lines = ['{"a": 1, "b": "x"}', '{"a": "no", "b": "y"}', '{"a": 2', "", "plain", '{"b": "z"}', '{"a": 3, "b": "q", "extra": 1}', "{}"]
    (tmp_path / "in.json").write_text("\n".join(lines) + ends)
    good, rejected = read_json_split(spark, str(tmp_path / "in.json"), "a int, b string")
    assert rows(good) == sorted([(1, "x"), (None, "z"), (3, "q"), (None, None)], key=repr)
    assert rows(rejected) == sorted([('{"a": "no", "b": "y"}',), ('{"a": 2',), ("plain",)])
    assert good.count() + rejected.count() == len([line for line in lines if line])


def test_popular_among_some(spark, rows):
    reviews = spark.createDataFrame([(b, "2020-01-01") for b in (1, 1, 1, 2, 2, 3)], "business_id int, ts string")
    businesses = spark.createDataFrame([(i, i) for i in (1, 2, 3)], "business_id int, address_id int")
    addresses = spark.createDataFrame([(i, 7) for i in (1, 2, 3)], "address_id int, city_id int")
    weather = spark.createDataFrame([(7, "2020-01-01", 30.0)], "city_id int, date string, avg_temperature double").withColumn("date", F.col("date").cast("date"))
    links = spark.createDataFrame([(2, "r"), (3, "r"), (2, "s"), (1, "t")], "business_id int, category_id string")
    names = spark.createDataFrame([("Restaurants", "r"), ("Shops", "s"), ("Bars", "t")], "category string, category_id string")
    among = analytics.businesses_in(links, names, ["Restaurants", "Shops"])
    hot = analytics.popular_when_hot(reviews, businesses, addresses, weather, 25.0, 5, among)
    assert [tuple(r) for r in hot.collect()] == [(2, 2), (3, 1)]
    assert analytics.popular_when_hot(reviews, businesses, addresses, weather, 25.0, 5).count() == 3
