import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from relweave.operators import aggregate as A
from relweave.operators import dimension as D
from relweave.operators import joins as J
from relweave.operators import nested as N
from relweave.operators import relational as R
from relweave.operators import reshape as P


# --- nested ----------------------------------------------------------------------------------------


def test_explode_delimited_variants(spark, rows):
    df = spark.createDataFrame([(1, "a, b, a"), (1, "b"), (2, ""), (3, None), (4, "None")], "k int, v string")
    plain = rows(N.explode_delimited(df, "v", "x", ["k"], ", "))
    assert plain == [(1, "a"), (1, "a"), (1, "b"), (1, "b"), (4, "None")]
    assert rows(N.explode_delimited(df, "v", "x", ["k"], ", ", distinct="row")) == [(1, "a"), (1, "b"), (1, "b"), (4, "None")]
    without_none = N.explode_delimited(df, "v", "x", ["k"], ", ", ("", "None"), distinct="global")
    assert rows(without_none) == [(1, "a"), (1, "b")]


def test_delimiter_is_literal(spark, rows):
    df = spark.createDataFrame([(1, "a|b.c")], "k int, v string")
    assert rows(N.explode_delimited(df, "v", "x", ["k"], "|")) == [(1, "a"), (1, "b.c")]
    assert rows(N.explode_delimited(df, "v", "x", ["k"], ".")) == [(1, "a|b"), (1, "c")]


def test_explode_array_outer(spark, rows):
    df = spark.createDataFrame([(1, ["a"]), (2, []), (3, None)], "k int, v array<string>")
    assert rows(N.explode_array(df, "v", "x", ["k"])) == [(1, "a")]
    assert rows(N.explode_array(df, "v", "x", ["k"], outer=True)) == [(1, "a"), (2, None), (3, None)]


def test_map_keys_are_sorted_renamed_and_bounded(spark, rows):
    df = spark.createDataFrame([(1, {"b-c": True}), (2, {"a": False}), (3, None)], "k int, m map<string,boolean>")
    wide = N.map_to_columns(df, "m")
    assert wide.columns == ["k", "m_a", "m_b_c"]
    assert rows(wide) == [(1, None, True), (2, False, None), (3, None, None)]
    assert rows(N.distinct_keys(df, "m")) == [("a", 1), ("b-c", 1)]
    assert rows(N.undeclared_keys(df, "m", ["a"])) == [("b-c", 1)]
    assert rows(N.map_long(df, "m", ["k"])) == [(1, "b-c", True), (2, "a", False)]


def test_keys_without_bound_make_no_columns(spark, monkeypatch):
    monkeypatch.setattr(N, "MOST_COLUMNS", 5)
    df = spark.range(6).select(F.create_map(F.concat(F.lit("k"), F.col("id").cast("string")), F.lit(True)).alias("m"))
    with pytest.raises(ValueError, match="more than 5 keys"):
        N.map_to_columns(df, "m")
    assert len(N.map_to_columns(df.where("id < 5"), "m").columns) == 5


def test_any_number_of_keys_in_the_long_form(spark):
    df = spark.range(6000).select(F.create_map(F.concat(F.lit("k"), F.col("id")), F.lit(True)).alias("m"))
    assert N.map_long(df, "m", []).count() == 6000 == N.distinct_keys(df, "m").count()


# --- reshape ---------------------------------------------------------------------------------------


def test_pivot_then_unpivot_is_identity(spark, rows):
    data = [(k, c, k * 10 + i) for k in range(5) for i, c in enumerate("abc")]
    long = spark.createDataFrame(data, "k int, name string, value int")
    wide = P.pivot_max(long, "name", "value")
    assert wide.columns == ["a", "b", "c", "k"]
    assert rows(P.unpivot(wide, ["k"], ["a", "b", "c"], "name", "value")) == rows(long)


def test_unpivot_nulls(spark, rows):
    df = spark.createDataFrame([(1, None, "x")], "k int, a string, b string")
    assert len(rows(P.unpivot(df, ["k"], ["a", "b"], "n", "v"))) == 2
    assert rows(P.unpivot(df, ["k"], ["a", "b"], "n", "v", keep_nulls=False)) == [(1, "b", "x")]


@pytest.mark.parametrize("scale", [None, 2])
def test_series_mean(spark, rows, scale):
    df = spark.createDataFrame([("d1", 1.0, None), ("d1", 2.0, None), ("d2", None, 5.5)], "day string, a double, b double")
    assert rows(P.series_mean(df, "day", ["a", "b"], "s", "v", scale)) == [
        ("d1", "a", 1.5), ("d1", "b", None), ("d2", "a", None), ("d2", "b", 5.5),
    ]


def test_mode_ties_nulls_and_empty_groups(spark, rows):
    data = [("tie", "b"), ("tie", "a"), ("null", None), ("null", None), ("null", "z"), ("empty", None)]
    df = spark.createDataFrame(data, "g string, v string")
    assert rows(A.mode_per_group(df, ["g"], "v")) == [("empty", None), ("null", "z"), ("tie", "a")]
    assert rows(A.mode_per_group(df, ["g"], "v", ignore_nulls=False)) == [("empty", None), ("null", None), ("tie", "a")]


def test_bag_keeps_every_value(spark):
    random.seed(1)
    data = [(random.randrange(3), random.choice("xyz")) for _ in range(300)]
    df = spark.createDataFrame(data, "g int, v string")
    got = A.collect_bag(df, ["g"], "v", "bag").select("g", "bag", A.bag_to_list("bag").alias("list")).collect()
    expected = defaultdict(list)
    for g, v in data:
        expected[g].append(v)
    assert {r["g"]: r["list"] for r in got} == {g: sorted(v) for g, v in expected.items()}
    assert all(len(r["bag"]) == 3 for r in got)


def test_candidate_key_and_first_row(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b")], "k int, v string")
    assert tuple(A.candidate_key(df, ["k"]).first()) == (1, 2, False)
    assert tuple(A.candidate_key(df, ["k", "v"]).first()) == (2, 1, True)
    assert tuple(A.candidate_key(df.where("k > 5"), ["k"]).first()) == (0, None, True)
    assert A.first_row(df.where("v = 'b'"))["v"] == "b"
    assert A.first_row(df.where("k > 5")) is None


# --- relational ------------------------------------------------------------------------------------


def test_open_on_counts_hours_past_midnight(spark):
    columns = [f"{d}_{s}" for d in ("Saturday", "Sunday") for s in ("from", "to")]
    data = [("day", None, None, 900, 1700), ("late", None, None, 1800, 200), ("spill", 2000, 300, None, None),
            ("always", 0, 0, 0, 0), ("closed", None, None, None, None)]
    df = spark.createDataFrame(data, "id string, " + ", ".join(f"{c} int" for c in columns))
    names = lambda out: sorted(r["id"] for r in out.collect())
    assert names(R.open_on(df, "Sunday", 2000)) == ["always", "late"]
    assert names(R.open_on(df, "Sunday", 100)) == ["always", "spill"]
    assert names(R.open_at(df, "Sunday_from", "Sunday_to", 1000)) == ["day"]
    assert names(R.open_at(df, "Sunday_from", "Sunday_to", 2000)) == []


def test_union_fill_and_missing(spark, rows):
    a = spark.createDataFrame([(1, "x")], "k int, a string")
    b = spark.createDataFrame([(2, 5)], "k int, b int")
    assert R.missing_columns(a, ["b", "k", "c"]) == ["b", "c"]
    assert rows(R.union_fill(a, b)) == [(1, "x", None), (2, None, 5)]


# --- joins -----------------------------------------------------------------------------------------


def test_lookup_null_keys(spark, rows):
    left = spark.createDataFrame([(1, "a"), (2, None)], "i int, k string")
    dim = spark.createDataFrame([("a", 10), (None, 20)], "k string, id int")
    assert rows(J.lookup(left, dim, ["k"], ["id"])) == [(1, "a", 10), (2, None, None)]
    assert rows(J.lookup(left, dim, ["k"], ["id"], null_safe=True)) == [(1, "a", 10), (2, None, 20)]
    with pytest.raises(ValueError, match="both sides"):
        J.lookup(left, dim, ["k"], ["k"])


@pytest.mark.parametrize("how", ["left", "inner"])
def test_salted_lookup_equals_plain_with_hot_and_null_keys(spark, rows, how):
    random.seed(2)
    keys = ["hot"] * 400 + [None] * 300 + [f"k{random.randrange(50)}" for _ in range(500)]
    fact = spark.createDataFrame(list(enumerate(keys)), "i int, k string")
    dim = spark.createDataFrame([("hot", 1), ("hot", 2), *[(f"k{i}", i) for i in range(40)]], "k string, v int")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        plain = J.lookup(fact, dim, ["k"], ["v"], how)
        salted = J.salted_lookup(fact, dim, ["k"], ["v"], hot_share=0.1, salts=6, how=how)
        assert rows(salted.select("i", "k", "v")) == rows(plain.select("i", "k", "v"))
        # the hot key is spread over several tasks
        spread = salted.where("k = 'hot'").groupBy(F.spark_partition_id()).count().count()
        assert spread > 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_salted_lookup_shuffles_facts_once_and_spreads_equal_rows(spark):
    fact = spark.createDataFrame([("hot", 1)] * 800 + [(None, 1)] * 200, "k string, x int").repartition(16)
    dim = spark.createDataFrame([("hot", 1), ("other", 2)], "k string, v int")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        salted = J.salted_lookup(fact, dim, ["k"], ["v"], hot_share=0.2, salts=8, how="inner")
        plan = salted._jdf.queryExecution().executedPlan().toString()
        assert len(re.findall(r"Exchange hashpartitioning\(k#\d+, _salt#\d+", plan)) == 2
        assert not re.findall(r"SortMergeJoin \[k#\d+\]", plan)
        assert salted.count() == 800
        for how in ("right", "full", "outer"):
            with pytest.raises(ValueError, match="salted"):
                J.salted_lookup(fact, dim, ["k"], ["v"], hot_share=0.2, salts=8, how=how)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_content_keys_of_negative_zero(spark, rows):
    from relweave.operators.dimension import extract_dimension, foreign_key

    df = spark.createDataFrame([(1, -0.0, "-0.0"), (2, 0.0, "0.0"), (3, None, None)], "i int, x double, t string")
    for column in ("x",):
        for style in ("content", "dense"):
            dim = extract_dimension(df.where("x is not null"), [column], "id", style)
            assert dim.count() == 1
            keyed = df.where("x is not null").withColumn("id", foreign_key([column])) if style == "content" else J.lookup(df.where("x is not null"), dim, [column], ["id"])
            assert J.orphans(keyed, dim, {"id": "id"}).count() == 0 and keyed.where("id is null").count() == 0
    # texts stay apart
    assert df.where("t is not null").select(foreign_key(["t"]).alias("k")).distinct().count() == 2


def test_orphans(spark, rows):
    child = spark.createDataFrame([(1,), (1,), (2,), (None,)], "fk int")
    parent = spark.createDataFrame([(2,), (3,)], "id int")
    assert rows(J.orphans(child, parent, {"fk": "id"})) == [(1, 2)]


def brute_upsert(target, batch):
    """The three statements of the load, literally."""
    ge = lambda a, b: a is not None and b is not None and a >= b
    kept = [t for t in target if not any(b[0] == t[0] and b[0] is not None and ge(b[1], t[1]) for b in batch)]
    new = [b for b in batch if not any(t[0] == b[0] and b[0] is not None and ge(t[1], b[1]) for t in kept)]
    return Counter(kept + new)


def test_newest_wins_equals_brute_force(spark):
    random.seed(3)
    for _ in range(6):
        make = lambda n, tag: [
            (random.choice([None, 1, 2, 3, 4, 5]), random.choice([None, 1, 2, 3]), f"{tag}{i}") for i in range(n)
        ]
        target, batch = make(25, "t"), make(25, "b")
        schema = "pk int, ik int, v string"
        got = J.newest_wins(spark.createDataFrame(target, schema), spark.createDataFrame(batch, schema), ["pk"], "ik")
        assert Counter(tuple(r) for r in got.collect()) == brute_upsert(target, batch)


def test_newest_wins_composite_key_missing_column_and_idempotence(spark, rows):
    target = spark.createDataFrame([(1, 1, 5, "old"), (1, 2, 5, "keep")], "a int, b int, ik int, v string")
    batch = spark.createDataFrame([(1, 1, 5)], "a int, b int, ik int")
    once = J.newest_wins(target, batch, ["a", "b"], "ik")
    assert rows(once) == [(1, 1, 5, None), (1, 2, 5, "keep")]
    assert rows(J.newest_wins(once, batch, ["a", "b"], "ik")) == rows(once)


# --- keys ------------------------------------------------------------------------------------------


@pytest.mark.parametrize("width", [1, 3, 8])
def test_dense_key_is_the_rank_whatever_the_width(spark, width):
    spark.conf.set("spark.sql.shuffle.partitions", str(width))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        names = [f"n{i * 7919 % 2003:05d}" for i in range(2003)]
        df = spark.createDataFrame([(n, n.upper()) for n in names], "name string, other string")
        got = {r["name"]: r["id"] for r in D.dense_key(df, ["name"], "id").collect()}
        assert got == {n: i + 1 for i, n in enumerate(sorted(names))}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_occurrence_key_numbers_copies_in_chunks(spark):
    data = [("hot", None)] * 1005 + [("x", "1"), ("x", "1"), ("y", None)]
    df = spark.createDataFrame(data, "a string, b string").repartition(5)
    keyed = D.occurrence_key(df, "id", chunk=10)
    assert keyed.count() == len(data)
    assert keyed.select("id").distinct().count() == len(data)
    assert Counter((r["a"], r["b"]) for r in keyed.collect()) == Counter(data)
    again = {r["id"] for r in D.occurrence_key(df.repartition(2), "id").collect()}
    assert again == {r["id"] for r in keyed.collect()}


def test_unknown_key_style(spark):
    with pytest.raises(ValueError, match="key style"):
        D.extract_dimension(spark.range(1), ["id"], "k", "serial")
