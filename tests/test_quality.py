import pytest

from relweave.operators import quality as Q
from relweave.operators.spec import ForeignKey, TableSpec


@pytest.fixture
def people(spark):
    return spark.createDataFrame(
        [(1, "ann", 5.0), (2, "bo", None), (2, "cy", 1.0), (None, "", 0.0)], "id int, name string, score double"
    )


def test_value_checks_share_a_scan(spark, people):
    checks = [
        Q.ValueCheck("hit", "p", 4), Q.ValueCheck("miss", "p", 5), Q.ValueCheck("inside", "p", 5, tolerance=0.2),
        Q.ValueCheck("outside", "p", 5, tolerance=0.1), Q.ValueCheck("expr", "p", 6, "sum(score)"), Q.ValueCheck("null", "p", 0, "max(nullif(id, id))"),
    ]
    result = Q.run_checks({"p": people}, checks)
    assert {r["check"]: r["passed"] for r in result.collect()} == {
        "hit": True, "miss": False, "inside": True, "outside": False, "expr": True, "null": False,
    }
    assert result._jdf.queryExecution().optimizedPlan().toString().count("Aggregate") == 1


def test_sql_checks(spark, people):
    people.createOrReplaceTempView("people_view")
    try:
        verdict = lambda sql, expected, tol=None: Q.check_sql(spark, "c", sql, expected, tol).first()["passed"]
        assert verdict("SELECT count(*) FROM people_view", 4)
        assert not verdict("SELECT count(*) FROM people_view", 3)
        assert verdict("SELECT count(*), 4.2 FROM people_view", 4, 0.1)
        assert not verdict("SELECT count(*), 5 FROM people_view", 4, 0.1)
        assert verdict("SELECT max(name) FROM people_view", "cy")
        assert not verdict("SELECT id FROM people_view WHERE id > 10", 1)
    finally:
        spark.catalog.dropTempView("people_view")


@pytest.mark.parametrize(
    "sql, passed",
    [
        ("SELECT 1, 'x', true, array(1), date'2020-01-01'", True),
        ("SELECT 1, ''", False), ("SELECT 0", False), ("SELECT 1, false", False), ("SELECT CAST(NULL AS INT)", False),
        ("SELECT array()", False), ("SELECT CAST('NaN' AS DOUBLE)", True), ("SELECT 1 WHERE false", False),
    ],
)
def test_truthy(spark, sql, passed):
    assert Q.check_truthy(spark.sql(sql), "c").first()["passed"] is passed


def test_interval(spark):
    days = [("2024-01-08", 1.0)] * 10 + [("2024-01-15", 2.0)] * 14 + [("2024-01-10", 99.0)]
    df = spark.createDataFrame(days, "ds string, v double").selectExpr("CAST(ds AS DATE) AS ds", "v")
    metrics = {"n": ("count(*)", 1.5), "total": ("sum(v)", 2), "zero": ("count_if(v > 100)", 2)}
    got = {r["metric"]: (r["observed"], r["reference"], r["ratio"], r["passed"]) for r in Q.check_interval(df, metrics, "2024-01-15").collect()}
    assert got == {"n": (14.0, 10.0, 1.4, True), "total": (28.0, 10.0, 2.8, False), "zero": (0.0, 0.0, None, True)}
    strict = Q.check_interval(df, metrics, "2024-01-15", ignore_zero=False).collect()
    assert [r["passed"] for r in strict if r["metric"] == "zero"] == [False]
    assert not any(r["passed"] for r in Q.check_interval(df, metrics, "2024-03-01").collect())
    swapped = Q.check_interval(df, {"n": ("count(*)", 1.5)}, "2024-01-08", days_back=7).first()
    assert (swapped["observed"], swapped["reference"]) == (10.0, 14.0)


def test_keys(spark, rows, people):
    assert rows(Q.primary_key_violations(people, ["id"])) == [(2, 2), (None, 1)]
    assert rows(Q.primary_key_violations(people, ["id", "name"])) == [(None, "", 1)]
    spec = TableSpec.of("p", "id int, name varchar(2)", foreign_keys=(ForeignKey("id", "q", "qid"),))
    parents = spark.createDataFrame([(1,)], "qid int")
    assert rows(Q.foreign_key_violations({"p": people, "q": parents}, spec)) == [("p", "id", "q", 1, 2)]
    with pytest.raises(ValueError, match="no foreign key"):
        Q.foreign_key_violations({}, TableSpec.of("p", "id int"))


def test_lengths_and_profiles(spark, rows, people):
    spec = TableSpec.of("p", "id int, name varchar(2)")
    assert rows(Q.length_violations(people, spec)) == [("name", 2, 3, False)]
    assert rows(Q.length_violations(people.where("id > 5"), spec)) == [("name", 2, None, True)]
    assert rows(Q.profile_nulls(people)) == [("id", 4, 1), ("name", 4, 0), ("score", 4, 1)]
    assert rows(Q.profile_lengths(people)) == [("name", 3)]
    assert rows(Q.describe(people)) == [("id", "int", 4, 1, None), ("name", "string", 4, 0, 3), ("score", "double", 4, 1, None)]
