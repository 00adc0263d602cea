import ast
import json

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from relweave.functions import (
    clean_bool, clean_int, clean_number, clean_string, content_key, day_text, parse_date, parse_flag_dict,
    parse_hours, parse_literal, parse_timestamp, slugify, split_list, text_to,
)
from relweave.operators.nested import flag_dicts_to_columns, literals_to_columns
from relweave.plans.vocabulary import PROTECTED_CATEGORIES


def apply(spark, values, expression):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[0] for r in df.select("i", expression.alias("x")).orderBy("i").select("x").collect()]


@pytest.mark.parametrize(
    "expression, cases",
    [
        (lambda: clean_bool("v"), {None: None, "None": None, "False": False, "True": True, "true": None, "": None}),
        (lambda: clean_string("v"), {None: None, "": None, "None": "none", "u'18plus'": "18plus", "u'Full_Bar'": "full_bar",
                             "'Beer'": "beer", "menu's": "mens"}),
        (lambda: clean_string("v", strict=True), {None: None, "": None, "u'Full_Bar'": "full_bar", "'x'": "x", "menu's": "menu's"}),
        (lambda: clean_int("v"), {None: None, "None": None, "1": 1, " 4 ": 4, "+5": 5, "-3": -3, "x": None, "2.5": None,
                          "99999999999": None, "": None}),
        (lambda: clean_number("v", "double"), {"1.5": 1.5, ".5": 0.5, "1e3": 1000.0, "None": None, "x": None, "-2.": -2.0}),
        (lambda: text_to("v", "bigint"), {"99999999999": 99999999999, "9" * 30: None, "a": None}),
        (lambda: slugify("v"), {"Black or African-American": "black_or_african_american", "White": "white", None: None}),
        (lambda: day_text("v"), {"2012-10-01 13:00:00": "2012-10-01", None: None}),
    ],
)
def test_examples(spark, expression, cases):
    assert apply(spark, list(cases), expression()) == list(cases.values())


def test_temporal(spark):
    stamps = apply(spark, ["2018-01-02 03:04:05", "2018-01-02", "soon", None, ""], parse_timestamp("v").cast("string"))
    assert stamps == ["2018-01-02 03:04:05", "2018-01-02 00:00:00", None, None, None]
    assert apply(spark, ["2018-01-02", "2018-02-30", None], parse_date("v").cast("string")) == ["2018-01-02", None, None]


def test_timestamp_is_independent_of_the_session_zone(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        assert apply(spark, ["2018-03-11 02:30:00"], parse_timestamp("v").cast("string")) == ["2018-03-11 02:30:00"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


HOURS = {
    "9:0-0:0": (900, 0), "10:00-21:00": (1000, 2100), "9:0-1:0": (900, 100), "10:30-21:45": (1030, 2145), None: None,
    " 9 : 5 - 17:0 ": (905, 1700), "9:0:30-17:15:59": (900, 1715), "9:0-12:0-17:0": (900, 1200), "junk": (None, None),
    "9:0": (None, None), "9-17": (None, None), "a:b-17:5": (None, None), "99999999:0-1:0": (None, None), "": (None, None),
}


def test_hours(spark):
    found = apply(spark, list(HOURS), parse_hours("v"))
    assert [tuple(r) if r is not None else None for r in found] == list(HOURS.values())


CATEGORIES = {
    None: [], "": [], "A": ["A"], "A, B,C": ["A", "B", "C"], "A ,,B": ["A ", "B"],
    f"A, {PROTECTED_CATEGORIES[0]}, B": [PROTECTED_CATEGORIES[0], "A", "B"],
    f"{PROTECTED_CATEGORIES[0]}, {PROTECTED_CATEGORIES[0]}": [PROTECTED_CATEGORIES[0]],
}


def test_category_list(spark):
    assert apply(spark, list(CATEGORIES), split_list("v", PROTECTED_CATEGORIES)) == list(CATEGORIES.values())


DICTS = {
    None: None, "None": None, "": None, "{}": {},
    "{'romantic': False, 'casual': True}": {"romantic": False, "casual": True},
    "{u'a': True, 'menu': False, 'True story': True}": {"a": True, "menu": False, "True story": True},
    "{'a': None, 'b': 'True', 'c': 3, 'd':True}": {"a": None, "b": None, "c": None, "d": True},
    "{\"it's\": True , 'b' : False}": {"it's": True, "b": False},
    r"{'both \' and \"': True, ',u': False, ', ': True}": {"both ' and \"": True, ",u": False, ", ": True},
    "{'x': ', y: True, ', u'z': False}": {"x": None, "z": False},
    "not a dictionary": None,
    "{'a': True, 'b': False}": {"a": True, "b": False},
    "{'aa': True, 'a': False, 'ba': None}": {"aa": True, "a": False, "ba": None},
    "{" + ", ".join(f"'k{i}': True" for i in range(5000)) + ", 'a': True}": {f"k{i}": True for i in range(5000)} | {"a": True},
}


def test_flag_dict(spark):
    assert apply(spark, list(DICTS), parse_flag_dict("v")) == list(DICTS.values())


def test_flag_columns_declared_and_discovered(spark):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(DICTS)], "i int, Diet string")
    named = flag_dicts_to_columns(df, {"Diet": ["romantic", "a", "absent-key"]}).orderBy("i")
    assert named.columns == ["i", "Diet_romantic", "Diet_a", "Diet_absent_key"]
    assert [r[1:] for r in named.collect()] == [
        ((d or {}).get("romantic"), (d or {}).get("a"), None) for d in DICTS.values()
    ]
    plain = flag_dicts_to_columns(df, {"Diet": ["a", "b"]}).orderBy("i")
    assert [r[1:] for r in plain.collect()] == [((d or {}).get("a"), (d or {}).get("b")) for d in DICTS.values()]
    df = df.where(F.length("Diet") < 1000)
    few = [d for text, d in DICTS.items() if text is not None and len(text) < 1000]
    found = flag_dicts_to_columns(df, {"Diet": None})
    keys = sorted({k for d in few for k in (d or {})})
    assert found.columns == ["i", *[f"Diet_{k}" for k in keys]]
    assert [tuple(r)[1:] for r in found.orderBy("i").collect()] == [
        tuple((d or {}).get(k) for k in keys) for d in few
    ]


WORDS = st.text("abTrueFals' ,-", min_size=1, max_size=8)


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.dictionaries(WORDS, st.booleans(), max_size=4), min_size=10, max_size=60))
def test_flag_dict_reads_what_python_writes(spark, dicts):
    texts = [repr(d) for d in dicts]
    assert [ast.literal_eval(t) for t in texts] == apply(spark, texts, parse_flag_dict("v"))


def test_content_key_separates_every_tuple(spark):
    tuples = [("a", "bc"), ("ab", "c"), ("a", None), (None, "a"), ("", ""), (None, None), ("", None), ("1:a", ""), ("-", None)]
    df = spark.createDataFrame(tuples, "a string, b string")
    assert df.select(content_key("a", "b").alias("k")).distinct().count() == len(tuples)
    strict = df.select(content_key("a", "b", null_if_any_null=True).alias("k")).where(F.col("k").isNull()).count()
    assert strict == sum(None in t for t in tuples)


LITERAL = st.recursive(
    st.none() | st.booleans() | st.integers(-10**9, 10**9) | st.text(st.characters(min_codepoint=32, max_codepoint=0x17F, exclude_characters="\x7f\xad"), max_size=8).filter(
        lambda t: "\\x" not in repr(t)
    ),
    lambda inner: st.lists(inner, max_size=3) | st.tuples(inner, inner) | st.dictionaries(st.text("ab'\"u, ", max_size=3), inner, max_size=3),
    max_leaves=8,
)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(LITERAL, min_size=30, max_size=60))
def test_literals_are_what_python_reads(spark, values):
    got = apply(spark, [repr(v) for v in values], F.to_json(parse_literal("v")))
    assert [json.loads(g) for g in got] == json.loads(json.dumps(values))


def test_texts_that_are_no_literal(spark):
    texts = [None, "", "word", "{'a': ", "'O", "{1: 2}", "{'a': 1, 'a': 2}", "'a' 'b'", "u'free'", "{u'a': [1,],}", '"it\'s"', "'" + "x" * 100_000 + "'"]
    got = apply(spark, texts, F.to_json(parse_literal("v")))
    assert got[:8] == [None] * 8
    assert [json.loads(g) for g in got[8:]] == ["free", {"a": [1]}, "it's", "x" * 100_000]


def test_literal_fields_keep_their_types(spark):
    df = spark.createDataFrame([(1, "{'a': 2, 'b-c': {'d': [True, None]}, \"o'x\": u'y'}"), (2, "{'a': 'word'}"), (3, None)], "k int, `m.n` string")
    wide = literals_to_columns(df, "m.n", {"a": "int", "b-c": "struct<d: array<boolean>>", "o'x": "string"})
    assert wide.columns == ["k", "m.n_a", "m.n_b_c", "m.n_o'x"]
    rows = sorted(tuple(r) for r in wide.collect())
    assert rows == [(1, 2, ([True, None],), "y"), (2, None, None, None), (3, None, None, None)]
