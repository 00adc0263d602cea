"""Source documents derived from the star-schema tables.

The tables have no nested or masked columns, so each document column is an expression over them. The
expressions are valid in Spark and in ANSI SQL, and work row by row: nothing is grouped to make text.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relweave.gallery.registry import Tables
from relweave.plans import vocabulary as V

QUOTE = "chr(39)"


def text(expression: str) -> str:
    return f"CAST({expression} AS STRING)"


def quoted(word: str) -> str:
    return f"{QUOTE} || '{word}' || {QUOTE}"


def masked_boolean(seed: str) -> str:
    return f"CASE ({seed}) % 4 WHEN 0 THEN 'True' WHEN 1 THEN 'False' WHEN 2 THEN 'None' END"


def masked_text(seed: str, word: str) -> str:
    return f"CASE ({seed}) % 4 WHEN 0 THEN 'u' || {quoted(word)} WHEN 1 THEN 'None' WHEN 2 THEN '' END"


def masked_integer(seed: str) -> str:
    return f"CASE WHEN ({seed}) % 5 = 4 THEN 'None' WHEN ({seed}) % 5 = 3 THEN NULL ELSE {text(f'({seed}) % 5 + 1')} END"


def masked_dict(seed: str, keys: Iterable[str]) -> str:
    entries = [
        f"{quoted(key)} || ': ' || CASE WHEN ({seed} + {i}) % 2 = 0 THEN 'True' ELSE 'False' END"
        for i, key in enumerate(keys)
    ]
    filled = "'{' || " + " || ', ' || ".join(entries) + " || '}'"
    return f"CASE ({seed}) % 5 WHEN 0 THEN NULL WHEN 1 THEN 'None' WHEN 2 THEN '' ELSE {filled} END"


def masked_hours(seed: str) -> str:
    opening = f"{text(f'({seed}) % 24')} || ':' || {text(f'({seed}) % 60')}"
    closing = f"{text(f'({seed}) * 5 % 24')} || ':0'"
    return f"CASE WHEN ({seed}) % 6 = 0 THEN NULL ELSE {opening} || '-' || {closing} END"


ATTRIBUTES: dict[str, str] = {}
for _i, _name in enumerate(V.BOOLEAN_ATTRIBUTES):
    ATTRIBUTES[_name] = masked_boolean(f"c_custkey + {_i}")
for _i, _name in enumerate(V.TEXT_ATTRIBUTES):
    ATTRIBUTES[_name] = masked_text(f"c_custkey + {_i}", "Full_Bar")
for _name in V.INTEGER_ATTRIBUTES:
    ATTRIBUTES[_name] = masked_integer("c_custkey")
for _i, (_name, _keys) in enumerate(V.FLAG_ATTRIBUTES.items()):
    ATTRIBUTES[_name] = masked_dict(f"c_custkey + {_i}", _keys)

HOURS = {day: masked_hours(f"c_custkey + {i}") for i, day in enumerate(V.DAYS)}

BUSINESS = {
    "business_id": "c_name",
    "name": f"'Shop ' || {text('c_custkey')}",
    "address": f"c_mktsegment || ' ' || {text('c_custkey % 40')}",
    "city": "n_name",
    "state": f"'S' || {text('n_regionkey')}",
    "postal_code": f"CASE WHEN c_custkey % 13 <> 0 THEN 'Z' || {text('c_custkey % 3')} END",
    "latitude": "CAST(c_custkey % 2 AS DOUBLE) + 0.5",
    "longitude": "CAST(c_custkey % 2 AS DOUBLE) - 7.25",
    "stars": "CAST(c_custkey % 9 AS DOUBLE) / 2 + 1",
    "review_count": "c_custkey % 100",
    "is_open": "c_custkey % 2",
    "categories": (
        f"CASE c_custkey % 11 WHEN 0 THEN NULL WHEN 1 THEN '{V.PROTECTED_CATEGORIES[0]}, ' || c_mktsegment "
        f"WHEN 2 THEN c_mktsegment || ', ' || c_mktsegment "
        f"ELSE c_mktsegment || ', Group ' || {text('c_custkey % 500')} || ',Shops' END"
    ),
}
BUSINESS_FROM = "customer JOIN nation ON c_nationkey = n_nationkey"

USER = {
    "user_id": "c_name",
    "name": "c_mktsegment",
    "yelping_since": (
        f"CASE WHEN c_custkey % 10 = 0 THEN 'unknown' ELSE {text('2004 + c_custkey % 15')} || '-0' || "
        f"{text('1 + c_custkey % 9')} || '-1' || {text('c_custkey % 10')} || ' 10:20:30' END"
    ),
    "elite": (
        f"CASE c_custkey % 5 WHEN 0 THEN '' WHEN 1 THEN NULL ELSE {text('2008 + c_custkey % 7')} || ',' || "
        f"{text('2009 + c_custkey % 7')} || ',' || {text('2008 + c_custkey % 7')} END"
    ),
    "friends": (
        f"CASE c_custkey % 6 WHEN 0 THEN 'None' WHEN 1 THEN '' WHEN 2 THEN NULL ELSE "
        f"{text('c_custkey + 1')} || ', ' || {text('c_custkey * 7 % 1000')} || ', ' || {text('c_custkey + 1')} END"
    ),
    "average_stars": "c_acctbal",
    "fans": "c_custkey % 17",
}
USER_FROM = "customer"

REVIEW = {
    "review_id": text("o_orderkey"),
    "user_id": text("o_custkey"),
    "business_id": text("o_custkey"),
    "stars": "CAST(1 + o_orderkey % 5 AS DOUBLE)",
    "date": f"CASE WHEN o_orderkey % 50 = 0 THEN 'long ago' ELSE {text('o_orderdate')} END",
    "text": "o_orderpriority || ' ' || o_orderstatus",
    "useful": "o_orderkey % 3",
}
REVIEW_FROM = "orders"

CHECKIN = {
    "business_id": text("user_id"),
    "date": f"CASE WHEN event_id % 20 = 0 THEN '' ELSE {text('ts')} || ', ' || CAST(ts + INTERVAL '1' HOUR AS STRING) END",
}
CHECKIN_FROM = "events"

TIP = {
    "user_id": text("l_suppkey % 3"),
    "business_id": "l_returnflag",
    "text": "l_linestatus",
    "date": text("l_shipdate"),
    "compliment_count": "CAST(l_linenumber AS BIGINT)",
}
TIP_FROM = "lineitem"

PHOTO = {"photo_id": text("p_partkey"), "business_id": "p_brand", "caption": "p_name", "label": "p_type"}
PHOTO_FROM = "part"

# The event types play the cities of the wide weather files.
SERIES = ("click", "error", "purchase", "signup", "view")
SERIES_STATES = (("click", "AZ"), ("error", "TX"), ("purchase", "CA"), ("signup", "NV"))
HOUR = f"substring({text('ts')}, 1, 13) || ':00:00'"
SERIES_STATE = "CASE event_type WHEN 'click' THEN 'AZ' WHEN 'error' THEN 'TX' WHEN 'purchase' THEN 'CA' ELSE 'XX' END"
SERIES_COUNTRY = "CASE event_type WHEN 'error' THEN 'Canada' ELSE 'United States' END"

RACE = (
    "CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'White' WHEN 'BUILDING' THEN 'Asian' "
    "WHEN 'FURNITURE' THEN 'Hispanic or Latino' WHEN 'HOUSEHOLD' THEN 'Black or African-American' "
    "ELSE 'American Indian and Alaska Native' END"
)
CITY_MEASURES = {
    "total_population": "CAST(n_nationkey AS BIGINT) * 1000",
    "median_age": "CAST(n_nationkey % 7 AS DOUBLE) + 30.5",
}


def shape_sql(columns: Mapping[str, str], source: str, *names: str) -> str:
    wanted = names or tuple(columns)
    return "SELECT " + ", ".join(f"{columns[n]} AS {n}" for n in wanted) + f" FROM {source}"


def _shape(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    return df.selectExpr(*[f"{expression} AS {name}" for name, expression in columns.items()])


def business(t: Tables) -> DataFrame:
    joined = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    nested = {
        "attributes": "struct(" + ", ".join(f"{e} AS {n}" for n, e in ATTRIBUTES.items()) + ")",
        "hours": "struct(" + ", ".join(f"{e} AS {n}" for n, e in HOURS.items()) + ")",
    }
    return _shape(joined, BUSINESS | nested)


def user(t: Tables) -> DataFrame:
    return _shape(t.customer, USER)


def review(t: Tables) -> DataFrame:
    return _shape(t.orders, REVIEW)


def checkin(t: Tables) -> DataFrame:
    return _shape(t.events, CHECKIN)


def tip(t: Tables) -> DataFrame:
    return _shape(t.lineitem, TIP)


def photo(t: Tables) -> DataFrame:
    return _shape(t.part, PHOTO)


def demographics(t: Tables) -> DataFrame:
    located = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    measures = [F.expr(e).alias(n) for n, e in CITY_MEASURES.items()]
    counted = located.groupBy(
        F.col("n_name").alias("city"), F.expr(BUSINESS["state"]).alias("state_code"), F.expr(RACE).alias("race"), *measures
    ).agg(F.count(F.lit(1)).alias("count"))
    # some cities are too small to be listed
    return counted.where("total_population >= 5000").select(F.struct(*counted.columns).alias("fields"))


def hourly(t: Tables) -> DataFrame:
    """Wide hourly series: one row per hour, one text column per event type, NULL where nothing happened."""
    return _hours(t).select("datetime", *[F.col(s).cast("string").alias(s) for s in SERIES])


def hourly_words(t: Tables) -> DataFrame:
    """The same hours described by a word."""
    return _hours(t).selectExpr("datetime", *[f"{word(s)} AS {s}" for s in SERIES])


def _hours(t: Tables) -> DataFrame:
    cells = [F.max(F.when(F.col("event_type") == s, F.col("value"))).alias(s) for s in SERIES]
    return t.events.groupBy(F.expr(HOUR).alias("datetime")).agg(*cells)


def word(column: str) -> str:
    return f"CASE WHEN {column} < 20 THEN 'clear' WHEN {column} < 60 THEN 'clouds' WHEN {column} < 150 THEN 'rain' WHEN {column} >= 150 THEN 'storm' END"


def hourly_sql() -> str:
    cells = ", ".join(f"max(CASE WHEN event_type = '{s}' THEN value END) AS {s}" for s in SERIES)
    return f"SELECT {HOUR} AS datetime, {cells} FROM events GROUP BY 1"


def hourly_words_sql() -> str:
    return f"SELECT datetime, {', '.join(f'{word(s)} AS {s}' for s in SERIES)} FROM ({hourly_sql()})"


def series_cities(t: Tables) -> DataFrame:
    return t.events.selectExpr("event_type AS city", f"{SERIES_STATE} AS state_code").distinct()


def series_attributes(t: Tables) -> DataFrame:
    return t.events.selectExpr("event_type AS City", f"{SERIES_COUNTRY} AS Country")


def key_sql(*columns: str) -> str:
    """SQL of the content key."""
    parts = [f"coalesce({text(f'length({text(c)})')} || ':' || {text(c)}, '-')" for c in columns]
    return f"md5({' || '.join(parts)})"


def foreign_key_sql(*columns: str) -> str:
    present = " AND ".join(f"{c} IS NOT NULL" for c in columns)
    return f"CASE WHEN {present} THEN {key_sql(*columns)} END"


def money_sql(column: str) -> str:
    """Exact sum of a two-decimal column, as double."""
    return f"CAST(sum(CAST({column} AS DECIMAL(18,2))) AS DOUBLE)"
