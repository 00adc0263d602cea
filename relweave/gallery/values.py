"""Cleaning of masked values, and delimited text to rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relweave.functions import clean_bool, clean_int, clean_string, parse_date, slugify
from relweave.gallery import shapes as S
from relweave.gallery.registry import Tables, query
from relweave.gallery.shapes import QUOTE, masked_boolean, masked_dict, masked_integer, masked_text, shape_sql
from relweave.operators import nested as N
from relweave.plans import normalise
from relweave.plans import vocabulary as V

U_QUOTE = f"'u' || {QUOTE}"


def bool_sql(column: str) -> str:
    return f"CASE {column} WHEN 'True' THEN true WHEN 'False' THEN false END"


def string_sql(column: str) -> str:
    return f"lower(replace(replace(nullif({column}, ''), {U_QUOTE}, ''), {QUOTE}, ''))"


@query(f"SELECT c_custkey, {bool_sql('v')} AS flag FROM (SELECT c_custkey, {masked_boolean('c_custkey')} AS v FROM customer)")
def _clean_bool(t: Tables) -> DataFrame:
    raw = t.customer.selectExpr("c_custkey", f"{masked_boolean('c_custkey')} AS v")
    return raw.select("c_custkey", clean_bool("v").alias("flag"))


@query(
    f"SELECT p_partkey, {string_sql('v')} AS word FROM "
    f"(SELECT p_partkey, coalesce({masked_text('p_partkey', 'Menu')}, p_name) AS v FROM part)"
)
def _clean_string(t: Tables) -> DataFrame:
    raw = t.part.selectExpr("p_partkey", f"coalesce({masked_text('p_partkey', 'Menu')}, p_name) AS v")
    return raw.select("p_partkey", clean_string("v").alias("word"))


@query(
    "SELECT p_partkey, CASE WHEN v <> 'None' THEN TRY_CAST(v AS INTEGER) END AS n FROM "
    f"(SELECT p_partkey, CASE WHEN p_size > 45 THEN p_type ELSE {masked_integer('p_partkey')} END AS v FROM part)"
)
def _clean_int(t: Tables) -> DataFrame:
    raw = t.part.selectExpr(
        "p_partkey", f"CASE WHEN p_size > 45 THEN p_type ELSE {masked_integer('p_partkey')} END AS v"
    )
    return raw.select("p_partkey", clean_int("v").alias("n"))


@query("SELECT o_orderkey, lower(replace(replace(o_orderpriority, ' ', '_'), '-', '_')) AS slug FROM orders")
def _slugify(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", slugify("o_orderpriority").alias("slug"))


@query(
    "SELECT review_id, TRY_CAST(date AS TIMESTAMP) AS ts, TRY_CAST(substring(date, 1, 10) AS DATE) AS day "
    f"FROM ({shape_sql(S.REVIEW, S.REVIEW_FROM, 'review_id', 'date')})"
)
def parse_ts(t: Tables) -> DataFrame:
    parsed = normalise.reviews(S.review(t).withColumn("day", parse_date(F.substring("date", 1, 10))))
    return parsed.select("review_id", "ts", "day")


DIETS = V.FLAG_ATTRIBUTES["DietaryRestrictions"]


def flag_sql(column: str, key: str) -> str:
    entry = f"{QUOTE} || '{key}' || {QUOTE} || ': "
    return f"CASE WHEN contains({column}, {entry}True') THEN true WHEN contains({column}, {entry}False') THEN false END"


@query(
    "SELECT p_partkey, "
    + ", ".join(f"{flag_sql('v', k)} AS {N.column_name_for('diet', k)}" for k in DIETS)
    + f" FROM (SELECT p_partkey, {masked_dict('p_partkey', DIETS)} AS v FROM part)"
)
def map_to_columns(t: Tables) -> DataFrame:
    raw = t.part.selectExpr("p_partkey", f"{masked_dict('p_partkey', DIETS)} AS diet")
    return N.flag_dicts_to_columns(raw, {"diet": DIETS})


def _labelled(t: Tables) -> DataFrame:
    entries = F.map_filter(
        F.create_map(
            F.lit("brand"), F.when(F.col("p_size") > 10, F.col("p_brand")),
            F.lit("long-type"), F.when(F.col("p_size") > 20, F.col("p_type")),
        ),
        lambda _, v: v.isNotNull(),
    )
    return t.part.select("p_partkey", "p_name", entries.alias("labels"))


@query(
    "SELECT p_partkey, p_name, CASE WHEN p_size > 10 THEN p_brand END AS labels_brand, "
    "CASE WHEN p_size > 20 THEN p_type END AS labels_long_type FROM part"
)
def map_keys_discovered(t: Tables) -> DataFrame:
    return N.map_to_columns(_labelled(t), "labels")


@query(
    "SELECT p_partkey, 'brand' AS key, p_brand AS value FROM part WHERE p_size > 10 AND p_brand IS NOT NULL "
    "UNION ALL SELECT p_partkey, 'long-type', p_type FROM part WHERE p_size > 20 AND p_type IS NOT NULL"
)
def map_long(t: Tables) -> DataFrame:
    return N.map_long(_labelled(t), "labels", ["p_partkey"])


@query("SELECT 'long-type' AS key, count(*) AS n_rows FROM part WHERE p_size > 20 AND p_type IS NOT NULL HAVING count(*) > 0")
def undeclared_keys(t: Tables) -> DataFrame:
    return N.undeclared_keys(_labelled(t), "labels", ["brand"])


LITERAL_FIELDS = {
    "name": "string", "size": "int", "large": "boolean", "none": "string", "tags": "array<string>", "deep": "struct<k: array<int>, t: string>",
    "type": "int",
}


@query(
    "SELECT p_partkey, p_name AS raw_name, CAST(p_size AS INTEGER) AS raw_size, p_size > 25 AS raw_large, CAST(NULL AS VARCHAR) AS raw_none, "
    f"p_brand || ',O' || {QUOTE} || 'x ' || chr(34) || 'y' || chr(34) AS raw_tags, CAST(p_size + 1 AS INTEGER) AS raw_deep, "
    "CAST(NULL AS INTEGER) AS raw_type FROM part"
)
def literal_values(t: Tables) -> DataFrame:
    def put(*pieces):
        return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in pieces])

    size = F.col("p_size").cast("string")
    large = F.when(F.col("p_size") > 25, F.lit("True")).otherwise(F.lit("False"))
    raw = put(
        "{'name': u'", F.col("p_name"), "', 'size': ", size, ", 'large': ", large, ", 'none': None, 'tags': ['", F.col("p_brand"),
        "', \"O'x \\\"y\\\"\",], 'deep': {'k': (", size, ", ", (F.col("p_size") + 1).cast("string"), "), 't': 'None'}, 'type': '", F.col("p_type"), "'}",
    )
    wide = N.literals_to_columns(t.part.select("p_partkey", raw.alias("raw")), "raw", LITERAL_FIELDS)
    return wide.withColumns({"raw_tags": F.array_join("raw_tags", ","), "raw_deep": F.col("raw_deep.k")[1]})


ATTRIBUTES_SQL = (
    "SELECT business_id, "
    + ", ".join(
        [f"{bool_sql(a)} AS {a}" for a in V.BOOLEAN_ATTRIBUTES]
        + [f"{string_sql(a)} AS {a}" for a in V.TEXT_ATTRIBUTES]
        + [f"CASE WHEN {a} <> 'None' THEN TRY_CAST({a} AS INTEGER) END AS {a}" for a in V.INTEGER_ATTRIBUTES]
        + [f"{flag_sql(a, k)} AS {N.column_name_for(a, k)}" for a, keys in V.FLAG_ATTRIBUTES.items() for k in keys]
    )
    + f" FROM ({shape_sql(S.BUSINESS | S.ATTRIBUTES, S.BUSINESS_FROM, 'business_id', *S.ATTRIBUTES)})"
)


@query(ATTRIBUTES_SQL)
def attributes_flatten(t: Tables) -> DataFrame:
    return normalise.business_attributes(S.business(t))


LIST_SQL = (
    f"list_filter(list_concat(CASE WHEN contains(categories, '{V.PROTECTED_CATEGORIES[0]}') "
    f"THEN ['{V.PROTECTED_CATEGORIES[0]}'] ELSE [] END, "
    f"regexp_split_to_array(replace(categories, '{V.PROTECTED_CATEGORIES[0]}', ''), ',\\s*')), lambda x: x <> '')"
)
CATEGORIES_SQL = (
    f"SELECT business_id, CASE WHEN categories IS NULL THEN [] ELSE {LIST_SQL} END AS items "
    f"FROM ({shape_sql(S.BUSINESS, S.BUSINESS_FROM, 'business_id', 'categories')})"
)


@query(f"SELECT business_id, array_to_string(items, '|') AS items, CAST(len(items) AS INTEGER) AS n_items FROM ({CATEGORIES_SQL})")
def parse_categories(t: Tables) -> DataFrame:
    parsed = S.business(t).select("business_id", normalise.category_list().alias("items"))
    return parsed.select("business_id", F.concat_ws("|", "items").alias("items"), F.size("items").alias("n_items"))


def exploded_sql(shape: str, column: str, sep: str, keep: str) -> str:
    return (
        f"SELECT {keep}, item FROM (SELECT {keep}, unnest(string_split({column}, '{sep}')) AS item FROM ({shape})) "
        "WHERE item <> ''"
    )


@query(
    "SELECT user_id, TRY_CAST(item AS INTEGER) AS year FROM ("
    + exploded_sql(shape_sql(S.USER, S.USER_FROM, "user_id", "elite"), "elite", ",", "user_id") + ")"
)
def split_explode_years(t: Tables) -> DataFrame:
    return normalise.elite_years(S.user(t))


@query(
    "SELECT DISTINCT user_id, item AS friend_id FROM ("
    + exploded_sql(shape_sql(S.USER, S.USER_FROM, "user_id", "friends"), "friends", ", ", "user_id") + ")"
)
def split_explode_edges(t: Tables) -> DataFrame:
    return normalise.friends(S.user(t))


@query(
    "SELECT business_id, TRY_CAST(item AS TIMESTAMP) AS ts FROM ("
    + exploded_sql(shape_sql(S.CHECKIN, S.CHECKIN_FROM), "date", ", ", "business_id") + ")"
)
def split_explode_ts(t: Tables) -> DataFrame:
    return normalise.checkins(S.checkin(t))


@query(
    "SELECT user_id, name, average_stars, fans, TRY_CAST(yelping_since AS TIMESTAMP) AS yelping_since FROM ("
    + shape_sql(S.USER, S.USER_FROM) + ")"
)
def users_table(t: Tables) -> DataFrame:
    return normalise.users(S.user(t))


@query(shape_sql(S.PHOTO, S.PHOTO_FROM))
def photos_table(t: Tables) -> DataFrame:
    return normalise.photos(S.photo(t))


@query(
    "SELECT review_id, user_id, business_id, stars, TRY_CAST(date AS TIMESTAMP) AS ts, text, useful FROM ("
    + shape_sql(S.REVIEW, S.REVIEW_FROM) + ")"
)
def reviews_table(t: Tables) -> DataFrame:
    return normalise.reviews(S.review(t))
