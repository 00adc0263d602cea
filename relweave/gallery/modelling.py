"""Joins, grouping, reshaping, keys, dimensions and whole tables of the model."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relweave.functions import content_key
from relweave.gallery import shapes as S
from relweave.gallery.registry import Tables, query
from relweave.gallery.shapes import RACE, foreign_key_sql, hourly_sql, hourly_words_sql, key_sql, money_sql, shape_sql, text
from relweave.gallery.values import CATEGORIES_SQL
from relweave.operators import aggregate as A
from relweave.operators import dimension as D
from relweave.operators import joins as J
from relweave.operators import reshape as P
from relweave.plans import normalise
from relweave.plans import vocabulary as V

# --- joins -----------------------------------------------------------------------------------------


@query(
    "SELECT o_orderkey, o_custkey, o_orderstatus, c_mktsegment FROM orders LEFT JOIN "
    "(SELECT c_custkey, 'F' AS st, c_mktsegment FROM customer WHERE c_acctbal > 0) "
    "ON o_custkey = c_custkey AND o_orderstatus = st"
)
def join_left_using(t: Tables) -> DataFrame:
    rich = t.customer.where("c_acctbal > 0").selectExpr("c_custkey AS o_custkey", "'F' AS o_orderstatus", "c_mktsegment")
    joined = J.lookup(t.orders, rich, ["o_custkey", "o_orderstatus"], ["c_mktsegment"])
    return joined.select("o_orderkey", "o_custkey", "o_orderstatus", "c_mktsegment")


COMPOSITE_LEFT = (
    "SELECT s_suppkey, s_nationkey, CASE WHEN s_acctbal >= 0 THEN 'S' || CAST(s_suppkey % 5 AS STRING) END AS zone, "
    "s_suppkey % 3 AS lane, s_suppkey % 2 AS side FROM supplier"
)
COMPOSITE_RIGHT = (
    "SELECT DISTINCT c_nationkey AS nation, CASE WHEN c_acctbal >= 0 THEN 'S' || CAST(c_custkey % 5 AS STRING) END AS area, "
    "c_custkey % 3 AS lane_no, c_custkey % 2 AS side_no FROM customer"
)


def _composite(t: Tables, null_safe: bool) -> DataFrame:
    left = t.spark.sql(COMPOSITE_LEFT.replace("supplier", "{supplier}"), supplier=t.supplier)
    right = t.spark.sql(COMPOSITE_RIGHT.replace("customer", "{customer}"), customer=t.customer)
    right = right.withColumn("address_id", content_key("nation", "area", "lane_no", "side_no"))
    on = {"s_nationkey": "nation", "zone": "area", "lane": "lane_no", "side": "side_no"}
    return J.lookup(left, right, on, ["address_id"], null_safe=null_safe).select("s_suppkey", "zone", "address_id")


def _composite_sql(equals: str) -> str:
    return (
        f"SELECT s_suppkey, zone, address_id FROM ({COMPOSITE_LEFT}) LEFT JOIN (SELECT *, "
        f"{key_sql('nation', 'area', 'lane_no', 'side_no')} AS address_id FROM ({COMPOSITE_RIGHT})) ON s_nationkey = nation "
        f"AND zone {equals} area AND lane = lane_no AND side = side_no"
    )


@query(_composite_sql("="))
def join_left_composite(t: Tables) -> DataFrame:
    return _composite(t, null_safe=False)


@query(_composite_sql("IS NOT DISTINCT FROM"))
def join_left_null_safe(t: Tables) -> DataFrame:
    return _composite(t, null_safe=True)


@query("SELECT s_suppkey, n_name, r_name FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey")
def join_inner_using(t: Tables) -> DataFrame:
    nations = J.lookup(t.nation, t.region, {"n_regionkey": "r_regionkey"}, ["r_name"], "inner")
    return J.lookup(t.supplier, nations, {"s_nationkey": "n_nationkey"}, ["n_name", "r_name"], "inner").select(
        "s_suppkey", "n_name", "r_name"
    )


@query("SELECT event_id, user_id, c_mktsegment FROM events LEFT JOIN customer ON user_id = c_custkey AND c_acctbal > 1000")
def join_salted(t: Tables) -> DataFrame:
    customers = t.customer.where("c_acctbal > 1000").selectExpr("c_custkey AS user_id", "c_mktsegment")
    events = t.events.select("event_id", "user_id")
    return J.salted_lookup(events, customers, ["user_id"], ["c_mktsegment"], hot_share=0.0001, salts=8)


@query(
    "SELECT o_custkey, count(*) AS n_rows FROM orders WHERE o_custkey NOT IN "
    "(SELECT c_custkey FROM customer WHERE c_mktsegment <> 'BUILDING') GROUP BY o_custkey"
)
def fk_orphans(t: Tables) -> DataFrame:
    return J.orphans(t.orders, t.customer.where("c_mktsegment <> 'BUILDING'"), {"o_custkey": "c_custkey"})


# --- grouping --------------------------------------------------------------------------------------


@query("SELECT l_returnflag, CASE WHEN l_linestatus = 'O' THEN l_linestatus END AS status, count(*) AS n FROM lineitem GROUP BY 1, 2")
def group_count(t: Tables) -> DataFrame:
    rows = t.lineitem.withColumn("status", F.when(F.col("l_linestatus") == "O", F.col("l_linestatus")))
    return A.group_count(rows, ["l_returnflag", "status"], "n")


@query(f"SELECT event_type, {money_sql('value')} / count(value) AS mean_value FROM events GROUP BY event_type")
def group_mean(t: Tables) -> DataFrame:
    return A.group_mean(t.events, ["event_type"], "value", "mean_value", scale=2)


@query(
    "SELECT o_custkey, string_agg(v || 'x' || CAST(n AS VARCHAR), ', ' ORDER BY v) AS priorities FROM "
    "(SELECT o_custkey, o_orderpriority AS v, count(*) AS n FROM orders GROUP BY 1, 2) GROUP BY o_custkey"
)
def collect_list_sorted(t: Tables) -> DataFrame:
    bags = A.collect_bag(t.orders, ["o_custkey"], "o_orderpriority", "bag")
    items = F.transform("bag", lambda x: F.concat(x["value"], F.lit("x"), x["n"].cast("string")))
    return bags.select("o_custkey", F.array_join(items, ", ").alias("priorities"))


@query(
    "SELECT l_suppkey, l_orderkey, l_linenumber, l_extendedprice FROM (SELECT *, row_number() OVER (PARTITION BY l_suppkey "
    "ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber, l_partkey) AS r FROM lineitem) WHERE r <= 3"
)
def topk_per_group(t: Tables) -> DataFrame:
    columns = ["l_suppkey", "l_orderkey", "l_linenumber", "l_extendedprice"]
    order = [F.desc("l_extendedprice"), F.asc("l_orderkey"), F.asc("l_linenumber"), F.asc("l_partkey")]
    return A.top_k_per_group(t.lineitem, ["l_suppkey"], order, 3).select(*columns)


@query("SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1 ORDER BY n DESC, o_custkey LIMIT 10")
def topk(t: Tables) -> DataFrame:
    counted = A.group_count(t.orders, ["o_custkey"], "n")
    return A.top_k(counted, [F.desc("n"), F.asc("o_custkey")], 10)


@query(
    "SELECT count(*) AS n_keys, max(n) AS max_rows, max(n) = 1 AS is_key FROM "
    "(SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)"
)
def candidate_key(t: Tables) -> DataFrame:
    return A.candidate_key(t.lineitem, ["l_orderkey", "l_linenumber"])


def _mode_sql(rank: str) -> str:
    return (
        "SELECT user_id, day, word FROM (SELECT *, row_number() OVER (PARTITION BY user_id, day ORDER BY "
        f"{rank}) AS r FROM (SELECT user_id, CAST(ts AS DATE) AS day, CASE WHEN event_type <> 'view' THEN event_type END AS word, "
        "count(*) AS n FROM events GROUP BY 1, 2, 3)) WHERE r = 1"
    )


def _words(t: Tables) -> DataFrame:
    return t.events.select(
        "user_id", F.col("ts").cast("date").alias("day"),
        F.when(F.col("event_type") != "view", F.col("event_type")).alias("word"),
    )


@query(_mode_sql("(word IS NULL), n DESC, word"))
def mode_per_group(t: Tables) -> DataFrame:
    return A.mode_per_group(_words(t), ["user_id", "day"], "word")


@query(_mode_sql("n DESC, (word IS NULL), word"))
def mode_with_nulls(t: Tables) -> DataFrame:
    return A.mode_per_group(_words(t), ["user_id", "day"], "word", ignore_nulls=False)


# --- reshape ---------------------------------------------------------------------------------------

PRIORITIES = ("1_urgent", "2_high", "3_medium", "4_not_specified", "5_low")


@query(
    "SELECT nation, segment, "
    + ", ".join(f"max(CASE WHEN slug = '{p}' THEN n END) AS \"{p}\"" for p in PRIORITIES)
    + " FROM (SELECT c_nationkey AS nation, c_mktsegment AS segment, lower(replace(replace(o_orderpriority, ' ', '_'), '-', '_')) AS slug, "
    "count(*) AS n FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2, 3) GROUP BY 1, 2"
)
def pivot_max(t: Tables) -> DataFrame:
    # orders are counted per customer first, so that the join does not carry them one by one
    slug = F.lower(F.translate("o_orderpriority", " -", "__")).alias("slug")
    per_customer = t.orders.groupBy("o_custkey", slug).agg(F.count(F.lit(1)).alias("n"))
    segments = t.customer.selectExpr("c_custkey", "c_nationkey AS nation", "c_mktsegment AS segment")
    located = J.lookup(per_customer, segments, {"o_custkey": "c_custkey"}, ["nation", "segment"], "inner")
    counted = located.groupBy("nation", "segment", "slug").agg(F.sum("n").alias("n"))
    return P.pivot_max(counted, "slug", "n", values=PRIORITIES)


@query(
    " UNION ALL ".join(
        f"SELECT o_orderkey, '{c}' AS name, {text(c)} AS value FROM orders" for c in ("o_custkey", "o_orderstatus", "o_orderpriority")
    )
)
def unpivot_columns(t: Tables) -> DataFrame:
    texts = t.orders.select("o_orderkey", F.col("o_custkey").cast("string").alias("o_custkey"), "o_orderstatus", "o_orderpriority")
    return P.unpivot(texts, ["o_orderkey"], ["o_custkey", "o_orderstatus", "o_orderpriority"], "name", "value")


DAILY_MEAN_SQL = " UNION ALL ".join(
    f"SELECT substring(datetime, 1, 10) AS date, '{s}' AS city, {money_sql(s)} / nullif(count({s}), 0) AS avg_temperature "
    f"FROM ({hourly_sql()}) GROUP BY 1"
    for s in S.SERIES
)


@query(DAILY_MEAN_SQL)
def wide_to_daily_mean(t: Tables) -> DataFrame:
    wide = S.hourly(t).select(
        F.substring("datetime", 1, 10).alias("date"), *[F.col(s).try_cast("double").alias(s) for s in S.SERIES]
    )
    return P.series_mean(wide, "date", S.SERIES, "city", "avg_temperature", scale=2)


def _daily_mode_sql(name: str) -> str:
    return (
        f"SELECT substring(datetime, 1, 10) AS date, '{name}' AS city, {name} AS word, count(*) AS n "
        f"FROM ({hourly_words_sql()}) GROUP BY 1, 3"
    )


DAILY_MODE_SQL = (
    "SELECT date, city, word AS weather_description FROM (SELECT *, row_number() OVER (PARTITION BY date, city "
    "ORDER BY (word IS NULL), n DESC, word) AS r FROM ("
    + " UNION ALL ".join(_daily_mode_sql(s) for s in S.SERIES)
    + ")) WHERE r = 1"
)


@query(DAILY_MODE_SQL)
def wide_to_daily_mode(t: Tables) -> DataFrame:
    wide = S.hourly_words(t).withColumn("date", F.substring("datetime", 1, 10))
    return P.series_mode(wide, "date", S.SERIES, "city", "weather_description")


# --- keys and dimensions ---------------------------------------------------------------------------


@query(f"SELECT c_custkey, {key_sql('c_name', 'c_mktsegment', 'zone')} AS key FROM "
       "(SELECT c_custkey, c_name, c_mktsegment, CASE WHEN c_acctbal > 0 THEN c_nationkey END AS zone FROM customer)")
def hash_key(t: Tables) -> DataFrame:
    zoned = t.customer.withColumn("zone", F.when(F.col("c_acctbal") > 0, F.col("c_nationkey")))
    return zoned.select("c_custkey", content_key("c_name", "c_mktsegment", "zone").alias("key"))


@query("SELECT l_orderkey, l_linenumber, row_number() OVER (ORDER BY l_orderkey, l_linenumber) AS id "
       "FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)")
def dense_key(t: Tables) -> DataFrame:
    return D.extract_dimension(t.lineitem, ["l_orderkey", "l_linenumber"], "id", style="dense")


@query(
    "WITH old AS (SELECT p_name, row_number() OVER (ORDER BY p_name) AS id FROM (SELECT DISTINCT p_name FROM part WHERE p_partkey % 3 = 0)), "
    "late AS (SELECT DISTINCT p_name FROM part WHERE p_name NOT IN (SELECT p_name FROM old)) SELECT * FROM old UNION ALL "
    "SELECT p_name, (SELECT max(id) FROM old) + row_number() OVER (ORDER BY p_name) FROM late"
)
def dense_key_stable(t: Tables) -> DataFrame:
    issued = D.extract_dimension(t.part.where("p_partkey % 3 = 0"), ["p_name"], "id", style="dense")
    return D.extend_keys(issued, t.part, ["p_name"], "id")


TIP_SQL = (
    "SELECT user_id, business_id, text, TRY_CAST(date AS TIMESTAMP) AS ts, compliment_count FROM "
    f"({shape_sql(S.TIP, S.TIP_FROM)})"
)


@query(
    f"SELECT user_id, business_id, text, ts, compliment_count, {key_sql('user_id', 'business_id', 'text', 'ts', 'compliment_count', 'k')} "
    f"AS tip_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id, business_id, text, ts, compliment_count) AS k FROM ({TIP_SQL}))"
)
def tips_table(t: Tables) -> DataFrame:
    return normalise.tips(S.tip(t))


@query(
    "SELECT l_returnflag, l_linestatus, "
    f"{key_sql('l_returnflag', 'l_linestatus', 'k')} AS id FROM "
    "(SELECT *, row_number() OVER (PARTITION BY l_returnflag, l_linestatus) AS k FROM lineitem)"
)
def occurrence_key(t: Tables) -> DataFrame:
    # six different rows only: every group of copies is far above the chunk size
    return D.occurrence_key(t.lineitem.select("l_returnflag", "l_linestatus"), "id", chunk=1_000)


ADDRESS_COLUMNS = ("address", "latitude", "longitude", "postal_code", "city_id")
LOCATED_SQL = (
    f"SELECT *, {foreign_key_sql('city', 'state')} AS city_id FROM "
    f"({shape_sql(S.BUSINESS, S.BUSINESS_FROM, 'business_id', 'name', 'address', 'latitude', 'longitude', 'postal_code', 'city', 'state', 'stars', 'review_count', 'is_open')})"
)
ADDRESSES_SQL = (
    f"SELECT *, {key_sql(*ADDRESS_COLUMNS)} AS address_id FROM (SELECT DISTINCT {', '.join(ADDRESS_COLUMNS)} FROM ({LOCATED_SQL}))"
)


@query(ADDRESSES_SQL)
def extract_dimension(t: Tables) -> DataFrame:
    return normalise.addresses(S.business(t))


FACTS = "business_id, address_id, CAST(is_open AS BOOLEAN) AS is_open, name, review_count, stars"


@query(
    f"SELECT {FACTS} FROM (SELECT *, CASE WHEN postal_code IS NOT NULL THEN {key_sql(*ADDRESS_COLUMNS)} END AS address_id "
    f"FROM ({LOCATED_SQL}))"
)
def businesses_table(t: Tables) -> DataFrame:
    return normalise.businesses(S.business(t))


@query(
    f"SELECT {FACTS} FROM ({LOCATED_SQL}) AS b LEFT JOIN (SELECT address AS a, latitude AS la, longitude AS lo, "
    f"postal_code AS pc, address_id FROM ({ADDRESSES_SQL})) ON address = a AND latitude = la AND longitude = lo AND postal_code = pc"
)
def businesses_loose(t: Tables) -> DataFrame:
    docs = S.business(t)
    return normalise.businesses(docs, normalise.addresses(docs), match="loose")


CATEGORY_SQL = f"SELECT DISTINCT business_id, unnest(items) AS category FROM ({CATEGORIES_SQL})"


@query(f"SELECT category, row_number() OVER (ORDER BY category) AS category_id FROM (SELECT DISTINCT category FROM ({CATEGORY_SQL}))")
def categories_dim(t: Tables) -> DataFrame:
    return normalise.categories(S.business(t), keys="dense")


@query(f"SELECT category, {key_sql('category')} AS category_id FROM (SELECT DISTINCT category FROM ({CATEGORY_SQL}))")
def categories_hashed(t: Tables) -> DataFrame:
    return normalise.categories(S.business(t))


@query(
    f"WITH pairs AS ({CATEGORY_SQL}) SELECT business_id, category_id FROM pairs JOIN (SELECT category AS c, row_number() OVER "
    "(ORDER BY category) AS category_id FROM (SELECT DISTINCT category FROM pairs)) ON category = c"
)
def bridge_table(t: Tables) -> DataFrame:
    docs = S.business(t)
    return normalise.business_categories(docs, normalise.categories(docs, "dense"), "dense")


@query(f"SELECT business_id, {key_sql('category')} AS category_id FROM ({CATEGORY_SQL})")
def bridge_hashed(t: Tables) -> DataFrame:
    return normalise.business_categories(S.business(t))


DEMO_SQL = (
    f"SELECT n_name AS city, {S.BUSINESS['state']} AS state_code, "
    + ", ".join(f"{e} AS {n}" for n, e in S.CITY_MEASURES.items())
    + f", lower(replace(replace({RACE}, ' ', '_'), '-', '_')) AS race, count(*) AS n "
    f"FROM {S.BUSINESS_FROM} WHERE n_nationkey >= 5 GROUP BY ALL"
)


@query(
    f"SELECT c.city, c.state_code, {', '.join(V.POPULATION_GROUPS)}, median_age, total_population, {key_sql('c.city', 'c.state_code')} AS city_id "
    f"FROM (SELECT DISTINCT n_name AS city, {S.BUSINESS['state']} AS state_code FROM {S.BUSINESS_FROM}) AS c "
    "LEFT JOIN (SELECT city, state_code, median_age, total_population, "
    + ", ".join(f"max(CASE WHEN race = '{g}' THEN n END) AS {g}" for g in V.POPULATION_GROUPS)
    + f" FROM ({DEMO_SQL}) GROUP BY 1, 2, 3, 4) AS d ON c.city = d.city AND c.state_code = d.state_code"
)
def cities_enriched(t: Tables) -> DataFrame:
    return normalise.cities(S.business(t), S.demographics(t))


WEATHER_SQL = (
    "SELECT TRY_CAST(m.date AS DATE) AS date, avg_temperature, weather_description, city_id FROM "
    f"({DAILY_MEAN_SQL}) AS m JOIN ({DAILY_MODE_SQL}) AS w ON m.date = w.date AND m.city = w.city JOIN "
    f"(SELECT city, {key_sql('city', 'state_code')} AS city_id FROM (VALUES ('click', 'AZ'), ('purchase', 'CA')) "
    "AS known(city, state_code)) AS k ON m.city = k.city"
)


@query(WEATHER_SQL)
def weather_daily(t: Tables) -> DataFrame:
    cities = D.extract_dimension(S.series_cities(t), ["city", "state_code"], "city_id")
    return normalise.city_weather(
        t.spark, cities, S.series_attributes(t), S.hourly(t), S.hourly_words(t), S.SERIES_STATES, scale=2
    )
