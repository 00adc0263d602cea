"""Analytical questions: events are the ratings, customers the businesses, nations the cities."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relweave.gallery.registry import Tables, query
from relweave.gallery.shapes import money_sql
from relweave.operators.aggregate import mean_state, means, merge_means
from relweave.operators.dimension import extract_dimension, foreign_key
from relweave.plans import analytics as Q
from relweave.session import materialise


def _reviews(t: Tables) -> DataFrame:
    return t.events.selectExpr("event_id AS review_id", "user_id AS business_id", "value AS stars", "ts", "event_type")


def _businesses(t: Tables) -> DataFrame:
    return t.customer.selectExpr("c_custkey AS business_id", "c_custkey AS address_id")


def _addresses(t: Tables) -> DataFrame:
    return t.customer.selectExpr("c_custkey AS address_id", "c_nationkey AS city_id")


def _cities(t: Tables) -> DataFrame:
    people = t.customer.groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("total_population"))
    named = t.nation.selectExpr("n_nationkey AS c_nationkey", "n_name AS city")
    return named.join(people, "c_nationkey", "left").withColumnRenamed("c_nationkey", "city_id")


def _weather(t: Tables) -> DataFrame:
    """Mean value and most frequent type per city and day; the events are first counted per business.

    The result is stored, as the weather table of the model is: its size is then known, and the facts that
    look it up are not shuffled while it is small.
    """
    day = F.col("ts").cast("date").alias("date")
    place = Q.business_city(_businesses(t), _addresses(t))
    typed = _reviews(t).groupBy("business_id", day, "event_type").agg(
        F.sum(F.col("stars").cast("decimal(18,2)")).alias("total"), F.count("stars").alias("n")
    )
    per_city = typed.join(place, "business_id").groupBy("city_id", "date", "event_type").agg(
        F.sum("total").alias("total"), F.sum("n").alias("n")
    )
    best = F.min(F.struct((-F.col("n")).alias("n"), F.col("event_type").alias("word")))
    daily = per_city.groupBy("city_id", "date").agg(
        (F.sum("total").cast("double") / F.sum("n")).alias("avg_temperature"), best["word"].alias("weather_description")
    )
    return materialise(daily, "weather")


RATED = "events JOIN customer ON user_id = c_custkey JOIN nation ON c_nationkey = n_nationkey"


@query(f"SELECT n_nationkey AS city_id, n_name AS city, {money_sql('value')} / count(value) AS avg_stars, count(value) AS n_ratings FROM {RATED} GROUP BY 1, 2")
def avg_stars_by_city(t: Tables) -> DataFrame:
    return Q.stars_by_city(_reviews(t), _businesses(t), _addresses(t), _cities(t))


RATINGS_SQL = (
    "SELECT city_id, n_ratings, total_population FROM "
    f"(SELECT n_nationkey AS city_id, count(*) AS n_ratings FROM {RATED} GROUP BY 1) JOIN "
    "(SELECT c_nationkey, count(*) AS total_population FROM customer GROUP BY 1) ON city_id = c_nationkey"
)


@query(RATINGS_SQL)
def ratings_per_population(t: Tables) -> DataFrame:
    return Q.ratings_and_population(_reviews(t), _businesses(t), _addresses(t), _cities(t))


@query(f"SELECT count(*) AS n_cities, round(corr(n_ratings, total_population), 9) AS correlation FROM ({RATINGS_SQL})")
def ratings_vs_population(t: Tables) -> DataFrame:
    pairs = Q.ratings_and_population(_reviews(t), _businesses(t), _addresses(t), _cities(t))
    return Q.ratings_population_correlation(pairs).withColumn("correlation", F.round("correlation", 9))


DAY_MEAN_SQL = (
    f"SELECT c_nationkey AS city_id, CAST(ts AS DATE) AS date, {money_sql('value')} / count(*) AS avg_temperature "
    "FROM events JOIN customer ON user_id = c_custkey GROUP BY 1, 2"
)
DAY_MODE_SQL = (
    "SELECT city_id, date, event_type AS weather_description FROM (SELECT *, row_number() OVER (PARTITION BY city_id, date ORDER BY n DESC, event_type) AS r "
    "FROM (SELECT c_nationkey AS city_id, CAST(ts AS DATE) AS date, event_type, count(*) AS n FROM events JOIN customer ON user_id = c_custkey GROUP BY 1, 2, 3)) WHERE r = 1"
)


@query(
    f"WITH hot AS (SELECT city_id, date FROM ({DAY_MEAN_SQL}) WHERE avg_temperature >= 60) SELECT user_id AS business_id, count(*) AS n_reviews "
    "FROM events JOIN customer ON user_id = c_custkey JOIN hot ON c_nationkey = city_id AND CAST(ts AS DATE) = date "
    "GROUP BY 1 ORDER BY n_reviews DESC, business_id LIMIT 20"
)
def popular_when_hot(t: Tables) -> DataFrame:
    return Q.popular_when_hot(_reviews(t), _businesses(t), _addresses(t), _weather(t), 60.0, 20)


@query(
    f"WITH hot AS (SELECT city_id, date FROM ({DAY_MEAN_SQL}) WHERE avg_temperature >= 60) SELECT user_id AS business_id, count(*) AS n_reviews "
    "FROM events JOIN customer ON user_id = c_custkey JOIN hot ON c_nationkey = city_id AND CAST(ts AS DATE) = date "
    "WHERE c_mktsegment IN ('BUILDING', 'MACHINERY') GROUP BY 1 ORDER BY n_reviews DESC, business_id LIMIT 20"
)
def popular_restaurants_when_hot(t: Tables) -> DataFrame:
    # market segments are the categories
    categories = extract_dimension(t.customer.selectExpr("c_mktsegment AS category"), ["category"], "category_id")
    member_of = t.customer.select(F.col("c_custkey").alias("business_id"), foreign_key(["c_mktsegment"]).alias("category_id"))
    among = Q.businesses_in(member_of, categories, ["BUILDING", "MACHINERY"])
    return Q.popular_when_hot(_reviews(t), _businesses(t), _addresses(t), _weather(t), 60.0, 20, among)


STARS_SQL = f"{money_sql('o_totalprice')} / count(o_totalprice)"


@query(f"SELECT o_custkey AS city_id, {STARS_SQL} AS avg_stars, count(o_totalprice) AS n FROM orders GROUP BY 1")
def avg_stars_incremental(t: Tables) -> DataFrame:
    rated = t.orders.selectExpr("o_custkey AS city_id", "o_totalprice AS stars", "o_orderdate AS ts")
    days = ["ts < TIMESTAMP_NTZ '1996-01-01'", "ts >= TIMESTAMP_NTZ '1996-01-01' AND ts < TIMESTAMP_NTZ '2000-01-01'", "ts >= TIMESTAMP_NTZ '2000-01-01'"]
    state = materialise(mean_state(rated.where(days[0]), ["city_id"], "stars"), "means")
    for day in days[1:]:
        state = materialise(merge_means(state, rated.where(day), ["city_id"], "stars"), "means")
    return means(state, "avg_stars")


@query(
    "SELECT event_id AS review_id, user_id AS business_id, ts, c_nationkey AS city_id, avg_temperature, weather_description "
    "FROM events LEFT JOIN customer ON user_id = c_custkey "
    f"LEFT JOIN ({DAY_MEAN_SQL}) AS m ON c_nationkey = m.city_id AND CAST(ts AS DATE) = m.date "
    f"LEFT JOIN ({DAY_MODE_SQL}) AS w ON c_nationkey = w.city_id AND CAST(ts AS DATE) = w.date"
)
def weather_at_event(t: Tables) -> DataFrame:
    return Q.weather_at_review(_reviews(t), _businesses(t), _addresses(t), _weather(t))
