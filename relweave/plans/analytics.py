"""Questions over the tables.

Facts are reduced to one row per business (and day) before they meet a dimension, so the joins carry
far fewer rows than the facts and a much-reviewed business is no hot key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relweave.operators.aggregate import top_k
from relweave.operators.joins import broadcast_within, lookup, salted_lookup


def business_city(businesses: DataFrame, addresses: DataFrame) -> DataFrame:
    """``business_id, city_id`` for every business with a known address."""
    places = businesses.select("business_id", "address_id")
    located = lookup(places, addresses, ["address_id"], ["city_id"], "inner").select("business_id", "city_id")
    # an address is one row of its table, so there are no more pairs than businesses
    return broadcast_within(located, places)


def stars_by_city(reviews: DataFrame, businesses: DataFrame, addresses: DataFrame, cities: DataFrame, scale: int = 2) -> DataFrame:
    """Average star rating and number of ratings per city."""
    per_business = reviews.groupBy("business_id").agg(
        F.sum(F.col("stars").cast(f"decimal(18,{scale})")).alias("stars"), F.count("stars").alias("n")
    )
    located = per_business.join(business_city(businesses, addresses), "business_id")
    per_city = located.groupBy("city_id").agg(F.sum("stars").cast("double").alias("stars"), F.sum("n").alias("n_ratings"))
    rated = per_city.select("city_id", (F.col("stars") / F.nullif("n_ratings", F.lit(0))).alias("avg_stars"), "n_ratings")
    return lookup(rated, cities, ["city_id"], ["city"], "inner").select("city_id", "city", "avg_stars", "n_ratings")


def ratings_and_population(
    reviews: DataFrame, businesses: DataFrame, addresses: DataFrame, cities: DataFrame, unrated: bool = False
) -> DataFrame:
    """``city_id, n_ratings, total_population`` of every city with both; with ``unrated`` also of those without a rating, as 0."""
    per_business = reviews.groupBy("business_id").agg(F.count(F.lit(1)).alias("n"))
    located = per_business.join(business_city(businesses, addresses), "business_id")
    per_city = located.groupBy("city_id").agg(F.sum("n").alias("n_ratings"))
    if unrated:
        known = cities.where(F.col("total_population").isNotNull()).groupBy("city_id").agg(F.first("total_population").alias("total_population"))
        rated = known.join(per_city, "city_id", "left")
        return rated.select("city_id", F.coalesce("n_ratings", F.lit(0)).cast("long").alias("n_ratings"), "total_population")
    joined = lookup(per_city, cities, ["city_id"], ["total_population"], "inner")
    return joined.where(F.col("total_population").isNotNull())


def ratings_population_correlation(pairs: DataFrame) -> DataFrame:
    """Does the number of ratings follow the population? Pearson correlation over the cities."""
    return pairs.agg(
        F.count(F.lit(1)).alias("n_cities"), F.corr("n_ratings", "total_population").alias("correlation")
    )


def businesses_in(business_categories: DataFrame, categories: DataFrame, names: Sequence[str]) -> DataFrame:
    """``business_id`` of the businesses in one of the named categories; a business may come more than once."""
    wanted = categories.where(F.col("category").isin(list(names))).select("category_id")
    return business_categories.join(wanted, "category_id", "left_semi").select("business_id")


def popular_when_hot(
    reviews: DataFrame, businesses: DataFrame, addresses: DataFrame, city_weather: DataFrame, min_temperature: float, k: int,
    among: DataFrame | None = None,
) -> DataFrame:
    """The ``k`` businesses with most reviews on days at least that hot in their city.

    ``among`` restricts them to its ``business_id``, such as the restaurants by :func:`businesses_in`.
    """
    if among is not None:
        businesses = businesses.join(among.select("business_id"), "business_id", "left_semi")
    hot_days = city_weather.where(F.col("avg_temperature") >= min_temperature).select("city_id", "date").distinct()
    per_day = reviews.groupBy("business_id", F.col("ts").cast("date").alias("date")).agg(F.count(F.lit(1)).alias("n"))
    located = per_day.join(business_city(businesses, addresses), "business_id")
    counted = located.join(hot_days, ["city_id", "date"]).groupBy("business_id").agg(F.sum("n").alias("n_reviews"))
    return top_k(counted, [F.desc("n_reviews"), F.asc("business_id")], k)


def weather_at_review(
    reviews: DataFrame,
    businesses: DataFrame,
    addresses: DataFrame,
    city_weather: DataFrame,
    columns: Sequence[str] = ("review_id", "business_id", "ts"),
    hot_share: float | None = None,
    salts: int = 32,
) -> DataFrame:
    """Every review with the weather of its city on its day (NULL where unknown).

    Each review has to reach its business, and a business may hold a large share of the reviews: AQE
    splits such a partition; ``hot_share`` salts businesses with more than that share of the reviews explicitly.
    """
    dated = reviews.select(*columns).withColumn("date", F.col("ts").cast("date"))
    places = business_city(businesses, addresses)
    if hot_share is None:
        located = lookup(dated, places, ["business_id"], ["city_id"])
    else:
        located = salted_lookup(dated, places, ["business_id"], ["city_id"], hot_share, salts)
    weather = city_weather.select("city_id", "date", "avg_temperature", "weather_description")
    return located.join(weather, ["city_id", "date"], "left").select(
        *columns, "city_id", "avg_temperature", "weather_description"
    )
