"""The fifteen tables, each as a lazy transformation of its source documents.

``keys`` chooses the style of generated keys. With ``content`` (default) a foreign key is computed
from the natural key in place, so no table has to be joined to find it; with ``dense`` keys are 1..n
and are looked up.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from relweave.functions import (
    clean_bool, clean_int, clean_string, clock_of, content_key, day_text, parse_date, parse_timestamp, slugify,
    split_list, text_to,
)
from relweave.operators.aggregate import distinct_rows
from relweave.operators.dimension import bridge_table, extract_dimension, foreign_key, occurrence_key
from relweave.operators.joins import lookup
from relweave.operators.nested import (
    expand_struct, explode_array, explode_delimited, flag_dicts_to_columns,
)
from relweave.operators.reshape import others, pivot_max, series_mean, series_mode
from relweave.plans import vocabulary as V
from relweave.sources import inline_lookup

ADDRESS = ("address", "latitude", "longitude", "postal_code")
CITY = ("city", "state_code")


def demographics_by_city(demographics: DataFrame, groups: Sequence[str] | None = V.POPULATION_GROUPS) -> DataFrame:
    """One row per combination of the city measures, the population groups as columns."""
    rows = expand_struct(demographics, "fields").withColumn("race", slugify("race"))
    return pivot_max(rows, "race", "count", values=groups)


def cities(
    business: DataFrame,
    demographics: DataFrame,
    keys: str = "content",
    groups: Sequence[str] | None = V.POPULATION_GROUPS,
) -> DataFrame:
    """Cities of the businesses with their demographics where known."""
    named = extract_dimension(business.select("city", F.col("state").alias("state_code")), CITY, "city_id", keys)
    measures = demographics_by_city(demographics, groups)
    joined = lookup(named, measures, CITY, others(measures, *CITY))
    return joined.select(*others(joined, "city_id"), "city_id")


def _with_city_id(business: DataFrame, city_table: DataFrame | None, keys: str) -> DataFrame:
    located = business.withColumnRenamed("state", "state_code")
    if keys == "content":
        return located.withColumn("city_id", foreign_key(CITY))
    # demographics may repeat a city, its key does not
    return lookup(located, city_table.select(*CITY, "city_id").distinct(), CITY, ["city_id"])


def addresses(business: DataFrame, city_table: DataFrame | None = None, keys: str = "content") -> DataFrame:
    """Distinct addresses, each in its city. ``city_table`` is needed for dense keys only."""
    located = _with_city_id(business.select(*ADDRESS, "city", "state"), city_table, keys)
    return extract_dimension(located, [*ADDRESS, "city_id"], "address_id", keys)


def businesses(
    business: DataFrame,
    address_table: DataFrame | None = None,
    city_table: DataFrame | None = None,
    keys: str = "content",
    match: str = "full",
    null_safe: bool = False,
) -> DataFrame:
    """Business facts with the key of their address.

    ``match='full'`` identifies the address by all its columns including the city, so one business stays
    one row. ``match='loose'`` joins on the four address columns only and
    repeats a business whose address text exists in several cities. A NULL in one of the four columns
    matches nothing unless ``null_safe``.
    """
    facts = ("business_id", "address_id", F.col("is_open").cast("boolean").alias("is_open"), "name",
             "review_count", "stars")
    needed = business.select("business_id", *ADDRESS, "city", "state", "is_open", "name", "review_count", "stars")
    if match == "loose":
        return lookup(needed, address_table, ADDRESS, ["address_id"], null_safe=null_safe).select(*facts)
    if match != "full":
        raise ValueError(f"match is 'full' or 'loose', not {match!r}")
    located = _with_city_id(needed, city_table, keys)
    if keys == "content":
        key = content_key(*ADDRESS, "city_id")
        if not null_safe:
            key = F.when(foreign_key(ADDRESS).isNotNull(), key)
        return located.withColumn("address_id", key).select(*facts)
    matched = _key_text(located, null_safe)
    # both sides meet on one never ambiguous text, in which a NULL city equals a NULL city
    keyed = _key_text(address_table, True).select("_match", "address_id")
    return lookup(matched, keyed, ["_match"], ["address_id"]).select(*facts)


def _key_text(df: DataFrame, null_safe: bool) -> DataFrame:
    key = content_key(*ADDRESS, "city_id")
    if not null_safe:
        key = F.when(foreign_key(ADDRESS).isNotNull(), key)
    return df.withColumn("_match", key)


def business_attributes(
    business: DataFrame, flag_keys: Mapping[str, Sequence[str] | None] = V.FLAG_ATTRIBUTES
) -> DataFrame:
    """Every attribute in its own typed column; dictionaries become one flag per key."""
    raw = expand_struct(business, "attributes", ["business_id"])
    cleaners = {name: clean_bool for name in V.BOOLEAN_ATTRIBUTES}
    cleaners |= {name: clean_string for name in V.TEXT_ATTRIBUTES}
    cleaners |= {name: clean_int for name in V.INTEGER_ATTRIBUTES}
    typed = raw.select(*[cleaners[c](c).alias(c) if c in cleaners else F.col(c) for c in raw.columns])
    return flag_dicts_to_columns(typed, {c: k for c, k in flag_keys.items() if c in typed.columns})


def category_list(col: Column | str = "categories") -> Column:
    return split_list(col, V.PROTECTED_CATEGORIES)


def categories(business: DataFrame, keys: str = "content") -> DataFrame:
    """Category names and their keys."""
    names = explode_array(business, category_list(), "category", [])
    return extract_dimension(names, ["category"], "category_id", keys)


def business_categories(business: DataFrame, category_table: DataFrame | None = None, keys: str = "content") -> DataFrame:
    """Which business is in which category."""
    pairs = explode_array(business, F.array_distinct(category_list()), "category", ["business_id"])
    if keys == "content":
        return pairs.distinct().select("business_id", foreign_key(["category"]).alias("category_id"))
    return bridge_table(pairs, category_table, "category", "category_id")


def business_hours(business: DataFrame) -> DataFrame:
    """Opening hours as two integers per weekday."""
    raw = expand_struct(business, "hours", ["business_id"])
    days = [d for d in V.DAYS if d in raw.columns]
    clocks = [clock_of(day, side).alias(f"{day}_{side}") for day in days for side in ("from", "to")]
    return raw.select("business_id", *clocks)


def reviews(review: DataFrame) -> DataFrame:
    return review.withColumnRenamed("date", "ts").withColumn("ts", parse_timestamp("ts"))


def users(user: DataFrame) -> DataFrame:
    return user.drop("elite", "friends").withColumn("yelping_since", parse_timestamp("yelping_since"))


def elite_years(user: DataFrame, distinct: str | None = None) -> DataFrame:
    rows = explode_delimited(user, "elite", "year", ["user_id"], ",", distinct=distinct)
    return rows.select("user_id", text_to("year", "int").alias("year"))


def friends(user: DataFrame, user_is_unique: bool = False, null_tokens: Sequence[str] = ("",)) -> DataFrame:
    """Edges of the friendship graph. When each user is one row, repeats are dropped without a shuffle."""
    return explode_delimited(
        user, "friends", "friend_id", ["user_id"], ", ", null_tokens, "row" if user_is_unique else "global"
    )


def checkins(checkin: DataFrame, distinct: str | None = None) -> DataFrame:
    rows = explode_delimited(checkin, "date", "ts", ["business_id"], ", ", distinct=distinct)
    return rows.withColumn("ts", parse_timestamp("ts"))


def tips(tip: DataFrame) -> DataFrame:
    """Tips have no natural key; equal tips get different keys by their number of occurrence."""
    return occurrence_key(tip.withColumnRenamed("date", "ts").withColumn("ts", parse_timestamp("ts")), "tip_id")


def photos(photo: DataFrame) -> DataFrame:
    return photo


LOOKUP_SCHEMA = T.StructType([T.StructField("city", T.StringType()), T.StructField("state_code", T.StringType())])


def city_weather(
    spark: SparkSession,
    city_table: DataFrame,
    city_attributes: DataFrame,
    temperature: DataFrame,
    description: DataFrame,
    states: Sequence[tuple[str, str]] = V.WEATHER_CITIES,
    country: str = V.WEATHER_COUNTRY,
    ignore_nulls: bool = True,
    scale: int | None = None,
) -> DataFrame:
    """Daily mean temperature and most frequent description per known city.

    Only the series of cities in ``states`` are read from the wide files: the others would be dropped
    by the joins at the end.
    """
    wanted = [city for city, _ in states if city in temperature.columns and city in description.columns]
    if not wanted:
        raise ValueError("none of the cities is a column of both weather files")
    day = day_text("datetime").alias("date")
    readings = temperature.select(day, *[text_to(F.col(f"`{c}`"), "double").alias(c) for c in wanted])
    words = description.select(day, *[F.col(f"`{c}`") for c in wanted])
    mean = series_mean(readings, "date", wanted, "city", "avg_temperature", scale)
    mode = series_mode(words, "date", wanted, "city", "weather_description", ignore_nulls)

    in_country = distinct_rows(city_attributes.where(F.col("Country") == country).select(F.col("City").alias("city")))
    located = inline_lookup(spark, states, LOOKUP_SCHEMA).join(in_country, "city", "left_semi")
    known = city_table.select(*CITY, "city_id").join(located, list(CITY)).select("city", "city_id").distinct()
    return (
        mean.join(mode, ["city", "date"]).join(known, "city")
        .select(parse_date("date").alias("date"), "avg_temperature", "weather_description", "city_id")
    )
