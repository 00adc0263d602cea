"""The fifteen tables from hand-written documents, end to end through files, with both key styles."""

import json
from datetime import date, datetime

import pytest

from relweave.operators.quality import primary_key_violations
from relweave.plans import analytics, normalise
from relweave.operators.spec import load_steps
from relweave.plans.pipeline import build_steps, build_tables, check_tables, count_checks, load_tables, undeclared
from relweave.plans.schemas import SOURCES, source_schema, target_specs
from relweave.plans.vocabulary import PROTECTED_CATEGORIES


def shop(i, **changes):
    base = {
        "business_id": f"b{i}", "name": f"Shop {i}", "address": "1 Main St", "city": "Phoenix", "state": "AZ", "postal_code": "85001",
        "latitude": 33.5, "longitude": -112.0, "stars": 4.5, "review_count": 10 + i, "is_open": 1, "categories": "Bars, Food",
        "attributes": {"BikeParking": "True", "WiFi": "u'free'", "RestaurantsPriceRange2": "2",
                       "Ambience": "{'romantic': False, 'casual': True}", "DietaryRestrictions": "{'dairy-free': True}"},
        "hours": {"Monday": "9:0-0:0", "Sunday": "10:00-21:00"},
    }
    return base | changes


BUSINESS = [
    shop(1),
    shop(2, categories=f"Legal, {PROTECTED_CATEGORIES[0]}, Bars", attributes=None, hours=None),
    shop(3, city="Tempe", is_open=0, categories=None),  # the same address text in another city
    shop(4, postal_code=None, categories="", attributes={"BikeParking": "None", "WiFi": "'no'", "Ambience": "None"}),
    shop(5, city="Boston", state="MA", address="9 Elm St", hours={"Friday": "18:0-2:0", "Saturday": "junk"}),
]
USERS = [
    {"user_id": "u1", "name": "Ann", "yelping_since": "2010-01-01 10:00:00", "elite": "2015,2016", "friends": "u2, u3, u2", "fans": 3},
    {"user_id": "u2", "name": "Bo", "yelping_since": "never", "elite": "", "friends": "None", "fans": 0},
    {"user_id": "u3", "name": "Cy", "yelping_since": "2012-05-06", "elite": None, "friends": None, "fans": None},
]
REVIEWS = [
    {"review_id": f"r{i}", "user_id": f"u{i % 3 + 1}", "business_id": f"b{b}", "stars": s, "date": d, "text": "ok", "useful": 0, "funny": 0, "cool": 1}
    for i, (b, s, d) in enumerate([(1, 5.0, "2012-10-01 12:00:00"), (1, 4.0, "2012-10-02 09:00:00"), (3, 1.0, "2012-10-01 10:00:00"),
                                   (5, 3.0, "2012-10-01 11:00:00"), (4, 2.0, "2012-10-01 11:00:00"), (2, 3.0, "2012-10-01 08:00:00")])
]
CHECKINS = [{"business_id": "b1", "date": "2012-10-01 12:00:00, 2012-10-02 13:00:00, 2012-10-01 12:00:00"}, {"business_id": "b2", "date": ""}]
TIPS = [{"user_id": "u1", "business_id": "b1", "text": "go", "date": "2012-10-01 12:00:00", "compliment_count": 0}] * 3 + [
    {"user_id": "u2", "business_id": "b1", "text": None, "date": "2012-10-01 12:00:00", "compliment_count": 0}]
PHOTOS = [{"photo_id": "p1", "business_id": "b1", "caption": "", "label": "food"}]


def people(city, state, race, count):
    return {"fields": {"city": city, "state": "Arizona", "state_code": state, "race": race, "count": count, "median_age": 33.0,
                       "total_population": 1000, "average_household_size": 2.5}}


DEMOGRAPHICS = [people("Phoenix", "AZ", "White", 700), people("Phoenix", "AZ", "Black or African-American", 200), people("Austin", "TX", "White", 5)]
ATTRIBUTES = "City,Country,Latitude\nPhoenix,United States,33\nBoston,United States,42\nToronto,Canada,43\n"
TEMPERATURE = "datetime,Phoenix,Boston,Toronto\n2012-10-01 12:00:00,300.5,,1\n2012-10-01 13:00:00,301.5,,2\n2012-10-02 12:00:00,290,280,3\n"
DESCRIPTION = ("datetime,Phoenix,Boston,Toronto\n2012-10-01 12:00:00,sunny,mist,x\n2012-10-01 13:00:00,clear,mist,x\n"
               "2012-10-02 12:00:00,,rain,x\n")


@pytest.fixture(scope="module")
def paths(tmp_path_factory):
    folder = tmp_path_factory.mktemp("sources")
    documents = {"business": BUSINESS, "review": REVIEWS, "user": USERS, "checkin": CHECKINS, "tip": TIPS, "photo": PHOTOS, "demographics": DEMOGRAPHICS}
    assert set(documents) == set(SOURCES)
    out = {}
    for name, items in documents.items():
        out[name] = str(folder / f"{name}.json")
        (folder / f"{name}.json").write_text("\n".join(map(json.dumps, items)))
    for name, text in (("city_attributes", ATTRIBUTES), ("temperature", TEMPERATURE), ("weather_description", DESCRIPTION)):
        out[name] = str(folder / f"{name}.csv")
        (folder / f"{name}.csv").write_text(text)
    return out


@pytest.fixture(scope="module", params=["content", "dense"])
def built(request, spark, paths, tmp_path_factory):
    return request.param, build_tables(spark, paths, str(tmp_path_factory.mktemp("out")), keys=request.param)


def by(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def test_every_table_has_its_declared_schema(built):
    keys, tables = built
    for name, spec in target_specs(keys).items():
        assert tables[name].schema == spec.struct_type, name


def test_cities(built):
    _, tables = built
    cities = tables["cities"]
    assert by(cities, "city", "state_code", "white", "black_or_african_american", "asian", "total_population", "state") == sorted(
        [("Boston", "MA", None, None, None, None, None), ("Phoenix", "AZ", 700, 200, None, 1000, "Arizona"), ("Tempe", "AZ", None, None, None, None, None)], key=repr)


def test_addresses_and_businesses(built):
    keys, tables = built
    assert tables["addresses"].count() == 4  # Main St in two cities, Main St without code, Elm St
    joined = tables["businesses"].join(tables["addresses"], "address_id", "left").join(tables["cities"], "city_id", "left")
    assert by(joined, "business_id", "city", "is_open", "review_count") == [
        ("b1", "Phoenix", True, 11), ("b2", "Phoenix", True, 12), ("b3", "Tempe", False, 13), ("b4", None, True, 14), ("b5", "Boston", True, 15)]
    if keys == "dense":
        assert by(tables["cities"], "city_id", "city") == [(1, "Boston"), (2, "Phoenix"), (3, "Tempe")]


def test_null_safe_and_loose_matching(spark, paths):
    docs = spark.read.schema(source_schema("business")).json(paths["business"])
    addresses = normalise.addresses(docs)
    safe = normalise.businesses(docs, null_safe=True)
    assert safe.join(addresses, "address_id").count() == 5
    loose = normalise.businesses(docs, addresses, match="loose")
    assert loose.count() == 5 + 3  # b1, b2 and b3 match the address text of both cities
    assert primary_key_violations(loose, ["business_id"]).count() == 3
    with pytest.raises(ValueError):
        normalise.businesses(docs, match="fuzzy")


def test_attributes(built):
    _, tables = built
    columns = ["business_id", "BikeParking", "WiFi", "RestaurantsPriceRange2", "Ambience_romantic", "Ambience_casual", "DietaryRestrictions_dairy_free", "Music_dj"]
    found = by(tables["business_attributes"], *columns)
    assert found[0] == ("b1", True, "free", 2, False, True, True, None)
    assert found[1] == ("b2", *[None] * 7)
    assert found[3] == ("b4", None, "no", *[None] * 5)
    assert len(tables["business_attributes"].columns) == 82


def test_categories(built):
    _, tables = built
    named = tables["business_categories"].join(tables["categories"], "category_id")
    assert by(named, "business_id", "category") == sorted(
        [("b1", "Bars"), ("b1", "Food"), ("b2", PROTECTED_CATEGORIES[0]), ("b2", "Legal"), ("b2", "Bars"), ("b5", "Bars"), ("b5", "Food")], key=repr)


def test_hours(built):
    _, tables = built
    found = by(tables["business_hours"], "business_id", "Monday_from", "Monday_to", "Sunday_from", "Sunday_to", "Friday_from", "Friday_to", "Saturday_from")
    assert found[0] == ("b1", 900, 0, 1000, 2100, None, None, None)
    assert found[1] == ("b2", *[None] * 7)
    assert found[4] == ("b5", None, None, None, None, 1800, 200, None)


def test_users_elite_friends(built):
    _, tables = built
    assert by(tables["users"], "user_id", "yelping_since", "fans") == [
        ("u1", datetime(2010, 1, 1, 10), 3), ("u2", None, 0), ("u3", datetime(2012, 5, 6), None)]
    assert by(tables["elite_years"], "user_id", "year") == [("u1", 2015), ("u1", 2016)]
    assert by(tables["friends"], "user_id", "friend_id") == [("u1", "u2"), ("u1", "u3"), ("u2", "None")]


def test_options_of_the_list_tables(spark, paths):
    user = spark.read.schema(source_schema("user")).json(paths["user"])
    assert by(normalise.friends(user, user_is_unique=True, null_tokens=("", "None")), "friend_id") == [("u2",), ("u3",)]
    checkin = spark.read.schema(source_schema("checkin")).json(paths["checkin"])
    assert normalise.checkins(checkin, distinct="row").count() == 2


def test_facts(built):
    _, tables = built
    assert by(tables["checkins"], "business_id", "ts") == [
        ("b1", datetime(2012, 10, 1, 12)), ("b1", datetime(2012, 10, 1, 12)), ("b1", datetime(2012, 10, 2, 13))]
    assert tables["tips"].count() == 4 and tables["tips"].select("tip_id").distinct().count() == 4
    assert by(tables["reviews"], "review_id", "ts")[0] == ("r0", datetime(2012, 10, 1, 12))
    assert by(tables["photos"], "photo_id", "label") == [("p1", "food")]


def test_city_weather(built):
    _, tables = built
    named = tables["city_weather"].join(tables["cities"], "city_id")
    assert by(named, "city", "date", "avg_temperature", "weather_description") == [
        ("Boston", date(2012, 10, 1), None, "mist"), ("Boston", date(2012, 10, 2), 280.0, "rain"),
        ("Phoenix", date(2012, 10, 1), 301.0, "clear"), ("Phoenix", date(2012, 10, 2), 290.0, None)]


def test_weather_needs_a_known_city(spark):
    wide = spark.createDataFrame([("2012-10-01 12:00:00", "1")], "datetime string, Rome string")
    with pytest.raises(ValueError, match="none of the cities"):
        normalise.city_weather(spark, None, None, wide, wide)


def test_checks(built):
    keys, tables = built
    specs = target_specs(keys)
    counts = {name: table.count() for name, table in tables.items()}
    results = check_tables(tables, specs, count_checks(counts | {"photos": 2}))
    assert {r["table"] for r in results["values"].collect() if not r["passed"]} == {"photos"}
    duplicated = {name for name in specs if results[f"{name}.primary_key"].count()}
    assert duplicated == {"checkins"}  # the source repeats a check-in and the table keeps it
    orphaned = {
        (r["table"], r["column"]) for key, df in results.items() if key.endswith("foreign_keys") for r in df.collect() if r["n_rows"]
    }
    assert orphaned == {("friends", "friend_id")}  # the literal 'None'


def test_undeclared_groups_and_keys_are_counted(spark):
    race = "struct<city: string, state_code: string, race: string, count: int>"
    people = spark.createDataFrame([(("A", "X", "White", 1),), (("A", "X", "Other Group", 2),), (("B", "X", "Other Group", 3),)], f"fields {race}")
    parking = spark.createDataFrame([("b", ("{'lot': True, 'roof': False}",)), ("c", (None,))], "business_id string, attributes struct<BusinessParking: string>")
    found = {name: by(df, "key", "n_rows") for name, df in check_tables({}, {}, sources={"business": parking, "demographics": people}).items()}
    assert found == {"business_attributes.BusinessParking.undeclared": [("roof", 1)], "cities.race.undeclared": [("other_group", 2)]}
    assert undeclared({}) == {}


def test_questions(built):
    _, t = built
    stars = analytics.stars_by_city(t["reviews"], t["businesses"], t["addresses"], t["cities"])
    assert by(stars, "city", "avg_stars", "n_ratings") == [("Boston", 3.0, 1), ("Phoenix", 4.0, 3), ("Tempe", 1.0, 1)]
    pairs = analytics.ratings_and_population(t["reviews"], t["businesses"], t["addresses"], t["cities"])
    assert by(pairs, "n_ratings", "total_population") == [(3, 1000)]
    every = analytics.ratings_and_population(t["reviews"].limit(0), t["businesses"], t["addresses"], t["cities"], unrated=True)
    assert by(every, "n_ratings", "total_population") == [(0, 1000)]
    hot = analytics.popular_when_hot(t["reviews"], t["businesses"], t["addresses"], t["city_weather"], 295, 1)
    assert by(hot, "business_id", "n_reviews") == [("b1", 1)]
    args = (t["reviews"], t["businesses"], t["addresses"], t["city_weather"])
    plain = by(analytics.weather_at_review(*args), "review_id", "avg_temperature", "weather_description")
    assert plain == [("r0", 301.0, "clear"), ("r1", 290.0, None), ("r2", None, None), ("r3", None, "mist"), ("r4", None, None), ("r5", 301.0, "clear")]
    assert by(analytics.weather_at_review(*args, hot_share=0.01, salts=3), "review_id", "avg_temperature", "weather_description") == plain


def test_load_into_the_catalog(spark, built, fresh):
    keys, tables = built
    spark.sql("CREATE DATABASE IF NOT EXISTS model")
    loaded = load_tables(spark, tables, target_specs(keys), fresh("wh"), "rebuild", "model")
    assert {n: t.count() for n, t in loaded.items()} == {n: t.count() for n, t in tables.items()}
    spark.sql("DROP DATABASE model CASCADE")


def test_content_keys_do_not_depend_on_partitioning(spark, paths):
    docs = spark.read.schema(source_schema("business")).json(paths["business"])
    assert by(normalise.addresses(docs), "address_id") == by(normalise.addresses(docs.repartition(7)), "address_id")


def test_load_steps():
    specs = target_specs()
    done: set[str] = set()
    for step in load_steps(specs.values()):
        for name in step:
            assert {fk.ref_table for fk in specs[name].foreign_keys} - {name} <= done
        done |= set(step)
    assert done == set(specs) and len(load_steps(specs.values())) < 6


def test_build_steps():
    names = target_specs()
    assert [len(s) for s in build_steps(names)] == [14, 1]
    dense = build_steps(names, "dense")
    assert sum(map(len, dense)) == 15 and "businesses" in dense[2]


