"""Declared schemas: the source documents and the fifteen target tables."""

from __future__ import annotations

from pyspark.sql import types as T

from relweave.operators.nested import column_name_for
from relweave.operators.spec import ForeignKey, TableSpec
from relweave.plans import vocabulary as V

ATTRIBUTE_NAMES = sorted([*V.BOOLEAN_ATTRIBUTES, *V.TEXT_ATTRIBUTES, *V.INTEGER_ATTRIBUTES, *V.FLAG_ATTRIBUTES])

# Counters every user document carries beside its own ones (fixed values).
COMPLIMENTS = ("cool", "cute", "funny", "hot", "list", "more", "note", "photos", "plain", "profile", "writer")


def _texts(names) -> str:
    return "struct<" + ",".join(f"{n}:string" for n in names) + ">"


SOURCES: dict[str, str] = {
    "business": (
        "business_id string, name string, address string, city string, state string, postal_code string, "
        "latitude double, longitude double, stars double, review_count bigint, is_open bigint, "
        f"categories string, attributes {_texts(ATTRIBUTE_NAMES)}, hours {_texts(V.DAYS)}"
    ),
    "review": (
        "review_id string, user_id string, business_id string, stars double, date string, text string, "
        "useful bigint, funny bigint, cool bigint"
    ),
    "user": (
        "user_id string, name string, yelping_since string, elite string, friends string, "
        "average_stars double, review_count bigint, fans bigint, useful bigint, funny bigint, cool bigint, "
        + ", ".join(f"compliment_{c} bigint" for c in COMPLIMENTS)
    ),
    "checkin": "business_id string, date string",
    "tip": "user_id string, business_id string, text string, date string, compliment_count bigint",
    "photo": "photo_id string, business_id string, caption string, label string",
    "demographics": (
        "fields struct<city:string, state:string, state_code:string, race:string, count:bigint, "
        "median_age:double, average_household_size:double, total_population:bigint, male_population:bigint, "
        "female_population:bigint, number_of_veterans:bigint, foreign_born:bigint>"
    ),
}

KEY_TYPES = {"content": "varchar(32)", "dense": "bigint"}


def source_schema(name: str) -> T.StructType:
    return T.StructType.fromDDL(SOURCES[name])


def target_specs(keys: str = "content") -> dict[str, TableSpec]:
    """The fifteen tables. ``keys`` names the style of the generated keys: content hash or 1..n."""
    key = KEY_TYPES[keys]
    row_key = KEY_TYPES["content"]
    specs: dict[str, TableSpec] = {}

    def table(name: str, columns: str, pk: str, refs: dict[str, str] | None = None) -> None:
        fks = tuple(ForeignKey(c, r, "user_id" if r == "users" else c) for c, r in (refs or {}).items())
        specs[name] = TableSpec.of(name, columns, primary_key=tuple(pk.split()), foreign_keys=fks)

    business = {"business_id": "businesses"}
    user = {"user_id": "users"}
    flags = [
        f"{column_name_for(a, k)} boolean" for a, names in V.FLAG_ATTRIBUTES.items() for k in names
    ]
    plain = {a: "boolean" for a in V.BOOLEAN_ATTRIBUTES}
    plain |= {a: f"varchar({n})" for a, n in V.TEXT_ATTRIBUTES.items()}
    plain |= {a: "integer" for a in V.INTEGER_ATTRIBUTES}

    table("businesses", f"business_id varchar(22), address_id {key}, is_open boolean, name varchar(256), "
          "review_count bigint, stars float", "business_id", {"address_id": "addresses"})
    table("business_attributes", ", ".join(["business_id varchar(22)", *[f"{a} {plain[a]}" for a in sorted(plain)], *flags]),
          "business_id", business)
    table("categories", f"category varchar(35), category_id {key}", "category_id")
    table("business_categories", f"business_id varchar(22), category_id {key}", "business_id category_id",
          business | {"category_id": "categories"})
    table("addresses", "address varchar(256), latitude float, longitude float, postal_code varchar(8), "
          f"city_id {key}, address_id {key}", "address_id", {"city_id": "cities"})
    table("cities", ", ".join(["city varchar(50)", "state_code varchar(3)", *_city_columns(), f"city_id {key}"]),
          "city_id")
    table("city_weather", f"date date, avg_temperature float, weather_description varchar(23), city_id {key}",
          "city_id date", {"city_id": "cities"})
    table("business_hours", ", ".join(["business_id varchar(22)", *[f"{d}_{s} int" for d in V.DAYS for s in ("from", "to")]]),
          "business_id", business)
    table("users", ", ".join(["average_stars float", *[f"compliment_{c} bigint" for c in COMPLIMENTS],
          "cool bigint", "fans bigint", "funny bigint", "name varchar(256)", "review_count bigint",
          "useful bigint", "user_id varchar(22)", "yelping_since timestamp"]), "user_id")
    table("elite_years", "user_id varchar(22), year int", "user_id year", user)
    table("friends", "user_id varchar(22), friend_id varchar(22)", "user_id friend_id",
          user | {"friend_id": "users"})
    table("reviews", "business_id varchar(22), cool bigint, ts timestamp, funny bigint, review_id varchar(22), "
          "stars float, text varchar(20000), useful bigint, user_id varchar(22)", "review_id", business | user)
    table("checkins", "business_id varchar(22), ts timestamp", "business_id ts", business)
    table("tips", "business_id varchar(22), compliment_count bigint, ts timestamp, text varchar(2000), "
          f"user_id varchar(22), tip_id {row_key}", "tip_id", business | user)
    table("photos", "business_id varchar(22), caption varchar(560), label varchar(7), photo_id varchar(22)",
          "photo_id", business)
    return specs


def _city_columns() -> list[str]:
    measures: dict[str, str] = {g: "bigint" for g in V.POPULATION_GROUPS}
    measures |= {
        "average_household_size": "float", "female_population": "bigint", "foreign_born": "bigint",
        "male_population": "bigint", "median_age": "float", "number_of_veterans": "bigint",
        "state": "varchar(14)", "total_population": "bigint",
    }
    return [f"{name} {measures[name]}" for name in sorted(measures)]


