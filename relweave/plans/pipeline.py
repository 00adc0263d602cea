"""The whole build: source files in, checked Parquet tables out."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

from relweave.functions import slugify
from relweave.operators.load import load_table
from relweave.operators.nested import expand_struct, undeclared_keys_in_text, undeclared_values
from relweave.operators.quality import ValueCheck, foreign_key_violations, primary_key_violations, run_checks
from relweave.operators.spec import TableSpec, conform, lay_out, load_order, load_steps, ready_steps
from relweave.plans import normalise as N
from relweave.plans import vocabulary as V
from relweave.plans.schemas import SOURCES, source_schema, target_specs
from relweave.sources import read_csv, read_parquet, stage_json, write_parquet

JOBS_AT_ONCE = 4
CSV_SOURCES = ("city_attributes", "temperature", "weather_description")


def read_sources(spark: SparkSession, paths: Mapping[str, str], staging: str, workers: int = JOBS_AT_ONCE) -> dict[str, DataFrame]:
    """Sources by name. JSON text is parsed once into Parquet: several tables read the same source."""

    def staged(name: str) -> DataFrame:
        return stage_json(spark, paths[name], source_schema(name), f"{staging}/{name}")

    with ThreadPoolExecutor(workers) as pool:
        sources = dict(zip(SOURCES, pool.map(inheritable_thread_target(spark)(staged), SOURCES)))
    return sources | {name: read_csv(spark, paths[name]) for name in CSV_SOURCES}


def builders(
    spark: SparkSession, sources: Mapping[str, DataFrame], tables: Mapping[str, DataFrame], keys: str = "content"
) -> dict[str, Callable[[], DataFrame]]:
    """How each table is made; ``tables`` holds the ones already written."""
    s = sources
    return {
        "cities": lambda: N.cities(s["business"], s["demographics"], keys),
        "addresses": lambda: N.addresses(s["business"], tables.get("cities"), keys),
        "businesses": lambda: N.businesses(s["business"], tables.get("addresses"), tables.get("cities"), keys),
        "business_attributes": lambda: N.business_attributes(s["business"]),
        "categories": lambda: N.categories(s["business"], keys),
        "business_categories": lambda: N.business_categories(s["business"], tables.get("categories"), keys),
        "business_hours": lambda: N.business_hours(s["business"]),
        "users": lambda: N.users(s["user"]),
        "elite_years": lambda: N.elite_years(s["user"]),
        "friends": lambda: N.friends(s["user"]),
        "reviews": lambda: N.reviews(s["review"]),
        "checkins": lambda: N.checkins(s["checkin"]),
        "tips": lambda: N.tips(s["tip"]),
        "photos": lambda: N.photos(s["photo"]),
        "city_weather": lambda: N.city_weather(
            spark, tables.get("cities"), s["city_attributes"], s["temperature"], s["weather_description"]
        ),
    }


def build_tables(
    spark: SparkSession,
    paths: Mapping[str, str],
    out: str,
    keys: str = "content",
    specs: Mapping[str, TableSpec] | None = None,
    workers: int = JOBS_AT_ONCE,
) -> dict[str, DataFrame]:
    """Build and write every table below ``out`` and read them back.

    Tables are built side by side, so that the last tasks of one do not leave the cluster idle. Only
    those that look something up in another table wait for it: with content keys that is the weather
    alone.
    """
    specs = specs or target_specs(keys)
    sources = read_sources(spark, paths, f"{out}/_sources", workers)
    tables: dict[str, DataFrame] = {}
    make = builders(spark, sources, tables, keys)

    def build(name: str) -> None:
        built = conform(make[name](), specs[name])
        write_parquet(lay_out(built, specs[name]), f"{out}/{name}")
        tables[name] = read_parquet(spark, f"{out}/{name}", specs[name].struct_type)

    for step in build_steps(specs, keys):
        with ThreadPoolExecutor(workers) as pool:
            list(pool.map(inheritable_thread_target(spark)(build), step))
    return {name: tables[name] for name in load_order(specs.values())}


# Tables that another one is looked up in while it is built.
LOOKUPS = {
    "content": {"city_weather": {"cities"}},
    "dense": {
        "city_weather": {"cities"}, "addresses": {"cities"}, "businesses": {"addresses", "cities"},
        "business_categories": {"categories"},
    },
}


def build_steps(names: Iterable[str], keys: str = "content") -> list[list[str]]:
    """Tables in groups that can be built side by side."""
    names = set(names)
    return ready_steps({n: LOOKUPS[keys].get(n, set()) & names for n in sorted(names)})


def load_tables(
    spark: SparkSession,
    tables: Mapping[str, DataFrame],
    specs: Mapping[str, TableSpec],
    root: str,
    mode: str = "rebuild",
    database: str = "default",
    workers: int = JOBS_AT_ONCE,
) -> dict[str, DataFrame]:
    """Load built tables into the catalog, referenced tables first, tables that do not refer to each other side by side."""
    loaded: dict[str, DataFrame] = {}

    def load(name: str) -> None:
        loaded[name] = load_table(spark, tables[name], specs[name], f"{database}.{name}", f"{root}/{name}", mode)

    for step in load_steps(specs.values()):
        with ThreadPoolExecutor(workers) as pool:
            list(pool.map(inheritable_thread_target(spark)(load), step))
    return {name: loaded[name] for name in load_order(specs.values())}


def count_checks(expected: Mapping[str, int]) -> list[ValueCheck]:
    """Exact row counts per table."""
    return [ValueCheck(f"check_{name}_count", name, n) for name, n in expected.items()]


def undeclared(sources: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """``key, n_rows`` of the dictionary keys and population groups of the sources that the wide tables have no column for."""
    results = {}
    if "business" in sources:
        attributes = expand_struct(sources["business"], "attributes")
        for name, keys in V.FLAG_ATTRIBUTES.items():
            if name in attributes.columns:
                results[f"business_attributes.{name}.undeclared"] = undeclared_keys_in_text(attributes, name, keys)
    if "demographics" in sources:
        races = expand_struct(sources["demographics"], "fields").select(slugify("race").alias("race"))
        results["cities.race.undeclared"] = undeclared_values(races, "race", V.POPULATION_GROUPS)
    return results


def check_tables(
    tables: Mapping[str, DataFrame], specs: Mapping[str, TableSpec], checks: Iterable[ValueCheck] = (),
    sources: Mapping[str, DataFrame] | None = None,
) -> dict[str, DataFrame]:
    """Lazy results: value checks, duplicate or NULL keys per table, and orphans per reference.

    With the ``sources`` that the tables were built from, also what no declared column holds.
    """
    results = undeclared(sources) if sources else {}
    checks = list(checks)
    if checks:
        results["values"] = run_checks(tables, checks)
    for name, spec in specs.items():
        if spec.primary_key:
            results[f"{name}.primary_key"] = primary_key_violations(tables[name], spec.primary_key)
        if spec.foreign_keys:
            results[f"{name}.foreign_keys"] = foreign_key_violations(tables, spec)
    return results
