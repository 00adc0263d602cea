"""Time the registered queries and the whole table build; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from relweave.gallery import QUERIES, Tables, shapes  # noqa: E402
from relweave.plans.pipeline import build_tables  # noqa: E402
from relweave.session import build_session, scratch_path  # noqa: E402
from relweave.sources import write_csv, write_json  # noqa: E402

RUNS = int(os.environ.get("BENCH_RUNS", "2"))


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def best_of(action) -> float:
    action()  # code generation and file listing are warm in the timed runs
    times = []
    for _ in range(RUNS):
        start = time.perf_counter()
        action()
        times.append(time.perf_counter() - start)
    return round(min(times), 4)


def source_files(tables: Tables) -> dict[str, str]:
    """The source documents of the model as files, derived from the tables (not timed)."""
    documents = {
        "business": shapes.business, "review": shapes.review, "user": shapes.user, "checkin": shapes.checkin,
        "tip": shapes.tip, "photo": shapes.photo, "demographics": shapes.demographics,
    }
    paths = {}
    cities = dict(zip(shapes.SERIES, ("Phoenix", "Dallas", "Seattle", "Denver", "Boston")))
    for name, make in documents.items():
        paths[name] = scratch_path(tables.spark, name)
        frame = make(tables)
        if name == "business":  # some of the businesses are in the cities with weather
            frame = frame.withColumn("city", F.regexp_replace("city", "^NATION_1$", "Phoenix"))
            frame = frame.withColumn("state", F.when(F.col("city") == "Phoenix", "AZ").otherwise(F.col("state")))
        write_json(frame, paths[name], n_files=8)
    named = {"temperature": shapes.hourly(tables), "weather_description": shapes.hourly_words(tables)}
    for name, wide in named.items():
        paths[name] = scratch_path(tables.spark, name)
        write_csv(wide.withColumnsRenamed(cities), paths[name], sep=",")
    paths["city_attributes"] = scratch_path(tables.spark, "city_attributes")
    rows = [(c, "United States") for c in cities.values()]
    write_csv(tables.spark.createDataFrame(rows, "City string, Country string"), paths["city_attributes"], sep=",")
    return paths


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    scratch = tempfile.TemporaryDirectory(prefix="relweave-bench-")
    spark = build_session(
        "bench", f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory="12g",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__sql__warehouse__dir=os.path.join(scratch.name, "warehouse"),
    )
    spark.sparkContext.setLogLevel("ERROR")
    tables = Tables(spark, folder)
    only = set(filter(None, os.environ.get("BENCH_QUERIES", "").split(",")))
    names = [n for n in QUERIES if not only or n in only]
    seconds = {name: best_of(lambda: run(QUERIES[name].run(tables))) for name in names}
    result = {
        "metric": "total_query_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(folder.rstrip("/")), "cpus": int(cpus),
        "settings": {
            "spark": spark.version, "shuffle_partitions": int(cpus), "driver_memory": "12g", "warm_runs": 1, "best_of": RUNS,
        },
    }
    if not only:
        paths = source_files(tables)
        build_tables(spark, paths, scratch_path(spark, "build"))
        start = time.perf_counter()
        built = build_tables(spark, paths, scratch_path(spark, "build"))
        elapsed = time.perf_counter() - start
        rows = sum(t.count() for t in built.values())
        result["build"] = {
            "seconds": round(elapsed, 3), "output_rows": rows, "output_rows_per_sec": round(rows / elapsed),
        }
    spark.stop()
    scratch.cleanup()
    print(json.dumps(result))


if __name__ == "__main__":
    main()
