"""Run a query on Spark and its SQL on DuckDB and compare columns, types and the bag of rows."""

from __future__ import annotations

from collections import Counter

import duckdb

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


def connect(folder: str):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return connection


def arrow_rows(table) -> Counter:
    names = sorted(table.column_names)
    columns = [table.column(n).to_pylist() for n in names]
    return Counter(zip(*columns))


def type_names(table) -> dict[str, str]:
    return {f.name: str(f.type).replace("large_", "") for f in table.schema}


def differences(df, connection, sql: str) -> list[str]:
    ours = df.toArrow()
    theirs = connection.sql(sql).to_arrow_table()
    found = []
    if sorted(ours.column_names) != sorted(theirs.column_names):
        return [f"columns {sorted(ours.column_names)} != {sorted(theirs.column_names)}"]
    a, b = type_names(ours), type_names(theirs)
    found += [f"type of {n}: {a[n]} != {b[n]}" for n in sorted(a) if a[n] != b[n]]
    if ours.num_rows != theirs.num_rows:
        found.append(f"rows {ours.num_rows} != {theirs.num_rows}")
    left, right = arrow_rows(ours), arrow_rows(theirs)
    if left != right:
        found.append(f"only here {list((left - right).items())[:3]}, only there {list((right - left).items())[:3]}")
    if not ours.num_rows:
        found.append("no rows")
    return found
