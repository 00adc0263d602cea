"""Queries over the star-schema tables, each with the SQL that gives the same result."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Tables:
    """The Parquet tables of one folder, read on demand."""

    spark: SparkSession
    folder: str

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


@dataclass(frozen=True)
class Query:
    run: Callable[[Tables], DataFrame]
    sql: str | None


QUERIES: dict[str, Query] = {}


def query(sql: str | None = None, name: str | None = None):
    """Register a function of the tables under its name, with the equivalent SQL."""

    def register(run: Callable[[Tables], DataFrame]):
        key = name or run.__name__.lstrip("_")
        if key in QUERIES:
            raise ValueError(f"query {key} is registered twice")
        QUERIES[key] = Query(run, sql)
        return run

    return register
