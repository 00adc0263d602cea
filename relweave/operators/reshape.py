"""Long to wide, wide to long, and daily summaries of wide hourly series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relweave.operators.aggregate import mean, mode_per_group
from relweave.operators.nested import quoted


def others(df: DataFrame, *excluded: str) -> list[str]:
    """All column names but the excluded ones, in the order of the frame."""
    return [c for c in df.columns if c not in excluded]


def sorted_columns(df: DataFrame) -> DataFrame:
    return df.select(*sorted(df.columns))


def pivot_max(
    df: DataFrame,
    key: str,
    value: str,
    by: Sequence[str] | None = None,
    values: Sequence[str] | None = None,
) -> DataFrame:
    """One column per key holding the largest value; groups by all other columns unless told.

    Columns come out in name order. Declared ``values`` keep the call lazy; without them Spark finds all
    of them in the data.
    """
    by = others(df, key, value) if by is None else list(by)
    given = df if values is not None else df.where(quoted(key).isNotNull())
    pivoted = given.groupBy(*map(quoted, by)).pivot(key, None if values is None else list(values))
    return sorted_columns(pivoted.agg(F.max(quoted(value))))


def unpivot(
    df: DataFrame, ids: Sequence[str], columns: Sequence[str], name: str, value: str, keep_nulls: bool = True
) -> DataFrame:
    """Columns to rows in a single scan."""
    long = df.unpivot(list(map(quoted, ids)), list(map(quoted, columns)), name, value)
    return long if keep_nulls else long.where(F.col(value).isNotNull())


def series_mean(
    df: DataFrame, day: str, columns: Sequence[str], name: str, value: str, scale: int | None = None
) -> DataFrame:
    """Daily mean of each series as rows ``(day, name, value)``; NULL readings are skipped.

    One plan at every width: columns become rows in the scan, and the rows of a day and series combine
    map-side, so one row for each of them and task is shuffled.
    """
    long = unpivot(df.select(quoted(day), *map(quoted, columns)), [day], list(columns), name, value)
    return long.groupBy(day, name).agg(mean(value, scale).alias(value))


def series_mode(
    df: DataFrame, day: str, columns: Sequence[str], name: str, value: str, ignore_nulls: bool = True
) -> DataFrame:
    """Most frequent daily value of each series as rows ``(day, name, value)``."""
    long = unpivot(df.select(quoted(day), *map(quoted, columns)), [day], list(columns), name, value)
    return mode_per_group(long, [day, name], value, ignore_nulls=ignore_nulls)
