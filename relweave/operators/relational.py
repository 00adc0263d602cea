"""Projections, filters and set operations by name."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def project(df: DataFrame, columns: Sequence[str], rename: Mapping[str, str] | None = None) -> DataFrame:
    """Select and rename in one step."""
    rename = rename or {}
    return df.select(*[F.col(c).alias(rename.get(c, c)) for c in columns])


def project_prefix(df: DataFrame, prefix: str, keep: Sequence[str] = ()) -> DataFrame:
    """``keep`` columns and all whose name starts with ``prefix``."""
    return df.select(*keep, *[c for c in df.columns if c.startswith(prefix) and c not in keep])


def filter_equal(df: DataFrame, values: Mapping[str, object], not_null: Sequence[str] = ()) -> DataFrame:
    """Rows where every column equals its value and the ``not_null`` columns hold something."""
    conditions = [F.col(c) == F.lit(v) for c, v in values.items()]
    conditions += [F.col(c).isNotNull() for c in not_null]
    return df.where(reduce(Column.__and__, conditions, F.lit(True)))


def filter_member(df: DataFrame, column: str, values: Sequence | DataFrame) -> DataFrame:
    """Rows whose column is among the values: a literal list is pushed to the scan, a frame of one
    column becomes a semi join."""
    if isinstance(values, DataFrame):
        members = values.select(F.col(values.columns[0]).alias(column))
        return df.join(members, column, "left_semi")
    return df.where(F.col(column).isin(list(values)))


def union_tagged(frames: Mapping[str, DataFrame], tag: str) -> DataFrame:
    """Bag union of frames, each marked with its name."""
    tagged = [frame.withColumn(tag, F.lit(name)) for name, frame in frames.items()]
    return reduce(lambda a, b: a.unionByName(b), tagged)


def missing_columns(df: DataFrame, wanted: Sequence[str]) -> list[str]:
    """Wanted names the frame lacks, in the given order."""
    return [c for c in wanted if c not in df.columns]


def union_fill(target: DataFrame, source: DataFrame) -> DataFrame:
    """Append ``source``; columns known to only one side are NULL on the other."""
    return target.unionByName(source, allowMissingColumns=True)


def open_at(df: DataFrame, start: str, end: str, at: int) -> DataFrame:
    """Rows whose ``[start, end)`` contains ``at``, taken literally."""
    return df.where((F.col(start) <= at) & (F.col(end) > at))


DAYS = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")


def open_on(df: DataFrame, day: str, at: int) -> DataFrame:
    """Rows open on ``day`` at clock time ``at``, counting hours that run past midnight.

    ``to <= from`` means the range wraps: it covers the rest of its own day and the start of the next.
    """
    before = DAYS[DAYS.index(day) - 1]
    start, end = F.col(f"{day}_from"), F.col(f"{day}_to")
    same_day = (start <= at) & ((end > at) | (end <= start))
    spill = (F.col(f"{before}_to") <= F.col(f"{before}_from")) & (F.col(f"{before}_to") > at)
    return df.where(F.coalesce(same_day, F.lit(False)) | F.coalesce(spill, F.lit(False)))
