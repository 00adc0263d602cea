"""Grouping, distinct, top-k and candidate keys.

Every grouping combines map-side first, so a key that holds most of the rows arrives at its reducer
as one partial row per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from relweave.functions.values import as_column


def mean(col: Column | str, scale: int | None = None) -> Column:
    """Mean skipping NULLs. With ``scale`` the sum is exact decimal arithmetic on that many digits,
    so the result does not depend on how the rows were partitioned."""
    c = as_column(col)
    if scale is None:
        return F.mean(c)
    return exact_sum(c, scale) / F.count(c)


def exact_sum(col: Column | str, scale: int = 2) -> Column:
    """Sum in decimal arithmetic, as double. Values are rounded to ``scale`` digits first, two unless told otherwise."""
    return F.sum(as_column(col).cast(f"decimal(18,{scale})")).cast("double")


def group_mean(df: DataFrame, by: Sequence[str], value: str, into: str, scale: int | None = None) -> DataFrame:
    return df.groupBy(*by).agg(mean(value, scale).alias(into))


def group_count(df: DataFrame, by: Sequence[str], into: str = "count") -> DataFrame:
    """Rows per group; NULL is a group of its own."""
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias(into))


def mean_state(df: DataFrame, by: Sequence[str], value: str, scale: int = 2) -> DataFrame:
    """``by``, exact ``total`` and ``n`` of the values: what is kept of rows to bring their mean up to date."""
    total = F.sum(as_column(value).cast(f"decimal(18,{scale})")).cast(f"decimal(38,{scale})")
    return df.groupBy(*by).agg(total.alias("total"), F.count(value).alias("n"))


def merge_means(state: DataFrame, delta: DataFrame, by: Sequence[str], value: str, scale: int = 2) -> DataFrame:
    """The state of old and new rows together, from the old state and the new rows only.

    Decimal sums are exact, so it equals the state made from all rows, in whatever parts they came. Rows of
    ``delta`` must be new; :func:`relweave.operators.load.load_table` applies a batch once.
    """
    both = state.unionByName(mean_state(delta, by, value, scale))
    return both.groupBy(*by).agg(F.sum("total").cast(f"decimal(38,{scale})").alias("total"), F.sum("n").alias("n"))


def means(state: DataFrame, into: str) -> DataFrame:
    """The mean per group of a state; NULL for a group without values."""
    mean_of = F.col("total").cast("double") / F.nullif("n", F.lit(0))
    return state.select(*[c for c in state.columns if c not in ("total", "n")], mean_of.alias(into), "n")


def mode_per_group(df: DataFrame, by: Sequence[str], value: str, ignore_nulls: bool = True) -> DataFrame:
    """Most frequent value per group; among equally frequent ones the smallest wins.

    A group of NULLs only yields NULL. With ``ignore_nulls=False`` NULL competes like a value and
    loses ties.
    """
    counted = group_count(df, [*by, value], "_n")
    is_null = F.col(value).isNull()
    rank = [(-F.col("_n")).alias("n"), is_null.alias("null"), F.col(value).alias("value")]
    if ignore_nulls:
        rank = [rank[1], rank[0], rank[2]]
    best = counted.groupBy(*by).agg(F.min(F.struct(*rank)).alias("_best"))
    return best.select(*by, F.col("_best.value").alias(value))


def top_k(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    """First ``k`` rows of the order; every task keeps only its own first ``k``."""
    return df.orderBy(*order).limit(k)


def top_k_per_group(df: DataFrame, by: Sequence[str], order: Sequence[Column], k: int, rank: str | None = None) -> DataFrame:
    """First ``k`` rows of each group; Spark drops lower ranks before the shuffle as well."""
    name = rank or "_rank"
    window = Window.partitionBy(*by).orderBy(*order)
    ranked = df.withColumn(name, F.row_number().over(window)).where(F.col(name) <= k)
    return ranked if rank else ranked.drop(name)


def candidate_key(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: number of keys, most rows under one key, and whether the columns are a key."""
    counted = group_count(df, columns, "_n")
    return counted.agg(
        F.count(F.lit(1)).alias("n_keys"),
        F.max("_n").alias("max_rows"),
        F.coalesce(F.max("_n") == 1, F.lit(True)).alias("is_key"),
    )


def collect_bag(df: DataFrame, by: Sequence[str], value: str, into: str) -> DataFrame:
    """All values of each group as a sorted array of ``(value, n)``.

    The multiset is kept whole, but a value that occurs a billion times is one item: the array grows
    with the number of different values, not with the rows of the group.
    """
    counted = group_count(df.where(F.col(value).isNotNull()), [*by, value], "n")
    items = F.collect_list(F.struct(F.col(value).alias("value"), F.col("n").alias("n")))
    return counted.groupBy(*by).agg(F.array_sort(items).alias(into))


def bag_to_list(col: Column | str) -> Column:
    """Plain sorted list with repeats; only for groups known to be small."""
    return F.flatten(F.transform(as_column(col), lambda x: F.array_repeat(x["value"], x["n"].cast("int"))))


def distinct_rows(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    return (df if columns is None else df.select(*columns)).distinct()


def first_row(df: DataFrame):
    """Any one row, or None; reads only as many partitions as it takes."""
    return df.first()
