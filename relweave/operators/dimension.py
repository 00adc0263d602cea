"""Surrogate keys, dimensions and bridge tables."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from relweave.functions.keys import content_key
from relweave.operators.joins import lookup
from relweave.session import materialise

# monotonically_increasing_id keeps the row position within a partition in the low 33 bits
POSITION_BITS = 33
REPEATS_PER_CHUNK = 100_000


def dense_key(df: DataFrame, order: Sequence[str], into: str) -> DataFrame:
    """Number the rows 1..n in the order of a unique key, without a single-task sort.

    A range-partitioned sort is written once; the position inside each partition plus the number of
    rows in the partitions before it is the key. The numbers depend on the data only, not on how many
    partitions there were.
    """
    placed = df.orderBy(*order).withColumn("_slot", F.monotonically_increasing_id())
    placed = materialise(placed, "dense-key").withColumn("_part", F.shiftright("_slot", POSITION_BITS))
    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_rows"))
    # one row per sort partition: this window and the broadcast are bounded by the partition count
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    position = F.col("_slot").bitwiseAND((1 << POSITION_BITS) - 1)
    numbered = placed.join(F.broadcast(starts), "_part")
    return numbered.select(*df.columns, (F.col("_start") + position + 1).alias(into))


def extend_keys(registry: DataFrame, names: DataFrame, order: Sequence[str], into: str) -> DataFrame:
    """``registry`` and the ``names`` it lacks, numbered on from its last key.

    Keys that were issued stay: only new names are sorted and numbered. NULL equals NULL, repeats count once.
    The result is the registry of the next call and should be stored.
    """
    known = registry.select(*[F.col(c).alias(f"_known_{c}") for c in order])
    same = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"_known_{c}")) for c in order])
    fresh = names.select(*order).distinct().join(known, same, "left_anti")
    last = registry.agg(F.coalesce(F.max(into), F.lit(0))).scalar()
    numbered = dense_key(fresh, order, into).withColumn(into, (F.col(into) + last).cast("long"))
    return registry.select(*order, into).unionByName(numbered)


def extract_dimension(
    df: DataFrame, columns: Sequence[str], into: str, style: str = "content"
) -> DataFrame:
    """Distinct value tuples with a surrogate key: an MD5 of the content, or 1..n in sorted order."""
    values = df.select(*columns).distinct()
    if style == "dense":
        return dense_key(values, columns, into)
    if style != "content":
        raise ValueError(f"key style is 'content' or 'dense', not {style!r}")
    return values.withColumn(into, content_key(*columns))


def bridge_table(pairs: DataFrame, dim: DataFrame, value: str, key: str) -> DataFrame:
    """Distinct pairs with the natural value swapped for the key of its dimension."""
    return lookup(pairs.distinct(), dim, [value], [key]).drop(value)


def occurrence_key(df: DataFrame, into: str, chunk: int = REPEATS_PER_CHUNK) -> DataFrame:
    """Key for rows without a natural key: MD5 of the content and of the number of its occurrence.

    Equal rows are counted (combining map-side) and written out again with numbers 1..n, so a row that
    occurs very often neither meets in one task nor fills one array: its numbers are produced in chunks
    on many tasks.
    """
    columns = df.columns
    counted = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("_n"))
    few = counted.where(F.col("_n") <= chunk).withColumn("_k", F.explode(F.sequence(F.lit(1), F.col("_n"))))
    chunks = F.sequence(F.lit(0), F.expr(f"(_n - 1) div {chunk}"))
    first = F.col("_chunk") * chunk + 1
    many = (
        counted.where(F.col("_n") > chunk)
        .withColumn("_chunk", F.explode(chunks))
        .repartition(F.col("_chunk"), F.xxhash64(*columns))
        .withColumn("_k", F.explode(F.sequence(first, F.least(first + (chunk - 1), F.col("_n")))))
    )
    numbered = few.select(*columns, "_k").unionByName(many.select(*columns, "_k"))
    return numbered.select(*columns, content_key(*columns, "_k").alias(into))


def foreign_key(cols: Sequence[Column | str]) -> Column:
    """Content key of the referenced row, computed in place instead of looked up by a join."""
    return content_key(*cols, null_if_any_null=True)
