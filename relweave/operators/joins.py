"""Equi-joins and the operators built on them.

Spark broadcasts a side whose size statistics are below ``spark.sql.autoBroadcastJoinThreshold``, and AQE
revises the choice with the sizes it has measured. :func:`broadcast_within` covers the one case where the
statistics mislead; nothing else carries a broadcast hint.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


# joins whose result never holds a row of the dimension without a partner
SALTED_JOINS = ("left", "inner", "left_semi", "left_anti")


def lookup(
    df: DataFrame,
    dim: DataFrame,
    on: Mapping[str, str] | Sequence[str],
    take: Sequence[str],
    how: str = "left",
    null_safe: bool = False,
) -> DataFrame:
    """Bring the ``take`` columns of ``dim`` to ``df``; the columns of ``dim`` used as key are dropped.

    ``on`` maps columns of ``df`` to columns of ``dim``. Under plain equality a NULL key matches
    nothing; ``null_safe`` lets NULL match NULL.
    """
    pairs = on if isinstance(on, Mapping) else {c: c for c in on}
    clash = set(take) & set(df.columns)
    if clash:
        raise ValueError(f"columns exist on both sides: {sorted(clash)}")
    right = dim.select(*[F.col(r).alias(f"_key_{r}") for r in pairs.values()], *take)
    tests = []
    for left_name, right_name in pairs.items():
        left_col, right_col = F.col(left_name), F.col(f"_key_{right_name}")
        tests.append(left_col.eqNullSafe(right_col) if null_safe else left_col == right_col)
    joined = df.join(right, reduce(Column.__and__, tests), how)
    return joined.drop(*[f"_key_{r}" for r in pairs.values()])


def broadcast_within(df: DataFrame, bound: DataFrame) -> DataFrame:
    """Hint a broadcast of ``df`` when ``bound``, which it cannot exceed, is below Spark's own threshold.

    Spark estimates a join as the product of its inputs. A small dimension made by a join therefore looks
    huge, and the fact table would be shuffled before AQE finds out. Beyond the threshold ``df`` comes
    back as it is and Spark decides.
    """
    plan = bound._jdf.queryExecution().optimizedPlan()
    size = int(str(plan.stats().sizeInBytes()))
    limit = df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return F.broadcast(df) if size <= limit else df


def salted_lookup(
    df: DataFrame, dim: DataFrame, on: Sequence[str], take: Sequence[str], hot_share: float, salts: int, how: str = "left"
) -> DataFrame:
    """:func:`lookup` for a side with hot keys, where neither side can be broadcast.

    Keys with more than ``hot_share`` of the rows of ``df`` are spread over ``salts`` tasks and only their
    rows of ``dim`` are repeated, so the cost of salting does not touch the ordinary keys. There are at
    most ``1 / hot_share`` such keys, so their list is broadcast and the only shuffle of ``df`` is the one
    by key and salt. NULL keys match nothing and are spread as well. The salt comes from the row's content
    and its partition: equal rows of different partitions part, and a task that runs again sends each row
    to the same place. Costs one extra pass over the key columns of ``df``. A repeated row of ``dim``
    without a partner would come out once for each salt, so joins that keep those are refused.
    """
    if how not in SALTED_JOINS:
        raise ValueError(f"a salted lookup is one of {SALTED_JOINS}, not {how!r}")
    if not 0 < hot_share <= 1:
        raise ValueError("hot_share is a share of the rows, above 0")
    on = list(on)
    present = reduce(Column.__and__, [F.col(c).isNotNull() for c in on])
    per_key = df.where(present).groupBy(*on).agg(F.count(F.lit(1)).alias("_n"))
    bound = per_key.agg(F.sum("_n") * hot_share).scalar()
    hot = per_key.where(F.col("_n") > bound).select(*on, F.lit(salts).alias("_salts"))
    hot = F.broadcast(hot)
    columns = [F.col("`" + c.replace("`", "``") + "`") for c in df.columns]
    spread = F.pmod(F.xxhash64(*columns) + F.spark_partition_id(), F.lit(salts)).cast("int")
    left = df.join(hot, on, "left").withColumn(
        "_salt", F.when(F.col("_salts").isNotNull() | ~present, spread).otherwise(F.lit(0))
    ).drop("_salts")
    copies = F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1)
    right = dim.select(*on, *take).join(hot, on, "left").withColumn("_salt", F.explode(copies)).drop("_salts")
    return left.join(right, [*on, "_salt"], how).drop("_salt")


def orphans(child: DataFrame, parent: DataFrame, on: Mapping[str, str]) -> DataFrame:
    """Foreign key values without a parent and the number of rows that hold them.

    The child is reduced to one row per value before the join, so neither its width nor a hot value
    is shuffled. Values with a NULL part reference nothing and are left out.
    """
    keys = list(on)
    present = reduce(Column.__and__, [F.col(c).isNotNull() for c in keys])
    values = child.where(present).groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
    known = parent.select(*[F.col(r).alias(c) for c, r in on.items()])
    return values.join(known, keys, "left_anti")


def newest_wins(target: DataFrame, batch: DataFrame, primary_key: Sequence[str], incremental_key: str) -> DataFrame:
    """Upsert result: per primary key the rows with the newer ``incremental_key`` stay.

    A target row goes when the batch has its key with an equal or newer value; a batch row goes when
    a target row that stays is newer. NULL in a key or in ``incremental_key`` compares with nothing,
    so such rows stay, and repeats inside the batch are not collapsed. Columns known to one side only
    are NULL on the other.

    "A row exists with ``ik >= x``" is the same as "the largest ``ik`` is ``>= x``", so both tests use
    one value per key: the joins stay equi-joins with a unique right side whatever the repeats, and
    the wide target is not shuffled when the keys of the batch are small enough to be broadcast.
    """
    keys = list(primary_key)
    newest = batch.groupBy(*keys).agg(F.max(incremental_key).alias("_newest"))
    touched = target.select(*keys, incremental_key).join(newest, keys, "inner")
    ahead = (
        touched.where(F.col("_newest").isNull() | (F.col(incremental_key) > F.col("_newest")))
        .groupBy(*keys).agg(F.max(incremental_key).alias("_newest"))
    )
    kept_target = _drop_not_newer(target, newest, keys, incremental_key)
    kept_batch = _drop_not_newer(batch, ahead, keys, incremental_key)
    return kept_target.unionByName(kept_batch, allowMissingColumns=True)


def _drop_not_newer(df: DataFrame, newest: DataFrame, keys: Sequence[str], incremental_key: str) -> DataFrame:
    other = newest.select(*[F.col(k).alias(f"_other_{k}") for k in keys], "_newest")
    same_key = [F.col(k) == F.col(f"_other_{k}") for k in keys]
    test = reduce(Column.__and__, same_key) & (F.col("_newest") >= F.col(incremental_key))
    return df.join(other, test, "left_anti")
