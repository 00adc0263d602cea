"""Checks that return result rows; checks of one table share one scan."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from relweave.operators.nested import quoted
from relweave.operators.joins import orphans
from relweave.operators.spec import TableSpec

COUNT = "count(*)"


@dataclass(frozen=True)
class ValueCheck:
    """An aggregate expression of a table must equal a number, or lie within ``tolerance`` of it."""

    name: str
    table: str
    expected: float
    expression: str = COUNT
    tolerance: float | None = None


def run_checks(tables: Mapping[str, DataFrame], checks: Iterable[ValueCheck]) -> DataFrame:
    """One row per check: ``check, table, observed, expected, tolerance, passed``."""
    by_table: dict[str, list[ValueCheck]] = {}
    for check in checks:
        by_table.setdefault(check.table, []).append(check)
    parts = [_checked(tables[name], group) for name, group in by_table.items()]
    return reduce(DataFrame.unionByName, parts)


def _checked(df: DataFrame, checks: Sequence[ValueCheck]) -> DataFrame:
    observed = df.agg(*[F.expr(c.expression).cast("double").alias(f"_{i}") for i, c in enumerate(checks)])
    rows = [
        F.struct(
            F.lit(c.name).alias("check"),
            F.lit(c.table).alias("table"),
            F.col(f"_{i}").alias("observed"),
            F.lit(float(c.expected)).alias("expected"),
            F.lit(c.tolerance).cast("double").alias("tolerance"),
            within(F.col(f"_{i}"), c.expected, c.tolerance).alias("passed"),
        )
        for i, c in enumerate(checks)
    ]
    return observed.select(F.inline(F.array(*rows)))


def within(observed: Column, expected: float, tolerance: float | None = None) -> Column:
    """Equality, or ``expected*(1-t) <= observed <= expected*(1+t)``; NULL fails."""
    if tolerance is None:
        passed = observed == F.lit(float(expected))
    else:
        passed = observed.between(expected * (1 - tolerance), expected * (1 + tolerance))
    return F.coalesce(passed, F.lit(False))


def check_sql(spark: SparkSession, name: str, sql: str, expected, tolerance: float | None = None) -> DataFrame:
    """Value check of every column in the first row of a query; text is compared as text."""
    result = spark.sql(sql).limit(1)
    row = result.toDF(*[f"_{i}" for i in range(len(result.columns))])
    numeric = isinstance(expected, (int, float))
    tests = [
        within(F.col(c).try_cast("double"), expected, tolerance)
        if numeric
        else F.coalesce(F.col(c).cast("string") == F.lit(str(expected)), F.lit(False))
        for c in row.columns
    ]
    return _verdict(row, name, reduce(Column.__and__, tests))


def check_truthy(df: DataFrame, name: str) -> DataFrame:
    """Passes when there is a first row and none of its values is false, zero, empty or NULL."""
    row = df.limit(1).toDF(*[f"_{i}" for i in range(len(df.columns))])
    return _verdict(row, name, reduce(Column.__and__, [truthy(f) for f in row.schema]))


def truthy(field: T.StructField) -> Column:
    c, kind = F.col(field.name), field.dataType
    if isinstance(kind, T.BooleanType):
        test = c
    elif isinstance(kind, T.NumericType):
        test = c != 0
    elif isinstance(kind, T.StringType):
        test = c != ""
    elif isinstance(kind, (T.ArrayType, T.MapType)):
        test = F.size(c) > 0
    else:
        test = c.isNotNull()
    return F.coalesce(test, F.lit(False))


def _verdict(row: DataFrame, name: str, test: Column) -> DataFrame:
    # no row at all is a failure, hence the aggregate without grouping
    passed = F.coalesce(F.bool_and(test), F.lit(False))
    return row.agg(passed.alias("passed")).select(F.lit(name).alias("check"), "passed")


def check_interval(
    df: DataFrame,
    metrics: Mapping[str, tuple[str, float]],
    day: str,
    date_column: str = "ds",
    days_back: int = -7,
    ignore_zero: bool = True,
) -> DataFrame:
    """Compare metrics of ``day`` with those of ``days_back`` before, in one scan of the two days.

    ``metrics`` maps a name to an aggregate expression and a threshold: the larger of the two values
    over the smaller must stay below it. A zero on either side passes with ``ignore_zero``; a missing
    day fails.
    """
    current = F.lit(day).cast("date")
    earlier = F.date_add(current, days_back)
    on_day = F.col(date_column).cast("date")
    start, end = sorted([day, _shift(day, days_back)])
    dated = df.where((F.col(date_column) >= F.lit(start).cast("date")) & (F.col(date_column) < F.lit(_shift(end, 1)).cast("date")))
    dated = dated.withColumn("_day", on_day).where(F.col("_day").isin(current, earlier))
    per_day = dated.groupBy("_day").agg(
        *[F.expr(expression).cast("double").alias(f"_{i}") for i, (expression, _) in enumerate(metrics.values())]
    )
    values = per_day.agg(
        *[
            F.max(F.when(F.col("_day") == when, F.col(f"_{i}"))).alias(f"_{label}{i}")
            for i in range(len(metrics))
            for label, when in (("now", current), ("then", earlier))
        ]
    )
    rows = []
    for i, (name, (_, threshold)) in enumerate(metrics.items()):
        now, then = F.col(f"_now{i}"), F.col(f"_then{i}")
        zero = (now == 0) | (then == 0)
        ratio = F.when(~zero, F.greatest(now, then) / F.least(now, then))
        passed = F.when(now.isNull() | then.isNull(), F.lit(False)).when(zero, F.lit(ignore_zero))
        rows.append(
            F.struct(
                F.lit(name).alias("metric"), now.alias("observed"), then.alias("reference"),
                ratio.alias("ratio"), F.lit(float(threshold)).alias("threshold"),
                passed.otherwise(ratio < threshold).alias("passed"),
            )
        )
    return values.select(F.inline(F.array(*rows)))


def _shift(day: str, days: int) -> str:
    from datetime import date, timedelta

    return (date.fromisoformat(day) + timedelta(days=days)).isoformat()


def primary_key_violations(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Key values held by several rows, or with a NULL part, and how many rows hold them."""
    has_null = reduce(Column.__or__, [F.col(c).isNull() for c in key])
    counted = df.groupBy(*key).agg(F.count(F.lit(1)).alias("n_rows"))
    return counted.where((F.col("n_rows") > 1) | has_null)


def foreign_key_violations(tables: Mapping[str, DataFrame], spec: TableSpec) -> DataFrame:
    """``table, column, ref_table, n_values, n_rows`` of orphans for every declared reference."""
    parts = [
        orphans(tables[spec.name], tables[fk.ref_table], {fk.column: fk.ref_column})
        .agg(F.count(F.lit(1)).alias("n_values"), F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n_rows"))
        .select(
            F.lit(spec.name).alias("table"), F.lit(fk.column).alias("column"),
            F.lit(fk.ref_table).alias("ref_table"), "n_values", "n_rows",
        )
        for fk in spec.foreign_keys
    ]
    if not parts:
        raise ValueError(f"table {spec.name} declares no foreign key")
    return reduce(DataFrame.unionByName, parts)


KEY_PARTS = 64  # a power of two; the values of a column set fall into this many parts by their hash, one of them is searched first


def _repeated_in_part(df: DataFrame, columns: Sequence[str], sets: Sequence[Sequence[str]]) -> set[int]:
    """Places of the column sets with two equal rows among those whose values fall into one part; one pass for all sets."""
    # a hash skips NULLs, so each value is hashed with whether it is one; the part of a set is that of all its columns together
    parts = {c: F.xxhash64(F.lit(k), quoted(c).isNull(), quoted(c)).bitwiseAND(F.lit(KEY_PARTS - 1)).cast("int") for k, c in enumerate(columns)}
    values = df.select(*[quoted(c).alias(f"_{k}") for k, c in enumerate(columns)], *[p.alias(f"_part{k}") for k, p in enumerate(parts.values())])
    place = {c: k for k, c in enumerate(columns)}
    inside = [reduce(Column.bitwiseXOR, [F.col(f"_part{place[c]}") for c in s]) == 0 for s in sets]
    rows = values.withColumn("_set", F.explode(F.array(*[F.when(own, F.lit(i)) for i, own in enumerate(inside)]))).where("_set IS NOT NULL")
    own = [F.when(F.col("_set").isin([i for i, s in enumerate(sets) if c in s]), F.col(f"_{k}")).alias(f"_{k}") for k, c in enumerate(columns)]
    repeated = rows.select("_set", *own).groupBy("_set", *[f"_{k}" for k in range(len(columns))]).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    return {r[0] for r in repeated.select("_set").distinct().collect()}


def _repeated(df: DataFrame, sets: Sequence[Sequence[str]]) -> set[int]:
    """Places of the column sets with two equal rows in the whole table, in one job."""
    def branch(i: int, chosen: Sequence[str]) -> DataFrame:
        counted = df.groupBy(*[quoted(c).alias(f"_{k}") for k, c in enumerate(chosen)]).agg(F.count(F.lit(1)).alias("_n"))
        return counted.agg(F.max("_n").alias("most")).select(F.lit(i).alias("place"), "most")

    return {r.place for r in reduce(DataFrame.unionByName, [branch(i, s) for i, s in enumerate(sets)]).where("most > 1").collect()}


def candidate_keys(df: DataFrame, columns: Sequence[str], width: int = 2) -> DataFrame:
    """``columns, width`` of every smallest set of up to ``width`` columns in which no two rows are equal.

    Two equal rows show that a set is no key, wherever they are found. Equal values have equal hashes, so they
    are sought first among the rows whose values fall into one part by their hash, for all sets in one pass;
    the sets without any there are grouped whole, width by width, which settles them. Sets that hold a key are
    left out. NULL counts as a value. An empty table has the keys of one column each.
    """
    sets = [s for n in range(1, width + 1) for s in combinations(columns, n)]
    refuted = _repeated_in_part(df, columns, sets) if sets else set()
    possible = [s for i, s in enumerate(sets) if i not in refuted]
    found: list[tuple[str, ...]] = []
    for n in range(1, width + 1):
        level = [s for s in possible if len(s) == n and not any(set(key) <= set(s) for key in found)]
        if level:
            refuted = _repeated(df, level)
            found += [s for i, s in enumerate(level) if i not in refuted]
    rows = [(",".join(s), len(s)) for s in found]  # at most as many as there are sets
    return df.sparkSession.createDataFrame(rows, "columns string, width int")


def dependency_violations(df: DataFrame, by: Sequence[str], columns: Sequence[str] | None = None) -> DataFrame:
    """``column, n_groups, n_varying``: in how many groups of ``by`` a column has more than one value.

    A column with none follows from ``by``. One aggregate finds the spread of all columns; NULL beside a
    value counts as varying. Maps have no order and are compared by their hash.
    """
    columns = [c for c in df.columns if c not in by] if columns is None else list(columns)
    compared = {c: F.xxhash64(F.to_json(quoted(c))) if isinstance(df.schema[c].dataType, T.MapType) else quoted(c) for c in columns}
    spread = df.groupBy(*[quoted(c) for c in by]).agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.struct(F.min(v).alias("low"), F.max(v).alias("high"), F.count(v).alias("n")).alias(f"_{i}") for i, v in enumerate(compared.values())],
    )
    varying = [
        F.count_if((F.col(f"_{i}.low") != F.col(f"_{i}.high")) | ((F.col(f"_{i}.n") > 0) & (F.col(f"_{i}.n") < F.col("_rows")))).alias(f"_{i}")
        for i in range(len(columns))
    ]
    totals = spread.agg(F.count(F.lit(1)).alias("n_groups"), *varying)
    rows = [F.struct(F.lit(c).alias("column"), F.col("n_groups"), F.col(f"_{i}").alias("n_varying")) for i, c in enumerate(columns)]
    return totals.select(F.inline(F.array(*rows)))


def sample_rows(df: DataFrame, k: int = 20) -> DataFrame:
    """Up to ``k`` rows of the table, the same ones however it is partitioned, in one pass.

    Every row falls into one of ``k`` parts by its hash, and the row of the smallest hash of each is taken;
    an aggregate of ``k`` rows, whatever the size of the table. Of equal rows one counts. Maps have no
    hash; convert them first.
    """
    every = [quoted(c) for c in df.columns]
    draw = F.xxhash64(*every)
    part = F.pmod(F.xxhash64(draw, F.lit("part")), F.lit(k))
    first = df.agg(*[F.min(F.when(part == i, F.struct(draw.alias("_draw"), F.struct(*every).alias("_row")))).alias(f"_{i}") for i in range(k)])
    taken = first.select(F.explode(F.array(*[F.col(f"_{i}") for i in range(k)])).alias("_taken")).where(F.col("_taken").isNotNull())
    return taken.select("_taken._row.*")


def length_violations(df: DataFrame, bounds: Mapping[str, int] | TableSpec) -> DataFrame:
    """``column, bound, max_length, passed`` for every bounded text column, in one pass."""
    if isinstance(bounds, TableSpec):
        bounds = {c.name: c.max_length for c in bounds.columns if c.max_length is not None}
    longest = df.agg(*[F.max(F.length(quoted(c))).alias(c) for c in bounds])
    rows = [
        F.struct(
            F.lit(c).alias("column"), F.lit(bound).alias("bound"), quoted(c).alias("max_length"),
            F.coalesce(quoted(c) <= bound, F.lit(True)).alias("passed"),
        )
        for c, bound in bounds.items()
    ]
    return longest.select(F.inline(F.array(*rows)))


def profile_nulls(df: DataFrame) -> DataFrame:
    """``column, n_rows, n_nulls`` for every column, in one pass."""
    summary = df.agg(
        F.count(F.lit(1)).alias("_rows"), *[F.count_if(quoted(c).isNull()).alias(c) for c in df.columns]
    )
    long = summary.unpivot(["_rows"], list(map(quoted, df.columns)), "column", "n_nulls")
    return long.select("column", F.col("_rows").alias("n_rows"), "n_nulls")


def profile_lengths(df: DataFrame) -> DataFrame:
    """``column, max_length`` for every text column, in one pass."""
    texts = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
    return df.agg(*[F.max(F.length(quoted(c))).alias(c) for c in texts]).unpivot([], list(map(quoted, texts)), "column", "max_length")


def describe(df: DataFrame) -> DataFrame:
    """Profile of a table: ``column, type, n_rows, n_nulls, max_length``, in one pass."""
    kinds = [(f.name, f.dataType.simpleString(), isinstance(f.dataType, T.StringType)) for f in df.schema]
    aggregates = [F.count(F.lit(1)).alias("_rows")]
    for i, (name, _, is_text) in enumerate(kinds):
        aggregates.append(F.count_if(quoted(name).isNull()).alias(f"_nulls{i}"))
        if is_text:
            aggregates.append(F.max(F.length(quoted(name))).alias(f"_length{i}"))
    rows = [
        F.struct(
            F.lit(name).alias("column"), F.lit(kind).alias("type"), F.col("_rows").alias("n_rows"),
            F.col(f"_nulls{i}").alias("n_nulls"),
            (F.col(f"_length{i}") if is_text else F.lit(None).cast("int")).alias("max_length"),
        )
        for i, (name, kind, is_text) in enumerate(kinds)
    ]
    return df.agg(*aggregates).select(F.inline(F.array(*rows)))
