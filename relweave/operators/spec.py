"""Declared tables: columns, types, keys and layout, read from YAML or JSON or written in code."""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from graphlib import TopologicalSorter
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from relweave.functions.values import text_to

# Warehouse type names and their Spark types (fixed values).
SPARK_TYPES = {
    "boolean": T.BooleanType(), "bool": T.BooleanType(),
    "smallint": T.ShortType(), "int2": T.ShortType(),
    "integer": T.IntegerType(), "int": T.IntegerType(), "int4": T.IntegerType(),
    "bigint": T.LongType(), "int8": T.LongType(),
    "real": T.FloatType(), "float4": T.FloatType(),
    "float": T.DoubleType(), "float8": T.DoubleType(), "double precision": T.DoubleType(), "double": T.DoubleType(),
    "date": T.DateType(),
    "timestamp": T.TimestampNTZType(), "timestamptz": T.TimestampType(),
    "text": T.StringType(), "string": T.StringType(),
}
TEXT_TYPE = re.compile(r"(?:varchar|char|character varying|character)\s*\(\s*(\d+)\s*\)$")
DECIMAL_TYPE = re.compile(r"(?:decimal|numeric)(?:\s*\(\s*(\d+)\s*(?:,\s*(\d+)\s*)?\))?$")


@dataclass(frozen=True)
class ColumnSpec:
    name: str
    declared: str

    @property
    def max_length(self) -> int | None:
        match = TEXT_TYPE.match(self.declared.strip().lower())
        return int(match.group(1)) if match else None

    @property
    def spark_type(self) -> T.DataType:
        if self.max_length is not None:
            return T.StringType()
        if match := DECIMAL_TYPE.match(self.declared.strip().lower()):
            # a warehouse decimal without digits is decimal(18, 0)
            return T.DecimalType(int(match.group(1) or 18), int(match.group(2) or 0))
        try:
            return SPARK_TYPES[self.declared.strip().lower()]
        except KeyError:
            raise ValueError(f"column {self.name}: unknown type {self.declared!r}") from None


@dataclass(frozen=True)
class ForeignKey:
    column: str
    ref_table: str
    ref_column: str


@dataclass(frozen=True)
class TableSpec:
    name: str
    columns: tuple[ColumnSpec, ...]
    primary_key: tuple[str, ...] = ()
    foreign_keys: tuple[ForeignKey, ...] = ()
    incremental_key: str | None = None
    dist_key: str | None = None
    sort_key: tuple[str, ...] = ()
    sort_type: str = "compound"
    source: str | None = None
    #: number of hash buckets of the primary key, the unit in which an upsert rewrites the table
    buckets: int | None = None
    #: number of files sets by ``dist_key`` that the catalog knows, so that joins on it need no shuffle
    dist_buckets: int | None = None

    def __post_init__(self):
        if not self.columns:
            raise ValueError(f"table {self.name}: no columns declared")
        known = set(self.column_names)
        if len(known) != len(self.columns):
            raise ValueError(f"table {self.name}: a column is declared twice")
        used = [*self.primary_key, *self.sort_key, *(fk.column for fk in self.foreign_keys)]
        used += [c for c in (self.dist_key, self.incremental_key) if c]
        unknown = sorted(set(used) - known)
        if unknown:
            raise ValueError(f"table {self.name}: keys name undeclared columns {unknown}")
        if self.sort_type.lower() not in ("compound", "interleaved"):
            raise ValueError(f"table {self.name}: sort type is 'compound' or 'interleaved'")
        if self.buckets and not self.primary_key:
            raise ValueError(f"table {self.name}: buckets need a primary key")
        if self.dist_buckets and not self.dist_key:
            raise ValueError(f"table {self.name}: distribution buckets need a distribution key")
        if self.buckets and self.dist_buckets:
            raise ValueError(f"table {self.name}: buckets of the primary key or of the distribution key, not both")

    @property
    def column_names(self) -> list[str]:
        return [c.name for c in self.columns]

    @property
    def struct_type(self) -> T.StructType:
        return T.StructType([T.StructField(c.name, c.spark_type) for c in self.columns])

    @classmethod
    def of(cls, name: str, columns: str | Sequence[tuple[str, str]], **keys) -> TableSpec:
        """Short form: ``TableSpec.of("users", "user_id varchar(22), fans bigint", primary_key=("user_id",))``."""
        if isinstance(columns, str):
            columns = [tuple(part.split(None, 1)) for part in re.split(r",(?![^(]*\))", columns)]
        return cls(name, tuple(ColumnSpec(n, t.strip()) for n, t in columns), **keys)

    @classmethod
    def from_dict(cls, entry: Mapping) -> TableSpec:
        """One entry of a definition file (``table_name``, ``origin_schema``, keys and layout)."""
        name = str(entry["table_name"]).lower()
        schema = entry.get("origin_schema")
        if not schema:
            raise ValueError(f"table {name}: origin_schema is missing")
        references = entry.get("foreign_key") or []
        if isinstance(references, Mapping):
            references = [references]
        if not isinstance(references, (list, tuple)):
            raise ValueError(f"table {name}: foreign_key is a mapping or a list of mappings")
        dist_key = entry.get("distkey")
        if dist_key and (not isinstance(dist_key, str) or "," in dist_key):
            raise ValueError(f"table {name}: only one distribution key may be given")
        return cls(
            name=name,
            columns=tuple(ColumnSpec(c["name"], c["type"]) for c in schema),
            primary_key=_names(entry.get("primary_key")),
            foreign_keys=tuple(
                ForeignKey(r["column_name"], r["reftable"], r["ref_column"]) for r in references
            ),
            incremental_key=entry.get("incremental_key"),
            dist_key=dist_key or None,
            sort_key=_names(entry.get("sortkey")),
            sort_type=entry.get("sort_type", "compound"),
            source=entry.get("s3_key"),
            buckets=entry.get("buckets"),
            dist_buckets=entry.get("dist_buckets"),
        )


def _names(value: str | Sequence[str] | None) -> tuple[str, ...]:
    if not value:
        return ()
    return (value,) if isinstance(value, str) else tuple(value)


def read_specs(path: str | Path, spark=None) -> dict[str, TableSpec]:
    """Table definitions from a YAML or JSON file: a list of entries, or an object of entries by table name.

    With ``spark`` the file is read through the session's file system, so it may lie in shared storage.
    """
    if spark is None:
        text = Path(path).read_text()
    else:
        text = spark.read.text(str(path), wholetext=True).first()[0]
    if str(path).endswith(".json"):
        entries = json.loads(text)
    else:
        try:
            import yaml
        except ImportError:
            raise RuntimeError("reading YAML definitions needs PyYAML; use JSON instead") from None
        entries = yaml.safe_load(text)
    if isinstance(entries, Mapping):
        entries = [{"table_name": name, **entry} for name, entry in entries.items()]
    return {spec.name: spec for spec in map(TableSpec.from_dict, entries)}


def _references(specs: Iterable[TableSpec]) -> dict[str, list[str]]:
    specs = {s.name: s for s in specs}
    return {
        name: sorted({fk.ref_table for fk in s.foreign_keys if fk.ref_table in specs} - {name})
        for name, s in specs.items()
    }


def load_order(specs: Iterable[TableSpec]) -> list[str]:
    """Table names with every referenced table before the tables that reference it."""
    return list(TopologicalSorter(_references(specs)).static_order())


def load_steps(specs: Iterable[TableSpec]) -> list[list[str]]:
    """Table names in groups: no table references one of its own group or of a later one."""
    return ready_steps(_references(specs))


def ready_steps(needs: Mapping[str, Iterable[str]]) -> list[list[str]]:
    """Names in groups, each name after all it needs."""
    order = TopologicalSorter(needs)
    order.prepare()
    steps = []
    while order.is_active():
        ready = sorted(order.get_ready())
        steps.append(ready)
        order.done(*ready)
    return steps


def stored_columns(spark, table: str) -> list[tuple[str, str]]:
    """Names and types a stored table declares, in table order."""
    return [(f.name, f.dataType.simpleString()) for f in spark.table(table).schema]


def conform(df: DataFrame, spec: TableSpec | T.StructType, on_missing: str = "null") -> DataFrame:
    """Columns of the spec, in its order and types; other columns are dropped.

    Values that do not fit become NULL (count them with :func:`cast_losses`). A missing column is NULL
    or, with ``on_missing='error'``, an error.
    """
    schema = spec if isinstance(spec, T.StructType) else spec.struct_type
    absent = [f.name for f in schema if f.name not in df.columns]
    if absent and on_missing == "error":
        raise ValueError(f"columns missing from the data: {absent}")
    return df.select(
        *[
            (F.lit(None).cast(f.dataType) if f.name in absent else _fitted(df, f.name, f.dataType)).alias(f.name)
            for f in schema
        ]
    )


def _fitted(df: DataFrame, column: str, to: T.DataType) -> Column:
    if df.schema[column].dataType == to:
        return F.col(column)
    if isinstance(df.schema[column].dataType, T.StringType):
        return text_to(column, to.simpleString())
    return F.col(column).try_cast(to)


def cast_losses(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Per column the number of values that :func:`conform` turns into NULL, in one pass."""
    shared = [c for c in spec.columns if c.name in df.columns]
    lost = [
        F.count_if(F.col(c.name).isNotNull() & _fitted(df, c.name, c.spark_type).isNull()).alias(c.name)
        for c in shared
    ]
    return df.agg(*lost).unpivot([], [c.name for c in shared], "column", "n_lost")


def schema_difference(df: DataFrame, spec: TableSpec) -> list[tuple[str, str, str | None, str | None]]:
    """``(column, problem, declared, actual)`` for every deviation from the spec."""
    actual = {f.name: f.dataType.simpleString() for f in df.schema}
    declared = {c.name: c.spark_type.simpleString() for c in spec.columns}
    found = []
    for name, kind in declared.items():
        if name not in actual:
            found.append((name, "missing", kind, None))
        elif actual[name] != kind:
            found.append((name, "type", kind, actual[name]))
    return found + [(n, "undeclared", None, k) for n, k in actual.items() if n not in declared]


def lay_out(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Physical layout before a write: rows of one distribution key together, files sorted.

    The rebalance lets AQE split a key that is too big for one task and merge small ones. A compound sort
    orders by the first key, then the next; an interleaved one by the place on a curve through all keys, so
    that a filter on any of them meets few files and row groups.
    """
    if spec.sort_type.lower() == "interleaved" and len(spec.sort_key) > 1:
        placed = df.withColumn(CURVE, curve_place(df, spec.sort_key))
        placed = placed.hint("rebalance", spec.dist_key) if spec.dist_key else placed.repartitionByRange(CURVE)
        return placed.sortWithinPartitions(CURVE).drop(CURVE)
    if spec.dist_key:
        df = df.hint("rebalance", spec.dist_key)
    return df.sortWithinPartitions(*spec.sort_key) if spec.sort_key else df


CURVE = "_curve"
CURVE_BITS = 8


def _sortable(df: DataFrame, column: str) -> Column:
    """The column as a number in the same order: of text the first seven bytes."""
    kind = df.schema[column].dataType
    if isinstance(kind, (T.StringType, T.BinaryType)):
        head = F.rpad(F.hex(F.substring(F.col(column).cast("binary"), 1, 7)), 14, "0")
        return F.conv(head, 16, 10).cast("long")
    if isinstance(kind, T.DateType):
        return F.unix_date(column).cast("long")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(F.col(column).cast("timestamp"))
    return F.col(column).cast("double" if isinstance(kind, (T.FloatType, T.DoubleType, T.DecimalType)) else "long")


def range_bounds(df: DataFrame, columns: Sequence[str], bits: int = CURVE_BITS, accuracy: int = 10_000) -> dict[str, list]:
    """Per column the values that split its rows into ``2 ** bits`` ranges of about equal size, in one pass."""
    shares = [i / (1 << bits) for i in range(1, 1 << bits)]
    bounds = df.agg(*[F.percentile_approx(_sortable(df, c), shares, accuracy).alias(f"_{i}") for i, c in enumerate(columns)]).first()
    return {c: sorted(set(bounds[i] or [])) for i, c in enumerate(columns)}


def curve_place(df: DataFrame, columns: Sequence[str], bits: int = CURVE_BITS, accuracy: int = 10_000) -> Column:
    """Place on a space-filling curve: the bits of every column's range number, highest first, in turn.

    NULL lies in the first range. The first column gives the highest bit of each turn.
    """
    bounds = range_bounds(df, columns, bits, accuracy)
    apart = [sum(((n >> bit) & 1) << (bit * len(columns)) for bit in range(bits)) for n in range(1 << bits)]
    place = F.lit(0).cast("long")
    for i, column in enumerate(columns):
        spaced = F.get(F.lit(apart).cast("array<long>"), _range_number(bounds[column], _sortable(df, column), bits))
        place = place + F.shiftleft(spaced, len(columns) - 1 - i)
    return place


def _range_number(bounds: Sequence, value: Column, bits: int) -> Column:
    """How many of the sorted bounds are at most ``value``, by halving; 0 for NULL."""
    if not bounds:
        return F.lit(0)
    ranges, steps = F.lit(list(bounds)), F.lit([1 << b for b in reversed(range(bits))])
    return F.aggregate(
        steps, F.lit(0), lambda at, step: F.when(F.get(ranges, at + step - 1) <= value, at + step).otherwise(at)
    )
