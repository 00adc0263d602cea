"""Structs, maps, arrays and delimited text: expand sideways into columns or downwards into rows."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from relweave.functions.values import JSON_OPTIONS, as_column, dict_text_to_json, flag_of, parse_flags, parse_literal


def expand_struct(df: DataFrame, struct: str, keep: Sequence[str] = ()) -> DataFrame:
    """``keep`` columns followed by every field of ``struct``."""
    return df.select(*keep, f"{struct}.*")


def split_structs(df: DataFrame, structs: Sequence[str], fields: Sequence[str]) -> DataFrame:
    """Replace each struct column by ``<struct>_<field>`` columns, in one projection."""
    kept = [F.col(c) for c in df.columns if c not in structs]
    flat = [F.col(f"{s}.{f}").alias(f"{s}_{f}") for s in structs for f in fields]
    return df.select(*kept, *flat)


def quoted(name: str) -> Column:
    """A column by its literal name, dots and backticks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def map_long(df: DataFrame, column: str, keep: Sequence[str]) -> DataFrame:
    """``keep`` columns with ``key`` and ``value`` of every map entry, for any number of keys."""
    return df.select(*map(quoted, keep), F.explode(quoted(column)).alias("key", "value"))


def distinct_keys(df: DataFrame, column: str) -> DataFrame:
    """``key, n_rows`` of a map column: the keys there are and how many rows have each."""
    return map_long(df, column, []).groupBy("key").agg(F.count(F.lit(1)).alias("n_rows"))


def undeclared_keys(df: DataFrame, column: str, declared: Sequence[str]) -> DataFrame:
    """``key, n_rows`` of the keys that a wide output of the ``declared`` ones leaves out."""
    return distinct_keys(df, column).where(~F.col("key").isin(*declared)) if declared else distinct_keys(df, column)


def undeclared_values(df: DataFrame, column: str, declared: Sequence[str]) -> DataFrame:
    """``key, n_rows`` of the values that a pivot over the ``declared`` ones leaves out."""
    rest = df.where(quoted(column).isNotNull() & ~quoted(column).isin(*declared))
    return rest.groupBy(quoted(column).alias("key")).agg(F.count(F.lit(1)).alias("n_rows"))


MOST_COLUMNS = 10_000


def _sorted_keys(keys: DataFrame) -> list:
    """The keys as column names. More than ``MOST_COLUMNS`` are refused: use :func:`map_long` for them."""
    found = sorted(row.key for row in keys.select("key").limit(MOST_COLUMNS + 1).collect())
    if len(found) > MOST_COLUMNS:
        raise ValueError(f"more than {MOST_COLUMNS} keys make no columns; declare the wanted ones or keep them as rows")
    return found


def column_name_for(prefix: str, key: str) -> str:
    return f"{prefix}_{key.replace('-', '_')}"


def map_to_columns(df: DataFrame, column: str, keys: Sequence[str] | None = None) -> DataFrame:
    """Replace a map column by one column per key, named ``<column>_<key>`` with ``-`` as ``_``.

    Declared keys keep the call lazy; otherwise one job finds the sorted distinct keys.
    """
    if keys is None:
        keys = _sorted_keys(distinct_keys(df, column))
    others = [F.col(c) for c in df.columns if c != column]
    return df.select(*others, *[F.col(column)[k].alias(column_name_for(column, k)) for k in keys])


def flag_dicts_to_columns(df: DataFrame, columns: Mapping[str, Sequence[str] | None]) -> DataFrame:
    """Replace dictionary-text columns by boolean columns; ``None`` keys are looked up in the data.

    One malformed value nulls its own flag only, where reading a map of booleans would lose the whole
    dictionary.
    """
    keys = {c: (_sorted_keys(keys_in_text(df, c)) if k is None else list(k)) for c, k in columns.items()}
    others = [F.col(c) for c in df.columns if c not in keys]
    # two projections: the text is rewritten once, however many of its words are read afterwards
    text = df.select(*others, *[dict_text_to_json(c).alias(c) for c in keys])
    parsed = text.select(*others, *[parse_flags(c, k).alias(c) for c, k in keys.items()])
    flags = [flag_of(F.col(c), k).alias(column_name_for(c, k)) for c, wanted in keys.items() for k in wanted]
    return parsed.select(*others, *flags)


def literals_to_columns(df: DataFrame, column: str, fields: Mapping[str, str]) -> DataFrame:
    """Replace Python literal text by one typed column per field, named ``<column>_<key>``; ``fields`` gives the types.

    A field that is missing, or whose value does not fit its type, is NULL by itself. The text is parsed once.
    """
    kept = [quoted(c) for c in df.columns if c != column]
    parsed = df.select(*kept, parse_literal(quoted(column)).alias(column))
    path = {k: f'$["{k}"]' if "'" in k else f"$['{k}']" for k in fields}  # a key with both quotes has no path
    return parsed.select(
        *kept, *[F.try_variant_get(quoted(column), path[k], kind).alias(column_name_for(column, k)) for k, kind in fields.items()]
    )


def keys_in_text(df: DataFrame, column: str) -> DataFrame:
    """``key, n_rows`` of dictionary text."""
    # a map of strings accepts any value, so a malformed one cannot hide the other keys
    as_map = F.from_json(dict_text_to_json(column), T.MapType(T.StringType(), T.StringType()), JSON_OPTIONS)
    return distinct_keys(df.select(as_map.alias("entries")), "entries")


def undeclared_keys_in_text(df: DataFrame, column: str, declared: Sequence[str]) -> DataFrame:
    """``key, n_rows`` of the dictionary text's keys that a wide output of the ``declared`` ones leaves out."""
    found = keys_in_text(df, column)
    return found.where(~F.col("key").isin(*declared)) if declared else found


def explode_array(df: DataFrame, column: Column | str, into: str, keep: Sequence[str], outer: bool = False) -> DataFrame:
    """One row per array item; ``outer`` keeps a row for an empty or NULL array."""
    generate = F.explode_outer if outer else F.explode
    return df.select(*keep, generate(as_column(column)).alias(into))


def explode_delimited(
    df: DataFrame,
    column: str,
    into: str,
    keep: Sequence[str],
    sep: str = ",",
    null_tokens: Sequence[str] = ("",),
    distinct: str | None = None,
) -> DataFrame:
    """Delimited text to rows, dropping NULL and ``null_tokens`` items.

    ``distinct='row'`` removes repeats inside one text without a shuffle, which is enough when
    ``keep`` identifies the row; ``distinct='global'`` also removes repeats across rows.
    """
    items = F.split(F.col(column), re.escape(sep))
    if distinct is not None:
        items = F.array_distinct(items)
    rows = df.select(*keep, F.explode(items).alias(into)).where(~F.col(into).isin(*null_tokens))
    return rows.distinct() if distinct == "global" else rows
