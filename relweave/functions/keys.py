"""Keys computed from row content: reproducible, and free of any shuffle."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from relweave.functions.values import as_column


def _text(part: Column) -> Column:
    """Text of a key part. Grouping and joins take -0.0 for 0.0, so both get the key of 0.0."""
    text = part.cast("string")
    return F.when(F.typeof(part).isin("double", "float") & (text == "-0.0"), F.lit("0.0")).otherwise(text)


def content_key(*cols: Column | str, null_if_any_null: bool = False) -> Column:
    """MD5 of the parts, each written as ``length:text`` (NULL as ``-``), so no two tuples share a text.

    128 bits keep the chance of a collision negligible for any number of rows; a 64-bit hash does not.
    ``null_if_any_null`` gives the outcome of a lookup by plain equality, which NULL never matches.
    """
    parts = [_text(as_column(c)) for c in cols]
    tagged = [
        F.coalesce(F.concat(F.length(p).cast("string"), F.lit(":"), p), F.lit("-")) for p in parts
    ]
    key = F.md5(F.concat(*tagged))
    if not null_if_any_null:
        return key
    present = parts[0].isNotNull()
    for p in parts[1:]:
        present = present & p.isNotNull()
    return F.when(present, key)
