"""Turn text that hides booleans, numbers, dictionaries, lists and time ranges into typed values."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def as_column(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def clean_bool(col: Column | str) -> Column:
    """``True`` / ``False`` text to boolean; every other value, also ``true``, to NULL."""
    c = as_column(col)
    return F.when(c == "True", F.lit(True)).when(c == "False", F.lit(False))


def clean_string(col: Column | str, strict: bool = False) -> Column:
    """Lower-case text without Python quoting; empty text to NULL, ``None`` stays ``none``.

    The default removes every ``u'`` and every ``'`` wherever they stand, so ``menu's`` becomes
    ``mens``. ``strict`` removes only the quotes that wrap the whole value.
    """
    c = F.nullif(as_column(col), F.lit(""))
    if strict:
        return F.lower(F.regexp_replace(c, r"(?s)^u?'(.*)'$", "$1"))
    return F.lower(F.replace(F.replace(c, F.lit("u'"), F.lit("")), F.lit("'"), F.lit("")))


# Text that a cast to the type accepts. Testing first matters for speed: a failing cast raises and
# catches an exception per row, which is some twenty times slower than the test.
NUMBER_TEXT = {
    "smallint": r"^\s*[+-]?\d+\s*$",
    "int": r"^\s*[+-]?\d+\s*$",
    "bigint": r"^\s*[+-]?\d+\s*$",
    "float": r"(?i)^\s*[+-]?(\d+\.?\d*(e[+-]?\d+)?|\.\d+(e[+-]?\d+)?|nan|inf|infinity)\s*$",
    "double": r"(?i)^\s*[+-]?(\d+\.?\d*(e[+-]?\d+)?|\.\d+(e[+-]?\d+)?|nan|inf|infinity)\s*$",
}


def text_to(col: Column | str, to: str) -> Column:
    """Text to another type; text that does not fit becomes NULL."""
    c = as_column(col)
    return (F.when(c.rlike(NUMBER_TEXT[to]), c) if to in NUMBER_TEXT else c).try_cast(to)


def clean_number(col: Column | str, to: str, null_tokens: Sequence[str] = ("None",)) -> Column:
    """Text to a number type; null tokens and unparsable text become NULL."""
    c = as_column(col)
    return text_to(F.when(~c.isin(*null_tokens), c), to)


def clean_int(col: Column | str) -> Column:
    return clean_number(col, "int")


# A quoted text, so that a pattern steps over whole texts and never matches inside one. The loops are
# possessive: they run without recursion, so long texts cannot overflow the stack.
QUOTED = r"""(?:'[^'\\]*+(?:\\.[^'\\]*+)*+'|"[^"\\]*+(?:\\.[^"\\]*+)*+")"""
JSON_OPTIONS = {"allowBackslashEscapingAnyCharacter": "true"}


def dict_text_to_json(col: Column | str) -> Column:
    """Python dictionary text to JSON text; NULL, ``None`` and empty text to NULL.

    The words True, False and None become the texts ``=True``, ``=False`` and ``=None``, which no
    quoted value of the source can be mistaken for; keys are left alone whatever they contain. The JSON
    reader accepts single quotes.
    """
    c = as_column(col)
    c = F.when(~c.isin("", "None"), c)
    c = F.when(F.contains(c, F.lit("u'")) | F.contains(c, F.lit('u"')), F.regexp_replace(c, f"u?({QUOTED})", "$1")).otherwise(c)
    return F.regexp_replace(c, rf"([{{,]\s*{QUOTED}\s*:\s*)(True|False|None)(?=\s*[,}}])", '$1"=$2"')


def _flag(value: Column) -> Column:
    return F.when(value == "=True", F.lit(True)).when(value == "=False", F.lit(False))


def parse_flag_dict(col: Column | str) -> Column:
    """Dictionary text to ``map<string,boolean>``; a value that is no flag becomes NULL."""
    entries = F.from_json(dict_text_to_json(col), T.MapType(T.StringType(), T.StringType()), JSON_OPTIONS)
    return F.transform_values(entries, lambda _, value: _flag(value))


def parse_flags(json: Column | str, keys: Sequence[str]) -> Column:
    """The raw words of the wanted keys as a struct, from the text made by :func:`dict_text_to_json`."""
    schema = T.StructType([T.StructField(k, T.StringType()) for k in keys])
    return F.from_json(as_column(json), schema, JSON_OPTIONS)


def flag_of(words: Column, key: str) -> Column:
    """One boolean of :func:`parse_flags`."""
    return _flag(words.getField(key))


def parse_literal(col: Column | str) -> Column:
    """Python literal text to ``VARIANT``: numbers, texts, flags, and lists, tuples and dictionaries of them.

    The text is cut into quoted and other pieces. Quoted ones are written with JSON's quotes and escapes; in the
    others ``True``, ``False`` and ``None`` get JSON's names, tuples become lists, and closing commas go.
    ``None`` gives a variant null. What is no literal, a bare word, a key that is no text, a repeated key or an
    escape that JSON has no form for gives NULL, as do NULL and empty text.
    """
    pieces = F.regexp_extract_all(as_column(col), F.lit(f"{QUOTED}|[^'\"]++|['\"]"), F.lit(0))

    def text(piece: Column) -> Column:
        inner = F.substring(piece, F.lit(2), F.length(piece) - 2)
        inner = F.regexp_replace(inner, r"(\\\\)|\\(')", "$1$2")
        inner = F.regexp_replace(inner, r'((?:\\\\)*+)\\?"', r'$1\\"')
        return F.concat(F.lit('"'), inner, F.lit('"'))

    def other(piece: Column) -> Column:
        plain = F.regexp_replace(F.translate(piece, "()", "[]"), r"\bu$", "")
        for word, name in (("True", "true"), ("False", "false"), ("None", "null")):
            plain = F.regexp_replace(plain, rf"\b{word}\b", name)
        return F.regexp_replace(plain, r",\s*+([\]}])", "$1")

    def is_text(piece: Column) -> Column:
        return (F.length(piece) > 1) & piece.rlike("^['\"]")

    json = F.array_join(F.transform(pieces, lambda p: F.when(is_text(p), text(p)).otherwise(other(p))), "")
    # the parser stops after one value; inside an array it has to read on, and a second one is seen
    one = F.try_parse_json(F.concat(F.lit("["), json, F.lit("]")))
    return F.when(F.try_variant_get(one, "$[1]", "variant").isNull(), F.try_variant_get(one, "$[0]", "variant"))


def split_list(col: Column | str, protected: Sequence[str] = (), pattern: str = r",\s*") -> Column:
    """Delimited text to an array without empty items; NULL gives an empty array.

    ``protected`` phrases contain the delimiter themselves: they are taken out first and lead the list.
    """
    rest = F.coalesce(as_column(col), F.lit(""))
    pieces = []
    for phrase in protected:
        none = F.array().cast("array<string>")
        pieces.append(F.when(F.contains(rest, F.lit(phrase)), F.array(F.lit(phrase))).otherwise(none))
        rest = F.replace(rest, F.lit(phrase), F.lit(""))
    return F.filter(F.concat(*pieces, F.split(rest, pattern)), lambda item: item != "")


# ``hour:minute-hour:minute``; further parts of a side are ignored.
HOURS_TEXT = r"^\s*\d{1,6}\s*:\s*\d{1,6}\s*(?::[^-]*)?-\s*\d{1,6}\s*:\s*\d{1,6}\s*(?:[:-].*)?$"


def clock_of(col: Column | str, side: str) -> Column:
    """The ``from`` or ``to`` of ``9:30-17:0`` as ``hour * 100 + minute``; unreadable text is NULL.

    One test of the whole text comes first, so that what follows is plain cutting and cannot fail.
    """
    c = as_column(col)
    half = F.substring_index(c, "-", 1) if side == "from" else F.substring_index(F.substring_index(c, "-", 2), "-", -1)
    hour = F.substring_index(half, ":", 1).cast("int")
    minute = F.substring_index(F.substring_index(half, ":", 2), ":", -1).cast("int")
    return F.when(c.rlike(HOURS_TEXT), hour * 100 + minute)


def parse_hours(col: Column | str) -> Column:
    """``9:30-17:0`` to ``struct<from: 930, to: 1700>``; unreadable text gives two NULLs."""
    c = as_column(col)
    return F.when(c.isNotNull(), F.struct(clock_of(c, "from").alias("from"), clock_of(c, "to").alias("to")))


def slugify(col: Column | str) -> Column:
    """Lower-case identifier: blanks and hyphens become underscores."""
    return F.lower(F.translate(as_column(col), " -", "__"))
