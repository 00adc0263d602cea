"""Column functions; all are built-in expressions, none is a UDF."""

from relweave.functions.keys import content_key
from relweave.functions.temporal import day_text, parse_date, parse_timestamp
from relweave.functions.values import (
    clean_bool,
    clean_int,
    clean_number,
    clean_string,
    clock_of,
    dict_text_to_json,
    flag_of,
    parse_flag_dict,
    parse_flags,
    parse_hours,
    parse_literal,
    slugify,
    split_list,
    text_to,
)

__all__ = [
    "clean_bool",
    "clean_int",
    "clean_number",
    "clean_string",
    "clock_of",
    "content_key",
    "day_text",
    "dict_text_to_json",
    "flag_of",
    "parse_date",
    "parse_flag_dict",
    "parse_flags",
    "parse_hours",
    "parse_literal",
    "parse_timestamp",
    "slugify",
    "split_list",
    "text_to",
]
