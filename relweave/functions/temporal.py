"""Text to dates and timestamps; unparsable text becomes NULL instead of failing the job."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from relweave.functions.values import as_column


def parse_timestamp(col: Column | str) -> Column:
    """Text to a timestamp without time zone, so that the session zone cannot shift it."""
    return as_column(col).try_cast("timestamp_ntz")


def parse_date(col: Column | str) -> Column:
    return as_column(col).try_cast("date")


def day_text(col: Column | str) -> Column:
    """The ``yyyy-mm-dd`` part of a timestamp text."""
    return F.substring(as_column(col), 1, 10)
