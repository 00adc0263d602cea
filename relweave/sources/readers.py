"""Scans: JSON lines, CSV with header, Parquet, and inline lookup tables."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from relweave.session import materialise


def read_json(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType | str | None = None,
    sampling_ratio: float | None = None,
) -> DataFrame:
    """JSON lines. Give a schema for production reads: inference costs a pass over the input."""
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    elif sampling_ratio is not None:
        reader = reader.option("samplingRatio", str(sampling_ratio))
    return reader.json(path)


REJECTED = "_rejected"


def read_json_split(spark: SparkSession, path: str | list[str], schema: T.StructType | str) -> tuple[DataFrame, DataFrame]:
    """(rows, rejected): the lines that fit the schema, and the text of those that do not.

    The lines are parsed once into a written table that both are read from, so together they are all lines
    of the input. A line whose values cannot be converted is rejected whole; blank lines are no lines.
    """
    declared = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    kept = T.StructType([*declared.fields, T.StructField(REJECTED, T.StringType())])
    parsed = spark.read.schema(kept).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", REJECTED).json(path)
    parsed = materialise(parsed, "json-lines")
    rejected = F.col(REJECTED).isNotNull()
    return parsed.where(~rejected).drop(REJECTED), parsed.where(rejected).select(F.col(REJECTED).alias("line"))


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType | str | None = None,
    sep: str = ",",
    header: bool = True,
    **options: str,
) -> DataFrame:
    """CSV; without a schema every column is a string named by the header (no inference pass)."""
    reader = spark.read.options(header=header, sep=sep, **options)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.csv(path)


def read_parquet(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """Parquet; a declared schema skips the footer read that schema discovery needs."""
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(path)


def stage_json(spark: SparkSession, path: str, schema: T.StructType | str, staged_path: str) -> DataFrame:
    """Parse JSON text once into Parquet, so that every later consumer prunes columns."""
    read_json(spark, path, schema).write.mode("overwrite").parquet(staged_path)
    return read_parquet(spark, staged_path)


def inline_lookup(spark: SparkSession, rows: Sequence[tuple], schema: T.StructType) -> DataFrame:
    """Literal table from the program text.

    It goes through Arrow so that Spark knows its real size and can choose a broadcast join by
    itself; a larger table belongs in a file.
    """
    columns = list(zip(*rows)) if rows else [()] * len(schema)
    arrow = pa.Table.from_arrays(
        [pa.array(values, type=field.type) for values, field in zip(columns, to_arrow_schema(schema))],
        names=schema.names,
    )
    return spark.createDataFrame(arrow, schema=schema)
