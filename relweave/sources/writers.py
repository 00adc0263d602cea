"""Sinks: overwrite a folder with Parquet, tab-delimited CSV or JSON lines."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def write_parquet(
    df: DataFrame, path: str, mode: str = "overwrite", partition_by: Sequence[str] = ()
) -> None:
    """Parquet; rows bound for one partition folder are first brought together and skew is split."""
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    df.write.mode(mode).partitionBy(*partition_by).parquet(path)


def write_csv(df: DataFrame, path: str, sep: str = "\t", mode: str = "overwrite", **options: str) -> None:
    """Delimited text with a header line."""
    df.write.mode(mode).options(header=True, sep=sep, **options).csv(path)


def write_json(
    df: DataFrame,
    path: str,
    n_files: int | None = None,
    max_records_per_file: int | None = None,
    mode: str = "overwrite",
) -> None:
    """JSON lines for loaders with a file size limit: a file count, or a row bound without a shuffle."""
    if n_files is not None:
        df = df.repartition(n_files)
    writer = df.write.mode(mode)
    if max_records_per_file is not None:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    writer.json(path)
