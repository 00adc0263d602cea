"""Load files that arrive over time: each run takes the new ones and stops."""

from __future__ import annotations

from collections.abc import Callable
from threading import Event

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from relweave.operators.load import load_table
from relweave.operators.spec import TableSpec


def incremental_load(
    spark: SparkSession,
    source: str,
    schema: T.StructType | str,
    spec: TableSpec,
    table: str,
    root: str,
    checkpoint: str,
    build: Callable[[DataFrame], DataFrame] = lambda df: df,
    source_format: str = "json",
) -> None:
    """Upsert the rows of files not seen before, as recorded in ``checkpoint``.

    The table keeps the number of the last batch of this checkpoint that it holds, so a batch that is
    delivered again after a failure changes nothing, whatever its rows.
    """
    started, stream_id = Event(), []

    def upsert(batch: DataFrame, batch_id: int) -> None:
        started.wait()
        load_table(spark, build(batch), spec, table, root, "upsert", batch=(stream_id[0], batch_id))

    stream = spark.readStream.schema(schema).format(source_format).load(source)
    query = (
        stream.writeStream.foreachBatch(upsert)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    stream_id.append(str(query.id))  # written in the checkpoint, so it outlives this process
    started.set()
    query.awaitTermination()
