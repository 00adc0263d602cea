"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Cluster-neutral settings: nothing here fixes a partition count or a memory size.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # the JVM never compiles a method above 8000 bytes; wide projections run faster as split functions
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # no call site recorded per column expression: building a table of eighty columns takes half the time
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app_name: str = "relweave", master: str | None = None, **conf: str) -> SparkSession:
    """Return a session with the library defaults; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = DEFAULT_CONF | {k.replace("__", "."): v for k, v in conf.items()}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_local_scratch: tempfile.TemporaryDirectory | None = None


def scratch_root(spark: SparkSession) -> str:
    """Folder every executor can reach, taken from ``spark.checkpoint.dir``.

    Only a local-mode session may fall back to a folder of this machine: on a cluster a
    machine-local folder would be invisible to the other executors.
    """
    global _local_scratch
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    if _local_scratch is None:
        _local_scratch = tempfile.TemporaryDirectory(prefix="relweave-")
        atexit.register(_local_scratch.cleanup)
    return _local_scratch.name


_made: set[str] = set()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, never reused path below the scratch folder."""
    path = f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"
    _made.add(path)
    return path


def materialise(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` once as Parquet in the scratch folder and read it back.

    Cuts lineage and pins non-deterministic columns; unlike a cache it survives executor loss,
    and unlike an RDD checkpoint the result keeps column pruning and size statistics.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Most bytes of rows that go to a Python worker in one batch (a longer row is alone).
BATCH_BYTES = 15 << 18


def bound_batches(spark: SparkSession) -> None:
    """Send rows to Python workers in batches of about ``BATCH_BYTES``, unless the session has smaller ones.

    By default a batch is 10,000 rows of up to 64 MB. Its buffers double while they grow, in the executor and in
    the worker, and what the executor has taken for them from the C heap stays with it.
    """
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    given = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(name))
    if not 0 < given <= BATCH_BYTES:
        spark.conf.set(name, str(BATCH_BYTES))


def release(spark: SparkSession, path: str) -> None:
    """Delete a folder made by :func:`scratch_path` once its readers are done."""
    if path not in _made:
        raise ValueError(f"{path} is not a scratch folder of this process")
    delete_path(spark, path)
    _made.discard(path)


def release_all(spark: SparkSession) -> None:
    """Delete every scratch folder of this process; frames read from them are unusable afterwards."""
    for path in sorted(_made):
        release(spark, path)


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove a folder on whatever file system it lives on."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
