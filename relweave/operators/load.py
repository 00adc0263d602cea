"""Load modes for Parquet tables of the session catalog.

Each load that replaces rows writes a fresh folder first and then points the table at it, so that a
table can be read while its successor is computed from it, a failed job leaves the table as it was,
and no reader sees it half written. No load deletes a file of the table: readers that planned before the
switch finish on the old files, and :func:`delete_unused` removes folders that the table no longer names.

A table has one writer at a time: two loads that run at once would both start from the same rows.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from relweave.operators.joins import newest_wins
from relweave.operators.relational import missing_columns, union_fill
from relweave.operators.spec import TableSpec, conform, lay_out
from relweave.session import delete_path

LOAD_MODES = ("append", "rebuild", "truncate", "upsert")
BUCKET = "_bucket"  # partition column of tables with ``TableSpec.buckets``
APPLIED = "relweave.applied."  # table property: last batch of a stream that is in the table


class LoadRejected(ValueError):
    """The staged rows broke a check; the table is as it was."""


def load_table(
    spark: SparkSession,
    df: DataFrame,
    spec: TableSpec,
    table: str,
    root: str,
    mode: str = "append",
    primary_key: Sequence[str] = (),
    incremental_key: str | None = None,
    checks: Mapping[str, str] | None = None,
    batch: tuple[str, int] | None = None,
) -> DataFrame:
    """Load ``df`` into ``table`` and return the table as it is afterwards.

    ``append`` adds the rows; ``rebuild`` replaces table and definition by those of the spec; ``truncate``
    replaces the rows but keeps the stored definition; ``upsert`` keeps the newest row per key. All but
    ``rebuild`` create the table when it does not exist. ``root`` is the folder for its data.

    An upsert into a table with ``spec.buckets`` reads and rewrites the buckets of the batch's keys only.
    ``checks`` are conditions over the written rows (``{"rows": "count(*) > 0"}``), gathered while they are
    staged; if one is not true the load is refused. ``batch`` (stream, number) applies a batch once: the
    number is kept with the table, and a batch that was broken off half way is finished, not repeated.
    """
    mode = mode.lower()
    if mode not in LOAD_MODES:
        raise ValueError(f"load mode {mode!r} is none of {LOAD_MODES}")
    keys = tuple(primary_key) or spec.primary_key
    incremental = incremental_key or spec.incremental_key
    if mode == "upsert" and not (keys and incremental):
        raise ValueError(f"upsert into {table} needs a primary key and an incremental key")
    _recover(spark, table)
    if batch and applied_batch(spark, table, batch[0]) >= batch[1]:
        return _rows(spark, table)
    label = f"{batch[0]}-{batch[1]}-" if batch else ""

    if mode == "rebuild":
        staged = _stage(conform(df, spec), spec, root, checks, label)
        _replace(spark, spec, table, staged)
    else:
        create_if_missing(spark, spec, table, root)
        stored = _rows(spark, table)
        if mode == "append":
            if checks:
                staged = _stage(conform(df, stored.schema), spec, root, checks, label)
                df = spark.read.schema(stored.schema).parquet(staged)
            lay_out(_dealt(conform(df, stored.schema), spec), spec).write.insertInto(table)
        elif mode == "upsert" and spec.buckets:
            _switch_buckets(spark, df, spec, table, root, keys, incremental, checks, label)
        else:
            rows = df if mode == "truncate" else newest_wins(stored, df, keys, incremental)
            if not (label and label in _location(spark, table)):
                staged = _stage(conform(rows, stored.schema), spec, root, checks, label)
                if spec.buckets:
                    _replace(spark, spec, table, staged)
                else:
                    spark.sql(f"ALTER TABLE {table} SET LOCATION '{staged}'")
    spark.catalog.refreshTable(table)
    if batch:
        spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('{APPLIED}{batch[0]}' = '{batch[1]}')")
    return _rows(spark, table)


def length_checks(spec: TableSpec) -> dict[str, str]:
    """A check for every text column with a declared length."""
    bounded = [c for c in spec.columns if c.max_length is not None]
    return {f"{c.name} length": f"coalesce(max(length(`{c.name}`)), 0) <= {c.max_length}" for c in bounded}


def applied_batch(spark: SparkSession, table: str, stream: str) -> int:
    """Number of the stream's last batch that is in the table, -1 for none."""
    if not spark.catalog.tableExists(table):
        return -1
    rows = spark.sql(f"SHOW TBLPROPERTIES {table}").where(F.col("key") == APPLIED + stream).collect()
    return int(rows[0]["value"]) if rows else -1


def create_if_missing(spark: SparkSession, spec: TableSpec, table: str, root: str) -> None:
    """Create an empty table with the declared columns and layout unless it exists."""
    if not spark.catalog.tableExists(table):
        _create(spark, spec, table, _fresh(root))


def reconcile_columns(spark: SparkSession, spec: TableSpec, table: str) -> list[str]:
    """Add declared columns that the stored table lacks; returns their names."""
    new = missing_columns(spark.table(table), spec.column_names)
    types = {c.name: c.spark_type.simpleString() for c in spec.columns}
    if new:
        columns = ", ".join(f"`{c}` {types[c]}" for c in new)
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({columns})")
    return new


def append_rows(target: DataFrame, source: DataFrame, spec: TableSpec | None = None) -> DataFrame:
    """Append as a pure transformation, filling columns the source lacks."""
    return union_fill(target, conform(source, spec) if spec else source)


def bucket_number(spec: TableSpec, keys: Sequence[str] = ()) -> Column:
    """The bucket of a row, from its key in the declared types."""
    return F.pmod(F.xxhash64(*(keys or spec.primary_key)), F.lit(spec.buckets)).cast("int")


def upsert_buckets(
    spark: SparkSession, df: DataFrame, spec: TableSpec, table: str, keys: Sequence[str], incremental: str, skip: Sequence[int] = ()
) -> tuple[list[int], DataFrame]:
    """The buckets that a batch touches, and the rows these have after it. Other partitions are not scanned.

    The list is at most ``spec.buckets`` long. Buckets in ``skip`` are left out.
    """
    stored = spark.table(table)
    schema = stored.drop(BUCKET).schema
    placed = conform(df, schema).withColumn(BUCKET, bucket_number(spec, keys))
    touched = sorted({r[0] for r in placed.select(BUCKET).distinct().collect()} - set(skip))
    placed = placed.where(F.col(BUCKET).isin(touched))
    before = stored.where(F.col(BUCKET).isin(touched))
    return touched, newest_wins(before.drop(BUCKET), placed.drop(BUCKET), keys, incremental)


def _switch_buckets(spark, df, spec, table, root, keys, incremental, checks, label) -> None:
    known = {int(r[0].split("=")[1]) for r in spark.sql(f"SHOW PARTITIONS {table}").collect()}
    done = [b for b in sorted(known) if label and label in _location(spark, table, b)]
    touched, rows = upsert_buckets(spark, df, spec, table, keys, incremental, done)
    if not touched:
        return
    staged = _stage(rows, spec, root, checks, label)
    for b in touched:
        place = f"PARTITION ({BUCKET}={b})"
        if b in known:
            spark.sql(f"ALTER TABLE {table} {place} SET LOCATION '{staged}/{BUCKET}={b}'")
        else:
            spark.sql(f"ALTER TABLE {table} ADD {place} LOCATION '{staged}/{BUCKET}={b}'")


def delete_unused(spark: SparkSession, table: str, root: str) -> list[str]:
    """Delete the load folders below ``root`` that neither the table nor a partition of it names; returns them.

    To be called when no reader that began before the last load is left.
    """
    used = [_location(spark, table)]
    if BUCKET in spark.table(table).columns:
        used += [_location(spark, table, r[0].split("=")[1]) for r in spark.sql(f"SHOW PARTITIONS {table}").collect()]
    names = {part for path in used for part in path.split("/") if part.startswith("load-")}
    target = spark._jvm.org.apache.hadoop.fs.Path(root)
    files = target.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(target)
    found = [f.getPath() for f in files if f.getPath().getName().startswith("load-")]
    unused = sorted(str(p) for p in found if p.getName() not in names)
    for path in unused:
        delete_path(spark, path)
    return unused


def _fresh(root: str, label: str = "") -> str:
    return f"{root.rstrip('/')}/load-{label}{uuid.uuid4().hex}"


def _dealt(df: DataFrame, spec: TableSpec) -> DataFrame:
    """``df`` with its bucket as last column, if the table has buckets."""
    return df.drop(BUCKET).withColumn(BUCKET, bucket_number(spec)) if spec.buckets else df


def _stage(df: DataFrame, spec: TableSpec, root: str, checks: Mapping[str, str] | None = None, label: str = "") -> str:
    """Write the rows in the table's layout to a fresh folder; the checks are gathered on the way."""
    path = _fresh(root, label)
    rows = _dealt(df, spec)
    if checks:
        seen = Observation()
        rows = rows.observe(seen, *[F.expr(test).alias(f"c{i}") for i, test in enumerate(checks.values())])
    if spec.buckets:
        rows = lay_out(rows.hint("rebalance", BUCKET), TableSpec(spec.name, spec.columns, sort_key=(*spec.sort_key,)))
        rows.write.partitionBy(BUCKET).parquet(path)
    elif spec.dist_buckets:
        # only a table can be written in buckets: this one is dropped again and its files stay
        name = f"relweave_staged_{uuid.uuid4().hex}"
        parts = rows.repartition(spec.dist_buckets, spec.dist_key).write.bucketBy(spec.dist_buckets, spec.dist_key)
        parts = parts.sortBy(*spec.sort_key) if spec.sort_key else parts
        parts.option("path", path).format("parquet").saveAsTable(name)
        df.sparkSession.sql(f"DROP TABLE {name}")
    else:
        lay_out(rows, spec).write.parquet(path)
    if checks:
        values = seen.get
        broken = [name for i, name in enumerate(checks) if not values[f"c{i}"]]
        if broken:
            delete_path(df.sparkSession, path)
            raise LoadRejected(f"the rows broke {broken}")
    return path


def _create(spark: SparkSession, spec: TableSpec, table: str, path: str) -> None:
    columns = [f"`{c.name}` {c.spark_type.simpleString()}" for c in spec.columns]
    layout = ""
    if spec.buckets:
        columns.append(f"{BUCKET} int")
        layout = f"PARTITIONED BY ({BUCKET})"
    elif spec.dist_buckets:
        order = f"SORTED BY ({', '.join(f'`{c}`' for c in spec.sort_key)})" if spec.sort_key else ""
        layout = f"CLUSTERED BY (`{spec.dist_key}`) {order} INTO {spec.dist_buckets} BUCKETS"
    spark.sql(f"CREATE TABLE {table} ({', '.join(columns)}) USING parquet {layout} LOCATION '{path}'")


def _replace(spark: SparkSession, spec: TableSpec, table: str, staged: str) -> None:
    """Put a table over the staged folder in the place of ``table``. At every step one of the two is whole."""
    following, last = f"{table}__next", f"{table}__last"
    spark.sql(f"DROP TABLE IF EXISTS {following}")
    spark.sql(f"DROP TABLE IF EXISTS {last}")
    _create(spark, spec, following, staged)
    if spec.buckets:
        spark.sql(f"ALTER TABLE {following} RECOVER PARTITIONS")
    if spark.catalog.tableExists(table):
        spark.sql(f"ALTER TABLE {table} RENAME TO {last}")
    spark.sql(f"ALTER TABLE {following} RENAME TO {table}")
    spark.sql(f"DROP TABLE IF EXISTS {last}")


def _recover(spark: SparkSession, table: str) -> None:
    """Undo a replacement that was broken off between its two renames."""
    if not spark.catalog.tableExists(table) and spark.catalog.tableExists(f"{table}__last"):
        spark.sql(f"ALTER TABLE {table}__last RENAME TO {table}")


def _rows(spark: SparkSession, table: str) -> DataFrame:
    return spark.table(table).drop(BUCKET)


def _location(spark: SparkSession, table: str, bucket: int | str | None = None) -> str:
    part = f" PARTITION ({BUCKET}={bucket})" if bucket is not None else ""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}{part}").where("col_name = 'Location'").collect()
    return rows[0]["data_type"]
