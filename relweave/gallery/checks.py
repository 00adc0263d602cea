"""Load modes, conformance, checks and profiles."""

from __future__ import annotations

import uuid
from dataclasses import replace
from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relweave.gallery.registry import Tables, query
from relweave.gallery.shapes import masked_integer, money_sql
from relweave.operators import load as L
from relweave.operators import quality as Q
from relweave.operators.spec import TableSpec, cast_losses as count_losses, conform, curve_place
from relweave.session import scratch_path
from relweave.sources import read_json_split

ORDERS = TableSpec.of(
    "orders_copy",
    "o_orderkey bigint, o_custkey bigint, o_orderstatus varchar(1), o_totalprice float, o_orderdate timestamp, "
    "o_orderpriority varchar(15)",
    primary_key=("o_orderkey",), incremental_key="o_orderdate", sort_key=("o_orderkey",),
)
COLUMNS = ", ".join(ORDERS.column_names)
BUCKETED = replace(ORDERS, buckets=8)


class _Target:
    """A catalog table under a name of its own, dropped once its result is resolved."""

    def __init__(self, t: Tables):
        self.spark = t.spark
        self.name = f"relweave_{uuid.uuid4().hex}"
        self.root = scratch_path(t.spark, "load")

    def load(self, df: DataFrame, spec: TableSpec, mode: str) -> DataFrame:
        return L.load_table(self.spark, df, spec, self.name, self.root, mode)

    def finish(self) -> DataFrame:
        result = self.spark.table(self.name).drop(L.BUCKET)
        if L.BUCKET in self.spark.table(self.name).columns:  # its partitions are known to the catalog only
            result = self.spark.read.schema(result.schema).parquet(*result.inputFiles())
        result.schema  # resolved here, before the name goes away
        self.spark.sql(f"DROP TABLE {self.name}")
        return result


OLD, NEW = "o_orderdate < TIMESTAMP_NTZ '2000-01-01'", "o_orderdate >= TIMESTAMP_NTZ '2000-01-01'"


@query(
    f"SELECT {COLUMNS} FROM orders WHERE o_orderdate < TIMESTAMP '2000-01-01' UNION ALL "
    "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, NULL FROM orders WHERE o_orderdate >= TIMESTAMP '2000-01-01'"
)
def load_append(t: Tables) -> DataFrame:
    target = _Target(t)
    target.load(t.orders.where(OLD), ORDERS, "append")
    target.load(t.orders.where(NEW).drop("o_orderpriority"), ORDERS, "append")
    return target.finish()


@query("SELECT o_orderkey, CAST(o_orderdate AS DATE) AS o_orderdate, o_orderpriority FROM orders WHERE o_orderdate >= TIMESTAMP '2000-01-01'")
def load_rebuild(t: Tables) -> DataFrame:
    target = _Target(t)
    target.load(t.orders.where(OLD), ORDERS, "rebuild")
    slim = TableSpec.of("orders_copy", "o_orderkey bigint, o_orderdate date, o_orderpriority varchar(15)")
    target.load(t.orders.where(NEW), slim, "rebuild")
    return target.finish()


@query("SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, NULL::VARCHAR AS o_orderpriority FROM orders WHERE o_orderdate >= TIMESTAMP '2000-01-01'")
def load_truncate(t: Tables) -> DataFrame:
    target = _Target(t)
    target.load(t.orders.where(OLD), ORDERS, "truncate")
    slim = TableSpec.of("orders_copy", "o_orderkey bigint, o_totalprice float")
    target.load(t.orders.where(NEW).drop("o_orderpriority"), slim, "truncate")
    return target.finish()


# The batch delivers the orders since 1998 again: finished ones a day newer, pending ones a day older,
# open ones with the same date, and orders without a priority with no date. Low ones come twice.
def _batch_sql(source: str) -> str:
    changed = (
        "CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN NULL WHEN o_orderstatus = 'F' THEN o_orderdate + INTERVAL '1' DAY "
        "WHEN o_orderstatus = 'P' THEN o_orderdate - INTERVAL '1' DAY ELSE o_orderdate END"
    )
    once = (
        f"SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice + 1000000 AS o_totalprice, {changed} AS o_orderdate "
        f"FROM {source} WHERE o_orderdate >= CAST('1998-01-01' AS DATE)"
    )
    return f"{once} UNION ALL {once} AND o_orderpriority = '5-LOW'"


@query(
    f"WITH dst AS (SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '2000-01-01'), src AS ({_batch_sql('orders')}), "
    "kept AS (SELECT * FROM dst WHERE NOT EXISTS (SELECT 1 FROM src WHERE src.o_orderkey = dst.o_orderkey AND src.o_orderdate >= dst.o_orderdate)) "
    f"SELECT {COLUMNS} FROM kept UNION ALL SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, NULL FROM src "
    "WHERE NOT EXISTS (SELECT 1 FROM kept WHERE src.o_orderkey = kept.o_orderkey AND kept.o_orderdate >= src.o_orderdate)"
)
def load_upsert(t: Tables) -> DataFrame:
    target = _Target(t)
    target.load(t.orders.where(OLD), BUCKETED, "rebuild")
    target.load(t.spark.sql(_batch_sql("{orders}"), orders=t.orders), BUCKETED, "upsert")
    return target.finish()


@query(
    "SELECT TRY_CAST(o_custkey AS INTEGER) AS o_custkey, CAST(o_orderdate AS DATE) AS o_orderdate, CAST(o_orderkey AS VARCHAR) AS o_orderkey, "
    "NULL::BOOLEAN AS is_gift, TRY_CAST(o_orderpriority AS INTEGER) AS o_orderpriority FROM orders"
)
def conform_schema(t: Tables) -> DataFrame:
    spec = TableSpec.of(
        "typed", "o_custkey integer, o_orderdate date, o_orderkey varchar(12), is_gift boolean, o_orderpriority integer"
    )
    return conform(t.orders, spec)


@query(
    f"WITH raw AS (SELECT {masked_integer('p_partkey')} AS size, p_brand AS brand FROM part) "
    "SELECT 'size' AS \"column\", count(*) FILTER (size IS NOT NULL AND TRY_CAST(size AS INTEGER) IS NULL) AS n_lost FROM raw "
    "UNION ALL SELECT 'brand', count(*) FILTER (brand IS NOT NULL AND TRY_CAST(brand AS BIGINT) IS NULL) FROM raw"
)
def cast_losses(t: Tables) -> DataFrame:
    raw = t.part.selectExpr(f"{masked_integer('p_partkey')} AS size", "p_brand AS brand")
    return count_losses(raw, TableSpec.of("raw", "size integer, brand bigint"))


def _check_sql(name: str, table: str, observed: str, expected: float, test: str) -> str:
    return (
        f"SELECT '{name}' AS \"check\", '{table}' AS \"table\", CAST({observed} AS DOUBLE) AS observed, CAST({expected} AS DOUBLE) AS expected, "
        f"CAST({{tolerance}} AS DOUBLE) AS tolerance, {test.format(observed=observed)} AS passed FROM {table}"
    )


@query(
    " UNION ALL ".join(
        [
            _check_sql("nations", "nation", "count(*)", 25, "{observed} = 25").format(tolerance="NULL"),
            _check_sql("lines", "lineitem", "count(*)", 60000, "{observed} = 60000").format(tolerance="NULL"),
            _check_sql("quantities", "lineitem", "max(l_quantity)", 49, "{observed} = 49").format(tolerance="NULL"),
        ]
    )
)
def check_value(t: Tables) -> DataFrame:
    checks = [
        Q.ValueCheck("nations", "nation", 25),
        Q.ValueCheck("lines", "lineitem", 60000),
        Q.ValueCheck("quantities", "lineitem", 49, "max(l_quantity)"),
    ]
    return Q.run_checks({"nation": t.nation, "lineitem": t.lineitem}, checks)


@query(
    " UNION ALL ".join(
        [
            _check_sql("near", "orders", "count(*)", 14000, "{observed} BETWEEN 14000 * 0.9 AND 14000 * 1.1").format(tolerance="0.1"),
            _check_sql("far", "orders", "count(*)", 14000, "{observed} BETWEEN 14000 * 0.99 AND 14000 * 1.01").format(tolerance="0.01"),
        ]
    )
)
def check_value_tolerance(t: Tables) -> DataFrame:
    checks = [
        Q.ValueCheck("near", "orders", 14000, tolerance=0.1),
        Q.ValueCheck("far", "orders", 14000, tolerance=0.01),
    ]
    return Q.run_checks({"orders": t.orders}, checks)


@query(
    "SELECT 'filled' AS \"check\", count(*) <> 0 AND max(c_name) <> '' AND bool_or(c_acctbal > 0) AS passed FROM customer "
    "UNION ALL SELECT 'balanced', count(*) FILTER (c_acctbal < -1000000) <> 0 FROM customer"
)
def check_truthy(t: Tables) -> DataFrame:
    filled = t.customer.agg(
        F.count(F.lit(1)).alias("n"), F.max("c_name").alias("name"), F.bool_or(F.col("c_acctbal") > 0).alias("credit")
    )
    balanced = t.customer.agg(F.count_if(F.col("c_acctbal") < -1000000).alias("n"))
    return Q.check_truthy(filled, "filled").unionByName(Q.check_truthy(balanced, "balanced"))


def _metric_sql(name: str, expression: str, threshold: float) -> str:
    now, then = (
        f"(SELECT CAST({expression} AS DOUBLE) FROM events WHERE CAST(ts AS DATE) = DATE '{day}')" for day in ("2024-01-15", "2024-01-08")
    )
    return (
        f"SELECT '{name}' AS metric, now AS observed, prior AS reference, greatest(now, prior) / least(now, prior) AS ratio, "
        f"CAST({threshold} AS DOUBLE) AS threshold, greatest(now, prior) / least(now, prior) < {threshold} AS passed "
        f"FROM (SELECT {now} AS now, {then} AS prior)"
    )


@query(
    " UNION ALL ".join(
        [
            _metric_sql("rows", "count(*)", 1.5),
            _metric_sql("users", "count(DISTINCT user_id)", 1.0001),
            _metric_sql("total", money_sql("value"), 2),
        ]
    )
)
def check_interval(t: Tables) -> DataFrame:
    metrics = {
        "rows": ("count(*)", 1.5),
        "users": ("count(DISTINCT user_id)", 1.0001),
        "total": ("sum(CAST(value AS DECIMAL(18,2)))", 2),
    }
    return Q.check_interval(t.events, metrics, "2024-01-15", "ts")


@query(
    "SELECT 'p_name' AS \"column\", 12 AS bound, CAST(max(length(p_name)) AS INTEGER) AS max_length, max(length(p_name)) <= 12 AS passed FROM part "
    "UNION ALL SELECT 'p_brand', 6, CAST(max(length(p_brand)) AS INTEGER), max(length(p_brand)) <= 6 FROM part"
)
def check_varchar(t: Tables) -> DataFrame:
    return Q.length_violations(t.part, {"p_name": 12, "p_brand": 6})


@query("SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def pk_duplicates(t: Tables) -> DataFrame:
    return Q.primary_key_violations(t.lineitem, ["l_orderkey", "l_linenumber"])


LINE_COLUMNS = (
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
    "l_returnflag", "l_linestatus", "l_shipdate",
)


@query(
    " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(*) AS n_rows, count(*) - count({c}) AS n_nulls FROM lineitem"
        for c in LINE_COLUMNS if c != "l_returnflag"
    )
    + " UNION ALL SELECT 'l_returnflag', count(*), count(*) FILTER (l_returnflag = 'N') FROM lineitem"
)
def profile_nulls(t: Tables) -> DataFrame:
    return Q.profile_nulls(t.lineitem.withColumn("l_returnflag", F.nullif("l_returnflag", F.lit("N"))))


@query(
    " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", CAST(max(length({c})) AS INTEGER) AS max_length FROM part" for c in ("p_name", "p_brand", "p_type")
    )
)
def profile_strlen(t: Tables) -> DataFrame:
    return Q.profile_lengths(t.part)


@query(
    " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", '{kind}' AS type, count(*) AS n_rows, count(*) - count({c}) AS n_nulls, "
        + (f"CAST(max(length({c})) AS INTEGER)" if kind == "string" else "NULL::INTEGER")
        + " AS max_length FROM customer"
        for c, kind in (
            ("c_custkey", "bigint"), ("c_name", "string"), ("c_nationkey", "int"), ("c_acctbal", "double"), ("c_mktsegment", "string"),
        )
    )
)
def profile_table(t: Tables) -> DataFrame:
    return Q.describe(t.customer)


KEY_COLUMNS = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_returnflag")
KEY_SETS = [c for n in (1, 2, 3) for c in combinations(KEY_COLUMNS, n)]


def _is_key(columns) -> str:
    return "k_" + "_".join(str(KEY_COLUMNS.index(c)) for c in columns)


@query(
    "WITH counted AS (SELECT "
    + ", ".join(f"count(DISTINCT ({', '.join(s)},)) = count(*) AS {_is_key(s)}" for s in KEY_SETS)
    + " FROM lineitem) "
    + " UNION ALL ".join(
        f"SELECT '{','.join(s)}' AS columns, CAST({len(s)} AS INTEGER) AS width FROM counted WHERE {_is_key(s)}"
        + "".join(f" AND NOT {_is_key(part)}" for n in range(1, len(s)) for part in combinations(s, n))
        for s in KEY_SETS
    )
)
def candidate_keys(t: Tables) -> DataFrame:
    return Q.candidate_keys(t.lineitem, KEY_COLUMNS, 3)


DEPENDENT = ("n_name", "n_regionkey", "c_acctbal", "c_mktsegment", "zone")
PLACED_SQL = "SELECT *, CASE WHEN c_custkey % 3 > 0 THEN n_regionkey END AS zone FROM customer JOIN nation ON c_nationkey = n_nationkey"


@query(
    " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(*) AS n_groups, count(*) FILTER (low <> high OR (0 < n AND n < n_rows)) AS n_varying FROM "
        f"(SELECT min({c}) AS low, max({c}) AS high, count({c}) AS n, count(*) AS n_rows FROM ({PLACED_SQL}) GROUP BY c_nationkey)"
        for c in DEPENDENT
    )
)
def dependency_violations(t: Tables) -> DataFrame:
    placed = t.spark.sql(PLACED_SQL.replace("customer", "{customer}").replace("JOIN nation", "JOIN {nation}"), customer=t.customer, nation=t.nation)
    return Q.dependency_violations(placed, ["c_nationkey"], DEPENDENT)


LINE_SQL = (
    "'{\"c_custkey\":' || CAST(c_custkey AS {text}) || CASE WHEN c_custkey % 11 = 0 THEN ',\"c_name\":' "
    "WHEN c_custkey % 13 = 0 THEN ',\"c_nationkey\":\"none\"}}' ELSE ',\"c_name\":\"' || c_name || '\"}}' END"
)


def _line_sql(kind: str) -> str:
    return LINE_SQL.replace("{text}", kind).replace("}}", "}")


@query(
    f"SELECT CASE WHEN bad THEN NULL ELSE c_custkey END AS c_custkey, CASE WHEN bad THEN NULL ELSE c_name END AS c_name, CASE WHEN bad THEN line END AS line "
    f"FROM (SELECT *, c_custkey % 11 = 0 OR c_custkey % 13 = 0 AS bad, {_line_sql('VARCHAR')} AS line FROM customer)"
)
def json_rejects(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "lines")
    t.customer.selectExpr(f"{_line_sql('STRING')} AS value").write.text(path)
    rows, rejected = read_json_split(t.spark, path, "c_custkey long, c_name string, c_nationkey int")
    return rows.drop("c_nationkey").unionByName(rejected, allowMissingColumns=True)


CURVE_COLUMNS, CURVE_BITS = ("o_custkey", "o_totalprice"), 4
CURVE_RANGES = {
    c: "[" + ", ".join(f"quantile_disc({c}, {i / (1 << CURVE_BITS)})" for i in range(1, 1 << CURVE_BITS)) + "]" for c in CURVE_COLUMNS
}


@query(
    "WITH bounds AS (SELECT " + ", ".join(f"{ranges} AS {c}_ranges" for c, ranges in CURVE_RANGES.items()) + " FROM orders), "
    "placed AS (SELECT o_orderkey, " + ", ".join(f"len(list_filter({c}_ranges, lambda b: b <= {c})) AS {c}_n" for c in CURVE_COLUMNS)
    + " FROM orders, bounds) SELECT o_orderkey, CAST("
    + " + ".join(
        f"(({c}_n >> {bit}) & 1) * {1 << (bit * len(CURVE_COLUMNS) + len(CURVE_COLUMNS) - 1 - i)}"
        for i, c in enumerate(CURVE_COLUMNS) for bit in range(CURVE_BITS)
    )
    + " AS BIGINT) AS place FROM placed"
)
def layout_interleaved(t: Tables) -> DataFrame:
    # an accuracy above the number of rows makes the quantiles exact, as the SQL has them
    return t.orders.select("o_orderkey", curve_place(t.orders, CURVE_COLUMNS, CURVE_BITS, accuracy=10_000_000).alias("place"))


@query(None)
def profile_sample(t: Tables) -> DataFrame:
    return Q.sample_rows(t.lineitem, 20)
