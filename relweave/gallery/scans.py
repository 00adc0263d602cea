"""File round trips, lookups, projections and filters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from relweave.functions import parse_hours
from relweave.gallery.registry import Tables, query
from relweave.gallery.shapes import HOURS, shape_sql
from relweave.gallery import shapes as S
from relweave.operators import aggregate as A
from relweave.operators import joins as J
from relweave.operators import nested as N
from relweave.operators import relational as R
from relweave.plans import normalise
from relweave.session import scratch_path
from relweave.sources import inline_lookup, read_csv, read_json, read_parquet, write_csv, write_json, write_parquet


@query("SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def json_roundtrip(t: Tables) -> DataFrame:
    source, path = t.customer, scratch_path(t.spark, "json")
    write_json(source, path, max_records_per_file=1_000_000)
    return read_json(t.spark, path, source.schema)


@query("SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM part")
def csv_roundtrip(t: Tables) -> DataFrame:
    source, path = t.part, scratch_path(t.spark, "csv")
    write_csv(source, path)
    return read_csv(t.spark, path, source.schema, sep="\t")


@query("SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders")
def parquet_roundtrip(t: Tables) -> DataFrame:
    source, path = t.orders.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus"), scratch_path(t.spark, "parquet")
    write_parquet(source, path, partition_by=["o_orderstatus"])
    return read_parquet(t.spark, path, source.schema)


TAGS = tuple((f"NATION_{i}", f"T{i % 3}") for i in range(11))


@query(
    "SELECT c_custkey, n_name, tag FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN (VALUES "
    + ", ".join(f"('{n}', '{tag}')" for n, tag in TAGS)
    + ") AS tags(tag_name, tag) ON n_name = tag_name"
)
def inline_lookup_join(t: Tables) -> DataFrame:
    schema = T.StructType([T.StructField("n_name", T.StringType()), T.StructField("tag", T.StringType())])
    nations = J.lookup(t.nation, inline_lookup(t.spark, TAGS, schema), ["n_name"], ["tag"], "inner")
    return J.lookup(t.customer, nations, {"c_nationkey": "n_nationkey"}, ["n_name", "tag"], "inner").select(
        "c_custkey", "n_name", "tag"
    )


@query("SELECT o_orderkey AS order_id, o_totalprice AS price, o_orderdate AS ts FROM orders")
def project_rename(t: Tables) -> DataFrame:
    names = {"o_orderkey": "order_id", "o_totalprice": "price", "o_orderdate": "ts"}
    return R.project(t.orders, list(names), names)


@query("SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM part")
def project_prefix(t: Tables) -> DataFrame:
    priced = t.part.withColumn("size_group", F.col("p_size") % 10)
    return R.project_prefix(priced, "p_")


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority = '2-HIGH' AND o_totalprice IS NOT NULL")
def filter_eq(t: Tables) -> DataFrame:
    wanted = {"o_orderstatus": "F", "o_orderpriority": "2-HIGH"}
    return R.filter_equal(t.orders, wanted, not_null=["o_totalprice"]).select("o_orderkey", "o_custkey")


@query(
    "SELECT c_custkey, c_mktsegment FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY') "
    "AND c_nationkey IN (SELECT s_nationkey FROM supplier WHERE s_acctbal > 5000)"
)
def filter_isin(t: Tables) -> DataFrame:
    rich = t.supplier.where("s_acctbal > 5000").select("s_nationkey")
    segments = R.filter_member(t.customer, "c_mktsegment", ["BUILDING", "MACHINERY"])
    return R.filter_member(segments, "c_nationkey", rich).select("c_custkey", "c_mktsegment")


@query(
    "SELECT c_custkey, CAST(c_custkey % 2 AS BOOLEAN) AS is_open, round(c_acctbal) > 0 AS in_credit FROM customer"
)
def cast_flags(t: Tables) -> DataFrame:
    flag = (F.col("c_custkey") % 2).cast("boolean")
    return t.customer.select("c_custkey", flag.alias("is_open"), (F.round("c_acctbal") > 0).alias("in_credit"))


@query("SELECT DISTINCT l_returnflag, l_linestatus, l_linenumber FROM lineitem")
def distinct_rows(t: Tables) -> DataFrame:
    return A.distinct_rows(t.lineitem, ["l_returnflag", "l_linestatus", "l_linenumber"])


@query(
    "SELECT c_custkey, n_name AS city, c_mktsegment AS segment, c_acctbal AS balance "
    "FROM customer JOIN nation ON c_nationkey = n_nationkey"
)
def struct_expand(t: Tables) -> DataFrame:
    located = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    fields = F.struct(
        F.col("n_name").alias("city"), F.col("c_mktsegment").alias("segment"), F.col("c_acctbal").alias("balance")
    )
    return N.expand_struct(located.select("c_custkey", fields.alias("fields")), "fields", ["c_custkey"])


@query("SELECT p_brand AS brand, p_type AS type, count(*) AS n FROM part GROUP BY 1, 2")
def struct_field_group(t: Tables) -> DataFrame:
    nested = t.part.select(F.struct(F.col("p_brand").alias("brand"), F.col("p_type").alias("type")).alias("fields"))
    return A.group_count(nested, ["fields.brand", "fields.type"], "n")


@query(
    "SELECT 'customer' AS side, c_nationkey AS nation, c_acctbal AS balance FROM customer "
    "UNION ALL SELECT 'supplier', s_nationkey, s_acctbal FROM supplier"
)
def union_tagged(t: Tables) -> DataFrame:
    frames = {
        "customer": R.project(t.customer, ["c_nationkey", "c_acctbal"], {"c_nationkey": "nation", "c_acctbal": "balance"}),
        "supplier": R.project(t.supplier, ["s_nationkey", "s_acctbal"], {"s_nationkey": "nation", "s_acctbal": "balance"}),
    }
    return R.union_tagged(frames, "side")


@query(
    "SELECT c_custkey AS k, c_name AS name, c_acctbal AS balance, NULL::VARCHAR AS region FROM customer "
    "UNION ALL SELECT s_suppkey, s_name, NULL, 'S' || CAST(s_nationkey % 5 AS VARCHAR) FROM supplier"
)
def union_fill_missing(t: Tables) -> DataFrame:
    left = t.customer.selectExpr("c_custkey AS k", "c_name AS name", "c_acctbal AS balance")
    right = t.supplier.selectExpr("s_suppkey AS k", "'S' || CAST(s_nationkey % 5 AS STRING) AS region", "s_name AS name")
    return R.union_fill(left, right)


CLOCK = "CAST(TRY_CAST(split_part(split_part({day}, '-', {side}), ':', 1) AS INTEGER) * 100 + " \
        "TRY_CAST(split_part(split_part({day}, '-', {side}), ':', 2) AS INTEGER) AS INTEGER)"
HOURS_SQL = (
    "SELECT business_id, "
    + ", ".join(
        f"{CLOCK.format(day=d, side=side)} AS {d}_{name}" for d in HOURS for side, name in ((1, "from"), (2, "to"))
    )
    + f" FROM ({shape_sql(S.BUSINESS | HOURS, S.BUSINESS_FROM, 'business_id', *HOURS)})"
)


@query(HOURS_SQL)
def hours_split(t: Tables) -> DataFrame:
    return normalise.business_hours(S.business(t))


@query(f"SELECT business_id, Monday_from, Monday_to, Friday_from, Friday_to FROM ({HOURS_SQL})")
def struct_split(t: Tables) -> DataFrame:
    days = ["Monday", "Friday"]
    raw = N.expand_struct(S.business(t), "hours", ["business_id"]).select("business_id", *days)
    return N.split_structs(raw.withColumns({d: parse_hours(d) for d in days}), days, ["from", "to"])


@query(f"SELECT business_id FROM ({HOURS_SQL}) WHERE Sunday_from <= 2000 AND Sunday_to > 2000")
def open_at(t: Tables) -> DataFrame:
    return R.open_at(normalise.business_hours(S.business(t)), "Sunday_from", "Sunday_to", 2000).select("business_id")


@query(
    f"SELECT business_id FROM ({HOURS_SQL}) WHERE "
    "(Sunday_from <= 130 AND (Sunday_to > 130 OR Sunday_to <= Sunday_from)) "
    "OR (Saturday_to <= Saturday_from AND Saturday_to > 130)"
)
def open_overnight(t: Tables) -> DataFrame:
    return R.open_on(normalise.business_hours(S.business(t)), "Sunday", 130).select("business_id")


