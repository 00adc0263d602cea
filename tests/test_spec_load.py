import json
import os

import pytest
from pyspark.sql import functions as F

from relweave.operators.joins import newest_wins
from relweave.operators.load import (
    LOAD_MODES, LoadRejected, append_rows, applied_batch, create_if_missing, delete_unused, length_checks, load_table, reconcile_columns,
    upsert_buckets,
)
from relweave.operators.spec import (
    TableSpec, cast_losses, conform, lay_out, load_order, read_specs, schema_difference, stored_columns,
)
from relweave.plans.schemas import target_specs
from relweave.session import materialise, release, scratch_path, scratch_root
from relweave.sources import inline_lookup, read_csv, read_json, write_csv, write_json, write_parquet

ENTRIES = [
    {
        "table_name": "Orders", "s3_key": "orders",
        "origin_schema": [{"name": "id", "type": "varchar(22)"}, {"name": "who", "type": "int4"}, {"name": "ts", "type": "timestamp"},
                          {"name": "price", "type": "float"}, {"name": "big", "type": "bigint"}, {"name": "ok", "type": "boolean"}],
        "primary_key": "id", "incremental_key": "ts", "distkey": "who", "sortkey": ["who", "ts"],
        "foreign_key": {"column_name": "who", "reftable": "people", "ref_column": "person"},
    },
    {
        "table_name": "people", "origin_schema": [{"name": "person", "type": "int"}, {"name": "day", "type": "date"}],
        "primary_key": ["person", "day"],
    },
]


@pytest.mark.parametrize("suffix", [".json", ".yml"])
def test_read_specs(tmp_path, suffix):
    if suffix == ".yml":
        yaml = pytest.importorskip("yaml")
    path = tmp_path / f"tables{suffix}"
    path.write_text(json.dumps(ENTRIES) if suffix == ".json" else yaml.safe_dump(ENTRIES))
    specs = read_specs(path)
    assert list(specs) == ["orders", "people"]
    orders = specs["orders"]
    assert orders.primary_key == ("id",) and orders.sort_key == ("who", "ts") and orders.dist_key == "who"
    assert orders.foreign_keys[0].ref_table == "people" and orders.columns[0].max_length == 22
    assert orders.struct_type.simpleString() == "struct<id:string,who:int,ts:timestamp_ntz,price:double,big:bigint,ok:boolean>"
    assert load_order(specs.values()) == ["people", "orders"]


@pytest.mark.parametrize(
    "change, message",
    [
        ({"origin_schema": None}, "origin_schema is missing"),
        ({"primary_key": "nope"}, "undeclared columns"),
        ({"distkey": "who,id"}, "one distribution key"),
        ({"sort_type": "random"}, "sort type"),
        ({"foreign_key": "who"}, "mapping"),
        ({"origin_schema": [{"name": "a", "type": "int"}, {"name": "a", "type": "int"}], "primary_key": None, "incremental_key": None,
          "distkey": None, "sortkey": None, "foreign_key": None}, "declared twice"),
    ],
)
def test_bad_specs(change, message):
    with pytest.raises(ValueError, match=message):
        TableSpec.from_dict(ENTRIES[0] | change)


def test_specs_through_the_session_and_decimals(spark, tmp_path):
    path = tmp_path / "tables.json"
    path.write_text(json.dumps({"prices": {"origin_schema": [{"name": "p", "type": "decimal(12, 2)"}, {"name": "q", "type": "numeric"}]}}))
    spec = read_specs(path.as_uri(), spark)["prices"]
    assert spec.struct_type.simpleString() == "struct<p:decimal(12,2),q:decimal(18,0)>"
    assert TableSpec.of("t", "a decimal(3, 1), b int").struct_type.simpleString() == "struct<a:decimal(3,1),b:int>"


def test_unknown_type():
    with pytest.raises(ValueError, match="unknown type"):
        TableSpec.of("t", "a geometry").struct_type


def test_conform(spark, rows):
    df = spark.createDataFrame([("1", "x", 7), ("no", None, 8)], "a string, b string, extra int")
    spec = TableSpec.of("t", "b varchar(3), a int, c date")
    out = conform(df, spec)
    assert out.schema == spec.struct_type
    assert rows(out) == [("x", 1, None), (None, None, None)] or rows(out) == sorted([("x", 1, None), (None, None, None)], key=repr)
    assert rows(cast_losses(df, spec)) == [("a", 1), ("b", 0)]
    assert schema_difference(df, spec) == [
        ("a", "type", "int", "string"), ("c", "missing", "date", None), ("extra", "undeclared", None, "int"),
    ]
    with pytest.raises(ValueError, match="missing from the data"):
        conform(df, spec, on_missing="error")


SPEC = TableSpec.of("t", "k bigint, ik bigint, v varchar(9)", primary_key=("k",), incremental_key="ik", dist_key="k", sort_key=("k",))


def make(spark, data, schema="k bigint, ik bigint, v string"):
    return spark.createDataFrame(data, schema)


@pytest.fixture
def table(spark, fresh):
    name = "t_" + os.path.basename(fresh("x").rsplit("/", 2)[-2]).replace("-", "_").replace("[", "_").replace("]", "_")
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    yield name
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_append_creates_then_adds(spark, rows, fresh, table):
    load_table(spark, make(spark, [(1, 1, "a")]), SPEC, table, fresh("data"), "APPEND")
    out = load_table(spark, make(spark, [(2, 1)], "k bigint, ik bigint"), SPEC, table, fresh("data"), "append")
    assert rows(out) == [(1, 1, "a"), (2, 1, None)]
    assert stored_columns(spark, table) == [("k", "bigint"), ("ik", "bigint"), ("v", "string")]


def test_rebuild_takes_the_new_definition(spark, rows, fresh, table):
    load_table(spark, make(spark, [(1, 1, "a")]), SPEC, table, fresh("data"), "rebuild")
    slim = TableSpec.of("t", "v varchar(9), k int")
    out = load_table(spark, make(spark, [(2, 1, "b")]), slim, table, fresh("data"), "rebuild")
    assert rows(out) == [("b", 2)]
    assert stored_columns(spark, table) == [("v", "string"), ("k", "int")]
    assert len(os.listdir(fresh("data"))) == 2  # a load deletes nothing under readers
    assert len(delete_unused(spark, table, fresh("data"))) == 1
    assert len(os.listdir(fresh("data"))) == 1 and rows(spark.table(table)) == [("b", 2)]


def test_truncate_keeps_the_stored_definition(spark, rows, fresh, table):
    load_table(spark, make(spark, [(1, 1, "a")]), SPEC, table, fresh("data"), "truncate")
    out = load_table(spark, make(spark, [("5", "b")], "k string, v string"), TableSpec.of("t", "k int"), table, fresh("data"), "truncate")
    assert rows(out) == [(5, None, "b")]
    assert stored_columns(spark, table)[0] == ("k", "bigint")


def test_truncate_from_the_table_itself(spark, rows, fresh, table):
    load_table(spark, make(spark, [(1, 1, "a"), (2, 2, "b")]), SPEC, table, fresh("data"), "rebuild")
    out = load_table(spark, spark.table(table).where("k = 2"), SPEC, table, fresh("data"), "truncate")
    assert rows(out) == [(2, 2, "b")]


def test_upsert(spark, rows, fresh, table):
    target = [(1, 5, "t"), (2, 5, "t"), (3, 5, "t"), (4, None, "t"), (5, 5, "t")]
    batch = [(1, 6, "newer"), (2, 4, "older"), (3, 5, "tie"), (4, 9, "null"), (6, 1, "new"), (7, 1, "twin"), (7, 1, "twin"), (5, None, "nil")]
    load_table(spark, make(spark, target), SPEC, table, fresh("data"), "rebuild")
    out = load_table(spark, make(spark, batch), SPEC, table, fresh("data"), "upsert")
    assert rows(out) == sorted(
        [(1, 6, "newer"), (2, 5, "t"), (3, 5, "tie"), (4, None, "t"), (4, 9, "null"), (5, 5, "t"), (5, None, "nil"), (6, 1, "new"),
         (7, 1, "twin"), (7, 1, "twin")], key=repr)


def test_upsert_needs_keys_and_modes_are_checked(spark, fresh, table):
    plain = TableSpec.of("t", "k bigint, ik bigint, v varchar(9)")
    with pytest.raises(ValueError, match="needs a primary key"):
        load_table(spark, make(spark, []), plain, table, fresh("data"), "Upsert")
    with pytest.raises(ValueError, match="load mode"):
        load_table(spark, make(spark, []), plain, table, fresh("data"), "merge")
    assert set(LOAD_MODES) == {"append", "rebuild", "truncate", "upsert"}


def test_a_failed_load_leaves_the_table(spark, rows, fresh, table):
    load_table(spark, make(spark, [(1, 1, "a")]), SPEC, table, fresh("data"), "rebuild")
    broken = make(spark, [(2, 2, "b")]).withColumn("v", F.raise_error(F.lit("boom")).cast("string"))
    for mode in ("rebuild", "truncate", "upsert"):
        with pytest.raises(Exception, match="boom"):
            load_table(spark, broken, SPEC, table, fresh("data"), mode)
        assert rows(spark.table(table)) == [(1, 1, "a")]


BUCKETED = TableSpec.of(
    "t", "k bigint, ik bigint, v varchar(9)", primary_key=("k",), incremental_key="ik", sort_key=("k",), buckets=16)


def files(folder):
    return {os.path.join(d, f) for d, _, names in os.walk(folder) for f in names if f.endswith(".parquet")}


@pytest.mark.parametrize("first", ["rebuild", "truncate", "append", "upsert"])
def test_upsert_rewrites_the_buckets_of_its_keys(spark, rows, fresh, table, first):
    target = [(i, 5 if i % 7 else None, f"t{i}") for i in range(200)]
    batch = [(3, 6, "newer"), (4, 4, "older"), (7, 9, "null"), (500, 1, "new"), (500, 1, "new"), (8, None, "nil")]
    load_table(spark, make(spark, target), BUCKETED, table, fresh("data"), first)
    before = set(spark.table(table).inputFiles())
    plain = newest_wins(make(spark, target), make(spark, batch), ["k"], "ik")
    touched, after = upsert_buckets(spark, make(spark, batch), BUCKETED, table, ["k"], "ik")
    assert 0 < len(touched) <= 5
    scanned = {f.split("_bucket=")[1].split("/")[0] for f in after.inputFiles() if "_bucket=" in f}
    assert scanned <= set(map(str, touched)) and "PartitionFilters: [" in after._jdf.queryExecution().toString()
    expected = rows(plain)
    out = load_table(spark, make(spark, batch), BUCKETED, table, fresh("data"), "upsert")
    assert rows(out) == expected and out.columns == ["k", "ik", "v"]
    now = set(spark.table(table).inputFiles())
    kept = {f for f in before if int(f.split("_bucket=")[1].split("/")[0]) not in touched}
    assert kept and kept == before & now  # the other files are the same
    assert all(os.path.exists(f.replace("file://", "")) for f in before)
    delete_unused(spark, table, fresh("data"))
    assert rows(spark.table(table).drop("_bucket")) == expected


def test_a_batch_is_applied_once(spark, rows, fresh, table):
    for spec in (SPEC, BUCKETED):
        spark.sql(f"DROP TABLE IF EXISTS {table}")
        data = fresh(f"data{spec.buckets}")
        batch = make(spark, [(1, 1, "a"), (2, None, "b")])
        for number in (0, 0):
            out = load_table(spark, batch, spec, table, data, "upsert", batch=("s", number))
            assert rows(out) == [(1, 1, "a"), (2, None, "b")]
        assert applied_batch(spark, table, "s") == 0 and applied_batch(spark, table, "other") == -1
        out = load_table(spark, batch, spec, table, data, "upsert", batch=("s", 1))
        assert rows(out) == [(1, 1, "a"), (2, None, "b"), (2, None, "b")]


@pytest.mark.parametrize("spec", [SPEC, BUCKETED], ids=["whole", "buckets"])
@pytest.mark.parametrize("step", range(6))
def test_a_batch_broken_off_at_any_step_is_finished(spark, rows, fresh, table, monkeypatch, spec, step):
    load_table(spark, make(spark, [(i, 1, "t") for i in range(20)]), spec, table, fresh("data"), "rebuild")
    batch = make(spark, [(1, 2, "a"), (2, None, "b"), (9, 3, "c")])
    expected = rows(newest_wins(spark.table(table).drop("_bucket"), batch, ["k"], "ik"))
    real, left = type(spark).sql, [step]

    def breaking(self, text, *more, **named):
        if text.startswith("ALTER"):
            if not left[0]:
                raise RuntimeError("lost")
            left[0] -= 1
        return real(self, text, *more, **named)

    monkeypatch.setattr(type(spark), "sql", breaking)
    try:
        load_table(spark, batch, spec, table, fresh("data"), "upsert", batch=("s", 5))
    except RuntimeError:
        pass
    monkeypatch.undo()
    for _ in range(2):
        assert rows(load_table(spark, batch, spec, table, fresh("data"), "upsert", batch=("s", 5))) == expected


@pytest.mark.parametrize("step", range(4))
def test_a_rebuild_broken_off_at_any_step_loses_nothing(spark, rows, fresh, table, monkeypatch, step):
    load_table(spark, make(spark, [(1, 1, "a")]), SPEC, table, fresh("data"), "rebuild")
    real, left = type(spark).sql, [step]

    def breaking(self, text, *more, **named):
        if text.startswith(("ALTER", "DROP", "CREATE")):
            if not left[0]:
                raise RuntimeError("lost")
            left[0] -= 1
        return real(self, text, *more, **named)

    monkeypatch.setattr(type(spark), "sql", breaking)
    with pytest.raises(RuntimeError):
        load_table(spark, make(spark, [(2, 2, "b")]), SPEC, table, fresh("data"), "rebuild")
    monkeypatch.undo()
    out = load_table(spark, make(spark, [(3, 3, "c")]), SPEC, table, fresh("data"), "append")
    assert rows(out) in ([(1, 1, "a"), (3, 3, "c")], [(2, 2, "b"), (3, 3, "c")])
    spark.sql(f"DROP TABLE IF EXISTS {table}__next")
    spark.sql(f"DROP TABLE IF EXISTS {table}__last")


@pytest.mark.parametrize("mode", LOAD_MODES)
@pytest.mark.parametrize("spec", [SPEC, BUCKETED], ids=["whole", "buckets"])
def test_checks_come_before_the_switch(spark, rows, fresh, table, mode, spec):
    load_table(spark, make(spark, [(1, 1, "a")]), spec, table, fresh("data"), "rebuild", checks={"rows": "count(*) = 1"})
    long = make(spark, [(2, 2, "b" * 10)])
    with pytest.raises(LoadRejected, match="v length"):
        load_table(spark, long, spec, table, fresh("data"), mode, checks=length_checks(spec))
    assert rows(spark.table(table).drop("_bucket")) == [(1, 1, "a")]
    out = load_table(spark, make(spark, [(2, 2, "b")]), spec, table, fresh("data"), mode, checks=length_checks(spec))
    assert rows(out)[-1] == (2, 2, "b")


def test_tables_in_buckets_join_without_a_shuffle(spark, rows, fresh, table):
    spec = TableSpec.of("t", "k bigint, v varchar(9)", dist_key="k", dist_buckets=4, sort_key=("k",))
    names = [table, f"{table}_2"]
    spark.sql(f"DROP TABLE IF EXISTS {names[1]}")
    for name, mode in zip(names, ("rebuild", "truncate")):
        out = load_table(spark, make(spark, [(i % 50, f"{name[-1]}{i % 3}") for i in range(100)], "k bigint, v string"), spec, name, fresh(name), mode)
        load_table(spark, make(spark, [(7, "more")], "k bigint, v string"), spec, name, fresh(name), "append")
    one, two = (spark.table(n) for n in names)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = one.join(two.withColumnRenamed("v", "w"), "k")
        text = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in text and "Exchange" not in text
        plain = make(spark, [tuple(r) for r in one.collect()], one.schema).join(make(spark, [tuple(r) for r in two.collect()], two.schema).withColumnRenamed("v", "w"), "k")
        assert rows(joined) == rows(plain) and joined.count() == 49 * 4 + 9
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql(f"DROP TABLE {names[1]}")


def test_interleaved_layout_serves_filters_on_either_key(spark, fresh):
    import pyarrow.parquet as pq

    df = spark.range(40_000).select(F.pmod(F.xxhash64("id"), F.lit(1000)).alias("a"), F.pmod(F.xxhash64(F.col("id") + 1), F.lit(1000)).alias("b"))
    met = {}
    for kind in ("compound", "interleaved"):
        spec = TableSpec.of("t", "a bigint, b bigint", sort_key=("a", "b"), sort_type=kind)
        df_laid = lay_out(df.coalesce(1) if kind == "compound" else df, spec)
        df_laid.write.option("maxRecordsPerFile", 1250).parquet(fresh(kind))
        bounds = []
        for path in files(fresh(kind)):
            meta = pq.ParquetFile(path).metadata
            stats = [[meta.row_group(g).column(c).statistics for c in (0, 1)] for g in range(meta.num_row_groups)]
            bounds += [tuple((s.min, s.max) for s in pair) for pair in stats]
        met[kind] = [sum(low <= 400 <= high for low, high in (b[c] for b in bounds)) / len(bounds) for c in (0, 1)]
        assert len(bounds) > 4
    assert met["compound"][1] > 0.9 and met["interleaved"][1] < 0.6 and met["interleaved"][0] < 0.6


def test_curve_of_texts_dates_and_nulls(spark):
    df = spark.createDataFrame([("a", 1.5), ("b", 2.5), (None, None), ("zz", 9.0)], "s string, x double")
    spec = TableSpec.of("t", "s varchar(9), x double", sort_key=("s", "x"), sort_type="interleaved")
    assert lay_out(df, spec).count() == 4 and lay_out(df, spec).columns == ["s", "x"]
    assert lay_out(df.limit(0), spec).count() == 0


def test_reconcile_adds_columns(spark, rows, fresh, table):
    create_if_missing(spark, TableSpec.of("t", "k bigint"), table, fresh("data"))
    assert reconcile_columns(spark, SPEC, table) == ["ik", "v"]
    assert reconcile_columns(spark, SPEC, table) == []
    out = load_table(spark, make(spark, [(1, 2, "a")]), SPEC, table, fresh("data"), "append")
    assert rows(out) == [(1, 2, "a")]


def test_append_rows_is_lazy_union(spark, rows):
    assert rows(append_rows(make(spark, [(1, 1, "a")]), make(spark, [(2, "x")], "k bigint, z string"), SPEC)) == [(1, 1, "a"), (2, None, None)]


def test_layout(spark):
    df = lay_out(make(spark, [(i % 5, i, "v") for i in range(100)]), SPEC)
    plan = df._jdf.queryExecution().toString()
    assert "RebalancePartitions" in plan and "Sort [k" in plan


def test_model_load_order():
    order = load_order(target_specs().values())
    for before, after in (("cities", "addresses"), ("addresses", "businesses"), ("businesses", "reviews"), ("users", "friends"),
                          ("categories", "business_categories"), ("cities", "city_weather")):
        assert order.index(before) < order.index(after)


# --- sources and scratch ---------------------------------------------------------------------------


def test_json_and_csv_sinks(spark, rows, fresh):
    df = make(spark, [(1, None, "a\tb"), (2, 3, 'q"c')])
    write_json(df, fresh("json"), n_files=2)
    assert rows(read_json(spark, fresh("json"), df.schema)) == rows(df)
    assert read_json(spark, fresh("json"), sampling_ratio=1.0).columns == ["ik", "k", "v"]
    write_csv(df, fresh("csv"))
    assert rows(read_csv(spark, fresh("csv"), df.schema, sep="\t")) == rows(df)
    assert dict(read_csv(spark, fresh("csv"), sep="\t").dtypes) == {"k": "string", "ik": "string", "v": "string"}
    write_json(df.repartition(1), fresh("small"), max_records_per_file=1)
    assert len([f for f in os.listdir(fresh("small")) if f.startswith("part")]) == 2


def test_partitioned_parquet(spark, fresh):
    write_parquet(make(spark, [(i, i, "ab"[i % 2]) for i in range(10)]), fresh("p"), partition_by=["v"])
    assert {d for d in os.listdir(fresh("p")) if d.startswith("v=")} == {"v=a", "v=b"}


def test_inline_lookup_is_sized(spark):
    schema = SPEC.struct_type
    small = inline_lookup(spark, [(1, 2, "x")], schema)
    assert small.schema == schema and small.count() == 1
    assert "LocalRelation" in small._jdf.queryExecution().optimizedPlan().toString()
    assert inline_lookup(spark, [(1, 2, "x")] * 10_001, schema).count() == 10_001


def test_scratch(spark):
    staged = materialise(make(spark, [(1, 2, "x")]), "x")
    assert staged.count() == 1
    assert staged.inputFiles()[0].split(":", 1)[1].lstrip("/").startswith(scratch_root(spark).lstrip("/"))
    path = scratch_path(spark, "y")
    make(spark, [(1, 2, "x")]).write.parquet(path)
    release(spark, path)
    assert not os.path.exists(path)
    with pytest.raises(ValueError):
        release(spark, "/somewhere/else")
