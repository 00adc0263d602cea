import json

from relweave.operators.spec import TableSpec
from relweave.streaming.incremental import incremental_load

SPEC = TableSpec.of("visits", "id bigint, ts timestamp, v varchar(9)", primary_key=("id",), incremental_key="ts")


def test_each_run_takes_only_new_files_and_newest_wins(spark, rows, fresh, tmp_path):
    source = tmp_path / "in"
    source.mkdir()

    def arrive(name, items):
        (source / name).write_text("\n".join(json.dumps(dict(zip(("id", "ts", "v"), i))) for i in items))

    def load():
        incremental_load(spark, str(source), "id bigint, ts timestamp_ntz, v string", SPEC, "visits", fresh("data"), fresh("cp"))
        return [(r[0], r[2]) for r in rows(spark.table("visits"))]

    spark.sql("DROP TABLE IF EXISTS visits")
    arrive("a.json", [(1, "2020-01-01T00:00:00", "a"), (2, "2020-01-01T00:00:00", "a")])
    assert load() == [(1, "a"), (2, "a")]
    assert load() == [(1, "a"), (2, "a")]
    arrive("b.json", [(1, "2020-01-02T00:00:00", "b"), (2, "2019-01-01T00:00:00", "late"), (3, "2020-01-01T00:00:00", "b")])
    assert load() == [(1, "b"), (2, "a"), (3, "b")]
    spark.sql("DROP TABLE visits")


def test_a_batch_delivered_twice_changes_nothing(spark, rows, fresh, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    items = [{"id": 1, "ts": "2020-01-01T00:00:00", "v": "a"}, {"id": 2, "ts": None, "v": "no time"}]
    (source / "a.json").write_text("\n".join(map(json.dumps, items)))
    spec = TableSpec.of("visits_twice", "id bigint, ts timestamp, v varchar(9)", primary_key=("id",), incremental_key="ts", buckets=4)

    def load():
        incremental_load(spark, str(source), "id bigint, ts timestamp_ntz, v string", spec, "visits_twice", fresh("data"), fresh("cp"))
        return [(r[0], r[2]) for r in rows(spark.table("visits_twice"))]

    spark.sql("DROP TABLE IF EXISTS visits_twice")
    assert load() == [(1, "a"), (2, "no time")]
    for name in ("0", ".0.crc"):  # as if the process had died before the batch was marked as done
        (tmp_path / "cp" / "commits" / name).unlink(missing_ok=True)
    assert load() == [(1, "a"), (2, "no time")]
    spark.sql("DROP TABLE visits_twice")
