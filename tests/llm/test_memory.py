"""Memory of Python workers, of the buffers rows go to them in, and of the driver."""

import math
import tracemalloc
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from relweave.llm import byte_bpe, decontamination, jaccard_join, katz_model, toxicity
from relweave.session import BATCH_BYTES
from test_operators_llm import documents


def one_bucket(chunks, size):
    """Batches of texts of random words, and the table of frequent words, which knows none."""
    rng = np.random.default_rng(3)
    texts = [" ".join(f"w{i}" for i in rng.zipf(1.3, size)[:size] % 50_000) for _ in range(chunks)]
    none = np.empty(0, np.int64)
    top = katz_model.Words(none.view(np.uint64), none, none.view(np.uint64), none, chunks * size, 50_000, np.ones(katz_model.K + 2), chunks * size, 0.1)
    return [pa.table({"uid": [i], "row": [i], "text": [t]}).to_batches()[0] for i, t in enumerate(texts)], top


def peak_of(work):
    tracemalloc.start()
    try:
        return work(), tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def test_working_memory_of_a_bucket():
    batches, top = one_bucket(60, 10_000)
    rows = pa.Table.from_batches(katz_model._emit_training((b.select([2]) for b in batches), top, 1))
    counted, training = peak_of(lambda: katz_model._count_pairs(rows, top))
    sizes = rows.column("n").to_pylist()
    pairs = sum(len(katz_model._unpacked(n)) for n in sizes)
    whole = counted.filter(pa.compute.is_valid(counted.column("ids")))
    alone = counted.filter(pa.compute.is_valid(counted.column("c")))
    n = len(alone)
    model = pa.table({
        **{f: pa.concat_arrays([*whole.column(f).chunks, pa.nulls(n, whole.column(f).type)]) for f in ("bucket", "ids", "sizes", "rare_words", "n")},
        "context": pa.array([None, *alone.column("context").to_pylist()]),
        "denominator": pa.array([None, *map(float, alone.column("c").to_pylist())]), "log_alpha": pa.array([None, *[-1.0] * n], pa.float64()),
    })
    out = katz_model._arrow(katz_model._SUMS)
    out = pa.schema([("uid", pa.int64()), ("row", pa.int64()), *out])
    emitted = pa.schema([*katz_model._arrow(katz_model._PAIRS + ", texts binary, per_pair binary, uids binary, first long"), *out])
    texts = pa.Table.from_batches(katz_model._emit_scoring(batches, top, 1, emitted))
    scored, scoring = peak_of(lambda: katz_model._score_pairs(texts, model, top, top.discount, out))
    # every pair was counted, so a text's score is that of its pairs by their counts
    after, of = Counter(), Counter()
    tokens_of = [[*b.column(2)[0].as_py().split(), None] for b in batches]
    for t in tokens_of:
        after.update(zip(t, t[1:]))
        of.update(t[:-1])
    got = Counter()
    for uid, score in zip(scored.column("uid").to_pylist(), scored.column("score").to_pylist()):
        got[uid] += score or 0
    for uid, t in enumerate(tokens_of):
        assert math.isclose(got[uid], sum(math.log10(after[p] / of[p[0]]) for p in zip(t, t[1:])), rel_tol=1e-9)
    assert max(len(c) for c in scored.column("uid").chunks) <= katz_model._OUT_ROWS
    assert training < 88 * pairs and scoring < 75 * pairs, (training / pairs, scoring / pairs)


@pytest.mark.parametrize("operator", ["katz", "near", "decontamination", "bpe", "toxicity"])
def test_rows_go_to_workers_in_small_batches(spark, operator):
    docs = documents(spark, ["one two three four five six", "two three"])
    labels = docs.selectExpr("doc_id", "cast(doc_id % 2 as int) AS toxic")
    name = "spark.sql.execution.arrow.maxBytesPerBatch"

    def largest():
        wide = spark.range(12_000).selectExpr("repeat('x', 1000) AS t").coalesce(1)
        sizes = wide.mapInArrow(lambda batches: (pa.record_batch({"n": [b.nbytes]}) for b in batches), "n long")
        return max(r.n for r in sizes.collect())

    def run():
        if operator == "katz":
            return katz_model.train(docs)
        if operator == "near":
            return jaccard_join.jaccard_components(docs)
        if operator == "decontamination":
            return decontamination.find_contamination(docs, docs.selectExpr("doc_id AS item_id", "text"))
        if operator == "bpe":
            return byte_bpe.encode(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"))
        return toxicity.drop_toxic(docs, labels)

    spark.conf.unset(name)
    try:
        assert largest() > 9_000_000
        run()
        assert largest() < 1.1 * BATCH_BYTES
        spark.conf.set(name, "1m")  # what the session asks for stays, if it is less
        run()
        assert spark.conf.get(name) == "1m"
    finally:
        spark.conf.unset(name)


def test_screening_takes_no_copies_of_its_table():
    texts, y = [f"clean words here {i}".encode() for i in range(400)], np.arange(400) % 4 == 0
    texts = [t + b" awful" if bad else t for t, bad in zip(texts, y)]
    found, peak = peak_of(lambda: toxicity._promising(texts, y.astype(float)))
    assert found.sum() == 2  # the word and its first four bytes
    assert peak < 120_000_000, peak


def test_components_need_no_python_workers(spark, monkeypatch):
    def refuse(*_, **__):
        raise AssertionError("rows of Python")

    links = spark.range(6).selectExpr("id AS a", "id + 1 AS b").where("a <> 3")
    monkeypatch.setattr(type(spark), "createDataFrame", refuse)
    assert sorted(map(tuple, jaccard_join.components(links).collect())) == [*[(i, 0) for i in range(4)], *[(i, 4) for i in range(4, 7)]]
    assert jaccard_join.components(links.limit(0)).count() == 0
