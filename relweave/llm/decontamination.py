"""Benchmark decontamination: windows of benchmark words looked up in every window of the documents.

The windows of the benchmark (``n`` words; a shorter item is one window) are found in tasks, written once and
broadcast as sorted arrays in blocks of about ``BLOCK_WINDOWS`` windows and ``BLOCK_BYTES`` bytes, so that neither the
driver nor an executor holds more than one block however large the benchmark: with several blocks, the result of one is
written before the next is read. No documents are shuffled. A document window whose hash is in the block is compared
word by word before it counts.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from relweave.llm.exact_dedup import quoted
from relweave.llm.words import LETTERS_DIGITS, chunks, find_words, runs_hash
from relweave.session import bound_batches, materialise

WINDOW_WORDS = 10
BLOCK_WINDOWS, BLOCK_BYTES = 400_000, 1 << 26
_FILTER_BITS = 20

_HITS = "n_words long, spans array<struct<first:int,last:int>>, items array<long>"


_WINDOW = "item long, size int, hash long, words binary"


def _windows_of(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("item", pa.int64()), ("size", pa.int32()), ("hash", pa.int64()), ("words", pa.binary())])
    for batch in batches:
        texts = batch.column("text").cast(pa.binary()).to_pylist()
        names = batch.column("item").to_pylist()
        for a, b in chunks(texts):
            found = find_words(texts[a:b], LETTERS_DIGITS)
            hashes = found.hashes()
            rows: list[tuple] = []
            for i, (first, end) in enumerate(zip(found.first[:-1].tolist(), found.first[1:].tolist())):
                size = min(n, end - first)
                if size:
                    words = found.words(first, end)
                    values = runs_hash(hashes[first:end], size).view(np.int64).tolist()
                    rows += {(names[a + i], size, h, b" ".join(words[k : k + size])) for k, h in enumerate(values)}
            columns = zip(*rows) if rows else [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def benchmark_windows(benchmark: DataFrame, text: str, item: str, n: int = WINDOW_WORDS) -> DataFrame:
    """Distinct ``(item, size, hash, words)``: the windows of every item, their words joined by one space."""
    given = benchmark.select(quoted(item).cast("long").alias("item"), quoted(text).cast("string").alias("text"))
    return given.mapInArrow(lambda batches: _windows_of(batches, n), _WINDOW).distinct()


class WindowSet:
    """A block of windows as arrays sorted by length and hash; nothing is held as Python objects."""

    def __init__(self, rows: pa.Table):
        sizes = rows["size"].to_numpy()
        self.of_size: dict[int, tuple[np.ndarray, np.ndarray, pa.Array, pa.Array]] = {}
        for size in np.unique(sizes).tolist():
            own = rows.take(np.flatnonzero(sizes == size))
            hashes = own["hash"].to_numpy().view(np.uint64)
            order = np.argsort(hashes, kind="stable")
            own = own.take(order).combine_chunks()
            bits = np.zeros(1 << _FILTER_BITS, bool)
            bits[hashes >> np.uint64(64 - _FILTER_BITS)] = True
            self.of_size[size] = (hashes[order], bits, *(pa.concat_arrays(own[c].chunks) for c in ("words", "item")))

    def hits(self, found, hashes: np.ndarray) -> Iterator[tuple[int, int, int, list[int]]]:
        """``(text, first word, size, items)`` of every verified occurrence; items without id are not among ``items``."""
        text_of = found.text_of()
        for size, (known, bits, words, items) in self.of_size.items():
            values = runs_hash(hashes, size)
            at = np.flatnonzero(bits[values >> np.uint64(64 - _FILTER_BITS)])
            at = at[text_of[at] == text_of[at + size - 1]]
            first, end = np.searchsorted(known, values[at], "left"), np.searchsorted(known, values[at], "right")
            for k, i, j in zip(at[end > first].tolist(), first[end > first].tolist(), end[end > first].tolist()):
                own = b" ".join(found.words(k, k + size))
                same = [x for x in range(i, j) if words[x].as_py() == own]
                if same:
                    yield int(text_of[k]), k, size, [x for x in (items[x].as_py() for x in same) if x is not None]


def window_blocks(windows: DataFrame, block: int, most_bytes: int = BLOCK_BYTES) -> Iterator[pa.Table]:
    """The written windows in parts by hash of item and words, one after another; one empty part if there are none."""
    n, size = windows.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.length("words")), F.lit(0))).first()
    parts = max(1, -(-n // block), -(-size // most_bytes))
    for k in range(parts):
        part = windows if parts == 1 else windows.where(F.pmod(F.xxhash64("item", "words"), F.lit(parts)) == k)
        yield part.toArrow()


def _scan(batches: Iterator[pa.RecordBatch], windows: WindowSet, carried: int) -> Iterator[pa.RecordBatch]:
    """Append the hits of one block to (row, text, n_words, spans, items)."""
    schema = pa.schema([
        ("n_words", pa.int64()),
        ("spans", pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())]))),
        ("items", pa.list_(pa.int64())),
    ])
    for batch in batches:
        texts = batch.column("text").cast(pa.binary()).to_pylist()
        n_words = np.zeros(len(texts), np.int64)
        spans: list[list] = [[] for _ in texts]
        items: list[set] = [set() for _ in texts]
        for a, b in chunks(texts):
            found = find_words(texts[a:b], LETTERS_DIGITS)
            n_words[a:b] = np.diff(found.first)
            if not len(found.start):
                continue
            for i, k, size, which in windows.hits(found, found.hashes()):
                spans[a + i].append((k - int(found.first[i]), k - int(found.first[i]) + size - 1))
                items[a + i].update(which)
        if carried:
            for i, old in enumerate(batch.column("spans").to_pylist()):
                spans[i] += [(s["first"], s["last"]) for s in old]
            for i, old in enumerate(batch.column("items").to_pylist()):
                items[i].update(old)
        merged = [[{"first": f, "last": l} for f, l in _merge(s)] for s in spans]
        yield pa.RecordBatch.from_arrays(
            [batch.column("row"), batch.column("text"), pa.array(n_words, schema.field(0).type),
             pa.array(merged, schema.field(1).type), pa.array([sorted(x) for x in items], schema.field(2).type)],
            schema=pa.schema([batch.schema.field("row"), batch.schema.field("text"), *schema]),
        )


def _merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping or touching word ranges as one."""
    out: list[tuple[int, int]] = []
    for first, last in sorted(spans):
        if out and first <= out[-1][1] + 1:
            out[-1] = (out[-1][0], max(last, out[-1][1]))
        else:
            out.append((first, last))
    return out


def find_contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    carry: Sequence[str] = ("doc_id",),
    item: str = "item_id",
    item_text: str = "text",
    n: int = WINDOW_WORDS,
    block: int = BLOCK_WINDOWS,
) -> DataFrame:
    """One row per document: ``row`` (struct of ``carry``), ``text``, ``n_words``, ``spans``, ``items``.

    ``spans`` are the ranges of document words inside an occurrence of a benchmark window, merged;
    ``items`` the sorted ids of the items with one. NULL or wordless text has no words and no hit;
    items without words hit nothing, items without id (NULL, or no whole number) hit without being named; repeated items
    and rows count each. An empty benchmark hits nothing. Input columns stay inside ``row`` and cannot clash.
    """
    bound_batches(docs.sparkSession)
    windows = materialise(benchmark_windows(benchmark, item_text, item, n), "benchmark-windows")
    current = docs.select(F.struct(*[quoted(c) for c in carry]).alias("row"), quoted(text).cast("string").alias("text"))
    out = T.StructType([*current.schema.fields, *T.StructType.fromDDL(_HITS).fields])
    shared = None
    for k, rows in enumerate(window_blocks(windows, block)):
        if shared is not None:
            current = materialise(current, "contamination")
            shared.unpersist()
        shared = docs.sparkSession.sparkContext.broadcast(WindowSet(rows))
        current = current.mapInArrow(lambda batches, s=shared, k=k: _scan(batches, s.value, k), out)
    return current


def remove_spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``text`` without the bytes from the first to the last word of every span."""
    for batch in batches:
        texts = batch.column("text").cast(pa.binary()).to_pylist()
        for i, spans in enumerate(batch.column("spans").to_pylist()):
            if spans:
                found = find_words([texts[i]], LETTERS_DIGITS)
                kept, at = [], 0
                for s in spans:
                    kept.append(texts[i][at : int(found.start[s["first"]])])
                    at = int(found.end[s["last"]])
                texts[i] = b"".join([*kept, texts[i][at:]])
        column = pa.array(texts, pa.binary()).cast(pa.string())
        yield batch.set_column(batch.schema.get_field_index("text"), "text", column)


def decontaminate(docs: DataFrame, benchmark: DataFrame, text: str = "text", remove: str = "documents", **how) -> DataFrame:
    """``docs`` with its own columns, without contaminated ``documents`` or without the hit ``spans``."""
    if remove not in ("documents", "spans"):
        raise ValueError(f"remove 'documents' or 'spans', not {remove!r}")
    others = [c for c in docs.columns if c != text]
    found = find_contamination(docs, benchmark, text, others, **how)
    if remove == "documents":
        found = found.where(F.size("spans") == 0)
    else:
        found = found.mapInArrow(remove_spans, found.schema)
    return found.select(*[F.col("text").alias(c) if c == text else F.col("row")[c].alias(c) for c in docs.columns])


def query(spark, folder: str) -> DataFrame:
    """Words, hit words and items hit of every document."""
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    benchmark = spark.read.parquet(f"{folder}/benchmark.parquet")
    found = find_contamination(docs, benchmark)
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + (s["last"] - s["first"] + 1))
    names = F.array_sort(F.transform("items", lambda i: i.cast("string")))
    return found.select(
        "row.doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(names, ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"),
    )


_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

SQL = f"""
WITH items AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
item_windows AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS size, array_to_string(w[k:k + least(len(w), 10) - 1], ' ') AS words
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS k FROM items WHERE len(w) > 0)
),
docs AS (SELECT doc_id, {_WORDS} AS w FROM documents),
sizes AS (SELECT DISTINCT size FROM item_windows),
doc_windows AS (
  SELECT doc_id, size, k, array_to_string(w[k:k + size - 1], ' ') AS words
  FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS k FROM docs, sizes WHERE len(w) >= size)
),
hits AS (SELECT doc_id, d.size, k, item_id FROM doc_windows d JOIN item_windows i ON d.words = i.words AND d.size = i.size),
hit_words AS (SELECT doc_id, count(DISTINCT word) AS n_hit FROM (SELECT doc_id, unnest(range(k, k + size)) AS word FROM hits) GROUP BY 1),
hit_items AS (
  SELECT doc_id, count(*) AS n_items, sha256(string_agg(id, ',' ORDER BY id)) AS sha
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM hits) GROUP BY 1
)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       coalesce(sha, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs d LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)
"""
