"""N-gram Jaccard join and its connected components, exact at a similarity of 4/5.

Documents are sets of five-word shingles. Equal sets are one node. A pair can only link when the sets share
a shingle among the fifth of each that comes first in one global order (the prefix filter); the order
puts shingles of crowded hash buckets last, by a table of fixed size counted over all documents. The
documents that share such a shingle form a tile.

A tile is not expanded into its pairs. Every member is paired with one pivot of each tile, and then with
``PIVOTS`` drawn members of its largest open tile; what links joins the pivot's component, which settles
a tile of near copies in linear time. Only tiles that still hold several components are then joined,
banded by size: the members outside a drawn member's component, with members of another component in
the same or the next size band. Every pair first has to pass a bound from hashed bitmaps (bits set on
one side only are elements that the other set lacks), then the count of shared shingles in both
prefixes, then the exact intersection of the sorted arrays. No pair is skipped: the
result is that of comparing all pairs, up to collisions of 64-bit hashes (about one in 10^10 nodes).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from relweave.llm.exact_dedup import quoted
from relweave.llm.words import BETWEEN_SPACE, chunks, find_words, mix, runs_hash
from relweave.session import bound_batches, materialise

SHINGLE = 5
LARGE_TILE, PIVOTS = 64, 32
ORDER_BITS = 18  # buckets of the order table
BITMAP_LONGS = 8
MOST_FILTER_BITS = 1 << 28
_SLICES = 64
_BITS = [f"b{i}" for i in range(BITMAP_LONGS)]


def shingle_sets(texts: list[bytes | None]) -> Iterator[tuple[int, np.ndarray]]:
    """(text number, sorted distinct shingle hashes); a text of fewer words is one shingle, without words none."""
    for a, b in chunks(texts):
        found = find_words(texts[a:b], BETWEEN_SPACE)
        words = found.hashes()
        whole = runs_hash(words, SHINGLE)
        bounds = found.first.tolist()
        for i, (p, q) in enumerate(zip(bounds, bounds[1:])):
            if q - p >= SHINGLE:
                yield a + i, np.unique(whole[p : q - SHINGLE + 1])
            elif q > p:
                yield a + i, mix(runs_hash(words[p:q], q - p) + np.uint64(q - p))
            else:
                yield a + i, np.empty(0, np.uint64)


def node_of(shingles: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(shingles.tobytes(), digest_size=8).digest(), "little", signed=True)


def bitmap_of(shingles: np.ndarray) -> np.ndarray:
    bits = np.zeros(64 * BITMAP_LONGS, np.uint8)
    bits[(shingles & np.uint64(64 * BITMAP_LONGS - 1)).astype(np.int64)] = 1
    return np.packbits(bits).view(np.int64)


def prefix_of(shingles: np.ndarray, order: np.ndarray) -> np.ndarray:
    """The first n - ceil(4n/5) + 1 shingles by (order of the bucket, hash)."""
    n = len(shingles)
    first = np.argsort(order[shingles >> np.uint64(64 - ORDER_BITS)], kind="stable")
    return shingles[first[: n - -(-4 * n // 5) + 1]]


def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for every document, and at the end of the task its bucket counts in slices."""
    counts = np.zeros(1 << ORDER_BITS, np.int64)
    names = ["id", "n", "node", *_BITS, "slice", "counts"]
    kinds = [pa.int64(), pa.int64(), pa.int64(), *[pa.int64()] * BITMAP_LONGS, pa.int32(), pa.binary()]
    schema = pa.schema(list(zip(names, kinds)))
    for batch in batches:
        texts = batch.column(1).cast(pa.binary()).to_pylist()
        n, node = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
        bits = np.zeros((BITMAP_LONGS, len(texts)), np.int64)
        for i, shingles in shingle_sets(texts):
            n[i] = len(shingles)
            if len(shingles):
                node[i] = node_of(shingles)
                bits[:, i] = bitmap_of(shingles)
                np.add.at(counts, (shingles >> np.uint64(64 - ORDER_BITS)).astype(np.int64), 1)
        empty = [pa.nulls(len(texts), pa.int32()), pa.nulls(len(texts), pa.binary())]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n), pa.array(node), *map(pa.array, bits), *empty], schema=schema)
    parts = counts.reshape(_SLICES, -1)
    nothing = [pa.nulls(_SLICES, pa.int64())] * (3 + BITMAP_LONGS)
    yield pa.RecordBatch.from_arrays(
        [*nothing, pa.array(np.arange(_SLICES, dtype=np.int32)), pa.array([p.tobytes() for p in parts], pa.binary())], schema=schema
    )


def _sum_slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for at, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            total[at] = total.get(at, 0) + np.frombuffer(counts, np.int64)
    yield pa.RecordBatch.from_arrays(
        [pa.array(list(total), pa.int32()), pa.array([t.tobytes() for t in total.values()], pa.binary())], ["slice", "counts"]
    )


def _order_table(described: DataFrame) -> np.ndarray:
    """Rank of every bucket by its count over all documents: 2^ORDER_BITS numbers, whatever the input."""
    slices = described.where(F.col("slice").isNotNull()).select("slice", "counts")
    summed = slices.repartition(_SLICES, "slice").mapInArrow(_sum_slices, "slice int, counts binary")
    counts = np.zeros((_SLICES, (1 << ORDER_BITS) // _SLICES), np.int64)
    for row in summed.toLocalIterator():
        counts[row.slice] += np.frombuffer(row.counts, np.int64)
    rank = np.empty(1 << ORDER_BITS, np.int64)
    rank[np.argsort(counts.ravel(), kind="stable")] = np.arange(1 << ORDER_BITS)
    return (rank >> (ORDER_BITS - 16)).astype(np.uint16)


def _postings(texts: DataFrame, order) -> DataFrame:
    """(shingle, node) of every prefix; a task writes each node once, however many copies it meets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            shingle, node = [], []
            for _, shingles in shingle_sets(batch.column(0).cast(pa.binary()).to_pylist()):
                if len(shingles) and (own := node_of(shingles)) not in seen:
                    seen.add(own)
                    shingle.append(prefix_of(shingles, order.value))
                    node.append(np.full(len(shingle[-1]), own))
            if shingle:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(shingle).view(np.int64)), pa.array(np.concatenate(node))], ["shingle", "node"]
                )

    return texts.mapInArrow(run, "shingle long, node long")


def bit_filter(wanted: DataFrame) -> tuple[int, Broadcast]:
    """A table of at most ``MOST_FILTER_BITS`` bits, one set for each ``node``, broadcast to all tasks.

    It keeps most other documents from being shuffled. What it lets through wrongly goes in a join; a
    full table only saves less.
    """
    n = wanted.count()
    bits = min(MOST_FILTER_BITS, 1 << max(15, (16 * max(1, n)).bit_length()))
    slot = F.pmod(F.col("node"), F.lit(bits)) + 1  # Spark's bitmaps count from one
    table = wanted.groupBy(F.bitmap_bucket_number(slot).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(slot)).alias("bits")
    )
    packed = np.zeros(bits // 8, np.uint8)
    for row in table.toLocalIterator():  # bits / 8 bytes in all
        start = (row.bucket - 1) * 4096
        packed[start : start + 4096] |= np.frombuffer(row.bits, np.uint8)[: len(packed) - start]
    return bits, wanted.sparkSession.sparkContext.broadcast(packed)


def _arrays(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """(node, shingles) of the wanted nodes, the array as bytes, once for each."""
    bits, shared = bit_filter(wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            node, arrays = [], []
            for _, shingles in shingle_sets(batch.column(0).cast(pa.binary()).to_pylist()):
                if len(shingles) and (own := node_of(shingles)) not in seen:
                    at = own % bits
                    if shared.value[at >> 3] >> (at & 7) & 1:
                        seen.add(own)
                        node.append(own)
                        arrays.append(shingles.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(node, pa.int64()), pa.array(arrays, pa.binary())], ["node", "shingles"])

    found = texts.mapInArrow(run, "node long, shingles binary").join(wanted, "node", "left_semi")
    return found.groupBy("node").agg(F.first("shingles").alias("shingles"))


def may_link(a: str, b: str) -> Column:
    """Whether sizes and bitmaps leave room for a link; every bit set on one side only is an element less."""

    def lacking(one: str, other: str) -> Column:
        return reduce(Column.__add__, [
            F.bit_count(F.col(f"{one}.{c}").bitwiseAND(F.bitwise_not(F.col(f"{other}.{c}")))) for c in _BITS
        ])

    na, nb = F.col(f"{a}.n"), F.col(f"{b}.n")
    most = F.least(na - lacking(a, b), nb - lacking(b, a))
    return 9 * most >= 4 * (na + nb)


def _intersect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep = []
        for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
            a, b = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
            place = np.searchsorted(b, a)
            place[place == len(b)] = 0
            keep.append(9 * int(np.count_nonzero(b[place] == a)) >= 4 * (len(a) + len(b)))
        yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))


def _verify(texts: DataFrame, pairs: DataFrame) -> DataFrame:
    """The pairs (a, b) that link, by exact intersection of the sorted arrays."""
    pairs = materialise(pairs, "jaccard-pairs")
    ends = pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node"))).distinct()
    arrays = materialise(_arrays(texts, ends), "jaccard-arrays")
    one = pairs.join(arrays.select(F.col("node").alias("a"), F.col("shingles").alias("x")), "a")
    both = one.join(arrays.select(F.col("node").alias("b"), F.col("shingles").alias("y")), "b").select("a", "b", "x", "y")
    links = materialise(both.mapInArrow(_intersect, "a long, b long"), "jaccard-links")
    _forget_shuffles(texts.sparkSession)
    return links


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node with a link (a, b); the root is the smallest node of the component.

    Every node moves to its smallest neighbour or stays, then to where that one went; links between moved
    nodes that are still apart go on to the next round. Minima combine map-side, so a node with very many
    links is no hot group.
    """
    edges = links.select("a", "b")
    roots = edges.toDF("node", "root").limit(0)  # no frame of Python rows: it would need Python workers of its own
    while True:
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select("b", "a"))
        parent = both.groupBy("u").agg(F.min("v").alias("v")).select(F.col("u").alias("node"), F.least("u", "v").alias("root"))
        parent = materialise(_few_files(parent), "parents")
        above = parent.select(F.col("node").alias("root"), F.col("root").alias("next"))
        parent = parent.join(above, "root").select("node", F.col("next").alias("root"))
        step = parent.select(F.col("node").alias("root"), F.col("root").alias("next"))
        moved = roots.join(step, "root", "left").select("node", F.coalesce("next", "root").alias("root"))
        new = parent.join(roots, "node", "left_anti")
        roots = materialise(_few_files(moved.unionByName(new)), "roots")
        of_a, of_b = (parent.select(F.col("node").alias(c), F.col("root").alias(f"r{c}")) for c in "ab")
        rest = edges.join(of_a, "a").join(of_b, "b").where("ra <> rb")
        edges = materialise(_few_files(rest.select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct()), "edges")
        if edges.isEmpty():
            return roots


def _few_files(df: DataFrame) -> DataFrame:
    """The rows for writing in a quarter of the tasks: tables of links are far smaller than what they come from."""
    return df.coalesce(max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) // 4))


def jaccard_components(docs: DataFrame, text: str = "text", order: str = "doc_id") -> DataFrame:
    """One row per input row: ``id``, ``n_shingles``, ``component_id``.

    Words are runs of other bytes than 20 and 09-0D after lower-casing A-Z. NULL, empty and wordless texts
    have no shingle and link with nothing: their component is their own id. Rows with NULL ids take part,
    but a component is named by its smallest non-NULL id. Equal rows are members like any other. An empty
    table gives an empty result.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    texts = docs.select(quoted(text).cast("string").alias("text"))
    given = docs.select(quoted(order).cast("long").alias("id"), quoted(text).cast("string").alias("text"))
    kinds = "id long, n long, node long, " + ", ".join(f"{c} long" for c in _BITS) + ", slice int, counts binary"
    described = materialise(given.mapInArrow(_describe, kinds), "jaccard-documents")
    table = spark.sparkContext.broadcast(_order_table(described))
    rows = described.where(F.col("slice").isNull())
    nodes = rows.where("n > 0").groupBy("node").agg(F.min("id").alias("least_id"), *[F.first(c).alias(c) for c in ["n", *_BITS]])
    nodes = materialise(nodes, "jaccard-nodes")

    postings = _postings(texts, table)
    repeated = postings.groupBy("shingle").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("shingle")
    tiles = materialise(postings.join(repeated, "shingle").distinct(), "jaccard-tiles")
    _forget_shuffles(spark)
    shared = tiles.groupBy("shingle").agg(F.min("node").alias("pivot"), F.max("node").alias("last")).where("pivot < last")
    members = tiles.join(shared.select("shingle", "pivot"), "shingle")

    one, two = nodes.drop("least_id").alias("one"), nodes.drop("least_id").alias("two")

    def bounded(pairs: DataFrame) -> DataFrame:
        joined = pairs.join(one, F.col("a") == F.col("one.node")).join(two, F.col("b") == F.col("two.node"))
        return joined.where(may_link("one", "two")).select("a", "b")

    lists = tiles.groupBy("node").agg(F.collect_list("shingle").alias("in_tiles")).join(nodes.select("node", "n"), "node")
    lists = materialise(lists, "jaccard-lists")
    tested = materialise(_ordered(members, "pivot", "node"), "jaccard-star")
    links = _verify(texts, _dense_enough(bounded(tested), lists))

    for last in (False, True):
        placed = tiles.join(components(links), "node", "left").select("shingle", "node", F.coalesce("root", "node").alias("root"))
        open_ = placed.groupBy("shingle").agg(
            F.min("root").alias("low"), F.max("root").alias("high"), F.count(F.lit(1)).alias("size"),
            F.min(F.struct(F.xxhash64("node").alias("draw"), "root")).alias("drawn"),
        ).where("low < high")
        open_ = open_.select("shingle", "size", F.col("drawn.root").alias("settled"))
        members = placed.join(open_, "shingle")
        if not last:  # further pivots join most of what a first one has left apart
            members = materialise(members, "jaccard-open")
            fresh = _ordered(_to_pivots(members), "pivot", "node")
            fresh = materialise(fresh.join(tested, ["a", "b"], "left_anti"), "jaccard-star")
            tested = tested.union(fresh)
            links = links.union(_verify(texts, _dense_enough(bounded(fresh), lists)))
    members = materialise(members, "jaccard-open")
    pairs = _open_pairs(members, nodes).join(tested, ["a", "b"], "left_anti")
    links = links.union(_verify(texts, _dense_enough(pairs, lists)))
    roots = components(links)
    named = nodes.join(roots, "node", "left").select("node", "least_id", F.coalesce("root", "node").alias("root"))
    names = named.groupBy("root").agg(F.min("least_id").alias("component_id"))
    labelled = named.join(names, "root").select("node", "component_id")
    member = rows.where("n > 0").join(labelled, "node").select("id", F.col("n").alias("n_shingles"), "component_id")
    return member.unionByName(rows.where("n = 0").select("id", F.col("n").alias("n_shingles"), F.col("id").alias("component_id")))


def _to_pivots(members: DataFrame) -> DataFrame:
    """Every member of an open tile with ``PIVOTS`` drawn members of its largest one, of other components."""
    place = members.groupBy("node").agg(F.max(F.struct("size", "shingle")).alias("largest"), F.min("root").alias("root"))
    draw = Window.partitionBy("shingle").orderBy(F.xxhash64("node"), "node")
    drawn = members.withColumn("turn", F.row_number().over(draw)).where(F.col("turn") <= PIVOTS)
    drawn = drawn.select("shingle", F.col("node").alias("pivot"), F.col("root").alias("pivot_root"))
    return place.select("node", "root", "largest.shingle").join(drawn, "shingle").where("root <> pivot_root")


def _ordered(rows: DataFrame, x: str, y: str) -> DataFrame:
    """Distinct unequal pairs, the smaller node first."""
    return rows.where(F.col(x) != F.col(y)).select(F.least(x, y).alias("a"), F.greatest(x, y).alias("b")).distinct()


def _open_pairs(members: DataFrame, nodes: DataFrame) -> DataFrame:
    """Pairs of different components within a tile, in the same or the next size band, that may link.

    One side is the members outside the component of a drawn member, which usually is nearly all of a
    large tile. In tiles of more than ``LARGE_TILE`` members a pair comes out only in the first large
    tile that both share, so that near copies with many tiles in common are not repeated for each.
    """
    band = F.floor(F.log(F.col("n")) / float(np.log(1.25)) + 1e-9).cast("int")
    large = members.where(F.col("size") > LARGE_TILE).groupBy("node").agg(F.collect_list("shingle").alias("large"))
    member = members.join(large, "node", "left").join(nodes.drop("least_id").withColumn("band", band), "node")
    member = member.withColumn("large", F.when(F.col("size") > LARGE_TILE, F.col("large")))
    near = F.explode(F.array(F.col("band") - 1, F.col("band"), F.col("band") + 1))
    left = member.where("root <> settled").withColumn("band", near).alias("one")
    right = member.alias("two")
    same_tile = (F.col("one.shingle") == F.col("two.shingle")) & (F.col("one.band") == F.col("two.band"))
    once = (F.col("two.root") == F.col("two.settled")) | (F.col("one.node") < F.col("two.node"))
    apart = (F.col("one.root") != F.col("two.root")) & once
    first = F.col("one.large").isNull() | (
        F.array_min(F.array_intersect("one.large", "two.large")) == F.col("one.shingle")
    )
    joined = left.join(right, same_tile & apart & may_link("one", "two") & first)
    return joined.select(F.least("one.node", "two.node").alias("a"), F.greatest("one.node", "two.node").alias("b")).distinct()


def _enough_shared() -> Column:
    """The prefixes of a pair that links share as many shingles as its overlap leaves beyond the longer rest.

    What is common comes in one order, so what lies outside either prefix is no more than the longer of
    both rests; a prefix leaves ceil(4n/5) - 1.
    """
    overlap = F.ceil(4 * (F.col("na") + F.col("nb")) / 9)

    def beyond(n: str) -> Column:
        return overlap - F.ceil(4 * F.col(n) / 5) + 1

    return F.col("shared") >= F.least(beyond("na"), beyond("nb"))


def _dense_enough(pairs: DataFrame, lists: DataFrame) -> DataFrame:
    """The pairs whose prefixes share enough shingles; a node's list is no longer than its own prefix."""
    one = lists.select(F.col("node").alias("a"), F.col("in_tiles").alias("x"), F.col("n").alias("na"))
    two = lists.select(F.col("node").alias("b"), F.col("in_tiles").alias("y"), F.col("n").alias("nb"))
    both = pairs.join(one, "a").join(two, "b")
    return both.withColumn("shared", F.size(F.array_intersect("x", "y"))).where(_enough_shared()).select("a", "b")


def _forget_shuffles(spark) -> None:
    """Let Spark's cleaner delete the shuffle files of what has been written; they would outlive their use."""
    spark.sparkContext._jvm.System.gc()


def near_dedup(docs: DataFrame, text: str = "text", order: str = "doc_id") -> DataFrame:
    """``docs`` without near copies: of each component the rows with the smallest id stay.

    Rows that share an id are one document; a row without an id always stays.
    """
    found = jaccard_components(docs, text, order)
    dropped = found.where("component_id <> id").select(F.col("id").alias("_dropped")).distinct()
    return docs.join(dropped, quoted(order) == F.col("_dropped"), "left_anti")


def query(spark, folder: str) -> DataFrame:
    """Set size and component of every document."""
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    return jaccard_components(docs).select(F.col("id").alias("doc_id"), "n_shingles", "component_id")


SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[k:k + 4], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS k FROM words WHERE len(w) > 0)
),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY 1),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b
  FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS common FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY 1, 2) p
  JOIN sizes a ON a.doc_id = p.a JOIN sizes b ON b.doc_id = p.b
  WHERE 100 * common >= 80 * (a.n + b.n - common)
),
reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, l.b FROM reach r JOIN links l ON l.a = r.other
)
SELECT r.doc_id, coalesce(any_value(n), 0) AS n_shingles, min(other) AS component_id
FROM reach r LEFT JOIN sizes USING (doc_id) GROUP BY 1
"""
