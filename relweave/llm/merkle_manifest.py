"""A Merkle manifest of a dataset: one digest for all rows, and for every row the proof that it is part of it.

Every row is a leaf. The leaves of a source, in order, form a tree: every ``ARITY`` consecutive nodes (a run)
hash to their parent until one is left, the subroot; the subroots, ordered by source, form a tree of the same
kind, whose top is the root.

A level is a table of (tree, position, size of the level, digest). In a window over each run, ``lag`` and
``lead`` columns at the fixed offsets 1 to ``ARITY - 1`` hold the neighbours; which of them are siblings
follows from the node's slot in its run and the run's length. The rows in slot 0 put their leads behind their
own digest and hash the parent. On the way down the same columns supply the siblings of every node, joined to
the path of its parent by the very (tree, run) that the window is dealt by, so each level is shuffled once.

No source is gathered in one place: positions come from a range-partitioned sort by source and order, and a
run has at most ``ARITY`` rows. Levels are written below ``spark.checkpoint.dir``.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from relweave.llm.crc_sql import CRC_TABLE, crc32
from relweave.llm.exact_dedup import quoted
from relweave.operators.dimension import dense_key
from relweave.session import materialise

ARITY = 16
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
BLOCK = 100_000  # rows whose sources are counted together when positions are found
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def digest(*inputs: Column) -> Column:
    """Lowercase hex sha256 of the inputs, one after the other."""
    return F.sha2(F.concat(*[c.cast("binary") for c in inputs]), 256)


def leaf(fields: Sequence[Column]) -> Column:
    """Digest of a row: each field as ``-`` if NULL, else its UTF-8 byte count, a colon and the value."""
    parts = []
    for field in fields:
        value = field.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return digest(*parts)


def _slot(arity: int) -> Column:
    return F.col("position") % arity


def _run(arity: int) -> Column:
    return F.floor(F.col("position") / F.lit(arity)).cast("long")


def _run_length(arity: int) -> Column:
    """Rows of the node's run: the last run of a level may be shorter."""
    return F.least(F.lit(arity).cast("long"), F.col("size") - F.col("position") + _slot(arity))


def _after(arity: int) -> Column:
    """Digests of the siblings behind the node: leads that stay within its run."""
    order = Window.partitionBy("tree", "run").orderBy("position")
    return F.concat(*[
        F.when(_slot(arity) + k < _run_length(arity), F.lead("digest", k).over(order)).otherwise(F.lit("")) for k in range(1, arity)
    ])


def _before(arity: int) -> Column:
    """Digests of the siblings before the node: lags that stay within its run."""
    order = Window.partitionBy("tree", "run").orderBy("position")
    return F.concat(*[
        F.when(_slot(arity) >= k, F.lag("digest", k).over(order)).otherwise(F.lit("")) for k in range(arity - 1, 0, -1)
    ])


def _parents(level: DataFrame, arity: int) -> DataFrame:
    """The level above: the first child of every run hashes itself and what follows in the run."""
    runs = level.where("size > 1").select("tree", "position", "size", "digest").withColumn("run", _run(arity))
    first = runs.withColumn("after", _after(arity)).where(_slot(arity) == 0)
    return first.select(
        "tree", F.col("run").alias("position"),
        F.ceil(F.col("size") / F.lit(arity)).cast("long").alias("size"), digest(F.col("digest"), F.col("after")).alias("digest"),
    )


def _levels(leaves: DataFrame, arity: int) -> list[DataFrame]:
    """``leaves`` and the levels above them, as long as a tree has several nodes."""
    levels = [leaves]
    while not levels[-1].where("size > 1").isEmpty():
        levels.append(materialise(_parents(levels[-1], arity), "merkle-level"))
    return levels


def _tops(levels: Sequence[DataFrame]) -> DataFrame:
    """(tree, digest) of the last node of every tree."""
    tops = levels[0].where("size = 1").select("tree", "digest")
    for level in levels[1:]:
        tops = tops.unionByName(level.where("size = 1").select("tree", "digest"))
    return tops


def _with_path(level: DataFrame, above: DataFrame | None, tops: DataFrame, arity: int) -> DataFrame:
    """``level`` with ``path``: (before, after) for its own run, its parent's, and so on up to the root.

    ``above`` is the next level with its path; ``tops`` has what comes after the last node of a tree. Other
    columns of ``tops`` come along.
    """
    extra = [c for c in tops.columns if c not in ("tree", "path")]
    alone = level.where("size = 1").join(tops, "tree")
    columns = [*level.columns, "path", *extra]
    if above is None:
        return alone.select(*columns)
    parents = above.select("tree", F.col("position").alias("run"), F.col("path").alias("rest"), *extra)
    runs = level.where("size > 1").withColumn("run", _run(arity))
    own = F.struct(_before(arity).alias("before"), _after(arity).alias("after"))
    placed = runs.withColumn("own", own).join(parents, ["tree", "run"])
    placed = placed.withColumn("path", F.concat(F.array("own"), "rest"))
    return placed.select(*columns).unionByName(alone.select(*columns))


def _paths(levels: Sequence[DataFrame], tops: DataFrame, arity: int) -> DataFrame:
    """The lowest level with its paths; those of the upper levels are written, a sixteenth of the rows each."""
    above = None
    for level in reversed(levels[1:]):
        above = materialise(_with_path(level, above, tops, arity), "merkle-path")
    return _with_path(levels[0], above, tops, arity)


def positions(rows: DataFrame, group: str, order: Sequence[str]) -> DataFrame:
    """``rows`` with ``tree`` (a number of its group, ascending as the groups do), ``position`` and ``size``.

    Rows are numbered over all groups by a range-partitioned sort; a group's first number is its tree. The
    counts behind that are one row for each group and block of numbers, and are joined back by both, so
    neither side has a hot key.
    """
    numbered = dense_key(rows, [group, *order], "_number").withColumn("_block", F.floor(F.col("_number") / BLOCK))
    counts = numbered.groupBy("_block", group).agg(F.min("_number").alias("low"), F.count(F.lit(1)).alias("n"))
    counts = materialise(counts, "merkle-counts")
    groups = counts.groupBy(F.col(group).alias("_of")).agg(F.min("low").alias("tree"), F.sum("n").alias("size"))
    spans = counts.join(groups, F.col(group).eqNullSafe(F.col("_of"))).select(
        F.col("_block").alias("_b"), F.col("_of").alias("_g"), "tree", "size"
    )
    placed = numbered.join(spans, (F.col("_block") == F.col("_b")) & F.col(group).eqNullSafe(F.col("_g")))
    return placed.select(*rows.columns, "tree", (F.col("_number") - F.col("tree")).alias("position"), "size")


@dataclass(frozen=True)
class Manifest:
    """``rows``: row (struct of the carried columns), leaf, subroot, root, path; ``levels``: the digests of every level."""

    rows: DataFrame
    levels: list[DataFrame]
    sources: list[DataFrame]


def manifest(
    docs: DataFrame, fields: Sequence[str] = FIELDS, group: str = "source", order: str = "doc_id",
    carry: Sequence[str] = ("doc_id",), arity: int = ARITY,
) -> Manifest:
    """The trees over all rows of ``docs``.

    Rows of equal ``order`` come in the order of their digests, so repeated rows change nothing else; NULL
    order and NULL group come first, and an empty text is not a NULL one. An empty table has no rows and no
    root. Other columns take no part, and the carried ones keep their names inside ``row``.
    """
    rows = docs.select(
        F.struct(*[quoted(c) for c in carry]).alias("row"), quoted(group).cast("string").alias("group"),
        quoted(order).alias("rank"), leaf([quoted(c) for c in fields]).alias("digest"),
    )
    rows = materialise(rows, "merkle-leaves")  # the sort samples its input: texts are hashed once
    leaves = materialise(positions(rows, "group", ["rank", "digest"]).select("row", "tree", "position", "size", "digest"), "merkle-leaves")
    levels = _levels(leaves, arity)
    tops = materialise(_tops(levels), "merkle-subroots")
    subroots = dense_key(tops, ["tree"], "_number").select(
        F.lit(0).cast("long").alias("tree"), (F.col("_number") - 1).alias("position"),
        F.lit(tops.count()).cast("long").alias("size"), "digest", F.col("tree").alias("member"),
    )
    sources = _levels(subroots, arity)
    root = _tops(sources).select(
        "tree", F.col("digest").alias("root"), F.array().cast("array<struct<before:string,after:string>>").alias("path")
    )
    above = _paths(sources, root, arity).select(F.col("member").alias("tree"), F.col("digest").alias("subroot"), "root", "path")
    paths = _paths(levels, materialise(above, "merkle-sources"), arity)
    return Manifest(paths.select("row", F.col("digest").alias("leaf"), "subroot", "root", "path"), levels, sources)


def proof_digest(path: Column) -> Column:
    """Digest of all siblings on a path, level by level, left to right."""
    return digest(F.array_join(F.transform(path, lambda p: F.concat(p["before"], p["after"])), ""))


def folded(node: Column, path: Column) -> Column:
    """The root that follows from a leaf and the siblings on its path."""
    return F.aggregate(path, node, lambda at, p: F.sha2(F.concat(p["before"], at, p["after"]), 256))


def verified(rows: DataFrame, node: Column) -> DataFrame:
    """``rows`` of a manifest with ``folded_root`` from the leaf ``node``, and whether that is the root."""
    held = rows.withColumn("folded_root", folded(node, F.col("path")))
    return held.withColumn("verified", F.col("folded_root") == F.col("root"))


def query(spark, folder: str) -> DataFrame:
    """Leaf, subroot, root and proof of every document, and the check of the documents after tampering."""
    docs = spark.read.parquet(f"{folder}/documents.parquet").select(*FIELDS)
    hit = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))
    changed = [F.translate("text", UPPER, LOWER) if c == "text" else F.col(c) for c in FIELDS]
    tampered = docs.withColumn("tampered", F.when(hit, leaf(changed)))
    found = manifest(tampered, carry=["doc_id", "tampered"]).rows
    checked = verified(found, F.coalesce("row.tampered", "leaf"))
    return checked.select(
        "row.doc_id", "leaf", "subroot", "root", proof_digest(F.col("path")).alias("proof_sha256"), "folded_root", "verified"
    )


def _sql(height: int = 6) -> str:
    """SQL of the query, for trees of up to ``height`` levels above the leaves."""
    def value(name: str) -> str:
        return f"coalesce(concat(strlen(CAST({name} AS VARCHAR)), ':', CAST({name} AS VARCHAR)), '-')"

    def hashed(text: str) -> str:
        return "sha256(" + " || ".join(value(text if f == "text" else f) for f in FIELDS) + ")"

    def levels(name: str) -> str:
        """The runs of each level above the table ``name`` of (tree, position, size, digest)."""
        out = []
        for k in range(height):
            out.append(
                f"{name}{k}_runs AS (SELECT tree, position // {ARITY} AS run, max(size) AS size, list(digest ORDER BY position) AS digests "
                f"FROM {name}{k} GROUP BY ALL)"
            )
            out.append(
                f"{name}{k + 1} AS (SELECT tree, run AS position, CAST(ceil(size / {ARITY}) AS BIGINT) AS size, "
                f"CASE WHEN size = 1 THEN digests[1] ELSE sha256(array_to_string(digests, '')) END AS digest FROM {name}{k}_runs)"
            )
        return ",\n".join(out)

    def climb(rows: str, name: str) -> str:
        """``rows`` with their nodes' siblings of each level added to ``proof`` and folded into ``at``."""
        out = []
        for k in range(height):
            slot = f"CAST(r.position % {ARITY} AS INTEGER)"
            out.append(
                f"{rows}_{name}{k} AS (SELECT r.* REPLACE (r.position // {ARITY} AS position, "
                f"CASE WHEN u.size = 1 THEN proof ELSE proof || array_to_string(u.digests[:{slot}] || u.digests[{slot} + 2:], '') END AS proof, "
                f"CASE WHEN u.size = 1 THEN fold ELSE sha256(array_to_string(u.digests[:{slot}], '') || fold || array_to_string(u.digests[{slot} + 2:], '')) "
                f"END AS fold) FROM {rows if k == 0 else f'{rows}_{name}{k - 1}'} AS r JOIN {name}{k}_runs AS u "
                f"ON r.tree = u.tree AND r.position // {ARITY} = u.run)"
            )
        return ",\n".join(out)

    return f"""
WITH {CRC_TABLE},
hashed AS (
  SELECT doc_id, source, {hashed('text')} AS leaf,
         CASE WHEN {crc32('CAST(doc_id AS VARCHAR)')} % 5 = 0 THEN {hashed(f"translate(text, '{UPPER}', '{LOWER}')")} END AS tampered
  FROM documents, crc
),
placed AS (
  SELECT *, dense_rank() OVER (ORDER BY source NULLS FIRST) AS tree, count(*) OVER (PARTITION BY source) AS size,
         row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS position
  FROM hashed
),
node0 AS (SELECT tree, position, size, leaf AS digest FROM placed),
{levels('node')},
subroot0 AS (SELECT 0 AS tree, tree - 1 AS position, count(*) OVER () AS size, digest FROM node{height}),
{levels('subroot')},
leaves AS (SELECT doc_id, leaf, tree, tree AS own, position, coalesce(tampered, leaf) AS fold, '' AS proof FROM placed),
{climb('leaves', 'node')},
located AS (SELECT * REPLACE (0 AS tree, own - 1 AS position) FROM leaves_node{height - 1}),
{climb('located', 'subroot')}
SELECT doc_id, leaf, s.digest AS subroot, t.digest AS root, sha256(proof) AS proof_sha256, fold AS folded_root, fold = t.digest AS verified
FROM located_subroot{height - 1} AS l JOIN node{height} AS s ON l.own = s.tree CROSS JOIN subroot{height} AS t
"""


SQL = _sql()
