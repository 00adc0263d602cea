"""Exact deduplication by distributed most-significant-digit radix partitioning.

Documents are split by successive digits of their bytes until a group holds one document or its texts
have ended. The first digit is the length together with the first bytes; each further digit takes the
next bytes, ``growth`` times as many as the digit before. Equality is equality of all bytes: no digest
takes part.

One round counts the rows per (group, digit), which combines map-side, writes the groups with two rows
or more, and joins them back to the rows. Only rows of such groups carry their text on. The joins are
sort-merge joins at every size (groups grow with the input, so they are never broadcast) against one row
per group, so Spark may split a group of any size over tasks. Rounds
are cut by written tables in the shared folder: a lost executor repeats one round at most.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from relweave.session import materialise

FIRST_DIGIT = 64  # bytes
GROWTH = 8


def quoted(name: str) -> Column:
    """A column by its literal name, dots and backticks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def _repeated(rows: DataFrame, key: Sequence[str], *aggregates: Column) -> DataFrame:
    """The (group, digit) pairs with two rows or more, each with a new group number ``next``."""
    counted = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("n"), *aggregates).where(F.col("n") > 1)
    # written before use, so that a number never changes between two readers
    return materialise(counted.withColumn("next", F.monotonically_increasing_id()), "radix-groups")


def exact_groups(
    docs: DataFrame,
    text: str = "text",
    order: str = "doc_id",
    carry: Sequence[str] = (),
    keep_text: bool = False,
    first: int = FIRST_DIGIT,
    growth: int = GROWTH,
) -> DataFrame:
    """One row per input row: ``row`` (struct of ``carry``), ``keep_id``, ``group_size``, ``kept``.

    NULL text counts as empty. Of equal texts the row with the largest ``order`` stays (NULL is the
    smallest); of rows that tie there, exactly one. ``keep_id`` is the ``order`` of the row that stays.
    ``keep_text`` adds ``body``, the text as bytes. Input columns keep their names inside ``row``, so
    they cannot clash with ours. An empty table gives an empty result; texts may have any length.
    """
    body = F.coalesce(quoted(text).cast("string"), F.lit("")).cast("binary")
    rows = docs.select(
        F.struct(*[quoted(c) for c in carry]).alias("row"), quoted(order).alias("rank"), body.alias("body")
    ).select("row", "rank", "body", F.octet_length("body").alias("size"), F.substring("body", 1, first).alias("digit"))
    kept_text = ["body"] if keep_text else []

    def alone(level: DataFrame) -> DataFrame:
        return level.select(
            "row", F.col("rank").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
            F.lit(True).alias("kept"), *kept_text,
        )

    found = _repeated(rows, ["size", "digit"])
    joined = rows.join(found.hint("merge"), ["size", "digit"], "left").withColumn("more", F.col("next").isNotNull())
    body = F.col("body") if keep_text else F.when(F.col("more"), F.col("body"))
    level = materialise(
        joined.select(
            "row", "rank", "size", "more", F.col("next").alias("group"), body.alias("body"),
            F.monotonically_increasing_id().alias("uid"),
        ),
        "radix",
    )
    done = [alone(level.where(~F.col("more")))]
    start, width = first, first * growth
    while not level.where("more").isEmpty():
        active = level.where("more").select("row", "rank", "size", "group", "body", "uid")
        active = active.withColumn("digit", F.substring("body", start + 1, width))
        found = _repeated(active, ["group", "digit"], F.max(F.struct("rank", "uid")).alias("top"))
        repeated = F.col("next").isNotNull()
        joined = active.join(found.hint("merge"), ["group", "digit"], "left").withColumns(
            {"repeated": repeated, "more": repeated & (F.col("size") > start + width)}
        )
        level = materialise(
            joined.select(
                "row", "rank", "size", "repeated", "more", F.col("next").alias("group"), body.alias("body"), "uid",
                "n", "top",
            ),
            "radix",
        )
        ended = level.where(F.col("repeated") & ~F.col("more"))
        done.append(alone(level.where(~F.col("repeated"))))
        done.append(
            ended.select(
                "row", F.col("top.rank").alias("keep_id"), F.col("n").alias("group_size"),
                (F.col("uid") == F.col("top.uid")).alias("kept"), *kept_text,
            )
        )
        start, width = start + width, width * growth
    return reduce(DataFrame.unionByName, done)


def exact_dedup(docs: DataFrame, text: str = "text", order: str = "doc_id") -> DataFrame:
    """The rows that stay, with the columns of ``docs`` unchanged."""
    others = [c for c in docs.columns if c != text]
    # NULL and empty count as equal but come back as they were
    marked = docs.withColumn("_radix_null_text", quoted(text).isNull())
    groups = exact_groups(marked, text, order, [*others, "_radix_null_text"], keep_text=True).where("kept")
    original = F.when(~F.col("row._radix_null_text"), F.col("body").cast("string")).alias(text)
    return groups.select(
        *[original if c == text else F.col("row")[c].alias(c) for c in docs.columns]
    )


def query(spark, folder: str) -> DataFrame:
    """Group, survivor and digest of every document."""
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    hashed = docs.withColumn("sha", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256))
    groups = exact_groups(hashed, carry=["doc_id", "sha"])
    return groups.select("row.doc_id", "keep_id", "group_size", "kept", F.col("row.sha").alias("text_sha256"))


SQL = """
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW w AS (PARTITION BY coalesce(text, ''))
"""
