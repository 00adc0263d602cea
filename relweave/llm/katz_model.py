"""Scores of texts by a Katz backoff model of word pairs.

A token is a word or the end of its text. For a token ``w`` after the token ``h``

    p(w | h) = d(c(h w)) c(h w) / c(h)    where the pair was counted in training,
               alpha(h) p(w)              otherwise,
    p(w)     = d(c(w)) c(w) / N           where the word was, and the mass left over for any other word,

with Good-Turing discounts ``d`` for counts up to ``K`` and ``alpha(h)`` such that the probabilities after every
``h`` sum to exactly one. A context whose counts are all above ``K`` leaves no mass; its denominator is one
larger. The first token of a text has no context.

The model is two stored tables: the words with their counts, and the pairs, dealt into buckets of about
``BUCKET_TOKENS`` tokens by their context; a frequent context is dealt over several buckets in proportion to
its count, so no bucket grows with it. Inside a task pairs are arrays, sorted and counted at once, and travel
as arrays, so a shuffle carries a row for each chunk of text and bucket instead of one a token.

Texts are scored by the recursion itself, one order after the other: the pairs of the texts meet the model's
bucket by bucket; those counted in training are settled there, the others add ``alpha`` and go on as words.
Words of the ``TOP_WORDS`` most frequent are settled in place from a broadcast table of that size, the others by
a join with all words. That table only saves work.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  (pa.compute)
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from relweave.llm.exact_dedup import quoted
from relweave.llm.words import BETWEEN_SPACE, find_words, give_back, mix
from relweave.session import bound_batches, materialise

K = 5  # the largest count that is discounted
TOP_WORDS = 1 << 19
BUCKET_TOKENS = 1 << 20
CHUNK_BYTES = 4 << 20
END = np.uint64(1)  # the token at the end of every text
_MOST_TEXTS = 50_000
_OUT_ROWS = 1 << 13  # rows of a batch that a worker returns
_RANGES = 4  # a bucket's pairs are counted in so many ranges of their contexts


def _packed(values: np.ndarray) -> bytes:
    """Whole numbers, byte by byte of all of them, compressed; before that how many bytes and how many numbers."""
    values = values.astype("<u8")
    width = max(1, -(-int(values.max()).bit_length() // 8)) if len(values) else 1
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(-1, 8).T[:width])
    return np.array([width, len(values)], "<i8").tobytes() + pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def _unpacked(data: bytes) -> np.ndarray:
    width, n = np.frombuffer(data, "<i8", 2).tolist()
    planes = np.frombuffer(pa.decompress(data[16:], n * width, codec="zstd"), np.uint8).reshape(width, n)
    out = np.zeros((n, 8), np.uint8)
    out[:, :width] = planes.T
    return out.view("<i8").ravel()


def tokens_of(texts: Sequence[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """The tokens of all texts as hashes, each text closed by ``END``, and the text of each token."""
    found = find_words(texts, BETWEEN_SPACE)
    owner = found.text_of()
    out = np.full(len(owner) + len(texts), END, np.uint64)
    out[np.arange(len(owner)) + owner] = np.maximum(found.hashes(), np.uint64(2))
    return out, np.repeat(np.arange(len(texts)), np.diff(found.first) + 1)


def text_chunks(column: pa.Array) -> Iterator[tuple[int, int, list[bytes | None]]]:
    """Ranges of rows with their texts, so that only those of one range are taken out of the column at once."""
    sizes = pa.compute.fill_null(pa.compute.binary_length(column), 0).to_numpy(zero_copy_only=False)
    begin = 0
    for stop in _ends(sizes):
        yield begin, stop, column.slice(begin, stop - begin).cast(pa.binary()).to_pylist()
        begin = stop
    give_back()


def _ends(sizes: np.ndarray) -> Iterator[int]:
    """Where ranges of about ``CHUNK_BYTES`` and at most ``_MOST_TEXTS`` texts end; a longer text is alone."""
    total, begin = np.concatenate(([0], np.cumsum(sizes))), 0
    while begin < len(sizes):
        stop = int(np.searchsorted(total, total[begin] + CHUNK_BYTES, "right")) - 1
        begin = min(max(stop, begin + 1), begin + _MOST_TEXTS)
        yield begin


def distinct_rows(columns: Sequence[np.ndarray]) -> tuple[list[np.ndarray], np.ndarray]:
    """The distinct tuples of small whole numbers in sorted order, and how often each occurs."""
    bits = [int(c.max()).bit_length() if len(c) else 0 for c in columns]
    if sum(bits) > 64:
        raise ValueError("a chunk of text is too large")
    key = np.zeros(len(columns[0]), np.uint64)
    for column, width in zip(columns, bits):
        key = (key << np.uint64(width)) | column.astype(np.uint64)
    key, counts = np.unique(key, return_counts=True)
    out = []
    for width in reversed(bits):
        out.append(key & np.uint64((1 << width) - 1))
        key = key >> np.uint64(width)
    return out[::-1], counts


@dataclass(frozen=True)
class Words:
    """The most frequent words, most frequent first, with their counts; and what is known of all words.

    ``key`` and ``place`` are their hashes in sorted order and where each is in the table.
    """

    word: np.ndarray
    count: np.ndarray
    key: np.ndarray
    place: np.ndarray
    tokens: int
    distinct: int
    discount: np.ndarray
    denominator: int
    unknown: float

    def places(self, words: np.ndarray) -> np.ndarray:
        """Place of each word in the table, -1 for a word that is not there."""
        if not len(self.key):
            return np.full(len(words), -1)
        at = np.minimum(np.searchsorted(self.key, words), len(self.key) - 1)
        return np.where(self.key[at] == words, self.place[at], -1)

    def counts(self, words: np.ndarray) -> np.ndarray:
        """Training count of each word, 0 for a word that is not in the table."""
        at = self.places(words)
        return np.append(self.count, 0)[at]

    def probability(self, counts: np.ndarray) -> np.ndarray:
        """Probability of words by their counts."""
        known = self.discount[np.minimum(counts, K + 1)] * counts / self.denominator
        return np.where(counts > 0, known, self.unknown)

    def base(self, counts: np.ndarray) -> np.ndarray:
        return np.log10((counts + 0.5) / (self.tokens + 0.5 * (self.distinct + 1)))


def good_turing(classes: Sequence[int]) -> np.ndarray:
    """Discount by count, from the numbers of items counted 1, 2, ... K + 1 times; 1 where none can be estimated."""
    n = [0, *classes]
    out = np.ones(K + 2)
    above = (K + 1) * n[K + 1] / n[1] if n[1] else 1.0
    for r in range(1, K + 1):
        if n[r] and above < 1:
            d = ((r + 1) * n[r + 1] / (r * n[r]) - above) / (1 - above)
            if 0 < d < 1:
                out[r] = d
    return out


def spread(counts: np.ndarray, buckets: int) -> np.ndarray:
    """Number of buckets that a context of such a count is dealt over."""
    return np.clip(4 * counts // BUCKET_TOKENS + 1, 1, buckets).astype(np.uint64)


def bucket_of(context: np.ndarray, word: np.ndarray, over: np.ndarray, buckets: int) -> np.ndarray:
    return ((mix(context) >> np.uint64(1)) + mix(word + np.uint64(7)) % over) % np.uint64(buckets)


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for _, _, texts in text_chunks(batch.column(0)):
            words, n = np.unique(tokens_of(texts)[0], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(words.view(np.int64)), pa.array(n)], ["word", "c"])


_PAIRS = "bucket int, ids binary, sizes binary, rare_words binary, n binary"
_SUMS = "score double, base double, n_tokens long, n_known long, token long, n_all long, n_open long"


def _arrays(contexts: np.ndarray, sizes: np.ndarray, words: np.ndarray, at: np.ndarray, place: np.ndarray, known: int) -> dict:
    """Contexts, their numbers of pairs and the pairs' words: places in ``words`` as places in the table of frequent words.

    A word that is not there is a place behind the table, in the list of rare words that goes along.
    """
    both = np.concatenate((contexts, at))
    ids = place[both]
    rare = np.flatnonzero(ids < 0)
    extra, own = np.unique(words[both[rare]], return_inverse=True)
    ids[rare] = known + own
    return {"ids": _packed(ids), "sizes": _packed(sizes), "rare_words": extra.tobytes()}


def _blobs(words: np.ndarray, context: np.ndarray, word: np.ndarray, top: Words, buckets: int) -> Iterator[tuple[int, np.ndarray, dict]]:
    """Pairs of places in ``words``, sorted, by bucket: (bucket, places of its pairs, its arrays)."""
    place = top.places(words)
    over = spread(np.append(top.count, 0)[place], buckets)
    bucket = bucket_of(words[context], words[word], over[context], buckets)
    order = np.argsort(bucket, kind="stable")
    starts = np.flatnonzero(np.diff(bucket[order], prepend=np.uint64(buckets)))
    for start, stop in zip(starts.tolist(), [*starts[1:].tolist(), len(order)]):
        own = order[start:stop]
        first = np.flatnonzero(np.diff(context[own].astype(np.int64), prepend=-1))
        sizes = np.diff(first, append=len(own))
        yield int(bucket[order[start]]), own, _arrays(context[own[first]], sizes, words, word[own], place, len(top.key))


def _emit_training(batches: Iterator[pa.RecordBatch], top: Words, buckets: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for _, _, texts in text_chunks(batch.column(0)):
            tokens, text = tokens_of(texts)
            words, place = np.unique(tokens, return_inverse=True)
            at = np.flatnonzero(text[1:] == text[:-1])
            if not len(at):
                continue
            (context, word), n = distinct_rows([place[at], place[at + 1]])
            context, word = context.astype(np.int64), word.astype(np.int64)
            rows = [{"bucket": k, **arrays, "n": _packed(n[own])} for k, own, arrays in _blobs(words, context, word, top, buckets)]
            yield pa.RecordBatch.from_pylist(rows, schema=_arrow(_PAIRS))


def _arrow(ddl: str) -> pa.Schema:
    kinds = {"int": pa.int32(), "long": pa.int64(), "double": pa.float64(), "binary": pa.binary()}
    return pa.schema([(name, kinds[kind]) for name, kind in (field.split() for field in ddl.split(", "))])


def _pairs_of(row: dict, top: Words) -> tuple[np.ndarray, np.ndarray]:
    """(context, word) hashes of the pairs in a row."""
    ids, sizes = _unpacked(row["ids"]), _unpacked(row["sizes"])
    hashes = np.zeros(len(ids), np.uint64)
    inside = ids < len(top.key)
    hashes[inside] = top.word[ids[inside]]
    hashes[~inside] = np.frombuffer(row["rare_words"], "<u8")[ids[~inside] - len(top.key)]
    return np.repeat(hashes[: len(sizes)], sizes), hashes[len(sizes) :]


def _ordered(context: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of pairs by context and word, and where in it another pair begins."""
    order = np.lexsort((word, context))
    context, word = context[order], word[order]
    new = np.ones(len(order), bool)
    new[1:] = (context[1:] != context[:-1]) | (word[1:] != word[:-1])
    return order, np.flatnonzero(new)


_COUNTED = _PAIRS + ", context long, c long, p double, rare long, " + ", ".join(f"n{r} long" for r in range(1, K + 2))


def _sum_of(rows: pa.Table, top: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct pairs of all rows, sorted, with the sums of their counts.

    The pairs of a row are sorted, so those of a range of contexts lie together: the ranges are sorted one by one,
    and what sorting takes follows a range.
    """
    cuts = [np.uint64(k * (1 << 64) // _RANGES) for k in range(1, _RANGES)]
    parts: list[list[tuple]] = [[] for _ in range(_RANGES)]
    for row in _rows_of(rows):
        context, word = _pairs_of(row, top)
        n = _unpacked(row["n"])
        at = [0, *np.searchsorted(context, cuts).tolist(), len(n)]
        for part, a, b in zip(parts, at, at[1:]):
            part.append((context[a:b].copy(), word[a:b].copy(), n[a:b].astype(np.int32 if b - a and n[a:b].max() < 1 << 31 else np.int64)))
    summed = []
    for k in range(_RANGES):
        context, word, n = (np.concatenate(x) for x in zip(*parts[k]))
        parts[k] = []
        order, first = _ordered(context, word)
        summed.append((context[order[first]], word[order[first]], np.add.reduceat(n[order].astype(np.int64), first) if len(n) else n[:0]))
    context, word, n = (np.concatenate(x) for x in zip(*summed))
    return context, word, n.astype(np.int64, copy=False)


def _rows_of(table: pa.Table) -> Iterator[dict]:
    """The rows one by one, so that only one row's arrays are taken out of the table at once."""
    for batch in table.to_batches(max_chunksize=1):
        yield from batch.to_pylist()


def _in_batches(table: pa.Table) -> pa.Table:
    """The table in batches of at most ``_OUT_ROWS`` rows, as which it goes back to the executor."""
    return pa.Table.from_batches(table.to_batches(max_chunksize=_OUT_ROWS), table.schema)


def _count_pairs(group: pa.Table, top: Words) -> pa.Table:
    """Of a bucket: one row with its pairs and counts, one for each context, and one for each pair with a rare word.

    The row of a context has the sum of its counts, the numbers of its pairs counted 1 to K + 1 times, and the
    probabilities of their words that are in the table of frequent ones.
    """
    bucket = group.column("bucket")[0].as_py()
    context, word, n = _sum_of(group, top)
    begins = np.flatnonzero(np.diff(context, prepend=~context[:1]))
    sizes = np.diff(begins, append=len(n))
    known = top.counts(word)
    frequent = np.where(known > 0, top.probability(known), 0.0)
    rare = np.flatnonzero(known == 0)
    used, place = np.unique(np.concatenate((context[begins], word)), return_inverse=True)
    arrays = _arrays(place[: len(begins)], sizes, used, place[len(begins) :], top.places(used), len(top.key))
    whole = {"bucket": bucket, **arrays, "n": _packed(n)}
    sums = {
        "bucket": np.full(len(begins), bucket, np.int32), "context": context[begins].view(np.int64), "c": np.add.reduceat(n, begins),
        "p": np.add.reduceat(frequent, begins), **{f"n{r}": np.add.reduceat((n == r).astype(np.int64), begins) for r in range(1, K + 2)},
    }
    schema = _arrow(_COUNTED)
    tables = [pa.Table.from_pylist([whole], schema=schema), _partial(sums, schema)]
    if len(rare):
        tables.append(_partial({"context": context[rare].view(np.int64), "rare": word[rare].view(np.int64)}, schema))
    return _in_batches(pa.concat_tables(tables))


def _given_back(result: pa.Table) -> pa.Table:
    """The result of a group; what its arrays took is given back, as the worker goes on to other stages."""
    give_back()
    return result


def _partial(columns: dict, schema: pa.Schema) -> pa.Table:
    """A table of the schema in which the other columns are NULL."""
    rows = len(next(iter(columns.values())))
    return pa.Table.from_arrays([pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(rows, f.type) for f in schema], schema=schema)


@dataclass(frozen=True)
class KatzModel:
    """``words`` (word, c), ``pairs`` (a row of arrays for each bucket), ``contexts`` (bucket, context, denominator, log_alpha)."""

    words: DataFrame
    pairs: DataFrame
    contexts: DataFrame
    buckets: int
    top: Words
    shared: Broadcast[Words]  # ``top`` on the executors: a worker that trains and scores holds it once
    discount: np.ndarray


def _word_probability(top: Words, c: Column) -> Column:
    """Probability of a word by its count column, NULL or 0 for a word that was not counted."""
    by_count = F.element_at(F.array(*[F.lit(float(d)) for d in top.discount[1:]]), F.least(c, F.lit(K + 1)).cast("int"))
    return F.when(c > 0, by_count * c / top.denominator).otherwise(top.unknown)


def _words(counted: DataFrame) -> Words:
    """The frequent words of (word, c). The counts' own counts are at most the root of twice the tokens many."""
    sizes = sorted(((r.c, r.n) for r in counted.groupBy("c").agg(F.count(F.lit(1)).alias("n")).collect()), reverse=True)
    tokens, distinct = sum(c * n for c, n in sizes), sum(n for _, n in sizes)
    least, held = None, 0
    for c, n in sizes:
        held += n
        if held > TOP_WORDS:
            break
        least = c
    kept = counted.where(F.col("c") >= least) if least is not None else counted.limit(0)
    table = kept.orderBy("word").toArrow()
    key, count = (np.asarray(table.column(name).to_numpy(), np.int64) for name in ("word", "c"))
    order = np.lexsort((key, -count))
    word, count = key.view(np.uint64)[order], count[order]
    place = np.argsort(word)
    by_count = dict(sizes)
    discount = good_turing([by_count.get(r, 0) for r in range(1, K + 2)])
    mass = sum(discount[min(c, K + 1)] * c * n for c, n in sizes)
    denominator = tokens if mass < tokens else tokens + 1
    unknown = 1.0 - float(mass) / denominator
    return Words(word, count, word[place], place, tokens, distinct, discount, denominator, unknown)


def train(docs: DataFrame, text: str = "text") -> KatzModel:
    """The model of all texts of ``docs``; NULL counts as empty, an empty table gives the model that knows no word."""
    spark = docs.sparkSession
    bound_batches(spark)
    texts = docs.select(quoted(text).cast("string").alias("text"))
    counted = texts.mapInArrow(_count_words, "word long, c long").groupBy("word").agg(F.sum("c").alias("c"))
    words = materialise(counted, "katz-words")
    top = _words(words)
    buckets = max(1, -(-top.tokens // BUCKET_TOKENS))
    shared = spark.sparkContext.broadcast(top)  # TOP_WORDS words at most
    emitted = texts.mapInArrow(lambda batches: _emit_training(batches, shared.value, buckets), _PAIRS)
    counted = emitted.groupBy("bucket").applyInArrow(lambda group: _given_back(_count_pairs(group, shared.value)), _COUNTED)
    counted = materialise(counted, "katz-pairs")
    pairs = counted.where(F.col("ids").isNotNull()).select("bucket", "ids", "sizes", "rare_words", "n")

    classes = [f"n{r}" for r in range(1, K + 2)]
    parts = counted.where(F.col("context").isNotNull() & F.col("rare").isNull()).select("bucket", "context", "c", "p", *classes)
    totals = [F.sum(n).alias(n) for n in classes]
    row = parts.agg(*totals).first()
    discount = good_turing([row[n] or 0 for n in classes])
    missing = counted.where(F.col("rare").isNotNull()).select("context", F.col("rare").alias("word"))
    missing = missing.join(words, "word").groupBy("context").agg(F.sum(_word_probability(top, F.col("c"))).alias("p_rare"))
    sums = parts.groupBy("context").agg(F.sum("c").alias("c"), F.sum("p").alias("p"), *totals)
    low = sum((F.col(f"n{r}") * r * float(discount[r]) for r in range(1, K + 1)), F.lit(0.0))
    kept = low + F.col("c") - sum((F.col(f"n{r}") * r for r in range(1, K + 1)), F.lit(0))
    discounted = sum((F.col(f"n{r}") for r in range(1, K + 1) if discount[r] < 1), F.lit(0)) > 0
    denominator = F.when(discounted, F.col("c")).otherwise(F.col("c") + 1)
    alpha = (1 - F.col("kept") / F.col("denominator")) / (1 - F.col("p") - F.coalesce("p_rare", F.lit(0.0)))
    weighed = sums.select("context", "p", kept.alias("kept"), denominator.cast("double").alias("denominator"))
    weighed = weighed.join(missing, "context", "left").select("context", "denominator", F.log10(alpha).alias("log_alpha"))
    contexts = materialise(parts.select("bucket", "context").join(weighed, "context"), "katz-contexts")
    return KatzModel(words, pairs, contexts, buckets, top, shared, discount)


def _emit_scoring(batches: Iterator[pa.RecordBatch], top: Words, buckets: int, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Of (uid, row, text): the pairs by bucket with their texts, one row for each text, and one for each rare word of a text."""
    for batch in batches:
        for a, b, texts in text_chunks(batch.column(2)):
            uid = np.asarray(batch.column(0).slice(a, b - a).to_numpy(zero_copy_only=False), np.int64)
            tokens, text = tokens_of(texts)
            words, place = np.unique(tokens, return_inverse=True)
            count = top.counts(words)
            starts = np.flatnonzero(np.diff(text, prepend=-1))
            opening = np.zeros(len(tokens), np.int64)
            opening[starts] = 1  # the first token has no context: it is a word from the start
            c = count[place]
            known = c > 0
            score = np.where(known & (opening == 1), np.log10(top.probability(c)), 0.0)
            out = {
                "bucket": (uid % buckets).astype(np.int32), "uid": uid, "row": batch.column(1).slice(a, b - a),
                "score": np.add.reduceat(score, starts), "base": np.add.reduceat(np.where(known, top.base(c), 0.0), starts),
                "n_tokens": np.diff(starts, append=len(tokens)), "n_known": np.add.reduceat(known.astype(np.int64), starts),
            }
            yield from _partial(out, schema).to_batches(max_chunksize=_OUT_ROWS)
            rare = np.flatnonzero(~known)
            if len(rare):
                (owner, word, first), n = distinct_rows([text[rare], place[rare], opening[rare]])
                owner, word, first = owner.astype(np.int64), word.astype(np.int64), first.astype(np.int64)
                yield from _partial({
                    "bucket": (uid[owner] % buckets).astype(np.int32), "uid": uid[owner], "token": words[word].view(np.int64),
                    "n_all": n, "n_open": n * first,
                }, schema).to_batches(max_chunksize=_OUT_ROWS)
            at = np.flatnonzero(text[1:] == text[:-1])
            if not len(at):
                continue
            (context, word, owner), n = distinct_rows([place[at], place[at + 1], text[at]])
            context, word = context.astype(np.int64), word.astype(np.int64)
            new = np.ones(len(n), bool)
            new[1:] = (context[1:] != context[:-1]) | (word[1:] != word[:-1])
            first = np.flatnonzero(new)
            size = np.diff(first, append=len(n))
            rows = []
            for k, own, arrays in _blobs(words, context[first], word[first], top, buckets):
                inside = np.repeat(first[own] - np.concatenate(([0], np.cumsum(size[own])[:-1])), size[own]) + np.arange(size[own].sum())
                rows.append({
                    "bucket": k, **arrays, "n": _packed(n[inside]), "texts": _packed(owner[inside]), "per_pair": _packed(size[own]),
                    "uids": _packed(np.diff(uid, prepend=uid[0])), "first": int(uid[0]),
                })
            yield pa.RecordBatch.from_pylist([{f: r.get(f) for f in schema.names} for r in rows], schema=schema)


class _Stored:
    """A bucket's part of the model: its pairs with their counts, and what is known of its contexts."""

    def __init__(self, model: pa.Table, top: Words):
        whole = model.filter(pa.compute.is_valid(model.column("ids")))
        context, word, self.count = _sum_of(whole, top) if whole.num_rows else (np.empty(0, np.uint64), np.empty(0, np.uint64), np.empty(0, np.int64))
        self.contexts, place = np.unique(context, return_inverse=True)
        self.words, own = np.unique(word, return_inverse=True)
        self.pair = place * max(1, len(self.words)) + own  # ascending, as the pairs are sorted
        alone = model.filter(pa.compute.is_valid(model.column("context")))
        known = np.asarray(alone.column("context").to_numpy(), np.int64).view(np.uint64)
        order = np.argsort(known)
        self.known = known[order]
        self.denominator = np.asarray(alone.column("denominator").to_numpy())[order]
        self.log_alpha = np.asarray(alone.column("log_alpha").to_numpy())[order]

    def counts(self, context: np.ndarray, word: np.ndarray) -> np.ndarray:
        """Training count of each pair, 0 for one that is not there."""
        out = np.zeros(len(context), np.int64)
        if not len(self.pair):
            return out
        place = np.minimum(np.searchsorted(self.contexts, context), len(self.contexts) - 1)
        own = np.minimum(np.searchsorted(self.words, word), len(self.words) - 1)
        both = np.flatnonzero((self.contexts[place] == context) & (self.words[own] == word))
        pair = place[both] * len(self.words) + own[both]
        at = np.minimum(np.searchsorted(self.pair, pair), len(self.pair) - 1)
        met = self.pair[at] == pair
        out[both[met]] = self.count[at[met]]
        return out


def _score_pairs(texts: pa.Table, model: pa.Table, top: Words, discount: np.ndarray, schema: pa.Schema) -> pa.Table:
    """The pairs of a bucket's texts against its part of the model, chunk by chunk; the rows of texts and words pass."""
    pairs = texts.filter(pa.compute.is_valid(texts.column("ids")))
    passed = texts.filter(pa.compute.is_null(texts.column("ids"))).select(schema.names).cast(schema)
    if not pairs.num_rows:
        return _in_batches(passed)
    stored = _Stored(model, top)
    known = stored.known
    tables = [passed]
    for r in _rows_of(pairs):
        context, word = _pairs_of(r, top)
        total = stored.counts(context, word)
        value = np.zeros(len(total))
        seen = total > 0
        if len(known):
            at = np.minimum(np.searchsorted(known, context), len(known) - 1)
            met = known[at] == context
            value[seen] = np.log10(discount[np.minimum(total[seen], K + 1)] * total[seen] / stored.denominator[at[seen]])
            value[met & ~seen] = stored.log_alpha[at[met & ~seen]]
        count = top.counts(word)
        frequent = ~seen & (count > 0)
        value[frequent] += np.log10(top.probability(count[frequent]))
        rare = ~seen & (count == 0)
        span = np.repeat(np.arange(len(total)), _unpacked(r["per_pair"]))
        uids = np.cumsum(_unpacked(r["uids"])) + r["first"]
        owner, n = _unpacked(r["texts"]), _unpacked(r["n"])
        sums = np.bincount(owner, value[span] * n, len(uids))
        hit = np.flatnonzero(np.bincount(owner, minlength=len(uids)))
        tables.append(_partial({"uid": uids[hit], "score": sums[hit]}, schema))
        left = np.flatnonzero(rare[span])
        if len(left):
            tables.append(_partial({"uid": uids[owner[left]], "token": word[span[left]].view(np.int64), "n_open": n[left]}, schema))
    return _in_batches(pa.concat_tables(tables))


def score(docs: DataFrame, model: KatzModel, text: str = "text", carry: Sequence[str] = ("doc_id",)) -> DataFrame:
    """One row per input row: ``row`` (struct of ``carry``), n_tokens, n_known, base_score, score.

    ``score`` is the base 10 logarithm of the text's probability; ``base_score`` adds up the logarithms of
    ``(c + 0.5) / (N + 0.5 (V + 1))``. NULL and empty texts are one end. Repeated rows and ids come out each,
    an empty table gives an empty result, and input columns keep their names inside ``row``.
    """
    bound_batches(docs.sparkSession)
    given = docs.select(
        F.monotonically_increasing_id().alias("uid"), F.struct(*[quoted(c) for c in carry]).alias("row"), quoted(text).cast("string").alias("text")
    )
    sums = T.StructType([T.StructField("uid", T.LongType()), T.StructField("row", given.schema["row"].dataType), *T.StructType.fromDDL(_SUMS).fields])
    arrays = T.StructType.fromDDL(_PAIRS + ", texts binary, per_pair binary, uids binary, first long")
    from pyspark.sql.pandas.types import to_arrow_schema

    emitted, out = to_arrow_schema(T.StructType([*arrays.fields, *sums.fields]), prefers_large_types=False), to_arrow_schema(sums)
    top, buckets, discount = model.shared, model.buckets, model.discount
    pairs = given.mapInArrow(lambda batches: _emit_scoring(batches, top.value, buckets, emitted), T.StructType([*arrays.fields, *sums.fields]))
    known = model.pairs.unionByName(model.contexts, allowMissingColumns=True)
    met = pairs.groupBy("bucket").cogroup(known.groupBy("bucket")).applyInArrow(
        lambda texts, own: _given_back(_score_pairs(texts, own, top.value, discount, out)) if texts.num_rows else out.empty_table(), sums
    )
    met = materialise(met, "katz-sums")
    words = met.where(F.col("token").isNotNull()).groupBy("uid", F.col("token").alias("word")).agg(
        F.coalesce(F.sum("n_all"), F.lit(0)).alias("n"), F.coalesce(F.sum("n_open"), F.lit(0)).alias("n_open")
    )
    c = F.coalesce("c", F.lit(0))
    flat = F.log10((c + 0.5) / (model.top.tokens + 0.5 * (model.top.distinct + 1)))
    settled = words.join(model.words, "word", "left").select(
        "uid", (F.col("n_open") * F.log10(_word_probability(model.top, c))).alias("score"), (F.col("n") * flat).alias("base"),
        F.when(c > 0, F.col("n")).otherwise(0).cast("long").alias("n_known"),
    )
    every = met.where(F.col("token").isNull()).unionByName(settled, allowMissingColumns=True)
    return every.groupBy("uid").agg(
        F.first("row", ignorenulls=True).alias("row"), F.max("n_tokens").alias("n_tokens"), F.sum("n_known").alias("n_known"),
        F.sum("base").alias("base_score"), F.sum("score").alias("score"),
    ).drop("uid")


def query(spark, folder: str) -> DataFrame:
    """Scores of every document under the model of those that are not held out."""
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 1
    held_out = F.coalesce(held_out, F.lit(False))
    model = train(docs.where(~held_out))
    scored = score(docs, model)
    own = F.crc32(F.col("row.doc_id").cast("string").cast("binary")) % 5 == 1
    return scored.select(
        "row.doc_id", F.coalesce(own, F.lit(False)).alias("held_out"), "n_tokens", "n_known",
        F.lit(model.top.tokens).cast("long").alias("train_tokens"), "base_score", "score",
    )
