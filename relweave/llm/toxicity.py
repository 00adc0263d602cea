"""Toxicity by multiple-instance learning: only documents have labels, sentences get scores.

A sentence scores by a logistic model over its words and the beginnings of its words; a document is
toxic unless all its sentences are clean, that is by noisy-or: ``1 - prod(1 - p_sentence)``. The model is
trained on document labels through the noisy-or, on a bounded sample (see ``MOST_TOXIC``,
``MOST_CLEAN``, ``MOST_BYTES``). Scoring is row-local: every sentence of every whole text.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from relweave.llm.exact_dedup import quoted
from relweave.llm.words import LETTERS_DIGITS, Words, chunks, find_words, give_back, mix
from relweave.session import bound_batches

#: The training sample: so many labelled documents of each class at most, each of so many bytes at most.
MOST_TOXIC, MOST_CLEAN, MOST_BYTES = 3_000, 9_000, 1 << 20
LEAST_DOCUMENTS, LEAST_Z = 3, 4.0
EPOCHS, RATE, DECAY = 250, 0.15, 1e-4
PREFIX_BYTES = (4, 5, 6, 8)
_FILTER_BITS, _SCREEN_BITS = 18, 23
_ENDS = np.array([b in b".!?\n" for b in range(256)])


def held_out(order: str) -> Column:
    """Whether a document belongs to the fifth that nothing is learned from; NULL ids count as held out."""
    return F.coalesce(F.crc32(quoted(order).cast("string")) % 5 == 0, F.lit(True))


def features(found: Words) -> list[tuple[np.ndarray, np.ndarray]]:
    """(word numbers, hashes): all words, then the words longer than each prefix by that prefix."""
    n = found.end - found.start
    out = [(np.arange(len(n)), found.hashes())]
    at = np.ndarray(len(found.buffer) - 7, "<u8", found.buffer, strides=(1,))
    first = at[found.start]
    for size in PREFIX_BYTES:
        long = np.flatnonzero(n > size)
        masked = first[long] & np.uint64((1 << 8 * size) - 1)
        out.append((long, mix(masked + np.uint64(size))))
    return out


def sentences_of(found: Words) -> tuple[np.ndarray, np.ndarray]:
    """The sentence of each word, numbered over all texts, and the first word of each sentence.

    A sentence ends at ``.``, ``!``, ``?`` or a line feed; one without a word is none.
    """
    ends = np.flatnonzero(_ENDS[np.frombuffer(found.buffer, np.uint8)])
    stretch = np.searchsorted(ends, found.start)
    new = np.ones(len(stretch), bool)
    new[1:] = stretch[1:] != stretch[:-1]
    return np.cumsum(new) - 1, np.flatnonzero(new)


def _softplus(z: np.ndarray) -> np.ndarray:
    return np.logaddexp(0.0, z)


@dataclass
class Model:
    """Sorted feature hashes with their weights, and the log-odds of a sentence without any."""

    hashes: np.ndarray
    weights: np.ndarray
    bias: float
    boundary: float = 0.0  # log-odds of a document that come out as 0.5

    def __post_init__(self):
        self.filter = np.zeros(1 << _FILTER_BITS, bool)
        self.filter[self.hashes >> np.uint64(64 - _FILTER_BITS)] = True

    def known(self, found: Words) -> tuple[np.ndarray, np.ndarray]:
        """(word number, feature number) of every occurrence of a feature of the model."""
        at, which = [], []
        for words, values in features(found):
            maybe = np.flatnonzero(self.filter[values >> np.uint64(64 - _FILTER_BITS)])
            place = np.searchsorted(self.hashes, values[maybe])
            place[place == len(self.hashes)] = 0
            hit = self.hashes[place] == values[maybe] if len(self.hashes) else np.zeros(0, bool)
            at.append(words[maybe[hit]])
            which.append(place[hit])
        return np.concatenate(at), np.concatenate(which)

    def score(self, found: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Score of each text; score and first word of each sentence."""
        sentence, first = sentences_of(found)
        at, which = self.known(found)
        pairs = np.unique(sentence[at].astype(np.int64) * max(1, len(self.hashes)) + which)  # once a sentence
        z = np.full(len(first), self.bias)
        z += np.bincount(pairs // max(1, len(self.hashes)), self.weights[pairs % max(1, len(self.hashes))], len(first))
        clean = np.concatenate(([0.0], np.cumsum(_softplus(z))))
        bounds = np.searchsorted(first, found.first)
        noisy_or = np.expm1(np.minimum(clean[bounds[1:]] - clean[bounds[:-1]], 500))  # odds
        return noisy_or / (noisy_or + np.exp(self.boundary)), 1 / (1 + np.exp(-z)), first


def _telling(in_docs: np.ndarray, in_toxic: np.ndarray, rate: float) -> np.ndarray:
    """Features clearly more common in toxic documents than their share of the sample."""
    out = np.zeros(len(in_docs), bool)
    common = np.flatnonzero(in_docs >= LEAST_DOCUMENTS)  # few of a table's buckets
    in_docs, in_toxic = in_docs[common], in_toxic[common]
    out[common] = (in_toxic - rate * in_docs) / np.sqrt(np.maximum(rate * (1 - rate) * in_docs, 1e-9)) > LEAST_Z
    return out


def _promising(texts: Sequence[bytes | None], y: np.ndarray) -> np.ndarray:
    """Buckets of features that may be telling, from counts in a table of fixed size."""
    in_docs, in_toxic = np.zeros(1 << _SCREEN_BITS, np.int32), np.zeros(1 << _SCREEN_BITS, np.int32)
    for a, b in chunks(texts):
        found = find_words(texts[a:b], LETTERS_DIGITS)
        doc = found.text_of()
        pairs = np.unique(np.concatenate([
            doc[words] << _SCREEN_BITS | (values >> np.uint64(64 - _SCREEN_BITS)).astype(np.int64)
            for words, values in features(found)
        ]))
        bucket = pairs & (1 << _SCREEN_BITS) - 1
        np.add.at(in_docs, bucket, 1)
        np.add.at(in_toxic, bucket[y[a + (pairs >> _SCREEN_BITS)] > 0], 1)
    return _telling(in_docs, in_toxic, y.mean())


def train(texts: Sequence[bytes | None], toxic: Sequence[int]) -> Model:
    """Fit the model to document labels. Without both classes it knows no feature and calls all clean."""
    y = np.asarray(toxic, float)
    if not 0 < y.sum() < len(y):
        return Model(np.empty(0, np.uint64), np.empty(0), -20.0)
    promising = _promising(texts, y)
    parts, n_sentences, doc_of_sentence = [], 0, []
    for a, b in chunks(texts):
        found = find_words(texts[a:b], LETTERS_DIGITS)
        sentence, first = sentences_of(found)
        doc = found.text_of() + a
        doc_of_sentence.append(doc[first])
        for words, values in features(found):
            kept = np.flatnonzero(promising[values >> np.uint64(64 - _SCREEN_BITS)])
            parts.append((values[kept], sentence[words[kept]] + n_sentences, doc[words[kept]]))
        n_sentences += len(first)
    values, sentence, doc = (np.concatenate(x) for x in zip(*parts))
    doc_of_sentence = np.concatenate(doc_of_sentence)
    del parts
    # documents with each feature, by class; only features clearly more common in toxic ones are candidates
    hashes, number = np.unique(values, return_inverse=True)
    pairs = np.unique(number.astype(np.int64) * len(y) + doc)
    in_docs = np.bincount(pairs // len(y), minlength=len(hashes))
    in_toxic = np.bincount(pairs // len(y), y[pairs % len(y)], len(hashes))
    chosen = np.flatnonzero(_telling(in_docs, in_toxic, y.mean()))
    compact = np.full(len(hashes), -1)
    compact[chosen] = np.arange(len(chosen))
    column = compact[number]
    keep = column >= 0
    pairs = np.unique(sentence[keep].astype(np.int64) * max(1, len(chosen)) + column[keep])
    row, column = pairs // max(1, len(chosen)), pairs % max(1, len(chosen))
    weights, bias = np.zeros(len(chosen)), -8.0
    m, v = np.zeros(len(chosen) + 1), np.zeros(len(chosen) + 1)
    for step in range(1, EPOCHS + 1):
        z = bias + np.bincount(row, weights[column], n_sentences)
        clean = np.bincount(doc_of_sentence, _softplus(z), len(y))
        slope = np.where(y > 0, -1 / np.expm1(np.clip(clean, 1e-9, 50)), 1.0)
        by_sentence = slope[doc_of_sentence] / (1 + np.exp(-z))
        gradient = np.append(np.bincount(column, by_sentence[row], len(chosen)), by_sentence.sum()) / len(y)
        gradient[:-1] += DECAY * weights
        m = 0.9 * m + 0.1 * gradient
        v = 0.99 * v + 0.01 * gradient**2
        change = RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
        weights, bias = weights - change[:-1], min(bias - change[-1], -4.0)
    z = bias + np.bincount(row, weights[column], n_sentences)
    clean = np.bincount(doc_of_sentence, _softplus(z), len(y))
    return Model(hashes[chosen], weights, float(bias), _boundary(clean, y))


def _boundary(clean: np.ndarray, y: np.ndarray) -> float:
    """Log-odds of a document at which the F1 of the sample is best: the middle of the gap below the last toxic one."""
    odds = np.log(np.expm1(np.clip(clean, 1e-12, 500)))
    down = np.argsort(-odds, kind="stable")
    hits = np.cumsum(y[down])
    best = int(np.argmax(2 * hits / (np.arange(1, len(y) + 1) + y.sum())))
    below = odds[down[min(best + 1, len(y) - 1)]]
    return float(np.clip((odds[down[best]] + below) / 2, -3.0, 0.5))


def fit(docs: DataFrame, labels: DataFrame, text: str = "text", order: str = "doc_id", label: str = "toxic") -> Model:
    """Train on labelled documents outside the held-out fifth.

    The sample is taken from the labels by a hash of the id; its at most ``MOST_TOXIC + MOST_CLEAN`` ids
    are broadcast to the documents. Repeated labels of an id count as toxic if one is; NULL labels are none.
    """
    rows = labels.where(~held_out(order) & quoted(label).isNotNull())
    by_id = rows.groupBy(quoted(order).alias("id")).agg(F.max(quoted(label).cast("int")).alias("label"))
    sample = by_id.where("label = 1").orderBy(F.xxhash64("id"), "id").limit(MOST_TOXIC).unionByName(
        by_id.where("label = 0").orderBy(F.xxhash64("id"), "id").limit(MOST_CLEAN)
    )
    given = docs.select(quoted(order).alias("id"), quoted(text).cast("string").cast("binary").alias("text"))
    given = given.where(F.col("text").isNotNull() & (F.octet_length("text") <= MOST_BYTES))
    # of rows that share an id one is taken, so the sample stays bounded
    table = given.join(F.broadcast(sample), "id").dropDuplicates(["id"]).orderBy("id").toArrow()
    texts, toxic = table.column("text").to_pylist(), table.column("label").to_pylist()
    del table
    model = train(texts, toxic)
    del texts
    give_back()  # the driver goes on to other work
    return model


def score_documents(
    docs: DataFrame, model: Model, text: str = "text", carry: Sequence[str] = ("doc_id",), locate: bool = False
) -> DataFrame:
    """One row per document: ``row`` (struct of ``carry``) and ``score``.

    ``locate`` adds ``sentences``, an array of ``(start, stop, score)`` of the sentences that score 0.5 or
    more, by bytes of the UTF-8 text from the first to the last word. NULL, empty and wordless texts have
    no sentence and score 0. Input columns stay inside ``row`` and cannot clash.
    """
    bound_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # as many features as the sample has, at most
    given = docs.select(F.struct(*[quoted(c) for c in carry]).alias("row"), quoted(text).cast("string").alias("text"))
    spans = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64()), ("score", pa.float64())]))
    fields = [given.schema["row"], T.StructField("score", T.DoubleType())]
    if locate:
        fields += T.StructType.fromDDL("sentences array<struct<start:long,stop:long,score:double>>").fields

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            scores, found_spans = np.zeros(len(texts)), [[] for _ in texts]
            for a, b in chunks(texts):
                found = find_words(texts[a:b], LETTERS_DIGITS)
                if not len(found.start):
                    continue
                scores[a:b], p, first = shared.value.score(found)
                if locate:
                    last = np.append(first[1:], len(found.start)) - 1
                    for s in np.flatnonzero(p >= 0.5).tolist():
                        i = int(np.searchsorted(found.first, first[s], "right")) - 1
                        base = int(found.text_start[i])
                        found_spans[a + i].append({
                            "start": int(found.start[first[s]]) - base, "stop": int(found.end[last[s]]) - base,
                            "score": float(p[s]),
                        })
            columns, names = [batch.column("row"), pa.array(scores)], [batch.schema.field("row"), pa.field("score", pa.float64())]
            if locate:
                columns.append(pa.array(found_spans, spans))
                names.append(pa.field("sentences", spans))
            yield pa.RecordBatch.from_arrays(columns, schema=pa.schema(names))

    return given.mapInArrow(run, T.StructType(fields))


def drop_toxic(docs: DataFrame, labels: DataFrame, text: str = "text", order: str = "doc_id") -> DataFrame:
    """``docs`` with its own columns, without the documents that score 0.5 or more."""
    bound_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, text, order))
    place = docs.columns.index(text)

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = score_texts(shared.value, batch.column(place).cast(pa.binary()).to_pylist())
            yield batch.filter(pa.array(scores < 0.5))

    plain = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])  # names with dots do not pass mapInArrow
    return plain.mapInArrow(clean, plain.schema).toDF(*docs.columns)


def score_texts(model: Model, texts: Sequence[bytes | None]) -> np.ndarray:
    scores = np.zeros(len(texts))
    for a, b in chunks(texts):
        found = find_words(texts[a:b], LETTERS_DIGITS)
        if len(found.start):
            scores[a:b] = model.score(found)[0]
    return scores


def query(spark, folder: str) -> DataFrame:
    """Score of every document, learned from the labels outside the held-out fifth."""
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "toxic")
    scored = score_documents(docs, fit(docs, labels)).select("row.doc_id", "score")
    return scored.select(
        "doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )
