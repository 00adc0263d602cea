"""Language identification by a bidirectional gated recurrent network over bytes.

Two GRUs of a few units read the bytes forwards and backwards; a softmax over both states labels every
position, and a document's probabilities are the mean over its positions with letters. The network is
trained here, in numpy, by backpropagation through time, on a bounded sample of labelled documents
(``MOST_DOCUMENTS`` of each language, ``MOST_BYTES`` bytes each at most). Whole texts are labelled: they
are cut into segments that run side by side, each with ``WARM`` bytes more on either side for the states.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from relweave.llm.exact_dedup import quoted
from relweave.llm.toxicity import held_out
from relweave.llm.words import chunks

UNITS, SEGMENT, WARM = 8, 128, 16
MOST_DOCUMENTS, MOST_BYTES = 800, 1 << 20
STEPS, BATCH, RATE = 400, 192, 0.02
CHUNK_BYTES = 1 << 19
UNKNOWN = "und"
#: Bytes of letters, and everything outside ASCII.
_LETTER = np.array([65 <= b <= 90 or 97 <= b <= 122 or b >= 128 for b in range(256)])


def _sigmoid(x: np.ndarray) -> np.ndarray:
    x *= 0.5
    np.tanh(x, out=x)
    x += 1
    x *= 0.5
    return x


@dataclass
class Gru:
    """One direction: input gates by byte (update, reset, candidate) and the recurrent weights."""

    inputs: np.ndarray  # (3 units, 256)
    gates: np.ndarray  # (2 units, units)
    candidate: np.ndarray  # (units, units)

    @staticmethod
    def new(rng: np.random.Generator, units: int) -> Gru:
        def draw(*shape: int, scale: float) -> np.ndarray:
            return (rng.standard_normal(shape) * scale).astype(np.float32)

        return Gru(draw(3 * units, 256, scale=0.5), draw(2 * units, units, scale=0.4), draw(units, units, scale=0.4))

    def run(self, data: np.ndarray, trace: list | None = None) -> np.ndarray:
        """States (steps, units, sequences) for bytes (steps, sequences); ``trace`` gets what training needs."""
        steps, n = data.shape
        units = len(self.candidate)
        h = np.zeros((units, n), np.float32)
        out = np.empty((steps, units, n), np.float32)
        for t in range(steps):
            x = self.inputs.take(data[t], axis=1)
            gate = x[: 2 * units]
            gate += self.gates @ h
            _sigmoid(gate)
            z, r = gate[:units], gate[units:]
            c = x[2 * units :]
            c += self.candidate @ (r * h)
            np.tanh(c, out=c)
            if trace is not None:
                trace.append((h, z, r, c))
            step = c - h
            step *= z
            h = np.add(h, step, out=out[t])
        return out

    def back(self, data: np.ndarray, trace: list, slope: np.ndarray) -> Gru:
        """Gradients of the weights from the slope of the loss at every state."""
        steps, n = data.shape
        units = len(self.candidate)
        gates, candidate = np.zeros_like(self.gates), np.zeros_like(self.candidate)
        by_input = np.empty((steps, 3 * units, n), np.float32)
        carried = np.zeros((units, n), np.float32)
        for t in range(steps - 1, -1, -1):
            h, z, r, c = trace[t]
            dh = slope[t] + carried
            dc = dh * z * (1 - c * c)
            back = self.candidate.T @ dc
            dz, dr = dh * (c - h) * z * (1 - z), back * h * r * (1 - r)
            both = np.concatenate((dz, dr))
            gates += both @ h.T
            candidate += dc @ (r * h).T
            carried = dh * (1 - z) + back * r + self.gates.T @ both
            by_input[t, : 2 * units], by_input[t, 2 * units :] = both, dc
        flat = data.ravel()
        order = np.argsort(flat, kind="stable")
        values, first = np.unique(flat[order], return_index=True)
        inputs = np.zeros_like(self.inputs)
        inputs[:, values] = np.add.reduceat(by_input.transpose(0, 2, 1).reshape(-1, 3 * units)[order], first).T
        return Gru(inputs, gates, candidate)


@dataclass
class Network:
    """Both directions and the softmax over their states."""

    languages: list[str]
    forwards: Gru
    backwards: Gru
    out: np.ndarray  # (languages, 2 units)
    bias: np.ndarray  # (languages, 1)

    @staticmethod
    def new(languages: Sequence[str], units: int = UNITS, seed: int = 7) -> Network:
        rng = np.random.default_rng(seed)
        out = (rng.standard_normal((len(languages), 2 * units)) * 0.3).astype(np.float32)
        return Network(list(languages), Gru.new(rng, units), Gru.new(rng, units), out, np.zeros((len(languages), 1), np.float32))

    def weights(self) -> list[np.ndarray]:
        f, b = self.forwards, self.backwards
        return [f.inputs, f.gates, f.candidate, b.inputs, b.gates, b.candidate, self.out, self.bias]

    def _softmax(self, f: np.ndarray, b: np.ndarray) -> np.ndarray:
        units = self.out.shape[1] // 2
        p = self.out[:, :units] @ f
        p += self.out[:, units:] @ b
        p += self.bias
        p -= p.max(axis=-2, keepdims=True)
        np.exp(p, out=p)
        p /= p.sum(axis=-2, keepdims=True)
        return p

    def gradients(self, data: np.ndarray, language: np.ndarray, weight: np.ndarray) -> tuple[float, list[np.ndarray]]:
        """Loss and its gradients; ``weight`` (steps, sequences) says which positions count."""
        units = self.out.shape[1] // 2
        trace_f: list = []
        trace_b: list = []
        f = self.forwards.run(data, trace_f)
        b = self.backwards.run(data[::-1], trace_b)[::-1]
        p = self._softmax(f, b)
        share = (weight / max(1.0, float(weight.sum())))[:, None, :].astype(np.float32)
        truth = np.zeros_like(p)
        truth[:, language, np.arange(len(language))] = 1
        loss = -float((np.log(np.maximum(p, 1e-12)) * truth * share).sum())
        slope = (p - truth) * share
        into = np.concatenate((np.einsum("tcn,tun->cu", slope, f), np.einsum("tcn,tun->cu", slope, b)), axis=1)
        from_f = np.matmul(self.out[:, :units].T, slope)
        from_b = np.matmul(self.out[:, units:].T, slope)
        g_f = self.forwards.back(data, trace_f, from_f)
        g_b = self.backwards.back(data[::-1], trace_b, from_b[::-1])
        return loss, [
            g_f.inputs, g_f.gates, g_f.candidate, g_b.inputs, g_b.gates, g_b.candidate, into, slope.sum(axis=(0, 2))[:, None]
        ]

    def probabilities(self, texts: Sequence[bytes]) -> np.ndarray:
        """(texts, languages): mean over the positions with letters of each whole text; zeros without one."""
        sizes = np.array([len(t) for t in texts])
        starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
        counts = -(-sizes // SEGMENT)
        owner = np.repeat(np.arange(len(texts)), counts)
        if not len(owner):
            return np.zeros((len(texts), len(self.languages)))
        within = (np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)) * SEGMENT
        joined = np.frombuffer(b"".join(texts) + b"\0", np.uint8)
        at = within[None, :] + np.arange(-WARM, SEGMENT + WARM)[:, None]
        inside = (at >= 0) & (at < sizes[owner])
        data = joined[np.where(inside, at + starts[owner], len(joined) - 1)]
        core = slice(WARM, WARM + SEGMENT)
        f = self.forwards.run(data[: WARM + SEGMENT])[WARM:]
        b = self.backwards.run(data[WARM:][::-1])[WARM:][::-1]
        letters = (_LETTER[data[core]] & inside[core]).astype(np.float32)
        total = np.zeros((len(self.languages), len(owner)), np.float32)
        for t in range(SEGMENT):
            total += self._softmax(f[t], b[t]) * letters[t]
        out = np.zeros((len(texts), len(self.languages)))
        np.add.at(out, owner, total.T)
        count = np.bincount(owner, letters.sum(axis=0), len(texts))
        return out / np.maximum(count, 1)[:, None]


def train(texts: Sequence[bytes], languages: Sequence[str], steps: int = STEPS, seed: int = 7) -> Network:
    """Fit to labelled texts: random segments of many lengths, every language as often, Adam. No text gives no language."""
    names = sorted(set(languages))
    network = Network.new(names, seed=seed)
    if not names:
        return network
    rng = np.random.default_rng(seed)
    groups = [[t for t, own in zip(texts, languages) if own == name] for name in names]
    weights = network.weights()
    m, v = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    for step in range(1, steps + 1):
        language = rng.integers(0, len(names), BATCH)
        data = np.zeros((SEGMENT + 2 * WARM, BATCH), np.uint8)
        weight = np.zeros(data.shape, np.float32)
        for k, own in enumerate(language.tolist()):
            text = groups[own][int(rng.integers(0, len(groups[own])))]
            around = WARM if rng.random() < 0.6 else 0  # a segment of a text, or a short text of its own
            size = SEGMENT if around else int(rng.integers(4, SEGMENT))
            start = 0 if rng.random() < 0.3 else int(rng.integers(0, max(1, len(text) - size + 1)))
            before = min(around, start)
            piece = np.frombuffer(text[start - before : start + size + around], np.uint8)
            data[WARM - before : WARM - before + len(piece), k] = piece
        weight[WARM : WARM + SEGMENT] = _LETTER[data[WARM : WARM + SEGMENT]]
        _, slopes = network.gradients(data, language, weight)
        rate = RATE * min(1.0, 2 * (1 - (step - 1) / steps))
        for w, g, a, b in zip(weights, slopes, m, v):
            a += 0.1 * (g - a)
            b += 0.01 * (g * g - b)
            w -= rate * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.99**step)) + 1e-8)
    return network


def fit(docs: DataFrame, text: str = "text", lang: str = "lang", order: str = "doc_id") -> Network:
    """Train on documents outside the held-out fifth, chosen by a hash of their id.

    The at most ``MOST_DOCUMENTS`` ids of each language are broadcast to the documents, so what is sent
    grows with the number of languages and not with the documents.
    """
    rows = docs.select(
        quoted(order).alias("id"), quoted(lang).alias("lang"), quoted(text).cast("string").cast("binary").alias("text")
    ).where(~held_out(order) & F.col("lang").isNotNull() & (F.octet_length("text").between(1, MOST_BYTES)))
    turn = F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("id"), "id"))
    sample = rows.select("id", "lang").withColumn("turn", turn).where(F.col("turn") <= MOST_DOCUMENTS).select("id").distinct()
    # of rows that share an id one is taken, so the sample stays bounded
    table = rows.join(F.broadcast(sample), "id").dropDuplicates(["id"]).orderBy("id").toArrow()
    return train(table.column("text").to_pylist(), table.column("lang").to_pylist())


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def predict(docs: DataFrame, network: Network, text: str = "text", carry: Sequence[str] = ("doc_id",)) -> DataFrame:
    """One row per document: ``row`` (struct of ``carry``), ``lang_pred``, ``score`` (its probability).

    NULL text and text without a letter gives ``und`` with score 0, and so does a network that has
    learned no language. Input columns stay inside ``row`` and cannot clash.
    """
    shared = docs.sparkSession.sparkContext.broadcast(network)  # a fixed number of weights
    given = docs.select(F.struct(*[quoted(c) for c in carry]).alias("row"), quoted(text).cast("string").alias("text"))
    fields = [given.schema["row"], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = shared.value
        for batch in batches:
            texts = batch.column("text").to_pylist()
            names, scores = [], []
            for a, b in chunks(texts, CHUNK_BYTES):
                known = [has_letter(t) and bool(net.languages) for t in texts[a:b]]
                p = long_texts(net, [t.encode() if k else b"" for t, k in zip(texts[a:b], known)])
                best = p.argmax(axis=1) if net.languages else np.zeros(b - a, int)
                names += [net.languages[i] if k else UNKNOWN for i, k in zip(best.tolist(), known)]
                scores += [float(p[j, i]) if k else 0.0 for j, (i, k) in enumerate(zip(best.tolist(), known))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                schema=pa.schema([batch.schema.field("row"), ("lang_pred", pa.string()), ("score", pa.float64())]),
            )

    return given.mapInArrow(run, T.StructType(fields))


def long_texts(net: Network, texts: Sequence[bytes]) -> np.ndarray:
    """Probabilities; a text beyond the chunk size is worked off in stretches, weighted by their letters."""
    if len(texts) != 1 or len(texts[0]) <= 2 * CHUNK_BYTES:
        return net.probabilities(texts)
    whole, letters = np.zeros((1, len(net.languages))), 0.0
    for start in range(0, len(texts[0]), CHUNK_BYTES):
        piece = texts[0][start : start + CHUNK_BYTES]
        n = float(_LETTER[np.frombuffer(piece, np.uint8)].sum())
        whole += net.probabilities([piece]) * n
        letters += n
    return whole / max(letters, 1.0)


def query(spark, folder: str) -> DataFrame:
    """Language of every document, learned outside the held-out fifth."""
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text", "lang")
    found = predict(docs, fit(docs)).select("row.doc_id", "lang_pred", "score")
    return found.select("doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score")
