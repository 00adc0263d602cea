"""Byte-level BPE encoding and decoding without regular expressions on the texts.

Pre-tokenisation works on arrays of code points: every character becomes one of nine symbols (its class,
and for white space and apostrophes what follows), and a finite automaton over these symbols says where a
piece begins. The automaton's transition functions generate a small monoid, so running it is an
associative scan: rows of characters are composed side by side by table lookup, then the rows' totals,
then every character's state is read off. The pieces between boundaries go through a cache of merged
pieces; only a piece not in the cache is merged pair by pair.
"""

from __future__ import annotations

import base64
import heapq
import os
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from relweave.llm.exact_dedup import quoted
from relweave.llm.words import chunks
from relweave.session import bound_batches

CHUNK_BYTES = 1 << 20
CACHE_BYTES = 16 << 20  # of a generation of the cache, with what Python needs to hold a piece
_PIECE_BYTES = 200
_SLICE = 512  # rows that are worked on together
_ROW = 64

# symbols: letter, number, other; apostrophe of a contraction with one or two letters; white space inside or
# at the end of a text, last white space before a character (not a space, a space), end of text
_L, _N, _O, _A1, _A2, _W, _WL, _WS, _E = range(9)
# states: nothing open, in letters, in numbers, in others, in white space, after a space that joins the
# next piece, one or two letters of a contraction to come
_START, _INL, _INN, _INO, _INW, _JOIN, _ONE, _TWO = range(8)


def _automaton() -> tuple[np.ndarray, np.ndarray]:
    """Next state and "a piece begins here", by state and symbol."""
    move = np.zeros((8, 9), np.uint8)
    begins = np.ones((8, 9), bool)
    for state in range(8):
        for symbol, own in ((_L, _INL), (_N, _INN), (_O, _INO)):
            move[state, symbol] = own
            begins[state, symbol] = state not in (own, _JOIN)
        for symbol, own in ((_A1, _ONE), (_A2, _TWO)):
            in_others = state in (_INO, _JOIN)
            move[state, symbol] = _INO if in_others else own
            begins[state, symbol] = not in_others
        move[state, [_W, _WL, _WS, _E]] = _INW, _START, _JOIN, _START
        begins[state, _W] = state != _INW
    move[_ONE, :_W], begins[_ONE, :_W] = _START, False
    move[_TWO, :_W], begins[_TWO, :_W] = _ONE, False
    return move, begins


def _monoid(move: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All compositions of the transition functions: their values, their products and the symbols' numbers."""
    known = {tuple(range(8)): 0}
    todo = [tuple(range(8))]
    steps = [tuple(move[:, s].tolist()) for s in range(move.shape[1])]
    while todo:
        f = todo.pop()
        for step in steps:
            g = tuple(step[x] for x in f)
            if g not in known:
                known[g] = len(known)
                todo.append(g)
    values = np.array(list(known), np.uint8)
    product = np.array([[known[tuple(g[x] for x in f)] for g in known] for f in known], np.uint16)
    return values, product, np.array([known[s] for s in steps], np.uint16)


_MOVE, _BEGINS = _automaton()
_VALUES, _PRODUCT, _NUMBER = _monoid(_MOVE)
_FLAT_PRODUCT, _SIZE = _PRODUCT.ravel(), len(_VALUES)


def _scan(functions: np.ndarray) -> np.ndarray:
    """Inclusive prefix products of function numbers."""
    n = len(functions)
    if n <= _ROW:
        out = functions.copy()
        for i in range(1, n):
            out[i] = _PRODUCT[out[i - 1], functions[i]]
        return out
    rows = -(-n // _ROW)
    padded = np.zeros(rows * _ROW, np.uint16)  # 0 is the identity
    padded[:n] = functions
    columns = np.ascontiguousarray(padded.reshape(rows, _ROW).T)
    for j in range(1, _ROW):
        columns[j] = _FLAT_PRODUCT[columns[j - 1].astype(np.int32) * _SIZE + columns[j]]
    before = np.zeros(rows, np.uint16)
    before[1:] = _scan(columns[-1].copy())[:-1]
    return _FLAT_PRODUCT[before.astype(np.int32) * _SIZE + columns].T.reshape(-1)[:n]


def boundaries(symbols: np.ndarray) -> np.ndarray:
    """Where a piece begins, for the symbols of texts that each end with the end symbol."""
    prefix = _scan(_NUMBER[symbols])
    state = np.zeros(len(symbols), np.uint8)
    state[1:] = _VALUES[prefix[:-1], _START]
    return np.flatnonzero(_BEGINS.ravel()[state.astype(np.int32) * 9 + symbols])


def character_classes() -> np.ndarray:
    """Class of every code point (letter 0, number 1, other 2, white space 5) by the library's own Unicode tables."""
    every = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c <= 0xDFFF)
    byte_ranks = {bytes([i]): i for i in range(256)}
    table = np.full(0x110000, _O, np.uint8)
    for pattern, symbol in ((r"\p{L}", _L), (r"\p{N}", _N), (r"\s", _W)):
        only = tiktoken.Encoding("class", pat_str=pattern, mergeable_ranks=byte_ranks, special_tokens={})
        matched = bytes(only.encode_ordinary(every)).decode()
        table[np.frombuffer(matched.encode("utf-32-le"), np.uint32)] = symbol
    return table


def symbols_of(points: np.ndarray, ends: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """Symbols of code points; ``ends`` are the places of the end marks."""
    s = classes[points]
    s[ends] = _E
    space = s == _W
    last = np.zeros(len(s), bool)
    last[:-1] = space[:-1] & ~space[1:] & (s[1:] != _E)
    s[last] = np.where(points[last] == 0x20, _WS, _WL)
    quote = np.flatnonzero(points == 0x27)
    if len(quote):
        wide = np.concatenate((points, np.zeros(2, points.dtype)))
        one, two = wide[quote + 1], wide[quote + 2]
        is_end = np.zeros(len(wide), bool)
        is_end[ends] = True
        one, two = np.where(is_end[quote + 1], 0, one), np.where(is_end[quote + 2], 0, two)
        short = np.isin(one, [ord(c) for c in "stmd"])
        long = (np.isin(one, [ord("r"), ord("v")]) & (two == ord("e"))) | ((one == ord("l")) & (two == ord("l")))
        s[quote[short]] = _A1
        s[quote[long]] = _A2
    return s


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class Encoder(dict):
    """Piece of text to its ids as little-endian 32-bit bytes; itself the cache of merged pieces.

    The cache has two generations of at most ``CACHE_BYTES``, so that common pieces survive when rare
    ones go; a longer piece than 64 characters is not kept.
    """

    def __init__(self, ranks: dict[bytes, int], classes: np.ndarray):
        super().__init__()
        self.ranks, self.classes, self.older, self.held = ranks, classes, {}, 0
        self.tokens = tokens_by_rank(ranks)

    def __missing__(self, piece: str) -> bytes:
        ids = self.older.get(piece)
        if ids is None:
            ids = np.array(self.merge(piece.encode()), "<u4").tobytes()
        if len(piece) <= 64:
            if self.held >= CACHE_BYTES:
                self.older = dict(self)
                self.clear()
                self.held = 0
            self[piece] = ids
            self.held += _PIECE_BYTES + len(piece) + len(ids)
        return ids

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))

    def merge(self, piece: bytes) -> list[int]:
        """Always merge the pair of lowest rank, the leftmost of equals, until none is left."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        return self._merge_short(piece) if len(piece) <= 64 else self._merge_long(piece)

    def _merge_short(self, piece: bytes) -> list[int]:
        get, none = self.ranks.get, 1 << 40
        at = list(range(len(piece) + 1))
        pairs = [get(piece[i : i + 2], none) for i in range(len(piece) - 1)]
        while pairs and (lowest := min(pairs)) != none:
            i = pairs.index(lowest)
            del at[i + 1], pairs[i]
            if i < len(pairs):
                pairs[i] = get(piece[at[i] : at[i + 2]], none)
            if i:
                pairs[i - 1] = get(piece[at[i - 1] : at[i + 1]], none)
        return [self.ranks[piece[a:b]] for a, b in zip(at, at[1:])]

    def _merge_long(self, piece: bytes) -> list[int]:
        """The same by a heap, for pieces where a scan per merge would take quadratic time."""
        get, n = self.ranks.get, len(piece)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))  # the parts as a linked list of starts
        pair = {i: r for i in range(n - 1) if (r := get(piece[i : i + 2])) is not None}
        heap = [(r, i) for i, r in pair.items()]
        heapq.heapify(heap)

        def rate(i: int, stop: int) -> None:
            r = get(piece[i:stop])
            if r is None:
                pair.pop(i, None)
            else:
                pair[i] = r
                heapq.heappush(heap, (r, i))

        while heap:
            rank, i = heapq.heappop(heap)
            if pair.get(i) != rank:
                continue
            j = after[i]
            after[i] = k = after[j]
            pair.pop(j, None)
            if k < n:
                before[k] = i
                rate(i, after[k])
            else:
                pair.pop(i, None)
            if before[i] >= 0:
                rate(before[i], k)
        ids, i = [], 0
        while i < n:
            ids.append(self.ranks[piece[i : after[i]]])
            i = after[i]
        return ids

    def encode(self, texts: Sequence[str]) -> list[bytes]:
        """The ids of each text; texts are worked on together in chunks of characters."""
        out: list[bytes] = []
        for a, b in chunks(texts, CHUNK_BYTES):
            out += self._encode(list(texts[a:b]))
        return out

    def _encode(self, texts: list[str]) -> list[bytes]:
        joined = "\0".join(texts) + "\0"
        points = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        ends = np.cumsum([len(t) + 1 for t in texts]) - 1
        starts = boundaries(symbols_of(points, ends, self.classes))
        first = np.searchsorted(starts, ends).tolist()  # the end marks are pieces of their own
        starts = starts.tolist()
        pieces = list(map(self.__getitem__, map(joined.__getitem__, map(slice, starts, starts[1:]))))
        out, at = [], 0
        for stop in first:
            out.append(b"".join(pieces[at:stop]))
            at = stop + 1
        return out


def _safe_spans(text: str, limit: int) -> list[str]:
    """``text`` cut where white space follows something else: always a boundary, and nothing looks across it."""
    spans, at = [], 0
    while len(text) - at > limit:
        cut = at + limit
        while cut < len(text) and not (text[cut] in " \n\t" and text[cut - 1].isalnum()):
            cut += 1
        spans.append(text[at:cut])
        at = cut
    spans.append(text[at:])
    return spans


def tokens_by_rank(ranks: dict[bytes, int]) -> list[bytes | None]:
    out: list[bytes | None] = [None] * (max(ranks.values(), default=-1) + 1)
    for token, rank in ranks.items():
        out[rank] = token
    return out


_worker: dict[tuple, Encoder] = {}


def _encoder(key: tuple, ranks, classes) -> Encoder:
    """One encoder with its cache for all tasks of a Python worker."""
    if key not in _worker:
        _worker.clear()
        _worker[key] = Encoder(ranks.value, classes.value)
    return _worker[key]


def encode(docs: DataFrame, ranks_path: str, text: str = "text", carry: Sequence[str] = ("doc_id",), offsets: bool = False, decoded: bool = False) -> DataFrame:
    """One row per document: ``row`` (struct of ``carry``) and ``ids`` (binary, 32-bit little-endian each).

    ``offsets`` adds the byte offset of every id's bytes in the UTF-8 text, ``decoded`` the ``bytes`` that the
    ids stand for, as :func:`decode` gives them, in the same pass. NULL and empty texts have no ids. A very
    long text is cut at safe places, so the working arrays follow ``CHUNK_BYTES`` and not the text; a text
    without white space has no such place and is worked on whole.
    """
    bound_batches(docs.sparkSession)
    context = docs.sparkSession.sparkContext
    read = read_ranks(ranks_path)
    ranks, classes = context.broadcast(read), context.broadcast(character_classes())  # fixed sizes
    key = (os.path.basename(ranks_path), len(read))
    given = docs.select(F.struct(*[quoted(c) for c in carry]).alias("row"), quoted(text).cast("string").alias("text"))
    fields = [given.schema["row"], T.StructField("ids", T.BinaryType())]
    if offsets:
        fields.append(T.StructField("offsets", T.ArrayType(T.LongType())))
    if decoded:
        fields.append(T.StructField("bytes", T.BinaryType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(key, ranks, classes)
        lengths = token_lengths(ranks.value) if offsets else None
        for batch in (whole.slice(start, _SLICE) for whole in batches for start in range(0, whole.num_rows, _SLICE)):
            texts = batch.column("text").to_pylist()
            ids = []
            pieces, owner = [], []
            for i, t in enumerate(texts):
                spans = _safe_spans(t, CHUNK_BYTES) if t and len(t) > CHUNK_BYTES else [t or ""]
                pieces += spans
                owner += [i] * len(spans)
            for i, part in zip(owner, encoder.encode(pieces)):
                if i < len(ids):
                    ids[i].append(part)
                else:
                    ids.append([part])
            ids = [b"".join(parts) for parts in ids]
            columns = [batch.column("row"), pa.array(ids, pa.binary())]
            schema = [batch.schema.field("row"), pa.field("ids", pa.binary())]
            if offsets:
                ends = [np.cumsum(lengths[np.frombuffer(x, "<u4")]) for x in ids]
                columns.append(pa.array([[0, *e[:-1].tolist()] if len(e) else [] for e in ends], pa.list_(pa.int64())))
                schema.append(pa.field("offsets", pa.list_(pa.int64())))
            if decoded:
                columns.append(pa.array(map(encoder.decode, ids), pa.binary()))
                schema.append(pa.field("bytes", pa.binary()))
            yield pa.RecordBatch.from_arrays(columns, schema=pa.schema(schema))

    return given.mapInArrow(run, T.StructType(fields))


def token_lengths(ranks: dict[bytes, int]) -> np.ndarray:
    out = np.zeros(max(ranks.values()) + 1, np.int64)
    out[list(ranks.values())] = [len(t) for t in ranks]
    return out


def decode(encoded: DataFrame, ranks_path: str, ids: str = "ids") -> DataFrame:
    """``encoded`` with ``bytes``, the bytes behind ``ids``; a NULL list gives NULL. Fails on an unknown id."""
    bound_batches(encoded.sparkSession)
    ranks = encoded.sparkSession.sparkContext.broadcast(read_ranks(ranks_path))
    schema = T.StructType([*encoded.schema.fields, T.StructField("bytes", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        behind = tokens_by_rank(ranks.value).__getitem__
        for batch in batches:
            out = [
                None if x is None else b"".join(map(behind, np.frombuffer(x, "<u4").tolist()))
                for x in batch.column(ids).to_pylist()
            ]
            yield batch.append_column("bytes", pa.array(out, pa.binary()))

    return encoded.mapInArrow(run, schema)


def query(spark, folder: str) -> DataFrame:
    """Number of ids and the digests of ids and decoded bytes, for every document."""
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    return encode(docs, path, decoded=True).select(
        "row.doc_id", F.expr("octet_length(ids) div 4").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("bytes", 256).alias("decoded_sha256"),
    )
