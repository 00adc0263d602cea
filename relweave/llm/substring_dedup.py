"""Near-duplicate passages across documents, by compact windows.

The tokens of a document are the hashes of its five-word shingles. Under one hash function, every passage
of at least ``LEAST`` shingles has a smallest token; all passages whose smallest token is the same
position ``c`` form one compact window ``(l, c, r)``: the largest stretch around ``c`` without a smaller
token. Only positions that are the smallest of some passage of ``LEAST`` shingles have a window; the
Cartesian tree over these gives its bounds. A window stands for all its passages, so there are about
``2 / LEAST`` windows a token instead of one row a passage.

Under the first function the windows are those of all runs of ``RUN`` shingles: a passage that is near has an
equal run of more than that on one side of its change, so it shares a window with its like for certain.

Windows with the same smallest token form a group. All pairs of a group of up to ``SMALL`` windows are
candidates; in a larger one every member is joined with one pivot of the group. The joined intervals must
leave room for a passage. Pairs of documents found under any of the ``HASHES`` functions are verified on the
tokens themselves. Groups are never expanded into all pairs, so a passage shared by a third of all documents
costs one pair for each of them. Windows are sorted by token once, so that whole groups pass by a task; only the
groups with a large part of all windows are spread over tasks, each member given its pivot.

A pivot settles the members that are near to it. The windows of large groups with a passage that no verified
pair covers are open: they are grouped anew, by the smallest token of each ``BAND`` shingles next to their
own, on either side. Behind words that many documents share, these tell apart what continues differently.

What is left is settled by an exact pass: an equal passage has its smallest token at the same place
in both documents and continues alike for ``CONTEXT`` shingles to one side of it. The passages of such windows
that no verified pair covers are grouped by the hash of all their words. So no passage of ``PASSAGE_WORDS``
equal words is missed.

Nor is one that is only near. A near passage of ``LEAST`` shingles has ``OTHER`` at most that are not in its like, so one of
any ``OTHER`` + 1 is. The passages beside windows of large groups that are open after all that are compared with every
text that has one of their rarest shingles beside such a window, covered there or not: first with up to
``PIVOTS`` texts for each shingle, which settle most, then what is still open with all of them.
A pair of texts is not looked for because of a longer stretch that is similar only as a whole.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from relweave.llm.exact_dedup import quoted
from relweave.llm.jaccard_join import SHINGLE, bit_filter
from relweave.llm.words import BETWEEN_SPACE, Words, chunks, find_words, mix, run_factors, runs_hash
from relweave.session import bound_batches, delete_path, materialise, scratch_path

PASSAGE_WORDS = 50
LEAST = PASSAGE_WORDS - SHINGLE + 1  # shingles of the shortest passage
HASHES = 3
CONTEXT = LEAST // 2
MARGIN = 2 * PASSAGE_WORDS  # words kept around the outermost windows of a pair: every passage has one so near its ends
SMALL = 8  # windows of a group that is compared in all pairs
BAND, BANDS = 16, 3  # shingles of a band, and bands on either side of a window's smallest token
MOST_HOT = 1_000  # groups with more than this part of all rows are joined by broadcast, so there are fewer than this
LEAST_HOT = 1_000  # windows of a group that any task can hold
GROUP_ROWS = 1 << 17  # windows that are looked at together
TEXT_WORDS = 1 << 17  # words of the texts that are looked at together
PAIRS = 128  # pairs whose shingles are made together
EXACT, BANDED = 1, 2  # kinds of the windows told apart by what is next to them; before, the kind is the function
# A near passage of LEAST shingles lacks 5 of them at most, and a change inside it costs 4 at least: so one run
# of 21 or more is equal on both sides. The windows of the first function cover every run of RUN.
RUN = 20
OTHER = LEAST - -(-8 * LEAST // 9)  # shingles of a passage of LEAST that its like may lack
LONGEST = 5 * LEAST // 4  # shingles of the longest passage that is near one of LEAST
STARTS = 1 << 14  # passages that are looked at together
PIVOTS = 16  # texts with a shingle that are compared first, before all that have it
_ROOM = int(0.8 * LEAST)
_LAST = np.uint64(0xFFFFFFFFFFFFFFFF)
_ODD = np.uint64(0x9E3779B97F4A7C15)


def node_of(words: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(words.tobytes(), digest_size=8).digest(), "little", signed=True)


def _sliding(values: np.ndarray, n: int, choose) -> np.ndarray:
    """``choose`` over each run of ``n`` values."""
    out, width = values, 1
    while 2 * width <= n:
        out = choose(out[:-width], out[width:])
        width *= 2
    return choose(out[: len(values) - n + 1], out[n - width :]) if n > width else out


def window_minima(values: np.ndarray, text_of: np.ndarray, least: int = LEAST) -> np.ndarray:
    """Positions that are the smallest of some run of ``least`` tokens within one text."""
    n = len(values) - least + 1
    if n <= 0:
        return np.empty(0, np.int64)
    low = _sliding(values, least, np.minimum)
    low[text_of[:n] != text_of[least - 1 :]] = 0  # a run over two texts is none; 0 is no token's value
    pad = np.zeros(least - 1, np.uint64)
    highest = _sliding(np.concatenate((pad, low, pad)), least, np.maximum)
    return np.flatnonzero(highest == values)


def _changes(*columns: np.ndarray) -> np.ndarray:
    """Whether each row of sorted columns differs from the one before."""
    out = np.zeros(len(columns[0]), bool)
    out[:1] = True
    for c in columns:
        out[1:] |= c[1:] != c[:-1]
    return out


def cartesian_bounds(
    values: Sequence[int], places: Sequence[int], first: Sequence[int], end: Sequence[int]
) -> tuple[np.ndarray, np.ndarray]:
    """Bounds of the compact window at each place: its subtree in the Cartesian tree of the text's values.

    A smaller token next to a window is itself the smallest of a passage, so the tree over the given
    places alone has the right bounds. Of equal tokens the left one is the smaller. Each place points to its
    neighbour, and on to where that one points while it is larger, all places at once.
    """
    n = len(values)
    values, places = np.append(np.asarray(values, np.uint64), np.uint64(0)), np.asarray(places, np.int64)
    first, end = np.asarray(first, np.int64), np.asarray(end, np.int64)
    new = _changes(first)
    before, after = np.where(new, n, np.arange(n) - 1), np.where(np.append(new[1:], True), n, np.arange(n) + 1)  # n: none
    for to, larger in ((before, np.greater), (after, np.greater_equal)):
        some = np.flatnonzero(to < n)
        while len(some):
            some = some[larger(values[to[some]], values[some])]
            to[some] = to[to[some]]
            some = some[to[some] < n]
    return np.where(before < n, np.append(places, 0)[before] + 1, first), np.where(after < n, np.append(places, 0)[after] - 1, end)


def _tokens(found: Words, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Shingle at each word, 0 where it would reach into another text, and the text of each word."""
    text_of = found.text_of()
    whole = runs_hash(words, SHINGLE)
    inside = text_of[: len(whole)] == text_of[SHINGLE - 1 :]
    return np.where(inside, np.maximum(whole, np.uint64(1)), np.uint64(0)), text_of


def packed(at: np.ndarray, left: np.ndarray, right: np.ndarray, kind: np.ndarray | int) -> np.ndarray:
    """A window without its key as one number. Beyond the shortest passage its reach makes no difference, so it ends there."""
    place = at.astype(np.int64) << 14 | np.minimum(left, LEAST).astype(np.int64) << 8
    return place | np.minimum(right, LEAST).astype(np.int64) << 2 | kind


def unpacked(place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(at, left, right, kind) of what ``packed`` made."""
    return place >> 14, place >> 8 & 63, place >> 2 & 63, place & 3


def windows_of(found: Words, words: np.ndarray, nodes: np.ndarray, fresh: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    """(key, node, place) arrays under each function, as kind of the place, for the ``fresh`` texts."""
    tokens, text_of = _tokens(found, words)
    text_of = text_of[: len(tokens)]
    for f in range(HASHES):
        values = mix(tokens ^ np.uint64(0x9E3779B97F4A7C15 * (f + 1) & 0xFFFFFFFFFFFFFFFF))
        values[tokens == 0] = _LAST  # the last words of a text begin no shingle
        at = window_minima(values, text_of, RUN if f == 0 else LEAST)
        at = at[tokens[at] != 0]
        at = at[fresh[text_of[at]]]
        first = found.first[text_of[at]]
        end = np.maximum(found.first[text_of[at] + 1] - SHINGLE, first)
        left, right = cartesian_bounds(values[at], at, first, end)
        yield values[at].view(np.int64), nodes[text_of[at]], packed(at - first, at - left, right - at, f)


_WINDOW = "key long, node long, place long"
_NAMES = ["key", "node", "place"]


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row (id, node, -1 - number of words) for each of the documents (id, text), and the windows of the texts not seen yet."""
    seen: set[int] = set()
    for batch in batches:
        texts = batch.column(1).cast(pa.binary()).to_pylist()
        n, node = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
        for a, b in chunks(texts):
            found = find_words(texts[a:b], BETWEEN_SPACE)
            words = found.hashes()
            n[a:b] = np.diff(found.first)
            fresh = np.zeros(b - a, bool)
            for i in np.flatnonzero(n[a:b] >= PASSAGE_WORDS).tolist():
                node[a + i] = own = node_of(words[found.first[i] : found.first[i + 1]])
                if own not in seen:
                    seen.add(own)
                    fresh[i] = True
            if fresh.any():
                for columns in windows_of(found, words, node[a:b], fresh):
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], _NAMES)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(node), pa.array(-1 - n)], _NAMES)


def _repeated(windows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The windows whose key occurs twice, and a few more that the bit table lets through; and the keys with a large part of them.

    There are fewer than ``MOST_HOT`` such keys. A group of up to ``LEAST_HOT`` windows is never large.
    """
    counts = windows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(F.col("key").alias("node"), "n")
    counts = materialise(counts, "passage-keys")
    bits, shared = bit_filter(counts.select("node"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.column(0).to_numpy() % bits
            yield batch.filter(pa.array((shared.value[at >> 3] >> (at & 7) & 1).astype(bool)))

    return windows.mapInArrow(run, _WINDOW), _hot(counts.select(F.col("node").alias("key"), "n"))


def _hot(counts: DataFrame) -> DataFrame:
    total = counts.agg(F.sum("n")).first()[0] or 0
    return counts.where(F.col("n") > max(total // MOST_HOT, LEAST_HOT)).select("key")


def _groups(rows: DataFrame) -> DataFrame:
    """(key, n, p) of the groups with two nodes: their windows, and the smallest node as pivot.

    A pivot stands with all its windows of the group: its stretch reaches from the first to the last.
    """
    nodes = rows.groupBy("key", "node").agg(
        F.count(F.lit(1)).alias("n"), F.min("at").alias("low"), F.max("at").alias("high"), F.max("left").alias("left"), F.max("right").alias("right")
    )
    both = nodes.groupBy("key").agg(
        F.sum("n").alias("n"), F.min(F.struct("node", "low", "high", "left", "right")).alias("p"), F.max("node").alias("last")
    )
    return both.where("p.node < last").drop("last")


def _with_group(rows: DataFrame, groups: DataFrame, total: int) -> DataFrame:
    """``rows`` joined with their one row of ``groups``.

    The few groups with a large part of the ``total`` rows are joined by broadcast, and their rows never shuffled by key.
    """
    hot = F.col("n") > total // MOST_HOT
    rest = rows.join(F.broadcast(groups.where(hot).select("key")), "key", "left_anti").join(groups.where(~hot), "key")
    return rows.join(F.broadcast(groups.where(hot)), "key").unionByName(rest)


def _whole_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[list[np.ndarray]]:
    """The columns of many rows at once, cut between two keys; the rows come sorted by key."""
    held: list[list[np.ndarray]] = []
    for batch in batches:
        if batch.num_rows:
            held.append([c.to_numpy() for c in batch.columns])
        if sum(len(c[0]) for c in held) >= GROUP_ROWS and held[0][0][0] != held[-1][0][-1]:
            columns = [np.concatenate(c) for c in zip(*held)]
            cut = int(np.searchsorted(columns[0], columns[0][-1]))
            yield [c[:cut] for c in columns]
            held = [[c[cut:] for c in columns]]
    if held:
        yield [np.concatenate(c) for c in zip(*held)]


def pairs_of_groups(key: np.ndarray, node: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Candidates among windows sorted by (key, node, place), and which windows are in a group of two nodes and in a large one.

    A candidate is a column (a, b, from_a, to_a, from_b, to_b): the nodes and the stretch of words to compare in each.
    All pairs of a small group are candidates, else members with their pivot; see ``_groups``.
    """
    at, left, right, kind = unpacked(place)
    least = np.where(kind == 0, RUN, _ROOM)
    first = np.flatnonzero(_changes(key))
    n = np.diff(np.append(first, len(key)))
    group = np.repeat(np.arange(len(first)), n)
    both = (node[first] != node[first + n - 1])[group]
    large = both & (n > SMALL)[group]
    out = []
    some = np.flatnonzero(both & ~large)
    for d in range(1, SMALL):
        i, j = some[:-d], some[d:]  # both are empty when there are no more than d
        same = (group[i] == group[j]) & (node[i] != node[j])
        i, j = i[same], j[same]
        room = np.minimum(left[i], left[j]) + np.minimum(right[i], right[j]) + 1 >= least[j]
        i, j = i[room], j[room]
        out.append((node[i], node[j], at[i], at[i], at[j], at[j]))
    own = node == node[first][group]
    pivots = np.flatnonzero(large & own)
    if len(pivots):
        start = np.flatnonzero(_changes(key[pivots]))
        which = np.zeros(len(first), np.int64)
        which[group[pivots[start]]] = np.arange(len(start))
        stretch = [f.reduceat(c[pivots], start) for f, c in ((np.minimum, at), (np.maximum, at), (np.maximum, left), (np.maximum, right))]
        rows = np.flatnonzero(large)
        out.append(_with_pivot(node[rows], place[rows], np.array([node[pivots[start]], *stretch])[:, which[group[rows]]]))
    return np.array([np.concatenate(c) for c in zip(*out)]), both, large


def _with_pivot(node: np.ndarray, place: np.ndarray, pivot: np.ndarray) -> np.ndarray:
    """The candidates of windows, each with the pivot (node, low, high, left, right) of its group, see ``_groups``."""
    at, left, right, kind = unpacked(place)
    room = np.minimum(left, pivot[3]) + np.minimum(right, pivot[4]) + 1 >= np.where(kind == 0, RUN, _ROOM)
    m = (node != pivot[0]) & room
    return np.array([pivot[0, m], node[m], pivot[1, m], pivot[2, m], at[m], at[m]])


def _outermost(pairs: np.ndarray) -> np.ndarray:
    """One column for each pair of nodes."""
    pairs = pairs[:, np.lexsort(pairs[1::-1])]
    start = np.flatnonzero(_changes(*pairs[:2]))
    return np.array([*pairs[:2, start], *(f.reduceat(c, start) for f, c in zip((np.minimum, np.maximum) * 2, pairs[2:]))])


_GROUPED = "a long, b long, from_a int, to_a int, from_b int, to_b int, windows binary"
_KINDS = [pa.int64(), pa.int64(), *[pa.int32()] * 4, pa.binary()]
_FIELDS = ["a", "b", "from_a", "to_a", "from_b", "to_b", "windows"]


def _by_node(key: np.ndarray, node: np.ndarray, place: np.ndarray) -> pa.RecordBatch:
    """A row of ``_GROUPED`` for each node, with the (key, place) of its windows as bytes."""
    order = np.argsort(node, kind="stable")
    start = np.flatnonzero(_changes(node[order]))
    items = np.stack((key[order], place[order]), axis=1).tobytes()
    ends = pa.array(16 * np.append(start, len(order)), pa.int32())
    windows = pa.Array.from_buffers(pa.binary(), len(start), [None, ends.buffers()[1], pa.py_buffer(items)])
    nothing = [pa.nulls(len(start), kind) for kind in _KINDS[1:-1]]
    return pa.RecordBatch.from_arrays([pa.array(node[order][start]), *nothing, windows], _FIELDS)


def _grouped(windows: DataFrame, repeated: DataFrame, hot: DataFrame, keep_exact: bool) -> tuple[DataFrame, DataFrame]:
    """The candidates (a, b, from_a, to_a, from_b, to_b) of the windows, and (node, windows) of some with the (key, place) of each.

    ``repeated`` has at least all windows whose key occurs twice. Those kept are
    the windows of groups of two nodes that are ``EXACT`` for ``keep_exact``, of large groups else. Windows are
    sorted by key, so that whole groups pass by; those of the ``hot`` keys are given their pivot instead.
    """
    def rows_of(pairs: np.ndarray, key: np.ndarray, node: np.ndarray, place: np.ndarray) -> Iterator[pa.RecordBatch]:
        if len(key):
            yield _by_node(key, node, place)
        if pairs.shape[1]:
            pairs = _outermost(pairs)
            nothing = pa.nulls(pairs.shape[1], pa.binary())
            yield pa.RecordBatch.from_arrays([*map(pa.array, pairs[:2]), *(pa.array(c, pa.int32()) for c in pairs[2:]), nothing], _FIELDS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns in _whole_groups(batches):
            once = _changes(*columns)  # copies of a text are seen by several tasks
            key, node, place = (c[once] for c in columns)
            pairs, both, large = pairs_of_groups(key, node, place)
            keep = both & (place & 3 == EXACT) if keep_exact else large
            yield from rows_of(pairs, key[keep], node[keep], place[keep])

    def bits(shift: int) -> Column:
        return F.shiftright("place", shift).bitwiseAND(63).cast("int")

    # by node, so that what a text shares with a pivot is one row
    most = windows.join(F.broadcast(hot), "key").distinct().repartition("node").sortWithinPartitions("node")
    most = materialise(most.select("node", "key", "place"), "passage-hot")
    groups = _groups(most.select("*", F.shiftright("place", 14).cast("int").alias("at"), bits(8).alias("left"), bits(2).alias("right")))
    groups = materialise(groups, "passage-groups")  # fewer than MOST_HOT
    few = most.join(F.broadcast(groups.where(F.col("n") <= SMALL)), "key").select(*_NAMES)
    known = groups.where(F.col("n") > SMALL).orderBy("key").select("key", "p.*").collect()
    pivots = np.array([tuple(r) for r in known], np.int64).reshape(-1, 6).T

    def run_hot(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for node, key, place in _whole_groups(batches):
            which = np.searchsorted(pivots[0], key)
            large = np.append(pivots[0], 0)[which] == key
            large &= which < pivots.shape[1]
            node, key, place, which = (c[large] for c in (node, key, place, which))
            keep = place & 3 == EXACT if keep_exact else np.ones(len(key), bool)
            yield from rows_of(_with_pivot(node, place, pivots[1:, which]), key[keep], node[keep], place[keep])

    rest = repeated.join(F.broadcast(hot), "key", "left_anti").unionByName(few)
    path = scratch_path(windows.sparkSession, "passage-groups")
    found = rest.repartition("key").sortWithinPartitions(*_NAMES).mapInArrow(run, _GROUPED).union(most.mapInArrow(run_hot, _GROUPED))
    found.write.parquet(path)
    found = windows.sparkSession.read.schema(_GROUPED).parquet(path)
    pairs = _widest(found.where("windows IS NULL").select(_FIELDS[:6]))
    kept = found.where("windows IS NOT NULL").groupBy(F.col("a").alias("node")).agg(F.collect_list("windows").alias("windows"))
    pairs, kept = materialise(pairs, "passage-pairs"), materialise(kept, "passage-large")
    delete_path(windows.sparkSession, path)
    return pairs, kept


def open_windows(n_words: int, windows: Sequence[Sequence[int]], spans: Sequence[Sequence[int]]) -> np.ndarray:
    """Whether each window (at, left, right) is the smallest token of a passage that lies in no span."""
    at, left, right = np.array(windows, np.int64).reshape(-1, 3).T
    first, last = np.array(spans, np.int64).reshape(-1, 2).T
    return _open(np.array([0, n_words]), np.zeros(len(at), np.int64), at, left, right, np.zeros(len(first), np.int64), first, last)


def _open(bounds: np.ndarray, text: np.ndarray, at: np.ndarray, left: np.ndarray, right: np.ndarray, span_text: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """``open_windows`` for many texts: text i has the words from ``bounds[i]`` on; ``text`` and ``span_text`` say whose they are."""
    begin, n_words = bounds[:-1], np.diff(bounds)
    starts = np.maximum(n_words - PASSAGE_WORDS + 1, 0)
    size = int(bounds[-1]) + 1
    edge = np.bincount(begin[span_text] + np.minimum(first, n_words[span_text]), minlength=size)
    edge -= np.bincount(begin[span_text] + np.clip(last - PASSAGE_WORDS + 2, first, n_words[span_text]), minlength=size)
    before = np.concatenate(([0], np.cumsum(np.cumsum(edge) == 0)))
    low = np.clip(at - np.minimum(left, LEAST - 1), 0, starts[text])
    high = np.clip(np.minimum(at, at + right - LEAST + 1) + 1, low, starts[text])
    return before[begin[text] + high] > before[begin[text] + low]


def parts_of(
    words: np.ndarray, bounds: np.ndarray, text: np.ndarray, at: np.ndarray, left: np.ndarray, right: np.ndarray, kind: np.ndarray
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(kind, which windows, hash) of each way to tell windows of one key apart, for the windows of many texts, see ``_open``.

    The exact ones are the ``CONTEXT`` shingles from the smallest token on, and up to it; the others are the
    smallest token of each band that the window reaches into. An equal passage has the same smallest token under
    any function, so the first one does for what is exact.
    """
    reach_out = BAND * BANDS
    text_of = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    tokens = runs_hash(words, SHINGLE)
    inside = np.flatnonzero(text_of[: len(tokens)] == text_of[SHINGLE - 1 :])
    factors = run_factors(CONTEXT)
    for side, begin in enumerate((at, at - CONTEXT + 1)):
        which = np.flatnonzero((kind == 0) & (begin >= 0) & (begin <= np.diff(bounds)[text] - SHINGLE + 1 - CONTEXT))
        place = bounds[text[which]] + begin[which]
        contexts = np.zeros(len(which), np.uint64)
        for j, factor in enumerate(factors):
            contexts += tokens[place + j] * factor
        yield EXACT, which, mix(mix(contexts) + np.uint64(side))
    # texts lie apart here, so that no band reaches into another one
    shift = reach_out * np.arange(1, len(bounds))
    apart = np.full(len(words) + reach_out * (len(bounds) + 1), _LAST)
    apart[inside + shift[text_of[inside]]] = mix(tokens[inside])
    least = _sliding(apart, BAND, np.minimum)
    own = bounds[text] + shift[text] + at
    for j in range(BANDS):
        for side, begin, reach in ((0, own + 1 + BAND * j, right), (1, own - BAND * (j + 1), left)):
            which = np.flatnonzero(reach > BAND * j)
            low = least[begin[which]]
            yield BANDED, which[low != _LAST], mix(low[low != _LAST] + np.uint64(2 + 2 * j + side))


def _flat(column: pa.Array, *fields: str) -> tuple[list[int], np.ndarray]:
    """Where each row's items of a column of arrays of structs end, and the fields of all items, one row each."""
    ends = np.cumsum(pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)).tolist()
    items = pc.list_flatten(column)
    return ends, np.array([pc.struct_field(items, f).to_numpy(zero_copy_only=False) for f in fields], np.int64)


def _texts(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, ...]]:
    """(node, words, bounds, key and place of all windows and whose they are, spans and whose they are) of some texts at a time.

    The batch has (node, words, windows, spans).
    """
    ends, spans = _flat(batch.column(3), "first", "last")
    ends = np.array([0, *ends])
    sizes = pc.binary_length(batch.column(1)).to_numpy() // 4
    start = 0
    for stop in range(1, len(sizes) + 1):
        if stop < len(sizes) and sizes[start : stop + 1].sum() <= TEXT_WORDS:
            continue
        words = np.frombuffer(b"".join(batch.column(1)[start:stop].to_pylist()), np.uint32).astype(np.uint64)
        windows = [b"".join(w) for w in batch.column(2)[start:stop].to_pylist()]
        items = np.frombuffer(b"".join(windows), np.int64).reshape(-1, 2)
        numbers = np.arange(stop - start)
        yield (
            batch.column(0)[start:stop].to_numpy(), words, np.append(0, np.cumsum(sizes[start:stop])),
            items[:, 0], items[:, 1], np.repeat(numbers, [len(w) // 16 for w in windows]),
            spans[:, ends[start] : ends[stop]], np.repeat(numbers, np.diff(ends[start : stop + 1])),
        )
        start = stop


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, node, place) of the open windows of (node, words, windows, spans), one row for each part."""
    for batch in batches:
        for node, words, bounds, key, place, text, spans, span_text in _texts(batch):
            at, left, right, kind = unpacked(place)
            wanted = _open(bounds, text, at, left, right, span_text, *spans)
            key, text, at, left, right, kind = (c[wanted] for c in (key, text, at, left, right, kind))
            if len(at):
                for new, which, part in parts_of(words, bounds, text, at, left, right, kind):
                    columns = [mix(key[which].view(np.uint64) ^ part).view(np.int64), node[text[which]], packed(at[which], left[which], right[which], new)]
                    yield pa.RecordBatch.from_arrays([*map(pa.array, columns)], _NAMES)


def open_passages(n_words: int, windows: list[tuple[int, int, int]], spans: list[tuple[int, int]]) -> np.ndarray:
    """First words of the passages in which a window (at, left, right) has its smallest token, without those inside a span."""
    starts = n_words - PASSAGE_WORDS + 1
    if starts <= 0:
        return np.empty(0, np.int64)
    wanted = np.zeros(starts, bool)
    for at, left, right in windows:
        wanted[max(at - min(left, LEAST - 1), 0) : max(min(at, at + right - LEAST + 1) + 1, 0)] = True
    for first, last in spans:
        wanted[first : max(last - PASSAGE_WORDS + 2, first)] = False
    return np.flatnonzero(wanted)


def _passages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, node, first) of the open passages of (node, words, windows, spans), the hash of its words as key."""
    for batch in batches:
        for node, words, bounds, _, place, text, spans, span_text in _texts(batch):
            out: list[tuple] = []
            windows = np.array(unpacked(place)[:3])
            ends, span_ends = (np.searchsorted(t, np.arange(len(node) + 1)).tolist() for t in (text, span_text))
            hashes = None
            for i, own in enumerate(node.tolist()):
                begin, end = int(bounds[i]), int(bounds[i + 1])
                at = open_passages(end - begin, windows[:, ends[i] : ends[i + 1]].T.tolist(), spans[:, span_ends[i] : span_ends[i + 1]].T.tolist())
                if len(at):
                    if hashes is None:
                        hashes = runs_hash(words, PASSAGE_WORDS)
                    out.append((hashes[begin + at].view(np.int64), np.full(len(at), own), at))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out)], ["key", "node", "first"])


def _arrays(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """(node, words) of the wanted nodes, 32 bits of each word's hash, once for each; see ``bit_filter``."""
    bits, shared = bit_filter(wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            node, arrays = [], []
            texts = batch.column(0).cast(pa.binary()).to_pylist()
            for a, b in chunks(texts):
                found = find_words(texts[a:b], BETWEEN_SPACE)
                words = found.hashes()
                for i in np.flatnonzero(np.diff(found.first) >= PASSAGE_WORDS).tolist():
                    own = node_of(words[found.first[i] : found.first[i + 1]])
                    at = own % bits
                    if own not in seen and shared.value[at >> 3] >> (at & 7) & 1:
                        seen.add(own)
                        node.append(own)
                        arrays.append(words[found.first[i] : found.first[i + 1]].astype(np.uint32).tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(node, pa.int64()), pa.array(arrays, pa.binary())], ["node", "words"])

    found = texts.mapInArrow(run, "node long, words binary").join(wanted, "node", "left_semi")
    return found.groupBy("node").agg(F.first("words").alias("words"))


def _runs(flags: np.ndarray) -> list[tuple[int, int]]:
    """(start, stop) of the runs of True."""
    padded = np.zeros(len(flags) + 2, bool)
    padded[1:-1] = flags
    edges = np.flatnonzero(padded[1:] != padded[:-1]).tolist()
    return list(zip(edges[0::2], edges[1::2]))


def repeated_spans(a: np.ndarray, b: np.ndarray) -> tuple[list[tuple[int, int]], list[tuple[int, int]]]:
    """(first, last) words of the passages of ``a`` that repeat in ``b``, and of ``b`` that repeat in ``a``.

    A passage of ``PASSAGE_WORDS`` equal words always counts. So does a stretch of ``b`` in which every
    ``PASSAGE_WORDS`` words share enough shingles with ``a``, if the shingle sets of both passages have a
    Jaccard similarity of 0.8 or more.
    """
    return _spans_of(runs_hash(a, SHINGLE), runs_hash(b, SHINGLE))


def _spans_of(x: np.ndarray, y: np.ndarray) -> tuple[list[tuple[int, int]], list[tuple[int, int]]]:
    """``repeated_spans`` of the texts with these shingles."""
    if min(len(x), len(y)) < LEAST:
        return [], []
    order = np.argsort(x, kind="stable")
    ordered = x[order]
    low = np.searchsorted(ordered, y)
    new = _changes(ordered)
    stop = np.append(np.flatnonzero(new), len(x))[np.cumsum(new)]  # where the run of equal shingles stops
    at = np.minimum(low, len(x) - 1)
    high = np.where(ordered[at] == y, stop[at], low)
    shared = np.concatenate(([0], np.cumsum(high > low)))
    n_shared = shared[LEAST:] - shared[:-LEAST]
    full = _runs(n_shared >= -(-8 * LEAST // 9))
    if not full:
        return [], []
    in_a, in_b = [], []
    sources = _sources(order, low, high)
    if n_shared.max() == LEAST:
        in_a, in_b = _equal_runs(x, y, sources[0], bool((high - low > 1).any()))
    for source in sources:
        for p, q in full:
            stop = q + LEAST - 1
            matched = np.flatnonzero(source[p:stop] >= 0) + p
            for start, end in _aligned(source, int(matched[0]), int(matched[-1]) + 1):
                for (low_a, high_a), (first, last) in _similar(x, y, source, start, end):
                    in_a.append((low_a, high_a + SHINGLE - 1))
                    in_b.append((first, last + SHINGLE - 2))
    return in_a, in_b


def _equal_runs(x: np.ndarray, y: np.ndarray, source: np.ndarray, repeats: bool) -> tuple[list[tuple[int, int]], list[tuple[int, int]]]:
    """(first, last) words of the passages of equal words in both; ``repeats``: whether shingles of ``y`` have several places in ``x``."""
    if repeats:
        whole_x, whole_y = (_sliding(z, LEAST, lambda one, two: one * _ODD + two) for z in (x, y))
        in_x, in_y = np.isin(whole_x, whole_y), np.isin(whole_y, whole_x)
    else:  # then equal runs are those with consecutive sources
        in_x, in_y = np.zeros(len(x) - LEAST + 1, bool), np.zeros(len(y) - LEAST + 1, bool)
        for p, q in _runs((source[1:] == source[:-1] + 1) & (source[:-1] >= 0)):
            if q - p >= LEAST - 1:
                in_y[p : q - LEAST + 2] = True
                in_x[source[p] : source[p] + q - p - LEAST + 2] = True
    return tuple([(p, q + PASSAGE_WORDS - 2) for p, q in _runs(inside)] for inside in (in_x, in_y))


def _sources(order: np.ndarray, low: np.ndarray, high: np.ndarray) -> list[np.ndarray]:
    """Place in ``x`` of each shingle of ``y``, -1 for none. Of several the one that continues the shingles before, or those after.

    ``order`` sorts ``x``; the shingles of ``y`` are at ``low`` to ``high`` there.
    """
    source = np.where(high > low, order[np.minimum(low, len(order) - 1)], -1)
    n = len(source)
    several = np.flatnonzero(high - low > 1)
    if not len(several):
        return [source]
    out = []
    known = high - low == 1
    before = np.maximum.accumulate(np.where(known, np.arange(n), -1))
    after = n - 1 - np.maximum.accumulate(np.where(known[::-1], np.arange(n), -1))[::-1]
    places_of, begin, stop = order.tolist(), low.tolist(), high.tolist()  # lists, as single items of them are read faster
    for places, near in ((several.tolist(), before.tolist()), (several[::-1].tolist(), after.tolist())):
        chosen = source.tolist()
        last = -1  # the place of several sources that was settled last
        for i in places:
            j = near[i]
            if not 0 <= j < n:
                j = -1
            if last >= 0 and (j < 0 or abs(i - last) < abs(i - j)):
                j = last
            last = i
            if j >= 0:
                wanted = chosen[j] + i - j
                k = bisect_left(places_of, wanted, begin[i], stop[i])  # sorted there, as the order is stable
                below, above = places_of[max(k - 1, begin[i])], places_of[min(k, stop[i] - 1)]
                chosen[i] = below if abs(below - wanted) <= abs(above - wanted) else above
        out.append(np.array(chosen))
    return out[:1] if np.array_equal(*out) else out


def _similar(x: np.ndarray, y: np.ndarray, source: np.ndarray, start: int, end: int) -> list[tuple[tuple[int, int], tuple[int, int]]]:
    """(first, last) in ``x`` and (start, end) in ``y`` of the stretch if it is similar as a whole, else of its similar parts."""
    def test(p: int, q: int) -> tuple[tuple[int, int], tuple[int, int]] | None:
        hits = source[p:q]
        hits = hits[hits >= 0]
        if not len(hits):
            return None
        low, high = int(hits.min()), int(hits.max())
        if 9 * len(hits) < 4 * (high - low + 1):
            return None
        one, two = set(x[low : high + 1].tolist()), set(y[p:q].tolist())
        return ((low, high), (p, q)) if 9 * len(one & two) >= 4 * (len(one) + len(two)) else None

    if end - start < LEAST:
        return []
    if whole := test(start, end):
        return [whole]
    found, size = [], LEAST
    while size < end - start:
        found += [t for p in range(start, end - size + 1) if (t := test(p, p + size))]
        size *= 2
    return found


def _aligned(source: np.ndarray, start: int, end: int) -> list[tuple[int, int]]:
    """The stretch cut where its source jumps by more than a passage: there another passage begins."""
    at = np.flatnonzero(source[start:end] >= 0) + start
    shift = source[at] - at
    cuts = np.flatnonzero(np.abs(np.diff(shift)) > PASSAGE_WORDS) + 1
    return [(int(part[0]), int(part[-1]) + 1) for part in np.split(at, cuts)]


def _shingles(texts: list[bytes]) -> list[np.ndarray]:
    """Shingles of each text, given as 32 bits of each word's hash."""
    whole = runs_hash(np.frombuffer(b"".join(texts), np.uint32).astype(np.uint64), SHINGLE)
    stops = np.cumsum([len(t) // 4 for t in texts]).tolist()
    return [whole[start : max(stop - SHINGLE + 1, start)] for start, stop in zip([0, *stops], stops)]


def _joined(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping and touching (first, last) as one."""
    out: list[tuple[int, int]] = []
    for first, last in sorted(spans):
        if out and first <= out[-1][1] + 1:
            out[-1] = out[-1][0], max(last, out[-1][1])
        else:
            out.append((first, last))
    return out


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, PAIRS):
            some = batch.slice(start, PAIRS).to_pydict()
            rows: list[tuple[int, int, int, int]] = []
            for a, b, skip_a, x, skip_b, y in zip(some["a"], some["b"], some["skip_a"], _shingles(some["x"]), some["skip_b"], _shingles(some["y"])):
                in_a, in_b = map(_joined, _spans_of(x, y))
                rows += [(a, first + skip_a, last + skip_a, b) for first, last in in_a]
                rows += [(b, first + skip_b, last + skip_b, a) for first, last in in_b]
            columns = list(zip(*rows)) if rows else [(), (), (), ()]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["node", "first", "last", "other"])


def _verified(pairs: DataFrame, arrays: DataFrame) -> DataFrame:
    """(node, first, last, other) of the passages that the pairs share."""
    def part(name: str) -> list[Column]:
        skip = F.greatest(F.lit(0), F.col(f"from_{name}") - MARGIN)
        stop = F.col(f"to_{name}") + MARGIN
        return [skip.cast("long").alias(f"skip_{name}"), F.substring("words", 4 * skip + 1, 4 * (stop - skip))]

    skip, cut = part("a")
    one = pairs.join(arrays, pairs.a == arrays.node).select("a", "b", "from_b", "to_b", skip, cut.alias("x"))
    skip, cut = part("b")
    both = one.join(arrays, one.b == arrays.node).select("a", "b", "skip_a", "x", skip, cut.alias("y"))
    return both.mapInArrow(_verify, "node long, first long, last long, other long")


def repeated_passages(docs: DataFrame, text: str = "text", order: str = "doc_id") -> DataFrame:
    """One row per input row: ``id``, ``n_words``, ``spans``, ``partner_id``.

    ``spans`` are the word ranges (first, last; merged, sorted) that repeat in another row, as passages of
    ``PASSAGE_WORDS`` words or more with a similarity of 0.8 or more; ``partner_id`` is the smallest id
    of a row found to share one. Equal texts of that length repeat as a whole. NULL, empty and shorter
    texts have none, an empty table gives an empty result, and repeats inside one text do not count.
    """
    texts = docs.select(quoted(text).cast("string").alias("text"))
    given = docs.select(quoted(order).cast("long").alias("id"), quoted(text).cast("string").alias("text"))
    spark = docs.sparkSession
    bound_batches(spark)
    path = scratch_path(spark, "passage-windows")
    given.mapInArrow(_scan, _WINDOW).write.parquet(path)
    scanned = spark.read.schema(_WINDOW).parquet(path)
    rows = scanned.where("place < 0").select(F.col("key").alias("id"), (-1 - F.col("place")).alias("n_words"), "node")
    rows = materialise(rows, "passage-documents")
    nodes = rows.where(F.col("n_words") >= PASSAGE_WORDS).groupBy("node").agg(
        F.count(F.lit(1)).alias("copies"), F.min("id").alias("least_id"), F.max("id").alias("most_id"),
        F.first("n_words").alias("n_words"),
    )
    nodes = materialise(nodes, "passage-nodes")
    windows = scanned.where("place >= 0")
    pairs, gathered = _grouped(windows, *_repeated(windows), keep_exact=False)
    delete_path(spark, path)
    ends = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).union(gathered.select("node")).distinct()
    arrays = materialise(_arrays(texts, ends), "passage-words")

    found = materialise(_verified(pairs, arrays), "passages")
    spans = _merged(found.select("node", "first", "last"))
    given = arrays.join(gathered, "node").join(spans, "node", "left").select("node", "words", "windows", "spans")
    parts = materialise(given.mapInArrow(_parts, _WINDOW), "passage-parts")
    counts = materialise(parts.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "passage-keys")
    further, alike = _grouped(parts, parts, _hot(counts), keep_exact=True)
    further = materialise(_new_pairs(further, pairs), "passage-pairs")
    found = found.union(materialise(_verified(further, arrays), "passages"))
    found = found.union(_equal(alike, arrays, _merged(found.select("node", "first", "last"))))
    covered = _merged(found.select("node", "first", "last"))
    found = found.union(_near(gathered, arrays, covered, _widest(pairs.union(further))))

    ids = nodes.select(F.col("node").alias("other"), F.col("least_id").alias("other_id"))
    partner = found.select("node", "other").distinct().join(ids, "other").groupBy("node").agg(F.min("other_id").alias("other_id"))
    ranges = _merged(found.select("node", "first", "last"))
    about = nodes.join(partner, "node", "left").join(ranges, "node", "left")
    whole = F.array(F.struct(F.lit(0).cast("long").alias("first"), (F.col("n_words") - 1).alias("last")))
    none = F.array().cast("array<struct<first:long,last:long>>")
    about = about.select(
        "node", "copies", "least_id", "most_id", "other_id",
        F.when(F.col("copies") > 1, whole).otherwise(F.coalesce("spans", none)).alias("spans"),
    )
    copy = F.when(F.col("copies") > 1, F.when(F.col("id") == F.col("least_id"), F.col("most_id")).otherwise(F.col("least_id")))
    long = rows.where(F.col("n_words") >= PASSAGE_WORDS).join(about, "node").select(
        "id", "n_words", "spans", F.least(copy, F.col("other_id")).alias("partner_id")
    )
    short = rows.where(F.col("n_words") < PASSAGE_WORDS).select("id", "n_words", none.alias("spans"), F.lit(None).cast("long").alias("partner_id"))
    return long.unionByName(short)


def _equal(gathered: DataFrame, arrays: DataFrame, covered: DataFrame) -> DataFrame:
    """(node, first, last, other) of the passages of equal words that begin in ``gathered`` windows and are not ``covered`` yet."""
    given = arrays.join(gathered, "node").join(covered, "node", "left").select("node", "words", "windows", "spans")
    rows = materialise(given.mapInArrow(_passages, "key long, node long, first long"), "passages-open")
    sides = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("node").alias("one"), F.max("node").alias("two")).where("one < two")
    other = F.when(F.col("node") == F.col("one"), F.col("two")).otherwise(F.col("one"))
    stop = (F.col("first") + PASSAGE_WORDS - 1).alias("last")
    return materialise(_with_group(rows, sides, rows.count()).select("node", "first", stop, other.alias("other")), "passages-equal")


_STRETCH = "node long, first long, shingles binary, flags binary"
_SHINGLE = "token long, node long, low int, high int"


def _covered(size: int, first: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Whether each of ``size`` places lies in one of the ranges; those that stop before they begin have none."""
    first = np.minimum(first, size)
    edge = np.bincount(first, minlength=size + 1) - np.bincount(np.clip(stop, first, size), minlength=size + 1)
    return np.cumsum(edge)[:size] > 0


def _stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The shingles around the windows of (node, words, windows, spans), with 1 where an open passage of such a window starts and 2 inside the spans.

    Only windows of the first function count: a near passage has one in common with its like.
    """
    for batch in batches:
        for node, words, bounds, _, place, text, spans, span_text in _texts(batch):
            at, left, right, kind = unpacked(place)
            at, left, right, begin = (c[kind == 0] for c in (at + bounds[text], left, right, bounds[text]))
            last = bounds[1:][text[kind == 0]] - SHINGLE
            tokens = runs_hash(words, SHINGLE)
            near = _covered(len(tokens), np.maximum(at - LONGEST + 1, begin), np.minimum(at + LONGEST - 1, last) + 1)
            low = np.maximum(at - np.minimum(LEAST - 1, left + LEAST - RUN), begin)
            high = np.minimum(at + np.minimum(0, right - RUN + 1), last - LEAST + 1)
            starts = _covered(len(tokens), low, high + 1)
            first = bounds[span_text] + spans[0]
            starts &= ~_covered(len(tokens), first, bounds[span_text] + spans[1] - PASSAGE_WORDS + 2)
            inside = _covered(len(tokens), first, bounds[span_text] + spans[1] - SHINGLE + 2)
            flags = starts + 2 * inside.astype(np.int8)
            runs = np.array(_runs(near), np.int64).reshape(-1, 2)
            if len(runs):
                own = np.searchsorted(bounds, runs[:, 0], "right") - 1
                ends = np.append(0, np.cumsum(runs[:, 1] - runs[:, 0]))
                columns = [
                    pa.Array.from_buffers(pa.binary(), len(runs), [None, pa.array(width * ends, pa.int32()).buffers()[1], pa.py_buffer(values[near].tobytes())])
                    for values, width in ((tokens, 8), (flags, 1))
                ]
                yield pa.RecordBatch.from_arrays([pa.array(node[own]), pa.array(runs[:, 0] - bounds[own]), *columns], ["node", "first", "shingles", "flags"])


def _shingles_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, ...]]:
    """(node, place, token, flags) of the shingles of some stretches at a time, one row each.

    The flags are set anew for the stretches' spans, if they have such a column.
    """
    for batch in batches:
        sizes = pc.binary_length(batch.column(3)).to_numpy()
        with_spans = batch.num_columns > 4
        ends, spans = _flat(batch.column(4), "first", "last") if with_spans else ([], None)
        ends = np.array([0, *ends])
        start = 0
        for stop in range(1, len(sizes) + 1):
            if stop < len(sizes) and sizes[start : stop + 1].sum() <= TEXT_WORDS:
                continue
            begin = np.append(0, np.cumsum(sizes[start:stop]))
            which = np.repeat(np.arange(stop - start), sizes[start:stop])
            token, flags = (np.frombuffer(b"".join(batch.column(c)[start:stop].to_pylist()), kind) for c, kind in ((2, np.int64), (3, np.int8)))
            node, first = (batch.column(c)[start:stop].to_numpy() for c in (0, 1))
            if with_spans:
                own = np.repeat(np.arange(stop - start), np.diff(ends[start : stop + 1]))
                low, whole, high = (
                    begin[own] + np.clip(s[ends[start] : ends[stop]] - first[own], 0, sizes[start:stop][own])
                    for s in (spans[0], spans[1] - PASSAGE_WORDS + 2, spans[1] - SHINGLE + 2)
                )
                flags = flags & ~_covered(len(token), low, whole).astype(np.int8) | 2 * _covered(len(token), low, high).astype(np.int8)
            yield node[which], first[which] + np.arange(len(which)) - begin[which], token, flags
            start = stop


def _marked(table: tuple[int, Broadcast], token: np.ndarray) -> np.ndarray:
    """Whether each token has its bit in the table, see ``bit_filter``."""
    at = token % table[0]
    return (table[1].value[at >> 3] >> (at & 7) & 1).astype(bool)


def rarest(n: np.ndarray, token: np.ndarray, starts: np.ndarray, inside: np.ndarray) -> np.ndarray:
    """Which shingles are among the rarest of a passage that may be near another one; ``n`` texts have each.

    A near passage has ``OTHER`` shingles at most that are not in its like, and a fifth of its different ones. So it has no
    more that no other text has, and its like has one of any that are more. Of a passage that is ``inside`` known spans
    but for its ends, nothing new repeats without a shingle of these, which are chosen if fewer texts have them.
    """
    chosen = np.zeros(len(n), bool)
    alone, known, cost = (np.append(0, np.cumsum(c)) for c in (n <= 1, inside, np.where(inside | (n <= 1), 0, n)))
    at = np.flatnonzero(starts)  # a whole passage follows
    at = at[alone[at + LEAST] - alone[at] <= OTHER]
    if not len(at):
        return chosen
    core = np.zeros(len(n) + OTHER + 1, bool)  # LEAST - OTHER shingles from here on are inside
    core[: len(n) - LEAST + OTHER + 1] = known[LEAST - OTHER :] - known[: OTHER - LEAST] == LEAST - OTHER
    ends = _sliding(core, OTHER + 1, np.maximum)
    order = np.lexsort((token, n))
    rank = np.empty(len(n), np.int32)
    rank[order] = np.cumsum(_changes(n[order], token[order]))
    texts = np.zeros(int(rank.max()) + 1, np.int64)  # that have the token of a rank
    texts[rank] = n
    view = np.lib.stride_tricks.sliding_window_view(rank, LEAST)
    for some in np.array_split(at, len(at) // STARTS + 1):
        ranks = np.sort(view[some], axis=1)
        different = np.ones(ranks.shape, np.int8)
        different[:, 1:] = ranks[:, 1:] != ranks[:, :-1]
        nth = np.cumsum(different, axis=1, dtype=np.int8)
        last = np.minimum((nth <= nth[:, -1:] // 5).sum(axis=1), OTHER)
        limit = ranks[np.arange(len(some)), last]
        some, ranks, different, limit = (c[texts[limit] > 1] for c in (some, ranks, different, limit))
        if len(some):
            price = np.where((ranks <= limit[:, None]) & (different > 0), texts[ranks], 0).sum(axis=1)
            by_end = ends[some] & (cost[some + LEAST] - cost[some] <= price)
            chosen |= _covered(len(n), some[by_end], some[by_end] + LEAST) & ~inside
            some, limit = some[~by_end], limit[~by_end]
            row, column = np.nonzero(view[some] <= limit[:, None])
            chosen[some[row] + column] = True
    return chosen & (n > 1)


def _near(gathered: DataFrame, arrays: DataFrame, covered: DataFrame, known: DataFrame) -> DataFrame:
    """(node, first, last, other) of the passages beside ``gathered`` windows that are near another one, and are not ``covered`` yet.

    Every open passage is compared with all texts that have one of its rarest shingles beside a window, after most are
    settled by a few texts for each shingle. ``known`` are the pairs (a, b, from_a, to_a, from_b, to_b) that were compared before.
    """
    given = arrays.join(gathered, "node").join(covered, "node", "left").select("node", "words", "windows", "spans")
    stretches = materialise(given.mapInArrow(_stretches, _STRETCH), "passage-stretches")

    def tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for node, _, token, _ in _shingles_of(batches):
            order = np.lexsort((token, node))
            once = _changes(node[order], token[order])
            yield pa.RecordBatch.from_arrays([pa.array(token[order][once])], ["token"])

    counts = stretches.mapInArrow(tokens, "token long").groupBy("token").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    counts = materialise(counts, "passage-shingles")
    several = bit_filter(counts.select(F.col("token").alias("node")))
    total = counts.agg(F.sum("n")).first()[0] or 0
    found, spans = None, covered.limit(0)
    for with_all in (False, True):
        probes = _probes(stretches.join(spans, "node", "left"), counts, max(total // MOST_HOT, LEAST_HOT), several)
        pairs = materialise(_new_pairs(_sharing(stretches, probes, with_all), known), "passage-pairs")
        verified = materialise(_verified(pairs, arrays), "passages")
        found = found.union(verified) if found else verified
        known = _widest(known.union(pairs))
        spans = _merged(found.select("node", "first", "last"))
    return found


def _probes(given: DataFrame, counts: DataFrame, most: int, several: tuple[int, Broadcast]) -> DataFrame:
    """(token, node, low, high) of the ``rarest`` shingles of the open passages in (node, first, shingles, flags, spans), and their first and last place.

    ``counts`` has the number of texts of each token that several have; those of more than ``most`` are joined by broadcast.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for node, at, token, flags in _shingles_of(batches):
            alone = np.append(0, np.cumsum(~_marked(several, token)))
            first = np.flatnonzero(flags & 1)  # a whole passage follows
            first = first[alone[first + LEAST] - alone[first] <= OTHER]
            if len(first):
                wanted = _covered(len(token), first, first + LEAST)
                flags = flags & ~1
                flags[first] |= 1
                columns = [token[wanted], node[wanted], (at << 2 | flags)[wanted]]
                yield pa.RecordBatch.from_arrays([*map(pa.array, columns)], ["token", "node", "place"])

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for node, place, token, n in _whole_groups(batches):
            some = rarest(n, token, (place & 1).astype(bool), (place & 2).astype(bool))
            yield _ranges(token[some], node[some], place[some] >> 2)

    shingles = materialise(given.mapInArrow(run, "token long, node long, place long"), "passage-near")
    hot = F.col("n") > most
    rest = shingles.join(F.broadcast(counts.where(hot).select("token")), "token", "left_anti").join(counts.where(~hot), "token", "left")
    ranked = rest.unionByName(shingles.join(F.broadcast(counts.where(hot)), "token"))
    ranked = ranked.select("node", "place", "token", F.coalesce("n", F.lit(1)).alias("n"))
    return materialise(ranked.repartition("node").sortWithinPartitions("node", "place").mapInArrow(choose, _SHINGLE), "passage-probes")


def _ranges(token: np.ndarray, node: np.ndarray, at: np.ndarray) -> pa.RecordBatch:
    """One row of ``_SHINGLE`` for each token of a node."""
    order = np.lexsort((at, token, node))
    token, node, at = token[order], node[order], at[order]
    start = np.flatnonzero(_changes(node, token))
    last = np.append(start[1:], len(at)) - 1 if len(start) else start
    return pa.RecordBatch.from_arrays([pa.array(token[start]), pa.array(node[start]), *(pa.array(at[i], pa.int32()) for i in (start, last))], ["token", "node", "low", "high"])


def _sharing(stretches: DataFrame, probes: DataFrame, with_all: bool) -> DataFrame:
    """The pairs (a, b, from_a, to_a, from_b, to_b) of each probe's text with all others that have its token, or with up to ``PIVOTS`` of them."""
    wanted = bit_filter(probes.select(F.col("token").alias("node")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for node, at, token, _ in _shingles_of(batches):
            some = _marked(wanted, token)
            yield _ranges(token[some], node[some], at[some])

    held = stretches.mapInArrow(run, _SHINGLE)
    if not with_all:
        part = F.pmod(F.xxhash64("node"), F.lit(PIVOTS)).alias("part")
        held = held.groupBy("token", part).agg(F.min(F.struct("node", "low", "high")).alias("one")).select("token", "one.*")
    both = held.alias("h").join(probes.alias("p"), "token").where("h.node != p.node")
    h, p = (F.struct(*(F.col(f"{side}.{c}") for c in ("node", "low", "high"))) for side in "hp")
    first = F.col("h.node") < F.col("p.node")
    both = both.select(F.when(first, h).otherwise(p).alias("one"), F.when(first, p).otherwise(h).alias("two"))
    return _widest(both.select(*(F.col(f"{side}.{c}").alias(name) for (side, c), name in zip(
        [("one", "node"), ("two", "node"), ("one", "low"), ("one", "high"), ("two", "low"), ("two", "high")], _FIELDS))))


def _widest(pairs: DataFrame) -> DataFrame:
    """One row for each two of the pairs (a, b, from_a, to_a, from_b, to_b)."""
    return pairs.groupBy("a", "b").agg(*(f(c).alias(c) for f, c in zip((F.min, F.max) * 2, _FIELDS[2:6])))


def _new_pairs(pairs: DataFrame, known: DataFrame) -> DataFrame:
    """The pairs (a, b, from_a, to_a, from_b, to_b) that reach beyond those of the same two in ``known``."""
    further = pairs.alias("n").join(known.alias("o"), ["a", "b"], "left").where(
        "o.to_a IS NULL OR n.from_a < o.from_a OR n.to_a > o.to_a OR n.from_b < o.from_b OR n.to_b > o.to_b"
    )
    return further.select("a", "b", "n.from_a", "n.to_a", "n.from_b", "n.to_b")


def _merged(spans: DataFrame) -> DataFrame:
    """Overlapping and touching word ranges of each node as one, in one sorted array per node.

    Ranges are first merged within blocks of their position by the aggregate's arrays; a node's ranges are
    bounded by its own length, as equal ranges are one.
    """
    def join(merged, s):
        last = F.element_at(merged, -1)
        longer = F.struct(last["first"].alias("first"), F.greatest(last["last"], s["last"]).alias("last"))
        touches = (F.size(merged) > 0) & (s["first"] <= F.coalesce(F.try_element_at(merged, F.lit(-1))["last"], F.lit(-2)) + 1)
        return F.when(touches, F.concat(F.slice(merged, 1, F.greatest(F.size(merged) - 1, F.lit(0))), F.array(longer))).otherwise(
            F.concat(merged, F.array(s))
        )

    gathered = spans.groupBy("node", "first").agg(F.max("last").alias("last")).groupBy("node").agg(
        F.sort_array(F.collect_list(F.struct("first", "last"))).alias("all")
    )
    start = F.array().cast("array<struct<first:long,last:long>>")
    return gathered.select("node", F.aggregate("all", start, join).alias("spans"))


def query(spark, folder: str) -> DataFrame:
    """Words of every document that lie in a passage repeated in another one."""
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    found = repeated_passages(docs)
    n = F.aggregate("spans", F.lit(0).cast("long"), lambda total, s: total + (s["last"] - s["first"] + 1))
    return found.select(
        F.col("id").alias("doc_id"), "n_words", n.alias("n_repeated"), F.size("spans").alias("n_passages"), "partner_id"
    )
