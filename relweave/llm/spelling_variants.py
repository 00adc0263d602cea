"""Spelling variants: words one edit apart, by composing finite-state machines.

The vocabulary is a minimised acyclic acceptor A. A one-edit transducer E copies symbols, then replaces or
deletes one, then copies the rest. The paths of ``A o E o A`` are the pairs of words one edit apart: before the
edit both acceptors read the same symbols, and after it both must accept the same rest. As states with equal
right languages are one state, the pairs below a state are found once, however many prefixes lead to it. An
edit is only taken where the two words first differ (a symbol is never deleted before an equal one), so every
pair is accepted on one path.

No acceptor holds the whole vocabulary. The pairs whose longer word has ``length`` code points are dealt out by
where they differ: for an edit at a place in ``[low, high)`` both words share the ``low`` first and the ``length -
high`` last code points. Words that share them are a tile: the machine that is left of A after that prefix and
before that suffix, and the tile's initial state is where the prefix leads. Each tile is composed on its own.
A tile of more than ``TILE_WORDS`` words is divided by halving its range of places, which lengthens what its
words must share; a range of one place holds at most one word for each symbol. Every pair lies in one tile, so
nothing is lost or counted twice, and no list of words is gathered beyond a tile.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from relweave.llm.crc_sql import CRC_TABLE, crc32
from relweave.llm.exact_dedup import quoted
from relweave.session import materialise

RUN = r"[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LEAST_LENGTH, LEAST_COUNT, RATIO = 5, 3, 2
TILE_WORDS = 4_000

_NOTHING = np.empty((0, 2), np.int64)


class Acceptor:
    """Minimised acceptors of sets of equally long words, in one space of states.

    A state is a tuple of (symbol, next state), its number the order in which it was made; 0 accepts the
    empty rest. ``words[q]`` is the number of words from state ``q``, so that the words of an acceptor are
    numbered by the sums of what lies before their arcs.
    """

    def __init__(self) -> None:
        self.arcs: list[tuple[tuple[str, int], ...]] = [()]
        self.words: list[int] = [1]
        self.known: dict[tuple[tuple[str, int], ...], int] = {}

    def state(self, arcs: Sequence[tuple[str, int]]) -> int:
        key = tuple(arcs)
        found = self.known.get(key)
        if found is None:
            found = self.known[key] = len(self.arcs)
            self.arcs.append(key)
            self.words.append(sum(self.words[q] for _, q in key))
        return found

    def add(self, words: Sequence[str]) -> int:
        """The initial state of the acceptor of sorted, different, equally long words."""
        open_arcs: list[list[tuple[str, int]]] = [[] for _ in range(len(words[0]) + 1)]
        last = ""
        for word in words:
            same = 0
            while same < len(last) and last[same] == word[same]:
                same += 1
            self._close(open_arcs, last, same)
            last = word
        self._close(open_arcs, last, 0)
        return self.state(open_arcs[0]) if last else 0

    def _close(self, open_arcs: list[list[tuple[str, int]]], word: str, keep: int) -> None:
        """Number the states of ``word`` behind its first ``keep`` symbols."""
        below = 0
        for depth in range(len(word), keep, -1):
            if depth < len(word):
                below = self.state(open_arcs[depth])
                open_arcs[depth] = []
            open_arcs[depth - 1].append((word[depth - 1], below))

    def numbered(self, q: int) -> list[tuple[str, int, int]]:
        """(symbol, next state, words before) of the arcs of ``q``."""
        out, before = [], 0
        for symbol, to in self.arcs[q]:
            out.append((symbol, to, before))
            before += self.words[to]
        return out


class Composition:
    """The pairs of an acceptor through the one-edit transducer, as numbers of words."""

    def __init__(self, acceptor: Acceptor, after: str):
        self.a, self.after = acceptor, after  # ``after``: the symbol behind the words, that a deletion must not shift
        self.same: dict[tuple[int, int], np.ndarray] = {}
        self.rows: dict[int, list[tuple[str, int, int]]] = {}

    def arcs(self, q: int) -> list[tuple[str, int, int]]:
        found = self.rows.get(q)
        if found is None:
            found = self.rows[q] = self.a.numbered(q)
        return found

    def common(self, p: int, q: int) -> list[tuple[str, int, int, int, int]]:
        """(symbol, next of p, next of q, words before in p, in q) of the symbols that both read."""
        other = {s: (to, before) for s, to, before in self.arcs(q)}
        return [(s, to, other[s][0], before, other[s][1]) for s, to, before in self.arcs(p) if s in other]

    def equal(self, p: int, q: int) -> np.ndarray:
        """(number from p, number from q) of the rests that both accept: the state after the edit."""
        known = self.same
        if (p, q) in known:
            return known[p, q]
        todo = [(p, q)]
        while todo:
            x, y = todo[-1]
            if (x, y) in known:
                todo.pop()
                continue
            if x == y:
                every = np.arange(self.a.words[x])
                known[x, y] = np.stack((every, every), 1)
                todo.pop()
                continue
            steps = self.common(x, y)
            missing = [(i, j) for _, i, j, _, _ in steps if (i, j) not in known]
            if missing:
                todo += missing
                continue
            known[x, y] = _joined([known[i, j] + (b, c) for _, i, j, b, c in steps if len(known[i, j])])
            todo.pop()
        return known[p, q]

    def replaced(self, start: int) -> np.ndarray:
        """Pairs of words from ``start`` that differ in one symbol, the smaller one first."""
        below: dict[int, np.ndarray] = {0: _NOTHING}
        for q in self._upwards(start):
            arcs = self.arcs(q)
            found = [below[to] + before for _, to, before in arcs if len(below[to])]
            for k, (_, p, b) in enumerate(arcs):
                found += [e + (b, c) for _, r, c in arcs[k + 1 :] if len(e := self.equal(p, r))]
            below[q] = _joined(found)
        return below[start]

    def _upwards(self, start: int) -> list[int]:
        """The states from ``start`` on, each after those that it leads to."""
        seen, todo = {start}, [start]
        while todo:
            for _, to in self.a.arcs[todo.pop()]:
                if to not in seen:
                    seen.add(to)
                    todo.append(to)
        return sorted(seen - {0})

    def deleted(self, longer: int, shorter: int) -> np.ndarray:
        """(number from ``longer``, number from ``shorter``) where a symbol less makes a longer word a shorter one."""
        found: list[np.ndarray] = []
        todo = [(longer, shorter, 0, 0)]
        while todo:  # the same symbols so far: states of both and the words before
            p, q, b, c = todo.pop()
            for symbol, to, before in self.arcs(p):
                if q == 0:
                    rest = self.equal(to, q) if symbol != self.after else _NOTHING
                else:  # what follows must not be the deleted symbol
                    steps = [s for s in self.common(to, q) if s[0] != symbol]
                    rest = _joined([e + (d, f) for _, i, j, d, f in steps if len(e := self.equal(i, j))])
                if len(rest):
                    found.append(rest + (b + before, c))
            todo += [(i, j, b + d, c + f) for _, i, j, d, f in self.common(p, q)]
        return _joined(found)


def _joined(parts: list[np.ndarray]) -> np.ndarray:
    return np.concatenate(parts) if parts else _NOTHING


def pairs_of_tile(words: Sequence[str], length: int, low: int, high: int) -> np.ndarray:
    """Numbers of the pairs of ``words`` one edit apart, where the longer has ``length`` code points and the
    words first differ in ``[low, high)``. All share what lies before and behind that range."""
    tail = length - high
    after = words[0][len(words[0]) - tail] if tail else ""
    longer = sorted((w[low : len(w) - tail], k) for k, w in enumerate(words) if len(w) == length)
    shorter = sorted((w[low : len(w) - tail], k) for k, w in enumerate(words) if len(w) == length - 1)
    if not longer:
        return _NOTHING
    acceptor = Acceptor()
    start = acceptor.add([w for w, _ in longer])
    number = np.array([k for _, k in longer])
    both = Composition(acceptor, after)
    found = [number[both.replaced(start)]]
    if shorter:
        less = acceptor.add([w for w, _ in shorter])
        pairs = both.deleted(start, less)
        found.append(np.stack((number[pairs[:, 0]], np.array([k for _, k in shorter])[pairs[:, 1]]), 1))
    return _joined([f for f in found if len(f)])


_NEAR = "word string, n_near long, best_n long, best string"


def _near_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per tile and word the number of near words and the best of them, of rows sorted by tile."""
    def settle(tile: list[tuple[str, int]], key: tuple[int, int, int]) -> None:
        words, counts = [w for w, _ in tile], np.array([n for _, n in tile])
        pairs = pairs_of_tile(words, *key)
        if not len(pairs):
            return
        a, b = np.concatenate((pairs, pairs[:, ::-1])).T
        rank = np.empty(len(words), np.int64)
        rank[sorted(range(len(words)), key=words.__getitem__)] = np.arange(len(words))
        order = np.lexsort((rank[b], -counts[b], a))
        a, b = a[order], b[order]
        first = np.flatnonzero(np.concatenate(([True], a[1:] != a[:-1])))
        total = np.diff(np.append(first, len(a)))
        for i, n in zip(first.tolist(), total.tolist()):
            out.append((words[a[i]], n, int(counts[b[i]]), words[b[i]]))

    tile: list[tuple[str, int]] = []
    at, key = None, (0, 0, 0)
    out: list[tuple[str, int, int, str]] = []

    def flush() -> pa.RecordBatch:
        columns = list(zip(*out)) if out else [(), (), (), ()]
        kinds = (pa.string(), pa.int64(), pa.int64(), pa.string())
        out.clear()
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["word", "n_near", "best_n", "best"])

    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("tile", "word", "n", "length", "low", "high")]
        for name, word, n, *place in zip(*columns):
            if name != at:
                if len(tile) > 1:
                    settle(tile, key)
                tile, at, key = [], name, tuple(place)
            tile.append((word, n))
        if len(out) > 10_000:
            yield flush()
    if len(tile) > 1:
        settle(tile, key)
    yield flush()


def _tile() -> Column:
    """What the words of a tile share, as one text: no word has a space."""
    length = F.col("length") - F.col("high")
    return F.concat_ws(
        " ", "length", "low", "high", F.substring("word", F.lit(1), F.col("low")),
        F.substring("word", F.char_length("word") - length + 1, length),
    )


def _halves(rows: DataFrame) -> DataFrame:
    """Every row once for either half of its range of places."""
    middle = F.floor((F.col("low") + F.col("high")) / 2).cast("int")
    sides = F.array(
        F.struct(F.col("low"), middle.alias("high")), F.struct(middle.alias("low"), F.col("high"))
    )
    halved = rows.select("word", "n", "length", F.explode(sides).alias("side"))
    return halved.select("word", "n", "length", "side.low", "side.high").withColumn("tile", _tile())


def tiles(vocabulary: DataFrame, most: int = TILE_WORDS) -> DataFrame:
    """(word, n, length, low, high, tile): the words of every tile of two words or more."""
    lengths = F.explode(F.array(F.char_length("word"), F.char_length("word") + 1)).alias("length")
    rows = vocabulary.select("word", "n", lengths).withColumns({"low": F.lit(0), "high": F.col("length")})
    active, settled = _halves(rows), []
    while True:
        sizes = active.groupBy("tile").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
        level = materialise(active.join(sizes, "tile"), "spelling-tiles")
        whole = (F.col("size") <= most) | (F.col("high") - F.col("low") == 1)
        settled.append(level.where(whole).drop("size"))
        large = level.where(~whole)
        if large.isEmpty():
            break
        active = _halves(large)
    out = settled[0]
    for level in settled[1:]:
        out = out.unionByName(level)
    return out


def near_words(vocabulary: DataFrame, most: int = TILE_WORDS) -> DataFrame:
    """(word, n_near, best_n, best) of the words of (word, n) with a word one edit away.

    ``best`` is the most frequent such word, of equally frequent ones the smallest by code points. Words are
    not NULL and different; an empty vocabulary gives an empty result.
    """
    dealt = tiles(vocabulary, most)
    dealt = dealt.repartition("tile").sortWithinPartitions("tile")
    found = dealt.mapInArrow(_near_words, _NEAR)
    best = F.min(F.struct((-F.col("best_n")).alias("n"), F.col("best").alias("word"))).alias("top")
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best).select(
        "word", "n_near", (-F.col("top.n")).alias("best_n"), F.col("top.word").alias("best")
    )


def roots(links: DataFrame) -> DataFrame:
    """(word, root): where the links (word, form) lead in the end. Each round doubles the steps taken."""
    reached = materialise(links.select("word", F.col("form").alias("root"), F.lit(True).alias("open")), "spelling-roots")
    while True:
        onward = reached.select(F.col("word").alias("root"), F.col("root").alias("next"))
        joined = reached.where("open").join(onward, "root", "left")
        moved = joined.select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("open"))
        reached = materialise(reached.where("not open").unionByName(moved), "spelling-roots")
        if reached.where("open").isEmpty():
            return reached.select("word", "root")


def words_of(docs: DataFrame, text: str = "text", order: str = "doc_id", damage: int | None = None) -> DataFrame:
    """(word): the runs of letters of every text, A-Z lower-cased.

    With ``damage`` a run whose CRC-32 of ``<order>:<run>`` it divides loses one code point. NULL text has no
    runs; a NULL ``order`` counts as an empty one.
    """
    lowered = F.translate(quoted(text).cast("string"), UPPER, LOWER)
    runs = docs.select(
        F.coalesce(quoted(order).cast("string"), F.lit("")).alias("id"), F.explode(F.regexp_extract_all(lowered, F.lit(RUN), F.lit(0))).alias("run")
    )
    if damage is None:
        return runs.select(F.col("run").alias("word"))
    hashed = runs.withColumn("h", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")))
    at = (F.col("h") % F.char_length("run")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.char_length("run")))
    return hashed.select(F.when(F.col("h") % damage == 0, cut).otherwise(F.col("run")).alias("word"))


def variants(words: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, ratio: int = RATIO, most: int = TILE_WORDS) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of (word) that is long and frequent enough.

    ``form`` is the near word of largest ``n`` (ties: the smallest) if that is at least ``ratio`` times the
    word's own, ``root`` the last word reached by following forms, the word itself where there is none.
    """
    counted = words.where(F.char_length("word") >= least_length).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    vocabulary = materialise(counted.where(F.col("n") >= least_count), "spelling-vocabulary")
    near = near_words(vocabulary, most)
    known = vocabulary.join(near, "word", "left")
    frequent = F.col("best_n") >= ratio * F.col("n")
    formed = materialise(known.select(
        "word", F.when(frequent, F.col("best")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(frequent, F.col("best_n")).alias("form_n"),
    ), "spelling-forms")
    ends = roots(formed.where(F.col("form").isNotNull()))
    return formed.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def query(spark, folder: str) -> DataFrame:
    """Every frequent word of the documents, damaged as the contract says, with its form and root."""
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    return variants(words_of(docs, damage=97))


SQL = f"""
WITH RECURSIVE {CRC_TABLE},
runs AS (SELECT doc_id, unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '{RUN}')) AS run FROM documents),
hashed AS (SELECT run, {crc32("coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run")} AS h FROM runs, crc),
words AS (
  SELECT CASE WHEN h % 97 = 0 THEN run[:h % length(run)] || run[h % length(run) + 2:] ELSE run END AS word FROM hashed
),
vocabulary AS (SELECT word, count(*) AS n FROM words WHERE length(word) >= {LEAST_LENGTH} GROUP BY 1 HAVING count(*) >= {LEAST_COUNT}),
cuts AS (
  SELECT word, n, i, word[:i] || word[i + 2:] AS cut FROM (SELECT *, unnest(range(length(word))) AS i FROM vocabulary)
),
pairs AS (
  SELECT a.word, b.word AS other, b.n FROM cuts AS a JOIN cuts AS b ON a.cut = b.cut AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM cuts AS a JOIN vocabulary AS b ON a.cut = b.word
  UNION SELECT b.word, a.word, a.n FROM cuts AS a JOIN vocabulary AS b ON a.cut = b.word
),
near AS (SELECT word, count(*) AS n_near, max(n) AS best_n, arg_min(other, (-n, other)) AS best FROM pairs GROUP BY 1),
formed AS (
  SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN best_n >= {RATIO} * v.n THEN best END AS form,
         CASE WHEN best_n >= {RATIO} * v.n THEN best_n END AS form_n
  FROM vocabulary AS v LEFT JOIN near USING (word)
),
led AS (
  SELECT word, word AS at FROM formed
  UNION ALL SELECT l.word, f.form FROM led AS l JOIN formed AS f ON l.at = f.word WHERE f.form IS NOT NULL
)
SELECT f.word, f.form, l.at AS root, f.n, f.n_near, f.form_n
FROM formed AS f JOIN led AS l USING (word) JOIN formed AS e ON l.at = e.word AND e.form IS NULL
"""
