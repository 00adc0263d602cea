"""Manifest, language model and spelling variants against plain recomputation, and queries against their SQL."""

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import compare
from relweave.llm import katz_model, license_scan, merkle_manifest, spelling_variants
from relweave.llm.registry import QUERIES
from test_operators_llm import EDGE, SCHEMA, documents, edge, empty, prose  # noqa: F401  (fixtures)

FOLDER = "/root/testdata/sf0.001"
LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in ("documents", "benchmark", "labels", "pages"):
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{FOLDER}/{name}.parquet')")
    return connection


@pytest.mark.parametrize("name", sorted(n for n, (_, sql) in QUERIES.items() if sql))
def test_same_as_sql(spark, duck, name):
    run, sql = QUERIES[name]
    assert compare.differences(run(spark, FOLDER), duck, sql) == []


# Merkle manifest

def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(values):
    return sha(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def tree_of(leaves, arity):
    """Top and, for each leaf, the (before, after) of its run on every level."""
    paths = [[] for _ in leaves]
    level = [(d, [i]) for i, d in enumerate(leaves)]
    while len(level) > 1:
        above = []
        for start in range(0, len(level), arity):
            run = level[start : start + arity]
            for k, (_, members) in enumerate(run):
                for m in members:
                    paths[m].append(("".join(d for d, _ in run[:k]), "".join(d for d, _ in run[k + 1 :])))
            above.append((sha(*[d for d, _ in run]), [m for _, members in run for m in members]))
        level = above
    return level[0][0], paths


def expected_manifest(rows, arity):
    groups = {}
    for i, r in enumerate(rows):
        groups.setdefault(r[1], []).append((r[0] is not None, r[0] or 0, leaf_of(r), i))
    subroots, found = [], {}
    for g in sorted(groups, key=lambda g: (g is not None, (g or "").encode())):
        members = sorted(groups[g])
        top, paths = tree_of([m[2] for m in members], arity)
        for m, path in zip(members, paths):
            found[m[3]] = (m[2], top, path, len(subroots))
        subroots.append(top)
    root, paths = tree_of(subroots, arity)
    return sorted((leaf, top, root, path + paths[k]) for leaf, top, path, k in found.values())


@pytest.mark.parametrize("arity, n", [(2, 37), (16, 300), (16, 1), (3, 27)])
def test_manifest_equals_brute_force(spark, arity, n, monkeypatch):
    monkeypatch.setattr(merkle_manifest, "BLOCK", 7)
    rng = random.Random(n)
    rows = [(rng.choice([None, *range(n)]), rng.choice([None, "", "s", "s", "s", "ß", "z"]), "en", rng.choice([None, 5]), rng.choice([None, "", prose(9, i)])) for i in range(n)]
    rows += rows[:3]  # repeated rows
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").withColumn("leaf", F.lit(1)).withColumn("tree", F.lit("x"))
    held = merkle_manifest.manifest(docs, carry=["doc_id", "leaf", "tree"], arity=arity).rows
    got = held.collect()
    assert sorted((r.leaf, r.subroot, r.root, [tuple(p) for p in r.path]) for r in got) == expected_manifest(rows, arity)
    assert all(r.row.leaf == 1 and r.row.tree == "x" for r in got)
    assert {r.verified for r in merkle_manifest.verified(held, F.col("leaf")).collect()} == {True}
    assert {r.verified for r in merkle_manifest.verified(held, F.sha2("leaf", 256)).collect()} == {False}


def test_manifest_of_edge_cases(spark, edge, empty):  # noqa: F811
    assert merkle_manifest.manifest(edge).rows.count() == len(EDGE)
    assert merkle_manifest.manifest(empty).rows.count() == 0


# language model

def tokens(text):
    return re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().translate(LOWER)) + [None]


class Plain:
    """The same model over dictionaries."""

    def __init__(self, texts):
        self.words, self.pairs = Counter(), Counter()
        for t in map(tokens, texts):
            self.words.update(t)
            self.pairs.update(zip(t, t[1:]))
        self.n = sum(self.words.values())
        self.word_discount, self.pair_discount = (
            katz_model.good_turing([Counter(c.values())[r] for r in range(1, katz_model.K + 2)]) for c in (self.words, self.pairs)
        )
        mass = sum(self.word_discount[min(c, katz_model.K + 1)] * c for c in self.words.values())
        self.total = self.n if mass < self.n else self.n + 1
        self.unknown = 1 - mass / self.total
        self.after = {}
        for (h, w), c in self.pairs.items():
            self.after.setdefault(h, {})[w] = c

    def word(self, w):
        c = self.words[w]
        return self.word_discount[min(c, katz_model.K + 1)] * c / self.total if c else self.unknown

    def p(self, h, w):
        known = self.after.get(h)
        if known is None:
            return self.word(w)
        discounts = {v: self.pair_discount[min(c, katz_model.K + 1)] for v, c in known.items()}
        total = sum(known.values()) + (0 if any(d < 1 for d in discounts.values()) else 1)
        if w in known:
            return discounts[w] * known[w] / total
        left = 1 - sum(discounts[v] * c for v, c in known.items()) / total
        return left / (1 - sum(map(self.word, known))) * self.word(w)

    def score(self, text):
        t = tokens(text)
        return math.log10(self.word(t[0])) + sum(math.log10(self.p(h, w)) for h, w in zip(t, t[1:]))

    def base(self, text):
        return sum(math.log10((self.words[w] + 0.5) / (self.n + 0.5 * (len(self.words) + 1))) for w in tokens(text))


def zipf_text(n, seed):
    rng = random.Random(seed)
    return " ".join(f"W{int(rng.paretovariate(0.7))}" for _ in range(n))


@pytest.mark.parametrize("top, bucket, chunk", [(1 << 19, 1 << 20, 8 << 20), (5, 300, 500), (0, 50, 200)])
def test_scores_equal_brute_force(spark, monkeypatch, top, bucket, chunk):
    monkeypatch.setattr(katz_model, "TOP_WORDS", top)
    monkeypatch.setattr(katz_model, "BUCKET_TOKENS", bucket)
    monkeypatch.setattr(katz_model, "CHUNK_BYTES", chunk)
    training = [zipf_text(i % 40, i) for i in range(120)] + [None, "", " \t"]
    texts = training[:20] + [zipf_text(50, 10_000 + i) for i in range(20)] + ["never seen words", "w1", None, "", "\n", "w1 " * 3000]
    plain = Plain(training)
    # the model adds up to one after any token
    for h in [None, *list(plain.after)[:5]]:
        assert math.isclose(sum(plain.p(h, w) for w in plain.words) + plain.p(h, "other"), 1.0, rel_tol=1e-9)
    model = katz_model.train(documents(spark, training))
    ids = [None, *range(1, len(texts) - 1), 1]
    got = katz_model.score(documents(spark, texts, ids), model, carry=["doc_id", "text", "score", "node"]).collect()
    assert len(got) == len(texts) and Counter(r.row.doc_id for r in got) == Counter(ids)
    for r in got:
        t = tokens(r.row.text)
        assert (r.n_tokens, r.n_known, model.top.tokens) == (len(t), sum(w in plain.words for w in t), plain.n)
        assert math.isclose(r.score, plain.score(r.row.text), rel_tol=1e-9)
        assert math.isclose(r.base_score, plain.base(r.row.text), rel_tol=1e-9)


def test_scores_of_edge_cases(spark, edge, empty):  # noqa: F811
    model = katz_model.train(edge)
    assert katz_model.score(edge, model).count() == len(EDGE)
    assert katz_model.score(empty, model).count() == 0
    nothing = katz_model.train(empty)
    got = katz_model.score(edge, nothing).collect()
    assert len(got) == len(EDGE) and {r.n_known for r in got} == {0}
    assert all(r.score == 0 for r in got)  # all mass is on words that were not counted


def test_packed_numbers_come_back():
    import numpy as np

    for values in ([], [0], [255, 1], [256], [1 << 40, 3, (1 << 62) - 1], list(range(70_000))):
        assert katz_model._unpacked(katz_model._packed(np.array(values, np.int64))).tolist() == values


# spelling variants

def near(a, b):
    if len(a) < len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(a) == len(b) + 1 and any(a[:i] + a[i + 1 :] == b for i in range(len(a)))


def expected_variants(counts):
    links, table = {}, {}
    for w, n in counts.items():
        others = [v for v in counts if near(w, v)]
        best = min(others, key=lambda v: (-counts[v], v), default=None)
        form = best if best and counts[best] >= 2 * n else None
        links[w] = form
        table[w] = (n, len(others), form)
    def end(w):
        while links[w]:
            w = links[w]
        return w
    return {w: (f, end(w), n, k, counts[f] if f else None) for w, (n, k, f) in table.items()}


def test_every_pair_is_found_once():
    rng = random.Random(8)
    for _ in range(150):
        alphabet = rng.choice(["ab", "abé", "abcde"])
        words = sorted({"".join(rng.choice(alphabet) for _ in range(rng.randint(1, 6))) for _ in range(rng.randint(2, 50))})
        found = []
        for length in range(1, 8):
            cuts = sorted({0, length, *(rng.randint(0, length) for _ in range(2))})
            for low, high in zip(cuts, cuts[1:]):
                tiles = {}
                for w in words:
                    if length - 1 <= len(w) <= length:
                        tiles.setdefault((w[:low], w[len(w) - length + high :] if high < length else ""), []).append(w)
                for tile in tiles.values():
                    found += [tuple(sorted((tile[i], tile[j]))) for i, j in spelling_variants.pairs_of_tile(tile, length, low, high).tolist()]
        assert sorted(found) == [p for p in itertools.combinations(words, 2) if near(*p)]


def test_acceptors_are_minimal():
    machine = spelling_variants.Acceptor()
    start = machine.add(["abx", "aby", "cbx", "cby"])
    assert machine.words[start] == 4 and len(machine.arcs) == 4  # two words with a and two with c share their rest


@pytest.mark.parametrize("most", [2, 9, 4000])
def test_variants_equal_brute_force(spark, most):
    rng = random.Random(most)
    base = ["straße", "aaaaa", "aaaaaa", "bananas", "letter"] + ["".join(rng.choice("abé") for _ in range(rng.randint(5, 7))) for _ in range(60)]
    words = [w for w in base for _ in range(rng.choice([1, 3, 3, 6, 7, 14, 30]))] + ["x" * 3000, "x" * 3001] * 3 + ["x" * 3000] * 3
    rng.shuffle(words)
    counts = {w: n for w, n in Counter(words).items() if n >= 3}
    got = spelling_variants.variants(spark.createDataFrame([(w,) for w in words], "word string"), most=most).collect()
    assert len(got) == len(counts)
    assert {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in got} == expected_variants(counts)


def test_words_and_damage(spark, edge, empty):  # noqa: F811
    texts = ["Straße ÄÖ×a1b", None, "", "12", "Abcdef ABCDEF"] + [f"wörter{'abc' * (i % 4)}" for i in range(200)]
    docs = documents(spark, texts, [None, *range(1, len(texts))])
    plain = [(i, w) for i, t in zip([""] + list(range(1, len(texts))), texts) for w in re.findall("[A-Za-zÀ-ÿ]+", (t or "").translate(str.maketrans(spelling_variants.UPPER, spelling_variants.LOWER)))]
    assert sorted(r.word for r in spelling_variants.words_of(docs).collect()) == sorted(w for _, w in plain)
    expected = []
    for i, w in plain:
        h = zlib.crc32(f"{i}:{w}".encode())
        expected.append(w[: h % len(w)] + w[h % len(w) + 1 :] if h % 3 == 0 else w)
    assert sorted(r.word for r in spelling_variants.words_of(docs, damage=3).collect()) == sorted(expected)
    assert spelling_variants.variants(spelling_variants.words_of(empty)).count() == 0
    assert spelling_variants.variants(spelling_variants.words_of(edge)).count() >= 0


def test_texts_are_taken_range_by_range_and_memory_is_given_back(spark, monkeypatch):
    monkeypatch.setattr(katz_model, "CHUNK_BYTES", 20)
    monkeypatch.setattr(katz_model, "_MOST_TEXTS", 3)
    texts = ["a" * 9, None, "", "", "b" * 50, "c" * 20, "d", "e" * 19, "f" * 9, "\u00e9" * 5]
    got = list(katz_model.text_chunks(pa.array(texts)))
    assert [t for _, _, part in got for t in part] == [t and t.encode() if t else t if t is None else b"" for t in texts]
    assert [(a, b) for a, b, _ in got] == [(0, 3), (3, 4), (4, 5), (5, 6), (6, 8), (8, 10)]
    assert list(katz_model.text_chunks(pa.array([], pa.string()))) == []
    model = katz_model.train(documents(spark, ["a b a b", "b a"]))
    assert model.shared.value is not None and np.array_equal(model.shared.value.word, model.top.word)
    given = []
    monkeypatch.setattr(katz_model, "give_back", lambda: given.append(1))
    table = pa.table({"a": [1]})
    assert katz_model._given_back(table) is table and given == [1]


# licences that are no training texts

REAL = {
    "GPL-3.0": "This program is free software: you can redistribute it and/or modify\nit under the terms of the GNU General Public License as published by\n"
               "the Free Software Foundation, either version 3 of the License, or\n(at your option) any later version.",
    "BSD-3-Clause": "Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that the following conditions\nare met:",
    "ISC": "Permission to use, copy, modify, and distribute this software for any\npurpose with or without fee is hereby granted, provided that the above\ncopyright notice appear.",
    "MIT": "Distributed under the MIT License, see the file LICENSE.",
    "Apache-2.0": "Parts are licensed under the Apache License, Version 2.0",
    "AGPL-3.0": "The program is licensed under version 3 of the GNU Affero General Public License.",
}


def test_wrapped_and_reworded_notices(spark, empty):  # noqa: F811
    texts = [prose(30, i) + ".\n" + prose(14, 900 + i) + "." for i in range(80)]
    texts += ["A first line.\n" + t + "\nA last line." for t in REAL.values()]
    texts += ["A first line.\n" + t + "\nA last line." for t in REAL.values()]  # equal rows, and real notices among the sampled
    found = license_scan.scan(documents(spark, texts), carry=["doc_id", "body"]).collect()
    got = {}
    for r in found:
        got.setdefault(r.row.doc_id, []).append(r.family)
    assert not [i for i in got if i < 80]
    right = sum(got.get(80 + k) == [family] for k, family in enumerate([*REAL, *REAL]))
    assert right >= 10  # of 12
    assert license_scan.scan(empty).count() == 0


def test_every_paragraph_is_learned_from_or_kept_aside(spark):
    lines = [f"The license plate of car {i} belongs to {' '.join(prose(6, i).split())}." for i in range(4500)]
    texts = ["\n".join(lines[i : i + 90]) + "\nAll rights reserved.\nNo word that tells." for i in range(0, 4500, 90)]
    chosen = license_scan.counterexamples(documents(spark, texts + texts[:5]), "text", "doc_id")
    assert {" ".join(r.words) for r in chosen.collect()} == {" ".join(re.findall(license_scan._WORD, line.lower())) for line in lines}
    assert chosen.count() == 4500  # equal ones once
    rows = spark.createDataFrame([("none", ["a", "b"]), ("none", ["a", "b"]), ("MIT", ["m", "b"]), ("MIT", ["m", "o"])], "family string, grams array<string>")
    assert license_scan.gram_names(rows) == ["a", "b", "m"]


def test_words_of_the_corpus_have_one_coefficient_each(spark):
    """The driver holds every coefficient many times over: they must not be words of the corpus times families."""
    texts = [f"the license of word{i % 300} and word{i % 299} here" for i in range(600)]
    model, families, _ = license_scan.fit(documents(spark, texts))
    weights = sum(s.coefficientMatrix.numRows * s.coefficientMatrix.numCols for s in model.stages if hasattr(s, "coefficientMatrix"))
    rows = license_scan.training_rows(spark, license_scan.counterexamples(documents(spark, texts), "text", "doc_id"))
    every = rows.select("words", F.expr("transform(slice(words, 2, size(words)), (w, i) -> concat_ws(' ', words[i], w))").alias("pairs"), "family")
    own, others = license_scan.gram_names_by_use(every.select("family", F.concat("words", "pairs").alias("grams")))
    assert len(others) > 250
    assert weights <= len(own) * len(families) + len(own) + len(others)



def test_lines_without_telling_words_resemble_no_notice(spark):
    """Every text of half a notice's words has a telling word, whichever half it is."""
    draw = random.Random(5)
    texts = []
    for _, notice in license_scan.NOTICES:
        words = sorted(set(re.findall(license_scan._WORD, notice.lower())))
        least = -(-len(words) // 2)
        texts += [" ".join(["zzz", *draw.sample(words, least)]) for _ in range(30)]
    texts += ["", "zzz", "this is by the way", "sublicensed", "ALL RIGHTS RESERVED", "allKights reserved"]
    rows = spark.createDataFrame([(t,) for t in texts], "text string")
    alike = license_scan.best_match(license_scan.words_of(F.col("text"))) >= license_scan.LEAST_ALIKE
    got = rows.select("text", alike.alias("alike"), license_scan.may_match(F.col("text")).alias("may")).collect()
    assert [r.text for r in got if r.alike and not r.may] == []
    assert sum(r.alike for r in got) > 30 * len(license_scan.NOTICES)
    assert not any(r.may for r in got if r.text in ("", "zzz", "this is by the way", "sublicensed"))


def test_wrapped_lines(spark):
    """A break is a blank where the next line goes on; full stops, empty lines and capitals part paragraphs."""
    cases = {
        "ends in the\nMIT License": "ends in the MIT License", "goes\n on": "goes  on", "Stop.\nnext": "Stop.\nnext",
        "a\n\nb": "a\n\nb", "a \t\r\n(b": "a (b", "One\nTwo": "One\nTwo", "one,\n  Two": "one,   Two", "x  \n\n y": "x  \n\n y", "by\nMe": "by\nMe",
    }
    rows = spark.createDataFrame(list(cases.items()), "text string, joined string")
    got = rows.select("joined", F.regexp_replace("text", license_scan._WRAP, " ").alias("got")).collect()
    assert [(r.joined, r.got) for r in got if r.joined != r.got] == []
