"""The numpy and Python parts against plain forms of the same thing."""

import random
import re
import unicodedata

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from relweave.llm import byte_bpe, jaccard_join, language_id, substring_dedup, toxicity
from relweave.llm.words import BETWEEN_SPACE, LETTERS_DIGITS, chunks, find_words, runs_hash

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def encoder():
    return byte_bpe.Encoder(byte_bpe.read_ranks(RANKS), byte_bpe.character_classes())


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.read_ranks(RANKS), special_tokens={})


def ids_of(encoder, texts):
    return [np.frombuffer(x, "<u4").tolist() for x in encoder.encode(texts)]


PIECES = st.sampled_from([" ", "  ", "\n", "\t", "'s", "'re", "'ll", "'", " '", "a", "Zé", "1", "٣", ".", "!?", "　", "\x85", "語", "\x1c", "\0", "🙂"])


@settings(max_examples=300, deadline=None)
@given(st.lists(PIECES, max_size=25).map("".join))
def test_encoding_equals_the_library(encoder, library, text):
    assert ids_of(encoder, [text]) == [library.encode_ordinary(text)]


def test_every_code_point_alone_and_between_letters(encoder, library):
    points = [chr(c) for c in range(0, 0x30000, 7) if not 0xD800 <= c <= 0xDFFF]
    texts = points + [f"a{c}b {c}" for c in points]
    assert ids_of(encoder, texts) == library.encode_ordinary_batch(texts, num_threads=1)


@pytest.mark.parametrize("text", ["", "x" * 3000, "ab" * 2000, " " * 3000, "'s" * 500, "é" * 1500])
def test_long_pieces(encoder, library, text):
    assert ids_of(encoder, [text]) == [library.encode_ordinary(text)]


def test_safe_spans_change_nothing(encoder, library):
    rng = random.Random(3)
    text = "".join(rng.choice(["word", " ", "  ", "\n", "'s", "12", ".", "é", "\t"]) for _ in range(5000))
    spans = byte_bpe._safe_spans(text, 300)
    assert "".join(spans) == text and len(spans) > 20
    assert sum(ids_of(encoder, spans), []) == library.encode_ordinary(text)


def test_cache_generations(encoder, library, monkeypatch):
    monkeypatch.setattr(byte_bpe, "CACHE_BYTES", 1000)
    fresh = byte_bpe.Encoder(encoder.ranks, encoder.classes)
    text = " ".join(f"pseudoword{i} antidis{i % 3}" for i in range(60))
    assert ids_of(fresh, [text, text]) == [library.encode_ordinary(text)] * 2
    assert len(fresh) <= 5


def lower(text):
    return text.encode().translate(bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256)))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.none() | st.text(alphabet="aB9é .\n\t\x0b_\0", max_size=30), max_size=6))
def test_words_equal_the_patterns(texts):
    raw = [None if t is None else t.encode() for t in texts]
    for inside, pattern in ((BETWEEN_SPACE, rb"[^\x20\x09-\x0D]+"), (LETTERS_DIGITS, rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")):
        found = find_words(raw, inside)
        got = [found.words(a, b) for a, b in zip(found.first, found.first[1:])]
        assert got == [re.findall(pattern, lower(t)) if t else [] for t in texts]


def test_hashes_follow_the_words():
    words = [b"a", b"ab", b"abcdefgh", b"abcdefghi", b"abcdefghj", b"x" * 63, b"x" * 64, b"x" * 65, b"y" * 500, b"a"]
    found = find_words([b" ".join(words)], BETWEEN_SPACE)
    hashes = found.hashes().tolist()
    assert len(set(hashes)) == len(set(words)) and hashes[0] == hashes[-1]
    alone = [find_words([w], BETWEEN_SPACE).hashes()[0] for w in words]
    assert hashes == alone
    assert len(runs_hash(found.hashes(), 11)) == 0


def test_chunks_cover_everything_once():
    sizes = [0, 5, 100, 3, 3, 3, None, 50]
    texts = [None if n is None else b"x" * n for n in sizes]
    ranges = list(chunks(texts, 10))
    assert [i for a, b in ranges for i in range(a, b)] == list(range(len(texts)))
    assert list(chunks([], 10)) == []


def test_bitmap_bound_never_rejects_a_link():
    rng = np.random.default_rng(1)
    for _ in range(200):
        n = int(rng.integers(1, 900))
        a = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
        keep = rng.random(len(a)) < rng.uniform(0.8, 1)
        b = np.unique(np.concatenate((a[keep], rng.integers(0, 2**63, int((~keep).sum() * rng.random())).astype(np.uint64))))
        if not len(b):
            continue
        both = len(np.intersect1d(a, b))
        bits_a, bits_b = jaccard_join.bitmap_of(a).view(np.uint64), jaccard_join.bitmap_of(b).view(np.uint64)
        lacking = sum(int(x).bit_count() for x in bits_a & ~bits_b)
        assert both <= len(a) - lacking
        order = rng.permutation(1 << jaccard_join.ORDER_BITS).astype(np.int64)
        if 9 * both >= 4 * (len(a) + len(b)):
            shared = len(np.intersect1d(jaccard_join.prefix_of(a, order), jaccard_join.prefix_of(b, order)))
            overlap = -(-4 * (len(a) + len(b)) // 9)
            assert shared >= max(1, overlap - -(-4 * max(len(a), len(b)) // 5) + 1)


def test_window_minima_and_bounds_equal_brute_force():
    rng = np.random.default_rng(5)
    for size in (10, 45, 46, 47, 200):
        values = rng.integers(1, 40, size).astype(np.uint64)
        text_of = np.sort(rng.integers(0, 3, size))
        least = substring_dedup.LEAST
        expected = set()
        for i in range(size - least + 1):
            if text_of[i] == text_of[i + least - 1]:
                run = values[i : i + least]
                expected |= {i + int(k) for k in np.flatnonzero(run == run.min())}
        at = substring_dedup.window_minima(values, text_of)
        assert set(at.tolist()) == expected
        first = [int(np.searchsorted(text_of, text_of[p])) for p in at]
        end = [int(np.searchsorted(text_of, text_of[p], "right")) - 1 for p in at]
        left, right = substring_dedup.cartesian_bounds(values[at].tolist(), at.tolist(), first, end)
        for p, l, r, s, e in zip(at.tolist(), left, right, first, end):
            low = p
            while low > s and values[low - 1] > values[p]:
                low -= 1
            high = p
            while high < e and values[high + 1] >= values[p]:
                high += 1
            assert (l, r) == (low, high)


def test_repeated_spans():
    rng = np.random.default_rng(2)
    passage = rng.integers(0, 2**60, 80).astype(np.uint64)
    def fill(n):
        return rng.integers(0, 2**60, n).astype(np.uint64)
    a, b = np.concatenate((fill(30), passage, fill(20))), np.concatenate((fill(5), passage, fill(60)))
    in_a, in_b = substring_dedup.repeated_spans(a, b)
    assert (30, 109) in in_a and (5, 84) in in_b
    changed = passage.copy()
    changed[40] = 1
    in_a, in_b = substring_dedup.repeated_spans(np.concatenate((fill(30), changed, fill(20))), b)
    assert any(first <= 8 and last >= 80 for first, last in in_b)
    assert substring_dedup.repeated_spans(fill(100), fill(100)) == ([], [])
    short = passage[:49]
    assert substring_dedup.repeated_spans(np.concatenate((fill(60), short)), np.concatenate((short, fill(60)))) == ([], [])


def test_repeated_spans_with_repeated_lines():
    rng = np.random.default_rng(3)
    def fill(n):
        return rng.integers(0, 2**60, n).astype(np.uint64)
    line, tail = fill(20), fill(35)
    changed = tail.copy()
    changed[15] = 1
    a = np.concatenate((fill(40), line, fill(300), line, tail, fill(40)))
    b = np.concatenate((fill(60), line, changed, fill(30)))
    in_a, in_b = substring_dedup.repeated_spans(a, b)
    assert any(first <= 362 and last >= 412 for first, last in in_a) and any(first <= 62 and last >= 112 for first, last in in_b)


def test_equal_runs_without_and_with_repeats():
    rng = np.random.default_rng(6)
    least = substring_dedup.LEAST
    for letters in (2**60, 3):
        part = rng.integers(0, letters, 60).astype(np.uint64)
        x = np.concatenate((part[:50], rng.integers(0, letters, 9).astype(np.uint64), part))
        y = np.concatenate((rng.integers(0, letters, 7).astype(np.uint64), part[3:], part[:47]))
        for one, two in ((x, y), (x[59:], y[:64])):  # the second pair has no shingle twice
            order = np.argsort(one, kind="stable")
            low, high = np.searchsorted(one[order], two), np.searchsorted(one[order], two, "right")
            source = substring_dedup._sources(order, low, high)[0]
            got = substring_dedup._equal_runs(one, two, source, bool((high - low > 1).any()))
            runs = [{tuple(z[i : i + least].tolist()) for i in range(len(z) - least + 1)} for z in (one, two)]
            for z, other, spans in ((one, runs[1], got[0]), (two, runs[0], got[1])):
                starts = {i for i in range(len(z) - least + 1) if tuple(z[i : i + least].tolist()) in other}
                assert {i for p, q in spans for i in range(p, q - substring_dedup.PASSAGE_WORDS + 2)} == starts and starts


def test_parts_of_many_texts_are_those_of_each():
    rng = np.random.default_rng(7)
    sizes, n = [200, 50, 120, 61], 12
    texts = [rng.integers(0, 2**32, size).astype(np.uint64) for size in sizes]
    text = np.repeat(np.arange(len(sizes)), n)
    at = np.concatenate([np.sort(rng.integers(0, size - 4, n)) for size in sizes])
    left, right, kind = np.minimum(at, 46), np.full(len(at), 46), rng.integers(0, 3, len(at))
    bounds = np.append(0, np.cumsum(sizes))
    together = {(new, i, h) for new, which, part in substring_dedup.parts_of(np.concatenate(texts), bounds, text, at, left, right, kind)
                for i, h in zip(which.tolist(), part.tolist())}
    alone = set()
    for k, words in enumerate(texts):
        own = np.flatnonzero(text == k)
        given = [c[own] for c in (at, left, right, kind)]
        for new, which, part in substring_dedup.parts_of(words, np.array([0, len(words)]), np.zeros(n, np.int64), *given):
            alone |= {(new, int(own[i]), h) for i, h in zip(which.tolist(), part.tolist())}
    assert together == alone and {new for new, _, _ in alone} == {substring_dedup.EXACT, substring_dedup.BANDED}


@pytest.mark.parametrize("large", [False, True])
def test_pairs_of_few_windows_in_small_groups(large):
    place = (60 << 14) + (46 << 8) + (46 << 2)
    for n in range(2, substring_dedup.SMALL + 1):  # one small group alone, or beside a large one
        rows = [(1, node, place) for node in range(n)] + [(2, node, place) for node in range(20)] * large
        pairs, both, in_large = substring_dedup.pairs_of_groups(*np.array(rows, np.int64).T)
        expected = {(a, b) for b in range(n) for a in range(b)} | {(0, b) for b in range(1, 20 * large)}
        assert {(a, b) for a, b in pairs[:2].T.tolist()} == expected
        assert both.all() and in_large.tolist() == [False] * n + [True] * 20 * large


def test_rarest_shingles_meet_every_near_passage():
    rng = np.random.default_rng(11)
    least, other = substring_dedup.LEAST, substring_dedup.OTHER
    for letters in (10**6, 30):  # with and without shingles that occur several times
        token = rng.integers(0, letters, 300)
        n = np.where(rng.random(letters) < 0.05, 1, rng.integers(2, 60, letters))[token]
        starts, inside = rng.random(300) < 0.7, np.zeros(300, bool)
        starts[300 - least + 1 :] = False
        inside[100:160] = True
        chosen = substring_dedup.rarest(n, token, starts, inside)
        assert chosen.any() and (n[chosen] > 1).all()
        for s in np.flatnonzero(starts):
            part = slice(s, s + least)
            some, have = np.unique(token[part], return_counts=True)
            alone = {t for t in some.tolist() if n[part][token[part] == t][0] == 1}
            own = {int(t) for t in token[part][chosen[part]]}
            ends = np.flatnonzero(~inside[part])
            if len(ends) <= other:
                continue  # the ends may be looked for instead
            # what a text without those chosen lacks is more than a near one may
            lacks = have[[t in own or t in alone for t in some.tolist()]]
            assert lacks.sum() > other or len(lacks) > len(some) // 5


def test_similar_parts_of_a_stretch_that_is_not_similar():
    rng = np.random.default_rng(4)
    one = rng.integers(0, 2**60, 200).astype(np.uint64)
    other = one.copy()
    other[[20, 66, 68, 112, 158]] = 1  # every fifty words are near, but for those around the middle
    x, y = substring_dedup.runs_hash(one, 5), substring_dedup.runs_hash(other, 5)
    longer = np.insert(x, 100, rng.integers(0, 2**60, 120).astype(np.uint64))
    source = np.where(x == y, np.arange(len(x)) + np.where(np.arange(len(x)) >= 100, 120, 0), -1)
    parts = substring_dedup._similar(longer, y, source, 0, len(y))
    assert parts and min(p for _, (p, _) in parts) == 0 and max(q for _, (_, q) in parts) == len(y)


def test_gradients_of_the_network():
    network = language_id.Network.new(["x", "y", "z"], units=3, seed=1)
    for gru in (network.forwards, network.backwards):
        gru.inputs, gru.gates, gru.candidate = (w.astype(np.float64) for w in (gru.inputs, gru.gates, gru.candidate))
    network.out, network.bias = network.out.astype(np.float64), network.bias.astype(np.float64)
    rng = np.random.default_rng(0)
    data, language = rng.integers(65, 70, (9, 4)).astype(np.uint8), np.array([0, 1, 2, 1])
    weight = (rng.random((9, 4)) < 0.8).astype(float)
    _, slopes = network.gradients(data, language, weight)
    for values, slope in zip(network.weights(), slopes):
        for _ in range(6):
            at = tuple(int(rng.integers(0, n)) for n in values.shape)
            if values.shape[-1] == 256:
                at = (at[0], int(rng.integers(65, 70)))
            kept, step = values[at], 1e-2
            values[at] = kept + step
            up = network.gradients(data, language, weight)[0]
            values[at] = kept - step
            down = network.gradients(data, language, weight)[0]
            values[at] = kept
            assert slope[at] == pytest.approx((up - down) / (2 * step), abs=2e-4, rel=2e-2)


def test_network_labels_whole_texts_of_any_length():
    texts = [(b"abba baab " * 40), (b"xyzzy zyx " * 40)] * 8
    network = language_id.train(texts, ["one", "two"] * 8, steps=60)
    long = b"xyzzy zyx " * 3000
    p = network.probabilities([b"", b"abba baab abba", long, b"1234"])
    assert p[0].sum() == 0 and p[3].sum() == 0 and p[1].argmax() == 0 and p[2].argmax() == 1
    stretches = language_id.long_texts(network, [long * 60])
    assert stretches.argmax() == 1 and abs(stretches.sum() - 1) < 1e-3
    assert language_id.train([], []).languages == []
    assert not language_id.has_letter(None) and not language_id.has_letter("12 %") and language_id.has_letter("é")


def test_toxicity_learns_from_documents_and_finds_the_sentence():
    rng = random.Random(4)
    def sentence():
        return " ".join("".join(rng.choice("abcdef") for _ in range(5)) for _ in range(6))
    texts, labels = [], []
    for i in range(300):
        parts = [sentence() for _ in range(5)]
        if i % 5 == 0:
            parts[rng.randrange(5)] += rng.choice([" grobian", " lumpenkerl"])
        texts.append(". ".join(parts).encode())
        labels.append(int(i % 5 == 0))
    model = toxicity.train(texts, labels)
    found = find_words([b"abcde fedcb. You grobian! abcde.", b"abcde", b""], LETTERS_DIGITS)
    scores, sentences, _ = model.score(found)
    assert scores[0] > 0.5 > scores[1] and scores[2] == 0
    assert sentences.argmax() == 1
    assert toxicity.train(texts, [0] * 300).score(found)[0].max() < 0.01
    assert toxicity.train([], []).score(find_words([b"a"], LETTERS_DIGITS))[0].tolist()[0] < 0.01


def test_unicode_classes_match_what_python_knows():
    table = byte_bpe.character_classes()
    for c in range(0, 0x3000):
        category = unicodedata.category(chr(c))
        if category == "Cn":  # the library may know a later Unicode
            continue
        assert (table[c] == byte_bpe._L) == (category[0] == "L")
        assert (table[c] == byte_bpe._N) == (category[0] == "N")
