"""Collocations against brute force, with tries that burst and spill all the time."""

import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from tidemark.llm import collocations as c

SHAPE = "doc_id long, text string, lang string, n long, rank int, phrase string"


def brute_counts(rows, longest=3):
    counts = defaultdict(Counter)
    for lang, text in rows:
        low = "".join(x.lower() if "A" <= x <= "Z" else x for x in text or "")
        for piece in re.split("[.,;:!?\n-\r]", low):
            words = [w for w in re.split("[ \t]+", piece) if w]
            for n in range(1, longest + 1):
                counts[lang or "und"].update(" ".join(words[i : i + n]) for i in range(len(words) - n + 1))
    return counts


def brute(rows, least, inside=50, longest=3, top=2000):
    out = []
    for lang, counts in brute_counts(rows, longest).items():
        total = sum(f for p, f in counts.items() if " " not in p)
        rated = {}
        for p, a in counts.items():
            words = p.split(" ")
            if len(words) > 1 and a >= least:
                cuts = [(1000000 * a * a // (counts[" ".join(words[:k])] * counts[" ".join(words[k:])]), k) for k in range(1, len(words))]
                score, k = min(cuts)
                rated[p] = (score, a, counts[" ".join(words[:k])], counts[" ".join(words[k:])])
        longer = Counter()
        for p, (_, a, _, _) in rated.items():
            words = p.split(" ")
            for m in range(2, len(words)):
                for i in range(len(words) - m + 1):
                    part = " ".join(words[i : i + m])
                    longer[part] = max(longer[part], a)
        kept = [(-s, -a, p.encode(), l, r) for p, (s, a, l, r) in rated.items() if not (longer[p] and 100 * longer[p] >= inside * a)]
        out += [(lang, i + 1, p.decode(), -a, l, r, total, -s) for i, (s, a, p, l, r) in enumerate(sorted(kept)[:top])]
    return sorted(out)


def found(frame, **options):
    return sorted(tuple(r) for r in c.collocations(frame, **options).collect())


@pytest.fixture(scope="module")
def rows():
    draw = np.random.default_rng(4)
    vocabulary = ["the", "The", "a", "of", "ß", "É", "漢", "x-y", " ", "end"]
    ends = [" ", "  ", "\t", ". ", ",", "\n", "!?", "\x0b", " "]
    texts = []
    for i in range(120):
        n = int(draw.integers(0, 60))
        text = "".join(vocabulary[int(draw.integers(0, 1 + i % 10))] + ends[int(draw.choice(9, p=[0.5, 0.1, 0.1, 0.05, 0.05, 0.05, 0.03, 0.02, 0.1]))] for _ in range(n))
        texts.append((["en", "de", None, "und"][i % 4], text))
    return texts + [("en", None), ("fr", ""), ("fr", " .\n"), ("en", "A.b"), ("en", "the of " * 4000)]


@pytest.mark.parametrize("limits", [{}, {"limit": 20, "stretch": 7, "numbers": 16, "parts": 3}, {"limit": 200, "stretch": 64, "numbers": 1000}])
def test_equals_brute_force(spark, rows, limits):
    frame = spark.createDataFrame([(1, t, lang, 1, 1, "x") for lang, t in rows], SHAPE)
    for options in ({"least": 10}, {"least": 2, "inside": 90, "top": 5}):
        assert found(frame, **options, **limits) == brute(rows, **options)


def test_longer_phrases(spark, rows):
    frame = spark.createDataFrame([(1, t, lang, 1, 1, "x") for lang, t in rows], SHAPE)
    assert found(frame, longest=4, least=3, numbers=5000, stretch=1000) == brute(rows, 3, longest=4)
    with pytest.raises(ValueError, match="63 bits"):
        c.collocations(frame, longest=4)


def test_trie_bursts_and_spills_whole_subtrees():
    draw = np.random.default_rng(0)
    for bits in (21, 15):
        depth = 63 // bits
        trie, want = c.HatTrie(depth, bits, burst=8), Counter()
        for _ in range(30):
            some = np.sort(draw.integers(0, 9, (200, depth)) * (np.arange(depth) == 0) + draw.integers(0, 9, (200, depth)), axis=0) + [1] + np.zeros((200, depth), int)
            packed = [sum(int(x) << (bits * (depth - 1 - i)) for i, x in enumerate(r)) for r in some]
            want.update(packed)
            trie.add(*np.unique(np.array(packed, np.int64), return_counts=True))
        assert trie.size == len(want) == sum(trie.sizes.values())
        assert any(isinstance(child, c._Node) for child in trie.root.values())
        largest, before = max(trie.sizes.values()), trie.size
        keys, counts = trie.take(before - 1)
        assert len(keys) == largest and len(set((keys >> (bits * (depth - 1))).tolist())) == 1
        rest, more = trie.take(0)
        assert dict(zip([*keys.tolist(), *rest.tolist()], [*counts.tolist(), *more.tolist()])) == want
        assert trie.size == 0 and not trie.root and len(keys) + len(rest) == len(want)


@pytest.mark.parametrize("size", [6, 12, 26])
def test_a_full_filter_loses_nothing(spark, rows, size):
    frame = spark.createDataFrame([(1, t, lang, 1, 1, "x") for lang, t in rows], SHAPE)
    assert found(frame, least=3, filter_bits=size) == brute(rows, 3)


def test_products_past_64_bits(spark):
    counts = spark.createDataFrame([("en", "", 10**15 - 1), ("en", "a", 10**14 + 7), ("en", "b", 10**14 + 9), ("en", "a b", 10**14 + 3)], "lang string, phrase string, f long")
    a, left, right = 10**14 + 3, 10**14 + 7, 10**14 + 9
    assert [(r["phrase"], r["score"]) for r in c.scored(counts).collect()] == [("a b", 1000000 * a * a // (left * right))]


def test_empty_and_very_long(spark):
    empty = spark.createDataFrame([], SHAPE)
    assert found(empty) == []
    words = [f"w{i * 7919 % 997}" for i in range(300_000)]
    rows = [(None, " ".join(words))]
    assert found(spark.createDataFrame([(1, rows[0][1], None, 1, 1, "")], SHAPE), least=200) == brute(rows, 200)
