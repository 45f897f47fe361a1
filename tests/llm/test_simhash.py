"""SimHash near-duplicates against brute force."""

import itertools
import re

import numpy as np
import pytest
import xxhash

from tidemark.llm import simhash
from tidemark.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def brute_components(prints, radius=4):
    """The smallest element that each distinct print reaches."""
    prints = sorted(set(prints))
    parent = {p: p for p in prints}

    def root(p):
        while parent[p] != p:
            parent[p] = parent[parent[p]]
            p = parent[p]
        return p

    for a, b in itertools.combinations(prints, 2):
        if bin((a ^ b) & (2**64 - 1)).count("1") <= radius:
            low, high = sorted((root(a), root(b)))
            parent[high] = low
    return {p: root(p) for p in prints}


def brute_print(text):
    words = [w for w in re.split("[ \t-\r]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")) if w]
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_masks_cover_every_pair_within_the_radius():
    draw = np.random.default_rng(3)
    for radius, level in ((1, 0), (2, 1), (4, 0), (4, 1), (4, 5)):
        tables = simhash.masks(radius, level)
        assert len(tables) == 2 ** (radius + 1) - 1
        assert all(24 <= m.bit_count() <= 44 for m in tables) or radius < 4
        for _ in range(3000):
            apart = sum(1 << int(b) for b in draw.choice(64, radius, replace=False))
            assert any(not m & apart for m in tables)


def test_query_equals_brute_force(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    prints = {i: brute_print(t) for i, t in docs}
    reach = brute_components(prints.values())
    least = {}
    for i in sorted(prints):
        least.setdefault(reach[prints[i]], i)
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in QUERIES["op12_simhash_dedup"](spark, SF).collect()}
    assert got == {i: (f"{p:016x}", least[reach[p]]) for i, p in prints.items()}


@pytest.mark.parametrize("small,hubs", [(64, 8), (4, 1), (2, 2)])
def test_dense_groups_lose_no_link(spark, small, hubs):
    """Chains and balls around few centres, so that large buckets are split again and again."""
    draw = np.random.default_rng(small)
    prints = {0, 1, 7, 2**63, 2**64 - 1}
    for centre in draw.integers(0, 1 << 63, 3, dtype=np.uint64).tolist():
        for _ in range(120):
            p = centre
            for b in draw.choice(64, int(draw.integers(0, 9)), replace=False):
                p ^= 1 << int(b)
            prints.add(p)
    signed = sorted({int(np.uint64(p).view(np.int64)) for p in prints})
    path = simhash.stored(spark.createDataFrame([(p,) for p in signed], "node long"), "nodes")
    got = {r["node"]: r["label"] for r in simhash.labelled(path, small=small, hubs=hubs).collect()}
    assert {p: got.get(p, p) for p in signed} == brute_components(signed)


def test_long_text_ties_and_short_texts(spark):
    long = "a b c d e f g\n" * 6_000
    assert len(long.split()) > simhash.STRETCH and simhash.fingerprint(long.encode()) == brute_print(long)
    rows = [(1, None), (2, " \t\n"), (3, "One  Two"), (4, "one two"), (None, "one\ttwo"), (5, "x" * 3_000_000), (4, "one two"), (6, long)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 node", "2 label", "'x' path")
    got = sorted((r["doc_id"] or -1, r["fingerprint"], r["component_id"]) for r in simhash.near_duplicates(frame).collect())
    zero, two = "0" * 16, f"{brute_print('one two'):016x}"
    assert got[0] == (-1, two, 3) and got[1:6] == [(1, zero, 1), (2, zero, 1), (3, two, 3), (4, two, 3), (4, two, 3)]
    assert got[6] == (5, f"{xxhash.xxh64_intdigest(b'x' * 3_000_000, seed=42):016x}", 5)


def test_only_null_ids_have_no_component_id(spark):
    frame = spark.createDataFrame([(None, "a b"), (None, "a b")], "doc_id long, text string")
    assert [r["component_id"] for r in simhash.near_duplicates(frame).collect()] == [None, None]
