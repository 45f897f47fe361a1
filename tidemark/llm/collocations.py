"""Collocations: phrases counted in HAT-tries, merged per prefix partition, scored by their weakest cut.

A text with A-Z lowered is split at `[.,;:!?\\x0A-\\x0D]` into pieces, and these into words
`[^\\x20\\x09]+`. Every phrase of up to `longest` words inside a piece counts, overlaps
included, per lang.

Counting. A task numbers its words and keeps one trie a lang: a shallow trie over word numbers
whose leaves are hash containers (suffix -> count). A container of more than `BURST` entries
bursts into a node with a container for each next word. Above `LIMIT` entries whole subtrees,
the largest first, are spilled as sorted runs until an eighth is left, so a task's memory is bounded
whatever its input. A run has the phrases of one prefix partition in the order of their numbers,
one row a partition; the prefix is the first word and one of `SPREAD` parts of the second, so the
phrases of a very common first word are not one partition. Runs are shuffled once, by partition,
and merged there by a sum that needs no further shuffle.

Words and pairs are counted first, then each longer length in a pass of its own: a phrase of n
words that reaches `least` holds two of n - 1 words that do, so it is counted only where both are
in a Bloom filter of those. The filter has `1 << FILTER` bits whatever the corpus; what it lets
through wrongly is counted and dropped, and it never holds back what belongs in, so a filter that a
large corpus fills costs time, not phrases.

A candidate has 2 words or more and a count a of `least` or more. Cutting it behind its first k
words gives l and r, the counts of both parts, and floor(1000000 * a * a / (l * r)); the
lowest score counts, ties to the smallest k. All parts of a candidate are as frequent, so only
phrases that reach `least` are kept after the merge. Arithmetic is in 38 digits: exact for
counts up to 10^15, an error beyond. A candidate goes if it stands inside a longer candidate
that has `inside` per cent of its count or more. Each lang keeps its first `top`.

Nulls: a null lang is `und`, a null text is empty. Repeated rows count each. Ties of score and
count go by the phrase's UTF-8 bytes. A long text is worked on in stretches of `STRETCH` words
that look on to the next. Empty tables and texts without candidates give no rows. Other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.tables import stored
from tidemark.llm.text import LOWER, blocks, marks, shingles, words

LONGEST, LEAST, INSIDE, TOP = 3, 10, 50, 2000
UNDEFINED = "und"
#: Entries of a container before it bursts, of a task's tries before they spill, parts of a hot first word.
BURST, LIMIT, SPREAD = 1 << 12, 1 << 19, 16
#: Words worked on at once, and words that a task numbers before it starts anew. Bits of a filter, as a power of two.
STRETCH, NUMBERS, FILTER = 1 << 17, 1 << 19, 26
_CUTS = marks((0x0A, 0x0D), *((ord(c), ord(c)) for c in ".,;:!?"))
_WORD = marks((0x09, 0x0D), (0x20, 0x20), *((ord(c), ord(c)) for c in ".,;:!?"))


class HatTrie:
    """Counts of sequences of numbers: hash containers under a shallow trie that grows where containers burst.

    A node is a dict of number -> child; a child is a node or a container. A container is a dict of
    packed suffix -> count, where a suffix has `bits` bits for each number that is left, 0 for none.
    """

    def __init__(self, depth: int, bits: int, burst: int = BURST) -> None:
        self.depth, self.bits, self.burst = depth, bits, burst
        self.root: dict[int, dict] = {}
        self.sizes: dict[int, int] = {}
        self.size = 0

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        """Packed sequences in order, without repeats, and how often each was seen."""
        shift = self.bits * (self.depth - 1)
        first = keys >> shift
        edges = [0, *(np.flatnonzero(first[1:] != first[:-1]) + 1).tolist(), len(first)] if len(first) else [0]
        firsts, suffixes, seen = first[edges[:-1]].tolist(), (keys & ((1 << shift) - 1)).tolist(), counts.tolist()
        for at, low, high in zip(firsts, edges, edges[1:]):
            child = self.root.get(at)
            if child is None:
                child = self.root[at] = {}
            more = self._put(child, suffixes[low:high], seen[low:high], self.depth - 1)
            if len(child) > self.burst and self.depth > 2 and type(child) is dict:
                self.root[at] = self._burst(child, self.depth - 1)
            self.sizes[at] = self.sizes.get(at, 0) + more
            self.size += more

    def _put(self, child: dict, suffixes: list[int], counts: list[int], left: int) -> int:
        """Add suffixes of `left` numbers; by how many entries the child grew."""
        if type(child) is dict:
            before, get = len(child), child.get
            for key, count in zip(suffixes, counts):
                child[key] = get(key, 0) + count
            return len(child) - before
        shift, more = self.bits * (left - 1), 0
        mask = (1 << shift) - 1
        for key, count in zip(suffixes, counts):
            below = child.get(key >> shift)
            if below is None:
                below = child[key >> shift] = {}
            more += self._put(below, [key & mask], [count], left - 1)
            if len(below) > self.burst and left > 2 and type(below) is dict:
                child[key >> shift] = self._burst(below, left - 1)
        return more

    def _burst(self, container: dict, left: int) -> _Node:
        node = _Node()
        self._put(node, list(container), list(container.values()), left)
        return node

    def take(self, most: int) -> tuple[np.ndarray, np.ndarray]:
        """Packed sequences and counts of whole subtrees, the largest first, which are removed until `most` entries are left."""
        keys: list[int] = []
        counts: list[int] = []
        shift = self.bits * (self.depth - 1)
        firsts, sizes = (np.fromiter(x, np.int64, len(self.sizes)) for x in (self.sizes.keys(), self.sizes.values()))
        for at in firsts[np.argsort(-sizes, kind="stable")].tolist():
            if self.size <= most:
                break
            self.size -= self.sizes.pop(at)
            self._gather(self.root.pop(at), at << shift, self.depth - 1, keys, counts)
        return np.array(keys, np.int64), np.array(counts, np.int64)

    def _gather(self, child: dict, prefix: int, left: int, keys: list[int], counts: list[int]) -> None:
        if type(child) is dict:
            keys.extend([prefix | k for k in child])
            counts.extend(child.values())
        else:
            for at, below in child.items():
                self._gather(below, prefix | at << (self.bits * (left - 1)), left - 1, keys, counts)


class _Node(dict):
    """Number -> child."""


def _slots(prints: np.ndarray, size: int) -> np.ndarray:
    """The places of each print in a Bloom filter of 2 ** size bits."""
    mask = np.uint64((1 << size) - 1)
    return np.stack((prints & mask, prints >> np.uint64(64 - size)), axis=-1)


def _among(prints: np.ndarray, bloom: np.ndarray) -> np.ndarray:
    size = len(bloom).bit_length() + 5
    at = _slots(prints, size)
    hit = bloom[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63)) & np.uint64(1)
    return (hit.all(axis=-1)) & (prints != 0)


class _Counter:
    """A task's tries, one a lang, with the numbers of its words, for phrases of `low` to `high` words."""

    def __init__(self, low: int, high: int, parts: int, bloom: np.ndarray | None) -> None:
        self.low, self.high, self.parts, self.bloom = low, high, parts, bloom
        self.bits = 63 // high
        self.clear()

    def clear(self) -> None:
        self.ids: dict[bytes, int] = {}
        self.tries: dict[str, HatTrie] = {}
        self.totals: dict[str, int] = {}
        self.names: list[bytes] = [b""]

    @property
    def size(self) -> int:
        return sum(t.size for t in self.tries.values())

    def add(self, lang: str, data: bytes, start: np.ndarray, end: np.ndarray, hashes: np.ndarray, piece: np.ndarray, new: int) -> None:
        """Phrases that begin among the first `new` words; the others are what these look on to."""
        begins = []
        for n in range(self.low, self.high + 1):
            last = max(0, min(new, len(piece) - n + 1))
            fits = piece[:last] == piece[n - 1 : last + n - 1]
            if self.bloom is not None and last:
                known = _among(shingles(hashes, piece, n - 1), self.bloom)
                fits &= known[:last] & known[1 : last + 1]
            begins.append(np.flatnonzero(fits))
        needed = np.zeros(len(piece), bool)
        for n, at in zip(range(self.low, self.high + 1), begins):
            for j in range(n):
                needed[at + j] = True
        needed = np.flatnonzero(needed)
        ids = self.ids
        number = np.zeros(len(piece), np.int64)
        number[needed] = [ids.setdefault(data[a:b], len(ids) + 1) for a, b in zip(start[needed].tolist(), end[needed].tolist())]
        keys = []
        for n, at in zip(range(self.low, self.high + 1), begins):
            key = np.zeros(len(at), np.int64)
            for j in range(n):
                key = (key << self.bits) + number[at + j]
            keys.append(key << (self.bits * (self.high - n)))
        trie = self.tries.setdefault(lang, HatTrie(self.high, self.bits))
        trie.add(*np.unique(np.concatenate(keys), return_counts=True))
        if self.low == 1:
            self.totals[lang] = self.totals.get(lang, 0) + new

    def spill(self, most: int) -> Iterator[pa.RecordBatch]:
        """Sorted runs of whole subtrees until `most` entries are left; with 0, everything, and the numbers start anew."""
        self.names.extend(islice(self.ids, len(self.names) - 1, None))
        for lang, trie in sorted(self.tries.items(), key=lambda t: -t[1].size):
            if most and self.size <= most:
                break
            keys, counts = trie.take(max(0, most - self.size + trie.size))
            path = [keys >> (self.bits * i) & ((1 << self.bits) - 1) for i in reversed(range(self.high))]
            # Only the words of these phrases, 0 for none.
            used = np.unique(np.concatenate([[0], *path]))
            named = [self.names[i] for i in used.tolist()]
            path = [np.searchsorted(used, p) for p in path]
            code = np.fromiter(map(zlib.crc32, named), np.int64, len(named))
            first, further = pa.array(named, pa.binary()), pa.array([b" " + w if w else w for w in named], pa.binary())
            part = code[path[0]]
            if self.high > 1:
                part = part + np.where(path[1] > 0, 31 * (code[path[1]] % SPREAD + 1), 0)
            part %= self.parts
            order = np.lexsort((keys, part))
            words_ = [(further if i else first).take(pa.array(p[order])) for i, p in enumerate(path)]
            yield from self._rows(lang, part[order], pc.binary_join_element_wise(*words_, b"") if len(words_) > 1 else words_[0], counts[order])
        if not most:
            for lang, total in self.totals.items():
                yield from self._rows(lang, np.array([zlib.crc32(lang.encode()) % self.parts]), pa.array([b""], pa.binary()), np.array([total]))
            self.clear()

    def _rows(self, lang: str, part: np.ndarray, phrases: pa.Array, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
        edges = np.append(np.flatnonzero(np.append(True, part[1:] != part[:-1])) if len(part) else [], len(part)).astype(np.int32)
        runs = pa.ListArray.from_arrays(pa.array(edges), phrases.cast(pa.string()))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(part[edges[:-1]].astype(np.int32)),
                pa.array([lang] * (len(edges) - 1), pa.string()),
                pc.binary_join(runs, "\n"),
                pa.ListArray.from_arrays(pa.array(edges), pa.array(counts, pa.int64())),
            ],
            names=["part", "lang", "phrases", "counts"],
        )


def _counted(low: int, high: int, parts: int, bloom: np.ndarray | None, limit: int, numbers: int, stretch: int):
    """For mapInArrow over (lang, text): sorted runs (part, lang, phrases one a line, counts)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _Counter(low, high, parts, bloom)
        for batch in batches:
            langs = batch.column("lang").to_pylist()
            for first, last, raw, offsets in blocks(batch):
                data = raw.translate(LOWER)
                start, end, hashes, row = words(data, offsets, _WORD)
                # A piece ends at a cut and at a row's end.
                piece = np.cumsum(~_CUTS[np.frombuffer(data, np.uint8)])[start] + (row << 40)
                of: dict[str, list[int]] = {}
                for i in range(first, last):
                    of.setdefault(langs[i], []).append(i - first)
                for lang, rows in of.items():
                    mine = np.flatnonzero(np.isin(row, rows)) if len(of) > 1 else np.arange(len(row))
                    for at in range(0, len(mine), stretch):
                        some = mine[at : at + stretch + high - 1]
                        if len(counter.ids) + len(some) > numbers:
                            yield from counter.spill(0)
                        counter.add(lang, data, start[some], end[some], hashes[some], piece[some], min(stretch, len(mine) - at))
                        if counter.size > limit:
                            yield from counter.spill(limit // 8)
        yield from counter.spill(0)

    return run


def _bloom_bits(size: int):
    """For mapInArrow over (phrase): (slot, bits) of the phrases' places in the filter."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, data, offsets in blocks(batch, "phrase"):
                _, _, hashes, row = words(data, offsets, _WORD)
                n = np.bincount(row, minlength=len(offsets) - 1)
                # All phrases have as many words.
                prints = shingles(hashes, row, int(n.max(initial=0)))
                at = np.unique(_slots(prints[prints != 0], size).reshape(-1))
                slot, first = np.unique(at >> np.uint64(6), return_index=True)
                bits = np.bitwise_or.reduceat(np.uint64(1) << (at & np.uint64(63)), first) if len(at) else at
                yield pa.RecordBatch.from_arrays([pa.array(slot.astype(np.int32)), pa.array(bits.view(np.int64))], names=["slot", "bits"])

    return run


def _bloom(phrases: DataFrame, size: int) -> np.ndarray:
    """The filter of all phrases, of 2 ** size bits."""
    found = phrases.select("phrase").mapInArrow(_bloom_bits(size), "slot int, bits long").groupBy("slot").agg(F.bit_or("bits").alias("bits")).toArrow()
    out = np.zeros(1 << (size - 6), np.uint64)
    out[found.column("slot").to_numpy()] = found.column("bits").to_numpy().view(np.uint64)
    return out


def phrase_counts(documents: DataFrame, longest: int = LONGEST, least: int = LEAST, parts: int | None = None, limit: int = LIMIT, numbers: int = NUMBERS, stretch: int = STRETCH, filter_bits: int = FILTER) -> DataFrame:
    """(lang, phrase, f) of each phrase of up to `longest` words that is found `least` times or more; the phrase "" has the number of all words.

    `parts` is the number of prefix partitions, by default four for each shuffle partition of the session.
    """
    if not 1 <= longest or max(numbers, stretch + longest) >= 1 << 63 // longest or filter_bits < 6:
        raise ValueError("the numbers of a phrase's words do not fit in 63 bits: choose smaller `numbers` and `stretch`, or `longest`")
    spark = documents.sparkSession
    parts = parts or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    texts = documents.select(F.coalesce(F.col("lang").cast("string"), F.lit(UNDEFINED)).alias("lang"), F.col("text").cast("string").alias("text")).filter("text is not null")
    out, bloom, low = None, None, 1
    for high in range(min(2, longest), longest + 1):
        runs = texts.mapInArrow(_counted(low, high, parts, bloom, limit, numbers, stretch), "part int, lang string, phrases string, counts array<long>")
        each = runs.repartition("part").select("part", "lang", F.inline(F.arrays_zip(F.split("phrases", "\n").alias("phrase"), "counts")).alias("phrase", "n"))
        # Dealt out by partition already, so the sum needs no shuffle of its own.
        merged = each.groupBy("part", "lang", "phrase").agg(F.sum("n").alias("f"))
        found = stored(merged.filter((F.col("f") >= least) | (F.col("phrase") == "")).select("lang", "phrase", "f"), "phrases")
        out, low = found if out is None else out.unionAll(found), high + 1
        if high < longest:
            bloom = _bloom(found.filter((F.size(F.split("phrase", " ")) == high) & (F.col("phrase") != "")), filter_bits)
    return out


def _cut(n: Column, k: Column) -> tuple[Column, Column]:
    """A phrase's first k and its other words."""
    return F.array_join(F.slice("words", F.lit(1), k), " "), F.array_join(F.slice("words", k + 1, n - k), " ")


def scored(counts: DataFrame, least: int = LEAST) -> DataFrame:
    """(lang, phrase, words, a, l, r, score) of every candidate, from `phrase_counts`."""
    known = counts.filter(F.col("phrase") != "").withColumn("words", F.split("phrase", " "))
    n = F.size("words")
    candidates = known.filter((n > 1) & (F.col("f") >= least)).select("lang", "phrase", "words", F.col("f").alias("a"), F.explode(F.sequence(F.lit(1), n - 1)).alias("k"))
    left, right = _cut(n, F.col("k"))
    candidates = candidates.withColumn("left", left).withColumn("right", right)
    both = candidates.join(counts.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l")), ["lang", "left"])
    both = both.join(counts.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r")), ["lang", "right"])
    score = F.expr("(1000000bd * cast(a as decimal(15,0)) * cast(a as decimal(15,0))) div (cast(l as decimal(15,0)) * cast(r as decimal(15,0)))")
    each = both.withColumn("score", score)
    weakest = each.groupBy("lang", "phrase").agg(F.min_by(F.struct("words", "a", "l", "r", "score"), F.struct("score", "k")).alias("cut"))
    return weakest.select("lang", "phrase", "cut.*")


def collocations(documents: DataFrame, longest: int = LONGEST, least: int = LEAST, inside: int = INSIDE, top: int = TOP, **options) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of each lang's first `top` phrases."""
    counts = phrase_counts(documents, longest, least, **options)
    candidates = stored(scored(counts, least), "candidates")
    n = F.size("words")
    # The phrases inside a longer candidate, each with the count of the most frequent one.
    parts = F.flatten(F.transform(F.sequence(F.lit(2), n - 1), lambda m: F.transform(F.sequence(F.lit(1), n - m + 1), lambda at: F.array_join(F.slice("words", at, m), " "))))
    held = candidates.filter(n > 2).select("lang", "a", F.explode(F.array_distinct(parts)).alias("phrase")).groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    left = candidates.join(held, ["lang", "phrase"], "left").filter(f"longer is null or 100 * longer < {inside} * a").drop("longer", "words")
    best = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # First within parts of a lang, so that none is sorted whole in one task.
    first = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(64))).orderBy(*best)
    some = left.withColumn("rank", F.row_number().over(first)).filter(F.col("rank") <= top).drop("rank")
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best)).cast("long")).filter(F.col("rank") <= top)
    totals = counts.filter(F.col("phrase") == "").select("lang", F.col("f").alias("n"))
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
