"""Katz backoff language model of any order, counted, stored and evaluated by joins.

Tokens are words with A-Z lowered, then one end. Every token is one n-gram of each order k up
to `order`: itself (w) after the k - 1 tokens before it (h), starts standing before the text.
Counts r of up to `most` get the Good-Turing discount of Katz, d(r) = (r* / r - x) / (1 - x)
with r* = (r + 1) n(r + 1) / n(r) and x = (most + 1) n(most + 1) / n(1), where n(r) is the
number of n-grams of that order seen r times; where the numbers of a small corpus give no
discount between 0 and 1, (r - 1/2) / r. With h' for h without its first token,

    P(w)     = d(c(w)) c(w) / N                    for a token seen, what is left for one never seen
    P(w | h) = d(c(h, w)) c(h, w) / c(h)           for an n-gram seen
             = alpha(h) P(w | h')                  else, and P(w | h') where h was never seen
    alpha(h) = (1 - sum of P(w | h)) / (1 - sum of P(w | h')), both over the w seen after h

so the probabilities after any h add up to 1, all unseen tokens counting as one. After an h
whose n-grams are all too frequent for a discount, c(h) counts one more, so that something
is left for other tokens. A history with no probability left for other tokens keeps its
plain shares.

Texts are put into blocks of some megabytes once, with each block's distinct words; these rows,
not the tokens, are counted, numbered by falling count and joined back, and the block is written
with numbers for words. A number tells its token's count by a list of the counts there are. All
n-grams with the same token before w (v) meet in one part, where every order of the recursion is
counted and evaluated, first for n(r), then for the shares; v that are more frequent than a part
are dealt among several by the token before v, and their pairs (v, w) are counted over all parts
and sent to each. A part's n-grams come as packed columns, one row for each block. Words go by
64-bit hashes until they have a number; texts by 128 bits. Shuffle files and tables go as soon as
the step behind them is written. All that follows one h of two tokens
or more meets in one part, every occurrence, in memory.

Nulls: a null text is empty, of one token, the end; a null doc_id is not the empty one. Rows
are told apart by doc_id and text; repeated rows count each in training and get the same
score, whether `train` (null: no) is the same or not. Without training rows all tokens are the
one that is unseen: every score is 0. A text of any length is counted whole, in one block if it is longer
than a block. Ties cannot matter: nothing is ordered. Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.tables import tidied, written
from tidemark.llm.text import LOWER, PLAIN, blocks, by_part, mix, pack, unpack, words
from tidemark.session import Scratch

#: The hash of the end as a word; the numbers of a word not learned, of the start and of the most frequent word.
END = 2
UNKNOWN, START, FIRST = 0, 1, 2
ORDER = 3
MOST = 5
#: Rows of up to five numbers that go to every task; a larger table is joined by a shuffle.
BROADCAST_ROWS = 1 << 20
#: Bytes of text in a block, tokens in a part, and the least parts of a corpus that is not small.
BLOCK, PART, PARTS, SMALL = 1 << 24, 1 << 21, 48, 1 << 14
TEXT = ["text_a", "text_b"]
_BLOCKS = "block long, words array<long>, counts array<long>, data binary, sizes array<long>, train array<boolean>, text_a array<long>, text_b array<long>"
_CODED = "block long, data binary, sizes array<long>, train array<boolean>, text_a array<long>, text_b array<long>, n_known array<long>, base array<double>"
Batches = Iterator[pa.RecordBatch]


def discounts(seen: dict[int, int], most: int = MOST) -> list[float]:
    """d(1) .. d(most), from the numbers of events by count."""
    n = [0] + [seen.get(r, 0) for r in range(1, most + 2)]
    x = (most + 1) * n[most + 1] / n[1] if n[1] else 1.0
    out = []
    for r in range(1, most + 1):
        plain = (r - 0.5) / r
        if n[r] and x < 1:
            d = ((r + 1) * n[r + 1] / n[r] / r - x) / (1 - x)
            out.append(d if 0 < d < 1 else plain)
        else:
            out.append(plain)
    return out


def _discounted(count: np.ndarray, by: list[float]) -> np.ndarray:
    return count * np.array([1.0, *by, 1.0])[np.minimum(count, len(by) + 1).astype(np.int64)]


@dataclass
class Tokens:
    """The counts of the tokens by their numbers: `counts` falls, and the numbers below `ends` have the count of that place or one before it."""

    counts: np.ndarray
    ends: np.ndarray
    by: list[float]
    n: int
    v: int
    unseen: float

    def count(self, ids: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.ends, ids.astype(np.int64), "right")
        return np.where(ids < FIRST, 0, np.append(self.counts, 0)[at])

    def chance(self, ids: np.ndarray) -> np.ndarray:
        c = self.count(ids)
        return np.where(c > 0, _discounted(c, self.by) / max(self.n, 1), self.unseen)

    def base(self, ids: np.ndarray) -> np.ndarray:
        return np.log10((self.count(ids) + 0.5) / (self.n + 0.5 * (self.v + 1)))


def _tokens(seen: dict[int, int], most: int) -> Tokens:
    """From the number of tokens by count."""
    counts = np.array(sorted(seen, reverse=True), np.int64)
    many = np.array([seen[int(c)] for c in counts], np.int64)
    n, by = int((counts * many).sum()), discounts(seen, most)
    kept = float((_discounted(counts, by) * many).sum())
    return Tokens(counts, FIRST + np.cumsum(many), by, n, int(many.sum()), max(0.0, 1 - kept / n) if n else 1.0)


def _blocked(size: int) -> Callable[[Batches], Batches]:
    """Of (text_a, text_b, train, text) blocks of texts: their distinct words, each counted in the texts learned from, and for each token the place of its word."""

    def run(batches: Batches) -> Batches:
        held, held_bytes, made = [], 0, 0

        def block() -> pa.RecordBatch:
            tokens, sizes, train, text_a, text_b = (np.concatenate(x) for x in zip(*held))
            unique, at = np.unique(tokens, return_inverse=True)
            counts = np.bincount(at[np.repeat(train, sizes)], minlength=len(unique))
            row = [(TaskContext.get().partitionId() << 32) + made], [unique.view(np.int64)], [counts], [pack(at)], [sizes], [train], [text_a], [text_b]
            kinds = pa.int64(), *[pa.list_(pa.int64())] * 2, pa.binary(), pa.list_(pa.int64()), pa.list_(pa.bool_()), *[pa.list_(pa.int64())] * 2
            return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(row, kinds)], names=[c.split()[0] for c in _BLOCKS.split(", ")])

        for batch in batches:
            for low, high, raw, offsets in blocks(batch):
                _, _, hashes, row = words(raw.translate(LOWER), offsets, PLAIN)
                ends = np.searchsorted(row, np.arange(high - low), "right")
                tokens = np.insert(hashes, ends, np.uint64(END))
                sizes = np.diff(np.append(0, ends)) + 1
                held.append((tokens, sizes, *(batch.column(c).slice(low, high - low).to_numpy(zero_copy_only=False) for c in ("train", *TEXT))))
                held_bytes += len(raw)
                if held_bytes >= size:
                    yield block()
                    held, held_bytes, made = [], 0, made + 1
        if held:
            yield block()

    return run


def _gathered(batches: Batches) -> Batches:
    """Of (block, pos, id) the places and numbers of each block's words."""
    for batch in batches:
        block, pos, ids = (batch.column(c).to_numpy() for c in ("block", "pos", "id"))
        by = np.argsort(block, kind="stable")
        at = np.flatnonzero(np.append(True, np.diff(block[by]) != 0)) if len(by) else np.zeros(0, np.int64)
        parts = [by[a:b] for a, b in zip(at, np.append(at[1:], len(by)))]
        yield pa.RecordBatch.from_arrays([pa.array(block[by[at]]), pa.array([pack(pos[x], ids[x]) for x in parts], pa.binary())], names=["block", "ids"])


def _coded(tokens: Tokens) -> Callable[[Batches], Batches]:
    """Of a block's row and the numbers of its words: the block with numbers for words, and what each text has of the base score."""

    def run(batches: Batches) -> Batches:
        found, rows = {}, []
        for batch in batches:
            for i in range(batch.num_rows):
                if batch.column("ids")[i].is_valid:
                    found.setdefault(batch.column("block")[i].as_py(), []).append(batch.column("ids")[i].as_py())
                else:
                    rows.append(batch.slice(i, 1))
        for row in rows:
            block = row.column("block")[0].as_py()
            (at,) = unpack(row.column("data")[0].as_py())
            ids = np.full(row.column("n_words")[0].as_py(), UNKNOWN, np.uint64)
            for data in found.pop(block, ()):
                pos, number = unpack(data)
                ids[pos.astype(np.int64)] = number
            at = at.astype(np.int64)
            begin = np.append(0, np.cumsum(row.column("sizes")[0].values.to_numpy()))[:-1]
            known = np.add.reduceat((ids != UNKNOWN).astype(np.int64)[at], begin)
            base = np.add.reduceat(tokens.base(ids)[at], begin)
            arrays = [pa.array([pack(ids[at])], pa.binary()), *(row.column(c) for c in ("sizes", "train", *TEXT)), pa.array([known], pa.list_(pa.int64())), pa.array([base], pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays([row.column("block"), *arrays], names=[c.split()[0] for c in _CODED.split(", ")])

    return run


def _splits(tokens: Tokens, texts: int, part: int, parts: int) -> np.ndarray:
    """Among how many parts the n-grams after a token are dealt, by the token's number; 1 from the last one on."""
    hot = int(np.searchsorted(-tokens.counts, -part, "left"))  # the counts above `part`
    many = np.diff(np.append(FIRST, tokens.ends[:hot]))
    after = np.repeat(tokens.counts[:hot], many)
    return np.minimum(parts, np.concatenate(([parts, -(-max(texts, 1) // part)], -(-after // part), [1]))).astype(np.uint64)


def _dealt(v: np.ndarray, other: np.ndarray, splits: np.ndarray, parts: int) -> np.ndarray:
    """The part of n-grams whose history ends in v; those of a frequent v are dealt out by another token."""
    many = splits[np.minimum(v, len(splits) - 1).astype(np.int64)]
    return ((mix(v + np.uint64(1)) % np.uint64(parts) + mix(other + np.uint64(7)) % many) % np.uint64(parts)).astype(np.int64)


def _spread(order: int, splits: np.ndarray, parts: int, learned: bool) -> Callable[[Batches], Batches]:
    """Of coded blocks (part, block, data): the n-grams, w first, and the text and whether it was learned from; `learned`: only of such texts."""
    pad = order - 1

    def run(batches: Batches) -> Batches:
        for batch in batches:
            for i in range(batch.num_rows):
                (ids,) = unpack(batch.column("data")[i].as_py())
                sizes, train = (batch.column(c)[i].values.to_numpy(zero_copy_only=False) for c in ("sizes", "train"))
                begin = np.append(0, np.cumsum(sizes))[:-1]
                padded = np.insert(ids, np.repeat(begin, pad), np.uint64(START))
                own = np.repeat(np.arange(len(sizes)), sizes)
                place = np.arange(len(ids)) + (own + 1) * pad
                if learned:
                    used = train[own]
                    own, place = own[used], place[used]
                grams = [padded[place - k] for k in range(order)]
                part = _dealt(grams[1], grams[2 if order > 2 else 0], splits, parts) if order > 1 else np.arange(len(place)) * parts // max(len(place), 1)
                named = own * 2 + train[own]
                found = [(p, pack(*(g[at] for g in grams), np.diff(named[at], prepend=0))) for p, at in by_part(part)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([p for p, _ in found], pa.int32()), pa.array([batch.column("block")[i].as_py()] * len(found), pa.int64()), pa.array([d for _, d in found], pa.binary())],
                    names=["part", "block", "data"],
                )

    return run


def _frequent(splits: np.ndarray, parts: int) -> Callable[[Batches], Batches]:
    """Of (v, w, c) after frequent tokens (part, block, data) for each part that the n-grams after v are dealt among."""

    def run(batches: Batches) -> Batches:
        for batch in batches:
            v, w, c = (batch.column(x).to_numpy().astype(np.uint64) for x in "vwc")
            many = splits[np.minimum(v, len(splits) - 1).astype(np.int64)].astype(np.int64)
            row = np.repeat(np.arange(len(v)), many)
            turn = np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many)
            part = ((mix(v + np.uint64(1)) % np.uint64(parts)).astype(np.int64)[row] + turn) % parts
            found = [(p, pack(v[row[at]], w[row[at]], c[row[at]])) for p, at in by_part(part)]
            yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in found], pa.int32()), pa.array([-1] * len(found), pa.int64()), pa.array([d for _, d in found], pa.binary())], names=["part", "block", "data"])

    return run


def _unique(high: np.ndarray, low: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(number of each pair, a place of each number); `low` lies below `size`."""
    unique, at = np.unique(high * np.uint64(max(size, 1)) + low.astype(np.uint64), return_inverse=True)
    place = np.zeros(len(unique), np.int64)
    place[at] = np.arange(len(at))
    return at, place


def _whole(batches: Batches, order: int) -> tuple[list[np.ndarray], list[int], list[np.ndarray], list[np.ndarray]]:
    """The n-grams of a part, w first; the block and the named texts of each piece; (v, w, c) after frequent tokens."""
    pieces, of, texts, more = [], [], [], []
    for batch in batches:
        for block, data in zip(batch.column("block").to_pylist(), batch.column("data")):
            each = unpack(data.as_py())
            if block < 0:
                more.append(each)
            else:
                pieces.append(each[:order])
                of.append(block)
                texts.append(np.cumsum(each[order].astype(np.int64)))
    none = np.zeros(0, np.uint64)
    grams = [np.concatenate(x) for x in zip(*pieces)] if pieces else [none] * order
    return grams, of, texts, [np.concatenate(x) for x in zip(*more)] if more else [none] * 3


def _numbers(order: int, splits: np.ndarray, most: int) -> Callable[[Batches], Batches]:
    """Of a part learned from: (k, c, n), how many n-grams of order k were seen c times, up to most + 1; (v, w, c) of the pairs after frequent tokens."""

    def run(batches: Batches) -> Batches:
        grams, _, _, _ = _whole(batches, order)
        at, size, out = grams[0], int(grams[0].max()) + 1 if len(grams[0]) else 1, []
        for k in range(2, order + 1):
            at, place = _unique(grams[k - 1], at, size)
            size = len(place)
            c = np.bincount(at, minlength=size)
            if k == 2:
                hot = grams[1][place] < len(splits) - 1
                yield _noted(2, c[hot], grams[1][place][hot], grams[0][place][hot])
                c = c[~hot]
            r, n = np.unique(c[c <= most + 1], return_counts=True)
            out.append((k, r, n))
        for k, r, n in out:
            yield _noted(k, r, None, None, n)

    return run


def _noted(k: int, c: np.ndarray, v: np.ndarray | None, w: np.ndarray | None, n: np.ndarray | None = None) -> pa.RecordBatch:
    longs = [pa.nulls(len(c), pa.int64()) if x is None else pa.array(x.astype(np.int64)) for x in (c, n, v, w)]
    return pa.RecordBatch.from_arrays([pa.array(np.full(len(c), k, np.int32)), *longs], names=["k", "c", "n", "v", "w"])


def _chances(grams: list[np.ndarray], learned: np.ndarray, more: list[np.ndarray], tokens: Tokens, by: dict[int, list[float]], splits: np.ndarray) -> np.ndarray:
    """The probability of each n-gram of a part."""
    m, order = len(learned), len(grams)
    if order == 1:
        return tokens.chance(grams[0])
    # Pairs after frequent tokens count by what all parts have seen of them.
    grams = [np.append(grams[0], more[1]), np.append(grams[1], more[0]), *grams[2:]]
    seen = np.append(np.where(grams[1][:m] < len(splits) - 1, 0, learned), more[2].astype(np.int64))
    at, size = grams[0], int(grams[0].max()) + 1 if len(grams[0]) else 1
    chance, after = tokens.chance(grams[0]), np.zeros(len(at), np.int64)
    for k in range(2, order + 1):
        if k == 3:
            at, chance, after, seen = at[:m], chance[:m], after[:m], learned
        at, place = _unique(grams[k - 1], at, size)
        size = len(place)
        c = np.bincount(at, weights=seen, minlength=size)
        h, _ = _unique(grams[k - 1][place], after[place], int(after.max()) + 1 if len(after) else 1)
        lower, kept = chance[place], _discounted(c, by[k])
        total, held, low = (np.bincount(h, weights=x) for x in (c, kept, np.where(c > 0, lower, 0.0)))
        free = 1 - low
        # Where all n-grams are too frequent for a discount, something is left for other tokens.
        plus = total + ((held >= total * (1 - 1e-12)) & (free > 1e-9) & (total > 0))
        with np.errstate(divide="ignore", invalid="ignore"):
            alpha = np.where(total == 0, 1.0, np.where(free > 1e-9, (1 - held / plus) / free, 0.0))
            share = np.where((free <= 1e-9)[h], c, kept) / plus[h]
        chance, after = np.where(c > 0, share, alpha[h] * lower)[at], h[at]
    return chance[:m]


def _scored(order: int, tokens: Tokens, by: dict[int, list[float]], splits: np.ndarray) -> Callable[[Batches], Batches]:
    """Of a part (block, texts, sums): what it has of the log10 probability of each text."""

    def run(batches: Batches) -> Batches:
        grams, of, texts, more = _whole(batches, order)
        if not of:
            return
        named = np.concatenate(texts)
        chance = _chances(grams, named & 1, more, tokens, by, splits)
        with np.errstate(divide="ignore"):
            log = np.where(chance > 0, np.log10(np.maximum(chance, 0)), -math.inf)
        edge = 0
        for block, each in zip(of, texts):
            own = each >> 1
            first = np.flatnonzero(np.append(True, np.diff(own) != 0))
            sums = np.add.reduceat(log[edge : edge + len(own)], first)
            edge += len(own)
            yield pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), pa.array([own[first]], pa.list_(pa.int32())), pa.array([sums], pa.list_(pa.float64()))], names=["block", "texts", "sums"])

    return run


def _totals(batches: Batches) -> Batches:
    """Of the sums of all parts and the blocks' own rows (text_a, text_b, n_tokens, n_known, base_score, score) of each text."""
    sums, rows = {}, []
    for batch in batches:
        for i in range(batch.num_rows):
            block = batch.column("block")[i].as_py()
            if batch.column("texts")[i].is_valid:
                own, part = (batch.column(c)[i].values.to_numpy() for c in ("texts", "sums"))
                have = sums.get(block, np.zeros(0))
                if len(own) and own[-1] >= len(have):
                    have = sums[block] = np.append(have, np.zeros(own[-1] + 1 - len(have)))
                have[own] += part
            else:
                rows.append(batch.slice(i, 1))
    for row in rows:
        own = [row.column(c)[0].values for c in (*TEXT, "sizes", "n_known", "base")]
        total = sums.pop(row.column("block")[0].as_py())[: len(own[0])]
        yield pa.RecordBatch.from_arrays([*own, pa.array(total)], names=[*TEXT, "n_tokens", "n_known", "base_score", "score"])


def _numbered(tokens: DataFrame, scratch: Scratch) -> DataFrame:
    """(w, id) of (w, c): numbers without gaps, by falling count."""
    placed = written(tokens.orderBy(F.desc("c"), "w").select("w", F.monotonically_increasing_id().alias("at")), scratch, "numbers")
    task, within = F.shiftright("at", 33), F.col("at").bitwiseAND((1 << 33) - 1)
    begin, first = [], FIRST
    sizes = {r["task"]: r["n"] for r in placed.groupBy(task.alias("task")).agg(F.count("*").alias("n")).collect()}
    for i in range(max(sizes, default=0) + 1):
        begin.append(first)
        first += sizes.get(i, 0)
    return placed.select("w", (F.get(F.array(*map(F.lit, begin)), task.cast("int")) + within).cast("long").alias("id"))


def _discounts(coded: DataFrame, order: int, most: int, splits: np.ndarray, parts: int, scratch: Scratch) -> tuple[dict[int, list[float]], DataFrame]:
    """The discounts of the orders from 2 on, and (v, w, c) of the pairs after frequent tokens."""
    spread = coded.select("block", "data", "sizes", "train").mapInArrow(_spread(order, splits, parts, True), "part int, block long, data binary")
    noted = written(spread.repartitionById(parts, "part").mapInArrow(_numbers(order, splits, most), "k int, c long, n long, v long, w long"), scratch, "noted")
    more = written(noted.filter("v is not null").groupBy("v", "w").agg(F.sum("c").alias("c")), scratch, "frequent")
    seen: dict[int, dict[int, int]] = {k: {} for k in range(2, order + 1)}
    rows = noted.filter("v is null").select("k", "c", "n").unionAll(more.filter(F.col("c") <= most + 1).select(F.lit(2), "c", F.lit(1).cast("long")))
    for r in rows.groupBy("k", "c").agg(F.sum("n").alias("n")).collect():
        seen[r["k"]][r["c"]] = r["n"]
    return {k: discounts(seen[k], most) for k in seen}, more


def scores(documents: DataFrame, train: Column, order: int = ORDER, most: int = MOST, broadcast: int = BROADCAST_ROWS, block: int = BLOCK, part: int = PART) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score, score of every row; `train` marks what is learned from."""
    if order < 1:
        raise ValueError("order must be 1 or more")
    spark = documents.sparkSession
    docs = documents.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"), F.coalesce(train, F.lit(False)).alias("train"))
    named = (F.col("doc_id").isNull(), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    docs = docs.withColumns({"text_a": F.xxhash64(*named, "text"), "text_b": F.xxhash64(F.lit("text"), "text", *named)})
    scratch, early = Scratch(spark), Scratch(spark)
    with tidied(spark):
        made = written(docs.select(*TEXT, "train", "text").mapInArrow(_blocked(block), _BLOCKS), early, "blocks")
        counted = made.select(F.inline(F.arrays_zip("words", "counts"))).filter("counts > 0").groupBy(F.col("words").alias("w")).agg(F.sum("counts").alias("c"))
        counted = written(counted, early, "tokens")
        tokens = _tokens({r["c"]: r["n"] for r in counted.groupBy("c").agg(F.count("*").alias("n")).collect()}, most)
        numbers = _numbered(counted, early)
        numbers = F.broadcast(numbers) if tokens.v <= broadcast else numbers.hint("merge")
        asked = made.select("block", F.posexplode("words").alias("pos", "w")).join(numbers, "w").select("block", "pos", "id")
        both = made.select("block", "data", F.size("words").alias("n_words"), "sizes", "train", *TEXT)
        both = both.unionByName(asked.mapInArrow(_gathered, "block long, ids binary"), allowMissingColumns=True)
        coded = written(both.repartition("block").mapInArrow(_coded(tokens), _CODED), scratch, "coded")
        early.remove()
        every = lambda c: F.aggregate(c, F.lit(0).cast("long"), lambda a, x: a + x)
        whole, texts = coded.select(F.coalesce(F.sum(every("sizes")), F.lit(0)), F.coalesce(F.sum(F.size(F.filter("train", lambda x: x))), F.lit(0))).first()
        parts = max(1, -(-whole // part), min(PARTS, -(-whole // SMALL)))
        splits = _splits(tokens, texts, part, parts)
        by, more = _discounts(coded, order, most, splits, parts, scratch) if order > 1 else ({}, None)
        spread = coded.select("block", "data", "sizes", "train").mapInArrow(_spread(order, splits, parts, False), "part int, block long, data binary")
        if more is not None:
            spread = spread.unionAll(more.mapInArrow(_frequent(splits, parts), "part int, block long, data binary"))
        sums = spread.repartitionById(parts, "part").mapInArrow(_scored(order, tokens, by, splits), "block long, texts array<int>, sums array<double>")
        sums = written(sums, scratch, "sums")
        own = coded.select("block", *TEXT, "sizes", "n_known", "base")
        rows = own.unionByName(sums, allowMissingColumns=True).repartition("block")
        shape = "text_a long, text_b long, n_tokens long, n_known long, base_score double, score double"
        # Repeated rows have the same score.
        each = rows.mapInArrow(_totals, shape).groupBy(*TEXT).agg(*(F.max(c).alias(c) for c in ("n_tokens", "n_known", "base_score", "score")))
        summed = written(each, Scratch(spark), "scores")
        scratch.remove()
    return docs.select("doc_id", *TEXT).join(summed, TEXT).select("doc_id", "n_tokens", "n_known", F.lit(tokens.n).cast("long").alias("train_tokens"), "base_score", "score")
