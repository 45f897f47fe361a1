"""The Katz model against a recursion over dictionaries."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark import session
from tidemark.llm import katz
from tidemark.llm.quality import held_out
from tidemark.llm.text import pack, unpack

SF = "/root/testdata/sf0.001"


def tokens(text):
    low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    return [w for w in re.split("[ \t-\r]+", low) if w] + [None]


class Brute:
    """Counts, discounts and shares of every order, each computed from its definition."""

    def __init__(self, texts, order, most=katz.MOST):
        self.order, self.most = order, most
        self.counts = {k: Counter(g for t in texts for g in self.grams(t, k)) for k in range(1, order + 1)}
        self.by = {k: self.discounts(Counter(c.values())) for k, c in self.counts.items()}
        self.total = sum(self.counts[1].values())
        self.after = {}
        for k in range(2, order + 1):
            for g in self.counts[k]:
                self.after.setdefault(g[:-1], []).append(g[-1])
        self.unseen = max(0.0, 1 - sum(self.kept(1, (w,)) / self.total for (w,) in self.counts[1])) if self.total else 1.0
        self.known = {}

    def grams(self, text, k):
        padded = ["<s>"] * (k - 1) + tokens(text)
        return [tuple(padded[i : i + k]) for i in range(len(padded) - k + 1)]

    def discounts(self, n):
        out, x = [], (self.most + 1) * n[self.most + 1] / n[1] if n[1] else 1.0
        for r in range(1, self.most + 1):
            d = ((r + 1) * n[r + 1] / n[r] / r - x) / (1 - x) if n[r] and x < 1 else 0
            out.append(d if 0 < d < 1 else (r - 0.5) / r)
        return out

    def kept(self, k, gram):
        c = self.counts[k][gram]
        return c * self.by[k][c - 1] if c <= self.most else c

    def history(self, h):
        """(total, alpha, plain)"""
        if h not in self.known:
            k = len(h) + 1
            total = sum(self.counts[k][(*h, w)] for w in self.after[h])
            kept = sum(self.kept(k, (*h, w)) for w in self.after[h])
            free = 1 - sum(self.chance((*h[1:], w)) for w in self.after[h])
            if free <= 1e-9:
                self.known[h] = (total, 0.0, True)
            else:
                total += kept >= total * (1 - 1e-12)
                self.known[h] = (total, (1 - kept / total) / free, False)
        return self.known[h]

    def chance(self, gram):
        k = len(gram)
        if k == 1:
            return self.kept(1, gram) / self.total if gram in self.counts[1] else self.unseen
        if gram[:-1] not in self.after:
            return self.chance(gram[1:])
        total, alpha, plain = self.history(gram[:-1])
        if gram in self.counts[k]:
            return (self.counts[k][gram] if plain else self.kept(k, gram)) / total
        return alpha * self.chance(gram[1:])

    def score(self, text):
        p = [self.chance(g) for g in self.grams(text, self.order)]
        return sum(map(math.log10, p)) if all(p) else -math.inf


def small(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, learned boolean")


def toy():
    draw = random.Random(4)
    made = [(i, " ".join(draw.choices("aBcdefgh", weights=[40, 20, 10, 8, 4, 2, 1, 1], k=draw.randint(0, 40))), i % 3 > 0) for i in range(60)]
    return [*made, (100, "unheard of  words", False), (101, None, True), (102, "", False), (None, "a b", True), (None, "a b", True), (-1, "a b", False), (103, "zz zz zz", True)]


@pytest.mark.parametrize("order", [1, 2, 3, 4])
def test_scores_equal_brute_force(spark, order):
    rows = toy()
    model = Brute([t for _, t, learned in rows if learned], order)
    want = sorted((repr(i), t or "", model.score(t)) for i, t, _ in rows)
    table = small(spark, rows)
    got = katz.scores(table.withColumn("id", F.struct("doc_id", "text")).drop("doc_id").withColumnRenamed("id", "doc_id"), F.col("learned"), order).collect()
    got = sorted((repr(r["doc_id"]["doc_id"]), r["doc_id"]["text"] or "", r["score"]) for r in got)
    assert [g[:2] for g in got] == [w[:2] for w in want]
    assert [g[2] for g in got] == pytest.approx([w[2] for w in want], rel=1e-9)


@pytest.mark.parametrize("order", [2, 3])
def test_documents_equal_brute_force(spark, order):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = docs.select("doc_id", "text", held_out(5, 1).alias("held")).collect()
    learned = [r["text"] for r in rows if not r["held"]]
    model, seen = Brute(learned, order), Counter(w for t in learned for w in tokens(t))
    n, v = sum(seen.values()), len(seen)
    texts = {r["doc_id"]: r["text"] for r in rows}
    # The tables joined by a shuffle give the same as those broadcast.
    for broadcast in (katz.BROADCAST_ROWS, 0) if order == 3 else (katz.BROADCAST_ROWS,):
        got = katz.scores(docs, ~held_out(5, 1), order, broadcast=broadcast).collect()
        assert len(got) == len(rows)
        for r in got:
            words = tokens(texts[r["doc_id"]])
            base = sum(math.log10((seen[w] + 0.5) / (n + 0.5 * (v + 1))) for w in words)
            assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(words), sum(seen[w] > 0 for w in words), n)
            assert r["base_score"] == pytest.approx(base, rel=1e-9)
            assert r["score"] == pytest.approx(model.score(texts[r["doc_id"]]), rel=1e-9)


@pytest.mark.parametrize("order", [2, 3])
def test_probabilities_add_up_after_every_history(order):
    rows = toy()
    model = Brute([t for _, t, learned in rows if learned], order)
    for h in model.after:
        seen = sum(model.chance((*h, *w)) for w in model.counts[1])
        assert seen + model.chance((*h, "never")) == pytest.approx(1, abs=1e-9)


def test_beats_the_base_on_held_out_text(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    held = docs.select("doc_id").filter(held_out(5, 1))
    out = katz.scores(docs, ~held_out(5, 1)).join(held, "doc_id").agg(F.sum("score"), F.sum("base_score")).first()
    assert out[0] > out[1]


def test_a_text_longer_than_a_block(spark):
    long = " ".join(f"w{i % 5000}" for i in range(250_000))
    rows = [(1, long, True), (2, "w1 w2 w3", False), (3, long + " tail", False)]
    assert len(long) > 1 << 20
    model = Brute([long], 3)
    got = {r["doc_id"]: r["score"] for r in katz.scores(small(spark, rows), F.col("learned"), 3).collect()}
    assert got == pytest.approx({i: model.score(t) for i, t, _ in rows}, rel=1e-9)


def test_without_training_rows(spark):
    got = katz.scores(small(spark, [(1, "a b", False), (2, None, None)]), F.col("learned")).collect()
    assert {(r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"], r["score"]) for r in got} == {(1, 3, 0, 0, 0.0), (2, 1, 0, 0, 0.0)}


@pytest.mark.parametrize("order", [2, 3, 4])
def test_frequent_tokens_dealt_among_parts(spark, order):
    # Blocks of a few texts and parts of 60 tokens: most tokens of the toy are then frequent.
    rows = toy()
    model = Brute([t for _, t, learned in rows if learned], order)
    got = katz.scores(small(spark, rows), F.col("learned"), order, block=300, part=60).collect()
    want = sorted((repr(i), model.score(t)) for i, t, _ in rows)
    got = sorted((repr(r["doc_id"]), r["score"]) for r in got)
    assert [g[0] for g in got] == [w[0] for w in want]
    assert [g[1] for g in got] == pytest.approx([w[1] for w in want], rel=1e-9)


def test_takes_little_disk(spark, tmp_path, monkeypatch):
    # Texts whose n-grams hardly repeat: rows of numbers took several times their bytes, and stayed.
    draw = random.Random(5)
    rows = [(i, " ".join(str(draw.randrange(5000)) for _ in range(500)), i % 5 > 0) for i in range(200)]
    monkeypatch.setattr(session, "shared_dir", lambda spark: str(tmp_path))
    assert katz.scores(small(spark, rows), F.col("learned")).count() == len(rows)
    left = sum(p.stat().st_size for p in tmp_path.rglob("*") if p.is_file())
    assert left < 0.1 * sum(len(t) for _, t, _ in rows)


def test_packed_columns_come_back():
    draw = np.random.default_rng(3)
    columns = [draw.integers(0, 1 << bits, 1000, dtype=np.uint64) for bits in (1, 8, 21, 63)]
    assert all((a == b).all() for a, b in zip(unpack(pack(*columns)), columns))
    assert [len(c) for c in unpack(pack(np.zeros(0, np.int64), np.zeros(0, np.int64)))] == [0, 0]
    # Less than three bytes for a number of 21 bits.
    assert len(pack(columns[2])) < 3.1 * 1000
