"""Quality classifier: supervised subword embeddings, trained by numpy's own gradient steps.

Words, pairs of neighbouring words (a word that follows itself is one pair, whatever the
word) and runs of 3 and 4 characters, which may begin or end at white space but not hold
it inside, are hashed into `buckets`. Each bucket has a learned vector; a document is the
average of its n-grams' vectors, and a softmax over a linear layer gives its classes.
Both layers are learned by stochastic gradient descent, one document a step.

Since average and linear layer commute, a fitted model scores with one number per
bucket, the vector times the difference of the two classes' weights. That table has
`buckets` floats whatever the corpus, and is all that tasks get.

The fit takes at most `most_rows` labelled rows with `most_bytes` of text together, those
of the smallest hash of doc_id, each with its whole text. It runs in one task, which makes
the features, takes all steps and returns the weights; the driver gets `buckets` floats. A
task that is lost does the same again. Everything else runs over all rows and whole texts.

Nulls: a null or empty text has no n-gram and gets the score of the bias. A null label is
no label; a doc_id with both labels is learned from twice. Without any labelled row every
score is 0.5. A score equal to the threshold counts as 1. A labelled text longer than
`most_bytes` is not learned from, but scored whole like any other. Repeated rows are each
scored. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.text import PLAIN, blocks, mix, words

#: A bounded sample: so many labelled rows at most are learned from, and so many bytes of their texts.
MOST_ROWS, MOST_BYTES = 3000, 16 << 20
BUCKETS = 1 << 18
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
_SAME = np.uint64(0x5851F42D4C957F2D)


@dataclass(frozen=True)
class Model:
    """What a bucket adds to the log odds of class 1, and the bias."""

    weights: np.ndarray
    bias: float


def ngrams(data: bytes, offsets: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, bucket) of every n-gram of the block, rows in order within each kind."""
    size = np.uint64(buckets)
    _, _, hashes, row = words(data, offsets, PLAIN)
    pair = np.flatnonzero(row[1:] == row[:-1])
    left, right = hashes[pair], hashes[pair + 1]
    pairs = np.where(left == right, _SAME, mix(left * _A + right))
    codes = np.frombuffer(data.decode("utf-8", "replace").encode("utf-32-le"), np.uint32).astype(np.uint64)
    raw = np.frombuffer(data, np.uint8)
    place = np.concatenate(([0], np.cumsum((raw & 0xC0) != 0x80)))[offsets]
    blank = (codes == 32) | ((codes >= 9) & (codes <= 13))
    codes = np.where(blank, np.uint64(32), codes)
    owner = np.repeat(np.arange(len(place) - 1), np.diff(place))
    rows, found = [row, row[pair]], [hashes % size, pairs % size]
    for n in (3, 4):
        last = len(codes) - n + 1
        if last < 1:
            continue
        good = owner[:last] == owner[n - 1 :]
        total = np.full(last, n, np.uint64)
        for j in range(n):
            if 0 < j < n - 1:
                good &= ~blank[j : last + j]
            total = total * _B + codes[j : last + j]
        at = np.flatnonzero(good)
        rows.append(owner[at])
        found.append(mix(total[at]) % size)
    return np.concatenate(rows), np.concatenate(found).astype(np.int64)


def _fitted(buckets: int):
    """For mapInArrow over the sample (doc_id, quality, text) in one task: (weights, bias)."""

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = []
        for batch in batches:
            ids, labels = batch.column("doc_id").to_pylist(), batch.column("quality").to_pylist()
            for low, high, data, offsets in blocks(batch):
                row, found = ngrams(data, offsets, buckets)
                key, counts = np.unique(row * buckets + found, return_counts=True)
                edges = np.searchsorted(key, np.arange(high - low + 1) * buckets)
                for i, (a, b) in enumerate(zip(edges[:-1], edges[1:])):
                    rows.append((ids[low + i], labels[low + i], (key[a:b] % buckets).astype(np.int32), counts[a:b].astype(np.float32)))
        if rows:
            model = train([r[1:] for r in sorted(rows, key=lambda r: r[:2])], buckets)
            yield pa.RecordBatch.from_arrays([pa.array([model.weights.tobytes()]), pa.array([model.bias])], names=["weights", "bias"])

    return fit


def train(rows: list[tuple[int, np.ndarray, np.ndarray]], buckets: int, dims: int = 8, epochs: int = 12, rate: float = 1.0) -> Model:
    """Gradient steps over (label, buckets, counts), in an order drawn anew each epoch from a fixed seed."""
    if not rows:
        return Model(np.zeros(buckets, np.float32), 0.0)
    draw = np.random.default_rng(7)
    vectors = draw.uniform(-1 / dims, 1 / dims, (buckets, dims)).astype(np.float32)
    layer, bias = np.zeros((2, dims), np.float32), np.zeros(2, np.float32)
    step, steps = 0, epochs * len(rows)
    for _ in range(epochs):
        for i in draw.permutation(len(rows)):
            label, found, counts = rows[i]
            pace = rate * (1 - step / steps)
            step += 1
            share = counts / max(1.0, float(counts.sum()))
            hidden = share @ vectors[found]
            logits = layer @ hidden + bias
            odds = np.exp(logits - logits.max())
            error = odds / odds.sum()
            error[label] -= 1
            back = error @ layer
            layer -= pace * np.outer(error, hidden)
            bias -= pace * 0.1 * error
            # A document's gradient is spread over its n-grams; as in common practice each gets it whole.
            vectors[found] -= (pace * np.minimum(1.0, share * len(found)))[:, None] * back[None, :]
    return Model((vectors @ (layer[1] - layer[0])).astype(np.float32), float(bias[1] - bias[0]))


def fit(documents: DataFrame, labels: DataFrame, most_rows: int = MOST_ROWS, most_bytes: int = MOST_BYTES, buckets: int = BUCKETS) -> Model:
    """Learn from labels (doc_id, quality). The caller leaves out what is held out."""
    named = labels.filter("doc_id is not null and quality in (0, 1)").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
    chosen = named.distinct().orderBy(F.xxhash64("doc_id"), "doc_id", "quality").limit(most_rows)
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(chosen), "doc_id")
    # A repeated doc_id could bring more rows than labels.
    order = [F.xxhash64("doc_id"), "doc_id", "quality", "text"]
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    texts = texts.filter(size <= most_bytes).orderBy(*order).limit(most_rows)
    # So few rows may meet in one task.
    so_far = F.sum(size).over(Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    sample = texts.withColumn("so_far", so_far).filter(F.col("so_far") <= most_bytes).select("doc_id", "quality", "text")
    found = sample.mapInArrow(_fitted(buckets), "weights binary, bias double").first()
    return Model(np.frombuffer(found["weights"], np.float32), found["bias"]) if found else train([], buckets)


def _scores(model: Model):
    """For mapInArrow over (doc_id, text) and other columns, which stay."""
    weights, bias = model.weights.astype(np.float64), model.bias

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = np.zeros(batch.num_rows)
            for low, high, data, offsets in blocks(batch):
                row, found = ngrams(data, offsets, len(weights))
                total = np.bincount(row, weights[found], high - low)
                out[low:high] = total / np.maximum(1, np.bincount(row, minlength=high - low))
            chance = 1 / (1 + np.exp(-np.clip(out + bias, -500, 500)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(chance)], names=[*batch.schema.names, "score"])

    return score


def score(rows: DataFrame, model: Model) -> DataFrame:
    """The rows with `score`, the probability of class 1, beside `text`; it replaces a column of that name."""
    rows = rows.drop("score")
    schema = rows.withColumn("score", F.lit(0.0)).schema
    return rows.mapInArrow(_scores(model), schema)


def held_out(share: int = 4, remainder: int = 2):
    """crc32 of doc_id as text; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % share == remainder


def quality_scores(documents: DataFrame, labels: DataFrame, threshold: float = 0.7, **options) -> DataFrame:
    """doc_id, held_out, score, predicted for every document; held-out labels are not learned from."""
    model = fit(documents, labels.filter(~held_out()), **options)
    scored = score(documents.select("doc_id", held_out().alias("held_out"), "text"), model)
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
