"""SimHash near-duplicates by covering locality-sensitive hashing: no pair within the radius is missed.

A text's fingerprint has a bit for each bit of the 64-bit hashes of its shingles, set where
more than half of them have it set. Two fingerprints link at `radius` differing bits or
fewer; a component is what links reach.

Structured masks: every bit position i has a vector phi(i) of radius + 1 bits, not zero. Table
v, for each v but zero, looks at the positions with an odd phi(i) & v. Any `radius` positions
leave some v orthogonal to all their vectors, so a pair within the radius agrees on all that
table v looks at: 2 ** (radius + 1) - 1 tables meet all links, with certainty.

Equal fingerprints are one node. A table's bucket of up to `SMALL` nodes is compared whole
in one task, which returns a spanning forest of its links. A larger bucket is never compared whole:

    1. each node is compared with `HUBS` of the bucket's nodes, and components are found;
    2. a bucket of one component is done. Of one with up to `SMALL` nodes outside its
       largest component, these are compared with all its nodes;
    3. any other is dealt out again, by the same masks with other vectors, over the bits
       its mask left out. That halves the free bits each time and again meets every link.

A bucket with f free bits has 2 ** f nodes at most, so this ends, and no step makes more than
max(SMALL, HUBS, tables) rows of a row. Every step is a join or an aggregate that combines
before its shuffle; tables are written, the driver sees only counts.

Nulls: a null text is empty; a text without words has fingerprint zero, linked like any
other. A null doc_id is never the smallest; a component of nothing else has a null
component_id. Repeated rows are each returned. Long texts are worked on whole, in
stretches of `STRETCH` shingles. Exactly half of the hashes (a tie) leaves a bit zero. Empty tables give
no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.links import components
from tidemark.llm.tables import stored
from tidemark.llm.text import LOWER

WORDS, SEED, RADIUS = 4, 42, 4
SMALL, HUBS = 64, 8
STRETCH = 1 << 15


def fingerprint(text: bytes, k: int = WORDS, seed: int = SEED) -> int:
    """The fingerprint of a text with A-Z lowered."""
    words = text.split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.append(0, ends[:-1] + 1)
    n = max(1, len(words) - k + 1)
    starts, ends = starts[:n], ends[min(k, len(words)) - 1 :]
    ones = np.zeros(64, np.int64)
    for at in range(0, n, STRETCH):
        cut = zip(starts[at : at + STRETCH].tolist(), ends[at : at + STRETCH].tolist())
        hashes = np.array([xxhash.xxh64_intdigest(joined[a:b], seed) for a, b in cut], "<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def _fingerprints(k: int, seed: int):
    """For mapInArrow over (doc_id, text): (doc_id, node)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").cast(pa.large_binary())
            made = np.fromiter((fingerprint((t.as_py() or b"").translate(LOWER), k, seed) for t in texts), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(made.view(np.int64))], names=["doc_id", "node"])

    return run


def fingerprints(documents: DataFrame, k: int = WORDS, seed: int = SEED) -> DataFrame:
    """(doc_id, node): the fingerprint as a signed 64-bit integer."""
    return documents.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(_fingerprints(k, seed), f"doc_id {documents.schema['doc_id'].dataType.simpleString()}, node long")


def masks(radius: int = RADIUS, level: int = 0) -> list[int]:
    """The bits that each table looks at. The vectors are dealt out to the 64 positions evenly, in another order at each level."""
    size = 1 << (radius + 1)
    phi = np.random.default_rng([radius, level]).permutation(np.arange(64) % (size - 1) + 1)
    return [sum(1 << i for i in range(64) if int(phi[i] & v).bit_count() & 1) for v in range(1, size)]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _dealt(nodes: DataFrame, radius: int, level: int) -> DataFrame:
    """(path, mask, part, node): each node in each table; `mask` are the bits a table looks at so far, `path` names the tables and buckets it came by.

    Two paths of one hash would only put nodes together that need not be compared.
    """
    tables = F.array(*[F.lit(_signed(m)) for m in masks(radius, level)])
    each = nodes.select("path", "mask", "node", F.posexplode(tables).alias("v", "more"))
    mask = F.col("mask").bitwiseOR(F.col("more"))
    return each.select(F.xxhash64("path", "v").alias("path"), mask.alias("mask"), F.col("node").bitwiseAND(mask).alias("part"), "node")


def _near(a: str, b: str, radius: int) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b))) <= radius


def forest(nodes: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (a, b) that join what links of these nodes reach; one fewer than nodes at most."""
    values = nodes.view(np.uint64)
    near = np.bitwise_count(values[:, None] ^ values[None, :]) <= radius
    label = np.arange(len(nodes))
    while True:
        least = np.where(near, label[None, :], len(nodes)).min(axis=1)
        least = least[least]
        if np.array_equal(least, label):
            break
        label = least
    other = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[other], nodes[label[other]]


def _forests(radius: int):
    """For mapInArrow over (nodes): (a, b)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("nodes")
            edges, flat = lists.offsets.to_numpy(), lists.values.to_numpy()
            a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            # Most buckets are pairs: all at once.
            low, size = edges[:-1], np.diff(edges)
            two = low[size == 2]
            x, y = flat[two], flat[two + 1]
            alike = np.bitwise_count((x ^ y).view(np.uint64)) <= radius
            a.append(x[alike])
            b.append(y[alike])
            for i in np.flatnonzero(size > 2):
                left, right = forest(flat[edges[i] : edges[i + 1]], radius)
                a.append(left)
                b.append(right)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], names=["a", "b"])

    return run


def _joined(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionAll(part)
    return out.distinct()


def labelled(nodes: DataFrame, radius: int = RADIUS, small: int = SMALL, hubs: int = HUBS) -> DataFrame:
    """(node, label) of every distinct node that has a link: the smallest node it reaches. `nodes` is a written table (node) without repeats."""
    bucket = ["path", "part"]
    nodes = nodes.select(F.lit(0).cast("long").alias("path"), F.lit(0).cast("long").alias("mask"), "node")
    labels, level = None, 0
    while True:
        dealt = _dealt(nodes, radius, level)
        if labels is not None:
            # Only buckets of more than one component are left to look at.
            dealt = _named(dealt, labels)
            counted = dealt.groupBy(*bucket).agg(F.count("*").alias("size"), F.min("label").alias("low"), F.max("label").alias("high")).filter("low <> high")
        else:
            counted = dealt.groupBy(*bucket).agg(F.count("*").alias("size")).filter("size > 1")
        met = stored(dealt.join(counted.select(*bucket, "size"), bucket).select("path", "mask", "part", "node", "size"), "met")
        few, many = met.filter(F.col("size") <= small), met.filter(F.col("size") > small)
        links = few.groupBy(*bucket).agg(F.collect_list("node").alias("nodes")).select("nodes").mapInArrow(_forests(radius), "a long, b long")
        chosen = many.groupBy(*bucket, F.pmod(F.xxhash64("node", F.lit(level)), F.lit(hubs)).alias("draw")).agg(F.min("node").alias("hub")).drop("draw")
        close = many.join(chosen, bucket).filter(F.col("node") != F.col("hub")).filter(_near("node", "hub", radius)).select(F.col("node").alias("a"), F.col("hub").alias("b"))
        labels = components(stored(_joined([links, close, *_known(labels)]), "links"))
        # What is left of the large buckets.
        known = _named(many, labels)
        shares = known.groupBy(*bucket, "label").agg(F.count("*").alias("n"))
        shares = shares.groupBy(*bucket).agg(F.max_by("label", F.struct("n", "label")).alias("major"), F.max("n").alias("n"))
        left = stored(known.join(shares, bucket).filter("n < size").select("path", "mask", "part", "node", "size", "label", "major", "n"), "left")
        if left.isEmpty():
            return labels
        minor = left.filter((F.col("size") - F.col("n") <= small) & (F.col("label") != F.col("major"))).select(*bucket, F.col("node").alias("other"), F.col("label").alias("other_label"))
        ends = left.join(minor, bucket).filter("label <> other_label").filter(_near("node", "other", radius)).select(F.col("node").alias("a"), F.col("other").alias("b"))
        labels = components(stored(_joined([ends, *_known(labels)]), "links"))
        nodes, level = left.filter(F.col("size") - F.col("n") > small).select(F.xxhash64("path", "part").alias("path"), "mask", "node"), level + 1
        if nodes.isEmpty():
            return labels


def _known(labels: DataFrame | None) -> list[DataFrame]:
    """Of the links found before, one a node."""
    return [] if labels is None else [labels.filter("node <> label").select(F.col("node").alias("a"), F.col("label").alias("b"))]


def _named(members: DataFrame, labels: DataFrame) -> DataFrame:
    return members.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))


def near_duplicates(documents: DataFrame, k: int = WORDS, radius: int = RADIUS, **options) -> DataFrame:
    """doc_id, fingerprint, component_id of every document."""
    docs = stored(fingerprints(documents, k), "fingerprints")
    nodes = stored(docs.groupBy("node").agg(F.min("doc_id").alias("least")), "nodes")
    known = _named(nodes, labelled(nodes.select("node"), radius, **options))
    least = known.groupBy("label").agg(F.min("least").alias("component_id"))
    named = known.join(least, "label").select("node", "component_id")
    return docs.join(named, "node").select("doc_id", F.lower(F.lpad(F.hex("node"), 16, "0")).alias("fingerprint"), "component_id")
