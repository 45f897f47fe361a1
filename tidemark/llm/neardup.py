"""Near-duplicate documents: consistent weighted sampling over TF-IDF shingles.

A document's features are its runs of five words (all words of a shorter one). A
feature's weight is its count in the text times its idf, ln(1 + N / (df + N / 4)),
where df counts the documents that hold a feature of the same one of `buckets` hash
buckets, over the whole corpus. The quarter of N keeps what a large group of copies
shares from losing its weight; rare features all weigh nearly the same.

Improved consistent weighted sampling draws `bands * rows` samples: two texts agree on
one with the probability of their weighted Jaccard similarity. Texts that agree on all
rows of a band are compared, and linked if the weighted Jaccard similarity of their
whole texts is at least `least`. Bands of 3 and 12 of them find a pair at 0.8 with
probability 0.9998. Equal texts are one node from the start.

Only the idf table, of fixed size, passes through the driver. Texts that share a band
are shuffled once, next to the text they are compared with; a task holds one anchor.

Nulls: a null text equals no other and is its own class. Texts without words are linked
only to equal texts. Rows with a null doc_id belong to their class but name it only if
no other does. Repeated rows are equal texts. Empty tables give empty results. Other
columns are not read, or are kept as they are, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.links import linked
from tidemark.llm.tables import BROADCAST_IDS, of_ids, set_aside, stored
from tidemark.llm.text import PLAIN, blocks, mix, shingles, words

SHINGLE = 5
BUCKETS = 1 << 20
SEGMENT = 1 << 14
BANDS, ROWS = 12, 3
LEAST = 0.8
#: Members that are compared with one copy of their anchor's text.
MEMBERS = 64


def block_features(data: bytes, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, shingle hash, count) of the block, by row and hash, each once."""
    _, _, hashes, row = words(data, offsets, PLAIN)
    grams = shingles(hashes, row, SHINGLE)
    at = np.flatnonzero(grams)
    rows, found = [row[at]], [grams[at]]
    sizes = np.bincount(row, minlength=len(offsets) - 1)
    for n in range(1, SHINGLE):  # texts of fewer words: all of them
        short = np.flatnonzero(sizes == n)
        if len(short):
            grams = shingles(hashes, row, n)
            first = np.searchsorted(row, short)
            rows.append(short)
            found.append(grams[first])
    row, found = np.concatenate(rows), np.concatenate(found)
    order = np.lexsort((found, row))
    row, found = row[order], found[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (found[1:] != found[:-1])
    first = np.flatnonzero(new)
    return row[first], found[first], np.diff(np.append(first, len(row)))


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One table of counts for each task, in segments; segment -1 holds the number of rows."""
    counts, n = np.zeros(BUCKETS, np.uint32), 0
    for batch in batches:
        n += batch.num_rows
        for _, _, data, offsets in blocks(batch):
            _, found, _ = block_features(data, offsets)
            counts += np.bincount((found % np.uint64(BUCKETS)).astype(np.int64), minlength=BUCKETS).astype(np.uint32)
    if n:
        for s in range(BUCKETS // SEGMENT):
            yield pa.RecordBatch.from_arrays([pa.array([s], pa.int32()), pa.array([counts[s * SEGMENT : (s + 1) * SEGMENT].astype(np.int64).tobytes()], pa.binary())], names=["segment", "counts"])
        yield pa.RecordBatch.from_arrays([pa.array([-1], pa.int32()), pa.array([np.array([n], np.int64).tobytes()], pa.binary())], names=["segment", "counts"])


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for s, part in zip(batch.column("segment").to_pylist(), batch.column("counts")):
            own = np.frombuffer(part.as_buffer(), np.int64)
            total[s] = total[s] + own if s in total else own.copy()
    for s, counts in total.items():
        yield pa.RecordBatch.from_arrays([pa.array([s], pa.int32()), pa.array([counts.tobytes()], pa.binary())], names=["segment", "counts"])


def idf_table(documents: DataFrame) -> np.ndarray:
    """The idf of each bucket, from all documents; counts are added in two steps of tasks."""
    shape = "segment int, counts binary"
    parts = documents.select("text").mapInArrow(_frequencies, shape)
    some = parts.repartition(64, "segment", F.pmod(F.spark_partition_id(), F.lit(16))).mapInArrow(_sums, shape)
    counts, n = np.zeros(BUCKETS, np.int64), 0
    for row in some.repartition(16, "segment").mapInArrow(_sums, shape).collect():
        own = np.frombuffer(row["counts"], np.int64)
        if row["segment"] < 0:
            n = int(own[0])
        else:
            counts[row["segment"] * SEGMENT : (row["segment"] + 1) * SEGMENT] += own
    n = max(1, n)
    return np.log1p(n / (counts + n / 4)).astype(np.float32)


def samples(row: np.ndarray, found: np.ndarray, weight: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(rows that have features, their samples as an array of rows by `size`)."""
    first = np.flatnonzero(np.concatenate(([True], row[1:] != row[:-1]))) if len(row) else np.zeros(0, np.int64)
    out = np.zeros((len(first), size), np.uint64)
    log_weight = np.log(weight.astype(np.float32))
    place = np.arange(len(row), dtype=np.uint64)
    low = np.float32(1 / (1 << 22))
    for j in range(size):
        bits = mix(found + np.uint64(0x9E3779B97F4A7C15 * (j + 1) % (1 << 64)))
        more = (bits ^ (bits >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
        more ^= more >> np.uint64(29)
        u1 = ((bits >> np.uint64(43)).astype(np.float32) + np.float32(0.5)) * np.float32(2 * low)
        u2 = ((bits >> np.uint64(22) & np.uint64(0x1FFFFF)).astype(np.float32) + np.float32(0.5)) * np.float32(2 * low)
        beta = (bits & np.uint64(0x3FFFFF)).astype(np.float32) * low
        u3 = ((more >> np.uint64(43)).astype(np.float32) + np.float32(0.5)) * np.float32(2 * low)
        u4 = ((more >> np.uint64(22) & np.uint64(0x1FFFFF)).astype(np.float32) + np.float32(0.5)) * np.float32(2 * low)
        r = -np.log(u1 * u2)
        step = np.floor(log_weight / r + beta)
        score = np.log(-np.log(u3 * u4)) - r * (step - beta + np.float32(1))
        # As unsigned integers in the order of the scores, with the place below.
        raw = score.view(np.uint32)
        raw = np.where(raw >> 31 != 0, ~raw, raw | np.uint32(0x80000000))
        best = np.minimum.reduceat((raw.astype(np.uint64) << np.uint64(32)) | place, first) & np.uint64(0xFFFFFFFF) if len(first) else first
        best = best.astype(np.int64)
        out[:, j] = mix(found[best] + step[best].astype(np.int64).view(np.uint64) * np.uint64(0xD6E8FEB86659FD93) + np.uint64(j))
    return row[first], out


def _sketches(idf: np.ndarray, bands: int, rows: int):
    """For mapInArrow over (doc_id, node, text): the hash of each band, none for a text without words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, data, offsets in blocks(batch):
                row, found, count = block_features(data, offsets)
                weight = count * idf[(found % np.uint64(BUCKETS)).astype(np.int64)]
                held, drawn = samples(row, found, weight, bands * rows)
                keys = np.zeros((len(held), bands), np.uint64)
                for b in range(bands):
                    key = np.full(len(held), b + 1, np.uint64)
                    for j in range(rows):
                        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + drawn[:, b * rows + j])
                    keys[:, b] = key
                edges = np.zeros(high - low + 1, np.int32)
                edges[held + 1] = bands
                lists = pa.ListArray.from_arrays(pa.array(np.cumsum(edges).astype(np.int32)), pa.array(keys.reshape(-1).view(np.int64)))
                part = batch.slice(low, high - low)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("node"), lists], names=["doc_id", "node", "bands"])

    return run


def _weighted(idf: np.ndarray):
    """For mapInArrow over (key, text): (node, feature, weight) of every feature."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column("key")
            for low, _, data, offsets in blocks(batch):
                row, found, count = block_features(data, offsets)
                weight = count * idf[(found % np.uint64(BUCKETS)).astype(np.int64)].astype(np.float64)
                yield pa.RecordBatch.from_arrays([keys.take(pa.array(row + low)), pa.array(found.view(np.int64)), pa.array(weight)], names=["node", "feature", "weight"])

    return run


def _similar(idf: np.ndarray, least: float):
    """For mapInArrow over (anchor, part, node, text) with the anchor's own row (node null) first in each part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, base, base_weight = None, None, None
        for batch in batches:
            anchors, nodes = batch.column("anchor").to_pylist(), batch.column("node").to_pylist()
            kept = []
            for low, high, data, offsets in blocks(batch):
                row, found, count = block_features(data, offsets)
                weight = count * idf[(found % np.uint64(BUCKETS)).astype(np.int64)].astype(np.float64)
                bounds = np.searchsorted(row, np.arange(high - low + 1))
                for i in range(high - low):
                    own, own_weight = found[bounds[i] : bounds[i + 1]], weight[bounds[i] : bounds[i + 1]]
                    if nodes[low + i] is None:
                        of, base, base_weight = anchors[low + i], own, own_weight
                        continue
                    if of != anchors[low + i]:
                        continue  # no text of the anchor
                    at = np.searchsorted(base, own)
                    at[at == len(base)] = 0
                    same = base[at] == own if len(base) else np.zeros(len(own), bool)
                    shared = np.minimum(own_weight[same], base_weight[at[same]]).sum()
                    if shared >= least * (own_weight.sum() + base_weight.sum() - shared) and shared > 0:
                        kept.append((nodes[low + i], of))
            yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in kept], pa.binary()), pa.array([k[1] for k in kept], pa.binary())], names=["node", "anchor"])

    return run


def _verifier(texts: DataFrame, idf: np.ndarray, least: float):
    """Compares the texts of pairs; an anchor's text goes to one place for every `MEMBERS` members."""

    def verify(pairs: DataFrame) -> DataFrame:
        pairs = stored(pairs, "pairs")
        sizes = pairs.groupBy("anchor").agg(F.count("*").alias("n")).select("anchor", F.ceil(F.col("n") / MEMBERS).cast("int").alias("parts"))
        dealt = pairs.join(sizes, "anchor").select("anchor", F.pmod(F.xxhash64("node"), "parts").cast("int").alias("part"), "node")
        own = sizes.select("anchor", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
        wanted = dealt.select("anchor", "part", "node", F.col("node").alias("of")).unionAll(own.select("anchor", "part", F.lit(None).cast("binary").alias("node"), F.col("anchor").alias("of")))
        held = wanted.join(texts, wanted["of"] == texts["key"]).select("anchor", "part", "node", "text")
        placed = held.repartition("anchor", "part").sortWithinPartitions("anchor", "part", F.col("node").asc_nulls_first())
        return placed.mapInArrow(_similar(idf, least), "node binary, anchor binary")

    return verify


def near_duplicates(documents: DataFrame, least: float = LEAST, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """A written table (doc_id, node, label), a row per document: node is the text's, label the class's.

    `node` is the md5 of the text, NULL for a null text.
    """
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.unhex(F.md5("text")).alias("node"), "text")
    idf = idf_table(docs)
    sketched = stored(docs.mapInArrow(_sketches(idf, bands, rows), "doc_id long, node binary, bands array<long>"), "sketches")
    nodes = sketched.filter("node is not null").groupBy("node").agg(F.count("*").alias("copies"), F.first("bands").alias("bands"))
    placed = nodes.select("node", "copies", F.explode("bands").alias("bucket"))
    shared = placed.groupBy("bucket").agg(F.min("node").alias("low"), F.max("node").alias("high")).filter("low <> high").select("bucket")
    members = stored(placed.join(shared, "bucket", "left_semi").select("bucket", "node", "copies").distinct(), "members")
    # The texts of all that may be compared, once each.
    needed = stored(members.select("node").distinct(), "needed")
    texts = of_ids(docs.select("node", "text"), needed, "node", BROADCAST_IDS // 2).groupBy("node").agg(F.first("text").alias("text"))
    texts = stored(texts.select(F.col("node").alias("key"), "text"), "texts")

    def features(unsettled: DataFrame) -> DataFrame:
        held = texts.join(unsettled.withColumnRenamed("node", "key"), "key", "left_semi")
        return stored(held.mapInArrow(_weighted(idf), "node binary, feature long, weight double"), "features")

    labels = linked(members, _verifier(texts, idf, least), features, least)
    labelled = sketched.select("doc_id", "node").join(labels, "node", "left")
    return stored(labelled.select("doc_id", "node", F.coalesce("label", "node").alias("label")), "classes")


def classes(documents: DataFrame, **options) -> DataFrame:
    """doc_id, class_id and class_size of every document; class_id is the class's smallest doc_id."""
    found = near_duplicates(documents, **options)
    sizes = found.filter("label is not null").groupBy("label").agg(F.min("doc_id").alias("class_id"), F.count("*").alias("class_size"))
    alone = found.join(sizes, "label", "left")
    return alone.select("doc_id", F.coalesce("class_id", "doc_id").alias("class_id"), F.coalesce("class_size", F.lit(1)).cast("long").alias("class_size"))


def without_copies(documents: DataFrame, **options) -> DataFrame:
    """The documents with one of each class: that of the smallest doc_id, then of the smallest text hash."""
    found = near_duplicates(documents, **options).filter("label is not null")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "node"))
    kept = stored(found.groupBy("label").agg(first.alias("k")).select(F.col("k.doc_id").alias("_id"), F.col("k.node").alias("_node")), "kept")
    held, own = set_aside(documents, "_text_node")
    marked = held.withColumn("_text_node", F.unhex(F.md5("text")))
    # A class's first may be there in several equal rows; these are told apart only where there are any.
    again = found.join(kept, found["doc_id"].eqNullSafe(kept["_id"]) & (found["node"] == kept["_node"])).groupBy("_id", "_node").count().filter("count > 1")
    same = marked["doc_id"].eqNullSafe(kept["_id"]) & (marked["_text_node"] == kept["_node"])
    out = marked.join(kept, same, "left_semi")
    if not again.isEmpty():
        out = out.dropDuplicates(["doc_id", "_text_node"])
    nulls = marked.filter(marked["_text_node"].isNull())
    return out.unionAll(nulls).drop("_text_node").withColumnsRenamed(own)
