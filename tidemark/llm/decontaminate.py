"""Benchmark decontamination by winnowing.

A document shares a window with a benchmark item when it holds `span` consecutive
words of it (all words of a shorter item). Of every `span - k + 1` neighbouring k-grams
the one with the smallest hash is kept, so two texts that share `span` words keep a
k-gram in common. Shorter items use one k-gram as long as the item, all kept.
Fingerprints are joined, each hit is extended to the windows around it, and these are
joined with the benchmark's windows as text, so no hash decides a result.

Nulls: a null text has no words. A null or repeated doc_id is a row of its own. An item
without words has no window; repeated items and ids count once. Ties between equal
hashes keep the rightmost, on both sides alike. Empty tables give empty results, and an
empty benchmark contaminates nothing. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.tables import set_aside
from tidemark.llm.text import LETTERS, LOWER, blocks, shingles, words

#: Beyond so many fingerprints of the benchmark (8 bytes each) they are joined by a shuffle.
BROADCAST_PRINTS = 4_000_000


def winnow(prints: np.ndarray, width: int) -> np.ndarray:
    """The positions that some full window of `width` fingerprints keeps; 0 is no fingerprint."""
    n = len(prints) - width + 1
    if n < 1:
        return np.zeros(0, np.int64)
    best, at = prints[:n].copy(), np.arange(n)
    usable = prints[:n] != 0
    for j in range(1, width):
        here = prints[j : j + n]
        usable &= here != 0
        take = here <= best
        best = np.where(take, here, best)
        at[take] = np.flatnonzero(take) + j
    return np.unique(at[usable])


def row_key(doc_id: int | None, text: bytes) -> str:
    """Names a row by what it holds; equal rows have equal results."""
    return hashlib.blake2b(b"%s|%s" % (str(doc_id).encode(), text), digest_size=16).hexdigest()


def _prints(hashes, row, span: int, k: int, short: list[int]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(window length, positions, fingerprints) of the kept k-grams."""
    grams = shingles(hashes, row, k)
    at = winnow(grams, span - k + 1)
    yield span, at, grams[at]
    for length in short:
        grams = shingles(hashes, row, length)
        at = np.flatnonzero(grams)
        yield length, at, grams[at]


def _windows(span: int, k: int, short: list[int], known: np.ndarray | None):
    """For mapInArrow: each row's number of words and the windows around fingerprints that are known."""

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            own = batch.column("prints").to_pylist() if known is None else None
            for low, high, raw, offsets in blocks(batch):
                data = raw.translate(LOWER)
                start, end, hashes, row = words(data, offsets, LETTERS)
                bounds = np.searchsorted(row, np.arange(high - low + 1))
                found: dict[int, set] = {}
                for length, at, prints in _prints(hashes, row, span, k, short):
                    if known is not None:
                        hit = at[np.isin(prints, known)] if len(known) else at[:0]
                    else:
                        wanted = [set(own[low + r] or ()) for r in range(high - low)]
                        hit = [p for p, f in zip(at.tolist(), prints.view(np.int64).tolist()) if f in wanted[row[p]]]
                    reach = length - k if length == span else 0
                    for p in map(int, hit):
                        r = int(row[p])
                        first, last = max(int(bounds[r]), p - reach), min(p, int(bounds[r + 1]) - length)
                        found.setdefault(r, set()).update((s, length) for s in range(first, last + 1))
                keys, rows = [], []
                for r in range(high - low):
                    keys.append(row_key(ids[low + r], raw[offsets[r] : offsets[r + 1]]))
                    spans = []
                    for s, length in sorted(found.get(r, ())):
                        window = b" ".join(data[start[i] : end[i]] for i in range(s, s + length))
                        spans.append({"start": s - int(bounds[r]), "length": length, "window": window.decode()})
                    rows.append(spans)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(ids[low:high], pa.int64()),
                        pa.array(keys, pa.string()),
                        pa.array(np.diff(bounds), pa.int64()),
                        pa.array(rows, pa.list_(pa.struct([("start", pa.int32()), ("length", pa.int32()), ("window", pa.string())]))),
                    ],
                    names=["doc_id", "row_key", "n_words", "near"],
                )

    return near


def _fingerprints(span: int, k: int, short: list[int], id_type: pa.DataType):
    """For mapInArrow: the kept fingerprints of each row, each once."""

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, _high, raw, offsets in blocks(batch):
                _, _, hashes, row = words(raw.translate(LOWER), offsets, LETTERS)
                for _, at, prints in _prints(hashes, row, span, k, short):
                    table = pa.table({"r": pa.array(row[at] + low), "print": pa.array(prints.view(np.int64))}).group_by(["r", "print"]).aggregate([])
                    ids = batch.column(0).take(table.column("r").combine_chunks()).cast(id_type)
                    yield pa.RecordBatch.from_arrays([ids, table.column("print").combine_chunks()], names=["id", "print"])

    return own


def item_words(text: Column) -> Column:
    """The words as SQL sees them, for the exact comparison."""
    plain = F.translate(F.coalesce(text, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.filter(F.split(plain, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"), lambda w: w != "")


def benchmark_windows(items: DataFrame, span: int = 13) -> DataFrame:
    """(item_id as text, window, length): every window of every item, once."""
    listed = items.select(F.col("item_id").cast("string").alias("item_id"), item_words(F.col("text")).alias("w")).filter("size(w) > 0")
    cut = listed.select("item_id", "w", F.least(F.size("w"), F.lit(span)).alias("length"))
    starts = F.expr("sequence(1, size(w) - length + 1)")
    at = cut.select("item_id", "length", "w", F.explode(starts).alias("s"))
    return at.select("item_id", "length", F.array_join(F.slice("w", F.col("s"), F.col("length")), " ").alias("window")).distinct()


def contaminated_words(documents: DataFrame, items: DataFrame, span: int = 13, k: int = 5, most_prints: int = BROADCAST_PRINTS) -> DataFrame:
    """Per row of documents: doc_id, row_key, n_words, the hit words' positions and the items found.

    `most_prints` is the size up to which the benchmark's fingerprints go to every task;
    a larger benchmark is joined with the documents' fingerprints by a shuffle.
    """
    windows = benchmark_windows(items, span)
    short = sorted(r[0] for r in windows.filter(F.col("length") < span).select("length").distinct().collect())  # at most span - 1 numbers
    texts = items.select(F.lit(0).alias("doc_id"), "text")
    prints = texts.mapInArrow(_fingerprints(span, k, short, pa.int64()), "id long, print long").select("print").distinct()
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    shape = "doc_id long, row_key string, n_words long, near array<struct<start:int,length:int,window:string>>"
    first = prints.limit(most_prints + 1).toPandas()["print"]
    if len(first) <= most_prints:
        near = docs.mapInArrow(_windows(span, k, short, np.sort(first.to_numpy(np.int64).view(np.uint64))), shape)
    else:
        keyed = docs.withColumn("text_key", F.sha2(F.coalesce("text", F.lit("")), 256))
        own = keyed.select("text_key", "text").mapInArrow(_fingerprints(span, k, short, pa.string()), "id string, print long")
        met = own.distinct().join(prints, "print").groupBy("id").agg(F.collect_list("print").alias("prints"))
        near = keyed.join(met, keyed["text_key"] == met["id"], "left").select("doc_id", "text", "prints")
        near = near.mapInArrow(_windows(span, k, short, None), shape)
    # The rows without a hit never meet the windows.
    at = near.filter("size(near) > 0").select("row_key", F.explode("near").alias("n")).select("row_key", "n.*").distinct()
    hits = at.join(windows.select("window").distinct(), "window", "left_semi")
    covered = F.array_distinct(F.flatten(F.collect_list(F.sequence("start", F.col("start") + F.col("length") - 1))))
    positions = hits.groupBy("row_key").agg(F.array_sort(covered).alias("positions"))
    found = hits.select("row_key", "window").distinct().join(windows.select("window", "item_id"), "window")
    found = found.groupBy("row_key").agg(F.array_sort(F.collect_set("item_id")).alias("items"))
    marked = positions.join(found, "row_key")
    return near.select("doc_id", "row_key", "n_words").join(marked, "row_key", "left")


def contamination(documents: DataFrame, items: DataFrame, **options) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    marked = contaminated_words(documents, items, **options)
    none = F.array().cast("array<string>")
    return marked.select(
        "doc_id",
        "n_words",
        F.coalesce(F.size("positions"), F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
        F.sha2(F.array_join(F.coalesce("items", none), ","), 256).alias("items_sha256"),
    ).withColumn("contaminated", F.expr("n_hit > 0 and 20 * n_hit >= n_words"))


def clean(documents: DataFrame, items: DataFrame, **options) -> DataFrame:
    """The rows of documents that are not contaminated, all columns kept.

    The contaminated are few and joined by doc_id and text, so a repeated id with
    another text stays.
    """
    marked = contaminated_words(documents, items, **options).filter("size(positions) > 0 and 20 * size(positions) >= n_words")
    bad = marked.select(F.col("row_key").alias("_row_key")).distinct()
    held, own = set_aside(documents, "_row_key")
    keyed = held.mapInArrow(_keyed, held.withColumn("_row_key", F.lit("")).schema)
    return keyed.join(bad, "_row_key", "left_anti").drop("_row_key").withColumnsRenamed(own)


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys = [row_key(i, (t or "").encode()) for i, t in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist())]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(keys, pa.string())], names=[*batch.schema.names, "_row_key"])
