"""Quality rules: counts by rule, and a hashed n-gram log-likelihood ratio.

DataFrame functions only. Words and pairs of neighbouring words are hashed into
`buckets`. Two multinomials are counted over whole tables, each with one added count a
bucket: that of trusted documents and that of all documents. A document's ratio is the
mean over its n-grams of the logarithm of trusted by raw share; at `least` or above it
is kept, unless a base rule fails. The ratios by bucket are a table of fixed size and
become an array that each task holds.

Nulls: a null text has no words and fails the base rules; a null doc_id is a row that
nobody trusts. Repeated trusted ids count once, repeated documents each time. A text
without n-grams has ratio 0. Without trusted documents every ratio is 0. A tie with
the threshold is kept. Other columns are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.tables import BROADCAST_IDS, stored

BUCKETS = 1 << 14
#: Documents below this mean log ratio are dropped.
LEAST_RATIO = -0.07
WINDOW = 5


def let(value: Column, body) -> Column:
    """body(value), with the value worked out once."""
    return F.transform(F.array(value), body)[0]


def word_list(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), "[ \\t-\\r]+"), "")


def _after(values: Column, skip: int) -> Column:
    return F.slice(values, F.lit(skip + 1), F.greatest(F.size(values) - skip, F.lit(0)))


def _before(values: Column, less: int) -> Column:
    return F.slice(values, F.lit(1), F.greatest(F.size(values) - less, F.lit(0)))


def both(left: Column, right: Column) -> Column:
    """A hash of each two values at one place; the arrays are of one length."""
    return F.zip_with(left, right, lambda a, b: F.xxhash64(a, b))


def repeated_words(hashes: Column, pairs: Column) -> Column:
    """Words inside windows of five words that the text holds twice or more."""
    window = WINDOW
    fours = both(_before(pairs, 2), _after(pairs, 2))
    grams = let(fours, lambda four: both(_before(four, 1), _after(hashes, 4)))

    def covered(found: Column) -> Column:
        placed = F.sort_array(F.transform(found, lambda x, i: F.struct(x.alias("x"), i.alias("i"))))
        again = lambda s: F.filter(s, lambda e, j: F.coalesce(e["x"] == F.get(s, j - 1)["x"], F.lit(False)) | F.coalesce(e["x"] == F.get(s, j + 1)["x"], F.lit(False)))
        at = let(placed, lambda s: F.sort_array(F.transform(again(s), lambda e: e["i"])))
        steps = lambda p: F.transform(p, lambda v, j: F.least(F.lit(window), F.coalesce(F.get(p, j + 1) - v, F.lit(window))))
        return let(at, lambda p: F.aggregate(steps(p), F.lit(0), lambda total, x: total + x))

    # Most texts repeat no window and are done here.
    return let(grams, lambda g: F.when(F.size(F.array_distinct(g)) == F.size(g), 0).otherwise(covered(g)))


def base_counts(documents: DataFrame, *keep: str) -> DataFrame:
    """The kept columns, the words' hashes as `hashes`, and the counts of the base rules."""
    plain = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(plain, "\n"), lambda line: line.rlike("[^ \\t-\\r]"))
    cut = documents.select(*keep, plain.alias("text"), word_list(F.col("text")).alias("w"))
    return cut.select(
        *keep,
        F.transform("w", lambda w: F.xxhash64(w)).alias("hashes"),
        F.size("w").cast("long").alias("n_words"),
        F.length(F.array_join("w", "")).cast("long").alias("word_chars"),
        (F.length("text") - F.length(F.regexp_replace("text", "[#*$%&|<>]", ""))).cast("long").alias("n_symbols"),
        let(lines, lambda found: F.size(found) - F.size(F.array_distinct(found))).cast("long").alias("n_dup_lines"),
    )


def log_ratios(documents: DataFrame, trusted: DataFrame, buckets: int = BUCKETS, most: int = BROADCAST_IDS) -> list[float]:
    """For each bucket ln(trusted share / raw share), from all documents; `trusted` has doc_id."""
    assert buckets & (buckets - 1) == 0, "a power of two"
    ids = stored(trusted.filter("doc_id is not null").select(F.col("doc_id").cast("long").alias("id")).distinct().withColumn("good", F.lit(1)), "trusted")
    few = ids.count() <= most
    marked = documents.select(F.col("doc_id").cast("long").alias("id"), "text").join(F.broadcast(ids) if few else ids.hint("merge"), "id", "left")
    hashed = marked.select("good", F.transform(word_list(F.col("text")), lambda w: F.xxhash64(w)).alias("h"))
    grams = hashed.select("good", F.explode(F.concat("h", both(_before(F.col("h"), 1), _after(F.col("h"), 1)))).alias("x"))
    found = grams.groupBy(F.col("x").bitwiseAND(F.lit(buckets - 1).cast("long")).alias("b")).agg(F.count("*").alias("raw"), F.count("good").alias("good"))
    rows = {r["b"]: (r["raw"], r["good"]) for r in found.collect()}  # two numbers per bucket, whatever the input
    all_raw, all_good = (sum(r[i] for r in rows.values()) for i in (0, 1))
    if not all_good:
        return [0.0] * buckets
    raw_base, good_base = math.log(all_raw + buckets), math.log(all_good + buckets)
    return [math.log(good + 1) - good_base - math.log(raw + 1) + raw_base for raw, good in (rows.get(b, (0, 0)) for b in range(buckets))]


def judged(documents: DataFrame, trusted: DataFrame, least: float = LEAST_RATIO, buckets: int = BUCKETS, **options) -> DataFrame:
    """doc_id, the counts, base_failed, ratio and kept of every document."""
    table = F.lit(log_ratios(documents, trusted, buckets, **options)).cast("array<double>")
    mask = F.lit(buckets - 1).cast("long")
    total = lambda values: F.aggregate(values, F.lit(0.0), lambda t, x: t + F.get(table, x.bitwiseAND(mask)))
    # In steps: each column is worked out once, and what follows refers to it.
    hashed = base_counts(documents, "doc_id").withColumn("pairs", both(_before(F.col("hashes"), 1), _after(F.col("hashes"), 1)))
    scored = hashed.withColumn("n_repeat_words", repeated_words(F.col("hashes"), F.col("pairs")).cast("long"))
    scored = scored.withColumn("ratio", F.when(F.size("hashes") == 0, 0.0).otherwise((total(F.col("hashes")) + total(F.col("pairs"))) / (F.size("hashes") + F.size("pairs"))))
    failed = F.expr("n_words < 10 or 100 * n_repeat_words > 20 * n_words")
    return scored.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"), "ratio", (~failed & (F.col("ratio") >= least)).alias("kept"))
