"""Temperature mixing of sources, and its realisation as budgeted block permutations.

A source's weight is its share of all tokens to the power of an exponent, normalised.
At 1 the corpus is as it is, at 0 all sources weigh the same. The exponent is bisected
to the largest at which the weights' entropy reaches the target, then raised until no
source is read more often than the repetition limit; the limit wins.

A weight times the budget is a source's tokens to read. Its documents lie in blocks by
hash. Each whole reading is a permutation of all blocks; the last takes blocks of its
own permutation while they fit, and of the first that does not, the documents of the
smallest hashes that fit. Only sums by source and block are shuffled; a document finds
its place in its own row, joined with the plan of its block.

Nulls: a null source is the source of empty name, a null text has no tokens, a null
doc_id hashes as empty text. Repeated rows count each; rows of one doc_id share a hash
and are taken together. Sources without tokens have weight 0 and are read in no epoch.
An empty table gives an empty result. Clashing names of extra columns: columns called
epoch, block, place or n_tokens are replaced.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.rules import word_list
from tidemark.llm.tables import set_aside, stored

#: Blocks of a source, whatever its size.
BLOCKS = 4096
#: Sources up to which the bisection has their sums at hand; beyond, each step is a query.
FEW_SOURCES = 100_000
STEPS = 60


def digest(*parts: Column) -> Column:
    """60 bits of the md5 of the parts, as a long that any SQL engine can make."""
    text = F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def weights_at(shares: list[float], exponent: float) -> list[float]:
    powers = [p**exponent if p > 0 else 0.0 for p in shares]
    total = sum(powers)
    return [p / total for p in powers]


def _measures(sources: DataFrame, total: int, few: list[int] | None):
    """exponent -> (entropy of the weights, largest weight by share)."""

    def local(exponent: float) -> tuple[float, float]:
        shares = [t / total for t in few if t > 0]
        weights = weights_at(shares, exponent)
        return -sum(w * math.log(w) for w in weights), max(w / p for w, p in zip(weights, shares))

    def spread(exponent: float) -> tuple[float, float]:
        power = F.pow(F.col("tokens") / total, F.lit(exponent))
        row = sources.filter("tokens > 0").agg(F.sum(power).alias("z"), F.sum(power * F.log(power)).alias("l"), F.max(power / (F.col("tokens") / total)).alias("m")).first()
        return math.log(row["z"]) - row["l"] / row["z"], row["m"] / row["z"]

    return local if few is not None else spread


def bisect(fits, low: float = 0.0, high: float = 1.0, largest: bool = True) -> float:
    """The largest (else smallest) exponent that fits, where one end fits and the answer changes once."""
    if fits(high if largest else low):
        return high if largest else low
    for _ in range(STEPS):
        middle = (low + high) / 2
        if fits(middle) == largest:
            low = middle
        else:
            high = middle
    return low if largest else high


def choose_exponent(measures, budget_share: float, entropy: float | None, most_repeats: float | None) -> float:
    exponent = 1.0 if entropy is None else bisect(lambda a: measures(a)[0] >= entropy)
    if most_repeats is not None and budget_share * measures(exponent)[1] > most_repeats:
        exponent = bisect(lambda a: budget_share * measures(a)[1] <= most_repeats, exponent, 1.0, largest=False)
    return exponent


def mix(documents: DataFrame, budget_share: float = 1.0, evenness: float | None = 0.97, most_repeats: float | None = 4.0, blocks: int = BLOCKS, few_sources: int = FEW_SOURCES) -> DataFrame:
    """The documents' columns, n_tokens, and epoch, block and place of each reading; those four replace columns of their name.

    The budget is `budget_share` of all tokens; the entropy's target is `evenness`
    times that of equal weights. `place` orders a source's blocks within an epoch.
    """
    documents, own = set_aside(documents, "_source", "_hash", "left", "last")
    source, cell = F.coalesce(F.col("source").cast("string"), F.lit("")), F.pmod(digest(F.col("doc_id"), F.lit("block")), F.lit(blocks))
    held = documents.drop("epoch", "block", "place", "n_tokens")
    held = held.select("*", F.size(word_list(F.col("text"))).cast("long").alias("n_tokens"), source.alias("_source"), cell.alias("block"), digest(F.col("doc_id"), F.lit("order")).alias("_hash"))
    cells = stored(held.groupBy("_source", "block").agg(F.sum("n_tokens").alias("cell_tokens")), "cells")
    sources = cells.groupBy("_source").agg(F.sum("cell_tokens").alias("tokens"))
    total, known = sources.agg(F.coalesce(F.sum("tokens"), F.lit(0)), F.count_if(F.col("tokens") > 0)).first()
    few = sorted(r["tokens"] for r in sources.select("tokens").collect()) if known <= few_sources else None
    if not total:
        return held.select("*", F.lit(0).alias("epoch"), F.lit(0).alias("place")).drop("_source", "_hash").filter("false").withColumnsRenamed(own)
    measures = _measures(sources, total, few)
    exponent = choose_exponent(measures, budget_share, None if evenness is None else evenness * math.log(known), most_repeats)
    scale = sum((t / total) ** exponent for t in few if t > 0) if few is not None else sources.filter("tokens > 0").agg(F.sum(F.pow(F.col("tokens") / total, F.lit(exponent)))).first()[0]
    weight = F.when(F.col("tokens") > 0, F.pow(F.col("tokens") / total, F.lit(exponent)) / F.lit(scale)).otherwise(0.0)
    # Rounded, so that sums in another order lead to the same tokens.
    wanted = F.floor(F.round(weight, 9) * F.lit(float(budget_share)) * total + 0.5).cast("long")
    aims = sources.filter("tokens > 0").select("_source", "tokens", wanted.alias("wanted"))
    aims = aims.select("_source", F.expr("wanted div tokens").cast("int").alias("whole"), F.expr("wanted % tokens").alias("rest"))
    order = Window.partitionBy("_source", "epoch").orderBy("order", "block")
    plan = cells.join(aims, "_source").withColumn("epoch", F.explode(F.sequence(F.lit(0), F.col("whole"))))
    plan = plan.withColumn("order", digest(F.col("_source"), F.col("block"), F.col("epoch")))
    plan = plan.withColumn("place", F.row_number().over(order)).withColumn("upto", F.sum("cell_tokens").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    left = F.col("rest") - F.col("upto") + F.col("cell_tokens")  # of the last epoch's tokens when the block begins
    plan = stored(plan.filter((F.col("epoch") < F.col("whole")) | (left > 0)).select("_source", "block", "epoch", "place", F.when((F.col("epoch") == F.col("whole")) & (F.col("cell_tokens") > left), left).alias("left")), "plan")
    # One block of each source is cut: the last hash that fits, repeated ids together.
    cut = held.select("_source", "block", "_hash", "n_tokens").join(plan.filter("left is not null").select("_source", "block", "left"), ["_source", "block"])
    upto = F.sum("n_tokens").over(Window.partitionBy("_source").orderBy("_hash").rangeBetween(Window.unboundedPreceding, 0))
    last = cut.groupBy("_source", "_hash").agg(F.sum("n_tokens").alias("n_tokens"), F.first("left").alias("left")).withColumn("upto", upto).filter("upto <= left").groupBy("_source").agg(F.max("_hash").alias("last"))
    plan = stored(plan.join(last, "_source", "left"), "places")
    taken = held.join(F.broadcast(plan) if plan.count() <= 1_000_000 else plan, ["_source", "block"])
    taken = taken.filter("left is null or _hash <= last")
    return taken.select(*[c for c in held.columns if c not in ("_source", "_hash")], "epoch", "place").withColumnsRenamed(own)
