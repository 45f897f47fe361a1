"""Links between nodes that share buckets, and their components.

No bucket's pairs are all made. First every bucket's nodes are compared with one of
them, the one with most exact copies: of a large group that is most often what the
others were made from, so one comparison a node joins the group. Buckets whose nodes
are then of one class are done. The nodes of the rest get new, sharper buckets by a
prefix filter: any two alike nodes share one. In these the smallest 4, 16, 64 ... nodes
that have not yet met all others are compared with those of other classes, but for
pairs that share too few features with anyone to be alike, until every bucket has one
class left or all its nodes have met. So no link between different classes is lost. Every step is a join or an aggregate, each
round's tables are written, and the driver sees only counts.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.tables import stored


def components(edges: DataFrame) -> DataFrame:
    """(node, label): the smallest node of each component of (a, b); `edges` is a written table."""
    both = edges.select("a", "b").unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    labels = stored(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("least")).select("node", F.least("node", "least").alias("label")), "labels")
    while True:
        seen = both.join(labels.select(F.col("node").alias("b"), F.col("label").alias("other")), "b").groupBy(F.col("a").alias("node")).agg(F.min("other").alias("other"))
        near = labels.join(seen, "node", "left").select("node", F.col("label").alias("was"), F.least("label", F.coalesce("other", "label")).alias("label"))
        # A label's own label: paths shorten by half each time.
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("further"))
        after = stored(near.join(jump, "label", "left").select("node", "was", F.least("label", F.coalesce("further", "label")).alias("label")), "labels")
        labels = after.select("node", "label")
        if after.filter("was <> label").isEmpty():
            return labels


def _edges(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("node").alias("a"), F.col("anchor").alias("b"))


def _ordered(met: DataFrame) -> DataFrame:
    return met.select(F.greatest("node", "anchor").alias("node"), F.least("node", "anchor").alias("anchor")).distinct()


def _named(members: DataFrame, labels: DataFrame) -> DataFrame:
    return members.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))


def prefix_buckets(features: DataFrame, least: float) -> DataFrame:
    """(bucket, node, most, whole) from (node, feature, weight), where alike means weighted Jaccard of `least` or more.

    A node's features are ranked by the number of nodes that hold them. What two alike
    nodes share weighs at least `least` of each, so it can't all lie behind the first
    1 - least of the weight of one: they share a feature there. `whole` is the node's
    weight, `most` that of the features from this one on that any other node has. In the
    bucket of the first feature that two nodes share, they share no more than `most`.
    """
    held = features.groupBy("feature").agg(F.count("*").alias("n"))
    counted = features.join(held, "feature")
    rarest = Window.partitionBy("node").orderBy("n", "feature")
    whole = Window.partitionBy("node")
    ranked = counted.select(
        "node",
        F.col("feature").alias("bucket"),
        "n",
        (F.sum("weight").over(rarest.rowsBetween(Window.unboundedPreceding, 0)) - F.col("weight")).alias("before"),
        F.sum("weight").over(whole).alias("whole"),
        F.sum(F.when(F.col("n") > 1, F.col("weight"))).over(rarest.rowsBetween(0, Window.unboundedFollowing)).alias("most"),
    )
    first = ranked.filter((F.col("n") > 1) & (F.col("before") <= (1 - least) * F.col("whole") * (1 + 1e-9)) & (F.col("most") >= least * F.col("whole") * (1 - 1e-9)))
    return first.select("bucket", "node", "most", "whole")


def linked(members: DataFrame, verify: Callable[[DataFrame], DataFrame], features: Callable[[DataFrame], DataFrame], least: float) -> DataFrame:
    """(node, label) of every node that has a link.

    `members` is a written table (bucket, node, copies) without repeats, of buckets with
    two nodes or more. `verify` takes pairs (node, anchor) and returns those whose
    weighted Jaccard similarity is `least` or more. `features` takes a table of nodes
    and returns (node, feature, weight) of each.
    """
    hubs = members.groupBy("bucket").agg(F.max_by("node", F.struct("copies", "node")).alias("anchor"), F.count("*").alias("size"))
    met = stored(members.select("bucket", "node").join(hubs, "bucket").filter("node <> anchor"), "met")
    labels = components(stored(_edges(verify(_ordered(met))), "links"))
    # A bucket of two has met. Of the others those with a node outside the class of their hub are open.
    larger = _named(met.filter("size > 2"), labels)
    hub = labels.select(F.col("node").alias("anchor"), F.col("label").alias("hub_label"))
    open_ = larger.join(hub, "anchor", "left").filter("label <> coalesce(hub_label, anchor)").select("bucket").distinct()
    unsettled = stored(met.join(open_, "bucket", "left_semi").select("node").distinct(), "unsettled")
    if unsettled.isEmpty():
        return labels
    rest, anchors = stored(prefix_buckets(features(unsettled), least), "refined"), 4
    alike = f"least(most, anchor_most) >= {least / (1 + least) * (1 - 1e-9)} * (whole + anchor_whole)"
    while True:
        known = _named(rest, labels)
        several = known.groupBy("bucket").agg(F.min("label").alias("low"), F.max("label").alias("high")).filter("low <> high").select("bucket")
        known = stored(known.join(several, "bucket", "left_semi"), "members")
        if known.isEmpty():
            return labels
        order = Window.partitionBy("bucket").orderBy("node")
        chosen = known.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= anchors)
        chosen = stored(chosen.select("bucket", F.col("node").alias("anchor"), F.col("label").alias("anchor_label"), F.col("most").alias("anchor_most"), F.col("whole").alias("anchor_whole")), "anchors")
        pairs = _ordered(known.join(chosen, "bucket").filter("label <> anchor_label").filter(alike))
        # Of what earlier rounds joined, one edge a node is enough.
        before = labels.filter("node <> label").select(F.col("node").alias("a"), F.col("label").alias("b"))
        labels = components(stored(_edges(verify(pairs)).unionAll(before), "links"))
        rest = known.drop("label").join(chosen.select("bucket", F.col("anchor").alias("node")), ["bucket", "node"], "left_anti")
        anchors *= 4
