"""Connected components of a link table by label contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundloom.operators.skew import hot_keys, join_unique
from fundloom.session import checkpoint


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, label) of every node of ``links``; the label is the smallest node of its component.

    Each round gives a node the smallest label among itself and its neighbours,
    then jumps to that label's own label, so labels travel twice as far each
    round. Aggregations combine before the shuffle, and the links of a node that
    has a large share of them stay where they are and meet its one label by
    broadcast; nothing but such nodes is collected.
    """
    edges = links.select(F.col(a).alias("a"), F.col(b).alias("b")).filter("a is not null and b is not null and a != b")
    both = checkpoint(edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    hubs = hot_keys(both, ["b"])
    labels = checkpoint(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).select("node", F.least("node", "m").alias("label")))
    while True:
        near = join_unique(both, labels.select(F.col("node").alias("b"), "label"), ["b"], "inner", hubs).groupBy(F.col("a").alias("node")).agg(F.min("label").alias("m"))
        step = labels.join(near, "node").select("node", F.least("label", "m").alias("new"), "label")
        jump = step.select(F.col("node").alias("new"), F.col("new").alias("far"))
        moved = checkpoint(step.join(jump, "new", "left").select("node", F.least("new", F.coalesce("far", "new")).alias("label"), (F.col("label") != F.least("new", F.coalesce("far", "new"))).alias("changed")))
        labels = moved.select("node", "label")
        if not moved.filter("changed").take(1):
            return labels
