"""Parent-child links to full hierarchies by pointer doubling.

Every node keeps a pointer to an ancestor and its distance. One round replaces
the pointer by the pointer's own pointer, so the distance doubles: a forest of
depth d is resolved in about log2(d) + 1 joins. After k rounds every node of
depth up to 2**k is resolved. A node on a longer acyclic chain has an ancestor
on each lower level, so a round that resolves nothing proves that whatever is
left runs into a cycle.

Defined results:
* a null, blank or unknown parent makes the node its own root (depth 0);
* a node stated with several parents takes the smallest one in byte order, the
  others are listed by :func:`other_parents`; repeated rows count once; a null
  or blank node id is no node;
* an empty table gives an empty result;
* a node on a cycle, or below one, has root ``CYCLE`` and depth -1, and its
  path is null; :func:`descendants` leaves it out, :func:`lineage` lists it too.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundloom.operators.skew import join_unique
from fundloom.session import written

CYCLE = "CYCLE"


def _blank_to_null(name: str):
    return F.when(F.trim(F.col(name)) != "", F.col(name))


def links(df: DataFrame, hierarchy: str, node: str, parent: str, parents_are_nodes: bool = False) -> DataFrame:
    """(hierarchy, node, parent), one row per node; ``parents_are_nodes`` adds parents that have no row."""
    own = df.select(_blank_to_null(node).alias("node"), _blank_to_null(parent).alias("parent"))
    if parents_are_nodes:
        own = own.unionByName(own.select(F.col("parent").alias("node"), F.lit(None).cast("string").alias("parent")))
    return (
        own.filter("node is not null").groupBy("node").agg(F.min("parent").alias("parent"))
        .select(F.lit(hierarchy).alias("hierarchy"), "node", "parent")
    )


def other_parents(df: DataFrame, hierarchy: str, node: str, parent: str) -> DataFrame:
    """(hierarchy, node, parent, other): each link that :func:`links` leaves out, with the parent it takes."""
    stated = df.select(_blank_to_null(node).alias("node"), _blank_to_null(parent).alias("other")).filter("node is not null and other is not null").distinct()
    kept = stated.groupBy("node").agg(F.min("other").alias("parent"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    return stated.join(kept, "node").filter("other != parent").select(F.lit(hierarchy).alias("hierarchy"), "node", "parent", "other")


def _pending(state: DataFrame, share: float, least: int) -> tuple[int, list[tuple]]:
    """Unresolved rows and the pointers that at least ``share`` of them have (at most 1/share)."""
    counts = state.filter("not done").groupBy("hierarchy", "ptr").agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n")).first()[0] or 0
    if total * share < least:  # no pointer has enough rows to be worth a split
        hot = []
        if total >= least:
            hot = counts.filter(F.col("n") >= least).orderBy(F.desc("n")).limit(int(1 / share)).collect()
    else:
        hot = counts.filter(F.col("n") >= share * total).collect()
    return total, [(r["hierarchy"], r["ptr"]) for r in hot]


def resolve(edges: DataFrame, with_path: bool = True, share: float = 1 / 64, least: int = 50_000, with_walk: bool = False) -> DataFrame:
    """(hierarchy, node, root, depth[, path][, walk]) of every node of :func:`links`.

    ``path`` runs from the root to the node. Path segments are concatenated as
    distances double; a segment that repeats a node is dropped at once, so a
    cycle never grows one beyond twice its length. ``walk`` (with ``path`` only)
    is for nodes on and below cycles: all their ancestors, farthest first, and
    the node; it keeps the nearest of repeated nodes and is whole once one repeats.
    """
    known = edges.select("hierarchy", F.col("node").alias("parent"), F.lit(True).alias("known"))
    state = edges.join(known, ["hierarchy", "parent"], "left").select(
        "hierarchy", "node",
        F.when(F.col("known"), F.col("parent")).otherwise(F.col("node")).alias("ptr"),
        F.when(F.col("known"), 1).otherwise(0).cast("long").alias("depth"),
        F.col("known").isNull().alias("done"),
        *([F.array("node").alias("path")] if with_path else []),
    )
    path = []
    if with_path:
        whole = F.concat("rest", "path")
        once = F.reverse(F.array_distinct(F.reverse(whole)))
        path = [(once if with_walk else F.when(F.size(F.array_distinct(whole)) == F.size(whole), whole)).alias("path")]

    def moved(part: DataFrame, state: DataFrame, hot: list[tuple]) -> DataFrame:
        ahead = state.select(
            "hierarchy", F.col("node").alias("ptr"), F.col("ptr").alias("next"), F.col("depth").alias("more"),
            F.col("done").alias("end"), *([F.col("path").alias("rest")] if with_path else []),
        )
        return join_unique(part, ahead, ["hierarchy", "ptr"], "inner", hot).select(
            "hierarchy", "node", F.col("next").alias("ptr"), (F.col("depth") + F.col("more")).alias("depth"),
            F.col("end").alias("done"), *path,
        )

    start = written(state)
    finished, waiting = [start.filter("done")], start.filter("not done")  # what is resolved is set aside and not written again

    def everything(parts: list[DataFrame]) -> DataFrame:
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out

    left, hot = _pending(waiting, share, least)
    while left:
        step = written(moved(waiting, everything([*finished, waiting]), hot))
        finished.append(step.filter("done"))
        waiting, before = step.filter("not done"), left
        left, hot = _pending(waiting, share, least)
        if left == before:
            break
    if with_walk and left:  # a cycle may be longer than every chain: double among its nodes until each walk repeats one
        ended, open_ = [waiting.filter("size(path) < depth")], waiting.filter("size(path) = depth")
        left, hot = _pending(open_, share, least)
        while left:
            step = written(moved(open_, everything([*ended, open_]), hot))
            ended.append(step.filter("size(path) < depth"))
            open_ = step.filter("size(path) = depth")
            left, hot = _pending(open_, share, least)
        waiting = everything([*ended, open_])
    state = everything([*finished, waiting])
    return state.select(
        "hierarchy", "node",
        F.when(F.col("done"), F.col("ptr")).otherwise(CYCLE).alias("root"),
        F.when(F.col("done"), F.col("depth")).otherwise(-1).alias("depth"),
        *([F.when(F.col("done"), F.col("path")).alias("path")] if with_path else []),
        *([F.when(~F.col("done"), F.col("path")).alias("walk")] if with_walk else []),
    )


def descendants(resolved: DataFrame) -> DataFrame:
    """(hierarchy, ancestor, descendant, distance) for each node and each node below it, along paths.

    Nodes on or below a cycle have no path and are left out; :func:`lineage` has them.
    """
    return (
        resolved.filter("path is not null").select("hierarchy", "node", "depth", F.posexplode("path").alias("at", "ancestor"))
        .filter("at < depth")
        .select("hierarchy", "ancestor", F.col("node").alias("descendant"), (F.col("depth") - F.col("at")).alias("distance"))
    )


def lineage(resolved: DataFrame) -> DataFrame:
    """(hierarchy, ancestor, descendant, distance) for each node and each node below it, cycles included.

    ``resolved`` has walks. On a cycle every node is below every other; a pair is
    listed once with the shortest distance, and no node is its own descendant.
    """
    line = F.coalesce("path", "walk")
    return (
        resolved.select("hierarchy", "node", F.size(line).cast("long").alias("n"), F.posexplode(line).alias("at", "ancestor"))
        .filter("at < n - 1")
        .select("hierarchy", "ancestor", F.col("node").alias("descendant"), (F.col("n") - 1 - F.col("at")).alias("distance"))
    )
