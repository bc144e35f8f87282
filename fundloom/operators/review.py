"""Operators of reviews: scoped lookups, detection, adjudication, precedence, rules and cycles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fundloom.session import written


def scoped(rows: DataFrame, given: DataFrame, scopes: list[list[str]], value: str) -> DataFrame:
    """``rows`` with (scoped, place): the smallest given value of the narrowest scope (list of keys) that has one; place counts from 1."""
    out, found, place = rows, F.lit(None), F.lit(None).cast("int")
    values = []
    for i, keys in enumerate(scopes):
        per = given.dropna(subset=keys).groupBy(*keys).agg(F.min(value).alias(f"__s{i}"))
        out = out.join(per, keys, "left")
        values.append(F.col(f"__s{i}"))
    for i, v in reversed(list(enumerate(values))):
        place = F.when(v.isNotNull(), i + 1).otherwise(place)
    found = F.coalesce(*values)
    return out.withColumn("scoped", found).withColumn("place", place).drop(*[f"__s{i}" for i in range(len(scopes))])


def detection(injected: DataFrame, failed: DataFrame, key: str, kind: str) -> DataFrame:
    """(kind, injected, detected, missed, rate) of injected defects among the failed records."""
    hits = injected.join(failed.select(key).distinct().withColumn("__hit", F.lit(1)), key, "left")
    return hits.groupBy(kind).agg(F.count(F.lit(1)).alias("injected"), F.count("__hit").alias("detected")).select(
        kind, "injected", "detected", (F.col("injected") - F.col("detected")).alias("missed"), (F.col("detected") / F.col("injected")).alias("rate"))


def adjudicated(pairs: DataFrame, rulings: DataFrame, keys: list[str], a: str, b: str, ruling: str) -> DataFrame:
    """``pairs`` with (decision, final): AGREED, SINGLE (one side only), ADJUDICATED by a ruling, or OPEN with a null value."""
    x = pairs.join(rulings.select(*keys, ruling), keys, "left")
    agreed, single = F.col(a).eqNullSafe(F.col(b)), F.col(a).isNull() | F.col(b).isNull()
    decision = F.when(agreed, "AGREED").when(single, "SINGLE").when(F.col(ruling).isNotNull(), "ADJUDICATED").otherwise("OPEN")
    return x.withColumn("decision", decision).withColumn("final", F.when(agreed | single, F.coalesce(a, b)).otherwise(F.col(ruling))).drop(ruling)


def stated_part(*fields: str) -> Column:
    """Share of the fields that are neither null nor blank."""
    return sum((F.when(F.coalesce(F.trim(F.col(f).cast("string")), F.lit("")) != "", 1).otherwise(0) for f in fields), F.lit(0)) / len(fields)


def worst_status(status: Column, order: list[str]) -> Column:
    """An aggregate: of the statuses in a group the first in ``order``; others are ignored."""
    at = F.coalesce(*[F.when(status == s, i) for i, s in enumerate(order)])
    return F.element_at(F.lit(order), F.min(at) + 1)


def at_least_one(df: DataFrame, by: list[str], flag: str, order: list[str], out: str) -> DataFrame:
    """``df`` with ``out``: flagged rows, and the first row of a group that has none. A group is a page, so few rows."""
    group = W.partitionBy(*by)
    some = F.max(F.coalesce(F.col(flag), F.lit(False)).cast("int")).over(group)
    return df.withColumn(out, F.coalesce(F.col(flag), F.lit(False)) | ((some == 0) & (F.row_number().over(group.orderBy(*order)) == 1)))


def binding(df: DataFrame, by: list[str], rank: str, value: str) -> DataFrame:
    """(*by, value, conflict): the smallest value of the lowest rank, and whether that rank states several.

    Two aggregations that combine before they shuffle, no window.
    """
    per = df.groupBy(*by, rank).agg(F.min(value).alias("__low"), F.max(value).alias("__high"))
    return per.groupBy(*by).agg(F.min(F.struct(rank, "__low", "__high")).alias("__b")).select(*by, F.col("__b.__low").alias("value"), (F.col("__b.__low") != F.col("__b.__high")).alias("conflict"))


def rule_outcome(rules: list[tuple[int, dict[str, str], str]]) -> Column:
    """The outcome of the matching rule of lowest priority number; null if none matches.

    A condition is a value, ``*`` or ``/pattern/``. Matching rules of one
    priority that disagree are an error. Rules are configuration, so a chain of conditions.
    """

    def meets(field: str, want: str) -> Column:
        if want == "*":
            return F.lit(True)
        if len(want) > 1 and want[0] == want[-1] == "/":
            return F.coalesce(F.col(field).rlike(want[1:-1]), F.lit(False))
        return F.coalesce(F.col(field) == want, F.lit(False))

    out = F.lit(None).cast("string")
    for priority in sorted({p for p, _, _ in rules}, reverse=True):
        own = [(conditions, outcome) for p, conditions, outcome in rules if p == priority]
        hits = []
        for conditions, outcome in own:
            hit = F.lit(True)
            for field, want in conditions.items():
                hit = hit & meets(field, want)
            hits.append((hit, outcome))
        found = F.array_distinct(F.array_compact(F.array(*[F.when(hit, F.lit(outcome)) for hit, outcome in hits])))
        tie = F.when(F.size(found) > 1, F.raise_error(F.lit(f"rules of priority {priority} disagree")).cast("string"))
        out = F.when(F.size(found) > 0, F.coalesce(tie, F.get(found, F.lit(0)))).otherwise(out)
    return out


def required(matrix: dict[str, str], value: Column, name: str) -> Column:
    """The matrix entry of a value; a value it lacks, null too, is an error."""
    found = F.try_element_at(F.create_map(*[F.lit(x) for kv in matrix.items() for x in kv]), value)
    return F.coalesce(found, F.raise_error(F.concat(F.lit(f"no {name}: "), F.coalesce(value, F.lit("null")))).cast("string"))


def reading(taxonomy: dict[str, str], fields: list[str]) -> tuple[Column, Column]:
    """(reading, origin): the taxonomy's name of the first field that has one, else the first field as printed, else Unclassified."""
    known = F.create_map(*[F.lit(x) for kv in taxonomy.items() for x in kv])
    found = [(f, F.try_element_at(known, F.lower(F.trim(F.col(f))))) for f in fields]
    printed = F.nullif(F.trim(F.col(fields[0])), F.lit(""))
    origin = F.when(printed.isNotNull(), "printed").otherwise("none")
    for f, v in reversed(found):
        origin = F.when(v.isNotNull(), f).otherwise(origin)
    return F.coalesce(*[v for _, v in found], printed, F.lit("Unclassified")), origin


def preserved(source: DataFrame, completed: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """One row (source_rows, lost, changed): source rows that the completed table lacks or states otherwise."""
    other = completed.select(F.col(key), F.struct(*fields).alias("__v"))
    x = source.select(F.col(key), F.struct(*fields).alias("__s")).join(other, key, "left")
    return x.agg(F.count(F.lit(1)).alias("source_rows"), F.count_if(F.col("__v").isNull()).alias("lost"), F.count_if(F.col("__v").isNotNull() & ~F.col("__v").eqNullSafe(F.col("__s"))).alias("changed"))


def on_cycles(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node) of every node on a cycle of a directed graph; nodes may have several parents and children.

    Edges that lead nowhere or come from nowhere are peeled off until none is
    left to peel; of what stays, a node is on a cycle if it reaches itself, found
    by doubling the paths within the core. An edge from a node to itself is a cycle.
    """
    core = written(edges.select(F.col(a).alias("a"), F.col(b).alias("b")).dropna().distinct())
    left = core.count()
    while left:
        kept = core.join(core.select(F.col("a").alias("b")).distinct(), "b", "left_semi").join(core.select(F.col("b").alias("a")).distinct(), "a", "left_semi")
        core, before = written(kept.select("a", "b")), left
        left = core.count()
        if left == before:
            break
    reach, n = core, left
    while n:
        longer = reach.join(reach.select(F.col("a").alias("b"), F.col("b").alias("c")), "b").select("a", F.col("c").alias("b"))
        reach, before = written(reach.unionByName(longer).distinct()), n
        n = reach.count()
        if n == before:
            break
    return reach.filter("a = b").select(F.col("a").alias("node"))
