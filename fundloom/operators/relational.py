"""Relational operators that SQL has no single word for."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fundloom.operators.order_statistics import standing


def latest_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key in ``order``; ties are settled by the order's last columns."""
    return df.withColumn("__rn", F.row_number().over(W.partitionBy(*keys).orderBy(*order))).filter("__rn = 1").drop("__rn")


def first_wins_pivot(df: DataFrame, grain: list[str], column: str, value: str, order: str, names: list[str]) -> DataFrame:
    """One row per grain with the first value per name, and the number of names stated more than once.

    One aggregation: each output column is the value of the smallest ``order``
    under a condition, so no row is expanded and partial results combine.
    """
    cells = [F.min_by(F.when(F.col(column) == n, F.col(value)), F.when(F.col(column) == n, F.col(order))).alias(n) for n in names]
    counts = [F.count(F.when(F.col(column) == n, 1)) for n in names]
    collisions = sum((F.when(c > 1, 1).otherwise(0) for c in counts), F.lit(0))
    return df.filter(F.col(column).isin(names)).groupBy(*grain).agg(*cells, collisions.alias("collisions"))


def parity(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows of either side that the other lacks, as multisets, with their side."""
    return a.exceptAll(b).withColumn("side", F.lit("a")).unionByName(b.exceptAll(a).withColumn("side", F.lit("b")))


def missing_parents(child: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Child rows whose non-null key has no parent row."""
    return child.filter(F.col(key).isNotNull()).join(parent.select(F.col(parent_key).alias(key)).distinct(), key, "left_anti")


def repeated_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their count; the window-free form combines before the shuffle."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def unique_match(a: DataFrame, b: DataFrame, keys: list[str], a_id: str, b_id: str) -> DataFrame:
    """Pairs (keys, a_id, b_id) of keys that occur exactly once on both sides."""
    one = lambda df, c: df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.min(c).alias(c)).filter("n = 1").drop("n")
    return one(a, a_id).join(one(b, b_id), keys)


def source_wins(source: DataFrame, generated: DataFrame, keys: list[str]) -> DataFrame:
    """All source rows, and generated rows of keys the source lacks."""
    return source.unionByName(generated.join(source.select(*keys).distinct(), keys, "left_anti"))


def match_rules(df: DataFrame, rules: list[tuple[int, str, str]], text: str) -> Column:
    """The outcome of the first rule, by priority, whose pattern the text matches; null if none does.

    Rules are configuration, so they are a chain of conditions, not a join.
    """
    out = F.lit(None).cast("string")
    for _, pattern, outcome in sorted(rules, reverse=True):
        out = F.when(F.col(text).rlike(pattern), outcome).otherwise(out)
    return out


def lookup(matrix: dict[str, str], value: Column, star: bool = True) -> Column:
    """A decision matrix: exact value, ``<blank>`` for empty or null, ``*`` for the rest."""
    table = F.create_map(*[F.lit(x) for kv in matrix.items() for x in kv])
    key = F.coalesce(F.nullif(F.trim(value), F.lit("")), F.lit("<blank>"))
    found = F.try_element_at(table, key)
    return F.coalesce(found, F.lit(matrix.get("*"))) if star else found


def midpoint_percentile(df: DataFrame, cohort: list[str], owner: str, score: str) -> DataFrame:
    """100 (below + equal / 2) / n against the cohort's rows of other owners.

    Counting below and equal needs no self-join: the counts of the cohort less
    those of the owner's own rows. Both are sums over distinct scores, so no
    cohort is sorted in one task; a row of a cohort without other owners gets null.
    """
    rows = df.filter(F.col(score).isNotNull())
    every, own = standing(rows, cohort, score), standing(rows, [*cohort, owner], score)
    near = lambda by, side: [F.col(f"x.{k}").eqNullSafe(F.col(f"{side}.{k}")) for k in [*by, score]]
    joined = rows.alias("x").join(every.alias("e"), near(cohort, "e")).join(own.alias("o"), near([*cohort, owner], "o"))
    of = lambda c: F.col(f"e.{c}") - F.col(f"o.{c}")
    peers = of("total")
    return joined.select("x.*", peers.alias("peers"), F.when(peers > 0, 100.0 * (of("before") + 0.5 * of("n")) / peers).alias("percentile"))


def fold_index(df: DataFrame, by: list[str], time: str, rate: str) -> DataFrame:
    """Cumulative index of simple returns, product of (1 + rate), in order of ``time``."""
    w = W.partitionBy(*by).orderBy(time).rowsBetween(W.unboundedPreceding, 0)
    return df.withColumn("index", F.exp(F.sum(F.log1p(F.col(rate))).over(w)))


def scorecard(results: DataFrame, by: list[str], status: str = "status") -> DataFrame:
    """(*by, checks, passes, failures, skips, pass_rate_excluding_skips) of quality results."""
    n = lambda s: F.count_if(F.col(status) == s)
    return results.groupBy(*by).agg(
        F.count(F.lit(1)).alias("checks"), n("PASS").alias("passes"), n("FAIL").alias("failures"), n("SKIP").alias("skips"),
        F.try_divide(n("PASS").cast("double"), n("PASS") + n("FAIL")).alias("pass_rate_excluding_skips"),
    )
