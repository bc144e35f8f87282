"""Positions and quantiles in sorted groups of any size.

Rows are sorted over all partitions, each partition counts its rows per group,
and the counts before it are added: so a group that holds a third of all rows is
numbered by as many tasks as its rows ask for, and nothing is collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fundloom.session import written


def numbered(df: DataFrame, by: list[str], order: list[str], out: str = "position", total: str | None = None) -> DataFrame:
    """``df`` with the position (from 1) of each row in its group in ascending ``order``, and the group's rows in ``total``.

    Nulls come first; rows that are equal in ``order`` come in any, but one, order.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    laid = written(df.repartitionByRange(parts, *by, *order).sortWithinPartitions(*by, *order).withColumn("__part", F.spark_partition_id()))
    counts = laid.groupBy(*by, "__part").agg(F.count(F.lit(1)).alias("__n"))  # one row per group and partition it lies in
    group = W.partitionBy(*by)
    before = counts.select(
        *by, "__part", F.coalesce(F.sum("__n").over(group.orderBy("__part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("__before"), F.sum("__n").over(group).alias("__total")
    )
    own = laid.withColumn("__own", F.row_number().over(W.partitionBy(*by, "__part").orderBy(*order)))
    same = [F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}")) for k in [*by, "__part"]]
    joined = own.alias("l").join(before.alias("r"), same)
    more = [F.col("r.__total").alias(total)] if total else []
    return joined.select(*[F.col(f"l.{c}") for c in df.columns], (F.col("r.__before") + F.col("l.__own")).alias(out), *more)


def quantiles(df: DataFrame, by: list[str], value: str, probabilities: dict[str, float]) -> DataFrame:
    """(*by, n, *names): exact quantiles by linear interpolation of the non-null values of each group, as doubles."""
    ranked = numbered(df.select(*by, F.col(value).cast("double").alias("__v")).filter("__v is not null"), by, ["__v"], "__at", "__n")
    wanted, columns = F.lit(False), []
    for name, p in probabilities.items():
        place = (F.col("__n") - 1) * F.lit(p) + 1
        low = F.floor(place)
        wanted = wanted | (F.col("__at") == low) | (F.col("__at") == low + 1)
        part = place - low
        weight = F.when(F.col("__at") == low, 1 - part).when((F.col("__at") == low + 1) & (part > 0), part)
        columns.append(F.sum(F.col("__v") * weight).alias(name))
    return ranked.filter(wanted).groupBy(*by).agg(F.max("__n").alias("n"), *columns)


def standing(df: DataFrame, by: list[str], value: str) -> DataFrame:
    """(*by, value, n, before, total): per distinct value of a group its rows, those with a smaller value and all of the group.

    Rows are counted per value before anything is sorted; the counts are summed
    along range partitions, so neither a large group nor a frequent value gathers in one task.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counts = df.groupBy(*by, value).agg(F.count(F.lit(1)).alias("n"))
    laid = written(counts.repartitionByRange(parts, *by, value).sortWithinPartitions(*by, value).withColumn("__part", F.spark_partition_id()))
    group = W.partitionBy(*by)
    sums = laid.groupBy(*by, "__part").agg(F.sum("n").alias("__n"))  # one row per group and partition it lies in
    earlier = sums.select(
        *by, "__part", F.coalesce(F.sum("__n").over(group.orderBy("__part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("__earlier"), F.sum("__n").over(group).alias("__total")
    )
    own = laid.withColumn("__own", F.coalesce(F.sum("n").over(W.partitionBy(*by, "__part").orderBy(value).rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
    same = [F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}")) for k in [*by, "__part"]]
    return own.alias("l").join(earlier.alias("r"), same).select(
        *[F.col(f"l.{c}") for c in [*by, value, "n"]], (F.col("r.__earlier") + F.col("l.__own")).alias("before"), F.col("r.__total").alias("total")
    )


def ranks(df: DataFrame, by: list[str], score: str) -> DataFrame:
    """``df`` with (competition, dense): the rank of each row in its group by descending score; null scores are left out."""
    rows = df.filter(F.col(score).isNotNull())
    place = standing(rows, by, score)
    distinct = standing(rows.select(*by, score).distinct(), by, score).select(*by, score, (F.col("total") - F.col("before")).alias("dense"))
    near = lambda side: [F.col(f"x.{k}").eqNullSafe(F.col(f"{side}.{k}")) for k in [*by, score]]
    joined = rows.alias("x").join(place.alias("p"), near("p")).join(distinct.alias("d"), near("d"))
    return joined.select("x.*", (F.col("p.total") - F.col("p.before") - F.col("p.n") + 1).alias("competition"), F.col("d.dense"))
