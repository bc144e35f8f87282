"""Managers scored by their funds: roll-ups, consistency, peers and shocks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fundloom.operators.order_statistics import quantiles


def roll_up(funds: DataFrame, manager: str, score: str, least_funds: int = 2, least_coverage: float = 0.75) -> DataFrame:
    """(manager, funds, scored, coverage, mean, worst, best, eligible): every fund weighs the same; unscored funds lower the coverage."""
    per = funds.groupBy(manager).agg(F.count(F.lit(1)).alias("funds"), F.count(score).alias("scored"), F.avg(score).alias("mean"), F.min(score).alias("worst"), F.max(score).alias("best"))
    coverage = F.col("scored") / F.col("funds")
    return per.select(manager, "funds", "scored", coverage.alias("coverage"), "mean", "worst", "best", ((F.col("scored") >= least_funds) & (coverage >= least_coverage)).alias("eligible"))


def consistency(funds: DataFrame, manager: str, score: str) -> DataFrame:
    """(manager, above_50, top_quarter, bottom_quarter, iqr, worst) of scores from 0 to 100."""
    part = lambda c: F.avg(F.when(F.col(score).isNotNull(), c.cast("double")))
    rates = funds.groupBy(manager).agg(
        part(F.col(score) > 50).alias("above_50"), part(F.col(score) >= 75).alias("top_quarter"), part(F.col(score) <= 25).alias("bottom_quarter"), F.min(score).alias("worst")
    )
    q = quantiles(funds, [manager], score, {"q25": 0.25, "q75": 0.75}).select(manager, (F.col("q75") - F.col("q25")).alias("iqr"))
    return rates.join(q, manager, "left").select(manager, "above_50", "top_quarter", "bottom_quarter", "iqr", "worst")


def value_shock(holdings: DataFrame, owner: str, company: str, sector: str, value: str, top: int = 3, company_loss: float = 0.5, sector_loss: float = 0.3) -> DataFrame:
    """(owner, value, after_companies, after_sector): values after the largest companies, or the largest sector, lose a part.

    Companies and sectors are summed before they are ranked; ties go by name.
    """
    per = holdings.groupBy(owner, sector, company).agg(F.sum(value).alias("v"))
    companies = per.groupBy(owner, company).agg(F.sum("v").alias("v"))
    ranked = companies.withColumn("at", F.row_number().over(W.partitionBy(owner).orderBy(F.desc("v"), company)))
    whole = ranked.groupBy(owner).agg(F.sum("v").alias("value"), F.sum(F.when(F.col("at") <= top, F.col("v")).otherwise(0.0)).alias("largest"))
    sectors = per.groupBy(owner, sector).agg(F.sum("v").alias("v")).groupBy(owner).agg(F.max("v").alias("sector_value"))
    return whole.join(sectors, owner).select(
        owner, "value", (F.col("value") - company_loss * F.col("largest")).alias("after_companies"), (F.col("value") - sector_loss * F.col("sector_value")).alias("after_sector")
    )
