"""Performance of positions against their flows and a benchmark: multiples, public market equivalent, direct alpha."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Days by which a benchmark may end before a period, if it is not coarser itself.
TERMINAL_LAG = 7


def multiples(paid_in: Column, distributed: Column, nav: Column) -> dict[str, Column]:
    """DPI, RVPI and TVPI; null without paid-in capital."""
    base = F.when(paid_in > 0, paid_in)
    return {"dpi": distributed / base, "rvpi": nav / base, "tvpi": (distributed + nav) / base}


def levels_as_of(dates: DataFrame, date: str, series: DataFrame, on: str = "d", level: str = "level") -> DataFrame:
    """(date, level_date, level): the latest observation on or before each distinct date; dates before the first are left out.

    The dates are made distinct first, so what is sorted in one task is bounded
    by the days of the calendar and of the series, whatever the number of flows.
    """
    asked = dates.select(F.col(date).alias("__d")).distinct().withColumn("__o", F.lit(None).cast(series.select(F.struct(on, level)).schema[0].dataType))
    seen = series.select(F.col(on).alias("__d"), F.struct(on, level).alias("__o"))
    carried = F.last("__o", ignorenulls=True).over(W.orderBy("__d", F.col("__o").isNull()).rowsBetween(W.unboundedPreceding, 0))
    both = seen.unionByName(asked).withColumn("__hit", carried).filter(F.col("__o").isNull() & F.col("__hit").isNotNull())
    return both.select(F.col("__d").alias(date), F.col(f"__hit.{on}").alias("level_date"), F.col(f"__hit.{level}").alias("level"))


def spacing(series: DataFrame, on: str = "d") -> DataFrame:
    """One row (last, tolerance): the end of a series and how many days a period may lie beyond it: the upper median spacing, a week at least."""
    gaps = series.select(F.col(on).alias("x"), F.datediff(F.col(on), F.lag(on).over(W.orderBy(on))).alias("gap"))  # a series has a row a day at most
    return gaps.agg(F.max("x").alias("last"), F.sort_array(F.collect_list("gap")).alias("g")).select(
        "last", F.when(F.size("g") > 0, F.greatest(F.lit(TERMINAL_LAG), F.element_at("g", (F.size("g") / 2).cast("int") + 1))).alias("tolerance")
    )


def market_equivalent(flows: DataFrame, periods: DataFrame, series: DataFrame, key: str = "position") -> DataFrame:
    """(key, as_of, ks_pme, flows, status) of each period (key, as_of, nav) from flows (key, d, amount) and a series (d, level).

    ``flows`` of the result are the flows carried to the period at the benchmark,
    with the NAV, for :func:`direct_alpha`. status is ``ok``, ``series ends``
    (the benchmark stops too long before the period), ``series starts late`` (a
    flow lies before it) or ``no contribution``; other than ``ok`` has nulls.
    """
    dates = flows.select(F.col("d")).unionByName(periods.select(F.col("as_of").alias("d")))
    level = F.broadcast(levels_as_of(dates, "d", series))  # a row a calendar day at most
    end = F.broadcast(spacing(series))
    final = periods.join(level.select(F.col("d").alias("as_of"), F.col("level").alias("final")), "as_of", "left").crossJoin(end)
    dated = flows.join(level.select("d", "level"), "d", "left").join(final, key).filter("d <= as_of")
    grown = F.col("amount") * F.col("final") / F.col("level")
    per = dated.groupBy(key, "as_of").agg(
        F.sum(F.when(F.col("amount") < 0, -F.col("amount") / F.col("level"))).alias("put"), F.sum(F.when(F.col("amount") > 0, F.col("amount") / F.col("level"))).alias("got"),
        F.max(F.col("level").isNull().cast("int")).alias("early"), F.array_sort(F.collect_list(F.struct(F.col("d").alias("date"), grown.alias("amount")))).alias("carried"),
    )
    out = final.join(per, [key, "as_of"], "left")
    late = (F.datediff("as_of", "last") > F.col("tolerance")) | F.col("final").isNull()
    status = F.when(late, "series ends").when(F.col("early") == 1, "series starts late").when(F.coalesce("put", F.lit(0.0)) <= 0, "no contribution").otherwise("ok")
    pme = (F.coalesce("got", F.lit(0.0)) + F.col("nav") / F.col("final")) / F.col("put")
    tail = F.when(F.col("nav") > 0, F.array(F.struct(F.col("as_of").alias("date"), F.col("nav").cast("double").alias("amount")))).otherwise(F.array().cast("array<struct<date:date,amount:double>>"))
    return out.select(key, "as_of", status.alias("status"), pme.alias("__pme"), F.concat(F.col("carried").cast("array<struct<date:date,amount:double>>"), tail).alias("__flows")).select(
        key, "as_of", F.when(F.col("status") == "ok", F.col("__pme")).alias("ks_pme"), F.when(F.col("status") == "ok", F.col("__flows")).alias("flows"), "status"
    )


def benchmark_choice(funds: DataFrame, starts: DataFrame, mapping: dict[str, str], default: str, strategy: str = "strategy", first_flow: str = "first_flow") -> DataFrame:
    """``funds`` with (benchmark, reason): the benchmark mapped to a fund's strategy, or the default and why.

    ``starts`` has (benchmark, start), one row per series.
    """
    known = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    asked = funds.withColumn("__b", F.try_element_at(known, F.col(strategy))).join(F.broadcast(starts.select(F.col("benchmark").alias("__b"), F.col("start").alias("__s"))), "__b", "left")
    reason = (
        F.when(F.coalesce(F.trim(F.col(strategy)), F.lit("")) == "", "no_strategy").when(F.col("__s").isNull(), "series_absent")
        .when(F.col("__s") > F.col(first_flow), "series_starts_after_first_flow").otherwise("mapped")
    )
    return asked.withColumn("reason", reason).withColumn("benchmark", F.when(F.col("reason") == "mapped", F.col("__b")).otherwise(default)).drop("__b", "__s")
