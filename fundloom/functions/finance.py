"""Dated cash flows: net present value and internal rate of return."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DAYS = 365.0


def xnpv(flows: Column, rate: Column | float) -> Column:
    """Net present value of an array of (date, amount) sorted by date, actual/365 from the first date; stays in the JVM."""
    r = F.lit(rate) if isinstance(rate, float) else rate
    origin = flows[0]["date"]
    return F.aggregate(flows, F.lit(0.0), lambda acc, x: acc + x["amount"] / F.pow(1 + r, F.datediff(x["date"], origin) / F.lit(DAYS)))


def solve(days: np.ndarray, amounts: np.ndarray) -> float | None:
    """Rate at which the flows' present value is zero; None without a sign change.

    The bracket is doubled until it holds the root; Newton steps are taken while
    they stay inside the bracket, which each value narrows, and halves of it else.
    """
    if len(days) < 2 or not (amounts > 0).any() or not (amounts < 0).any():
        return None
    years = (days - days[0]) / DAYS
    value = lambda r: float(np.sum(amounts * (1 + r) ** -years))
    low, high = -0.999999, 1.0
    at_low = value(low)
    while at_low * value(high) > 0:
        high = 2 * high + 1
        if high > 1e6:
            return None
    rate = 0.1 if low < 0.1 < high else (low + high) / 2
    for _ in range(250):
        v = value(rate)
        if at_low * v <= 0:
            high = rate
        else:
            low = rate
        if high - low < 1e-12 or v == 0:
            break
        slope = float(np.sum(-years * amounts * (1 + rate) ** (-years - 1)))
        new = rate - v / slope if slope else low
        if not low < new < high:
            new = (low + high) / 2
        if abs(new - rate) < 1e-13 * max(1.0, abs(rate)):
            rate = new
            break
        rate = new
    return rate


def with_xirr(df: DataFrame, flows: str, out: str = "xirr") -> DataFrame:
    """``df`` with the internal rate of return of an array column of (date, amount), in Arrow batches without a shuffle."""

    @F.pandas_udf("double")
    def rate(days: pd.Series, amounts: pd.Series) -> pd.Series:
        return pd.Series([solve(np.asarray(d, float), np.asarray(a, float)) for d, a in zip(days, amounts, strict=True)], dtype="float64")

    return df.withColumn(out, rate(F.transform(flows, lambda x: F.unix_date(x["date"])), F.transform(flows, lambda x: x["amount"])))


def dated_flows(df: DataFrame, keys: list[str], date: str, amount: str) -> DataFrame:
    """One sorted array of same-day sums per key."""
    daily = df.groupBy(*keys, F.col(date).cast("date").alias("date")).agg(F.sum(amount).alias("amount"))
    return daily.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("date", "amount"))).alias("flows"))
