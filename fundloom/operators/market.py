"""A ridge regression by normal equations, judged against group medians on held-out rows."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def fit(rows: DataFrame, features: list[str], target: str, alpha: float) -> tuple[dict[str, tuple[float, float]], np.ndarray]:
    """({feature: (mean, spread)}, coefficients, intercept first) of standardised features; the intercept is not shrunk.

    One aggregation gives all sums of products, so the driver gets a matrix of
    the features' number squared, whatever the rows. Rows with a null are left out.
    """
    clean = rows.select(*[F.col(c).cast("double").alias(c) for c in features], F.col(target).cast("double").alias("__y")).dropna()
    names = [*features, "__y"]
    sums = clean.agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(c).alias(f"s_{i}") for i, c in enumerate(names)],
        *[F.sum(F.col(a) * F.col(b)).alias(f"p_{i}_{j}") for i, a in enumerate(names) for j, b in enumerate(names) if i <= j],
    ).first()
    n, k = sums["n"], len(names)
    if not n:
        raise ValueError("no rows to fit")
    s = np.array([sums[f"s_{i}"] for i in range(k)])
    products = np.array([[sums[f"p_{min(i, j)}_{max(i, j)}"] for j in range(k)] for i in range(k)])
    mean = s / n
    covariance = products - n * np.outer(mean, mean)  # sums of products about the means
    spread = np.sqrt(np.maximum(np.diag(covariance)[:-1] / n, 0.0))
    spread[spread == 0] = 1.0
    gram = covariance[:-1, :-1] / np.outer(spread, spread)
    slope = np.linalg.solve(gram + alpha * np.eye(k - 1), covariance[:-1, -1] / spread)
    return {f: (float(m), float(d)) for f, m, d in zip(features, mean[:-1], spread, strict=True)}, np.r_[mean[-1], slope]


def predicted(rows: DataFrame, scales: dict[str, tuple[float, float]], coefficients: np.ndarray, out: str = "prediction", low: float | None = None, high: float | None = None) -> DataFrame:
    """``rows`` with the model's value, kept within bounds where given."""
    value = F.lit(float(coefficients[0]))
    for (f, (mean, spread)), b in zip(scales.items(), coefficients[1:], strict=True):
        value = value + float(b) * (F.col(f).cast("double") - mean) / spread
    if low is not None:
        value = F.greatest(F.lit(low), value)
    if high is not None:
        value = F.least(F.lit(high), value)
    return rows.withColumn(out, value)


def judged(rows: DataFrame, split: str, actual: str, model: str, baseline: str, weight: str) -> DataFrame:
    """(split, n, model_mae, baseline_mae, model_weighted_mae, baseline_weighted_mae, model_bias, model_wins) of each held-out split."""
    error = lambda c: F.abs(F.col(c) - F.col(actual))
    w = F.greatest(F.col(weight).cast("double"), F.lit(0.0))
    weighted = lambda c: F.coalesce(F.sum(w * error(c)) / F.nullif(F.sum(w), F.lit(0.0)), F.avg(error(c)))
    return rows.groupBy(split).agg(
        F.count(F.lit(1)).alias("n"), F.avg(error(model)).alias("model_mae"), F.avg(error(baseline)).alias("baseline_mae"), weighted(model).alias("model_weighted_mae"),
        weighted(baseline).alias("baseline_weighted_mae"), F.avg(F.col(model) - F.col(actual)).alias("model_bias"), (F.avg(error(model)) < F.avg(error(baseline))).alias("model_wins"),
    )
