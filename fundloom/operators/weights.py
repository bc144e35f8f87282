"""Equal weights within bounds."""

from __future__ import annotations

from decimal import ROUND_HALF_EVEN, Decimal, localcontext

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundloom.functions.frames import frame

#: Fixed value: the quantum of weights.
QUANTUM = Decimal("0.0000000001")


def bounded_equal(bounds: dict[str, tuple[Decimal, Decimal]]) -> dict[str, Decimal]:
    """Weights that sum to one, each the common level where its bounds allow that, else the nearer bound.

    The sum of clamped levels rises piecewise linearly, so the level is found
    exactly between the two bounds that enclose it: no search is needed. Weights
    are rounded half-even to the quantum; the rest goes to the first name, in
    order, that has room. Bounds that can't sum to one are an error.
    """
    names = sorted(bounds)
    if not names or any(low < 0 or high > 1 or low > high for low, high in bounds.values()):
        raise ValueError("invalid bounds")
    if sum(low for low, _ in bounds.values()) > 1 or sum(high for _, high in bounds.values()) < 1:
        raise ValueError("infeasible bounds")
    with localcontext() as c:
        c.prec = 40
        total = lambda level: sum(min(max(level, low), high) for low, high in bounds.values())
        marks = sorted({x for pair in bounds.values() for x in pair})
        at = next((i for i, m in enumerate(marks) if total(m) >= 1), len(marks) - 1)
        level = marks[at]
        if at and total(level) > 1:
            below, above = total(marks[at - 1]), total(level)
            level = marks[at - 1] + (marks[at] - marks[at - 1]) * (1 - below) / (above - below)
        weights = {n: min(max(level, bounds[n][0]), bounds[n][1]).quantize(QUANTUM, rounding=ROUND_HALF_EVEN) for n in names}
        rest = 1 - sum(weights.values())
        for n in names:
            if rest and bounds[n][0] <= weights[n] + rest <= bounds[n][1]:
                weights[n], rest = weights[n] + rest, Decimal(0)
        if rest:
            raise ValueError("rounded weights do not sum to one")
    return weights


def allocate(members: DataFrame, portfolio: str, member: str, low: str, high: str) -> DataFrame:
    """(portfolio, member, weight): one task per portfolio, whose members are few by nature."""
    kinds = {c: members.schema[c].dataType.simpleString() for c in (portfolio, member)}

    def run(g: pd.DataFrame) -> pd.DataFrame:
        keyed = {f"{k!s:>40}": (Decimal(str(a)), Decimal(str(b))) for k, a, b in zip(g["m"], g["low"], g["high"], strict=True)}
        weights = bounded_equal(keyed)
        return frame(p=g["p"], m=g["m"], weight=[weights[f"{k!s:>40}"] for k in g["m"]])

    rows = members.select(F.col(portfolio).alias("p"), F.col(member).alias("m"), F.col(low).alias("low"), F.col(high).alias("high"))
    out = rows.groupBy("p").applyInPandas(run, f"p {kinds[portfolio]}, m {kinds[member]}, weight decimal(12,10)")
    return out.select(F.col("p").alias(portfolio), F.col("m").alias(member), "weight")
