"""Forecasts of positions quarter by quarter, and prices at a hurdle rate."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Scenario:
    """One course of a position: growth a year, opening multiplier, delay and multiplier of distributions."""

    name: str
    growth: float
    opening: float = 1.0
    delay: int = 0
    distributions: float = 1.0


@dataclass(frozen=True)
class Policy:
    quarters: int = 8
    funding_quarters: int = 3
    distribution_start: int = 2
    distribution_fraction: float = 0.15
    draw_fraction: float = 0.8
    fee_fraction: float = 0.1


STEP = "struct<quarter:int,step_date:date,opening_nav:double,growth:double,call:double,fee:double,distribution:double,nav:double,unfunded:double,draw:double>"


def quarters(closing: Column, nav: Column, unfunded: Column, s: Scenario, p: Policy) -> Column:
    """The quarters of a position as an array, folded in the JVM: growth, call, fee, distribution, closing NAV and unfunded.

    Calls are even over the funding quarters, a fee part of each is not
    capitalised; distributions are a part of NAV from their first quarter on and
    all of it in the last.
    """
    at = lambda q: F.add_months(closing, 3 * q)
    fraction = min(1.0, p.distribution_fraction * s.distributions)

    def step(acc: Column, q: Column) -> Column:
        before = F.element_at(acc, -1)
        day = at(q)
        growth = before["nav"] * (F.pow(F.lit(1 + s.growth), F.datediff(day, before["step_date"]) / 365.0) - 1) if s.growth > -1 else F.lit(0.0)
        call = F.when((q <= p.funding_quarters) & (before["draw"] > 1e-12), before["draw"] / (p.funding_quarters - q + 1)).otherwise(0.0)
        grown = before["nav"] + growth + call * (1 - p.fee_fraction)
        paid = F.when((q >= p.distribution_start + s.delay) & (grown > 1e-12), F.when(q == p.quarters, grown).otherwise(grown * fraction)).otherwise(F.when(q == p.quarters, grown).otherwise(0.0))
        row = F.struct(
            q.cast("int"), day, before["nav"], growth, call, call * p.fee_fraction, paid, grown - paid, before["unfunded"] - call, before["draw"] - call
        ).cast(STEP)
        return F.array_append(acc, row)

    opening = F.struct(
        F.lit(0), closing.cast("date"), F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(0.0), nav.cast("double") * s.opening, unfunded.cast("double"), unfunded.cast("double") * p.draw_fraction
    ).cast(STEP)
    return F.slice(F.aggregate(F.sequence(F.lit(1), F.lit(p.quarters)), F.array(opening), step), 2, p.quarters)


def forecast(positions: DataFrame, key: str, closing: str, nav: str, unfunded: str, scenarios: list[Scenario], policy: Policy = Policy()) -> DataFrame:
    """(key, scenario, quarter, step_date, opening_nav, growth, call, fee, distribution, nav, unfunded): no shuffle."""
    each = F.array(*[F.struct(F.lit(s.name).alias("scenario"), quarters(F.col(closing), F.col(nav), F.col(unfunded), s, policy).alias("steps")) for s in scenarios])
    return positions.select(key, F.explode(each).alias("x")).select(key, "x.scenario", F.explode("x.steps").alias("s")).select(key, "scenario", "s.*").drop("draw")


def priced(positions: DataFrame, key: str, closing: str, nav: str, unfunded: str, ask: str, scenarios: list[Scenario], hurdle: float, cost: str, policy: Policy = Policy()) -> DataFrame:
    """(key, scenario, present_value, ceiling, ceiling_part, ask_value, multiple, status) of each position and scenario.

    ceiling is the highest price that still earns the hurdle rate, as a part of
    NAV where that is not zero; status tells whether the asked price meets it.
    """
    each = F.array(*[F.struct(F.lit(s.name).alias("scenario"), quarters(F.col(closing), F.col(nav), F.col(unfunded), s, policy).alias("steps")) for s in scenarios])
    rows = positions.select("*", F.explode(each).alias("__x"))
    steps = F.col("__x.steps")
    flow = lambda x: x["distribution"] - x["call"]
    total = lambda f: F.aggregate(steps, F.lit(0.0), lambda acc, x: acc + f(x))
    value = total(lambda x: flow(x) / F.pow(F.lit(1 + hurdle), F.datediff(x["step_date"], F.col(closing)) / 365.0))
    rows = rows.select(key, F.col("__x.scenario").alias("scenario"), F.col(nav).alias("__nav"), F.col(ask).alias("__ask"), F.col(cost).alias("__cost"), value.alias("present_value"), total(lambda x: x["call"]).alias("__calls"), total(lambda x: x["distribution"]).alias("__got"))
    ceiling, outlay = F.col("present_value") - F.col("__cost"), F.col("__ask") + F.col("__cost")
    return rows.select(
        key, "scenario", "present_value", ceiling.alias("ceiling"), (ceiling / F.nullif(F.col("__nav").cast("double"), F.lit(0.0))).alias("ceiling_part"),
        (F.col("present_value") - outlay).alias("ask_value"), F.when(outlay + F.col("__calls") > 0, F.col("__got") / (outlay + F.col("__calls"))).alias("multiple"),
        F.when(ceiling <= 0, "negative ceiling").when(F.col("__ask") <= ceiling, "meets hurdle").otherwise("exceeds ceiling").alias("status"),
    )
