import datetime as dt
import random
from decimal import Decimal

import numpy as np
import pytest
from fundloom.functions import finance, printed_values
from fundloom.operators import market, order_statistics, performance, weights
from pyspark.sql import functions as F


def test_newton_finds_the_root():
    rng = np.random.default_rng(4)
    for _ in range(200):
        days = np.sort(rng.integers(0, 4000, 12)).astype(float)
        amounts = np.r_[-rng.uniform(10, 100, 5), rng.uniform(1, 120, 7)]
        r = finance.solve(days, amounts)
        value = float(np.sum(amounts * (1 + r) ** -((days - days[0]) / 365)))
        assert abs(value) < 1e-6 * np.abs(amounts).sum()
    assert finance.solve(np.array([0.0, 365.0]), np.array([-100.0, 110.0])) == pytest.approx(0.1, abs=1e-10)
    assert finance.solve(np.array([0.0, 1.0]), np.array([1.0, 2.0])) is None


def test_bounded_weights():
    got = weights.bounded_equal({"a": (Decimal("0.5"), Decimal(1)), "b": (Decimal(0), Decimal("0.1")), "c": (Decimal(0), Decimal(1))})
    assert got == {"a": Decimal("0.5"), "b": Decimal("0.1"), "c": Decimal("0.4")}
    assert weights.bounded_equal({k: (Decimal(0), Decimal(1)) for k in "abc"})["a"] == Decimal("0.3333333334")
    random.seed(2)
    for _ in range(200):
        n = random.randint(1, 9)
        bounds = {str(i): tuple(sorted((Decimal(random.randint(0, 10**9)) / 10**9, Decimal(random.randint(0, 10**9)) / 10**9))) for i in range(n)}
        if sum(a for a, _ in bounds.values()) > 1 or sum(b for _, b in bounds.values()) < 1:
            with pytest.raises(ValueError):
                weights.bounded_equal(bounds)
            continue
        w = weights.bounded_equal(bounds)
        assert sum(w.values()) == 1 and all(bounds[k][0] <= v <= bounds[k][1] for k, v in w.items())


def test_printed_values(spark):
    cases = {
        "": ("empty", None, "", ""), "(12.5)%": ("percent", -12.5, "negative", ""), "1.85x": ("multiple", 1.85, "positive", ""), "€ 1,200": ("money", 1200.0, "positive", "EUR"),
        "USD (5.0)": ("money", -5.0, "negative", "USD"), "n.m.": ("text", None, "", ""), "−7": ("number", -7.0, "negative", ""), "C$3": ("money", 3.0, "positive", "CAD"),
    }
    df = spark.createDataFrame([(k,) for k in cases] + [(None,)], "t string")
    got = {r["t"]: (r["v"]["kind"], None if r["v"]["number"] is None else float(r["v"]["number"]), r["v"]["sign"], r["v"]["currency"]) for r in df.select("t", printed_values.value_parts(F.col("t")).alias("v")).collect()}
    assert got == cases | {None: cases[""]}
    halves = {"$90.5": 50_000.0, "1.05x": 0.005, "22,909,961": 0.5, "none": None}
    h = spark.createDataFrame([(k,) for k in halves], "t string").select("t", printed_values.half_unit(F.col("t"), F.when(F.col("t") == "$90.5", 1_000_000)).alias("h"))
    assert {r["t"]: r["h"] for r in h.collect()} == halves


def test_printed_dates(spark):
    cases = {
        "31/12/2020": ("2020-12-31", "day"), "12/31/2020": ("2020-12-31", "day"), "Friday, 5 June 2020.": ("2020-06-05", "day"), "Sept. 3, 2020": ("2020-09-03", "day"), "Feb 2020": ("2020-02-29", "month"),
        "FY21": ("2021-12-31", "year"), "2019": ("2019-12-31", "year"), "soon": (None, "unknown"), "": (None, ""), "5/5/2020": ("2020-05-05", "day"), "31 Feb 2020": (None, "unknown"),
    }
    df = spark.createDataFrame([(k,) for k in cases] + [(None,)], "t string").select("t", printed_values.dated(F.col("t")).alias("v"))
    assert {r["t"]: (r["v"]["date"] and r["v"]["date"].isoformat(), r["v"]["precision"]) for r in df.collect()} == cases | {None: (None, "")}
    open_ = spark.createDataFrame([("4/5/2020",)], "t string")
    with pytest.raises(Exception, match="ambiguous date"):
        open_.select(printed_values.dated(F.col("t"))).collect()
    assert open_.select(printed_values.dated(F.col("t"), ambiguous="unknown").alias("v")).first()["v"]["precision"] == "unknown"
    assert open_.select(printed_values.dated(F.col("t"), F.lit("DMY")).alias("v")).first()["v"]["date"] == dt.date(2020, 5, 4)


def test_market_equivalent_by_hand(spark):
    day = dt.date
    flows = spark.createDataFrame([("a", day(2020, 1, 1), -100.0), ("a", day(2021, 1, 1), 60.0), ("b", day(2019, 1, 1), -10.0), ("c", day(2021, 1, 1), 5.0), ("d", day(2020, 1, 1), -1.0)], "position string, d date, amount double")
    periods = spark.createDataFrame([("a", day(2021, 12, 31), 55.0), ("b", day(2021, 12, 31), 1.0), ("c", day(2021, 12, 31), 1.0), ("d", day(2022, 6, 1), 1.0)], "position string, as_of date, nav double")
    series = spark.createDataFrame([(day(2020, 1, 1), 100.0), (day(2020, 12, 31), 110.0), (day(2021, 12, 31), 121.0)], "d date, level double")
    got = {r["position"]: r for r in performance.market_equivalent(flows, periods, series).collect()}
    assert got["a"]["ks_pme"] == pytest.approx((60 / 110 + 55 / 121) / (100 / 100))
    assert [x["amount"] for x in got["a"]["flows"]] == pytest.approx([-121.0, 66.0, 55.0])
    assert {k: r["status"] for k, r in got.items()} == {"a": "ok", "b": "series starts late", "c": "no contribution", "d": "ok"}
    weekly = spark.createDataFrame([(day(2020, 1, 1) + dt.timedelta(7 * i), 100.0 + i) for i in range(20)], "d date, level double")
    assert performance.market_equivalent(flows.filter("position = 'd'"), periods.filter("position = 'd'"), weekly).first()["status"] == "series ends"


def test_ridge_against_numpy(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(300, 3)) * [1, 50, 0.1] + [5, -3, 2]
    y = x @ [2.0, -0.1, 7.0] + rng.normal(size=300)
    df = spark.createDataFrame([(*map(float, a), float(b)) for a, b in zip(x, y)] + [(None, 1.0, 1.0, 1.0)], "a double, b double, c double, y double")
    scales, beta = market.fit(df, ["a", "b", "c"], "y", 2.5)
    z = (x - x.mean(axis=0)) / x.std(axis=0)
    design = np.column_stack([np.ones(300), z])
    want = np.linalg.solve(design.T @ design + np.diag([0, 2.5, 2.5, 2.5]), design.T @ y)
    assert np.allclose(beta, want, rtol=1e-6)
    got = [r["prediction"] for r in market.predicted(df.dropna(), scales, beta).orderBy("a").collect()]
    assert np.allclose(got, (design @ want)[np.argsort(x[:, 0])], rtol=1e-6)


def test_order_statistics(spark):
    rng = np.random.default_rng(5)
    rows = [(["a", "b", None][i % 3], None if i % 11 == 0 else float(rng.integers(0, 40))) for i in range(500)] + [("one", 3.0), ("none", None)]
    df = spark.createDataFrame(rows, "g string, v double")
    got = {r["g"]: (r["n"], r["q1"], r["q5"], r["q10"]) for r in order_statistics.quantiles(df, ["g"], "v", {"q1": 0.1, "q5": 0.5, "q10": 1.0}).collect()}
    for g in ("a", "b", None, "one"):
        v = [x for k, x in rows if k == g and x is not None]
        assert got[g][0] == len(v) and np.allclose(got[g][1:], np.quantile(v, [0.1, 0.5, 1.0]))
    assert "none" not in got
    places = order_statistics.numbered(df, ["g"], ["v"], total="n").collect()
    assert all(sorted(r["position"] for r in places if r["g"] == g) == list(range(1, 1 + sum(k == g for k, _ in rows))) for g in ("a", None, "one"))


def test_percentiles_among_other_owners(spark):
    from fundloom.operators.relational import midpoint_percentile

    rng = np.random.default_rng(6)
    rows = [(i, ["a", None][i % 2], ["m", "n", None][int(rng.integers(0, 3))], None if i % 13 == 0 else float(rng.integers(0, 9))) for i in range(200)] + [(900, "alone", "m", 1.0)]
    df = spark.createDataFrame(rows, "id int, g string, o string, v double")
    got = {r["id"]: (r["peers"], r["percentile"]) for r in midpoint_percentile(df, ["g"], "o", "v").collect()}
    assert set(got) == {i for i, _, _, v in rows if v is not None} and got[900] == (0, None)
    for i, g, o, v in rows:
        if v is not None and i != 900:
            peers = [x for _, h, q, x in rows if h == g and q != o and x is not None]
            assert got[i][0] == len(peers) and got[i][1] == pytest.approx(100 * (sum(x < v for x in peers) + 0.5 * sum(x == v for x in peers)) / len(peers))
