import itertools
import math
import random

import numpy as np
import pytest
from fundloom.operators import units
from fundloom.plans import general, registry

LOGS = np.array([0.0, math.log(1000), math.log(1_000_000)])
MODELS = [
    units.Model(LOGS, np.array([0.5, 0.3, 0.2])),
    units.Model(LOGS, np.array([0.5, 0.3, 0.2]), centre=12.0, spread=2.0, jump=0.3, switch=0.2),
    units.Model(LOGS, np.array([0.6, 0.2, 0.2]), centre=12.0, spread=1.0, jump=1.4, switch=0.9),
]


def score(model, values, stated, states):
    """The log chance of a path, written out."""
    s = math.log(model.shares[states[0]])
    if model.spread:
        s -= min(0.5 * ((math.log(values[0]) + LOGS[states[0]] - model.centre) / model.spread) ** 2, units.TAIL / 2)
    for (a, b), (x, y) in zip(itertools.pairwise(values), itertools.pairwise(states)):
        s += math.log((1 - model.switch) * (x == y) + model.switch * model.shares[y])
        la, lb = math.log(a) + LOGS[x], math.log(b) + LOGS[y]
        if model.spread:
            r = min(max(1 - model.jump**2 / (2 * model.spread**2), 0), 0.9999)
            s -= min(0.5 * (lb - model.centre - r * (la - model.centre)) ** 2 / (model.spread**2 * (1 - r * r)), units.TAIL)
        else:
            s -= min(0.5 * ((lb - la) / model.jump) ** 2, units.TAIL)
    for told, state in zip(stated, states, strict=True):
        if told >= 0:
            s += math.log(1 - model.misstated) if told == state else math.log(model.misstated / 2)
    return s


@pytest.mark.parametrize("model", MODELS)
def test_viterbi_against_all_paths(model):
    random.seed(5)
    for _ in range(30):
        n = random.randint(1, 6)
        values = [random.choice([1, 1000, 1e6]) * random.uniform(0.5, 2) for _ in range(n)]
        stated = [random.choice([-1, -1, -1, 0, 1, 2]) for _ in range(n)]
        best = max(score(model, values, stated, p) for p in itertools.product(range(3), repeat=n))
        got = units.viterbi(model, np.log(values), stated)
        assert math.isclose(score(model, values, stated, got), best, abs_tol=1e-9)


def smooth_rows(lengths, told, seed=1):
    rng = np.random.default_rng(seed)
    rows, truth = [], {}
    for dev, n in enumerate(lengths):
        level, unit = 5e6, 0
        for t in range(n):
            level *= math.exp(rng.normal(0, 0.05))
            unit = rng.integers(0, 3) if rng.random() < 0.2 else unit
            name = ("share", "thousand", "million")[unit]
            truth[(dev, t)] = name
            rows.append((f"d{dev}", t, level / math.exp(LOGS[unit]), name if told(t) else None, "count", "junk"))
    return rows, truth


SCHEMA = "dev string, t int, v double, stated string, family string, unit_text string"
FAMILIES = {"count": [("share", 1.0), ("thousand", 1e3), ("million", 1e6)]}


def test_decode_over_partitions(spark):
    rows, truth = smooth_rows([80, 6, 6, 6], lambda t: t % 5 == 0)
    rows += [("d9", 0, None, None, "count", "j"), ("d9", 1, 0.0, "share", "count", "j"), (None, 1, 4.0, "share", "count", "j"), ("d8", 1, 4.0, "share", "odd", "j")]
    df = spark.createDataFrame(rows, SCHEMA)
    out = units.decode(df, ["dev"], ["t"], "v", "stated", FAMILIES, "family").collect()
    assert len(out) == len(rows)
    got = {(int(r["dev"][1:]), r["t"]): r["unit"] for r in out if r["dev"] and r["dev"] not in ("d9", "d8")}
    assert sum(got[k] == v for k, v in truth.items()) >= 0.97 * len(truth)
    rest = {(r["dev"], r["t"]): r["unit"] for r in out}
    assert rest[("d9", 0)] is None and rest[("d9", 1)] == "share" and rest[(None, 1)] == "share" and rest[("d8", 1)] == "share"
    assert units.decode(df.limit(0), ["dev"], ["t"], "v", "stated", FAMILIES, "family").count() == 0


def test_partitions_do_not_change_the_path(spark, monkeypatch):
    rows, _ = smooth_rows([300, 40, 3], lambda t: t % 3 == 0, seed=2)
    df = spark.createDataFrame(rows, SCHEMA)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    found = []
    monkeypatch.setattr(units, "hot_keys", lambda df, keys, share: [("d0",)])
    for parts in ("1", "7"):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        found.append({(r["dev"], r["t"]): r["unit"] for r in units.decode(df, ["dev"], ["t"], "v", "stated", FAMILIES, "family").collect()})
    spark.conf.set("spark.sql.shuffle.partitions", before)
    assert found[0] == found[1]


def test_a_misstated_unit_is_overruled_by_smooth_levels(spark):
    rows = [("d", t, 5e6 * 1.01**t, "share", "count", "j") for t in range(40)]
    rows[20] = ("d", 20, 5e3 * 1.01**20, "share", "count", "j")  # a thousandth, so thousands
    got = {r["t"]: r["unit"] for r in units.decode(spark.createDataFrame(rows, SCHEMA), ["dev"], ["t"], "v", "stated", FAMILIES, "family").collect()}
    assert got[20] == "thousand" and got[19] == got[21] == "share"


def test_rows_of_p4_found_come_from_the_model(spark, monkeypatch):
    d = "/root/testdata/sf0.001"
    whole = registry.queries()["p4_found"](spark, d).count()
    monkeypatch.setattr(units, "decode", lambda df, *a, **k: df.selectExpr("*", "'share' as unit"))
    assert registry.queries()["p4_found"](spark, d).count() < whole / 2


def test_hidden_units_come_back_where_levels_tell_them_apart(spark):
    rows = {(r["field_name"], r["family"]): r for r in general.p4_unit_holdout(spark, "/root/testdata/sf0.01").collect()}
    spreads = rows["spread_bps", "rate"]
    assert spreads["right"] >= 0.9 * spreads["hidden"]
    # levels of quantities and amounts are spread over five decades in every device, so no model can tell near units apart
    quantities = [r for (f, _), r in rows.items() if f == "quantity"]
    assert sum(r["right"] for r in quantities) >= 0.5 * sum(r["hidden"] for r in quantities)


def test_wide_amounts_and_mixed_fractions(spark, tmp_path):
    from pyspark.sql import functions as F

    from fundloom.sources.tables import table

    d = "/root/testdata/sf0.001"
    for name in ("unit_reference", "currency_reference", "quality_source_exceptions"):
        (tmp_path / f"{name}.parquet").symlink_to(f"{d}/{name}.parquet")
    position = table(spark, d, "fund_position").limit(1)
    kind = position.schema["fair_value"].dataType
    position.withColumns({"position_id": F.lit("p"), "fair_value": F.lit("123456789012345678.5").cast(kind), "currency": F.lit("EUR")}).write.parquet(str(tmp_path / "fund_position.parquet"))
    loans = [("a", "L plus 4 3/4 per cent", "475"), ("b", "S plus 8 3/4 per cent", "8.75"), ("c", "S+445", "0.0445"), ("d", "E + 815 bps", "815"), ("e", "PIK", None), ("f", None, None)]
    spark.createDataFrame(loans, "instrument_id string, rate_basis_raw string, s string").selectExpr("instrument_id", "rate_basis_raw", "cast(s as decimal(20,6)) as spread_bps").write.parquet(
        str(tmp_path / "investment_instrument.parquet"))
    rows = {(r["record_id"], r["field_name"]): r["base_value"] for r in registry.queries()["p4_found"](spark, str(tmp_path)).collect()}
    assert rows["p", "fair_value"] == 133827159289382715  # 123456789012345678.5 x 1.084 is ...715.494
    assert rows["b", "spread_bps"] == 875 and rows["c", "spread_bps"] == 445
    assert not {("a", "spread_bps"), ("d", "spread_bps"), ("e", "spread_bps"), ("f", "spread_bps")} & set(rows)


def test_spellings(spark):
    from fundloom.functions.units import currency_code, scale_of, unit_code, unit_words
    from pyspark.sql import functions as F

    df = spark.createDataFrame([("shares (millions)",), ("shs (000)",), ("mm shs",), ("thousand_share",), ("sq. ft.",), ("MT",), ("m³",), ("furlong",), (None,)], "u string")
    got = {r["u"]: r["c"] for r in df.select("u", unit_code(unit_words(F.col("u"))).alias("c")).collect()}
    assert got == {"shares (millions)": "million_share", "shs (000)": "thousand_share", "mm shs": "million_share", "thousand_share": "thousand_share",
                   "sq. ft.": "sq_ft", "MT": "tonne", "m³": "m3", "furlong": None, None: None}
    money = spark.createDataFrame([("GBp",), ("GBP (MM)",), ("U.S. dollars 000",), ("Sfr. k",), ("€ mn",), ("¥",)], "c string")
    got = {r["c"]: (r["code"], r["s"]) for r in money.select("c", currency_code(F.col("c")).alias("code"), scale_of(F.lower("c")).alias("s")).collect()}
    assert got == {"GBp": ("GBX", 1), "GBP (MM)": ("GBP", 1_000_000), "U.S. dollars 000": ("USD", 1_000), "Sfr. k": ("CHF", 1_000), "€ mn": ("EUR", 1_000_000), "¥": ("JPY", 1)}
