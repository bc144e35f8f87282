from fundloom.functions.numbers import plain_text, printed_number
from fundloom.operators import copies, eav
from pyspark.sql import functions as F


def test_differences(spark):
    schema = "k string, v string, w string, extra int"
    a = spark.createDataFrame([("1", "x", "p", 0), ("1", "x", "p", 9), ("2", "x", None, 0), ("3", "x", "p", 0), ("5", "é" * 5000, "", 0)], schema)
    b = spark.createDataFrame([("1", "x", "p", 0), ("2", "y", "", 0), ("4", "x", "p", 0), ("5", "é" * 4999, "", 0)], schema)
    got = {tuple(r) for r in copies.differences(a, b, ["k"], ["v", "w"]).collect()}
    assert got == {("2", "differs", "v"), ("3", "missing_b", ""), ("4", "missing_a", ""), ("5", "differs", "v")}
    one_bucket = {tuple(r) for r in copies.differences(a, b, ["k"], ["v", "w"], buckets=1).collect()}
    assert one_bucket == got
    assert copies.differences(a, a, ["k"], ["v", "w"]).count() == 0
    empty = spark.createDataFrame([], schema)
    assert copies.differences(empty, b, ["k"], ["v", "w"]).filter("diff_kind = 'missing_a'").count() == 4


def test_nearly_equal_copies_move_little(spark):
    rows = spark.range(40_000).selectExpr("cast(id as string) as k", "repeat(md5(cast(id as string)), 4) as v", "'w' as w")
    other = rows.withColumn("v", F.when(F.col("k") == "77", "changed").otherwise(F.col("v")))
    before = set(copies.unequal_cells(rows, other, ["k"], ["v", "w"], 1_250).select("__fields").collect()[0][0])
    assert before == {"v"}
    found = copies.differences(rows, other, ["k"], ["v", "w"])
    assert [tuple(r) for r in found.collect()] == [("77", "differs", "v")]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BroadcastHashJoin") >= 2 and "SortMergeJoin" not in plan.split("Initial Plan")[0].replace("FullOuter", "")  # unequal buckets are few: rows of others stay where they are


def test_repeats_do_not_hide_or_make_differences(spark):
    a = spark.createDataFrame([("1", "x"), ("1", "x"), ("2", "b"), ("2", "a"), ("3", "x"), ("3", "x")], "k string, v string")
    b = spark.createDataFrame([("1", "x"), ("2", "a")], "k string, v string")
    assert {tuple(r) for r in copies.differences(a, b, ["k"], ["v"]).collect()} == {("3", "missing_b", "")}


def test_widen(spark):
    cells = spark.createDataFrame(
        [("e", "m", "1,200", 2), ("e", "m", "n/a", 1), ("e", "t", "b", 1), ("e", "t", "a", 1), ("f", "zzz", "1", 1), (None, "m", "(3)", 1), ("g", "m", None, 1)],
        "entity string, attribute string, value string, priority int",
    )
    readers = {"n": printed_number, "s": lambda c: c}
    wide = eav.widen(cells.withColumn("__pos", F.lit(1)), ["entity"], [("m", "n"), ("t", "s")], readers)
    got = {r["entity"]: (r["m"], r["t"]) for r in wide.collect()}
    assert got["e"] == (None, "a") and got["f"] == (None, None) and got["g"] == (None, None) and int(got[None][0]) == -3
    assert eav.widen(cells.limit(0), ["entity"], [("m", "n"), ("t", "s")], readers).columns == ["entity", "m", "t"]


def test_printed_numbers(spark):
    texts = {"1,234.50": "1234.5", "($ 959.30)": "-959.3", "−609.40": "-609.4", "(9.5)%": "-9.5", "0.37X": "0.37", "2.97 x": "2.97", "(0.03)x": "-0.03", "(0.05) X": "-0.05", "€1": "1", "-": None, "": None,
             "n.m.": None, "12,34": None, "2008-12-28": None, "1e5": None, "007": "7", "100": "100", "0.000": "0", "x": None, "5-": "-5"}
    df = spark.createDataFrame([(k,) for k in texts] + [(None,)], "t string")
    got = {r["t"]: r["n"] for r in df.select("t", plain_text(printed_number(F.col("t"))).alias("n")).collect()}
    assert got == texts | {None: None}
