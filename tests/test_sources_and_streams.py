import pytest
from fundloom.functions import finance
from fundloom.operators import components, skew
from fundloom.plans import reference
from fundloom.sources import files
from fundloom.streaming import windows

DIR = "/root/testdata/sf0.001"


def test_csv_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("1", 'a "quoted", line\nbreak', None), ("2", "é", "3.5")], "id string, text string, value string")
    files.write_csv(df, str(tmp_path / "out"))
    back = files.read_csv(spark, str(tmp_path / "out"), ("id", "value"))
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))
    assert [tuple(r) for r in files.typed(back, {"id": "int", "value": "double"}).orderBy("id").collect()] == [(1, None), (2, 3.5)]
    with pytest.raises(ValueError, match="missing columns: nope"):
        files.read_csv(spark, str(tmp_path / "out"), ("nope",))


def test_byte_order_mark_and_pages(spark, tmp_path):
    (tmp_path / "bom.csv").write_text("﻿a,b\n1,\n", encoding="utf-8")
    assert [tuple(r) for r in files.read_csv(spark, str(tmp_path / "bom.csv"), ("a",)).collect()] == [("1", None)]
    (tmp_path / "doc.txt").write_text("head\n=== PAGE 1 ===\none\n=== PAGE 2 ===\ntwo\nlines\n")
    assert [(r["page"], r["text"].strip()) for r in files.read_pages(spark, str(tmp_path / "doc.txt")).orderBy("page").collect()] == [(1, "one"), (2, "two\nlines")]


def test_manifest(spark):
    assert [tuple(r) for r in files.manifest({"b": spark.range(3), "a": spark.range(0)}).orderBy("name").collect()] == [("a", 0), ("b", 3)]


def test_stream_agrees_with_batch(spark, tmp_path):
    events = spark.read.parquet(f"{DIR}/events.parquet")
    events.repartition(3).write.parquet(str(tmp_path / "in"))
    stream = windows.stream_hourly(spark, str(tmp_path / "in"), events.schema, "1000 days")
    q = stream.writeStream.outputMode("complete").format("memory").queryName("hourly").option("checkpointLocation", str(tmp_path / "cp")).start()
    q.processAllAvailable()
    q.stop()
    got = {(r["window"]["start"], r["event_type"], r["n"]) for r in spark.sql("select * from hourly").collect()}
    assert got == {(r["window"]["start"], r["event_type"], r["n"]) for r in windows.hourly(events).collect()}


def test_xirr_is_a_root(spark):
    flows = finance.dated_flows(reference.flows(spark, DIR), ["position"], "d", "amount")
    rates = finance.with_xirr(flows, "flows").collect()
    assert any(r["xirr"] is not None for r in rates)
    for r in rates:
        amounts = [x["amount"] for x in r["flows"]]
        if r["xirr"] is not None:
            t0 = r["flows"][0]["date"]
            value = sum(x["amount"] / (1 + r["xirr"]) ** ((x["date"] - t0).days / 365) for x in r["flows"])
            assert abs(value) < 1e-3 * max(map(abs, amounts))
        elif len(amounts) > 1:
            assert min(amounts) >= 0 or max(amounts) <= 0 or len(set(amounts)) >= 1


def test_components(spark):
    links = [("a", "b"), ("c", "b"), ("d", "e"), ("x", "x"), (None, "a"), *[(f"n{i:02}", f"n{i + 1:02}") for i in range(40)]]
    got = {r["node"]: r["label"] for r in components.components(spark.createDataFrame(links, "a string, b string")).collect()}
    assert got == {"a": "a", "b": "a", "c": "a", "d": "d", "e": "d"} | {f"n{i:02}": "n00" for i in range(41)}


def test_hot_keys_take_the_broadcast_branch(spark):
    left = spark.createDataFrame([("h", i) for i in range(200)] + [(f"k{i}", i) for i in range(50)] + [(None, 1)], "k string, v int")
    right = spark.createDataFrame([("h", "x"), ("k1", "y")], "k string, w string")
    hot = skew.hot_keys(left, ["k"], least=100)
    assert hot == [("h",)]
    plain = sorted(map(tuple, left.join(right, "k", "left").collect()), key=repr)
    assert sorted(map(tuple, skew.join_unique(left, right, ["k"], "left", hot).select("k", "v", "w").collect()), key=repr) == plain
