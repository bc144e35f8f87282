import random

import pytest
from fundloom.operators import evidence, review
from pyspark.sql import functions as F


def test_paragraphs_keep_every_word():
    random.seed(1)
    for _ in range(60):
        text = "".join(random.choice(["word ", "x" * 90 + " ", "\n", "\n\n", "Note 1 ", "(2) "]) for _ in range(random.randint(0, 120)))
        parts = evidence.split_paragraphs(text, 200)
        assert all(0 < len(p) <= 200 for p in parts)
        assert "".join("".join(parts).split()) == "".join(text.split())
    assert evidence.split_paragraphs("a\nNote 1 b\nc\n\nd") == ["a", "Note 1 b\nc", "d"]


def test_rules_that_disagree_are_an_error(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "x string")
    rules = [(1, {"x": "/^a/"}, "one"), (1, {"x": "a"}, "two"), (2, {"x": "*"}, "rest")]
    assert {r["o"] for r in df.filter("x = 'b' or x is null").select(review.rule_outcome(rules).alias("o")).collect()} == {"rest"}
    with pytest.raises(Exception, match="disagree"):
        df.select(review.rule_outcome(rules)).collect()
    with pytest.raises(Exception, match="no colour"):
        df.select(review.required({"a": "1", "b": "2"}, F.col("x"), "colour")).collect()


def test_cycles_against_reachability(spark):
    random.seed(3)
    for n in (0, 8, 14):
        edges = [(random.randrange(9), random.randrange(9)) for _ in range(n)]
        reach = {(a, b) for a, b in edges}
        while True:
            more = reach | {(a, d) for a, b in reach for c, d in reach if b == c}
            if more == reach:
                break
            reach = more
        df = spark.createDataFrame(edges + [(None, 1)], "a int, b int")
        assert {r["node"] for r in review.on_cycles(df).collect()} == {a for a, b in reach if a == b}


def test_empty_tables(spark):
    e = spark.createDataFrame([], "k string, v string, r int")
    assert evidence.paragraphs(e, "k", "v").count() == 0
    assert review.binding(e, ["k"], "r", "v").count() == 0
    assert review.detection(e, e, "k", "v").count() == 0
