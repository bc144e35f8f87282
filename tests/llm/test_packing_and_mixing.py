import numpy as np
from fundloom.llm import mixing, packing, tokens
from pyspark.sql import functions as F


def test_pack_keeps_all_limits():
    rng = np.random.default_rng(0)
    t, share = rng.integers(0, 900, 700), rng.random(700)
    loss = np.minimum((t * share).astype(int), 700)
    c = packing.pack(t, loss, 1000, 6, 700)
    for sizes, limit in ((t, 1000), (np.ones_like(t), 6), (loss, 700)):
        assert np.bincount(c, weights=sizes).max() <= limit
    bound = max(t.sum() / 1000, len(t) / 6, loss.sum() / 700)
    assert c.max() + 1 <= 1.1 * bound + 1


def test_containers(spark):
    rows = [(i, "word " * (i % 97) + "\n\n" + "answer " * (i % 53), 1) for i in range(600)] + [(9_001, "long " * 5_000, 1), (9_002, None, 1), (9_003, "", 1)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, tokens int")
    sizes = tokens.measured(df.select("doc_id", "text"), "doc_id", "text")
    placed = packing.containers(sizes, "doc_id", capacity=512, max_segments=8, max_loss=512, shard_items=100).cache()
    per = placed.groupBy("container_id").agg(F.sum("tokens").alias("t"), F.count("*").alias("n"), F.sum("loss").alias("l"))
    assert per.filter("t > 512 or n > 8 or l > 512").count() == 0
    whole = {r["doc_id"]: r["t"] for r in placed.groupBy("doc_id").agg(F.sum("tokens").alias("t")).collect()}
    assert whole == {i: tokens.token_count(t) for i, t, _ in rows}
    assert {r["doc_id"] for r in placed.groupBy("doc_id").count().filter("count > 1").collect()} == {9_001}
    assert packing.report(placed, 512).first()["divided_items"] == -(-tokens.token_count("long " * 5_000) // 512) - 1
    assert packing.containers(sizes.limit(0), "doc_id").count() == 0


def test_no_task_takes_more_than_a_shard(spark):
    equal = spark.range(5_000).selectExpr("id as doc_id", "0L as prompt_tokens", "1300L as answer_tokens")  # two never fit, so no container is ever full
    placed = packing.containers(equal, "doc_id", max_loss=2_048, shard_items=500)
    shards = placed.selectExpr("substring_index(container_id, '-', 2) as s").groupBy("s").count().collect()
    assert placed.count() == 5_000 and placed.select("container_id").distinct().count() == 5_000
    assert len(shards) == 10 and max(r["count"] for r in shards) < 650
    assert {r["s"].split("-")[0] for r in shards} == {"0"}  # a level that gains nothing is the last


def test_limit_on_loss_binds_and_lonely_items_stay_whole(spark):
    df = spark.createDataFrame([(i, 100, 300) for i in range(40)] + [(100, 0, 1_000)], "doc_id bigint, prompt_tokens bigint, answer_tokens bigint")
    placed = packing.containers(df, "doc_id", capacity=1_000, max_segments=8, max_loss=650, shard_items=1_000)
    per = {tuple(r) for r in placed.groupBy("container_id").agg(F.sum("loss"), F.count("*")).select("sum(loss)", "count(1)").distinct().collect()}
    assert per == {(600, 2), (1_000, 1)}
    got = packing.report(placed, 1_000, 8, 650, 0.9).first()
    assert (got["full_loss"], got["full_segments"], got["divided_items"]) == (21, 0, 0)


def test_one_source_of_one_size_is_spread(spark):
    df = spark.range(4_000).selectExpr("id as doc_id", "'only' as source", "100L as tokens")
    targets = spark.createDataFrame([("only", 1.0, 1)], "source string, target_share double, max_repeats int")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    drawn = mixing.draw(df, "doc_id", targets, total_tokens=100_000)
    assert abs(drawn.count() - 1_000) <= 1
    spread_over = drawn.groupBy(F.spark_partition_id()).count().count()
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert spread_over > 1


def test_mixture(spark):
    rng = np.random.default_rng(3)
    rows = [(i, s, int(x)) for i, (s, x) in enumerate((s, x) for s, n in (("big", 4000), ("mid", 900), ("small", 300)) for x in rng.lognormal(5, 1, n))] + [(99_999, None, 50), (99_998, "other", 50)]
    df = spark.createDataFrame(rows, "doc_id bigint, source string, tokens bigint")
    targets = spark.createDataFrame([("big", 0.5, 1), ("mid", 0.3, 3), ("small", 0.2, 4), ("none", 0.0, 2)], "source string, target_share double, max_repeats int")
    drawn = mixing.draw(df, "doc_id", targets)
    got = {r["source"]: r for r in mixing.shares(drawn, "doc_id", targets).collect()}
    for r in got.values():
        assert abs(r["share"] - r["target_share"]) < 0.01 and r["most_repeats"] <= {"big": 1, "mid": 3, "small": 4, "none": 0}[r["source"]]
    copies = {r["source"]: float(r["copies"]) for r in mixing.expected_copies(df, targets).collect()}
    for r in drawn.groupBy("source", "doc_id").count().collect():
        assert abs(r["count"] - copies[r["source"]]) < 1
    assert {tuple(r) for r in drawn.collect()} == {tuple(r) for r in mixing.draw(df.repartition(7), "doc_id", targets).collect()}
    assert mixing.draw(df.limit(0), "doc_id", targets).count() == 0
