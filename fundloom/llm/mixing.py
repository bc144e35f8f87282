"""Mixing sources to target shares by systematic sampling.

Each document of a source is expected so many copies that the source reaches
its share. The expected copies are summed along the source, documents in order of
size, one random offset is added, and a document is emitted once for
each integer that its stretch of the sum crosses. A document with e expected
copies so comes out floor(e) or ceil(e) times, never above the cap, and as every stretch of sizes
is drawn at the same rate the shares hold for tokens, not just documents.

The sum is a two-level prefix sum over range partitions: documents are sorted
by (source, size, hash) over all partitions, however they are distributed, each
partition's sums - one row per partition and source in it - are added up, and
each partition counts on from its own start. So a source, or a size, that holds any share of the rows is
spread over as many partitions as its rows ask for.

Defined results: documents without a source, or of a source without a target,
are not drawn; a source without documents or tokens reaches 0 and does not
lower the others; repeated texts are documents like others.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fundloom.session import checkpoint

#: Copies are counted in billionths: a batch of any copies then fits an integer.
DIGITS, UNIT = 9, 1_000_000_000


def expected_copies(sizes: DataFrame, targets: DataFrame, total_tokens: int | None = None) -> DataFrame:
    """(source, source_tokens, target_share, max_repeats, copies): copies expected of each document of a source.

    Without ``total_tokens`` the mixture is as large as caps allow while all
    shares are met. With it, a source that would exceed its cap stays at it.
    ``targets`` is a fixed table: one row per source.
    """
    have = sizes.groupBy("source").agg(F.sum("tokens").alias("source_tokens"))
    both = targets.join(have, "source", "left").withColumn("source_tokens", F.coalesce("source_tokens", F.lit(0)))
    feasible = F.min(F.when((F.col("source_tokens") > 0) & (F.col("target_share") > 0), F.col("max_repeats") * F.col("source_tokens") / F.col("target_share")))
    total = F.lit(total_tokens).cast("double") if total_tokens is not None else feasible.over(W.partitionBy(F.lit(1))).cast("double")
    copies = F.when(F.col("source_tokens") > 0, F.least(F.col("max_repeats").cast("double"), F.col("target_share").cast("double") * total / F.col("source_tokens")))
    return both.withColumn("copies", F.coalesce(copies, F.lit(0.0)).cast("decimal(18,9)"))


def draw(sizes: DataFrame, key: str, targets: DataFrame, seed: int = 20_260_101, total_tokens: int | None = None) -> DataFrame:
    """(key, source, tokens, copy_no): one row per copy drawn. ``sizes`` has (key, source, tokens)."""
    wanted = expected_copies(sizes, targets, total_tokens).select("source", "copies", "max_repeats")
    parts = int(sizes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["source", "tokens", "__tie", key]
    rows = sizes.join(F.broadcast(wanted), "source").withColumn("__tie", F.xxhash64(key, F.lit(seed + 1)))  # one row per source of the fixed table
    rows = checkpoint(rows.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("__part", F.spark_partition_id()))
    # a row per partition and source in it, so no more than partitions and sources
    sums = rows.groupBy("source", "__part").agg(F.sum((F.col("copies") * UNIT).cast("decimal(38,0)")).alias("s")).collect()
    before: dict[tuple[str, int], int] = {}
    reached = {r["source"]: r["o"] * (UNIT // 1_000_000) for r in wanted.select("source", F.pmod(F.xxhash64(F.lit(seed + 2), "source"), F.lit(1_000_000)).alias("o")).collect()}
    for r in sorted(sums, key=lambda r: (r["source"], r["__part"])):
        before[r["source"], r["__part"]] = reached[r["source"]]
        reached[r["source"]] += int(r["s"])

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """One row per integer that a document's stretch of the sum crosses; partitions come sorted."""
        at: dict[tuple[str, int], int] = dict(before)
        for b in batches:
            t = pa.Table.from_batches([b])
            copies = np.array([int(c.scaleb(DIGITS)) for c in t.column("copies").to_pylist()], dtype=np.int64)
            source, part = np.array(t.column("source").to_pylist(), dtype=object), t.column("__part").to_numpy()
            times = np.zeros(len(copies), dtype=np.int64)
            turns = np.flatnonzero(np.r_[True, source[1:] != source[:-1]]) if len(copies) else np.array([], int)
            for i, j in zip(turns, [*turns[1:], len(copies)], strict=True):
                start = at[source[i], part[i]]
                ends = start % UNIT + np.cumsum(copies[i:j])
                times[i:j] = np.diff(np.r_[0, ends // UNIT])
                at[source[i], part[i]] = start + int(copies[i:j].sum())
            row = np.repeat(np.arange(len(copies)), times)
            first = np.repeat(np.cumsum(times) - times, times)
            out = t.select([key, "source", "tokens"]).take(pa.array(row)).append_column("copy_no", pa.array((np.arange(len(row)) - first + 1).astype(np.int32)))
            yield from out.to_batches()

    schema = rows.select(key, "source", "tokens").withColumn("copy_no", F.lit(1)).schema
    return rows.select(key, "source", "tokens", "copies", "__part").mapInArrow(emit, schema)


def shares(drawn: DataFrame, key: str, targets: DataFrame) -> DataFrame:
    """(source, target_share, documents, copies, most_repeats, tokens, share) reached by each source."""
    per_document = drawn.groupBy("source", key).agg(F.count(F.lit(1)).alias("n"), F.sum("tokens").alias("t"))
    per = per_document.groupBy("source").agg(
        F.count(F.lit(1)).alias("documents"), F.sum("n").alias("copies"), F.max("n").alias("most_repeats"), F.sum("t").alias("tokens")
    )
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return targets.select("source", "target_share").join(per, "source", "left").select(
        "source", "target_share", zero("documents"), zero("copies"), zero("most_repeats"), zero("tokens"),
        F.round(F.coalesce(F.col("tokens") / F.sum("tokens").over(W.partitionBy(F.lit(1))), F.lit(0.0)), 6).alias("share"),
    )
