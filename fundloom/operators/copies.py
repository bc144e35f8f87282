"""Differences between two copies of a table by a column-by-bucket checksum matrix.

Both sides are scanned once as they are and reduced, with map-side combine, to
one row per key bucket holding for each column the sums of wide hashes of
(key, value). Sums are additive, so row order and partitioning do not matter
and equal cells give equal sums; only these sums are shuffled. A repeated row
counts as often as it occurs, so it can make a bucket unequal but not hide a
difference. Only buckets with an unequal cell are read again and joined, repeats
are settled there, and only their unequal columns are compared.

Defined results:
* rows are matched by the prepared key columns; a row repeated with the same
  key and values counts once, and of rows repeated with other values the
  smallest (by values, in byte order) stands for its key;
* compared values must be prepared as strings; null and empty are equal;
* an empty side reports every row of the other as missing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundloom.session import written


#: Rows that share a bucket: the matrix has so many times fewer rows than the table.
BUCKET_ROWS = 32


def checksums(df: DataFrame, keys: list[str], fields: list[str], buckets: int) -> DataFrame:
    """One row per bucket: the sums of 64-bit hashes, in halves that can't overflow, of the keys and of each field with the keys."""
    low = lambda h: F.sum(h.bitwiseAND(F.lit(0xFFFFFFFF)))
    high = lambda h: F.sum(F.shiftrightunsigned(h, 32))
    sums = []
    for i, f in enumerate(["__rows", *fields]):
        values = [] if i == 0 else [F.coalesce(F.col(f), F.lit(""))]
        h = F.xxhash64(F.lit(i), *keys, *values)
        sums += [low(h).alias(f"{f}__1"), high(h).alias(f"{f}__2"), low(F.xxhash64(F.lit(-i), *values, *keys)).alias(f"{f}__3")]
    return df.groupBy(bucket_of(keys, buckets).alias("__bucket")).agg(*sums)


def bucket_of(keys: list[str], buckets: int):
    return F.pmod(F.xxhash64(F.lit(7), *keys), F.lit(buckets))


def unequal_cells(a: DataFrame, b: DataFrame, keys: list[str], fields: list[str], buckets: int) -> DataFrame:
    """(__bucket, __fields): buckets with an unequal cell and the array of unequal fields."""
    x, y = checksums(a, keys, fields, buckets).alias("x"), checksums(b, keys, fields, buckets).alias("y")
    joined = x.join(y, F.col("x.__bucket") == F.col("y.__bucket"), "full_outer")
    same = lambda c: F.col(f"x.{c}").eqNullSafe(F.col(f"y.{c}"))
    names = [F.when(~(same(f"{f}__1") & same(f"{f}__2") & same(f"{f}__3")), F.lit(f)) for f in ["__rows", *fields]]
    return joined.select(
        F.coalesce("x.__bucket", "y.__bucket").alias("__bucket"), F.array_compact(F.array(*names)).alias("__fields")
    ).filter(F.size("__fields") > 0)


def differences(
    a: DataFrame, b: DataFrame, keys: list[str], fields: list[str], rows_per_bucket: int = BUCKET_ROWS, buckets: int | None = None
) -> DataFrame:
    """(*keys, diff_kind, field_name) with diff_kind ``missing_a``, ``missing_b`` or ``differs``.

    ``rows_per_bucket`` sets how finely unequal rows are located: the number of
    buckets grows with the rows, so that a bucket stays a few rows at any size.
    """
    buckets = buckets or max(16, a.count() // rows_per_bucket)
    # written, so that its size is known: few unequal buckets are broadcast, and then no other row moves
    cells = written(unequal_cells(a, b, keys, fields, buckets))

    def side(df: DataFrame, tag: str) -> DataFrame:
        tagged = df.withColumn("__bucket", bucket_of(keys, buckets)).join(cells, "__bucket")
        return tagged.select(*keys, F.lit(tag).alias("__side"), F.struct(*[F.coalesce(F.col(f), F.lit("")).alias(f) for f in fields]).alias("__v"), "__fields")

    pairs = side(a, "a").unionByName(side(b, "b")).groupBy(*keys).agg(
        F.min(F.when(F.col("__side") == "a", F.col("__v"))).alias("va"), F.min(F.when(F.col("__side") == "b", F.col("__v"))).alias("vb"),
        F.first("__fields").alias("__fields"),
    )
    differing = F.array_compact(F.array(*[
        F.when(F.array_contains("__fields", f) & (F.col("va")[f] != F.col("vb")[f]), F.lit(f)) for f in fields
    ]))
    kinds = F.when(F.col("va").isNull(), F.array(F.struct(F.lit("missing_a").alias("k"), F.lit("").alias("f")))).when(
        F.col("vb").isNull(), F.array(F.struct(F.lit("missing_b").alias("k"), F.lit("").alias("f")))
    ).otherwise(F.transform(differing, lambda f: F.struct(F.lit("differs").alias("k"), f.alias("f"))))
    return pairs.select(*keys, F.explode(kinds).alias("d")).select(
        *keys, F.col("d.k").alias("diff_kind"), F.col("d.f").alias("field_name")
    )
