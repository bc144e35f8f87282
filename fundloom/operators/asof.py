"""As-of joins: the latest right row on or before each left row."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def join_asof(
    left: DataFrame, right: DataFrame, by: list[str], left_time: str, right_time: str, values: list[str],
    strict: bool = False, tolerance: int | None = None,
) -> DataFrame:
    """``left`` with ``values`` and ``right_time`` of the latest right row of the same ``by`` keys.

    Both sides are tagged, united and sorted once per key - one shuffle on
    ``by`` - and the last right row is carried forward. ``strict`` takes only
    earlier rows; ``tolerance`` (in units of integer times, days of dates)
    refuses older ones. Without a match the values are null. Of right rows of
    one time the largest (by values) counts.
    """
    packed = F.struct(F.col(right_time).alias("__t"), *[F.col(v) for v in values])
    r = right.filter(F.col(right_time).isNotNull()).groupBy(*by, right_time).agg(F.max(F.struct(*values)).alias("__m"))
    r = r.select(*by, F.col(right_time).alias("__at"), F.lit(1 if strict else 0).alias("__side"), F.struct(F.col(right_time).alias("__t"), *[F.col("__m")[v].alias(v) for v in values]).alias("__r"), *[
        F.lit(None).cast(left.schema[c].dataType).alias(c) for c in left.columns if c not in by
    ])
    rows = left.select(
        *by, F.col(left_time).alias("__at"), F.lit(0 if strict else 1).alias("__side"), F.lit(None).cast(right.select(packed.alias("x")).schema["x"].dataType).alias("__r"),
        *[c for c in left.columns if c not in by],
    ).withColumn("__left", F.lit(True))
    both = rows.unionByName(r.withColumn("__left", F.lit(False)))
    carried = F.last("__r", ignorenulls=True).over(W.partitionBy(*by).orderBy("__at", "__side").rowsBetween(W.unboundedPreceding, 0))
    out = both.withColumn("__hit", carried).filter("__left")
    if tolerance is not None:
        age = F.datediff(F.col(left_time), F.col("__hit.__t")) if dict(left.dtypes)[left_time] in ("date", "timestamp") else F.col(left_time) - F.col("__hit.__t")
        out = out.withColumn("__hit", F.when(age <= tolerance, F.col("__hit")))
    return out.select(*left.columns, F.col("__hit.__t").alias(right_time), *[F.col("__hit")[v].alias(v) for v in values])
