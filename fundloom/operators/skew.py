"""Joins that survive keys holding a large share of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A key is hot when it holds at least this share of the rows, so there are at most 1/share of them.
HOT_SHARE = 1 / 64


def hot_keys(df: DataFrame, keys: list[str], share: float = HOT_SHARE, least: int = 20_000) -> list[tuple]:
    """Keys holding at least ``share`` of the rows (and ``least`` rows): at most 1/share of them.

    Counts are pre-aggregated before the shuffle. Null keys never join and are left out.
    """
    counts = df.dropna(subset=keys).groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    top = counts.orderBy(F.desc("__n")).limit(int(1 / share)).collect()
    total_at_least = sum(r["__n"] for r in top)
    if not top or top[0]["__n"] < least:
        return []
    total = max(total_at_least, df.count())
    return [tuple(r[k] for k in keys) for r in top if r["__n"] >= max(least, share * total)]


def matches(keys: list[str], hot: list[tuple]) -> Column:
    """Whether the row's key is one of ``hot``."""
    if not hot:
        return F.lit(False)
    if len(keys) == 1:
        return F.coalesce(F.col(keys[0]).isin([h[0] for h in hot]), F.lit(False))
    packed = F.struct(*[F.col(k) for k in keys])
    return F.coalesce(packed.isin([F.struct(*[F.lit(v) for v in h]) for h in hot]), F.lit(False))


def join_unique(left: DataFrame, right: DataFrame, keys: list[str], how: str, hot: list[tuple]) -> DataFrame:
    """``left`` joined to ``right``, which has one row per key.

    Rows of a hot key stay where they are and meet a broadcast of the hot keys'
    rows of ``right`` - one row each, so at most ``len(hot)``; all others shuffle.
    """
    if not hot:
        return left.join(right, keys, how)
    is_hot = matches(keys, hot)
    return (
        left.filter(~is_hot).join(right, keys, how)
        .unionByName(left.filter(is_hot).join(F.broadcast(right.filter(is_hot)), keys, how))
    )
