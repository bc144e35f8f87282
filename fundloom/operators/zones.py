"""Zone-offset intervals and the as-of join of local times to them."""

from __future__ import annotations

import datetime as dt
import functools
import zoneinfo

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Offsets in minutes of the zone abbreviations in use.
ABBREVIATIONS = {
    "z": 0, "utc": 0, "gmt": 0, "wet": 0, "bst": 60, "west": 60, "cet": 60, "cest": 120, "eet": 120, "eest": 180,
    "est": -300, "edt": -240, "cst": -360, "cdt": -300, "mst": -420, "mdt": -360, "pst": -480, "pdt": -420,
    "jst": 540, "sgt": 480, "hkt": 480,
}
#: Years for which intervals are built; the first reaches back and the last on without end.
FIRST_YEAR, LAST_YEAR = 1900, 2199
EVER = 1 << 60


@functools.cache
def _intervals(zone: str, first: int, last: int) -> list[tuple[int, int, int]]:
    """(local start, local end, offset) in seconds of each stretch of one offset, from the public time zone database."""
    tz, day = zoneinfo.ZoneInfo(zone), 86_400
    epoch = lambda y: int(dt.datetime(y, 1, 1, tzinfo=dt.timezone.utc).timestamp())
    at = lambda t: int(dt.datetime.fromtimestamp(t, tz).utcoffset().total_seconds())
    begin, end = epoch(first) - 2 * day, epoch(last + 1) + 2 * day
    out, start, offset, t = [], begin, at(begin), begin
    while t < end:
        nxt = min(t + 7 * day, end)
        if at(nxt) != offset:
            low, high = t, nxt
            while high - low > 1:
                mid = (low + high) // 2
                low, high = (mid, high) if at(mid) == offset else (low, mid)
            out.append((start + offset, high + offset, offset))
            start, offset, nxt = high, at(high), high
        t = nxt
    out.append((start + offset, EVER, offset))
    out[0] = (-EVER, *out[0][1:])
    return out


def offset_table(spark: SparkSession, zones: list[str], first: int = FIRST_YEAR, last: int = LAST_YEAR) -> DataFrame:
    """(zone, year, spans): per lower-case zone and local year the intervals that touch it.

    One row per zone and year, at most 600 zones in the time zone database: a
    proven bound for a broadcast. Unknown names have no row.
    """
    known = {z.lower(): z for z in zoneinfo.available_timezones()}
    rows = []
    for zone in sorted({z.lower() for z in zones if z and z.lower() in known}):
        spans = _intervals(known[zone], first, last)
        for year in range(first, last + 1):
            a = int(dt.datetime(year, 1, 1, tzinfo=dt.timezone.utc).timestamp())
            b = int(dt.datetime(year + 1, 1, 1, tzinfo=dt.timezone.utc).timestamp())
            rows.append((zone, year, [s for s in spans if s[0] < b and s[1] > a]))
    return spark.createDataFrame(rows, "zone string, year int, spans array<struct<begin:bigint,end:bigint,offset:int>>")


def named_zones(texts: DataFrame, text: str) -> list[str]:
    """The zones of the time zone database that texts name in full: at most as many as it has."""
    known = texts.sparkSession.createDataFrame([(z.lower(),) for z in sorted(zoneinfo.available_timezones())], "zone string")
    said = texts.filter(F.col(text).contains("/")).select(F.explode(F.regexp_extract_all(F.lower(F.col(text)), F.lit(r"([a-z_]+(?:/[a-z0-9_+-]+)+)"), 1)).alias("zone"))
    return sorted(r["zone"] for r in said.groupBy("zone").agg(F.count(F.lit(1))).join(F.broadcast(known), "zone", "left_semi").select("zone").collect())


def with_offset(df: DataFrame, offsets: DataFrame, zone: str, year: str, local: str, out: str = "__offset") -> DataFrame:
    """``df`` with the offset in seconds of its local time (seconds since 1970 on the local clock), and in ``__spans`` the number of intervals it lies in.

    One matching interval gives the offset. Two mean the time occurs twice; the
    first of the two instants has the larger offset. None means the time never
    occurs: null. A zone that is not known has a null number.
    """
    held = F.greatest(F.least(F.col(year), F.lit(LAST_YEAR)), F.lit(FIRST_YEAR))
    joined = df.withColumn("__held", held).join(
        F.broadcast(offsets.select(F.col("zone").alias(zone), F.col("year").alias("__held"), F.col("spans").alias("__all"))), [zone, "__held"], "left"
    )
    hits = F.filter("__all", lambda s: (s["begin"] <= F.col(local)) & (F.col(local) < s["end"]))
    found = joined.withColumn("__hits", hits).withColumns({out: F.array_max(F.transform("__hits", lambda s: s["offset"])), "__spans": F.when(F.col("__hits").isNotNull(), F.size("__hits"))})
    return found.drop("__all", "__hits", "__held")
