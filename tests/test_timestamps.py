import datetime as dt
import random
import zoneinfo

from fundloom.operators import timestamps, zones
from pyspark.sql import functions as F

CASES = {
    "as at 31 March 2015": "2015-03-31", "30-SEP-15": "2015-09-30", "Jun-15": "2015-06", "Mar. 2015": "2015-03", "1Q15": "2015-Q1", "2015 Q1": "2015-Q1",
    "Fourth quarter 2015": "2015-Q4", "FY15": "2015", "Year 2015": "2015", "11/2015": "2015-11", "20150217": "2015-02-17", "1421124448": "2015-01-13T04:47:28Z",
    "1427589240928": "2015-03-29T00:34:00Z", "Saturday, 31 DECEMBER 2016": "2016-12-31", "28JUL2030": "2030-07-28", "Due 16 May 2034": "2034-05-16", "matures Mar 23, 2027": "2027-03-23",
    "30.09.2015": "2015-09-30", "12/31/2015": "2015-12-31", "31/12/2015": "2015-12-31", "4/5/2015": None, "31 Feb 2020": None, "TBD": None, "": None, "2015-13-01": None,
    "2021-09-30 19:12:34 America/New_York": "2021-09-30T23:12:34Z", "30 Jun 2015 2:27 AM SGT": "2015-06-29T18:27:00Z", "2015-06-30T16:13:04.9-05:00": "2015-06-30T21:13:04Z",
    "2015-10-25T02:13:48[Europe/Berlin]": "2015-10-25T00:13:48Z", "2015-03-29T02:39[Europe/Berlin]": None, "2015-09-30  ": "2015-09-30", "2016-12-03T25:00:00Z": None,
    "31 Dec 2015 12:04:05 AM GMT": "2015-12-31T00:04:05Z", "2015-06-30 10:00 XYZ": None, "x" * 50_000: None,
}


def test_forms(spark):
    df = spark.createDataFrame([(k,) for k in CASES] + [(None,)], "raw string")
    offsets = zones.offset_table(spark, ["America/New_York", "Europe/Berlin", "no/zone"])
    got = {r["raw"]: r["normal_form"] for r in timestamps.normalise(df, "raw", offsets).collect()}
    assert got == CASES | {None: None}
    ordered = timestamps.normalise(spark.createDataFrame([("4/5/2015", "MDY"), ("4/5/2015", "DMY")], "raw string, o string"), "raw", offsets, F.col("o"))
    assert {r["normal_form"] for r in ordered.collect()} == {"2015-04-05", "2015-05-04"}


def test_local_times_against_the_zone_database(spark):
    random.seed(7)
    names = ["Europe/London", "America/Chicago", "Asia/Tokyo"]
    rows = []
    for _ in range(400):
        z = random.choice(names)
        day = random.choice([dt.datetime(2019, 3, 31), dt.datetime(2019, 3, 10), dt.datetime(2019, 10, 27), dt.datetime(2019, 11, 3), dt.datetime(2019, 7, 1)])
        rows.append((f"{day + dt.timedelta(minutes=random.randrange(0, 240)):%Y-%m-%d %H:%M:%S}", z))
    df = spark.createDataFrame(rows, "raw string, z string")
    out = timestamps.normalise(df, "raw", zones.offset_table(spark, names), None, F.col("z")).collect()
    for r in out:
        t, z = dt.datetime.fromisoformat(r["raw"]), zoneinfo.ZoneInfo(r["z"])
        utc = t.replace(tzinfo=z, fold=0).astimezone(dt.timezone.utc)
        want = f"{utc:%Y-%m-%dT%H:%M:%SZ}" if utc.astimezone(z).replace(tzinfo=None) == t else None
        assert r["normal_form"] == want


def test_any_year_any_zone_and_how_it_was_reached(spark):
    cases = {
        "1950-07-01 12:00 America/New_York": ("1950-07-01T16:00:00Z", "instant"), "2150-01-15 12:00 Europe/Berlin": ("2150-01-15T11:00:00Z", "instant"), "2300-01-15 12:00 Europe/Berlin": ("2300-01-15T11:00:00Z", "instant"),
        "1850-01-15 12:00 UTC": ("1850-01-15T12:00:00Z", "instant"), "2015-06-30 10:00 Asia/Kolkata": ("2015-06-30T04:30:00Z", "instant"), "2015-06-30 10:00 America/Toronto": ("2015-06-30T14:00:00Z", "instant"),
        "2015-10-25 02:30 Europe/Berlin": ("2015-10-25T00:30:00Z", "first of two"), "2015-03-29 02:30 Europe/Berlin": (None, "never occurs"), "2015-03-29 02:30 Middle/Earth": (None, "unknown zone"),
        "30 June 2015": ("2015-06-30", "date"), "1421124448": ("2015-01-13T04:47:28Z", "instant"), "TBD": (None, "unreadable"), "31 Feb 2015": (None, "unreadable"), " ": (None, None),
    }
    df = spark.createDataFrame([(k,) for k in cases] + [(None,)], "raw string")
    named = zones.named_zones(df, "raw")
    assert {"asia/kolkata", "america/toronto", "europe/berlin"} <= set(named) and "middle/earth" not in named
    got = {r["raw"]: (r["normal_form"], r["normal_form_status"]) for r in timestamps.normalise(df, "raw", zones.offset_table(spark, ["UTC", *named])).collect()}
    assert got == cases | {None: (None, None)}
