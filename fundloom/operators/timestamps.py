"""Printed dates and times of many layouts, precisions and zones in one unambiguous form.

Normal forms: ``YYYY-MM-DD``, ``YYYY-MM``, ``YYYY-Qn``, ``YYYY`` and, with a
time of day, ``YYYY-MM-DDTHH:MM:SSZ`` in UTC with fractions cut off.

Defined results:
* null, blank and unreadable texts, days that don't exist, local times that
  never occur, and unknown zones give null;
* a local time that occurs twice and carries no offset is the first of the two;
* a slashed date whose order is not given is read only if one part exceeds 12;
* rows are kept one for one, repeated rows included;
* a second column tells how a form was reached: ``date``, ``instant`` (a stated
  offset or one matching interval), ``first of two``, ``never occurs``,
  ``unknown zone``, ``unreadable``; null for a null or blank text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fundloom.functions.printed_dates import MONTH_NAME, month_number
from fundloom.functions.text import squeeze
from fundloom.operators.zones import ABBREVIATIONS, with_offset

#: Words that may stand before a date.
LEAD = r"^(?:as at|as of|due|matures|maturing|year|(?:mon|tue|tues|wed|wednes|thu|thur|thurs|fri|sat|satur|sun)(?:day)?,?) "
WITH_TIME = (
    r"^(.*?)(?:, | |t)(\d{1,2}):(\d{2})(?::(\d{2}))?(?:\.\d+)? ?(?:(am|pm)\b)? ?"
    r"(z|[+-]\d{2}:?\d{2}|\[[a-z_/+-]+\]|[a-z]+(?:/[a-z_]+)*)?$"
)
QUARTERS = {"first": 1, "second": 2, "third": 3, "fourth": 4}


def _canonical(c: Column) -> Column:
    """The date part with its pieces in the order year-month-day, year-month, year-qN or year."""
    rules = [
        (r"^(\d{4})(\d{2})(\d{2})$", "$1-$2-$3"),
        (r"^(\d{1,2})\.(\d{1,2})\.(\d{4})$", "$3-$2-$1"),
        (rf"^(\d{{1,2}})[ -]?({MONTH_NAME})[ -]?(\d{{4}}|\d{{2}})$", "$3-$2-$1"),
        (rf"^({MONTH_NAME}) (\d{{1,2}}), ?(\d{{4}})$", "$3-$1-$2"),
        (rf"^({MONTH_NAME})[ -](\d{{4}}|\d{{2}})$", "$2-$1"),
        (r"^(\d{1,2})/(\d{4})$", "$2-$1"),
        *[(rf"^{word} quarter (\d{{4}})$", f"$1-q{n}") for word, n in QUARTERS.items()],
        (r"^(q[1-4]) (\d{4})$", "$2-$1"),
        (r"^(\d{4}) (q[1-4])$", "$1-$2"),
        (r"^([1-4])q(\d{2}|\d{4})$", "$2-q$1"),
        (r"^fy ?(\d{4}|\d{2})$", "$1"),
        (r"^(\d{2})(-|$)", "20$1$2"),
        (r"^(?!\d{4}(-(q[1-4]|\d{1,2}|[a-z]{3,9}\.?)(-\d{1,2})?)?$).*$", ""),
    ]
    for pattern, to in rules:
        c = F.regexp_replace(c, pattern, to)
    return c


def normalise(df: DataFrame, raw: str, offsets: DataFrame, order: Column | None = None, local_zone: Column | None = None, out: str = "normal_form") -> DataFrame:
    """``df`` with the normal form of the column ``raw`` and, in column ``<out>_status``, how it was reached.

    ``order`` (``MDY`` or ``DMY``) tells the order of slashed dates,
    ``local_zone`` the zone of times without one, both per row. ``offsets`` is
    :func:`fundloom.operators.zones.offset_table`. Names starting with ``__``
    are the operator's own.
    """
    pieces = F.split(F.regexp_replace("__t", WITH_TIME, "$1\x1f$2\x1f$3\x1f$4\x1f$5\x1f$6"), "\x1f")
    part = lambda i: F.get("__parts", F.lit(i - 1))
    slash = r"^(\d{1,2})/(\d{1,2})/(\d{4})$"
    n = lambda c: c.try_cast("int")
    x = df.withColumns({
        "__t": F.regexp_replace(F.lower(squeeze(F.col(raw))), LEAD, ""),
        "__order": order if order is not None else F.lit(None).cast("string"),
        "__local": F.lower(local_zone) if local_zone is not None else F.lit(None).cast("string"),
    })
    x = x.withColumn("__parts", pieces)
    x = x.withColumn("__timed", F.size("__parts") == 6)
    x = x.withColumns({
        "__p": F.when(F.col("__timed"), part(1)).otherwise(F.col("__t")),
        "__h": F.when(F.col("__timed"), n(part(2))), "__m": F.when(F.col("__timed"), n(part(3))),
        "__s": F.when(F.col("__timed"), F.coalesce(n(part(4)), F.lit(0))),
        "__half": F.when(F.col("__timed"), part(5)), "__z": F.when(F.col("__timed"), F.regexp_replace(part(6), r"[\[\]]", "")),
    })
    x = x.withColumns({"__a": n(F.regexp_extract("__p", slash, 1)), "__b": n(F.regexp_extract("__p", slash, 2))})
    month_first = F.when(F.col("__a") > 12, F.lit(False)).when(F.col("__b") > 12, F.lit(True)).otherwise(F.col("__order") == "MDY")
    month_first = F.when(F.col("__order").isin("MDY", "DMY"), F.col("__order") == "MDY").otherwise(month_first)
    x = x.withColumn("__p", F.when(F.col("__a").isNull(), F.col("__p")).otherwise(
        F.regexp_replace("__p", slash, F.when(month_first, "$3-$1-$2").when(~month_first, "$3-$2-$1"))
    ))
    x = x.withColumn("__epoch", F.when(F.col("__p").rlike(r"^(\d{10}|\d{13})$") & ~F.col("__timed"), F.substring("__p", 1, 10).try_cast("bigint")))
    x = x.withColumn("__c", F.split(_canonical(F.col("__p")), "-"))
    piece = lambda i: F.get("__c", F.lit(i))
    x = x.withColumns({"__y": n(piece(0)), "__mm": F.coalesce(n(piece(1)), month_number(piece(1))), "__d": n(piece(2))})
    x = x.withColumn("__date", F.when(F.col("__d").isNotNull(), F.format_string("%04d-%02d-%02d", "__y", "__mm", "__d").try_cast("date")))
    hour = F.when(F.col("__half") == "", F.col("__h")).when(F.col("__h").between(1, 12), F.col("__h") % 12 + F.when(F.col("__half") == "pm", 12).otherwise(0))
    x = x.withColumn("__h", hour)
    valid = F.col("__h").between(0, 23) & F.col("__m").between(0, 59) & F.col("__s").between(0, 59)
    clock = F.unix_date("__date").cast("bigint") * 86_400 + F.col("__h") * 3600 + F.col("__m") * 60 + F.col("__s")
    fixed = F.create_map(*[v for k, m in ABBREVIATIONS.items() for v in (F.lit(k), F.lit(m * 60))])
    signed = F.when(F.col("__z").startswith("-"), -1).otherwise(1) * (
        n(F.substring("__z", 2, 2)) * 3600 + n(F.regexp_extract("__z", r"(\d{2})$", 1)) * 60
    )
    x = x.withColumns({
        "__clock": F.when(valid, clock), "__year": F.year("__date"),
        "__stated": F.when(F.col("__z").rlike(r"^[+-]\d"), signed).otherwise(F.try_element_at(fixed, F.col("__z"))),
        "__zone": F.when(F.col("__z") == "", F.col("__local")).otherwise(F.col("__z")),
    })
    x = with_offset(x, offsets, "__zone", "__year", "__clock")
    x = x.withColumn("__utc", F.coalesce("__epoch", F.col("__clock") - F.coalesce("__stated", "__offset")))
    instant = F.concat(
        F.date_from_unix_date(F.floor(F.col("__utc") / 86_400).cast("int")).cast("string"),
        F.format_string(
            "T%02d:%02d:%02dZ", F.floor(F.pmod("__utc", F.lit(86_400)) / 3600), F.floor(F.pmod("__utc", F.lit(3600)) / 60), F.pmod("__utc", F.lit(60))
        ),
    )
    form = (
        F.when(F.col("__epoch").isNotNull() | F.col("__timed"), F.when(F.col("__utc").isNotNull(), instant))
        .when(F.size("__c") == 3, F.col("__date").cast("string"))
        .when(piece(1).startswith("q"), F.concat_ws("-", piece(0), F.upper(piece(1))))
        .when(F.size("__c") == 2, F.when(F.col("__mm").between(1, 12), F.format_string("%04d-%02d", "__y", "__mm")))
        .when(F.col("__y").isNotNull(), F.format_string("%04d", "__y"))
    )
    status = (
        F.when(F.trim(F.col(raw)) == "", None).when(F.col(raw).isNull(), None).when(F.col(out).isNotNull() & ~F.coalesce(F.col("__timed"), F.lit(False)), F.when(F.col("__epoch").isNotNull(), "instant").otherwise("date"))
        .when(F.col(out).isNotNull(), F.when(F.col("__stated").isNull() & (F.col("__spans") > 1), "first of two").otherwise("instant"))
        .when(F.col("__clock").isNotNull() & F.col("__spans").isNull(), "unknown zone").when(F.col("__clock").isNotNull() & (F.col("__spans") == 0), "never occurs").otherwise("unreadable")
    )
    own = [c for c in x.columns if c.startswith("__")]
    return x.withColumn(out, form).withColumn(f"{out}_status", status).drop(*own)
