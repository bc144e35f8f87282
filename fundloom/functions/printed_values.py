"""Printed values, halves of their last digit, and dates with the precision they support."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fundloom.functions.numbers import printed_number
from fundloom.functions.printed_dates import MONTH_NAME, month_number, valid_date
from fundloom.functions.text import squeeze

#: Marks and codes of currencies, the longer ones first.
MARKS = {"US$": "USD", "C$": "CAD", "A$": "AUD", "€": "EUR", "£": "GBP", "¥": "JPY", "$": "USD"}
CODES = ["USD", "EUR", "GBP", "JPY", "CAD", "CHF", "AUD", "SEK"]


def stated_currency(c: Column) -> Column:
    """The currency of a print: its code, else that of its mark, else empty."""
    out = F.lit("")
    for mark, code in reversed(list(MARKS.items())):
        out = F.when(c.contains(mark), code).otherwise(out)
    for code in reversed(CODES):
        out = F.when(c.rlike(rf"(?i)\b{code}\b"), code).otherwise(out)
    return out


def value_parts(raw: Column, unit: Column | None = None) -> Column:
    """struct(kind, number, sign, currency) of a print.

    kind is ``empty``, ``text``, ``percent``, ``multiple``, ``money`` (a currency
    is stated) or ``number``; the number keeps the printed magnitude. Null counts as empty.
    """
    text = F.coalesce(squeeze(raw), F.lit(""))
    unit = F.coalesce(F.trim(unit), F.lit("")) if unit is not None else F.lit("")
    number, currency = printed_number(text), stated_currency(text)
    kind = (
        F.when(text == "", "empty").when(number.isNull(), "text").when((unit == "%") | text.rlike(r"%\)?$"), "percent")
        .when((F.lower(unit) == "x") | text.rlike(r"(?i)\d ?x$"), "multiple").when(currency != "", "money").otherwise("number")
    )
    sign = F.when(number.isNull(), "").when(number < 0, "negative").otherwise("positive")
    return F.struct(kind.alias("kind"), number.alias("number"), sign.alias("sign"), F.when(text == "", "").otherwise(currency).alias("currency"))


def half_unit(raw: Column, multiplier: Column | float = 1.0) -> Column:
    """Half of the place of the last printed digit, in stored units; null without a number."""
    m = F.lit(multiplier) if isinstance(multiplier, float) else F.coalesce(F.nullif(multiplier.cast("double"), F.lit(0.0)), F.lit(1.0))
    decimals = F.length(F.regexp_extract(raw, r"\d[\d,]*(?:\.(\d+))?", 1))
    return F.when(raw.rlike(r"\d"), 0.5 * F.pow(F.lit(10.0), -decimals) * m)


def quotient_slack(own: Column, numerators: list[Column], denominator: Column, denominator_half: Column, quotient: Column) -> Column:
    """How far a recomputed quotient may lie from the printed one: to first order in the halves of all prints."""
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    parts = sum((zero(n) for n in numerators), F.lit(0.0)) / denominator + F.abs(zero(quotient)) * zero(denominator_half) / denominator
    return zero(own) + F.when(denominator > 0, parts).otherwise(0.0)


def sum_slack(own: Column, components: list[Column]) -> Column:
    """How far a recomputed sum may lie from the printed one."""
    return sum((F.coalesce(c, F.lit(0.0)) for c in components), F.coalesce(own, F.lit(0.0)))


def dated(raw: Column, order: Column | None = None, ambiguous: str = "refuse") -> Column:
    """struct(date, precision) of a printed date: ``day``, ``month`` (at its end), ``year`` (at its end) or ``unknown``.

    ``order`` (``DMY`` or ``MDY``) tells slashed dates. Without it one that both
    orders allow, with different parts, is an error (``refuse``) or unknown (``unknown``).
    """
    order = order if order is not None else F.lit(None).cast("string")
    text = F.regexp_replace(squeeze(raw), r"(?i)^(?:mon|tues|wednes|thurs|fri|satur|sun)day,? *|\.$", "")
    slash, mdy = r"^(\d{1,2})/(\d{1,2})/(\d{4})$", rf"(?i)^({MONTH_NAME}) (\d{{1,2}}),? (\d{{4}})$"
    dmy, my, year, fy = rf"(?i)^(\d{{1,2}}) ({MONTH_NAME}),? (\d{{4}})$", rf"(?i)^({MONTH_NAME}) (\d{{4}})$", r"^(?:FY)?(\d{4})$", r"^FY(\d{2})$"
    x = lambda p, i: F.regexp_extract(text, p, i)
    n = lambda p, i: x(p, i).try_cast("int")
    a, b = n(slash, 1), n(slash, 2)
    first_day = F.when(order == "DMY", True).when(order == "MDY", False).when((a > 12) & (b <= 12), True).when(((b > 12) & (a <= 12)) | (a == b), False)
    refusal = F.raise_error(F.concat(F.lit("ambiguous date: "), raw)).cast("boolean") if ambiguous == "refuse" else F.lit(None).cast("boolean")
    first_day = F.when(text.rlike(slash), F.coalesce(first_day, refusal))
    day = (
        F.when(text.rlike(slash), F.when(first_day, valid_date(n(slash, 3), b, a)).when(~first_day, valid_date(n(slash, 3), a, b)))
        .when(text.rlike(mdy), valid_date(n(mdy, 3), month_number(x(mdy, 1)), n(mdy, 2))).when(text.rlike(dmy), valid_date(n(dmy, 3), month_number(x(dmy, 2)), n(dmy, 1)))
    )
    month = F.when(text.rlike(my), F.last_day(valid_date(n(my, 2), month_number(x(my, 1)), F.lit(1))))
    years = F.when(text.rlike(year), valid_date(n(year, 1), F.lit(12), F.lit(31))).when(text.rlike(fy), valid_date(2000 + n(fy, 1), F.lit(12), F.lit(31)))
    date = F.coalesce(day, month, years)
    precision = F.when(F.coalesce(text, F.lit("")) == "", "").when(day.isNotNull(), "day").when(month.isNotNull(), "month").when(years.isNotNull(), "year").otherwise("unknown")
    return F.struct(date.alias("date"), precision.alias("precision"))
