"""Printed dates of fixed layouts as dates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The first three letters of the months, in order.
MONTHS = ["jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec"]
MONTH_NAME = r"(?:jan(?:uary)?|feb(?:ruary)?|mar(?:ch)?|apr(?:il)?|may|june?|july?|aug(?:ust)?|sept?(?:ember)?|oct(?:ober)?|nov(?:ember)?|dec(?:ember)?)\.?"


def month_number(name: Column) -> Column:
    """1 to 12 for a month name or abbreviation in any case, else null."""
    at = F.array_position(F.lit(MONTHS), F.lower(F.substring(name, 1, 3)))
    return F.when(at > 0, at.cast("int"))


def four_digit_year(y: Column) -> Column:
    """Two-digit years are 20yy."""
    return F.when(F.length(y) == 2, F.concat(F.lit("20"), y)).otherwise(y).try_cast("int")


def valid_date(y: Column, m: Column, d: Column) -> Column:
    """The date, or null where there is no such day."""
    return F.format_string("%04d-%02d-%02d", y, m, d).try_cast("date")


def day_date(c: Column) -> Column:
    """A date printed to the day with a month name or in ISO order, else null."""
    s = F.lower(F.trim(c))
    iso = r"^(\d{4})-(\d{2})-(\d{2})$"
    dmy = rf"^(\d{{1,2}})[ -]({MONTH_NAME})[ -](\d{{4}}|\d{{2}})$"
    mdy = rf"^({MONTH_NAME}) (\d{{1,2}}), ?(\d{{4}})$"
    pick = lambda p, i: F.regexp_extract(s, p, i)
    return (
        F.when(s.rlike(iso), s.try_cast("date"))
        .when(s.rlike(dmy), valid_date(four_digit_year(pick(dmy, 3)), month_number(pick(dmy, 2)), pick(dmy, 1).try_cast("int")))
        .when(s.rlike(mdy), valid_date(pick(mdy, 3).try_cast("int"), month_number(pick(mdy, 1)), pick(mdy, 2).try_cast("int")))
    )
