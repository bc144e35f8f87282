"""Printed numbers as decimals, and decimals as plain text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fundloom.functions.text import BLANK

#: Currency marks that may stand before or after a number.
CURRENCY_MARK = r"(?i)(US\$|C\$|CA\$|A\$|AU\$|[$€£¥]|USD|EUR|GBP|GBX|JPY|CAD|CHF|AUD|SEK|Sfr\.?)"
#: Signs before the number and after it that do not count: percent and multiple signs.
SIGNS = CURRENCY_MARK + r"|%|percent\.?$|(?<=[\d.)])x$"


def printed_number(c: Column, decimals: str = "decimal(38,10)") -> Column:
    """The number that a print reads as, or null.

    Currency marks, percent and multiple signs do not count; a leading or
    trailing minus in any dash, or brackets, make it negative; thousands are
    grouped correctly or not at all. One chain of replacements, so generated
    code stays small.
    """
    s = F.translate(F.regexp_replace(c, BLANK + "+", ""), "−–‒", "---")
    s = F.regexp_replace(s, SIGNS, "")
    s = F.regexp_replace(s, r"^-?\(([^()]*)\)$|^([^-]+)-$", "-$1$2")
    s = F.regexp_replace(s, r"(?<=^-?\d{1,3}(,\d{3}){0,12}),(?=\d{3}(,|\.|$))", "")
    s = F.regexp_replace(s, r"^(?!-?(\d+(\.\d*)?|\.\d+)$).*$", "")
    return s.try_cast(decimals)


def plain_text(c: Column) -> Column:
    """A decimal as text with a leading ``-`` if negative and no trailing zeros."""
    s = F.regexp_replace(c.cast("string"), r"^-?0E.*$", "0")
    return F.regexp_replace(F.regexp_replace(s, r"(\.\d*?)0+$", "$1"), r"\.$", "")
