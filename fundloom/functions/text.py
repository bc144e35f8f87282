"""Column expressions on printed text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Every kind of blank that occurs in print, as a character class.
BLANK = r"[\s    　]"


def squeeze(c: Column) -> Column:
    """Blanks trimmed and runs of blanks made one."""
    return F.trim(F.regexp_replace(c, BLANK + "+", " "))


def match_key(c: Column) -> Column:
    """Squeezed and lower-cased; null becomes empty."""
    return F.coalesce(F.lower(squeeze(c)), F.lit(""))


def without_blanks(c: Column) -> Column:
    """All blanks dropped; null becomes empty."""
    return F.coalesce(F.regexp_replace(c, BLANK + "+", ""), F.lit(""))
