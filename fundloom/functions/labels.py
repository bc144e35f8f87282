"""Names and labels in comparable form."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fundloom.functions.text import squeeze

# Words without meaning for the identity of a firm.
NOISE_WORDS = ["the", "inc", "llc", "lp", "ltd", "limited", "corp", "corporation", "company", "co", "plc", "gmbh", "sa", "bv"]


def firm_key(c: Column) -> Column:
    """Lower case, without punctuation and legal noise words."""
    bare = F.regexp_replace(F.lower(c), r"[^a-z0-9 ]", " ")
    return squeeze(F.regexp_replace(bare, r"\b(" + "|".join(NOISE_WORDS) + r")\b", " "))


def canonical_label(c: Column) -> Column:
    """Lower case, dashes as blanks, without "investment(s)"."""
    return squeeze(F.regexp_replace(F.regexp_replace(F.lower(c), r"[-–—_]", " "), r"\binvestments?\b", " "))


def vintage(c: Column) -> Column:
    """The first year 19xx or 20xx in a text."""
    return F.regexp_extract(c, r"\b((?:19|20)\d{2})\b", 1).try_cast("int")
