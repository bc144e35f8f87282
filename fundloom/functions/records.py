"""Predicates and cells of evidence records."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from fundloom.functions.text import squeeze


def active(status: Column) -> Column:
    """Whether a record is active; null is not."""
    return F.coalesce(F.upper(F.trim(status)) == "ACTIVE", F.lit(False))


def term_applies(day: Column, start: Column, end: Column) -> Column:
    """Whether a term covers a day; a missing end is open, a missing start covers nothing."""
    return F.coalesce((day >= start) & (day <= F.coalesce(end, F.lit("9999-12-31").cast("date"))), F.lit(False))


def whole_fund(*parts: Column) -> Column:
    """Whether a record names no part of a fund (partner, class): all are blank."""
    out = F.lit(True)
    for p in parts:
        out = out & (F.coalesce(F.trim(p), F.lit("")) == "")
    return out


def period_cell(kind: Column, number: Column, multiplier: Column) -> Column:
    """A printed number as it is stored: money in single units, percents as fractions, others as printed."""
    return F.when(kind == "money", number * F.coalesce(multiplier, F.lit(1))).when(kind == "percent", number / 100).otherwise(number)


def scale_multiplier(scale: Column) -> Column:
    """1000000, 1000 or 1 by the name of a scale."""
    s = F.lower(F.coalesce(scale, F.lit("")))
    return F.when(s.rlike("million|^mm?$|^mn$"), 1_000_000).when(s.rlike("thousand|^k$|000"), 1_000).otherwise(1)


#: Fixed value: what passages that address a reader's tools look like.
INSTRUCTION = r"(?i)(ignore (previous|all) instructions|system:|you are now|/etc/passwd|drop table)"


def is_instruction(text: Column) -> Column:
    return F.coalesce(text.rlike(INSTRUCTION), F.lit(False))


def number_key(c: Column) -> Column:
    """A printed number without marks and grouping, negative ones with a minus."""
    bare = F.trim(F.translate(c, "$€£,", ""))
    negative = bare.rlike(r"^\(.*\)%?$") | bare.startswith("-")
    return F.concat(F.when(negative, "-").otherwise(""), F.regexp_replace(bare, r"^[(\-\s]+|[%)\s]+$", ""))


#: A printed number that is not part of another.
QUOTED = r"(?<![\w.])(\(\s*[$€£]?\s*[0-9][0-9,.]*%?\s*\)|-\s*[$€£]?\s*[0-9][0-9,.]*%?|[$€£]?\s*[0-9][0-9,.]*%?)(?![\w.])"


def number_in_quote(value: Column, quote: Column) -> Column:
    """Whether a claimed number stands in a quote as a number of its own."""
    found = F.transform(F.regexp_extract_all(quote, F.lit(QUOTED), 1), lambda x: number_key(F.regexp_replace(x, r"(?<=\d)[.,]+$", "")))
    return F.coalesce((number_key(value) == "") | F.array_contains(found, number_key(value)), F.lit(False))


def rounding_note(text: Column) -> Column:
    low = F.lower(text)
    return F.coalesce(low.contains("round") & ~low.rlike("fee|gross|net of|dietz"), F.lit(False))


#: Words that a search leaves out.
STOPWORDS = ["and", "or", "not", "near", "the", "a", "an", "of", "on", "for", "to", "in", "as"]


def query_terms(text: Column, most: int = 24) -> Column:
    """The first terms of a query, stop words left out; a percent sign is a word."""
    words = F.regexp_extract_all(F.replace(F.lower(text), F.lit("%"), F.lit(" percent ")), F.lit(r"([a-z0-9%$.]+)"), 1)
    return F.slice(F.filter(words, lambda w: ~w.isin(STOPWORDS)), 1, most)


def nfkc(c: Column) -> Column:
    """Compatibility composition, in Arrow batches: the JVM functions have none."""

    def composed(text: pd.Series) -> pd.Series:
        return text.map(lambda t: None if t is None or t != t else unicodedata.normalize("NFKC", t))

    return F.pandas_udf(composed, "string")(c)


def key_text(c: Column) -> Column:
    """A label as a key: composed, squeezed, in lower case."""
    return F.lower(squeeze(nfkc(c)))


def bucket(c: Column, modulus: int) -> Column:
    """A stable bucket of a key."""
    return F.conv(F.substring(F.sha2(c, 256), 1, 8), 16, 10).cast("bigint") % modulus


def clamp(c: Column, low: float, high: float) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), c))


def recovery_gap(invested: Column, recovered: Column, nav: Column) -> tuple[Column, Column]:
    """(capital still to be recovered, haircut of the NAV at which it just is)."""
    gap = F.greatest(invested - recovered, F.lit(0.0))
    return gap, F.when(nav > 0, F.greatest(F.lit(0.0), 1 - gap / nav))


def downside(revenue: Column, margin: Column, multiple: Column, revenue_loss: float, margin_loss: float, multiple_loss: float) -> Column:
    """Enterprise value after losses of revenue, margin (in points) and multiple."""
    return revenue * (1 - revenue_loss) * F.greatest(margin - margin_loss, F.lit(0.0)) * F.greatest(multiple - multiple_loss, F.lit(0.0))


def months_between_days(start: Column, end: Column) -> Column:
    return F.datediff(end, start) / F.lit(30.4375)


def date_at(start: Column, end: Column, part: Column) -> Column:
    """The date at a part of the way between two."""
    return F.date_add(start, F.round(F.datediff(end, start) * part).cast("int"))


def canonical_hash(*fields: Column) -> Column:
    """SHA-256 of the fields as JSON with null fields kept."""
    return F.sha2(F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}), 256)
