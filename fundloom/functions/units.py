"""Units, scales and currencies as typed by many hands."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fundloom.functions.text import squeeze

# Spellings of units (without scale words, dots dropped, lower case) and of currencies.
UNIT_NAMES = {
    "share": ["share", "shares", "sh", "shs"],
    "m2": ["m2", "m²", "sqm", "sq m", "square metres", "square meters", "square metre"],
    "sq_ft": ["sq ft", "sf", "square feet", "square foot", "sqft"],
    "acre": ["acre", "acres", "ac"],
    "hectare": ["hectare", "hectares", "ha"],
    "kwh": ["kwh", "kilowatt hours", "kilowatt-hours", "kilowatt hour"],
    "mwh": ["mwh", "megawatt hours", "megawatt-hours", "megawatt hour"],
    "gwh": ["gwh", "gigawatt hours", "gigawatt-hours", "gigawatt hour"],
    "kg": ["kg", "kgs", "kilogram", "kilograms"],
    "lb": ["lb", "lbs", "pound", "pounds", "pounds weight"],
    "tonne": ["tonne", "tonnes", "t", "mt", "metric tons", "metric ton"],
    "troy_oz": ["troy oz", "oz t", "ozt", "troy ounces", "troy ounce"],
    "m3": ["m3", "m³", "cbm", "cubic metres", "cubic meters", "cubic metre"],
    "bbl": ["bbl", "bbls", "barrel", "barrels"],
    "us_gallon": ["us gallon", "us gallons", "us gal", "gal", "gallons (us)", "gallon (us)"],
}
CURRENCY_NAMES = {
    "USD": ["usd", "us$", "us dollars", "us dollar", "$"],
    "EUR": ["eur", "euro", "euros", "€"],
    "GBP": ["gbp", "£", "pounds sterling", "pound sterling"],
    "GBX": ["gbx", "pence sterling", "pence"],
    "JPY": ["jpy", "¥", "japanese yen", "yen"],
    "CAD": ["cad", "c$", "ca$", "canadian dollars", "canadian dollar"],
    "CHF": ["chf", "sfr", "swiss francs"],
    "AUD": ["aud", "a$", "au$", "australian dollars", "australian dollar"],
    "SEK": ["sek", "swedish kronor", "kronor"],
}
MILLION = r"\(?\b(?:in )?(?:millions?|mn|mm|m)\b\)?"
THOUSAND = r"\(?\b(?:in )?(?:thousands?|000s?|k)\b\)?"


def lookup(names: dict[str, list[str]], c: Column) -> Column:
    """The code whose spellings include ``c``, else null."""
    pairs = [x for code, spelled in names.items() for s in spelled for x in (F.lit(s), F.lit(code))]
    return F.try_element_at(F.create_map(*pairs), c)


def scale_of(words: Column) -> Column:
    """1000000, 1000 or 1 by the scale words in lower-case text."""
    return F.when(words.rlike(MILLION), 1_000_000).when(words.rlike(THOUSAND), 1_000).otherwise(1)


def without_scale(words: Column) -> Column:
    return squeeze(F.regexp_replace(F.regexp_replace(words, MILLION, " "), THOUSAND, " "))


def unit_words(c: Column) -> Column:
    """Unit text in lower case, without dots, with underscores as blanks."""
    return squeeze(F.lower(F.translate(c, "_.", " ")))


def unit_code(words: Column) -> Column:
    """The unit_reference code of :func:`unit_words` text: counts carry their scale, e.g. ``thousand_share``."""
    exact = lookup(UNIT_NAMES, words)
    share = lookup({"share": UNIT_NAMES["share"]}, without_scale(words))
    scale = scale_of(words)
    scaled = F.when(share.isNotNull(), F.when(scale == 1_000_000, "million_share").when(scale == 1_000, "thousand_share").otherwise("share"))
    return F.coalesce(exact, scaled)


def currency_code(c: Column) -> Column:
    """The currency_reference code of a typed currency, scale words aside. ``GBp`` is pence, ``GBP`` pounds."""
    bare = F.translate(without_scale(F.lower(squeeze(c))), ".", "")
    return F.when(squeeze(c).rlike(r"^GBp\b"), "GBX").otherwise(lookup(CURRENCY_NAMES, bare))
