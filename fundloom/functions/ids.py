"""Stable identifiers and deterministic draws from hashes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def digest_id(prefix: str, *parts: Column, length: int = 16, separator: str = "\x1f") -> Column:
    """Prefix and the first hex digits of the SHA-256 of the parts; nulls count as empty."""
    joined = F.concat_ws(separator, *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return F.concat(F.lit(prefix), F.substring(F.sha2(joined, 256), 1, length))


def unit_interval(seed: Column) -> Column:
    """A draw in [0, 1]: the first eight bytes of the SHA-256 over 2^64 - 1."""
    return F.conv(F.substring(F.sha2(seed, 256), 1, 16), 16, 10).cast("decimal(20,0)").cast("double") / F.lit(18446744073709551615.0)


def one_in_ten(seed: Column) -> Column:
    """Whether the first four bytes of the SHA-256 leave no rest modulo ten."""
    return F.conv(F.substring(F.sha2(seed, 256), 1, 8), 16, 10).cast("bigint") % 10 == 0


def upper_snake(c: Column) -> Column:
    """Upper-case words joined by single underscores."""
    return F.regexp_replace(F.regexp_replace(F.upper(c), r"[^A-Z0-9]+", "_"), r"^_+|_+$", "")
