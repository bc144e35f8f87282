"""Queries of the text problems over the tables of a data directory."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fundloom.llm import mixing, mojibake, names, packing, scans, tokens
from fundloom.session import checkpoint
from fundloom.sources.tables import table

# --------------------------------------------------------------- 10 garbled text


def p10_repaired(spark: SparkSession, d: str) -> DataFrame:
    """The affected documents with their repaired text."""
    return mojibake.repaired(table(spark, d, "documents").select("doc_id", "text"))


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    return p10_repaired(spark, d).select("doc_id").distinct()


# ------------------------------------------------------------ 3 variant spellings

NAME_COLUMNS = [
    ("manager", "manager_master", "manager_name"), ("manager", "wide_allocation_observation", "subject_manager_name"),
    ("target", "investment_target", "printed_name_primary"), ("target", "wide_allocation_observation", "subject_name"),
]


def all_names(spark: SparkSession, d: str) -> DataFrame:
    parts = [table(spark, d, t).select(F.lit(domain).alias("name_domain"), F.col(c).alias("name")).distinct() for domain, t, c in NAME_COLUMNS]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def p3_classes(spark: SparkSession, d: str) -> DataFrame:
    """Every name with its class and number of links."""
    return names.classes(all_names(spark, d))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return names.variants(p3_classes(spark, d))


# --------------------------------------------------------------- 2 scanned pages

BLOCK_COLUMNS = ["block_id", "file_id", "physical_page", "printed_page", "original_text", "search_text"]


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return scans.noise(table(spark, d, "blocks").select(*BLOCK_COLUMNS))


def p2_repaired(spark: SparkSession, d: str) -> DataFrame:
    """Every block as continuous text with a clean page label."""
    return scans.reflowed(table(spark, d, "blocks").select(*BLOCK_COLUMNS))


# ------------------------------------------------- 8 containers, 9 target shares


def p8_containers(spark: SparkSession, d: str) -> DataFrame:
    """Every document, or part of an oversized one, in its container."""
    sizes = tokens.measured(table(spark, d, "documents").select("doc_id", "text"), "doc_id", "text")
    return packing.containers(sizes, "doc_id")


def p8_report(spark: SparkSession, d: str) -> DataFrame:
    return packing.report(p8_containers(spark, d))


def _drawn(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    targets = table(spark, d, "mix_target")
    texts = table(spark, d, "documents").filter("source is not null").select("doc_id", "source", "text")
    sizes = tokens.measured(texts, "doc_id", "text", ("source",)).select("doc_id", "source", (F.col("prompt_tokens") + F.col("answer_tokens")).alias("tokens"))
    return mixing.draw(checkpoint(sizes), "doc_id", targets), targets


def p9_mixture(spark: SparkSession, d: str) -> DataFrame:
    """Every copy drawn."""
    return _drawn(spark, d)[0]


def p9_shares(spark: SparkSession, d: str) -> DataFrame:
    """The shares reached."""
    drawn, targets = _drawn(spark, d)
    return mixing.shares(drawn, "doc_id", targets)
