"""Names of the queries on text corpora and of their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from fundloom.llm import plans


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "p2_found": plans.p2_found,
        "p2_repaired": plans.p2_repaired,
        "p3_found": plans.p3_found,
        "p3_classes": plans.p3_classes,
        "p8_containers": plans.p8_containers,
        "p8_report": plans.p8_report,
        "p9_mixture": plans.p9_mixture,
        "p9_shares": plans.p9_shares,
        "p10_found": plans.p10_found,
        "p10_repaired": plans.p10_repaired,
    }


def oracle_sql() -> dict[str, str]:
    return {}
