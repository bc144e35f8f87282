"""Names of the core queries and of their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from fundloom.plans import evidence, general, general_sql, performance, reference, review  # noqa: F401  (evidence, performance and review register their queries in reference)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return reference.QUERIES | {
        "p1_found": general.p1_found,
        "p1_hierarchies": general.p1_hierarchies,
        "p1_descendants": general.p1_descendants,
        "p1_other_parents": general.p1_other_parents,
        "p1_hierarchies_whole": general.p1_hierarchies_whole,
        "p4_found": general.p4_found,
        "p4_units": general.p4_units,
        "p4_unit_holdout": general.p4_unit_holdout,
        "p5_found": general.p5_found,
        "p5_forms": general.p5_forms,
        "p6_found": general.p6_found,
        "p7_found": general.p7_found,
        "p7_wide": general.p7_wide,
    }


def oracle_sql() -> dict[str, str]:
    return reference.SQL | general_sql.SQL


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reference.ks_pme(spark, sf_dir)
