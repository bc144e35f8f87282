"""Records into wide rows with a bridge back to every record."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SEP = "\x1f"


def grains(records: DataFrame, grain: list[str], category: str, label: str) -> DataFrame:
    """``records`` with (column_group, wide_row_id): a grain is split by column label only where one of its categories has several labels."""
    repeated = records.groupBy(*grain, category).agg(F.countDistinct(F.coalesce(F.col(label), F.lit(""))).alias("n")).groupBy(*grain).agg((F.max("n") > 1).alias("__split"))
    same = [F.col(f"l.{g}").eqNullSafe(F.col(f"r.{g}")) for g in grain]
    out = records.alias("l").join(repeated.alias("r"), same).select("l.*", F.when(F.col("r.__split"), F.coalesce(F.col(f"l.{label}"), F.lit(""))).alias("column_group"))
    parts = [F.coalesce(F.col(g).cast("string"), F.lit("")) for g in [*grain, "column_group"]]
    return out.withColumn("wide_row_id", F.concat(F.lit("WR_"), F.substring(F.sha2(F.concat_ws(SEP, *parts), 256), 1, 16)))


def wide(records: DataFrame, grain: list[str], category: str, value: str, order: str, names: list[str]) -> DataFrame:
    """One row per wide row of :func:`grains`: the first value of each category, the records in it and how many cells collided."""
    cells = [F.min_by(F.when(F.col(category) == n, F.col(value)), F.when(F.col(category) == n, F.col(order))).alias(n) for n in names]
    counts = [F.count_if(F.col(category) == n) for n in names]
    collisions = sum((F.when(c > 1, 1).otherwise(0) for c in counts), F.lit(0)).cast("bigint")
    return records.groupBy("wide_row_id", *grain, "column_group").agg(*cells, F.count(F.lit(1)).alias("records"), collisions.alias("collisions"))


def bridge(records: DataFrame, key: str, category: str) -> DataFrame:
    """(wide_row_id, key, category): where each record went."""
    return records.select("wide_row_id", key, category)


def conserved(records: DataFrame, wide_rows: DataFrame, bridged: DataFrame) -> DataFrame:
    """One row (records, in_rows, in_bridge, conserved): every record counts once in the wide rows and in the bridge."""
    a, b, c = records.agg(F.count(F.lit(1)).alias("records")), wide_rows.agg(F.coalesce(F.sum("records"), F.lit(0)).alias("in_rows")), bridged.agg(F.count(F.lit(1)).alias("in_bridge"))
    return a.crossJoin(b).crossJoin(c).withColumn("conserved", (F.col("records") == F.col("in_rows")) & (F.col("records") == F.col("in_bridge")))  # one row each


def star(records: DataFrame, document: str, page: str, subject: str, value: str) -> dict[str, DataFrame]:
    """Dimensions and facts of records under stable ids: ``dim_document``, ``dim_page``, ``dim_entity``, ``fact_observation``."""
    ident = lambda prefix, *c: F.concat(F.lit(prefix), F.substring(F.sha2(F.concat_ws(SEP, *[F.coalesce(F.col(x).cast("string"), F.lit("")) for x in c]), 256), 1, 16))
    with_ids = records.withColumns({"page_id": ident("PG_", document, page), "entity_id": F.when(F.col(subject).isNotNull(), ident("EN_", subject))})
    return {
        "dim_document": with_ids.groupBy(document).agg(F.count(F.lit(1)).alias("observation_count"), F.countDistinct("page_id").alias("pages_with_data")),
        "dim_page": with_ids.groupBy("page_id", document, page).agg(F.count(F.lit(1)).alias("records_written")),
        "dim_entity": with_ids.filter("entity_id is not null").groupBy("entity_id", F.col(subject).alias("canonical_name")).agg(F.count(F.lit(1)).alias("observation_count")),
        "fact_observation": with_ids.filter(F.col(value).isNotNull()),
    }
