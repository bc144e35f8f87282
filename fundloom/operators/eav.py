"""Attribute-value rows into wide tables with typed columns.

The entity-by-attribute grid is completed, the values are joined to it, each
entity collects its values in an array sorted by attribute position, and fixed
indices of that array become columns through casts of their type.

Defined results:
* an attribute without a (readable) value gives null in its column;
* of several values of one attribute of an entity, the one with the lowest
  priority counts, then the smallest text; null values never count;
* attributes that are not in the list are ignored; an empty table gives an
  empty wide table with all columns.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def widen(
    cells: DataFrame, entity: list[str], attributes: list[tuple[str, str]], readers: dict[str, Callable[[Column], Column]],
    attribute: str = "attribute", value: str = "value", priority: str = "priority",
) -> DataFrame:
    """One row per entity of ``cells``.

    ``attributes`` lists (name, kind) in column order - the columns of the
    result, so few; ``readers`` gives, per kind, the cast of the text that
    yields null when it can't be read.
    """
    positions = {name: i for i, (name, _) in enumerate(attributes)}
    at = F.create_map(*[x for name, i in positions.items() for x in (F.lit(name), F.lit(i))])
    keys = [f"__e{i}" for i in range(len(entity))]  # own names: extra columns of the input can't clash
    kept = cells.select(
        *[F.col(e).alias(k) for e, k in zip(entity, keys, strict=True)], F.try_element_at(at, F.col(attribute)).alias("__pos"),
        F.struct(F.col(priority).alias("p"), F.col(value).alias("v")).alias("__v"),
    )
    values = kept.filter("__pos is not null and __v.v is not null").groupBy(*keys, "__pos").agg(F.min("__v").alias("__v"))
    grid = kept.select(*keys).distinct().withColumn("__pos", F.explode(F.lit(list(range(len(attributes))))))
    filled = grid.alias("g").join(
        values.alias("w"),
        [F.col(f"g.{k}").eqNullSafe(F.col(f"w.{k}")) for k in keys] + [F.col("g.__pos") == F.col("w.__pos")], "left",
    ).select(*[F.col(f"g.{k}") for k in keys], F.col("g.__pos"), F.col("w.__v.v").alias("__v"))
    arrays = filled.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("__pos", "__v"))).alias("__a"))
    return arrays.select(
        *[F.col(k).alias(e) for e, k in zip(entity, keys, strict=True)],
        *[readers[kind](F.col("__a")[i]["__v"]).alias(name) for i, (name, kind) in enumerate(attributes)],
    )


def cells_of(wide: DataFrame, entity: list[str], texts: dict[str, Column]) -> DataFrame:
    """(*entity, attribute, cell_text): one row per filled column of ``wide``."""
    pairs = F.array(*[F.struct(F.lit(name).alias("attribute"), text.alias("cell_text")) for name, text in texts.items()])
    return wide.select(*entity, F.explode(pairs).alias("c")).select(*entity, "c.attribute", "c.cell_text").filter("cell_text is not null")
