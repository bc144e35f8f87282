"""Names and attributes gathered from records, filled in where they are sure."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fundloom.operators.relational import latest_per_key


def attributes(records: DataFrame, owner: str, fields: list[str], canonical) -> DataFrame:
    """(owner, field, filled, blank, values, variants, mode) per owner and field.

    ``values`` counts distinct spellings, ``variants`` those beyond one per
    canonical label; ``mode`` is the most frequent spelling, ties by length, then text.
    """
    pairs = F.array(*[F.struct(F.lit(f).alias("field"), F.nullif(F.trim(F.col(f)), F.lit("")).alias("value")) for f in fields])
    cells = records.select(owner, F.explode(pairs).alias("c")).select(owner, "c.field", "c.value")
    counted = cells.groupBy(owner, "field", "value").agg(F.count(F.lit(1)).alias("n"))
    named = counted.filter("value is not null")
    modes = latest_per_key(named, [owner, "field"], [F.desc("n"), F.desc(F.length("value")), F.col("value")]).select(owner, "field", F.col("value").alias("mode"))
    per = counted.withColumn("label", canonical(F.col("value"))).groupBy(owner, "field").agg(
        F.coalesce(F.sum(F.when(F.col("value").isNotNull(), F.col("n"))), F.lit(0)).alias("filled"), F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("n"))), F.lit(0)).alias("blank"),
        F.count("value").alias("values"), (F.count("value") - F.countDistinct("label")).alias("variants"),
    )
    return per.join(modes, [owner, "field"], "left")


def aliases(names: DataFrame, kind: str, name: str, key: Column, known: DataFrame, known_key: Column, value: str) -> DataFrame:
    """``names`` with ``value`` of the known entity of the same kind whose key is theirs, if that is only one."""
    index = known.select(kind, known_key.alias("__k"), value).distinct().groupBy(kind, "__k").agg(F.count(F.lit(1)).alias("__n"), F.min(value).alias(value)).filter("__n = 1").drop("__n")
    return names.withColumn("__k", key).join(index, [kind, "__k"], "left").drop("__k")


def propagated(funds: DataFrame, family: str, manager: str) -> DataFrame:
    """``funds`` with (manager, manager_source): a blank one is that of its family, if the family has only one."""
    stated = F.nullif(F.trim(F.col(manager)), F.lit(""))
    only = funds.select(F.col(family), stated.alias("__m")).filter(F.col(family).isNotNull() & F.col("__m").isNotNull()).groupBy(family).agg(F.min("__m").alias("__a"), F.max("__m").alias("__b")).filter("__a = __b")
    joined = funds.join(only, family, "left")
    source = F.when(stated.isNotNull(), "STATED").when(F.col("__a").isNotNull(), F.concat(F.lit("FAMILY "), F.col(family))).otherwise("NONE")
    return joined.withColumn("manager_source", source).withColumn(manager, F.coalesce(stated, "__a")).drop("__a", "__b")


def spelled_apart(names: DataFrame, name: str, key: Column) -> DataFrame:
    """(key, spellings, preferred): keys with several spellings; the preferred is the most frequent, ties by length, then text."""
    counted = names.filter(F.col(name).isNotNull()).groupBy(key.alias("key"), name).agg(F.count(F.lit(1)).alias("n"))
    per = counted.groupBy("key").agg(F.count(F.lit(1)).alias("spellings")).filter("spellings > 1")
    best = latest_per_key(counted, ["key"], [F.desc("n"), F.desc(F.length(name)), F.col(name)]).select("key", F.col(name).alias("preferred"))
    return per.join(best, "key")
