"""Presence summaries: what an entity adds to each value of a dimension, which roll up to distinct counts without counting distinct values.

An entity's rows (a few dates times the items) meet in one aggregate. Its summary has
one row a value it has, so that entities are counted by counting rows, and queries by
adding up numbers that no two entities share.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..roles import ROLES, Roles


def presence(df: DataFrame, dims: Iterable[str], roles: Roles = ROLES) -> DataFrame:
    """``entity, level, value, rows, positives, queries`` for each entity: in total (``total``, ``all``) and for each value of ``dims`` it has, as strings.

    Rows of an entity are expected to be as few as its dates times the items.
    """
    dims = list(dims)
    fields = [F.col(roles.time).alias("__time"), F.col(roles.label).cast("long").alias("__label"), *(F.col(d).cast("string").alias(f"__{i}") for i, d in enumerate(dims))]
    own = df.groupBy(*roles.entity).agg(F.collect_list(F.struct(*fields)).alias("rows"))

    def entry(level: str, value, rows):
        return F.struct(
            F.lit(level).alias("level"), value.alias("value"), F.size(rows).cast("long").alias("rows"),
            F.aggregate(rows, F.lit(0).cast("long"), lambda s, r: s + F.coalesce(r["__label"], F.lit(0))).alias("positives"),
            F.size(F.array_distinct(F.transform(rows, lambda r: r["__time"]))).cast("long").alias("queries"))

    def of(i: int, level: str):
        values = F.array_distinct(F.transform("rows", lambda r: r[f"__{i}"]))
        return F.transform(values, lambda v: entry(level, v, F.filter("rows", lambda r: r[f"__{i}"].eqNullSafe(v))))

    entries = F.concat(F.array(entry("total", F.lit("all"), F.col("rows"))), *(of(i, d) for i, d in enumerate(dims)))
    return own.select(*roles.entity, F.explode(entries).alias("e")).select(*roles.entity, "e.*")


def rolled_up(summary: DataFrame) -> DataFrame:
    """``level, value, rows, positives, entities, positive_entities, queries`` over all entities; summaries of disjoint entities may be united first."""
    positive = F.sum((F.col("positives") > 0).cast("long")).alias("positive_entities")
    return summary.groupBy("level", "value").agg(F.sum("rows").alias("rows"), F.sum("positives").alias("positives"), F.count("*").alias("entities"), positive, F.sum("queries").alias("queries"))


def dataset_overview(df: DataFrame, dims: Iterable[str], roles: Roles = ROLES) -> DataFrame:
    """Rows, positives, entities and queries in total and by each of ``dims``, as ``level, value, ...``; an empty frame gives no rows."""
    out = rolled_up(presence(df, dims, roles))
    rate = (F.col("positives") / F.col("rows")).alias("positive_rate")
    return out.select("level", F.coalesce("value", F.lit("all")).alias("value"), "rows", "positives", rate, "entities", "queries")


def item_entity_statistics(df: DataFrame, roles: Roles = ROLES) -> DataFrame:
    """Per item: positive, negative and all entities, positive rate, positives per positive entity."""
    own = rolled_up(presence(df, [roles.item], roles)).where(F.col("level") == roles.item)
    positive = F.col("positive_entities")
    return own.select(
        F.col("value").cast(df.schema[roles.item].dataType).alias(roles.item), "positive_entities", (F.col("entities") - positive).alias("negative_entities"), "entities",
        (positive / F.col("entities")).alias("positive_rate"), F.try_divide("positives", positive).alias("positives_per_entity"))


def segment_entity_statistics(df: DataFrame, segment: str, roles: Roles = ROLES) -> DataFrame:
    """As above by segment; no rows if the column isn't there."""
    if segment not in df.columns:
        return df.sparkSession.createDataFrame([], f"{segment} string, entities long, positive_entities long, positive_rate double")
    own = rolled_up(presence(df, [segment], roles)).where(F.col("level") == segment)
    return own.select(F.col("value").cast(df.schema[segment].dataType).alias(segment), "entities", "positive_entities", (F.col("positive_entities") / F.col("entities")).alias("positive_rate"))
