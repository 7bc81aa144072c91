"""Comparing two sources of predictions on what they share."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..roles import ROLES, Roles
from .filters import require_rows
from .joins import join_predictions
from .metrics import rank_within_query


def external_predictions(df: DataFrame, columns: dict[str, str], item_map: DataFrame | None = None, date: str | None = None, drop_unmapped: bool = True, roles: Roles = ROLES) -> DataFrame:
    """Rename columns to roles, keep a date, map items many to one, and keep the best score of each identity.

    ``item_map(source, item)``. Unmapped items are dropped, or fail if asked.
    """
    own = df.select(*(F.col(old).alias(new) for old, new in columns.items()))
    if date is not None:
        own = own.where(F.to_date(roles.time) == F.to_date(F.lit(date)))
    if item_map is not None:
        own = own.withColumnRenamed(roles.item, "source")
        if not drop_unmapped:
            stray = own.select("source").distinct().join(item_map, "source", "left_anti").limit(5).collect()
            if stray:
                raise ValueError(f"unmapped items: {[r.source for r in stray]}")
        own = own.join(item_map.select("source", F.col("item").alias(roles.item)), "source").drop("source")
    return own.groupBy(*roles.identity).agg(F.max(roles.score).alias(roles.score))


def own_predictions(df: DataFrame, version: str, date: str, roles: Roles = ROLES) -> DataFrame:
    return require_rows(df.where((F.col("version") == version) & (F.to_date(roles.time) == F.to_date(F.lit(date)))), f"{version} on {date}").drop("version")


def common_universe(a: DataFrame, b: DataFrame, columns: Iterable[str]) -> DataFrame:
    columns = list(columns)
    return a.select(*columns).intersect(b.select(*columns))


def restrict_to_common(a: DataFrame, b: DataFrame, labels: DataFrame, roles: Roles = ROLES) -> tuple[DataFrame, DataFrame]:
    """Both sides on shared entities and items, labelled and ranked anew; stays a join of sets, whatever their size. Fails if nothing is shared."""
    entities = common_universe(a, b, roles.entity)
    items = common_universe(a, b, [roles.item])
    for name, shared in (("entities", entities), ("items", items)):
        if shared.isEmpty():
            raise ValueError(f"the two sides share no {name}")

    def cut(df: DataFrame) -> DataFrame:
        kept = df.join(entities, list(roles.entity), "left_semi").join(items, roles.item, "left_semi")
        return rank_within_query(join_predictions(kept, labels, roles), roles, roles.rank)

    return cut(a), cut(b)


def comparison_delta(a: DataFrame, b: DataFrame, keys: Iterable[str]) -> DataFrame:
    """``keys, a, b, delta`` of two long tables ``(keys, value)``; what one side lacks is 0."""
    keys = list(keys)
    joined = a.withColumnRenamed("value", "a").join(b.withColumnRenamed("value", "b"), keys, "full")
    va, vb = F.coalesce("a", F.lit(0.0)), F.coalesce("b", F.lit(0.0))
    return joined.select(*keys, va.alias("a"), vb.alias("b"), (va - vb).alias("delta"))


def comparison_coverage(a: DataFrame, b: DataFrame, roles: Roles = ROLES) -> DataFrame:
    """``side, kind, total, common, dropped`` for entities and items."""
    parts = []
    for kind, cols in (("entity", list(roles.entity)), ("item", [roles.item])):
        flagged = a.select(*cols, F.lit(1).alias("a"), F.lit(0).alias("b")).unionByName(b.select(*cols, F.lit(0).alias("a"), F.lit(1).alias("b")))
        sets = flagged.groupBy(*cols).agg(F.max("a").alias("a"), F.max("b").alias("b"))
        for side in ("a", "b"):
            parts.append(sets.where(F.col(side) == 1).agg(F.count("*").alias("total"), F.coalesce(F.sum(F.col("a") * F.col("b")), F.lit(0)).alias("common")).select(
                F.lit(side).alias("side"), F.lit(kind).alias("kind"), "total", "common", (F.col("total") - F.col("common")).alias("dropped")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
