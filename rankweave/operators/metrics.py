"""Ranking metrics: query, segment, item and category grain, macro averages and overviews.

Ties in score go to the item that sorts first. Queries without a positive are left
out of metrics and counted apart. The row, query and segment steps all partition
by the query, so that one exchange serves them.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..roles import ROLES, Roles


def rank_within_query(df: DataFrame, roles: Roles = ROLES, pos: str = "pos") -> DataFrame:
    order = Window.partitionBy(*roles.query).orderBy(F.col(roles.score).desc(), roles.item)
    return df.withColumn(pos, F.row_number().over(order))


def query_total_rel(df: DataFrame, roles: Roles = ROLES) -> DataFrame:
    return df.withColumn("total_rel", F.sum(roles.label).over(Window.partitionBy(*roles.query)))


def ideal_dcg(total_rel: Column, k: int) -> Column:
    """Sum of 1 / log2(i + 1) for i up to min(total_rel, k); 0 without positives."""
    terms = F.sequence(F.lit(1), F.least(total_rel.cast("int"), F.lit(k)))
    return F.when(total_rel > 0, F.aggregate(terms, F.lit(0.0), lambda s, i: s + 1 / F.log2(i + 1.0))).otherwise(0.0)


def row_contributions(df: DataFrame, ks: Iterable[int], roles: Roles = ROLES) -> DataFrame:
    """Adds ``cum_rel, prec_at_pos, dcg_term`` and, for each k, ``hit@k, ap@k, ndcg@k`` to ranked rows with ``pos, total_rel``."""
    upto = Window.partitionBy(*roles.query).orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    label = F.col(roles.label)
    out = df.withColumn("cum_rel", F.sum(roles.label).over(upto)).withColumns(
        {"prec_at_pos": F.col("cum_rel") / F.col("pos"), "dcg_term": label / F.log2(F.col("pos") + 1.0)}
    )
    cols = {}
    for k in ks:
        top = F.when(F.col("pos") <= k, 1).otherwise(0)
        cols[f"hit@{k}"] = top * label
        cols[f"ap@{k}"] = top * label * F.col("prec_at_pos")
        cols[f"ndcg@{k}"] = F.try_divide(top * F.col("dcg_term"), ideal_dcg(F.col("total_rel"), k))
    return out.withColumns(cols)


def enrich(df: DataFrame, ks: Iterable[int], roles: Roles = ROLES) -> DataFrame:
    """Ranked rows with their contributions, of queries with a positive."""
    ranked = query_total_rel(rank_within_query(df, roles), roles).where("total_rel > 0")
    return row_contributions(ranked, ks, roles)


def per_query_metrics(enriched: DataFrame, ks: Iterable[int], roles: Roles = ROLES, carry: Iterable[str] = ()) -> DataFrame:
    """One row per query: map, ndcg, precision and recall at each k; ``carry`` columns are constant in a query."""
    aggs = [F.first(c).alias(c) for c in carry]
    for k in ks:
        hits = F.sum(f"hit@{k}")
        aggs += [
            (F.sum(f"ap@{k}") / F.max("total_rel")).alias(f"map@{k}"), F.sum(f"ndcg@{k}").alias(f"ndcg@{k}"),
            (hits / k).alias(f"precision@{k}"), (hits / F.max("total_rel")).alias(f"recall@{k}"),
        ]
    return enriched.groupBy(*roles.query).agg(*aggs)


def metric_names(ks: Iterable[int]) -> list[str]:
    return [f"{m}@{k}" for k in ks for m in ("map", "ndcg", "precision", "recall")]


def overall_metrics(per_query: DataFrame, ks: Iterable[int]) -> DataFrame:
    return per_query.agg(*(F.avg(m).alias(m) for m in metric_names(ks)), F.count("*").alias("n_queries"))


def segment_metrics(per_query: DataFrame, segment: str, ks: Iterable[int]) -> DataFrame:
    return per_query.groupBy(segment).agg(*(F.avg(m).alias(m) for m in metric_names(ks)), F.count("*").alias("n_queries"))


def item_metrics(enriched: DataFrame, dims: Iterable[str], ks: Iterable[int], roles: Roles = ROLES) -> DataFrame:
    """Per group of ``dims`` over positive rows: hit_rate, map_attr and ndcg_attr at each k, mean_pos and n_pos."""
    aggs = []
    for k in ks:
        aggs += [F.avg(f"{a}@{k}").alias(f"{b}@{k}") for a, b in (("hit", "hit_rate"), ("ap", "map_attr"), ("ndcg", "ndcg_attr"))]
    positive = enriched.where(F.col(roles.label) == 1)
    return positive.groupBy(*dims).agg(*aggs, F.avg("pos").alias("mean_pos"), F.count("*").alias("n_pos"))


def macro_average(per_item: DataFrame, metrics: Iterable[str], min_positives: int = 0, shrink: float = 0.0, alpha: float = 0.0) -> DataFrame:
    """One row: drop items under ``min_positives``, shrink towards the pooled mean by n / (n + shrink), weight by n_pos ** alpha."""
    kept = per_item.where(F.col("n_pos") >= min_positives)
    n = F.col("n_pos")
    pooled = kept.agg(*((F.sum(F.col(f"`{m}`") * n) / F.sum(n)).alias(f"pool {m}") for m in metrics))
    weight, lam = F.pow(n.cast("double"), F.lit(float(alpha))), n / (n + F.lit(float(shrink)))
    both = kept.crossJoin(F.broadcast(pooled))  # one row
    shrunk = {m: lam * F.col(f"`{m}`") + (1 - lam) * F.col(f"`pool {m}`") for m in metrics}
    return both.agg(*((F.sum(weight * v) / F.sum(weight)).alias(f"macro_{m}") for m, v in shrunk.items()), F.count("*").alias("n_items"))


def observation_items(per_item: DataFrame, min_positives: int) -> DataFrame:
    return per_item.where(F.col("n_pos") < min_positives)


def category_map(items: DataFrame, mapping: DataFrame, roles: Roles = ROLES) -> DataFrame:
    """``item, category`` of every declared item; items without one are their own. Fails on mapped items that aren't declared."""
    stray = mapping.join(items, roles.item, "left_anti").limit(5).collect()
    if stray:
        raise ValueError(f"categories of unknown items: {[r[roles.item] for r in stray]}")
    return items.select(roles.item).join(mapping, roles.item, "left").select(roles.item, F.coalesce("category", roles.item).alias("category"))


def collapse_to_categories(df: DataFrame, categories: DataFrame, roles: Roles = ROLES, carry: Iterable[str] = ()) -> DataFrame:
    """Per query and category: best score, any label; rows of unmapped items vanish. The category takes the item's place."""
    joined = df.join(categories, roles.item).drop(roles.item).withColumnRenamed("category", roles.item)
    return joined.groupBy(*roles.identity).agg(
        F.max(roles.score).alias(roles.score), F.max(roles.label).alias(roles.label), *(F.first(c).alias(c) for c in carry)
    )


def per_item_ap(enriched: DataFrame, k: int, weight: str | None = None, roles: Roles = ROLES) -> DataFrame:
    """``item, ap, n_pos``: weighted mean of the positives' precision at their position, within the first k."""
    w = F.col(weight) if weight else F.lit(1.0)
    positive = enriched.where(F.col(roles.label) == 1)
    return positive.groupBy(roles.item).agg((F.sum(w * F.col(f"ap@{k}")) / F.sum(w)).alias("ap"), F.count("*").alias("n_pos"))
