"""Which items stand above the ones that customers wanted, and what is bought together."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..roles import ROLES, Roles
from .metrics import query_total_rel, rank_within_query
from .shift import exact_median


def suppression_pairs(df: DataFrame, roles: Roles = ROLES) -> DataFrame:
    """``query, target, suppressor, gap, raw, margin``: each positive's AP gap, dealt out over the negatives ranked above it.

    The severity of a pair is what the positive's precision would gain by taking
    the negative's place, plus 1 / rank of the positives between them; severities
    are scaled to the positive's gap, ``1 - precision``. The join is within a query,
    whose size the number of items bounds.
    """
    ranked = query_total_rel(rank_within_query(df, roles), roles).where("total_rel > 0")
    upto = Window.partitionBy(*roles.query).orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    own = ranked.withColumns({"cum": F.sum(roles.label).over(upto), "inv": F.sum(F.col(roles.label) / F.col("pos")).over(upto)})
    cols = [F.col(c) for c in roles.query]
    p = own.where(F.col(roles.label) == 1).select(*cols, F.col(roles.item).alias("target"), F.col("pos").alias("p_pos"), F.col("cum").alias("p_cum"), F.col("inv").alias("p_inv"), F.col(roles.score).alias("p_score"))
    n = own.where(F.col(roles.label) == 0).select(*cols, F.col(roles.item).alias("suppressor"), F.col("pos").alias("n_pos"), F.col("cum").alias("n_cum"), F.col("inv").alias("n_inv"), F.col(roles.score).alias("n_score"))
    pairs = p.join(n, roles.query).where("n_pos < p_pos")
    old = F.col("p_cum") / F.col("p_pos")
    between = F.col("p_inv") - 1 / F.col("p_pos") - F.col("n_inv")
    raw = (F.col("n_cum") + 1) / F.col("n_pos") - old + between
    pairs = pairs.withColumns({"raw": raw, "row_gap": 1 - old, "margin": F.col("n_score") - F.col("p_score")})
    total = F.sum("raw").over(Window.partitionBy(*roles.query, "target"))
    gap = F.when(total > 0, F.col("row_gap") * F.col("raw") / total).otherwise(0.0)
    return pairs.select(*roles.query, "target", "suppressor", gap.alias("gap"), "raw", "margin")


def by_pair(pairs: DataFrame) -> DataFrame:
    """``target, suppressor, gap, rows, mean_margin, share`` of the total gap."""
    key = ["target", "suppressor"]
    own = pairs.groupBy(*key).agg(F.sum("gap").alias("gap"), F.count("*").alias("rows"), F.avg("margin").alias("mean_margin"))
    own = own.join(exact_median(pairs, key, "margin").withColumnRenamed("median", "median_margin"), key)
    return own.withColumn("share", F.try_divide(F.col("gap"), F.sum("gap").over(Window.partitionBy())))


def by_target(pairs: DataFrame, top: int = 3) -> DataFrame:
    """Gap and affected rows of each target with its worst suppressors."""
    per = pairs.groupBy("target", "suppressor").agg(F.sum("gap").alias("gap"), F.count("*").alias("rows"))
    worst = per.withColumn("n", F.row_number().over(Window.partitionBy("target").orderBy(F.col("gap").desc(), "suppressor")))
    names = F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col("n") <= top, F.struct("n", "suppressor")))), lambda s: s["suppressor"]), ",")
    return worst.groupBy("target").agg(F.sum("gap").alias("gap"), F.sum("rows").alias("pairs"), names.alias("top_suppressors"))


def by_suppressor(pairs: DataFrame, roles: Roles = ROLES) -> DataFrame:
    return pairs.groupBy("suppressor").agg(F.sum("gap").alias("gap"), F.count("*").alias("pairs"), F.countDistinct(F.struct(*roles.query)).alias("queries"), F.avg("margin").alias("mean_margin"))


def examples(pairs: DataFrame, n: int, roles: Roles = ROLES) -> DataFrame:
    """The n pairs of largest gap, a report's top list."""
    return pairs.orderBy(F.col("gap").desc(), F.col("raw").desc(), *roles.query, "target", "suppressor").limit(n)


def cross_purchase(df: DataFrame, roles: Roles = ROLES) -> DataFrame:
    """``item, other, n_item, n_other, n_joint, p_other_given_item, lift`` over queries; pairs come from a query's set of positives, which the items bound."""
    sets = df.groupBy(*roles.query).agg(F.collect_set(F.when(F.col(roles.label) == 1, F.col(roles.item))).alias("own"))
    pairs = sets.select(F.explode("own").alias("item"), "own").select("item", F.explode("own").alias("other"))
    counts = pairs.groupBy("item", "other").agg(F.count("*").alias("n_joint"))
    queries = F.broadcast(sets.agg(F.count("*").alias("n_queries")))
    base = counts.where("item = other").select("item", F.col("n_joint").alias("n"))  # an item with itself: its own count
    joint = counts.where("item <> other")
    out = joint.join(base.withColumnRenamed("n", "n_item"), "item").join(base.select(F.col("item").alias("other"), F.col("n").alias("n_other")), "other")
    p = F.col("n_joint") / F.col("n_item")
    return out.crossJoin(queries).select("item", "other", "n_item", "n_other", "n_joint", p.alias("p_other_given_item"), (p * F.col("n_queries") / F.col("n_other")).alias("lift"))
