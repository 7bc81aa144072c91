"""How well scores order the customers of an item: AUC and relative scores."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..roles import ROLES, Roles


def query_centering(df: DataFrame, roles: Roles = ROLES) -> DataFrame:
    """``centered``: the score less its query's mean."""
    return df.withColumn("centered", F.col(roles.score) - F.avg(roles.score).over(Window.partitionBy(*roles.query)))


def weighted_auc(df: DataFrame, by: Iterable[str], score: str, weight: str | None = None, roles: Roles = ROLES) -> DataFrame:
    """``by, auc, n_pos_weight, n_neg_weight``; ties count half, and the AUC is null without both classes.

    Rows are summed per distinct score first. Running sums then go in two steps, so
    that no task holds a whole item: within ranges of score, and over the ranges.
    """
    by = list(by)
    w = F.col(weight) if weight else F.lit(1.0)
    positive = F.col(roles.label) == 1
    own = df.groupBy(*by, F.col(score).alias("s")).agg(
        F.sum(F.when(positive, w).otherwise(0.0)).alias("p"), F.sum(F.when(positive, 0.0).otherwise(w)).alias("n"))
    ranged = own.repartitionByRange(*by, "s").withColumn("part", F.spark_partition_id())
    inside = Window.partitionBy(*by, "part").orderBy("s").rowsBetween(Window.unboundedPreceding, -1)
    run = ranged.withColumn("below", F.coalesce(F.sum("n").over(inside), F.lit(0.0)))
    sums = run.groupBy(*by, "part").agg(
        F.sum("p").alias("p"), F.sum("n").alias("n"), F.sum(F.col("p") * (F.col("below") + 0.5 * F.col("n"))).alias("won"))
    over = Window.partitionBy(*by).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = sums.withColumn("before", F.coalesce(F.sum("n").over(over), F.lit(0.0)))
    return parts.groupBy(*by).agg(
        F.try_divide(F.sum(F.col("won") + F.col("p") * F.col("before")), F.sum("p") * F.sum("n")).alias("auc"),
        F.sum("p").alias("n_pos_weight"), F.sum("n").alias("n_neg_weight"))


def item_auc(df: DataFrame, score: str | None = None, weight: str | None = None, roles: Roles = ROLES) -> DataFrame:
    """``item, raw_auc, centered_auc, auc_gap``: AUC of the score, of the score less its query's mean, and raw less centred.

    The gap is what the entities' overall level adds to the raw AUC: positive if buyers happen to score high on everything.
    """
    own = query_centering(df if score is None else df.withColumn(roles.score, F.col(score)), roles)
    own = own.withColumn("centered", F.round("centered", 12))  # equal but for the order of a sum: a tie
    raw, centered = (weighted_auc(own, [roles.item], c, weight, roles).select(roles.item, F.col("auc").alias(n)) for c, n in ((roles.score, "raw_auc"), ("centered", "centered_auc")))
    return raw.join(centered, roles.item).withColumn("auc_gap", F.col("raw_auc") - F.col("centered_auc"))


def item_ability(df: DataFrame, roles: Roles = ROLES) -> DataFrame:
    """Per item: mean centred score of positives and negatives, their gap, and percentiles of the rank in the query."""
    order = Window.partitionBy(*roles.query).orderBy(F.col(roles.score).desc(), roles.item)
    own = query_centering(df, roles).withColumn("pos", F.row_number().over(order))
    pos, neg = F.avg(F.when(F.col(roles.label) == 1, F.col("centered"))), F.avg(F.when(F.col(roles.label) == 0, F.col("centered")))
    return own.groupBy(roles.item).agg(
        pos.alias("mean_positive"), neg.alias("mean_negative"), (pos - neg).alias("gap"),
        *(F.percentile("pos", p / 100).alias(f"rank_p{p}") for p in (10, 50, 90)))


def candidates_per_query(df: DataFrame, roles: Roles = ROLES) -> DataFrame:
    sizes = df.groupBy(*roles.query).agg(F.count("*").alias("n"))
    return sizes.agg(F.min("n").alias("min"), F.percentile("n", 0.5).alias("median"), F.max("n").alias("max"))
