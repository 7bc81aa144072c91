"""Score and rank distributions, item by item."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..roles import ROLES, Roles


def score_histogram(df: DataFrame, bins: int, roles: Roles = ROLES) -> DataFrame:
    """``item, bin, lo, hi, count`` on equal bins of the whole table's range; one bin if the score is constant."""
    span = F.broadcast(df.agg(F.min(roles.score).alias("mn"), F.max(roles.score).alias("mx")))
    width = (F.col("mx") - F.col("mn")) / bins
    at = F.when(width > 0, F.least(F.floor(F.try_divide(F.col(roles.score) - F.col("mn"), width)), F.lit(bins - 1))).otherwise(0).cast("int")
    counts = df.crossJoin(span).groupBy(roles.item, at.alias("bin"), "mn", width.alias("w")).agg(F.count("*").alias("count"))
    return counts.select(roles.item, "bin", (F.col("mn") + F.col("bin") * F.col("w")).alias("lo"), (F.col("mn") + (F.col("bin") + 1) * F.col("w")).alias("hi"), "count")


def box_stats(df: DataFrame, roles: Roles = ROLES, accuracy: int = 10_000) -> DataFrame:
    """Quartiles per item and label, and Tukey's fences within the data's range; percentiles are sketches, so no group is collected."""
    q = df.groupBy(roles.item, roles.label).agg(F.percentile_approx(roles.score, [0.0, 0.25, 0.5, 0.75, 1.0], accuracy).alias("q"), F.count("*").alias("n"))
    q = q.select(roles.item, roles.label, "n", *(F.col("q")[i].alias(c) for i, c in enumerate(("low", "q1", "median", "q3", "high"))))
    iqr = 1.5 * (F.col("q3") - F.col("q1"))
    return q.withColumns({"lower_fence": F.greatest("low", F.col("q1") - iqr), "upper_fence": F.least("high", F.col("q3") + iqr)})


def rank_counts(df: DataFrame, n_items: int, roles: Roles = ROLES) -> DataFrame:
    """A row per item and a column per rank 1 to n_items, filled with zeros."""
    pivot = df.groupBy(roles.item).pivot(roles.rank, list(range(1, n_items + 1))).count().na.fill(0)
    return pivot.select(roles.item, *(F.col(str(i)).alias(f"rank_{i}") for i in range(1, n_items + 1)))


def positive_rank_counts(df: DataFrame, n_items: int, roles: Roles = ROLES) -> DataFrame:
    return rank_counts(df.where(F.col(roles.label) == 1), n_items, roles)


def positive_rate(df: DataFrame, roles: Roles = ROLES) -> DataFrame:
    return df.groupBy(roles.item, roles.rank).agg(F.avg(roles.label).alias("positive_rate"), F.count("*").alias("rows"))


def item_share_by_rank(df: DataFrame, roles: Roles = ROLES) -> DataFrame:
    counts = df.groupBy(roles.item, roles.rank).agg(F.count("*").alias("rows"))
    return counts.withColumn("share", F.col("rows") / F.sum("rows").over(Window.partitionBy(roles.rank)))


def calibration_bins(df: DataFrame, bins: int, roles: Roles = ROLES) -> DataFrame:
    """``item, bin, mean_score, mean_label, rows`` on uniform bins of 0 to 1; items with fewer rows than bins or no positive are left out."""
    at = F.greatest(F.least(F.floor(F.col(roles.score) * bins), F.lit(bins - 1)), F.lit(0)).cast("int")
    per = df.groupBy(roles.item, at.alias("bin")).agg(F.sum(roles.score).alias("s"), F.sum(roles.label).alias("p"), F.count("*").alias("rows"))
    item = Window.partitionBy(roles.item)
    kept = per.withColumns({"all_rows": F.sum("rows").over(item), "all_p": F.sum("p").over(item)}).where((F.col("all_rows") >= bins) & (F.col("all_p") > 0))
    return kept.select(roles.item, "bin", (F.col("s") / F.col("rows")).alias("mean_score"), (F.col("p") / F.col("rows")).alias("mean_label"), "rows")
