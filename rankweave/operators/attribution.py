"""Aggregates of attribution tables ``(query, item, feature, value)``: profiles, divergence and margins."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..roles import ROLES, Roles


def linear_attributions(df: DataFrame, coefficients: dict[str, float], keep: Iterable[str]) -> DataFrame:
    """Long table of coefficient times (value - mean), for the features of a linear model."""
    names = list(coefficients)
    means = F.broadcast(df.agg(*(F.avg(c).alias(f"__m {c}") for c in names)))
    terms = F.array(*(F.struct(F.lit(c).alias("feature"), (F.lit(float(coefficients[c])) * (F.col(c) - F.col(f"`__m {c}`"))).alias("value")) for c in names))
    return df.crossJoin(means).select(*keep, F.explode(terms).alias("x")).select(*keep, "x.*")


def signed_profile(df: DataFrame, dims: list[str], top: int) -> DataFrame:
    """``dims, feature, mean_abs, mean_signed, place`` of each group's top features."""
    own = df.groupBy(*dims, "feature").agg(F.avg(F.abs("value")).alias("mean_abs"), F.avg("value").alias("mean_signed"))
    place = F.row_number().over(Window.partitionBy(*dims).orderBy(F.col("mean_abs").desc(), "feature"))
    return own.withColumn("place", place).where(F.col("place") <= top)


def profile_divergence(df: DataFrame, dims: list[str], top: int) -> DataFrame:
    """``dims, jaccard, idiosyncratic``: each group's top features against those of all rows."""
    names = lambda d: F.array_sort(F.collect_set("feature"))
    own = signed_profile(df, dims, top).groupBy(*dims).agg(names(dims).alias("mine"))
    every = signed_profile(df.withColumn("__all", F.lit(1)), ["__all"], top).groupBy("__all").agg(names([]).alias("global"))
    both = own.crossJoin(F.broadcast(every.drop("__all")))
    jaccard = F.size(F.array_intersect("mine", "global")) / F.size(F.array_union("mine", "global"))
    return both.select(*dims, jaccard.alias("jaccard"), F.array_join(F.array_except("mine", "global"), ",").alias("idiosyncratic"))


def rank_divergence(df: DataFrame, dims: list[str]) -> DataFrame:
    """``dims, divergence``: (1 - Spearman) / 2 between each group's mean absolute values by feature and those of all rows; ties share their mean rank.

    0 is the same order of features, 1 the opposite; a group or a whole without variation gives 0.
    """
    size = F.avg(F.abs("value"))
    own, every = df.groupBy(*dims, "feature").agg(size.alias("v")), df.groupBy("feature").agg(size.alias("g"))
    joined = own.join(every, "feature")  # groups times features

    def place(column: str):
        part = Window.partitionBy(*dims)
        return F.rank().over(part.orderBy(column)) + (F.count("*").over(Window.partitionBy(*dims, column)) - 1) / 2.0

    ranked = joined.withColumns({"__a": place("v"), "__b": place("g")})
    rho = F.try_divide(F.covar_pop("__a", "__b"), F.stddev_pop("__a") * F.stddev_pop("__b"))
    return ranked.groupBy(*dims).agg(F.coalesce((1 - rho) / 2, F.lit(0.0)).alias("divergence"))


def score_summary(df: DataFrame, roles: Roles = ROLES) -> DataFrame:
    return df.groupBy(roles.item).agg(F.min(roles.score).alias("min"), F.max(roles.score).alias("max"), F.avg(roles.score).alias("mean"), (F.max(roles.label) == 1).alias("has_positive"))


def margin_decomposition(df: DataFrame, target: str, other: str, roles: Roles = ROLES) -> DataFrame:
    """``feature, mean_difference, queries``: attribution of the target less that of the other item, in the same query."""
    a = df.where(F.col(roles.item) == target).select(*roles.query, "feature", F.col("value").alias("t"))
    b = df.where(F.col(roles.item) == other).select(*roles.query, "feature", F.col("value").alias("o"))
    return a.join(b, [*roles.query, "feature"]).groupBy("feature").agg(F.avg(F.col("t") - F.col("o")).alias("mean_difference"), F.count("*").alias("queries"))
