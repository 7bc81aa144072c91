"""Column, entity and stratum statistics."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..roles import ROLES, Roles


def _unpivot(df: DataFrame, columns: Iterable[str], stats: dict[str, dict]) -> DataFrame:
    rows = [F.struct(F.lit(c).alias("column"), *(v.cast(_KIND.get(n, "double")).alias(n) for n, v in stats[c].items())) for c in columns]
    return df.select(F.explode(F.array(*rows)).alias("x")).select("x.*")


_KIND = {"rows": "long", "distinct": "long", "single_value": "boolean", "high_null": "boolean", "kind": "string", "bucket": "string"}


def column_profile(df: DataFrame, max_categories: int = 50, rsd: float = 0.05) -> DataFrame:
    """``column, kind, distinct, bucket``: approximate distinct values of every atomic column in one pass; categorical, drop (constant), numeric or review."""
    kinds = {c: t for c, t in df.dtypes}
    plain = [c for c, t in kinds.items() if not t.startswith(("array", "map", "struct", "binary", "date", "timestamp"))]
    one = df.agg(*(F.approx_count_distinct(c, rsd).alias(c) for c in plain)) if plain else df.sparkSession.createDataFrame([(0,)], "none int")
    stats = {}
    for c, t in kinds.items():
        n = F.col(f"`{c}`") if c in plain else F.lit(None)
        if c not in plain:
            bucket = F.lit("review")
        elif t in ("string", "boolean"):
            bucket = F.when(n <= 1, "drop").when(n <= max_categories, "categorical").otherwise("review")
        else:
            bucket = F.when(n <= 1, "drop").otherwise("numeric")
        stats[c] = {"kind": F.lit(t), "distinct": n, "bucket": bucket}
    return _unpivot(one, kinds, stats)


def feature_statistics(df: DataFrame, columns: Iterable[str], high_null: float = 0.5) -> DataFrame:
    """Null rate, distinct values, flags, mean, standard deviation and range of each feature, from one aggregate."""
    columns = list(columns)
    aggs = [F.count("*").alias("__n")]
    for c in columns:
        aggs += [F.count(c).alias(f"{c} n"), F.countDistinct(c).alias(f"{c} d"), F.avg(c).alias(f"{c} m"), F.stddev_samp(c).alias(f"{c} s"), F.min(c).alias(f"{c} lo"), F.max(c).alias(f"{c} hi")]
    one = df.agg(*aggs)
    stats = {}
    for c in columns:
        rate = 1 - F.try_divide(F.col(f"`{c} n`"), F.col("__n"))
        stats[c] = {"null_rate": rate, "distinct": F.col(f"`{c} d`"), "single_value": F.col(f"`{c} d`") <= 1, "high_null": rate > high_null,
                    "mean": F.col(f"`{c} m`"), "std": F.col(f"`{c} s`"), "min": F.col(f"`{c} lo`"), "max": F.col(f"`{c} hi`")}
    return _unpivot(one, columns, stats)


def stratum_profile(df: DataFrame, strata: list[str], roles: Roles = ROLES) -> DataFrame:
    return df.groupBy(*strata).agg(F.sum(roles.label).alias("n_pos"), F.sum(1 - F.col(roles.label)).alias("n_neg"))


def ratio_surface(profile: DataFrame, mult: float) -> DataFrame:
    """Adds ``ratio``: the share of negatives to keep for ``mult`` negatives a positive; all stay where there is no positive."""
    ratio = F.when(F.col("n_pos") == 0, 1.0).otherwise(F.least(F.greatest(F.coalesce(F.try_divide(F.lit(float(mult)) * F.col("n_pos"), F.col("n_neg")), F.lit(1.0)), F.lit(0.0)), F.lit(1.0)))
    kept = F.col("n_neg") * F.col("ratio")
    return profile.withColumn("ratio", ratio).withColumns({"kept_neg": kept, "new_rate": F.try_divide(F.col("n_pos"), F.col("n_pos") + kept)})


def weight_surface(surface: DataFrame, target: float, alpha: float, base: str = "coupled", phi: float = 1.0) -> DataFrame:
    """Adds ``floor, mass, attention, w_pos, w_neg``: the negatives' weight that gives a positive rate ``target``, and attention shared by mass.

    The base of negatives is what the ratio surface keeps ("coupled"), or the share
    ``phi`` of all of them whatever the ratios ("decoupled").
    """
    if base not in ("coupled", "decoupled"):
        raise ValueError(f"unknown base {base}")
    if base == "decoupled":
        surface = surface.withColumn("kept_neg", F.col("n_neg") * F.lit(float(phi)))
    floor = F.try_divide(F.col("n_pos") * (1 - target), target * F.col("kept_neg"))
    own = surface.withColumn("floor", F.coalesce(floor, F.lit(1.0))).withColumn("mass", F.col("n_pos") + F.col("floor") * F.col("kept_neg"))
    least = F.min(F.when(F.col("mass") > 0, F.col("mass"))).over(Window.partitionBy())  # a row a stratum
    attention = F.when(F.col("mass") > 0, F.pow(F.try_divide(least, F.col("mass")), F.lit(float(alpha)))).otherwise(1.0)
    return own.withColumn("attention", attention).withColumns({"w_pos": F.col("attention"), "w_neg": F.col("attention") * F.col("floor")})
