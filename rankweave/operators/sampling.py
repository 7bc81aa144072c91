"""Deterministic sampling and splitting: every draw is a hash of the row's key, so no state and no shuffle is needed."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.hashing import SCALE, stable_bucket, threshold
from ..roles import ROLES, Roles
from .filters import key_columns
from .joins import override_join

#: Bins of hash buckets that are counted to find a quantile.
BINS = 4096
RESERVED = ("stratum", "inclusion_weight")


def stratified_sample(df: DataFrame, strata: list[str], ratio: float, overrides: dict[str, float] | None = None, site: str = "train",
                      seed: int = 0, hash: str = "crc32", roles: Roles = ROLES) -> DataFrame:
    """Rows whose bucket is below their stratum's ratio; nothing is drawn if no ratio is below 1."""
    overrides = overrides or {}
    if min([ratio, *overrides.values()]) >= 1:
        return df
    rated = override_join(df, strata, overrides, ratio, "__ratio")
    drawn = stable_bucket(rated, roles.identity, SCALE, site, seed, hash)
    return rated.where(drawn < threshold(F.col("__ratio"))).drop("__ratio")


def entity_split(df: DataFrame, dev_ratio: float, site: str = "dev", seed: int = 0, hash: str = "crc32", roles: Roles = ROLES) -> tuple[DataFrame, DataFrame]:
    """Disjoint (train, dev) by entity. Fails if a ratio above 0 leaves no dev rows."""
    dev = stable_bucket(df, list(roles.entity), SCALE, site, seed, hash) < threshold(dev_ratio, "round")
    train, held = df.where(~dev), df.where(dev)
    if dev_ratio > 0 and held.isEmpty():
        raise ValueError(f"a dev ratio of {dev_ratio} leaves no rows")
    return train, held


def tune_holdout_split(df: DataFrame, tune_ratio: float, site: str = "tune", seed: int = 0, hash: str = "crc32", roles: Roles = ROLES) -> tuple[DataFrame, DataFrame]:
    """Disjoint (tune, holdout) by entity; fails unless both have rows and positives."""
    if not 0 < tune_ratio < 1:
        raise ValueError("the tune ratio must be between 0 and 1")
    own = df.withColumn("__tune", stable_bucket(df, list(roles.entity), SCALE, site, seed, hash) < threshold(tune_ratio, "round"))
    found = {r["__tune"]: r.n for r in own.groupBy("__tune").agg(F.sum(roles.label).alias("n")).collect()}
    if any(not found.get(side) for side in (True, False)):
        raise ValueError("a side has no rows, or no positives")
    return own.where("__tune").drop("__tune"), own.where("not __tune").drop("__tune")


def sampling_keys(df: DataFrame, strata: Iterable[str], carry: Iterable[str] = (), roles: Roles = ROLES) -> DataFrame:
    """Distinct rows of what a draw has to see, which it and the override join go over in place of the wide frame."""
    return df.select(*key_columns(strata, carry, roles)).distinct()


def entity_sample(df: DataFrame, ratio: float, site: str = "val", seed: int = 0, hash: str = "crc32", roles: Roles = ROLES) -> DataFrame:
    """Whole entities."""
    return df.where(stable_bucket(df, list(roles.entity), SCALE, site, seed, hash) < threshold(ratio, "round"))


def entity_bucket(df: DataFrame, n: int, salt: str = "bucket", hash: str = "crc32", roles: Roles = ROLES) -> DataFrame:
    return df.withColumn("entity_bucket", stable_bucket(df, list(roles.entity), n, salt, 0, hash).cast("int"))


def cap_queries(df: DataFrame, n: int, site: str = "cap", seed: int = 0, hash: str = "crc32", roles: Roles = ROLES) -> DataFrame:
    """All rows of n queries, those of lowest bucket.

    Buckets are counted by their first BINS, so that only the queries of the bin in which
    the n-th lies are put in order; those below are taken by their bucket alone.
    """
    keys = df.select(*roles.query).distinct()
    keys = keys.withColumn("__bucket", stable_bucket(keys, roles.query, 1 << 31, site, seed, hash)).withColumn("__bin", F.expr(f"__bucket div {(1 << 31) // BINS}"))
    left, edge = n, BINS
    for r in sorted(keys.groupBy("__bin").count().collect()):  # BINS rows at most
        if r["count"] >= left:
            edge = r["__bin"]
            break
        left -= r["count"]
    place = F.row_number().over(Window.partitionBy("__bin").orderBy("__bucket", *roles.query))
    last = keys.where(F.col("__bin") == edge).withColumn("__place", place).where(F.col("__place") <= left)
    some = keys.where(F.col("__bin") < edge).select(*roles.query).unionByName(last.select(*roles.query))
    return df.join(some, roles.query, "left_semi")


def diagnosis_sample(df: DataFrame, floor: int, budget: int, site: str = "diagnosis", seed: int = 0, hash: str = "crc32", roles: Roles = ROLES) -> DataFrame:
    """Rows of sampled queries with ``stratum`` and ``inclusion_weight``.

    Of the queries with positives, those with a positive on an item of fewer than
    ``floor`` positive queries are all taken; the rest are drawn at the ratio that
    gives ``budget`` queries. Weights are one over the design's ratio.
    """
    if taken := [c for c in RESERVED if c in df.columns]:
        raise ValueError(f"reserved column names: {taken}")
    positive = df.where(F.col(roles.label) == 1).select(*roles.query, roles.item).distinct()
    rare = positive.groupBy(roles.item).agg(F.count("*").alias("n")).where(F.col("n") < floor).select(roles.item, F.lit(1).alias("rare"))
    queries = positive.join(rare, roles.item, "left").groupBy(*roles.query).agg(F.max("rare").alias("rare"))
    size = F.broadcast(queries.where("rare is null").agg(F.count("*").alias("rest")))
    ratio = F.least(F.lit(1.0), F.lit(float(budget)) / F.greatest("rest", F.lit(1)))
    drawn = stable_bucket(queries, roles.query, SCALE, site, seed, hash) < threshold(ratio)
    taken = queries.crossJoin(size).where(F.col("rare").isNotNull() | drawn).select(
        *roles.query, F.when(F.col("rare") == 1, "take_all").otherwise("hash_ratio").alias("stratum"),
        F.when(F.col("rare") == 1, 1.0).otherwise(1 / ratio).alias("inclusion_weight"))
    return df.join(taken, roles.query)


def quadrants(df: DataFrame, k: int, roles: Roles = ROLES) -> DataFrame:
    """``quadrant``: TP, FP, FN or TN of being within the first k of the query against the label."""
    order = Window.partitionBy(*roles.query).orderBy(F.col(roles.score).desc(), roles.item)
    top, label = F.row_number().over(order) <= k, F.col(roles.label) == 1
    name = F.when(top & label, "TP").when(top, "FP").when(label, "FN").otherwise("TN")
    return df.withColumn("quadrant", name)


def stratified_top_n(df: DataFrame, strata: list[str], n: int, site: str = "top", hash: str = "crc32", roles: Roles = ROLES) -> DataFrame:
    """n rows of each stratum, those of lowest bucket. Rank limits are pushed below the shuffle, so each task sends n rows a stratum."""
    order = Window.partitionBy(*strata).orderBy("__b", *roles.identity)
    numbered = df.withColumn("__b", stable_bucket(df, roles.identity, 1 << 31, site, 0, hash)).withColumn("__n", F.row_number().over(order))
    return numbered.where(F.col("__n") <= n).drop("__n", "__b")


def extreme_cases(df: DataFrame, strata: list[str], roles: Roles = ROLES) -> DataFrame:
    """Highest and lowest score of each stratum, as ``role``; ties go to the smallest key at the top, the largest at the bottom."""
    key = F.struct(*roles.identity)
    return df.groupBy(*strata).agg(
        F.min(F.struct((-F.col(roles.score)).alias("s"), key.alias("k"))).alias("hi"),
        F.max(F.struct((-F.col(roles.score)).alias("s"), key.alias("k"))).alias("lo"),
    ).select(*strata, F.explode(F.array(F.struct(F.lit("highest").alias("role"), F.col("hi").alias("x")), F.struct(F.lit("lowest").alias("role"), F.col("lo").alias("x")))).alias("e")
    ).select(*strata, "e.role", "e.x.k.*", (-F.col("e.x.s")).alias(roles.score))


def drop_groups_without_positives(df: DataFrame, roles: Roles = ROLES) -> DataFrame:
    total = F.sum(roles.label).over(Window.partitionBy(*roles.query))
    return df.withColumn("__total", total).where("__total > 0").drop("__total")


def full_population(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    return df.select(*columns).distinct()
