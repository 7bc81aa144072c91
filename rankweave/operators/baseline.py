"""Popularity baselines: what each item sold in a window before the snapshot."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..roles import ROLES, Roles


def _windows(labels: DataFrame, snapshots: Iterable[str], months: int) -> DataFrame:
    rows = labels.sparkSession.createDataFrame([(s,) for s in snapshots], "s string").select(F.to_date("s").alias("snapshot"))
    return rows.withColumn("start", F.add_months("snapshot", -months))


def popularity_counts(labels: DataFrame, snapshots: Iterable[str], months: int, roles: Roles = ROLES) -> DataFrame:
    """``snapshot, item, count, fallback``: labels of each item in ``[snapshot - months, snapshot)``.

    A snapshot whose window is empty counts the whole table instead, flagged, as
    that looks into the future. Labels are summed per item and date first, so the
    range join meets a small table.
    """
    daily = labels.groupBy(roles.item, F.to_date(roles.time).alias("day")).agg(F.sum(roles.label).alias("n"))
    windows = _windows(labels, snapshots, months)
    inside = daily.join(F.broadcast(windows), (F.col("day") >= F.col("start")) & (F.col("day") < F.col("snapshot")))  # the caller's list
    found = inside.groupBy("snapshot", roles.item).agg(F.sum("n").alias("count")).withColumn("fallback", F.lit(False))
    total = daily.groupBy(roles.item).agg(F.sum("n").alias("count"))
    empty = windows.select("snapshot").join(found.select("snapshot").distinct(), "snapshot", "left_anti")
    whole = total.crossJoin(F.broadcast(empty)).select("snapshot", roles.item, "count", F.lit(True).alias("fallback"))  # the missing snapshots, the items
    return found.unionByName(whole)


def monthly_popularity(labels: DataFrame, snapshots: Iterable[str], months: int, roles: Roles = ROLES) -> DataFrame:
    """As popularity_counts, by ``month`` (yyyy-MM), without a fallback."""
    daily = labels.groupBy(roles.item, F.to_date(roles.time).alias("day")).agg(F.sum(roles.label).alias("n"))
    inside = daily.join(F.broadcast(_windows(labels, snapshots, months)), (F.col("day") >= F.col("start")) & (F.col("day") < F.col("snapshot")))
    return inside.groupBy("snapshot", roles.item, F.date_format("day", "yyyy-MM").alias("month")).agg(F.sum("n").alias("count"))


def baseline_frame(df: DataFrame, counts: DataFrame, roles: Roles = ROLES) -> DataFrame:
    """The frame with popularity as its score; items without a count score 0."""
    own = counts.select(F.col("snapshot").alias(roles.time), roles.item, F.col("count").cast("double").alias("__count"))
    joined = df.withColumn(roles.time, F.to_date(roles.time)).join(own, [roles.time, roles.item], "left")
    return joined.withColumn(roles.score, F.coalesce("__count", F.lit(0.0))).drop("__count")
