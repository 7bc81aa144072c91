"""Incremental refresh: which partitions to build, and guards on what a frame holds."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def plan_partitions(wanted: DataFrame, existing: DataFrame, keys: list[str], rebuild: DataFrame | None = None) -> DataFrame:
    """``keys, status``: process (wanted, not there), skip (there), rebuild (there, forced) or surplus (there, not wanted)."""
    w, e = wanted.select(*keys).distinct().withColumn("w", F.lit(1)), existing.select(*keys).distinct().withColumn("e", F.lit(1))
    joined = w.join(e, keys, "full")
    if rebuild is not None:
        joined = joined.join(rebuild.select(*keys).distinct().withColumn("r", F.lit(1)), keys, "left")
    else:
        joined = joined.withColumn("r", F.lit(None).cast("int"))
    status = F.when(F.col("w").isNull(), "surplus").when(F.col("e").isNull(), "process").when(F.col("r") == 1, "rebuild").otherwise("skip")
    return joined.select(*keys, status.alias("status"))


def populated_buckets(df: DataFrame, by: str, bucket: str = "entity_bucket") -> DataFrame:
    return df.groupBy(by).agg(F.array_sort(F.collect_set(bucket)).alias("buckets"))


def work_grid(dates: DataFrame, buckets: DataFrame, items: DataFrame) -> DataFrame:
    """``place, ...``: every date, bucket and item, numbered in that order, so that runs take the same pieces of work in the same order."""
    grid = dates.distinct().crossJoin(F.broadcast(buckets.distinct())).crossJoin(F.broadcast(items.distinct()))  # a plan's own lists
    place = F.row_number().over(Window.partitionBy().orderBy(*grid.columns))
    return grid.select(place.alias("place"), *grid.columns)


def require_unique(df: DataFrame, keys: Iterable[str]) -> DataFrame:
    """The frame's rows; the job that reads them fails if rows share their keys, as a join on them would then make more rows.

    The keys alone are counted, in a subquery of the job that prunes all other columns from
    its scan; the rows themselves are neither grouped nor moved.
    """
    keys = list(keys)
    message = F.concat(F.lit("repeated key: "), F.concat_ws("|", *(F.col(k).cast("string") for k in keys)))
    counted = df.groupBy(*keys).agg(F.count("*").alias("__n"))
    twice = counted.where(F.when(F.col("__n") > 1, F.raise_error(message).cast("boolean")).otherwise(False)).agg(F.count("*").alias("__n"))
    return df.where(twice.scalar() == 0)


def require_single_partition(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """The frame itself; raises unless all its rows belong to one partition."""
    columns = list(columns)
    seen = df.select(*columns).distinct().limit(2).collect()
    if len(seen) != 1:
        raise ValueError(f"rows of {len(seen) or 'no'} partitions{'' if len(seen) < 2 else ' or more'} by {columns}")
    return df


def require_population_covers(population: DataFrame, dates: Iterable[str], time: str) -> DataFrame:
    dates = list(dates)
    have = {str(r[0]) for r in population.select(F.to_date(time)).distinct().where(F.to_date(time).isin(*dates)).collect()}
    if missing := [d for d in dates if d not in have]:
        raise ValueError(f"population lacks {missing}")
    return population
