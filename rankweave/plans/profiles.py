"""Profiles kept beside a table: new partitions are sketched once, old ones are never read again."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import sketches
from ..sources import tables


def update_sketches(spark: SparkSession, path: str, df: DataFrame, by: str, columns: Iterable[str], extra: Iterable[str] = (), rebuild: Iterable[str] = ()) -> list[str]:
    """Sketch the partitions of ``df`` by the column ``by`` that ``path`` lacks, and those of ``rebuild``; returns the partitions that were there and are left as they are.

    The filter on ``by`` reaches the scan, so that folders of other partitions aren't read. ``extra`` columns split a
    partition's sketches further. Each partition is written by dynamic overwrite, so a run that broke off is repeated.
    """
    have = {r[0] for r in tables.list_partitions(spark, path, [by]).collect()}  # as many as partitions
    skip = sorted(have - {str(r) for r in rebuild})
    todo = df.where(~F.col(by).cast("string").isin(skip)) if skip else df
    found = sketches.column_sketches(todo, [by, *extra], columns).withColumn(by, F.col(by).cast("string"))
    tables.write_versioned(found, path, {}, [by])
    return skip


def read_profile(spark: SparkSession, path: str, where: str = "true", keep: Iterable[str] = ()) -> DataFrame:
    """The merged profile of the stored partitions that ``where`` selects."""
    return sketches.merged(tables.read_versioned(spark, path, {}).where(where), keep)
