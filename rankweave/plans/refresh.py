"""Incremental refresh from plan to table: partitions are built one by one, staged, checked and committed, and a run that broke off is taken up again."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from datetime import UTC, datetime
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..sources import tables
from .partitions import plan_partitions

#: Statuses of a plan that are work to do.
WORK = ("process", "rebuild")


def committed(spark: SparkSession, audit: str, table: str, run_id: str) -> set[str]:
    """Partitions that an earlier attempt of the run has finished, from its audit records; as many as partitions."""
    if not tables.exists(spark, audit):
        return set()
    done = spark.read.schema(tables.AUDIT_SCHEMA).parquet(audit).where((F.col("run_id") == run_id) & (F.col("table_name") == table) & F.col("status").isin("committed", "empty"))
    return {r[0] for r in done.select("target_date").distinct().collect()}


def stage_partition(df: DataFrame, staging: str, values: dict[str, object], keys: Iterable[str]) -> int:
    """Write a partition's rows to staging and return how many there are; fails if the job that writes them sees rows of another partition."""
    keys = list(keys)
    stray = reduce(lambda a, b: a | b, (~F.col(k).cast("string").eqNullSafe(F.lit(str(values[k]))) for k in keys))
    seen = Observation()
    own = df.observe(seen, F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(stray.cast("long")), F.lit(0)).alias("strays"))
    fixed = {k: v for k, v in values.items() if k not in keys}
    tables.write_versioned(own, staging, fixed, keys)
    found = seen.get
    if found["strays"]:
        raise ValueError(f"{found['strays']} rows don't belong to {values}")
    return found["rows"]


def refresh(spark: SparkSession, table: str, path: str, keys: list[str], wanted: DataFrame, build: Callable[[dict[str, str]], DataFrame], audit: str, run_id: str,
            fixed: dict[str, object] | None = None, rebuild: DataFrame | None = None) -> DataFrame:
    """Bring the table at ``path`` up to the wanted partitions; returns the plan as it was carried out, ``keys, status, outcome``.

    Existing partitions come from folder names. Those to process or rebuild are taken in
    the order of their keys: ``build`` makes a partition's rows, they are staged and checked within one
    write, moved into place and recorded. Called again with the same ``run_id`` after a failure, it goes
    on with what the records lack, so that a rebuilt partition isn't built twice; a partition that
    was being replaced is built again. Skipped and surplus partitions aren't touched. Only
    the plan, a row a partition, reaches the driver.
    """
    fixed = dict(fixed or {})
    existing = tables.list_partitions(spark, path, keys, fixed)
    plan = plan_partitions(wanted.select(*(F.col(k).cast("string").alias(k) for k in keys)), existing, keys, rebuild.select(*(F.col(k).cast("string").alias(k) for k in keys)) if rebuild is not None else None)
    rows = sorted(plan.collect(), key=lambda r: tuple(str(r[k]) for k in keys))
    done = committed(spark, audit, table, run_id)
    staging, sink, outcome = f"{path}.staging-{run_id}", tables.AuditSink(spark, audit), []
    for r in rows:
        values = {k: r[k] for k in keys}
        name, began = tables.partition_path(values), datetime.now(UTC)
        if r.status not in WORK or (name in done and (r.status == "rebuild" or tables.exists(spark, f"{path}/{tables.partition_path(fixed | values)}"))):
            outcome.append("kept" if r.status not in WORK else "done before")
            continue
        try:
            n = stage_partition(build(values), staging, fixed | values, keys)
            if n:
                tables.commit_partition(spark, staging, path, fixed | values)
        except Exception as error:
            sink.record(run_id, table, name, "failed", 0, began, datetime.now(UTC), str(error)[:500])
            sink.flush()
            raise
        outcome.append("built" if n else "empty")
        sink.record(run_id, table, name, "committed" if n else "empty", n, began, datetime.now(UTC))
        sink.flush()
    return spark.createDataFrame([(*(r[k] for k in keys), r.status, o) for r, o in zip(rows, outcome, strict=True)], ", ".join([*(f"`{k}` string" for k in keys), "status string", "outcome string"]))
