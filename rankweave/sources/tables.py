"""Versioned, partitioned Parquet tables: scans pinned to partition values, dynamic overwrite, append-only schema evolution."""

from __future__ import annotations

import json
import re
import tempfile
import uuid
from collections.abc import Iterable
from datetime import datetime
from urllib.parse import quote, unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .layout import balanced

#: Characters that Spark leaves as they are in folder names.
PLAIN = " !$&()+,-.;@_~"
#: Readers skip names that begin with a line.
SCHEMA_FILE = "_columns.json"
AUDIT_SCHEMA = "run_id string, table_name string, target_date string, status string, rows long, started timestamp, finished timestamp, message string"


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, as the session names it; a local session without one (tests) gets its own."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        folder = tempfile.mkdtemp(prefix="rankweave-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """The frame as a table of its own in the shared folder, for plans that read it more than once in different ways; a lost executor costs nothing."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def exists(spark: SparkSession, path: str) -> bool:
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jvm_path)


def read_source(spark: SparkSession, source: str, where: str | None = None, fraction: float | None = None, seed: int = 0) -> DataFrame:
    """A path (with a slash) or a table name, with an optional predicate and Bernoulli sample."""
    df = spark.read.parquet(source) if "/" in source else spark.table(source)
    df = df.where(where) if where else df
    return df.sample(fraction=fraction, seed=seed) if fraction is not None else df


def table_schema(spark: SparkSession, path: str, partitions: Iterable[str] = ()) -> T.StructType:
    """The columns of all partitions of a table, without those it is partitioned by.

    :func:`write_versioned` keeps them in a file of the table's folder, so that no footer is read;
    for a table that another writer made, footers are merged.
    """
    name = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{SCHEMA_FILE}")
    system = name.getFileSystem(spark._jsc.hadoopConfiguration())
    if system.exists(name):
        stream = system.open(name)
        try:
            return T.StructType.fromJson(json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")))
        finally:
            stream.close()
    return T.StructType([f for f in spark.read.option("mergeSchema", "true").parquet(path).schema if f.name not in set(partitions)])


def _keep_schema(spark: SparkSession, path: str, schema: T.StructType) -> None:
    """Written beside and renamed, before the data: columns that no file has yet are read as nulls."""
    kept = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{SCHEMA_FILE}")
    beside = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{SCHEMA_FILE}.{uuid.uuid4().hex}")
    system = kept.getFileSystem(spark._jsc.hadoopConfiguration())
    stream = system.create(beside, True)
    stream.write(bytearray(schema.json(), "utf-8"))
    stream.close()
    system.delete(kept, False)
    system.rename(beside, kept)


def read_versioned(spark: SparkSession, path: str, fixed: dict[str, object]) -> DataFrame:
    """The partitions of constant values, without the constant columns; the filter prunes directories.

    All columns that any partition was written with are there, null where a partition lacks them.
    """
    df = spark.read.schema(table_schema(spark, path)).parquet(path)
    for name, value in fixed.items():
        df = df.where(F.col(name) == F.lit(value))
    return df.drop(*fixed)


def inject_versions(df: DataFrame, fixed: dict[str, object]) -> DataFrame:
    """Adds missing constant columns; one that is there must hold that single value."""
    for name, value in fixed.items():
        if name in df.columns:
            seen = [r[0] for r in df.select(name).distinct().limit(2).collect()]
            if any(str(s) != str(value) for s in seen) or len(seen) > 1:
                raise ValueError(f"{name} holds {seen}, not {value}")
        else:
            df = df.withColumn(name, F.lit(value))
    return df


def infer_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[tuple[str, str]]:
    return [(n, t) for n, t in df.dtypes if n not in set(exclude)]


def evolve_schema(df: DataFrame, target: T.StructType, allow_removed: bool = True) -> DataFrame:
    """The frame in the target's order: absent columns as typed nulls, new ones appended; a type conflict fails, nothing is cast.

    With ``allow_removed`` false, a column that the target has and the frame lacks fails.
    """
    have = {f.name: f for f in df.schema}
    for f in target:
        if f.name in have and have[f.name].dataType != f.dataType:
            raise TypeError(f"{f.name} is {have[f.name].dataType.simpleString()}, the table has {f.dataType.simpleString()}")
        if f.name not in have and not allow_removed:
            raise ValueError(f"column {f.name} was removed")
    old = [F.col(f.name) if f.name in have else F.lit(None).cast(f.dataType).alias(f.name) for f in target]
    return df.select(*old, *(c for c in df.columns if c not in target.fieldNames()))


def write_versioned(df: DataFrame, path: str, fixed: dict[str, object], partitions: list[str], mode: str = "overwrite", balance: bool = False) -> None:
    """Replace only the partitions that the frame holds (or append), under the constant columns.

    With ``balance`` rows are dealt out by partition first, for files of even size.
    """
    out = inject_versions(df, fixed)
    spark = df.sparkSession
    keys = [*fixed, *partitions]
    if exists(spark, path):
        order = table_schema(spark, path, keys)
        kinds = {f.name: f.dataType for f in out.schema}
        out = evolve_schema(out, T.StructType([*order.fields, *(T.StructField(k, kinds[k]) for k in keys)]))
    _keep_schema(spark, path, T.StructType([T.StructField(f.name, f.dataType) for f in out.schema if f.name not in keys]))
    out = balanced(out, partitions) if balance else out
    out.write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy(*fixed, *partitions).parquet(path)


def list_partitions(spark: SparkSession, path: str, columns: list[str], where: dict[str, object] | None = None) -> DataFrame:
    """Existing partition values as strings, from folder names alone; no rows if the table isn't there.

    Folders are listed level by level, and ``where`` prunes on the way: as many
    names as there are partitions come to the driver, whatever the number of files.
    """
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    wanted, rows = {k: str(v) for k, v in (where or {}).items()}, set()
    todo = [(path, {})] if exists(spark, path) else []
    system = spark._jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    while todo:
        folder, named = todo.pop()
        if all(c in named for c in [*columns, *wanted]):
            rows.add(tuple(None if named[c] == "__HIVE_DEFAULT_PARTITION__" else named[c] for c in columns))
            continue
        for status in system.listStatus(spark._jvm.org.apache.hadoop.fs.Path(folder)):
            name, _, value = status.getPath().getName().partition("=")
            value = unquote(value)
            if status.isDirectory() and value and wanted.get(name, value) == value:
                todo.append((status.getPath().toString(), {**named, name: value}))
    return spark.createDataFrame(sorted(rows, key=str), schema)


def partition_path(values: dict[str, object]) -> str:
    """The folder of partition values below a table, as Spark names it."""
    return "/".join(f"{quote(k, safe=PLAIN)}={quote(str(v), safe=PLAIN)}" for k, v in values.items())


def commit_partition(spark: SparkSession, staging: str, production: str, values: dict[str, object]) -> None:
    """Move one written partition from ``staging`` into ``production``, in place of the one that is there.

    The old folder is put aside under a hidden name, the new one renamed, then the old one
    deleted: a run that breaks off leaves the partition as it was, or missing and so to be
    built again, never half written. Columns of both tables stay known.
    """
    kept = list(table_schema(spark, production, values)) if exists(spark, production) else []
    names = {f.name for f in kept}
    _keep_schema(spark, production, T.StructType([*kept, *(f for f in table_schema(spark, staging, values) if f.name not in names)]))
    path = lambda name: spark._jvm.org.apache.hadoop.fs.Path(name)
    system = path(production).getFileSystem(spark._jsc.hadoopConfiguration())
    folder = partition_path(values)
    new, old, aside = path(f"{staging}/{folder}"), path(f"{production}/{folder}"), path(f"{production}/_replaced-{uuid.uuid4().hex}")
    system.mkdirs(old.getParent())
    if system.exists(old) and not system.rename(old, aside):
        raise OSError(f"{old} can't be put aside")
    if not system.rename(new, old):
        raise OSError(f"{new} can't be moved to {old}")
    system.delete(aside, True)


def partition_report(before: DataFrame, after: DataFrame) -> DataFrame:
    """Partitions that are in the second listing only: what a write added."""
    return after.exceptAll(before)


def create_table(df: DataFrame, name: str, partitions: list[str], comments: dict[str, str] | None = None, location: str | None = None) -> None:
    """A partitioned Parquet table of the frame's columns, external if it has a location; nothing happens if it exists."""
    comments = comments or {}
    quoted = {c: f" COMMENT '{t.replace(chr(39), chr(39) * 2)}'" for c, t in comments.items()}
    cols = ", ".join(f"`{n}` {t}{quoted.get(n, '')}" for n, t in df.dtypes)
    parts = f" PARTITIONED BY ({', '.join(f'`{p}`' for p in partitions)})" if partitions else ""
    where = f" LOCATION '{location}'" if location else ""
    df.sparkSession.sql(f"CREATE TABLE IF NOT EXISTS {name} ({cols}) USING parquet{parts}{where}")


def insert_overwrite(df: DataFrame, name: str, partitions: dict[str, str]) -> None:
    """Into an existing table, in its order: new columns are added to it, partition columns go last with their types; other partitions stay."""
    spark = df.sparkSession
    target = spark.table(name).schema
    plain = T.StructType([f for f in target if f.name not in partitions])
    own = evolve_schema(df.drop(*partitions), plain, allow_removed=False)
    if new := [f for f in own.schema if f.name not in target.fieldNames()]:
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in new)})")
    order = [c for c in spark.table(name).columns if c not in partitions]
    typed = df.select(*order, *(F.col(c).cast(t).alias(c) for c, t in partitions.items()))
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        typed.write.insertInto(name, overwrite=True)
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", before)


def strip_header_comments(sql: str) -> str:
    return re.sub(r"\A(\s*(--[^\n]*(\n|\Z)|/\*.*?\*/))+", "", sql, flags=re.DOTALL).lstrip()


def template_sql(spark: SparkSession, sql: str, **args: object) -> DataFrame:
    """A query with named parameters (``:target_date``; tables as ``IDENTIFIER(:t)``); a name without a value fails."""
    sql = strip_header_comments(sql)
    wanted = set(re.findall(r"(?<![:\w]):([A-Za-z_]\w*)", re.sub(r"'[^']*'", "''", sql)))
    if missing := wanted - {*args}:
        raise ValueError(f"no value for {sorted(missing)}")
    return spark.sql(sql, args={k: v for k, v in args.items() if k in wanted})


def refresh_table(spark: SparkSession, sql: str, name: str, partitions: dict[str, str], **args: object) -> str:
    """Run a query for a date into a table: create it with typed partition columns last, or overwrite the partitions it yields.

    Returns ``created`` or ``overwritten``. Only the query's analysis is needed to
    compare columns; a column that the table has and the query lost fails.
    """
    df = template_sql(spark, sql, **args)
    plain = [c for c in df.columns if c not in partitions]
    if not spark.catalog.tableExists(name):
        typed = df.select(*plain, *(F.col(c).cast(t).alias(c) for c, t in partitions.items()))
        typed.write.partitionBy(*partitions).format("parquet").saveAsTable(name)
        return "created"
    insert_overwrite(df, name, partitions)
    return "overwritten"


class AuditSink:
    """Buffers run records and appends them as one small file; a failing flush is reported, never raised."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path, self.rows = spark, path, []

    def record(self, run_id: str, table: str, date: str, status: str, rows: int = 0, started: datetime | None = None, finished: datetime | None = None, message: str = "") -> None:
        self.rows.append((run_id, table, date, status, rows, started, finished, message))

    def flush(self) -> str | None:
        try:
            if self.rows:
                self.spark.createDataFrame(self.rows, AUDIT_SCHEMA).coalesce(1).write.mode("append").parquet(self.path)
            self.rows = []
            return None
        except Exception as error:  # a lost record must not fail the run it describes
            return str(error)
