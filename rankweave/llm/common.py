"""What the operators share: reading, staged tables and connected components."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes that separate words; ``bytes.split()`` without arguments splits on the same six.
SPACES = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, as the session names it; a local session without one (tests) gets its own."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        folder = tempfile.mkdtemp(prefix="rankweave-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


@contextmanager
def settings(spark: SparkSession, **values: str) -> Iterator[None]:
    """SQL settings (``__`` for a dot) that hold while the block runs."""
    named = {k.replace("__", "."): v for k, v in values.items()}
    before = {k: spark.conf.get(k, None) for k in named}
    try:
        for k, v in named.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def few_rows(spark: SparkSession, rows: int = 2000) -> None:
    """From now on the session hands Python so many rows at a time at most: whole texts travel with them, to a worker and back."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= rows:
        spark.conf.set(name, str(rows))


def stage(df: DataFrame, name: str, rows: int = 2000, **options: str) -> DataFrame:
    """Write ``df`` to a new table in the shared folder and read it back: the lineage is cut, and a lost executor costs nothing.

    Spark deletes the shuffle files of the write when it is over, and hands Python
    ``rows`` at a time, few, as texts can be long.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    with settings(spark, spark__sql__classic__shuffleDependency__fileCleanup__enabled="true", spark__sql__execution__arrow__maxRecordsPerBatch=str(rows)):
        df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def unstage(*staged: DataFrame) -> None:
    """Delete staged tables that nothing will read again."""
    for df in staged:
        jvm = df.sparkSession._jvm
        conf = df.sparkSession._jsc.hadoopConfiguration()
        for name in df.inputFiles()[:1]:
            path = jvm.org.apache.hadoop.fs.Path(name).getParent()
            path.getFileSystem(conf).delete(path, True)


def lay_out(codes: list[bytes], order: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The 32-bit integers of ``codes[order[0]]``, ``codes[order[1]]`` and so on, one after the other; and where in them the entries at ``ends`` of the order begin."""
    sizes = np.fromiter(map(len, codes), np.int64, len(codes)) // 4
    flat = np.frombuffer(b"".join(codes), "<u4")
    own = sizes[order]
    after = np.cumsum(own)
    places = np.repeat((np.cumsum(sizes) - sizes)[order] - (after - own), own)
    places += np.arange(len(places))
    return flat[places], np.append(0, after)[ends]


def words(text):
    """Column: the words of a text, in order; null and empty texts give an empty array."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACES, -1), lambda w: w != "")


def most_frequent(counted: DataFrame, most: int) -> DataFrame:
    """Rows of ``counted(n, ...)`` of the highest counts, ``most`` at most: counts are binned, so that what is collected has a fixed size and no task sorts them all."""
    level = F.floor(F.log2("n") * 32).cast("int")
    total, least = 0, None
    for r in sorted(counted.groupBy(level.alias("level")).agg(F.count("*").alias("rows")).collect(), key=lambda r: -r.level):
        total += r.rows
        if total > most:
            break
        least = r.level
    return counted.where(level >= least) if least is not None else counted.limit(0)


def text_key(text="text"):
    """Column: equal texts have equal keys; all blank ones have 0."""
    value = F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))
    return F.when(value.rlike(r"[^\x20\x09-\x0D]"), F.xxhash64(value)).otherwise(F.lit(0).cast("long"))


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Rows ``(node, root)``: the smallest node that each node of an edge reaches.

    Alternating large-star and small-star steps, each a few equi-joins and a
    minimum per node with map-side combining. A hub's rows meet its minimum in a
    plain shuffle join, which adaptive execution can split. Every round is a
    staged table. No edges give no rows.
    """
    now = stage(
        edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct(), "links"
    )
    mark = _mark(now)
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        after = stage(moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "links")
        unstage(now)
        now, before, mark = after, mark, _mark(after)
        if mark == before:
            break
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())
