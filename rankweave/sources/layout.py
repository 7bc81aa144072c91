"""Table layout for the joins on keys: tables bucketed and sorted by entity, joins that use the buckets, and writes with files of even size."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from ..roles import ROLES, Roles


def write_bucketed(df: DataFrame, name: str, buckets: int, partitions: Iterable[str] = (), mode: str = "overwrite", roles: Roles = ROLES) -> None:
    """A catalog table bucketed by entity and sorted by entity and time, with one file a bucket and partition.

    Rows are dealt out once, by the same hash as the buckets, so that each file has one
    writer. Tables of equal ``buckets`` join on the entity, and on any keys with it, without moving rows again.
    """
    partitions, order = list(partitions), [*roles.entity, *(c for c in (roles.time,) if c in df.columns)]
    own = df.repartition(buckets, *roles.entity).sortWithinPartitions(*partitions, *order)
    writer = own.write.mode(mode).format("parquet").bucketBy(buckets, *roles.entity).sortBy(*[c for c in order if c not in partitions])
    (writer.partitionBy(*partitions) if partitions else writer).saveAsTable(name)


@contextmanager
def co_located(spark: SparkSession) -> Iterator[None]:
    """While it holds, joins and groupings on keys that contain the entity use the tables' buckets by entity; plans must be made and run inside."""
    key = "spark.sql.requireAllClusterKeysForCoPartition"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def balanced(df: DataFrame, partitions: Iterable[str]) -> DataFrame:
    """The frame dealt out by partition values for a partitioned write: small partitions share a task and have one file, a large one is split over several by size.

    Sizes are known once the exchange is done; how large a file gets is ``spark.sql.adaptive.advisoryPartitionSizeInBytes``.
    """
    return df.hint("rebalance", *partitions)
