"""Vocabularies and category codes."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable
from functools import reduce
from itertools import chain

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .filters import UNKNOWN_CODE

#: Vocabularies up to this size become a map literal; larger ones a join.
LITERAL_VALUES = 1000


def vocabulary(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """``column, value, code``: each column's distinct values, sorted, null left out; codes from 0.

    Values are made distinct before they are numbered, so a numbering task holds a
    column's vocabulary and not its rows.
    """
    parts = [df.select(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")).where("value is not null").distinct() for c in columns]
    order = Window.partitionBy("column").orderBy("value")
    return reduce(DataFrame.unionByName, parts).withColumn("code", F.row_number().over(order) - 1)


def declared_vocabulary(df: DataFrame, declared: dict[str, list[str]]) -> DataFrame:
    rows = [(c, v, i) for c, values in declared.items() for i, v in enumerate(values)]
    return df.sparkSession.createDataFrame(rows, "column string, value string, code int")


def encode_categoricals(df: DataFrame, columns: Iterable[str], vocab: DataFrame) -> DataFrame:
    """Each column's values as their codes; unknown values and nulls as -1.

    The vocabularies are looked at once, by their first codes: a job, and a bounded number
    of rows a column, whatever their sizes.
    """
    columns, first = list(columns), defaultdict(list)
    if columns:
        for r in vocab.where(F.col("column").isin(columns) & (F.col("code") <= LITERAL_VALUES)).collect():
            first[r.column].append(r)
    for c in columns:
        few = first[c]
        if len(few) > LITERAL_VALUES:
            value = vocab.where(F.col("column") == c).select(F.col("value").alias("__value"), F.col("code").alias("__code"))
            df = df.join(value, F.col(c).cast("string") == F.col("__value"), "left")
            df = df.withColumn(c, F.coalesce("__code", F.lit(UNKNOWN_CODE)).cast("int")).drop("__value", "__code")
        elif few:
            codes = F.create_map(*chain.from_iterable((F.lit(r.value), F.lit(r.code)) for r in few))
            df = df.withColumn(c, F.coalesce(codes[F.col(c).cast("string")], F.lit(UNKNOWN_CODE)).cast("int"))
        else:
            df = df.withColumn(c, F.lit(UNKNOWN_CODE))
    return df


def unknown_encoding_counts(encoded: DataFrame, columns: Iterable[str]) -> DataFrame:
    """``column, unknown, rows``, from one pass."""
    columns = list(columns)
    sums = encoded.agg(F.count("*").alias("rows"), *(F.sum((F.col(c) == UNKNOWN_CODE).cast("long")).alias(c) for c in columns))
    pairs = F.explode(F.array(*(F.struct(F.lit(c).alias("column"), F.col(c).alias("unknown")) for c in columns)))
    return sums.select(pairs.alias("p"), "rows").select("p.column", F.coalesce("p.unknown", F.lit(0)).alias("unknown"), "rows")
