"""Profiles that merge: each partition's columns are summed up once as counts, moments and sketches, and a profile of any partitions is their union.

Distinct values are HyperLogLog sketches, quantiles KLL sketches; counts, means,
deviations and ranges stay exact.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Log2 of a distinct-value sketch's registers, whose relative standard error is about 1.04 / sqrt(2 ** LG): 1.6 %.
LG = 12
#: Size of a quantile sketch, whose ranks are off by about 0.7 % at 400.
K = 400
#: Standard errors that :func:`within` allows.
SIGMAS = 4
NUMERIC = ("tinyint", "smallint", "int", "bigint", "float", "double", "decimal")
SCHEMA = "column string, kind string, rows long, nulls long, low double, high double, mean double, m2 double, distinct binary, ranks binary"


def column_sketches(df: DataFrame, by: Iterable[str], columns: Iterable[str], lg: int = LG, k: int = K) -> DataFrame:
    """``by, column, kind, rows, nulls, low, high, mean, m2, distinct, ranks`` of each column in each group of ``by``, from one aggregate; moments and ranks of numeric columns only."""
    by, kinds = list(by), dict(df.dtypes)
    columns = list(columns)
    aggs: list[Column] = [F.count("*").alias("__rows")]
    for i, c in enumerate(columns):
        own, hashed = F.col(f"`{c}`"), F.when(F.col(f"`{c}`").isNotNull(), F.xxhash64(f"`{c}`"))
        aggs += [F.count(own).alias(f"__n{i}"), F.hll_sketch_agg(hashed, F.lit(lg)).alias(f"__d{i}")]
        if kinds[c].startswith(NUMERIC):
            x = own.cast("double")
            aggs += [F.min(x).alias(f"__low{i}"), F.max(x).alias(f"__high{i}"), F.avg(x).alias(f"__mean{i}"), (F.var_pop(x) * F.count(x)).alias(f"__m2{i}"), F.kll_sketch_agg_double(x, F.lit(k)).alias(f"__q{i}")]
    one = df.groupBy(*by).agg(*aggs)
    rows = []
    for i, c in enumerate(columns):
        number = kinds[c].startswith(NUMERIC)
        moments = [(F.col(f"__{n}{i}") if number else F.lit(None)).cast("double").alias(n) for n in ("low", "high", "mean", "m2")]
        rows.append(F.struct(F.lit(c).alias("column"), F.lit(kinds[c]).alias("kind"), F.col("__rows").alias("rows"), (F.col("__rows") - F.col(f"__n{i}")).alias("nulls"), *moments,
                             F.col(f"__d{i}").alias("distinct"), (F.col(f"__q{i}") if number else F.lit(None)).cast("binary").alias("ranks")))
    return one.select(*by, F.explode(F.array(*rows)).alias("x")).select(*by, "x.*")


def merged(sketches: DataFrame, keep: Iterable[str] = (), at: Iterable[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """``keep, column, kind, rows, null_rate, distinct, mean, std, low, high, p25, ...`` over all partitions of stored sketches.

    Rows of sketches are as few as partitions times columns; the data isn't read.
    """
    key = [*keep, "column", "kind"]
    n = F.col("rows") - F.col("nulls")
    whole = F.try_divide(F.sum(n * F.col("mean")).over(Window.partitionBy(*key)), F.sum(F.when(F.col("mean").isNotNull(), n)).over(Window.partitionBy(*key)))
    around = sketches.withColumn("__mean", whole).withColumn("__m2", F.col("m2") + n * F.pow(F.col("mean") - F.col("__mean"), F.lit(2.0)))
    some = F.sum(n)
    quantiles = F.when(F.count("ranks") > 0, F.kll_merge_agg_double("ranks"))
    own = around.groupBy(*key).agg(
        F.sum("rows").alias("rows"), F.try_divide(F.sum("nulls"), F.sum("rows")).alias("null_rate"), F.hll_sketch_estimate(F.hll_union_agg("distinct")).alias("distinct"),
        F.max("__mean").alias("mean"), F.when(some > 1, F.sqrt(F.sum("__m2") / (some - 1))).alias("std"), F.min("low").alias("low"), F.max("high").alias("high"),
        F.when(some > 0, quantiles).alias("__q"))
    return own.select("*", *(F.when(F.col("__q").isNotNull(), F.kll_sketch_get_quantile_double("__q", F.lit(float(q)))).alias(f"p{round(100 * q)}") for q in at)).drop("__q")


def within(profile: DataFrame, df: DataFrame, at: Iterable[float] = (0.25, 0.5, 0.75), lg: int = LG, k: int = K) -> DataFrame:
    """``column, distinct_within, ranks_within``: whether a merged profile is within its stated error of ``df`` itself.

    Distinct values may be off by SIGMAS relative standard errors (and one value), and the share of rows at or
    below a quantile by SIGMAS times 2.7 / k, as long as no single value holds more.
    """
    at, found = list(at), profile.collect()  # a row a column
    error, off = SIGMAS * 1.04 / 2 ** (lg / 2), SIGMAS * 2.7 / k
    aggs = []
    for i, r in enumerate(found):
        c = F.col(f"`{r.column}`")
        aggs.append((F.abs(F.countDistinct(c) - F.lit(r.distinct)) <= F.greatest(F.lit(1.0), error * F.countDistinct(c))).alias(f"d{i}"))
        shares = []
        for q in at:
            value = r[f"p{round(100 * q)}"]
            if value is not None:
                below, upto = (F.avg(F.when(c.isNotNull(), x.cast("int"))) for x in (c < value, c <= value))
                shares.append((below <= q + off) & (upto >= q - off))
        ok = F.lit(True)
        for s in shares:
            ok = ok & s
        aggs.append(ok.alias(f"q{i}"))
    one = df.agg(*aggs)
    rows = [F.struct(F.lit(r.column).alias("column"), F.col(f"d{i}").alias("distinct_within"), F.col(f"q{i}").alias("ranks_within")) for i, r in enumerate(found)]
    return one.select(F.explode(F.array(*rows)).alias("x")).select("x.*")
