"""Data checks, as tables of findings: each is one pass over the rows or metadata alone."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from ..roles import ROLES, Roles

CONTINUOUS = ("float", "double", "decimal")
NUMERIC = ("tinyint", "smallint", "int", "bigint", "float", "double", "decimal", "boolean")


def partition_quality(df: DataFrame, by: str, keys: list[str]) -> DataFrame:
    """Per date: rows, duplicate-key ratio (keys with a null count as duplicates, as COUNT(DISTINCT) skips them) and null ratio over all cells."""
    nulls = reduce(lambda a, b: a + b, (F.col(c).isNull().cast("long") for c in df.columns))
    full = reduce(lambda a, b: a & b, (F.col(k).isNotNull() for k in keys))
    own = df.groupBy(by).agg(F.count("*").alias("rows"), F.countDistinct(F.when(full, F.struct(*keys))).alias("keys"), F.sum(nulls).alias("nulls"))
    return own.select(by, "rows", (1 - F.col("keys") / F.col("rows")).alias("duplicate_ratio"), (F.col("nulls") / (F.col("rows") * len(df.columns))).alias("null_ratio"))


def missing_columns(df: DataFrame, required: Iterable[str]) -> DataFrame:
    rows = [(c,) for c in required if c not in df.columns]
    return df.sparkSession.createDataFrame(rows, "column string")


def source_freshness(df: DataFrame, by: str, dates: Iterable[str], min_rows: int) -> DataFrame:
    """``date, rows, ok`` of the wanted dates, absent ones with 0 rows."""
    wanted = df.sparkSession.createDataFrame([(d,) for d in dates], "d string").select(F.to_date("d").alias("date"))
    have = df.groupBy(F.to_date(by).alias("date")).agg(F.count("*").alias("rows"))
    rows = F.coalesce("rows", F.lit(0))
    return wanted.join(have, "date", "left").select("date", rows.alias("rows"), (rows >= min_rows).alias("ok"))


def schema_drift(df: DataFrame, expected: dict[str, str]) -> DataFrame:
    """``column, problem``: missing, new, or another type than expected."""
    have = dict(df.dtypes)
    rows = [(c, "missing") for c in expected if c not in have] + [(c, "new") for c in have if c not in expected]
    rows += [(c, f"{have[c]} is not {t}") for c, t in expected.items() if c in have and have[c] != t]
    return df.sparkSession.createDataFrame(rows, "column string, problem string")


def schema_checks(df: DataFrame, categorical: Iterable[str], features: Iterable[str], carry: Iterable[str] = ()) -> DataFrame:
    """``column, problem``: continuous categoricals, features that are neither numeric nor encoded, carried columns that are features too."""
    have, categorical, features = dict(df.dtypes), set(categorical), list(features)
    rows = [(c, f"categorical of type {have[c]}") for c in sorted(categorical) if c in have and have[c].startswith(CONTINUOUS)]
    rows += [(c, f"feature of type {have[c]}") for c in features if c in have and c not in categorical and not have[c].startswith(NUMERIC)]
    rows += [(c, "carried and a feature") for c in carry if c in features]
    return df.sparkSession.createDataFrame(rows, "column string, problem string")


def item_coverage(pool: DataFrame, labels: DataFrame, declared: Iterable[str], roles: Roles = ROLES) -> DataFrame:
    """``item, problem``: the pool must have exactly the declared items, the labels no others."""
    wanted = pool.sparkSession.createDataFrame([(d,) for d in declared], f"{roles.item} string")
    have, seen = pool.select(roles.item).distinct(), labels.select(roles.item).distinct()
    parts = [
        wanted.join(have, roles.item, "left_anti").withColumn("problem", F.lit("declared, not in pool")),
        have.join(wanted, roles.item, "left_anti").withColumn("problem", F.lit("in pool, not declared")),
        seen.join(wanted, roles.item, "left_anti").withColumn("problem", F.lit("in labels, not declared")),
    ]
    return reduce(DataFrame.unionByName, parts).select(F.col(roles.item).alias("item"), "problem")


def prediction_checks(df: DataFrame, n_items: int, roles: Roles = ROLES) -> DataFrame:
    """One row: queries, incomplete ones, ones of constant score, and the range of ranks; a grouped pass and a roll-up."""
    own = df.groupBy(*roles.query).agg(F.count("*").alias("n"), F.min(roles.score).alias("lo"), F.max(roles.score).alias("hi"), F.min(roles.rank).alias("r0"), F.max(roles.rank).alias("r1"))
    return own.agg(
        F.count("*").alias("queries"), F.sum((F.col("n") != n_items).cast("long")).alias("incomplete"),
        F.sum(((F.col("lo") == F.col("hi")) & (F.col("n") > 1)).cast("long")).alias("constant"), F.min("r0").alias("min_rank"), F.max("r1").alias("max_rank"))


def scored_checks(df: DataFrame, declared: Iterable[str], expected_rows: int, roles: Roles = ROLES) -> DataFrame:
    """``check, failures``: null keys or scores, repeated identities, unknown items, a wrong number of rows."""
    null = reduce(lambda a, b: a | b, (F.col(c).isNull() for c in [*roles.identity, roles.score]))
    rows = df.agg(F.sum(null.cast("long")).alias("nulls"), F.sum((~F.col(roles.item).isin(*declared)).cast("long")).alias("unknown_items"), (F.count("*") - expected_rows).alias("row_difference"))
    twice = df.groupBy(*roles.identity).agg(F.count("*").alias("n")).where("n > 1").agg(F.count("*").alias("repeated"))
    both = rows.crossJoin(F.broadcast(twice))
    return both.select(F.explode(F.array(*(F.struct(F.lit(c).alias("check"), F.coalesce(c, F.lit(0)).alias("failures")) for c in both.columns))).alias("x")).select("x.*")


def observed(ranked: DataFrame, declared: Iterable[str], roles: Roles = ROLES) -> tuple[DataFrame, Observation]:
    """The ranked rows, and what the job that writes them will have seen: ``rows, nulls, unknown_items, queries, incomplete, constant, repeated, rank_order``.

    Nothing is read for the checks: a query's figures come from windows over the
    partitioning that its ranks already have, and are counted at its first row.
    """
    declared = list(declared)
    query, by_rank = Window.partitionBy(*roles.query), Window.partitionBy(*roles.query).orderBy(roles.rank)
    seen = ranked.withColumns({
        "__n": F.count("*").over(query), "__items": F.size(F.collect_set(roles.item).over(query)), "__low": F.min(roles.score).over(query),
        "__high": F.max(roles.score).over(query), "__before": F.lag(roles.score).over(by_rank), "__at": F.row_number().over(by_rank)})
    null = reduce(lambda a, b: a | b, (F.col(c).isNull() for c in [*roles.identity, roles.score]))
    first = F.col("__at") == 1

    def rows(condition):
        return F.coalesce(F.sum(condition.cast("long")), F.lit(0))

    metrics = {
        "rows": F.count(F.lit(1)), "nulls": rows(null), "unknown_items": rows(~F.col(roles.item).isin(declared)), "queries": rows(first),
        "incomplete": rows(first & (F.col("__n") != len(declared))), "constant": rows(first & (F.col("__low") == F.col("__high")) & (F.col("__n") > 1)),
        "repeated": F.coalesce(F.sum(F.when(first, F.col("__n") - F.col("__items"))), F.lit(0)), "rank_order": rows(F.col(roles.score) > F.col("__before")),
    }
    observation = Observation()
    return seen.observe(observation, *(m.alias(n) for n, m in metrics.items())).select(*ranked.columns), observation


def rank_order_violations(df: DataFrame, roles: Roles = ROLES) -> DataFrame:
    """Rows whose score exceeds that of the rank before."""
    before = F.lag(roles.score).over(Window.partitionBy(*roles.query).orderBy(roles.rank))
    return df.withColumn("__before", before).where(F.col(roles.score) > F.col("__before")).drop("__before")
