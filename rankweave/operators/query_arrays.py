"""Metrics over queries as arrays: one aggregate gathers a query's candidates, and ranks, contributions and both grains are folded within its row.

No window is needed and no frame is kept: whatever a query adds to a result leaves
its row as a few facts, and all facts are summed by one aggregate.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..roles import ROLES, Roles
from .metrics import ideal_dcg


def gather(df: DataFrame, columns: dict[str, Column], carry: Iterable[str] = (), roles: Roles = ROLES) -> DataFrame:
    """``query, carry, rows``: a query's candidates as an array of ``i`` (item), ``l`` (label) and ``columns`` (``s`` for a score); ``carry`` columns are constant in a query."""
    fields = [F.col(roles.item).cast("string").alias("i"), F.col(roles.label).cast("int").alias("l"), *(c.alias(n) for n, c in columns.items())]
    return df.groupBy(*roles.query).agg(*(F.first(c).alias(c) for c in carry), F.collect_list(F.struct(*fields)).alias("rows"))


def ranked(rows: Column) -> Column:
    """``i, l, p, c`` of each candidate (``i, l, s``: item, label, score) in the order of ranks: its place, and the positives up to it. Ties go to the item that sorts first, null scores last."""
    ordered = F.array_sort(F.transform(rows, lambda r: F.struct(r["s"].isNull().alias("none"), (-r["s"]).alias("s"), r["i"].alias("i"), r["l"].alias("l"))))

    def add(done: Column, x: Column) -> Column:
        row = F.struct(x["i"].alias("i"), x["l"].alias("l"), (F.size(done["rows"]) + 1).alias("p"), (done["c"] + x["l"]).alias("c"))
        return F.struct((done["c"] + x["l"]).alias("c"), F.concat(done["rows"], F.array(row)).alias("rows"))

    start = F.struct(F.lit(0).alias("c"), F.array().cast("array<struct<i:string,l:int,p:int,c:int>>").alias("rows"))
    return F.aggregate(ordered, start, add)["rows"]


def by_category(rows: Column) -> Column:
    """A query's candidates by category (``g``): best score and any label; candidates without one vanish."""
    mapped = F.filter(rows, lambda r: r["g"].isNotNull())
    own = F.array_distinct(F.transform(mapped, lambda r: r["g"]))

    def one(g: Column) -> Column:
        inside = F.filter(mapped, lambda r: r["g"] == g)
        return F.struct(g.alias("i"), F.array_max(F.transform(inside, lambda r: r["l"])).alias("l"), F.array_max(F.transform(inside, lambda r: r["s"])).alias("s"))

    return F.transform(own, one)


def _gains(x: Column, total: Column, k: int) -> list[Column]:
    """Hit, AP and nDCG contribution of a positive."""
    inside = x["p"] <= k
    return [F.when(inside, v).otherwise(0.0) for v in (F.lit(1.0), x["c"] / x["p"], 1 / F.log2(x["p"] + 1.0) / ideal_dcg(total, k))]


def _sum(values: Column, at: int) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda s, v: s + v[at])


def facts(queries: DataFrame, ks: Iterable[int], segment: str | None = None) -> DataFrame:
    """``grain, level, key, v``: what each row ``grain, rows(i, l, s)`` of queries adds to the results of its grain.

    ``v`` has map, ndcg, precision and recall at each k for the levels ``overall`` and ``segment``;
    hit, AP and nDCG contribution at each k and the place for each positive of level ``item``; and for level
    ``excluded`` whether the query has no positive, in which case it adds nothing else.
    """
    ks = list(ks)
    keep = [F.col(segment).cast("string").alias("segment")] if segment else []
    own = queries.select("grain", *keep, F.filter(ranked(F.col("rows")), lambda x: x["l"] == 1).alias("hits"))
    total = F.size("hits")
    gained = own.withColumn("gains", F.transform("hits", lambda x: F.array(*(g for k in ks for g in _gains(x, total, k)), x["p"].cast("double"))))
    vector = []
    for n, k in enumerate(ks):
        hit, ap, ndcg = (_sum(F.col("gains"), 3 * n + j) for j in range(3))
        vector += [ap / total, ndcg, hit / k, hit / total]

    def fact(level: str, key: Column, v: Column) -> Column:
        return F.struct(F.lit(level).alias("level"), key.alias("key"), v.alias("v"))

    whole = [fact("overall", F.lit("all"), F.array(*vector))] + ([fact("segment", F.col("segment"), F.array(*vector))] if segment else [])
    items = F.zip_with("hits", "gains", lambda x, v: fact("item", x["i"], v))
    some = F.when(total > 0, F.concat(F.array(*whole), items))
    none = F.array(fact("excluded", F.lit("all"), F.array((total == 0).cast("double"))))
    return gained.select("grain", F.explode(F.when(total > 0, F.concat(none, some)).otherwise(none)).alias("f")).select("grain", "f.*")


def summed(found: DataFrame, ks: Iterable[int]) -> DataFrame:
    """``grain, level, key, metric, value`` of facts, by one aggregate: means at each key, with ``n_queries``, ``n_pos``, ``n_excluded_queries`` and ``n_differing_rows``."""
    ks = list(ks)
    width = max(4 * len(ks), 3 * len(ks) + 1)
    sums = found.groupBy("grain", "level", "key").agg(F.count("*").alias("n"), F.array(*(F.sum(F.get("v", F.lit(i))) for i in range(width))).alias("v"))

    def long(names: list[str], count: str) -> Column:
        rows = [F.struct(F.lit(m).alias("metric"), (F.col("v")[i] / F.col("n")).alias("value")) for i, m in enumerate(names)]
        return F.array(*rows, F.struct(F.lit(count).alias("metric"), F.col("n").cast("double").alias("value")))

    by_query = [f"{m}@{k}" for k in ks for m in ("map", "ndcg", "precision", "recall")]
    by_item = [f"{m}@{k}" for k in ks for m in ("hit_rate", "map_attr", "ndcg_attr")] + ["mean_pos"]
    counts = {"excluded": "n_excluded_queries", "differs": "n_differing_rows"}
    rows = F.when(F.col("level").isin(*counts), F.array(F.struct(F.when(F.col("level") == "excluded", counts["excluded"]).otherwise(counts["differs"]).alias("metric"), F.col("v")[0].alias("value")))).when(F.col("level") == "item", long(by_item, "n_pos")).otherwise(long(by_query, "n_queries"))
    level = F.when(F.col("level").isin(*counts), "overall").otherwise(F.col("level"))
    return sums.select("grain", level.alias("level"), "key", F.explode(rows).alias("m")).select("grain", "level", "key", "m.*")


def metric_bundle(df: DataFrame, ks: Iterable[int], segment: str | None = None, categories: DataFrame | None = None, roles: Roles = ROLES) -> DataFrame:
    """Everything in long form, ``grain, level, key, metric, value``, at item and category grain, with query counts.

    Two aggregates in all: one gathers queries, one sums facts. Without a row there is
    no result; without a positive there are only ``n_excluded_queries``.
    """
    ks, columns, frame = list(ks), {"s": F.col(roles.score).cast("double")}, df
    if categories is not None:
        frame = df.join(categories.select(roles.item, F.col("category").cast("string").alias("__category")), roles.item, "left")
        columns["g"] = F.col("__category")
    queries = gather(frame, columns, [segment] if segment else [], roles)
    keep = [segment] if segment else []
    parts = [as_grain("item", F.col("rows"))] + ([as_grain("category", by_category(F.col("rows")))] if categories is not None else [])
    return summed(facts(queries.select(*keep, F.explode(F.array(*parts)).alias("x")).select(*keep, "x.*"), ks, segment), ks)


def as_grain(name: str, rows: Column, score: str = "s") -> Column:
    """``grain, rows``: candidates under a name, ranked by the field ``score``."""
    return F.struct(F.lit(name).alias("grain"), F.transform(rows, lambda r: F.struct(r["i"].alias("i"), r["l"].alias("l"), r[score].alias("s"))).alias("rows"))


def compared_scores(df: DataFrame, ks: Iterable[int], scores: dict[str, str], roles: Roles = ROLES) -> DataFrame:
    """Bundle of several score columns (``scores``: grain by column), each ranked for itself, from one gathering of queries.

    Grain ``all`` has ``n_differing_rows``, in which the first two columns differ.
    """
    ks = list(ks)
    queries = gather(df, {c: F.col(c).cast("double") for c in scores}, roles=roles)
    parts = [as_grain(name, F.col("rows"), c) for c, name in scores.items()]
    own = facts(queries.select(F.explode(F.array(*parts)).alias("x")).select("x.*"), ks)
    first, second = list(scores)[:2]
    differs = F.size(F.filter("rows", lambda r: ~r[first].eqNullSafe(r[second]))).cast("double")
    other = queries.select(F.lit("all").alias("grain"), F.lit("differs").alias("level"), F.lit("all").alias("key"), F.array(differs).alias("v"))
    return summed(own.unionByName(other), ks)


def comparison(a: DataFrame, b: DataFrame, labels: DataFrame, ks: Iterable[int], roles: Roles = ROLES) -> DataFrame:
    """``level, key, metric, a, b, delta`` of two sides' scores on the entities and items that both have, with ``labels``' positives.

    Rows of both sides and the positives travel together: entities are matched within the
    exchange that gathers their queries, and a side's figures are two grains of one bundle.
    What one side lacks is 0; sides that share no item or no entity give no rows.
    """
    ks = list(ks)
    score = F.col(roles.score).cast("double")
    kinds = [(a, "a", score), (b, "b", score), (labels.where(F.col(roles.label) == 1), "l", F.lit(0.0))]
    rows = [df.select(*roles.identity, F.lit(side).alias("side"), s.alias("s")) for df, side, s in kinds]
    every = rows[0].unionByName(rows[1]).unionByName(rows[2])
    has = [F.max((F.col("side") == side).cast("int")).alias(side) for side in ("a", "b")]
    shared = every.groupBy(roles.item).agg(*has).where("a = 1 AND b = 1").select(roles.item)
    every = every.join(F.broadcast(shared), roles.item)  # the item list
    whole = Window.partitionBy(*roles.entity)
    both = [F.max((F.col("side") == side).cast("int")).over(whole).alias(f"__{side}") for side in ("a", "b")]
    kept = every.select("*", *both).where("__a = 1 AND __b = 1")
    queries = kept.groupBy(*roles.query).agg(F.collect_list(F.struct("side", F.col(roles.item).cast("string").alias("i"), "s")).alias("rows"))

    def of(side: str) -> Column:
        return F.filter("rows", lambda r: r["side"] == side)

    known = queries.select("rows", F.transform(of("l"), lambda r: r["i"]).alias("positive"))
    sides = [F.struct(F.lit(side).alias("grain"), F.transform(of(side), lambda r: F.struct(r["i"].alias("i"), F.array_contains("positive", r["i"]).cast("int").alias("l"), r["s"].alias("s"))).alias("rows")) for side in ("a", "b")]
    long = summed(facts(known.select(F.explode(F.array(*sides)).alias("x")).select("x.*").where("size(rows) > 0"), ks), ks)
    values = [F.coalesce(F.max(F.when(F.col("grain") == side, F.col("value"))), F.lit(0.0)).alias(side) for side in ("a", "b")]
    return long.groupBy("level", "key", "metric").agg(*values).withColumn("delta", F.col("a") - F.col("b"))
