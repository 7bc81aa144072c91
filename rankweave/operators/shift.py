"""What sampling ratios and weights do to scores, and what per-item shifts would."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..roles import ROLES, Roles
from ..sources.tables import staged
from .joins import override_join
from .metrics import enrich, macro_average, per_item_ap
from .query_arrays import gather, ranked
from .sampling import tune_holdout_split


def config_offset(df: DataFrame, context: str, ratios: dict[str, float], weights: dict[str, float], roles: Roles = ROLES) -> DataFrame:
    """``context, item, offset, centered``: ln of positive over negative sampling ratio plus ln of their weights.

    Overrides are keyed ``context|item|label``; a missing one is 1. Ratios and weights must be positive. ``centered`` is less the median of the context.
    """
    if bad := [k for k, v in {**ratios, **weights}.items() if v <= 0]:
        raise ValueError(f"not positive: {bad}")
    own = df.select(context, roles.item).distinct()
    for label in (1, 0):
        for name, table in (("r", ratios), ("w", weights)):
            own = override_join(own.withColumn("__l", F.lit(str(label))), [context, roles.item, "__l"], table, 1.0, f"{name}{label}")
    offset = F.ln(F.col("r1") / F.col("r0")) + F.ln(F.col("w1") / F.col("w0"))
    own = own.select(context, roles.item, offset.alias("offset"))
    median = own.groupBy(context).agg(F.percentile("offset", 0.5).alias("__m"))
    return own.join(median, context).select(context, roles.item, "offset", (F.col("offset") - F.col("__m")).alias("centered"))


def config_shift(df: DataFrame, offsets: DataFrame, context: str, k: int, roles: Roles = ROLES) -> DataFrame:
    """``variant, macro_ap, delta``: macro AP of the score, of the score less all offsets, and of one item's offset at a time.

    A query is ranked anew only for the items whose offset moves them in it, within its
    own array: what the positives gain against the score as it is leaves the query, and the gains
    of all queries are summed by variant and item.
    """
    joined = df.join(offsets.select(context, roles.item, "offset"), [context, roles.item], "left")
    queries = gather(joined, {"s": F.col(roles.score).cast("double"), "o": F.coalesce("offset", F.lit(0.0))}, roles=roles)

    def terms(variant: Column, rows: Column, sign: float = 1.0) -> Column:
        hits = F.filter(ranked(rows), lambda x: x["l"] == 1)
        return F.transform(hits, lambda x: F.struct(variant.alias("variant"), x["i"].alias("item"), (F.when(x["p"] <= k, x["c"] / x["p"]).otherwise(0.0) * sign).alias("ap")))

    def moved(which) -> Column:
        return F.transform("rows", lambda r: F.struct(r["i"].alias("i"), r["l"].alias("l"), F.when(which(r), r["s"] - r["o"]).otherwise(r["s"]).alias("s")))

    own = queries.select("rows", terms(F.lit("base"), F.col("rows")).alias("base"), F.filter("rows", lambda r: r["o"] != 0).alias("movers")).where("size(base) > 0")
    less = lambda name: F.transform("base", lambda x: F.struct(name.alias("variant"), x["item"].alias("item"), (-x["ap"]).alias("ap")))
    only = F.flatten(F.transform("movers", lambda j: F.concat(terms(F.concat(F.lit("only "), j["i"]), moved(lambda r: r["i"] == j["i"])), less(F.concat(F.lit("only "), j["i"])))))
    every = F.when(F.size("movers") > 0, F.concat("base", terms(F.lit("all"), moved(lambda r: F.lit(True))), less(F.lit("all")), only)).otherwise(F.col("base"))
    sums = own.select(F.explode(every).alias("x")).groupBy("x.variant", "x.item").agg(F.sum("x.ap").alias("ap"), F.count("*").alias("n"))
    # from here on a row a variant and item
    of_item, is_base = Window.partitionBy("item"), F.col("variant") == "base"
    shared = sums.select("variant", F.col("ap").alias("gain"), F.max(F.when(is_base, F.col("ap"))).over(of_item).alias("own"), F.max(F.when(is_base, F.col("n"))).over(of_item).alias("n"))
    gains = shared.groupBy("variant").agg(F.sum(F.col("gain") / F.col("n")).alias("gain"), F.avg(F.col("own") / F.col("n")).alias("mean"), F.count("*").alias("items"))
    every = Window.partitionBy()
    base, items = (F.max(F.when(is_base, F.col(c))).over(every) for c in ("mean", "items"))
    names = df.sparkSession.createDataFrame([("base",), ("all",)], "variant string").unionByName(offsets.select(F.concat(F.lit("only "), roles.item).alias("variant")).distinct())
    found = names.join(gains, "variant", "left").withColumns({"base": base, "delta": F.when(is_base | F.col("gain").isNull(), 0.0).otherwise(F.col("gain") / items)})
    return found.select("variant", (F.col("base") + F.col("delta")).alias("macro_ap"), "delta")


def _variants(rows: DataFrame, k: int, roles: Roles) -> DataFrame:
    wide = Roles(roles.time, (*roles.entity, "variant"), roles.item, roles.label, roles.score, roles.rank)
    own = enrich(rows, [k], wide).where(F.col(roles.label) == 1)
    per = own.groupBy("variant", roles.item).agg(F.avg(f"ap@{k}").alias("ap"))
    macro = per.groupBy("variant").agg(F.avg("ap").alias("macro_ap"))
    base = F.max(F.when(F.col("variant") == "base", F.col("macro_ap"))).over(Window.partitionBy())  # a row a variant
    return macro.select("variant", "macro_ap", (F.col("macro_ap") - base).alias("delta"))


def score_shift_grid(df: DataFrame, shifts: Iterable[tuple[str, float]], k: int, roles: Roles = ROLES) -> DataFrame:
    """``variant, macro_ap, delta`` of each (item, shift), all at once."""
    rows = [("base", None, 0.0), *((f"{i} {s:+g}", i, float(s)) for i, s in shifts)]
    grid = df.sparkSession.createDataFrame(rows, "variant string, __item string, __shift double")
    wide = df.crossJoin(F.broadcast(grid))  # the caller's list
    shifted = wide.withColumn(roles.score, F.col(roles.score) + F.when(F.col("__item") == F.col(roles.item), F.col("__shift")).otherwise(0.0))
    return _variants(shifted, k, roles)


#: Parts that a group's values are cut into, by approximate quantiles, before running sums go over one of them.
CUTS = 64
#: Decimals to which crossing points are told apart, below which two scores' differences differ by the order of subtraction alone.
PLACES = 12
#: Macro AP of intervals within this of the greatest counts as equal to it: sums of doubles depend on their order.
SAME = 1e-9


def crossings(df: DataFrame, k: int, items: Iterable[str] | None = None, roles: Roles = ROLES) -> DataFrame:
    """``item, at, passed, other, gain_own, gain_other, own``: shifts of ``item`` at which it passes another item of a query, and what the AP of both rows gains.

    Where an item rises past its neighbour, only these two rows of the query change
    places, so that only their own terms change. Each query is one sorted array;
    pairs of negatives, and those below the first ``k`` places, have nothing to gain and
    are not made. ``passed`` tells that the item is above the other without a shift, and
    ``items`` restricts which items move. Each row of ``df`` is also its own pair, for
    which ``own`` is its label: ``gain_own`` is then its term of the AP, and the rest is null.
    Pairs come from two explodes and plain columns, which stay in generated code.
    """
    score, label = F.col(roles.score), F.coalesce(F.col(roles.label).cast("int"), F.lit(0))
    order = F.sort_array(F.collect_list(F.struct(score.isNull().alias("z"), (-score).alias("s"), F.col(roles.item).alias("i"), label.alias("l"))))
    queries = df.groupBy(*roles.query).agg(order.alias("rows"))
    before = F.aggregate("rows", F.struct(F.lit(0).alias("n"), F.array().cast("array<int>").alias("c")), lambda s, x: F.struct((s["n"] + x["l"]).alias("n"), F.concat(s["c"], F.array(s["n"])).alias("c")))
    ranked = queries.select("rows", before["c"].alias("c"))
    movers = ranked.select("rows", "c", F.posexplode("rows").alias("p", "j")).select("rows", "c", "p", "j.*").withColumn("cj", F.col("c")[F.col("p")])
    movers = movers.select("rows", "c", (F.col("p") + 1).alias("pj"), F.col("s").alias("sj"), F.col("i").alias("item"), F.col("l").alias("lj"), "cj")
    pairs = movers.select("*", F.posexplode("rows").alias("p", "o")).select("pj", "sj", "item", "lj", "cj", (F.col("p") + 1).alias("pi"), F.col("o.s").alias("si"), F.col("o.i").alias("other"), F.col("o.l").alias("li"), F.col("c")[F.col("p")].alias("ci"))
    same, passed = F.col("pj") == F.col("pi"), F.col("pj") < F.col("pi")
    place = F.col("pi") - passed.cast("int")  # of the other, the mover left out
    useful = (F.col("item") != F.col("other")) & (F.col("lj") + F.col("li") > 0) & (place <= k)
    pairs = pairs.where(same | (useful & F.col("item").isin(list(items)) if items is not None else useful))
    lj, li, hits = F.col("lj"), F.col("li"), F.col("ci") - F.when(passed, F.col("lj")).otherwise(0)

    def term(place, hits):
        return F.when(place <= k, hits / place).otherwise(0.0)

    own = F.when(lj == 1, F.when(same, term(F.col("pj"), F.col("cj") + 1)).otherwise(term(place, hits + 1) - term(place + 1, hits + li + 1))).otherwise(0.0)
    its = F.when(li == 1, term(place + 1, hits + lj + 1) - term(place, hits + 1)).otherwise(0.0)
    apart = lambda value: F.when(~same, value)
    return pairs.select("item", apart(F.round(F.col("sj") - F.col("si"), PLACES)).alias("at"), apart(passed).alias("passed"), apart(F.col("other")).alias("other"), own.alias("gain_own"), apart(its).alias("gain_other"), F.when(same, lj).alias("own"))


def shift_steps(df: DataFrame, k: int, items: Iterable[str] | None = None, roles: Roles = ROLES) -> DataFrame:
    """``item, lo, hi, macro_ap, base``: macro AP as an exact step function of one item's shift, all other scores as they are.

    Between two neighbouring crossing points (``lo`` and ``hi``; null beyond the first and the last)
    no query changes, so that all shifts inside an interval give the same value. ``df`` is read
    once: crossings, and the terms of the AP as it is, are summed per pair of items and point
    into a staged table, and weights come after. Running sums then go within ranges of points, cut by
    approximate quantiles, and over the ranges' totals, so that no task holds all points of an item. Items without a
    crossing have one interval. Fewer than two rows an item and query are assumed, as everywhere.
    """
    spark, kind = df.sparkSession, df.schema[roles.item].dataType.simpleString()
    gone = lambda c: F.sum(F.when(F.col("passed"), F.col(c)).otherwise(0.0))
    summed = crossings(df, k, items, roles).groupBy("item", "other", "at", F.col("own").isNotNull().alias("__self")).agg(
        F.sum("gain_own").alias("gain_own"), F.sum("gain_other").alias("gain_other"), gone("gain_own").alias("passed_own"), gone("gain_other").alias("passed_other"), F.sum("own").alias("n"))
    found = staged(summed, "crossings")
    known = found.where("__self").select("item", F.col("gain_own").alias("s"), "n").collect()  # one row an item
    positive = [r for r in known if r.n]
    base = sum(r.s / r.n for r in positive) / len(positive) if positive else None
    share = spark.createDataFrame([(r["item"], 1.0 / (r.n * len(positive))) for r in positive], f"other {kind}, w double")
    weight = F.broadcast(share)  # one row an item
    gains = found.where("NOT __self").join(weight, "other", "left").join(F.broadcast(share.select(F.col("other").alias("item"), F.col("w").alias("w_own"))), "item", "left")
    weighed = lambda own, its: F.sum(F.coalesce(F.col(own) * F.col("w_own"), F.lit(0.0)) + F.coalesce(F.col(its) * F.col("w"), F.lit(0.0)))
    points = staged(gains.groupBy("item", "at").agg(weighed("gain_own", "gain_other").alias("gain"), weighed("passed_own", "passed_other").alias("passed")), "points")
    cuts = points.groupBy("item").agg(F.percentile_approx("at", [i / CUTS for i in range(1, CUTS)], 1000).alias("cuts")).collect()  # one row an item
    ranges = F.broadcast(spark.createDataFrame([(r["item"], list(r.cuts)) for r in cuts], f"item {kind}, cuts array<double>"))
    ranged = points.join(ranges, "item").select("item", "at", "gain", "passed", F.size(F.filter("cuts", lambda c: c < F.col("at"))).alias("part"))
    within = Window.partitionBy("item", "part").orderBy("at")
    run = ranged.select("item", "part", "at", "passed", F.sum("gain").over(within.rowsBetween(Window.unboundedPreceding, 0)).alias("upto"), F.lead("at").over(within).alias("next"))
    sums = run.groupBy("item", "part").agg(F.max_by("upto", "at").alias("total"), F.min("at").alias("first"), F.sum("passed").alias("passed"))
    over = Window.partitionBy("item").orderBy("part")  # as many rows as ranges
    starts = sums.select("item", "part", F.coalesce(F.sum("total").over(over.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)).alias("before"),
                         F.lead("first").over(over).alias("after"), F.sum("passed").over(Window.partitionBy("item")).alias("lost"))
    placed = run.join(starts, ["item", "part"])
    steps = placed.select("item", F.col("at").alias("lo"), F.coalesce("next", "after").alias("hi"), (F.lit(base) - F.col("lost") + F.col("before") + F.col("upto")).alias("macro_ap"))
    lowest = sums.groupBy("item").agg(F.min("first").alias("hi"), F.sum("passed").alias("passed"))
    every = found.where("__self").select("item")
    every = every.where(F.col("item").isin(list(items))) if items is not None else every
    first = every.join(lowest, "item", "left").select("item", F.lit(None).cast("double").alias("lo"), "hi", (F.lit(base) - F.coalesce("passed", F.lit(0.0))).alias("macro_ap"))
    return steps.unionByName(first).withColumn("base", F.lit(base)).withColumnRenamed("item", roles.item)


def best_shifts(steps: DataFrame, roles: Roles = ROLES) -> DataFrame:
    """``item, shift, macro_ap, base, gain``: for each item the shift of greatest macro AP, one row an item.

    It is the middle of its interval, one beyond the outermost points; of intervals of equal
    value the one nearest to no shift is taken, the lower of two. No shift is taken
    where none gains.
    """
    middle = F.when(F.col("lo").isNull() & F.col("hi").isNull(), 0.0).when(F.col("lo").isNull(), F.col("hi") - 1).when(F.col("hi").isNull(), F.col("lo") + 1).otherwise((F.col("lo") + F.col("hi")) / 2)
    own = staged(steps.withColumn("shift", middle), "steps")  # the greatest values and the rows that have them
    most = own.groupBy(roles.item).agg(F.max("macro_ap").alias("__most"))
    near = own.join(most, roles.item).where(F.col("macro_ap") >= F.col("__most") - SAME)
    one = near.groupBy(roles.item).agg(F.min(F.struct(F.abs("shift").alias("far"), "shift", "macro_ap", "base")).alias("x")).select(roles.item, "x.*")
    gains = F.col("macro_ap") > F.col("base") + SAME
    out = one.select(roles.item, F.when(gains, F.col("shift")).otherwise(0.0).alias("shift"), F.when(gains, F.col("macro_ap")).otherwise(F.col("base")).alias("macro_ap"), "base")
    return out.withColumn("gain", F.col("macro_ap") - F.col("base"))


def optimize_shifts(df: DataFrame, items: Iterable[str], k: int, moves: int = 1, roles: Roles = ROLES) -> dict[str, float]:
    """Steepest ascent: all items' best shifts are found at once, the one that gains most is taken, ``moves`` times or until none gains; one row an item reaches the driver each time.

    Ties go to the item that sorts first.
    """
    best = {i: 0.0 for i in items}
    for _ in range(moves):
        found = [r for r in best_shifts(shift_steps(apply_shifts(df, best, roles), k, best, roles), roles).collect() if r.gain > SAME]
        if not found:
            break
        most = max(r.gain for r in found)
        first = min((r for r in found if r.gain >= most - SAME), key=lambda r: r[roles.item])
        best[first[roles.item]] += first["shift"]
    return best


def apply_shifts(df: DataFrame, shifts: dict[str, float], roles: Roles = ROLES) -> DataFrame:
    """The frame with each item's shift added to its score."""
    return df.withColumn(roles.score, F.col(roles.score) + sum((F.when(F.col(roles.item) == i, s).otherwise(0.0) for i, s in shifts.items()), F.lit(0.0)))


def shift_search(df: DataFrame, items: Iterable[str], k: int, tune_ratio: float = 0.5, moves: int = 1, hash: str = "crc32", roles: Roles = ROLES) -> DataFrame:
    """``side, base, shifted, delta``: macro AP before and after shifts that were searched on the tune entities alone; the holdout row tells whether they hold.

    Both scores of a side are ranked in one pass, as two variants of its rows.
    """
    tune, holdout = tune_holdout_split(df.select(*roles.identity, roles.label, roles.score), tune_ratio, hash=hash, roles=roles)
    shifts = optimize_shifts(tune, items, k, moves, roles)
    both = tune.withColumn("side", F.lit("tune")).unionByName(holdout.withColumn("side", F.lit("holdout")))
    moved = apply_shifts(both, shifts, roles).select(*roles.identity, roles.label, roles.score, "side", F.lit("shifted").alias("variant"))
    rows = both.withColumn("variant", F.lit("base")).unionByName(moved)
    wide = Roles(roles.time, (*roles.entity, "variant"), roles.item, roles.label, roles.score, roles.rank)
    per = enrich(rows, [k], wide).where(F.col(roles.label) == 1).groupBy("side", "variant", roles.item).agg(F.avg(f"ap@{k}").alias("ap"))
    out = per.groupBy("side").agg(*(F.avg(F.when(F.col("variant") == v, F.col("ap"))).alias(v) for v in ("base", "shifted")))
    return out.withColumn("delta", F.col("shifted") - F.col("base"))


def exposure_share(df: DataFrame, k: int, roles: Roles = ROLES) -> DataFrame:
    """``item, exposure, positive_share, penalty``: share of the first k places against share of positives."""
    order = Window.partitionBy(*roles.query).orderBy(F.col(roles.score).desc(), roles.item)
    own = df.withColumn("pos", F.row_number().over(order)).groupBy(roles.item).agg(F.sum((F.col("pos") <= k).cast("long")).alias("top"), F.sum(roles.label).alias("p"))
    every = Window.partitionBy()  # one row an item
    out = own.withColumns({"exposure": F.try_divide("top", F.sum("top").over(every)), "positive_share": F.try_divide("p", F.sum("p").over(every))})
    return out.select(roles.item, "exposure", "positive_share", F.pow(F.col("exposure") - F.col("positive_share"), F.lit(2.0)).alias("penalty"))


def weighted_quantiles(df: DataFrame, by: list[str], value: str, weight: Column, reach: dict[str, Callable[[Column], Column]]) -> DataFrame:
    """``by`` and, for each name in ``reach``, the smallest value at which the running weight gets to ``reach(total weight)``.

    Values are summed first and cut into parts by approximate quantiles; running
    sums over the parts' totals tell which part has the value, and only that part's
    rows are looked at one by one. No task holds all values of a group, and the result is exact.
    """
    own = df.groupBy(F.struct(*by).alias("__g"), F.col(value).alias("__v")).agg(F.sum(weight).alias("__w"))
    cuts = own.groupBy("__g").agg(F.percentile_approx("__v", [i / CUTS for i in range(1, CUTS)], 1000).alias("__cuts"))
    parted = own.join(cuts, "__g").select("__g", "__v", "__w", F.size(F.filter("__cuts", lambda c: c < F.col("__v"))).alias("__part"))
    sums = parted.groupBy("__g", "__part").agg(F.sum("__w").alias("__w"))
    over = Window.partitionBy("__g").orderBy("__part")  # CUTS rows a group at most
    run = sums.select("__g", "__part", F.coalesce(F.sum("__w").over(over.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__before"), F.sum("__w").over(over).alias("__upto"), F.sum("__w").over(Window.partitionBy("__g")).alias("__all"))
    names = F.explode(F.array(*(F.struct(F.lit(n).alias("n"), f(F.col("__all")).alias("need")) for n, f in reach.items()))).alias("x")
    at = run.select("*", names).select("__g", "__part", "__before", "__upto", "x.*").where("__before < need AND __upto >= need")
    inside = parted.join(at.select("__g", "__part", "__before", "n", "need"), ["__g", "__part"])
    here = F.col("__before") + F.sum("__w").over(Window.partitionBy("__g", "n").orderBy("__v"))
    found = inside.withColumn("__here", here).where(F.col("__here") >= F.col("need"))
    out = found.groupBy("__g").agg(*(F.min(F.when(F.col("n") == n, F.col("__v"))).alias(n) for n in reach))
    return out.select(*(F.col("__g")[c].alias(c) for c in by), *reach)


def weighted_quantile(df: DataFrame, by: list[str], value: str, weight: str, q: float) -> DataFrame:
    """Smallest value at which the running weight reaches the share q."""
    return weighted_quantiles(df, by, value, F.col(weight), {"quantile": lambda total: q * total})


def exact_median(df: DataFrame, by: list[str], value: str) -> DataFrame:
    """``by, median``: the mean of the two middle values."""
    both = weighted_quantiles(df, by, value, F.lit(1), {"lo": lambda n: n / 2, "hi": lambda n: F.floor(n / 2) + 1})
    return both.select(*by, ((F.col("lo") + F.col("hi")) / 2).alias("median"))


def offset_spread(offsets: DataFrame, context: str, roles: Roles = ROLES) -> DataFrame:
    """``context, offset_spread``: greatest less smallest offset of a context's items; what the configuration says."""
    return offsets.groupBy(context).agg((F.max("offset") - F.min("offset")).alias("offset_spread"))


def query_offset_spread(df: DataFrame, offsets: DataFrame, context: str, at: Iterable[float] = (0.5, 0.9, 1.0), roles: Roles = ROLES) -> DataFrame:
    """One row of quantiles of the spread of offsets within a query, and ``varies``: whether a query has several contexts.

    This is what reaches the ranking: a context that varies within a query shifts
    places even where each context's own spread is nothing.
    """
    joined = df.join(offsets.select(context, roles.item, "offset"), [context, roles.item], "left").withColumn("offset", F.coalesce("offset", F.lit(0.0)))
    per = joined.groupBy(*roles.query).agg((F.max("offset") - F.min("offset")).alias("spread"), (F.min(context) != F.max(context)).alias("varies"))
    own = per.groupBy("spread").agg(F.count("*").alias("n"), F.max("varies").alias("varies"))  # spreads are as few as pairs of offsets
    whole = own.agg(*(F.percentile("spread", q, F.col("n")).alias(f"p{round(q * 100)}") for q in at), F.max("varies").alias("varies"))
    return whole


def macro_item_ap(df: DataFrame, k: int, roles: Roles = ROLES) -> DataFrame:
    return macro_average(per_item_ap(enrich(df, [k], roles), k, None, roles), ["ap"])
