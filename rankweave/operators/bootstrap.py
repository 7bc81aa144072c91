"""Bootstrap intervals: a unit's draws in all replicates are one array, and arrays are summed element by element.

How often a unit is drawn follows from counts that are halved down a tree: of the
draws of a node, a binomial number goes to its lower half. Every unit finds its
own counts by hashes of the nodes above it, so that nothing is exploded by
replicates and no draw is sent to its unit.
"""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..roles import ROLES, Roles
from ..sources.tables import staged
from .metrics import enrich

#: Units of a leaf at most; its draws go to its units one by one.
LEAF = 32
#: Bits taken from one hash, and steps of a binomial draw: each decides half of the draws that are left.
BITS, STEPS = 60, 61
#: Levels of the tree after which its nodes are dealt out over tasks.
SPREAD = 6


def _let(value: Column, body) -> Column:
    """``body(value)``, with the value made once."""
    return F.transform(F.array(value), body)[0]


def _div(a: Column, b: Column) -> Column:
    return F.call_function("div", a.cast("long"), b.cast("long"))


def _word(*key: Column) -> Column:
    """BITS bits of the MD5 of the key's parts."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", *key)), 1, BITS // 4), 16, 10).cast("long")


def _heads(n: Column, *key: Column) -> Column:
    """Number of heads in ``n`` tosses of a fair coin: bits of as many hashes as hold them."""

    def bits(total: Column, w: Column) -> Column:
        left = n - w * BITS
        mask = F.when(left >= BITS, F.lit((1 << BITS) - 1)).otherwise(F.call_function("shiftleft", F.lit(1).cast("long"), left.cast("int")) - 1)
        return total + F.bit_count(_word(*key, w).bitwiseAND(mask)).cast("long")

    words = F.sequence(F.lit(0).cast("long"), _div(n - 1, F.lit(BITS)))
    return F.when(n > 0, F.aggregate(words, F.lit(0).cast("long"), bits)).otherwise(F.lit(0).cast("long"))


def _binomial(n: Column, a: Column, size: Column, *key: Column) -> Column:
    """How many of ``n`` draws fall on ``a`` of ``size`` places, exactly in law and in whole numbers.

    A draw is a number below 1 that is read bit by bit and compared with a / size; a fair
    toss decides half of the draws left at each bit.
    """

    def step(s: Column, t: Column) -> Column:
        upper = s["a"] * 2 >= size

        def moved(h: Column) -> Column:
            return F.struct(
                F.when(upper, s["n"] - h).otherwise(h).alias("n"), F.when(upper, s["a"] * 2 - size).otherwise(s["a"] * 2).alias("a"),
                F.when(upper, s["x"] + h).otherwise(s["x"]).alias("x"))

        return F.when((s["n"] == 0) | (s["a"] == 0), s).otherwise(_let(_heads(s["n"], *key, t), moved))

    start = F.struct(n.cast("long").alias("n"), a.cast("long").alias("a"), F.lit(0).cast("long").alias("x"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(STEPS)), start, step)["x"]


def multiplicities(units: DataFrame, key: list[str], stratum: str | None, replicates: int, seed: int = 0) -> DataFrame:
    """``stratum, unit, times``: how often each unit (its ``key`` as a string) is drawn in each replicate, as an array.

    A stratum's n units are ordered by the MD5 of their key and drawn n times with
    replacement. Their order is cut into halves down to leaves of LEAF units; counts
    of all replicates go down together, and a leaf's draws become an array for each of its
    places. Two shuffles: numbering, and joining places to units. The places come from a few nodes,
    whose bytes tell nothing of theirs, so that join is told to shuffle them: they are as many as the units.
    """
    s = F.col(stratum).cast("string") if stratum else F.lit("all")
    own = units.select(s.alias("stratum"), F.concat_ws("|", *key).alias("unit")).distinct().withColumn("h", F.md5("unit"))
    # a task numbers one slice of the hashes, and offsets of the slices are added
    own = own.withColumn("slice", F.substring("h", 1, 2))
    sizes = own.groupBy("stratum", "slice").agg(F.count("*").alias("m"))
    before = Window.partitionBy("stratum").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    base = sizes.withColumns({"base": F.coalesce(F.sum("m").over(before), F.lit(0)), "n": F.sum("m").over(Window.partitionBy("stratum"))})
    at = F.row_number().over(Window.partitionBy("stratum", "slice").orderBy("h", "unit")) - 1
    own = own.withColumn("at", at).join(base, ["stratum", "slice"]).select("stratum", "unit", (F.col("at") + F.col("base")).alias("i"), "n")
    depth = F.size(F.filter(F.sequence(F.lit(0), F.lit(40)), lambda x: F.call_function("shiftleft", F.lit(LEAF).cast("long"), x) < F.col("n")))
    whole = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("depth"))  # leaf j has the places from floor(n j / whole) on
    totals = sizes.groupBy("stratum").agg(F.sum("m").alias("n")).withColumn("depth", depth)
    tasks = int(units.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    deepest = totals.agg(F.max("depth")).first()[0] or 0

    nodes = totals.select("stratum", "n", "depth", F.lit(0).cast("long").alias("j"), F.array_repeat(F.col("n"), replicates).alias("counts"))
    for d in range(deepest):
        lo, mid, hi = (_div(F.col("n") * j, F.lit(1 << level)) for j, level in ((F.col("j"), d), (2 * F.col("j") + 1, d + 1), (F.col("j") + 1, d)))
        lower = F.transform("counts", lambda c, b: _binomial(c, mid - lo, hi - lo, F.lit(seed), F.col("stratum"), F.lit(d), F.col("j"), b))
        halves = nodes.withColumn("lower", F.when(F.col("depth") > d, lower)).select(
            "stratum", "n", "depth", F.explode(F.when(F.col("depth") > d, F.array(
                F.struct((2 * F.col("j")).alias("j"), F.col("lower").alias("counts")),
                F.struct((2 * F.col("j") + 1).alias("j"), F.zip_with("counts", "lower", lambda c, x: c - x).alias("counts")),
            )).otherwise(F.array(F.struct("j", "counts")))).alias("x"))
        nodes = halves.select("stratum", "n", "depth", "x.*")
        if d + 1 == min(SPREAD, deepest):
            nodes = nodes.repartition(tasks, "stratum", "j")  # by number, as few bytes stand for much work
    first = _div(F.col("n") * F.col("j"), whole)
    size = _div(F.col("n") * (F.col("j") + 1), whole) - first
    drawn = F.transform("counts", lambda c, b: F.when(c > 0, F.transform(F.sequence(F.lit(1).cast("long"), c), lambda t: _word(F.lit(seed), F.col("stratum"), F.lit("leaf"), F.col("j"), b, t) % F.col("size"))).otherwise(F.array().cast("array<bigint>")))
    places = F.transform(F.sequence(F.lit(0).cast("long"), F.col("size") - 1), lambda place: F.transform("drawn", lambda a: F.size(F.filter(a, lambda x: x == place))))
    leaves = nodes.withColumns({"first": first, "size": size}).withColumn("drawn", drawn).select("stratum", "first", F.posexplode(places).alias("place", "times"))
    placed = leaves.select("stratum", (F.col("first") + F.col("place")).alias("i"), "times").hint("merge")
    return own.join(placed, ["stratum", "i"]).select("stratum", "unit", "times")


def _total(weight: Column) -> Column:
    """The arrays ``times``, each times a weight, summed element by element."""
    scaled = F.transform("times", lambda x: x * weight.cast("double"))
    return vector_to_array(Summarizer.sum(array_to_vector(scaled), F.lit(1.0)))


def _per_replicate(df: DataFrame, by: list[str], value: Column, name: str) -> DataFrame:
    """A row a group and replicate of an array's values, of which a group has one."""
    return df.select(*by, F.posexplode(value).alias("replicate", name)).where(F.col(name).isNotNull())


def _interval(column: str) -> list:
    return [F.percentile(column, 0.025).alias("lo"), F.percentile(column, 0.975).alias("hi"), F.avg(column).alias("mean")]


def bootstrap_item_ci(df: DataFrame, k: int, replicates: int = 200, seed: int = 0, roles: Roles = ROLES) -> DataFrame:
    """``item, lo, hi, mean`` of per-item AP over resampled entities; the macro average is the row ``macro``."""
    own = enrich(df, [k], roles).where(F.col(roles.label) == 1).withColumn("unit", F.concat_ws("|", *roles.entity))
    own = staged(own.groupBy("unit", roles.item).agg(F.sum(f"ap@{k}").alias("s"), F.count("*").alias("n")), "resampled")  # sums and numbering read it
    drawn = own.join(multiplicities(own, ["unit"], None, replicates, seed).drop("stratum"), "unit")
    sums = drawn.groupBy(roles.item).agg(_total(F.col("s")).alias("s"), _total(F.col("n")).alias("n"))
    per = _per_replicate(sums, [roles.item], F.zip_with("s", "n", lambda s, n: F.when(n > 0, s / n)), "ap")
    macro = per.groupBy("replicate").agg(F.avg("ap").alias("ap")).withColumn(roles.item, F.lit("macro"))
    return per.unionByName(macro.select(roles.item, "replicate", "ap")).groupBy(roles.item).agg(*_interval("ap"))


def paired_bootstrap_delta(df: DataFrame, shifted: str, k: int, replicates: int = 200, stratum: str | None = None, weight: str | None = None, seed: int = 0, roles: Roles = ROLES) -> DataFrame:
    """Interval of macro AP of ``shifted`` less that of the score, on the same draws; a shift of nothing gives exactly 0.

    A unit is an entity within a stratum. Both scores are ranked as two variants of the rows, in one pass.
    """
    s = F.col(stratum).cast("string") if stratum else F.lit("all")
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    rows = df.select(*roles.identity, roles.label, s.alias("stratum"), w.alias("w"), F.explode(F.array(F.struct(F.lit("base").alias("variant"), F.col(roles.score).alias("x")), F.struct(F.lit("moved").alias("variant"), F.col(shifted).alias("x")))).alias("v"))
    rows = rows.select(*roles.identity, roles.label, "stratum", "w", F.col("v.variant").alias("variant"), F.col("v.x").alias(roles.score))
    wide = Roles(roles.time, (*roles.entity, "variant"), roles.item, roles.label, roles.score, roles.rank)
    both = enrich(rows, [k], wide).where(F.col(roles.label) == 1).withColumn("unit", F.concat_ws("|", *roles.entity))
    ap = {v: F.sum(F.when(F.col("variant") == v, F.col("w") * F.col(f"ap@{k}")).otherwise(0.0)).alias(v) for v in ("base", "moved")}
    own = staged(both.groupBy("stratum", "unit", roles.item).agg(*ap.values(), F.sum(F.when(F.col("variant") == "base", F.col("w")).otherwise(0.0)).alias("w")), "resampled")
    drawn = own.join(multiplicities(own, ["unit"], "stratum", replicates, seed), ["stratum", "unit"])
    sums = drawn.groupBy(roles.item).agg(*(_total(F.col(c)).alias(c) for c in ("base", "moved", "w")))
    means = sums.select(roles.item, *(F.zip_with(c, "w", lambda x, y: F.when(y > 0, x / y)).alias(c) for c in ("base", "moved")))
    per = _per_replicate(means, [roles.item], F.zip_with("moved", "base", lambda x, y: x - y), "d")
    return per.groupBy("replicate").agg(F.avg("d").alias("delta")).agg(*_interval("delta"))


def auc_ci(df: DataFrame, replicates: int = 50, seed: int = 0, roles: Roles = ROLES) -> DataFrame:
    """``item, lo, hi, mean`` of AUC over resampled entities; ties count half, and replicates without both classes are left out.

    Positives and negatives are arrays of replicates, summed per item and score. One sort
    by ranges of score serves all replicates: running sums of the negatives' arrays go
    within a range, and over the ranges' totals.
    """
    every = range(replicates)
    own = df.select(roles.item, roles.label, roles.score, F.concat_ws("|", *roles.entity).alias("unit"))
    drawn = own.join(multiplicities(own, ["unit"], None, replicates, seed).drop("stratum"), "unit")
    positive = (F.col(roles.label) == 1).cast("double")
    scored = drawn.groupBy(roles.item, F.col(roles.score).alias("s")).agg(_total(positive).alias("p"), _total(1 - positive).alias("n"))
    ranged = scored.repartitionByRange(roles.item, "s").withColumn("part", F.spark_partition_id())
    inside = Window.partitionBy(roles.item, "part").orderBy("s").rowsBetween(Window.unboundedPreceding, -1)
    run = ranged.select(roles.item, "part", "p", "n", F.array(*(F.coalesce(F.sum(F.col("n")[b]).over(inside), F.lit(0.0)) for b in every)).alias("below"))
    won = F.zip_with(F.zip_with("below", "n", lambda x, y: x + 0.5 * y), "p", lambda x, p: x * p)
    parts = run.withColumn("won", won).groupBy(roles.item, "part").agg(*(F.array(*(F.sum(F.col(c)[b]) for b in every)).alias(c) for c in ("p", "n", "won")))
    over = Window.partitionBy(roles.item).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # as many rows as ranges
    before = parts.withColumn("before", F.array(*(F.coalesce(F.sum(F.col("n")[b]).over(over), F.lit(0.0)) for b in every)))
    gained = F.zip_with(F.zip_with("p", "before", lambda p, x: p * x), "won", lambda x, y: x + y)
    whole = before.withColumn("won", gained).groupBy(roles.item).agg(*(F.array(*(F.sum(F.col(c)[b]) for b in every)).alias(c) for c in ("p", "n", "won")))
    auc = F.zip_with("won", F.zip_with("p", "n", lambda p, n: p * n), lambda x, y: F.when(y > 0, x / y))
    return _per_replicate(whole, [roles.item], auc, "auc").groupBy(roles.item).agg(*_interval("auc"))
