import math
import random
import re
import statistics

import pytest
from pyspark.sql import functions as F

from rankweave.functions import text_mask
from rankweave.operators import ability, attribution, baseline, bootstrap, checks, compare, ml, profile, sampling, shift, suppression

SCHEMA = "snap_date string, cust_id string, prod_name string, score double, label int"


def test_suppression_by_hand(spark):
    """yam (second) lacks 1/2, all because of fig; leek (fourth) lacks 1/2, and a swap with fig would gain 1, one with kale 1/6."""
    rows = [("d", "u", "fig", 0.9, 0), ("d", "u", "yam", 0.7, 1), ("d", "u", "kale", 0.5, 0), ("d", "u", "leek", 0.2, 1)]
    pairs = suppression.suppression_pairs(spark.createDataFrame(rows, SCHEMA))
    got = {(r.target, r.suppressor): r for r in suppression.by_pair(pairs).collect()}
    gaps = {("yam", "fig"): 1 / 2, ("leek", "fig"): 3 / 7, ("leek", "kale"): 1 / 14}
    assert {k: r.gap for k, r in got.items()} == pytest.approx(gaps) and {k: r.share for k, r in got.items()} == pytest.approx(gaps)
    assert {r.target: r.top_suppressors for r in suppression.by_target(pairs).collect()} == {"yam": "fig", "leek": "fig,kale"}


def test_gaps_add_up(spark):
    from rankweave import frames
    from rankweave.operators import metrics as m

    df = frames.pred(spark, "/root/testdata/sf0.001")
    total = suppression.suppression_pairs(df).agg(F.sum("gap")).first()[0]
    own = m.enrich(df, [6]).where("label = 1").agg(F.sum(1 - F.col("prec_at_pos"))).first()[0]
    assert total == pytest.approx(own, rel=1e-9)


def test_cross_purchase(spark):
    """Of 25 customers 10 buy pens and 3 ink, 2 of these both."""
    rows = [("d", f"k{i}", p, 0.5, int(i < 10 if p == "pen" else i in (0, 5, 20))) for i in range(25) for p in ("pen", "ink")]
    got = {(r.item, r.other): r for r in suppression.cross_purchase(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert (got["pen", "ink"].n_item, got["pen", "ink"].n_other, got["pen", "ink"].n_joint) == (10, 3, 2)
    assert got["ink", "pen"].lift == pytest.approx(25 * 2 / (10 * 3))


def test_auc_with_ties(spark):
    df = spark.createDataFrame([("d", "a", "X", 0.9, 1), ("d", "b", "X", 0.5, 1), ("d", "c", "X", 0.5, 0), ("d", "e", "X", 0.1, 0), ("d", "f", "Y", 0.1, 0)], SCHEMA)
    got = {r.prod_name: r.auc for r in ability.weighted_auc(df, ["prod_name"], "score").collect()}
    assert got == {"X": 3.5 / 4, "Y": None}


def test_popularity_window_and_fallback(spark):
    rows = [("2019-03-10", "tea", 4), ("2019-03-11", "jam", 2), ("2019-09-01", "tea", 3), ("2019-10-05", "oil", 5)]
    labels = spark.createDataFrame(rows, "snap_date string, prod_name string, label int")
    year = {r.prod_name: (r["count"], r.fallback) for r in baseline.popularity_counts(labels, ["2019-10-05"], 12).collect()}
    assert year == {"tea": (7, False), "jam": (2, False)}  # the snapshot's own day is outside
    assert {r.prod_name: r["count"] for r in baseline.popularity_counts(labels, ["2019-10-05"], 2).collect()} == {"tea": 3}
    assert {r.fallback for r in baseline.popularity_counts(labels, ["2010-01-01"], 2).collect()} == {True}


def test_config_offset(spark):
    df = spark.createDataFrame([(s, p) for s in ("north", "south", "west") for p in ("tea", "jam", "oil")], "area string, prod_name string")
    offsets = shift.config_offset(df, "area", {"north|tea|0": 0.2, "north|jam|1": 0.4}, {"south|oil|1": 3.0})
    got = {(r.area, r.prod_name): r.offset for r in offsets.collect()}
    assert got["north", "tea"] == pytest.approx(math.log(5)) and got["north", "jam"] == pytest.approx(math.log(0.4))
    assert got["south", "oil"] == pytest.approx(math.log(3)) and got["west", "oil"] == 0
    spread = {r.area: r.offset_spread for r in shift.offset_spread(offsets, "area").collect()}
    assert spread == {"north": pytest.approx(math.log(12.5)), "south": pytest.approx(math.log(3)), "west": 0}
    with pytest.raises(ValueError):
        shift.config_offset(df, "area", {"north|tea|0": 0.0}, {})


def test_a_context_that_varies_within_a_query_shows_in_the_query_spread_alone(spark):
    rows = [("d", f"c{i}", p, tier) for i in range(3) for p, tier in (("tea", "hi"), ("jam", "hi"), ("oil", "lo"))]
    df = spark.createDataFrame(rows, "snap_date string, cust_id string, prod_name string, tier string")
    offsets = shift.config_offset(df, "tier", {"lo|oil|0": 0.5}, {})
    assert {r.offset_spread for r in shift.offset_spread(offsets, "tier").collect()} == {0.0}
    own = shift.query_offset_spread(df, offsets, "tier").first()
    assert own.p50 == pytest.approx(math.log(2)) and own.varies


def test_quantiles_by_parts_equal_sorting(spark):
    import random

    rng = random.Random(3)
    rows = [(g, v, w) for g in ("a", "b", None) for v, w in ((rng.choice([rng.random(), 0.25, 7.0]), rng.randint(1, 3)) for _ in range(rng.choice([1, 400])))]
    df = spark.createDataFrame(rows, "g string, v double, w int")
    got = {r.g: r.quantile for r in shift.weighted_quantile(df, ["g"], "v", "w", 0.7).collect()}
    medians = {r.g: r.median for r in shift.exact_median(df, ["g"], "v").collect()}
    for g in ("a", "b", None):
        own = sorted((v, w) for k, v, w in rows if k == g)
        total, run = sum(w for _, w in own), 0
        for v, w in own:
            run += w
            if run >= 0.7 * total:
                break
        assert got[g] == v and medians[g] == pytest.approx(statistics.median(v for v, _ in own))


def test_auc_gap_is_what_the_customers_level_adds(spark):
    # buyers of tea score high on everything: raw AUC is 1, within the query tea never stands out
    rows = [("d", f"c{i}", p, (0.8 if i < 5 else 0.2), int(i < 5 and p == "tea")) for i in range(10) for p in ("tea", "jam")]
    got = {r.prod_name: r for r in ability.item_auc(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert (got["tea"].raw_auc, got["tea"].centered_auc, got["tea"].auc_gap) == (1.0, 0.5, 0.5)
    assert got["jam"].raw_auc is None and got["jam"].auc_gap is None


def test_shifts_are_judged_on_the_holdout(spark):
    rows = [("d", f"c{i}", p, s, int(p == "tea")) for i in range(60) for p, s in (("tea", 0.4), ("jam", 0.6))]
    got = {r.side: r for r in shift.shift_search(spark.createDataFrame(rows, SCHEMA), ["tea"], 2).collect()}
    assert got["tune"].delta > 0 and got["holdout"].delta == got["tune"].delta == 0.5


def macro_ap(rows, k):
    """Macro AP in plain Python: the mean over items of the mean over their positives."""
    queries, terms = {}, {}
    for d, c, p, s, label in rows:
        queries.setdefault((d, c), []).append((-s, p, label))
    for own in queries.values():
        hits = 0
        for place, (_, p, label) in enumerate(sorted(own), 1):
            hits += label
            if label:
                terms.setdefault(p, []).append(hits / place if place <= k else 0.0)
    return sum(sum(t) / len(t) for t in terms.values()) / len(terms)


@pytest.mark.parametrize("seed", range(3))
def test_shift_steps_equal_macro_ap_at_every_midpoint(spark, seed):
    rng = random.Random(seed)
    items = ["tea", "jam", "oil", "rye", "ale"]
    rows = [("d", f"c{i}", p, rng.randrange(8) / 8, int(rng.random() < 0.3)) for i in range(25) for p in items if rng.random() < 0.9]  # many ties
    df = spark.createDataFrame(rows, SCHEMA)
    steps = shift.shift_steps(df, 3).collect()
    base = macro_ap(rows, 3)
    best = {r.prod_name: r for r in shift.best_shifts(shift.shift_steps(df, 3)).collect()}
    for item in items:
        own = sorted((r for r in steps if r.prod_name == item), key=lambda r: (r.lo is not None, r.lo))
        assert own[0].lo is None and own[-1].hi is None and all(a.hi == b.lo for a, b in zip(own, own[1:], strict=False))
        found = {}
        for r in own:
            shifts = [x for x in (r.lo, r.hi) if x is not None]
            middle = sum(shifts) / 2 if len(shifts) == 2 else r.hi - 1 if r.lo is None else r.lo + 1
            found[middle] = macro_ap([(d, c, p, s + (middle if p == item else 0), x) for d, c, p, s, x in rows], 3)
            assert r.macro_ap == pytest.approx(found[middle], abs=1e-12) and r.base == pytest.approx(base, abs=1e-12)
        most = max(found.values())
        want = min((abs(m), m) for m, v in found.items() if v >= most - 1e-9)[1] if most > base + 1e-9 else 0.0
        assert (best[item]["shift"], best[item].macro_ap) == (pytest.approx(want), pytest.approx(max(most, base)))
    some = shift.shift_steps(df, 3, ["jam"]).collect()
    assert sorted(map(str, some)) == sorted(str(r) for r in steps if r.prod_name == "jam")
    moves = shift.optimize_shifts(df, items, 3, moves=4)
    after = macro_ap([(d, c, p, s + moves[p], x) for d, c, p, s, x in rows], 3)
    assert after >= max(r.macro_ap for r in best.values()) - 1e-12


def test_shift_steps_make_no_row_for_each_shift(spark):
    df = spark.createDataFrame([("d", f"c{i}", p, s, int(p == "tea")) for i in range(30) for p, s in (("tea", 0.4), ("jam", 0.6))], SCHEMA)
    steps = shift.shift_steps(df, 2)
    assert steps.where("prod_name = 'tea'").count() == 2  # all queries cross at one point
    alone = spark.createDataFrame([("d", "c", "tea", 0.4, 1)], SCHEMA)
    assert [tuple(r) for r in shift.shift_steps(alone, 2).collect()] == [("tea", None, None, 1.0, 1.0)]
    assert shift.shift_steps(alone.limit(0), 2).count() == 0


def test_shift_steps_read_their_rows_once(spark):
    df = spark.createDataFrame([("d", f"c{i}", p, s, int(p == "tea")) for i in range(30) for p, s in (("tea", 0.4), ("jam", 0.6))] + [("d", "none", "rye", 0.1, 0)], SCHEMA)
    steps = shift.shift_steps(df, 2)
    plan = steps._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list" not in plan and "row_number" not in plan  # what follows the sums reads them from a table
    assert [(r.lo, r.hi, r.macro_ap) for r in steps.where("prod_name = 'rye'").collect()] == [(None, None, 0.5)]  # known from a query without a positive alone


def test_best_shifts_make_the_steps_once(spark):
    df = spark.createDataFrame([("d", f"c{i}", p, s, int(p == "tea")) for i in range(30) for p, s in (("tea", 0.4), ("jam", 0.6))], SCHEMA)
    best = shift.best_shifts(shift.shift_steps(df, 2))
    assert "windowspecdefinition" not in best._jdf.queryExecution().optimizedPlan().toString()
    assert {r.prod_name: (r.macro_ap, r.gain) for r in best.collect()} == {"tea": (1.0, 0.5), "jam": (1.0, 0.5)}


def test_rank_divergence(spark):
    rows = [("d", "c", p, f, v) for p, vs in (("same", (1.0, 2.0, 3.0)), ("turned", (9.0, 5.0, 1.0)), ("flat", (2.0, 2.0, 2.0))) for f, v in zip("xyz", vs, strict=True)]
    df = spark.createDataFrame(rows, "snap_date string, cust_id string, prod_name string, feature string, value double")
    got = {r.prod_name: r.divergence for r in attribution.rank_divergence(df, ["prod_name"]).collect()}
    assert got == {"same": pytest.approx(1.0), "turned": pytest.approx(0.0), "flat": 0.0}  # the whole's order is x, y, z downwards


@pytest.mark.parametrize("sizes", [(1, 32, 33), (100, 700)])
def test_every_replicate_draws_as_many_units_as_a_stratum_has(spark, sizes):
    units = [(f"s{s}", f"u{i}") for s, n in enumerate(sizes) for i in range(n)]
    got = bootstrap.multiplicities(spark.createDataFrame(units * 2, "stratum string, u string"), ["u"], "stratum", 40).collect()
    assert sorted((r.stratum, r.unit) for r in got) == sorted(units)
    for s, n in enumerate(sizes):
        own = [r.times for r in got if r.stratum == f"s{s}"]
        assert all(len(t) == 40 for t in own) and {sum(t[b] for t in own) for b in range(40)} == {n}
    if sizes[-1] == 700:  # in law: mean 1, variance (n - 1) / n, none with probability (1 - 1 / n) ** n
        draws = [x for r in got for x in r.times]
        assert statistics.pvariance(draws) == pytest.approx(1, abs=0.05) and draws.count(0) / len(draws) == pytest.approx(math.exp(-1), abs=0.01)


def broadcast_keys(df):
    """Keys of the broadcast joins in the plan that ran."""
    df.collect()
    return [k for keys in re.findall(r"BroadcastHashJoin \[([^]]*)]", df._jdf.queryExecution().executedPlan().toString()) for k in re.findall(r"(\w+)#", keys)]


def test_item_intervals_broadcast_no_draws(spark):
    rows = [("d", f"c{i}", p, ((i * 7 + j * 3) % 11) / 11, int((i + j) % 3 == 0)) for i in range(300) for j, p in enumerate("ABC")]
    df = spark.createDataFrame(rows, SCHEMA)
    # a leaf's draws are made after the shuffle, which has the few bytes of its nodes; there is a row of draws for each unit
    assert "i" not in broadcast_keys(bootstrap.bootstrap_item_ci(df, 3, 10))
    assert "i" not in broadcast_keys(bootstrap.multiplicities(df, ["cust_id"], None, 10))


def test_paired_intervals_broadcast_no_draws_and_read_their_rows_once(spark):
    rows = [("d", f"c{i}", p, ((i * 7 + j * 3) % 11) / 11, int((i + j) % 3 == 0)) for i in range(300) for j, p in enumerate("ABC")]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("stratum", F.when(F.col("cust_id") < "c2", "x").otherwise("y")).withColumn("moved", 1 - F.col("score"))
    found = bootstrap.paired_bootstrap_delta(df, "moved", 3, 10, "stratum")
    assert not {"stratum", "i"} <= set(broadcast_keys(found))
    assert "row_number(" not in found._jdf.queryExecution().optimizedPlan().toString().replace("row_number() windowspecdefinition(stratum", "")  # only the numbering of units; ranks are staged


def test_binomial_draws_in_law(spark):
    for n, a, size in ((1, 1, 3), (10, 1, 2), (200, 5, 7), (50, 0, 9), (0, 1, 2), (70, 9, 9)):
        own = spark.range(4000).select(bootstrap._binomial(F.lit(n).cast("long"), F.lit(a), F.lit(size), F.lit("x"), F.col("id")).alias("x"))
        mean, var, low, high = own.agg(F.avg("x"), F.var_pop("x"), F.min("x"), F.max("x")).first()
        p = a / size
        assert 0 <= low and high <= n and mean == pytest.approx(n * p, abs=4 * math.sqrt(n * p * (1 - p) / 4000) + 1e-9)
        assert var == pytest.approx(n * p * (1 - p), rel=0.15, abs=1e-9)


def test_intervals_equal_plain_resampling_and_explode_nothing(spark):
    rng = random.Random(5)
    rows = [("d", f"c{i}", p, rng.randrange(6) / 6, int(rng.random() < 0.4)) for i in range(90) for p in "ABC"]
    df = spark.createDataFrame(rows, SCHEMA)
    times = {r.unit: r.times for r in bootstrap.multiplicities(df, ["cust_id"], None, 12).collect()}
    want = []
    for b in range(12):
        own = [(s, x) for _, c, p, s, x in rows if p == "B" for _ in range(times[c][b])]
        pos, neg = [s for s, x in own if x], [s for s, x in own if not x]
        want.append(sum((s > t) + (s == t) / 2 for s in pos for t in neg) / len(pos) / len(neg))
    got = {r.prod_name: r for r in bootstrap.auc_ci(df, 12).collect()}["B"]
    assert got["mean"] == pytest.approx(statistics.mean(want)) and min(want) <= got.lo <= got.hi <= max(want)
    plan = bootstrap.auc_ci(df, 12)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("RepartitionByExpression [prod_name") == 1
    spread = bootstrap.bootstrap_item_ci(df, 3, 12)._jdf.queryExecution().executedPlan().toString()
    assert "replicate" not in spread.split("sum(")[-1]  # below the sums there is no row for each replicate
    never = df.withColumn("label", F.when(F.col("prod_name") == "A", 0).otherwise(F.col("label")))
    assert {r.prod_name for r in bootstrap.auc_ci(never, 5).collect()} == {"B", "C"}
    poor = df.withColumn("score", F.when(F.col("prod_name") == "C", -1.0).otherwise(F.col("score")))
    assert {r.prod_name: r.hi for r in bootstrap.bootstrap_item_ci(poor, 1, 5).collect()}["C"] >= 0


def test_bootstrap(spark):
    rows = [("d", f"c{i}", p, ((i * 7 + j * 3) % 11) / 11, int((i + j) % 3 == 0)) for i in range(40) for j, p in enumerate("ABC")]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("stratum", F.when(F.col("cust_id") < "c2", "x").otherwise("y"))
    zero = bootstrap.paired_bootstrap_delta(df, "score", 3, 20, "stratum").first()
    assert (zero.lo, zero.hi, zero.mean) == (0, 0, 0)
    ci = {r.prod_name: r for r in bootstrap.bootstrap_item_ci(df, 3, 30).collect()}
    assert all(r.lo <= r.mean <= r.hi for r in ci.values()) and "macro" in ci


def test_comparison(spark):
    a = spark.createDataFrame([("d", c, p, 0.1, 1) for c in ("c1", "c2", "c3") for p in ("p1", "p2", "p4")], SCHEMA)
    b = spark.createDataFrame([("d", c, p, 0.2) for c in ("c1", "c2") for p in ("p1", "p2")], "snap_date string, cust_id string, prod_name string, score double")
    labels = spark.createDataFrame([("d", "c1", "p1", 1)], "snap_date string, cust_id string, prod_name string, label int")
    ca, cb = compare.restrict_to_common(a, b, labels)
    assert ca.count() == cb.count() == 4 and cb.agg(F.sum("label")).first()[0] == 1
    got = {(r.side, r.kind): (r.total, r.common, r.dropped) for r in compare.comparison_coverage(a, b).collect()}
    assert got["a", "entity"] == (3, 2, 1) and got["b", "item"] == (2, 2, 0)
    with pytest.raises(ValueError, match="unmapped"):
        compare.external_predictions(b, {c: c for c in b.columns}, spark.createDataFrame([("p1", "q")], "source string, item string"), drop_unmapped=False)


def test_checks(spark):
    df = spark.createDataFrame([("d", 1, None), ("d", 1, 2), ("d", 1, 2)], "day string, a int, b int")
    one = checks.partition_quality(df, "day", ["a", "b"]).first()
    assert one.duplicate_ratio == pytest.approx(2 / 3) and one.null_ratio == pytest.approx(1 / 9)
    assert [r.column for r in checks.missing_columns(df, ["a", "zz"]).collect()] == ["zz"]
    bad = {r.column for r in checks.schema_checks(spark.createDataFrame([(1.0, "x", 1)], "f double, s string, k int"), ["f"], ["s", "k"], ["k"]).collect()}
    assert bad == {"f", "s", "k"}


def test_quadrants(spark):
    df = spark.createDataFrame([("d", "c1", "A", 0.9, 1), ("d", "c1", "B", 0.1, 0), ("d", "c2", "A", 0.9, 0), ("d", "c2", "B", 0.1, 1)], SCHEMA)
    got = [r.quadrant for r in sampling.quadrants(df, 1).orderBy("cust_id", "prod_name").collect()]
    assert got == ["TP", "TN", "FP", "FN"]


def test_profiles_and_masks(spark):
    df = spark.createDataFrame([(1, "a", "tel 12345 x", 1.0), (2, "a", "no", None)], "id int, c string, t string, v double")
    assert {r.column: r.bucket for r in profile.column_profile(df).collect()}["c"] == "drop"
    assert profile.feature_statistics(df, ["v"]).first().null_rate == 0.5
    out = df.withColumn("t", text_mask.mask_identifiers(F.col("t"), "[0-9]{3}[0-9]+", 2))
    assert out.first().t == "tel 12*** x"
    text_mask.require_clean(out, "t", {"n": "[0-9]{4}"})
    with pytest.raises(ValueError):
        text_mask.require_clean(df, "t", {"n": "[0-9]{4}"})
    surface = profile.weight_surface(profile.ratio_surface(spark.createDataFrame([("a", 0, 5), ("b", 2, 8)], "s string, n_pos long, n_neg long"), 2.0), 0.5, 0.0)
    assert {r.s: (r.ratio, r.w_pos) for r in surface.collect()} == {"a": (1.0, 1.0), "b": (0.5, 1.0)}
    terms = attribution.linear_attributions(spark.createDataFrame([(1, 1.0), (2, 3.0)], "k int, f double"), {"f": 2.0}, ["k"])
    assert {r.k: r.value for r in terms.collect()} == {1: -2.0, 2: 2.0}


def test_models(spark):
    rows = [("d", f"c{i}", p, 0.0, int(p == "A")) for i in range(20) for p in ("A", "B")]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("x", (F.col("prod_name") == "A").cast("double"))
    model = ml.fit_pointwise(df, ["x"], maxIter=5)
    scored = ml.score(df.drop("score"), model, ["x"])
    assert ml.RankingEvaluator("map", 2).evaluate(scored) == 1.0
    assert ml.feature_importance(spark, model, ["x"]).first().importance > 0
    assert ml.calibrate(scored, scored, "sigmoid").where("score between 0 and 1").count() == 40
    assert ml.search_space({"a": ("int", 1, 3), "b": ("choice", ["q"])}, 2) == ml.search_space({"a": ("int", 1, 3), "b": ("choice", ["q"])}, 2)
