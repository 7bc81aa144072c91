"""Registered queries over models, scoring and publication."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from .. import frames as fr
from ..operators import ml
from ..operators.encode import vocabulary
from ..sources import tables
from . import dataset, scoring, search
from .dataset_queries import features
from .metric_queries import rounded, with_segment

NAMES = ["n_orders", "total_price", "last"]


def _rows(spark, sf):
    """Candidates with the features of their year, and last year's score as one."""
    return with_segment(spark, sf).withColumn("last", F.col("score")).join(features(spark, sf).drop("priority"), ["snap_date", "cust_id"], "left")


def _split(spark, sf):
    rows = _rows(spark, sf)
    return rows.where("snap_date < DATE'1999-01-01'"), rows.where("snap_date = DATE'1999-01-01'"), rows.where("snap_date >= DATE'2000-01-01'")


def fit_calibrated_scores(spark, sf):
    train, val, test = _split(spark, sf)
    model = ml.fit_pointwise(train, NAMES, "logistic", maxIter=10)
    scored = [ml.score(x.drop("score"), model, NAMES) for x in (val, test)]
    return rounded(ml.calibrate(scored[0], scored[1], "isotonic").select("snap_date", "cust_id", "prod_name", "label", "score", "score_uncalibrated"))


def scored_test_set(spark, sf):
    """A fitted, calibrated model's scores of the test years, written by year: how many rows and queries came back, and whether ranks follow scores."""
    train, val, test = _split(spark, sf)
    model = ml.fit_pointwise(train, NAMES, "logistic", maxIter=10)
    back, seen = scoring.score_test_set(spark, test, model, NAMES, tables.fresh_path(spark, "test-scores"), {"version": "v1"}, val)
    before = F.lag("score").over(Window.partitionBy("snap_date", "cust_id").orderBy("rank"))
    checked = back.withColumn("fine", F.col("score").between(0, 1) & F.col("score_uncalibrated").between(0, 1) & (F.coalesce(before, F.lit(1.0)) >= F.col("score")))
    out = checked.groupBy(F.to_date("snap_date").alias("snap_date")).agg(F.count("*").alias("rows"), F.countDistinct("cust_id").alias("queries"), F.sum("label").alias("positives"), F.max("rank").alias("last_rank"), F.min("fine").alias("fine"))
    return out.withColumn("observed_rows", F.lit(seen["rows"]).cast("long"))


def feature_importance(spark, sf):
    train, val, _ = _split(spark, sf)
    model = ml.fit_pointwise(train, NAMES, "gbt", dev=val, maxIter=5, maxDepth=3)
    return rounded(ml.feature_importance(spark, model, NAMES))


def search_best_params(spark, sf):
    """Halving over four sets of parameters, whose fits run at once."""
    train, val, _ = _split(spark, sf)
    trials = ml.search_space({"regParam": ("log", 1e-4, 1e-1), "elasticNetParam": ("choice", [0.0, 0.5])}, 4)
    return search.halving_search(train, val, NAMES, trials, full=8, least=4, evaluator=ml.RankingEvaluator("macro", 3))


def refit_balance(spark, sf):
    """A model refitted on both parts: as an unregularised fit it expects as many positives as there are."""
    train, val, _ = _split(spark, sf)
    model = ml.refit(train, val, NAMES, "logistic", maxIter=100, tol=1e-12)
    both = ml.score(train.unionByName(val).drop("score"), model, NAMES)
    return both.agg(F.count("*").alias("rows"), F.sum("label").alias("positives"), (F.abs(F.sum("score") - F.sum("label")) <= 0.001 * F.sum("label")).alias("balanced"))


def isotonic_calibration(spark, sf):
    """A year's raw scores calibrated on themselves."""
    held = fr.pred(spark, sf).where("snap_date = DATE'1997-01-01'").select("snap_date", "cust_id", "prod_name", "label", "score")
    return rounded(ml.calibrate(held, held, "isotonic").select("snap_date", "cust_id", "prod_name", "label", "score", "score_uncalibrated"))


def publish_ranked(spark, sf):
    """Members of a year times all items, scored by an expression, checked and published."""
    items = fr.table(spark, sf, "part").select(F.col("p_type").alias("prod_name")).distinct()
    own = features(spark, sf).where("snap_date = DATE'1997-01-01'")
    fitted = dataset.Preprocessor(vocabulary(items, ["prod_name"]), ("prod_name",), ("n_orders", "total_price"))
    population = scoring.population_features(own.select("snap_date", "cust_id"), own, fitted, 8, ["priority"])
    scored = scoring.score_all_items(population, items, fitted, lambda g: g.withColumn("score", F.pmod(F.col("cust_id") * 7 + F.col("item_code") * 13, F.lit(101)) / 101.0))
    names = sorted(r.prod_name for r in items.collect())
    paths = [tables.fresh_path(spark, n) for n in ("staging", "production")]
    out = scoring.publish(spark, scored, *paths, names, len(names) * own.count(), "v1")
    return rounded(out.select(F.to_date("snap_date").alias("snap_date"), "cust_id", "prod_name", "score", "rank"))


QUERIES = {f.__name__: f for f in (fit_calibrated_scores, scored_test_set, feature_importance, search_best_params, refit_balance, isotonic_calibration, publish_ranked)}
ORACLE_SQL = {
    "scored_test_set": f"""WITH {fr.PRED}, t AS (SELECT * FROM pred WHERE snap_date >= DATE '2000-01-01')
SELECT snap_date, count(*) AS rows, count(DISTINCT cust_id) AS queries, sum(label)::BIGINT AS positives, 6 AS last_rank, true AS fine, (SELECT count(*) FROM t) AS observed_rows FROM t GROUP BY snap_date""",
    "refit_balance": f"WITH {fr.PRED} SELECT count(*) AS rows, sum(label)::BIGINT AS positives, true AS balanced FROM pred WHERE snap_date <= DATE '1999-01-01'",
    # the isotonic value at i is the greatest over a <= i of the least mean over a to b >= i
    "isotonic_calibration": f"""WITH {fr.PRED}, held AS (SELECT snap_date, cust_id, prod_name, label, score FROM pred WHERE snap_date = DATE '1997-01-01'),
g AS (SELECT score AS x, row_number() OVER (ORDER BY score) AS i, sum(sum(label)) OVER (ORDER BY score) AS y, sum(count(*)) OVER (ORDER BY score) AS n, sum(label) AS own_y, count(*) AS own_n FROM held GROUP BY score),
m AS (SELECT a.i AS a, b.i AS b, (b.y - a.y + a.own_y) / (b.n - a.n + a.own_n)::DOUBLE AS mean FROM g a JOIN g b ON b.i >= a.i),
l AS (SELECT a, b AS i, min(mean) OVER (PARTITION BY a ORDER BY b DESC) AS least FROM m),
iso AS (SELECT i, max(least) AS value FROM l GROUP BY i)
SELECT snap_date, cust_id, prod_name, label, round(value, 6) AS score, round(score, 6) AS score_uncalibrated FROM held JOIN g ON g.x = score JOIN iso USING (i)""",
    "publish_ranked": """WITH i AS (SELECT prod_name, row_number() OVER (ORDER BY prod_name) - 1 AS code FROM (SELECT DISTINCT p_type AS prod_name FROM part)),
p AS (SELECT DISTINCT o_custkey AS cust_id FROM orders WHERE year(o_orderdate) = 1997), s AS (SELECT cust_id, prod_name, ((cust_id * 7 + code * 13) % 101) / 101.0 AS score FROM p, i)
SELECT DATE '1997-01-01' AS snap_date, cust_id, prod_name, round(score, 6) AS score, (row_number() OVER (PARTITION BY cust_id ORDER BY score DESC, prod_name))::INT AS rank FROM s""",
}
