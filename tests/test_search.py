import random

import pytest
from pyspark.sql import functions as F

from rankweave.operators import ml
from rankweave.plans import search

SCHEMA = "snap_date string, cust_id string, prod_name string, label int, x double, y double"


def frame(spark, seed, n=150):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        for p in "ABC":
            x, y = rng.gauss(0, 1), rng.gauss(0, 1)
            rows.append(("d", f"c{seed}-{i}", p, int(x - 0.5 * y + rng.gauss(0, 1) > 0.7), x if rng.random() < 0.95 else None, y))
    return spark.createDataFrame(rows, SCHEMA)


def test_rungs():
    assert search.rungs(9, 16, 2, 2) == [(9, 2), (5, 4), (3, 8), (2, 16)]
    assert search.rungs(1, 5, 5, 2) == [(1, 5)] and search.rungs(4, 8, 4, 2) == [(4, 4), (2, 8)]


def test_halving_finds_what_all_trials_in_full_find(spark):
    train, val = frame(spark, 1), frame(spark, 2)
    trials = [{"regParam": r} for r in (3.0, 0.001, 0.9, 10.0, 0.3)]
    found = search.halving_search(train, val, ["x", "y"], trials, full=8, least=2, evaluator=ml.RankingEvaluator("map", 2)).collect()
    whole = ml.search_best(train, val, ["x", "y"], [{**t, "maxIter": 8} for t in trials], evaluator=ml.RankingEvaluator("map", 2)).collect()
    best = [r for r in found if r.best]
    assert len(best) == 1 and best[0].value == max(r.value for r in whole) and best[0].budget == 8
    assert {r.trial: r.value for r in whole}[best[0].trial] == best[0].value
    assert [sum(r.rung == i for r in found) for i in range(3)] == [5, 3, 2]
    assert {r.trial for r in found if r.rung == 1} == {r.trial for r in found if r.rung == 0 and r.kept}
    again = search.halving_search(train, val, ["x", "y"], trials, full=8, least=2, at_once=1, evaluator=ml.RankingEvaluator("map", 2)).collect()
    assert again == found


def test_training_rows_are_read_once(spark, tmp_path):
    frame(spark, 1, 40).write.parquet(f"{tmp_path}/train")
    reads = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            reads.add(batch.num_rows)
            yield batch

    train = spark.read.parquet(f"{tmp_path}/train")
    counted = train.mapInArrow(count, train.schema)
    search.halving_search(counted, frame(spark, 2, 40), ["x", "y"], [{"regParam": 0.1}, {"regParam": 1.0}, {"regParam": 0.01}], full=4, least=2)
    assert reads.value == 120


def test_nulls_of_any_type_have_their_value(spark):
    df = spark.createDataFrame([(1, 0.5), (None, float("nan")), (3, None)], "a int, b double")
    assert [r.v.toArray().tolist() for r in ml.feature_matrix(df, ["a", "b"], "v", ml.MISSING["gbt"]).collect()] == [[1.0, 0.5], [-1e30, -1e30], [3.0, -1e30]]


def test_refit_takes_the_best_trial(spark):
    train, val = frame(spark, 1), frame(spark, 2)
    trials = [{"regParam": 5.0}, {"regParam": 0.01}]
    found = search.halving_search(train, val, ["x", "y"], trials, full=6, least=6)
    model = search.refit_best(train, val, ["x", "y"], found, trials)
    assert model.getRegParam() == trials[found.where("best").first().trial]["regParam"] and model.getMaxIter() == 6
    assert ml.score(val, model, ["x", "y"]).where(F.col("score").between(0, 1)).count() == val.count()


def test_scored_months_are_replaced_and_bad_rows_fail(spark, tmp_path):
    from rankweave.plans import scoring

    train, test = frame(spark, 1, 60), frame(spark, 3, 20)
    model = ml.fit_pointwise(train, ["x", "y"], "logistic", maxIter=5)
    later = test.withColumn("snap_date", F.lit("2024-02-29"))
    both = test.withColumn("snap_date", F.lit("2024-01-31")).unionByName(later)
    back, seen = scoring.score_test_set(spark, both, model, ["x", "y"], f"{tmp_path}/s", {"v": "x"}, train)
    assert seen["rows"] == back.count() == 120 and seen["queries"] == 40
    assert {tuple(sorted(r.ranks)) for r in back.groupBy("snap_date", "cust_id").agg(F.collect_list("rank").alias("ranks")).collect()} == {(1, 2, 3)}
    again, _ = scoring.score_test_set(spark, later.limit(30), model, ["x", "y"], f"{tmp_path}/s", {"v": "x"}, train)
    assert {str(r.snap_date): r["count"] for r in again.groupBy("snap_date").count().collect()} == {"2024-01-31": 60, "2024-02-29": 30}
    with pytest.raises(ValueError, match="repeated"):
        scoring.score_test_set(spark, later.unionByName(later), model, ["x", "y"], f"{tmp_path}/t", {"v": "x"})


def test_models_travel_in_a_session_that_has_observed(spark):
    from pyspark.sql import Observation

    spark.range(3).observe(Observation(), F.count(F.lit(1)).alias("n")).collect()
    train, test = frame(spark, 1, 40), frame(spark, 2, 10)
    for kind, params in (("logistic", {"maxIter": 3}), ("gbt", {"maxIter": 2, "maxDepth": 2})):
        model = ml.fit_pointwise(train, ["x", "y"], kind, **params)
        for method in ("isotonic", "sigmoid"):
            assert ml.calibrate(ml.score(train, model, ["x", "y"]), ml.score(test, model, ["x", "y"]), method).where("score between 0 and 1").count() == 30
    assert search.halving_search(train, test, ["x", "y"], [{"regParam": 0.1}], full=2, least=2).count() == 1
