"""Operators that fail on purpose, and plans that must hold at any size."""

import pytest
from pyspark.sql import functions as F

from rankweave.operators import baseline, compare, joins, profile, sampling, shift
from rankweave.plans import dataset, partitions
from rankweave.sources import tables

SCHEMA = "snap_date string, cust_id string, prod_name string, score double, label int"


@pytest.fixture(scope="module")
def frame(spark):
    return spark.createDataFrame([("d", f"c{i}", p, i / 7, int(i % 3 == 0)) for i in range(30) for p in ("tea", "jam")], SCHEMA)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_empty_sides_fail(frame):
    with pytest.raises(ValueError, match="dev ratio"):
        sampling.entity_split(frame.where("cust_id = 'c1'"), 0.000011)
    with pytest.raises(ValueError, match="no positives"):
        sampling.tune_holdout_split(frame.withColumn("label", F.lit(0)), 0.5)
    with pytest.raises(ValueError, match="between"):
        sampling.tune_holdout_split(frame, 1.0)
    with pytest.raises(ValueError, match="share no items"):
        compare.restrict_to_common(frame.where("prod_name = 'tea'"), frame.where("prod_name = 'jam'"), frame)
    tune, holdout = sampling.tune_holdout_split(frame, 0.5)
    assert tune.count() + holdout.count() == 60 and not tune.join(holdout, "cust_id").count()


def test_joins_that_would_make_rows_fail(frame):
    keys, features = frame.select("snap_date", "cust_id", "prod_name"), frame.select("snap_date", "cust_id", F.lit(1.0).alias("x")).distinct()
    assert dataset.build_model_input(keys, frame, features, ["x"]).count() == keys.count()
    for twice in ((frame, features.union(features)), (frame.union(frame), features)):
        with pytest.raises(Exception, match="repeated key"):
            dataset.build_model_input(keys, *twice, ["x"]).collect()


def test_weights_keyed_by_codes():
    got = joins.code_weights({"a|x": 2.0, "b|x": 3.0, "q|x": 9.0}, ["seg", "item"], {"seg": ["b", "a"]})
    assert got == {"1|x": 2.0, "0|x": 3.0}


def test_decoupled_base_is_independent_of_the_ratios(spark):
    cells = spark.createDataFrame([("x", 10, 100), ("y", 5, 400)], "seg string, n_pos long, n_neg long")
    few, many = (profile.weight_surface(profile.ratio_surface(cells, mult), 0.5, 1.0, "decoupled", 0.5).orderBy("seg").collect() for mult in (1, 50))
    assert [r.floor for r in few] == [r.floor for r in many] == [10 / 50, 5 / 200]
    with pytest.raises(ValueError, match="base"):
        profile.weight_surface(cells, 0.5, 1.0, "other")


def test_the_work_grid_is_ordered(spark):
    one = lambda name, values: spark.createDataFrame([(v,) for v in values], f"{name} string")
    rows = partitions.work_grid(one("d", "ba"), one("b", "21"), one("i", "yx")).orderBy("place").collect()
    assert [(r.place, r.d + r.b + r.i) for r in rows] == list(enumerate(["a1x", "a1y", "a2x", "a2y", "b1x", "b1y", "b2x", "b2y"], 1))


def test_partitions_are_listed_by_folders(spark, tmp_path):
    df = spark.createDataFrame([("v1", "2020-01-01", 1), ("v2", "2020-01-02", 2), ("v1", "a b/c=d", 3), ("v1", None, 4)], "version string, day string, x int")
    path = f"{tmp_path}/t"
    df.write.partitionBy("version", "day").parquet(path)
    got = {r.day for r in tables.list_partitions(spark, path, ["day"], {"version": "v1"}).collect()}
    assert got == {"2020-01-01", "a b/c=d", None}
    assert tables.list_partitions(spark, f"{tmp_path}/none", ["day"]).count() == 0


def test_range_joins_are_no_cartesian_products(spark, frame):
    labels = frame.select(F.lit("2020-05-01").alias("snap_date"), "prod_name", "label")
    for df in (baseline.popularity_counts(labels, ["2020-06-01"], 3), baseline.monthly_popularity(labels, ["2020-06-01"], 3)):
        assert "CartesianProduct" not in plan(df)


def test_no_window_goes_over_an_item_alone(spark, frame):
    text = shift.weighted_quantile(frame.withColumn("w", F.lit(1.0)), ["prod_name"], "score", "w", 0.5)._jdf.queryExecution().optimizedPlan().toString()
    assert "windowspecdefinition(__g" in text and "__before" in text
    assert text.count("percentile_approx") >= 1
