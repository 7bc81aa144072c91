import random

import pytest
from pyspark.sql import functions as F

from rankweave.operators import metrics as m
from rankweave.operators import query_arrays
from rankweave.roles import Roles

#: Four items; a tie of Q and R in the first query, a positive beyond the third place in the second, and a query without a positive.
ROWS = [("2021-05-01", who, item, score, label) for who, scores, labels in (
    ("ann", (0.8, 0.6, 0.6, 0.2), (0, 1, 1, 0)), ("ben", (0.5, 0.1, 0.7, 0.9), (0, 1, 0, 1)), ("cem", (0.4, 0.3, 0.2, 0.1), (0, 0, 0, 0)))
    for item, score, label in zip("PQRS", scores, labels, strict=True)]
SCHEMA = "snap_date string, cust_id string, prod_name string, score double, label int"


@pytest.fixture(scope="module")
def frame(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def test_hand_computed_queries(frame):
    rows = {r.cust_id: r for r in m.per_query_metrics(m.enrich(frame, [3]), [3]).collect()}
    assert rows.keys() == {"ann", "ben"}
    # ann: positives at places 2 and 3, (1/2 + 2/3) / 2; ben: at 1 and 4, of which the first three places have one
    assert [round(rows["ann"][f"{n}@3"], 6) for n in ("map", "ndcg", "precision", "recall")] == [0.583333, 0.693426, 0.666667, 1.0]
    assert [round(rows["ben"][f"{n}@3"], 6) for n in ("map", "ndcg", "precision", "recall")] == [0.5, 0.613147, 0.333333, 0.5]


def test_hand_computed_overall_and_items(frame):
    own = m.enrich(frame, [3])
    over = m.overall_metrics(m.per_query_metrics(own, [3]), [3]).first()
    assert (round(over["map@3"], 6), round(over["ndcg@3"], 6), over.n_queries) == (0.541667, 0.653287, 2)
    items = {r.prod_name: r for r in m.item_metrics(own, ["prod_name"], [3]).collect()}
    assert {k: round(r["map_attr@3"], 6) for k, r in items.items()} == {"Q": 0.25, "R": 0.666667, "S": 1.0}
    assert {k: r.mean_pos for k, r in items.items()} == {"Q": 3, "R": 3, "S": 1}


def test_ties_go_to_the_first_item_and_queries_without_positives_are_out(spark):
    rows = [("d", "q", "B", 0.5, 1), ("d", "q", "A", 0.5, 0), ("d", "none", "A", 1.0, 0)]
    df = spark.createDataFrame(rows, SCHEMA)
    ranked = {r.prod_name: r.pos for r in m.rank_within_query(df).where("cust_id = 'q'").collect()}
    assert ranked == {"A": 1, "B": 2}
    assert m.per_query_metrics(m.enrich(df, [1]), [1]).count() == 1
    long = {(r.level, r.metric): r.value for r in query_arrays.metric_bundle(df, [1]).collect() if r.level == "overall"}
    assert long["overall", "n_excluded_queries"] == 1 and long["overall", "n_queries"] == 1


def test_recall_of_all_items_is_one_and_metrics_are_bounded(spark):
    from rankweave import frames

    own = m.per_query_metrics(m.enrich(frames.pred(spark, "/root/testdata/sf0.001"), [3, 6]), [3, 6])
    worst = own.agg(F.min("recall@6").alias("r"), F.min("map@3").alias("lo"), F.max("ndcg@3").alias("hi")).first()
    assert worst.r == 1 and worst.lo >= 0 and worst.hi <= 1 + 1e-12


def test_macro_families(spark):
    per = spark.createDataFrame([("A", 1.0, 1), ("B", 0.0, 3)], "prod_name string, x double, n_pos long")
    assert m.macro_average(per, ["x"]).first().macro_x == 0.5
    assert m.macro_average(per, ["x"], min_positives=2).first().macro_x == 0.0
    assert m.macro_average(per, ["x"], alpha=1.0).first().macro_x == 0.25
    assert m.macro_average(per, ["x"], shrink=1.0).first().macro_x == pytest.approx((0.5 * 1 + 0.5 * 0.25 + 0.25 * 0.25) / 2)


def test_categories(spark, frame):
    items = frame.select("prod_name").distinct()
    mapping = spark.createDataFrame([("P", "X"), ("Q", "X")], "prod_name string, category string")
    assert {(r.prod_name, r.category) for r in m.category_map(items, mapping).collect()} == {("P", "X"), ("Q", "X"), ("R", "R"), ("S", "S")}
    with pytest.raises(ValueError, match="unknown"):
        m.category_map(items, spark.createDataFrame([("Z", "X")], "prod_name string, category string"))
    best = m.collapse_to_categories(frame, m.category_map(items, mapping)).where("cust_id = 'ann' AND prod_name = 'X'").first()
    assert (best.score, best.label) == (0.8, 1)


def test_other_roles(spark):
    roles = Roles("t", ("u", "v"), "i", "y", "s", "r")
    df = spark.createDataFrame([("d", 1, 2, "a", 0.1, 1), ("d", 1, 2, "b", 0.2, 0)], "t string, u int, v int, i string, s double, y int")
    assert m.per_query_metrics(m.enrich(df, [2], roles), [2], roles).first()["map@2"] == 0.5


def test_folded_queries_equal_windows(spark):
    rng = random.Random(2)
    rows = [("d" + str(i % 2), f"c{i}", p, rng.choice([None, 0.1, 0.5, 0.5, 0.9]), int(rng.random() < 0.35), "NS"[i % 2]) for i in range(60) for p in "PQRST"]
    df = spark.createDataFrame(rows, SCHEMA + ", segment string")
    kinds = spark.createDataFrame([("P", "first"), ("Q", "first"), ("R", "second")], "prod_name string, category string")
    long = {(r.grain, r.level, r.key, r.metric): r.value for r in query_arrays.metric_bundle(df, [1, 3], "segment", kinds).collect()}
    for grain, frame in (("item", df), ("category", m.collapse_to_categories(df, kinds, carry=["segment"]))):
        own = m.enrich(frame, [1, 3])
        per = m.per_query_metrics(own, [1, 3], carry=["segment"])
        for level, table in (("overall", m.overall_metrics(per, [1, 3]).withColumn("key", F.lit("all"))), ("segment", m.segment_metrics(per, "segment", [1, 3]).withColumnRenamed("segment", "key")), ("item", m.item_metrics(own, ["prod_name"], [1, 3]).withColumnRenamed("prod_name", "key"))):
            for r in table.collect():
                for metric in table.columns:
                    if metric != "key":
                        assert long.pop((grain, level, r.key, metric)) == pytest.approx(r[metric]), (grain, level, metric)
        groups = frame.groupBy("snap_date", "cust_id").agg(F.max("label").alias("x")).where("x = 0").count()
        assert long.pop((grain, "overall", "all", "n_excluded_queries")) == groups
    assert not long
    assert query_arrays.metric_bundle(df.limit(0), [1]).count() == 0


def test_bundles_need_two_exchanges_and_no_window(spark, tmp_path):
    rows = [("d", "c", "P", 0.5, 1, "N")]
    spark.createDataFrame(rows, SCHEMA + ", segment string").write.parquet(f"{tmp_path}/t")
    df = spark.read.parquet(f"{tmp_path}/t")
    plan = query_arrays.metric_bundle(df, [3], "segment")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2 and "Window" not in plan


def test_comparison_on_what_both_sides_have(spark):
    a = spark.createDataFrame([("d", "c1", "P", 0.9), ("d", "c1", "Q", 0.1), ("d", "c2", "P", 0.4), ("d", "c2", "Q", 0.6), ("d", "c3", "P", 0.5), ("d", "c1", "only a", 1.0)], "snap_date string, cust_id string, prod_name string, score double")
    b = spark.createDataFrame([("d", "c1", "P", 0.2), ("d", "c1", "Q", 0.3), ("d", "c2", "P", 0.8), ("d", "c2", "Q", 0.7), ("d", "c4", "P", 0.5), ("d", "c1", "only b", 1.0)], "snap_date string, cust_id string, prod_name string, score double")
    labels = spark.createDataFrame([("d", "c1", "P", 1), ("d", "c2", "Q", 1), ("d", "c2", "P", 0), ("d", "c3", "P", 1), ("d", "c1", "only a", 1)], "snap_date string, cust_id string, prod_name string, label int")
    got = {(r.level, r.key, r.metric): (r.a, r.b, r.delta) for r in query_arrays.comparison(a, b, labels, [2]).collect()}
    assert got["overall", "all", "map@2"] == (1.0, 0.5, 0.5) and got["overall", "all", "n_queries"] == (2, 2, 0)
    assert got["item", "P", "map_attr@2"] == (1.0, 0.5, 0.5) and got["overall", "all", "n_excluded_queries"] == (0, 0, 0)
    assert query_arrays.comparison(a, b.where("prod_name = 'only b'"), labels, [2]).count() == 0
