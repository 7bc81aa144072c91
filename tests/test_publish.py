import shutil

import pytest
from pyspark.sql import functions as F

from rankweave.plans import scoring
from rankweave.sources import tables

ITEMS = ["rye", "oats", "malt"]


@pytest.fixture
def paths(tmp_path):
    return f"{tmp_path}/source", f"{tmp_path}/staging", f"{tmp_path}/production"


def scores(spark, n=40):
    rows = spark.range(n).select(F.lit("2024-05-31").alias("snap_date"), F.concat(F.lit("c"), "id").alias("cust_id"), F.col("id"))
    return rows.select("*", F.explode(F.array(*map(F.lit, ITEMS))).alias("prod_name")).select("snap_date", "cust_id", "prod_name", (F.pmod(F.xxhash64("id", "prod_name"), F.lit(1000)) / 1000).alias("score"))


def publish(spark, df, paths, rows=120):
    return scoring.publish(spark, df, paths[1], paths[2], ITEMS, rows, "v1")


def test_scores_are_read_once(spark, paths, monkeypatch):
    scores(spark).write.parquet(paths[0])
    write, calls = tables.write_versioned, []

    def write_then_lose_the_source(df, path, *rest):
        write(df, path, *rest)
        calls.append(path)
        shutil.rmtree(paths[0], ignore_errors=True)

    monkeypatch.setattr(tables, "write_versioned", write_then_lose_the_source)
    out = publish(spark, spark.read.parquet(paths[0]), paths)
    assert calls == list(paths[1:]) and out.count() == 120
    assert {tuple(sorted(r.ranks)) for r in out.groupBy("cust_id").agg(F.collect_list("rank").alias("ranks")).collect()} == {(1, 2, 3)}
    assert "rank" in out.columns and not [c for c in out.columns if c.startswith("__")]


@pytest.mark.parametrize(
    ("broken", "found"),
    [
        (lambda df: df.where("NOT (cust_id = 'c3' AND prod_name = 'rye')"), {"incomplete": 1, "row_difference": -1}),
        (lambda df: df.unionByName(df.where("cust_id = 'c4'")), {"incomplete": 1, "repeated": 3, "row_difference": 3}),
        (lambda df: df.withColumn("score", F.when(F.col("cust_id") != "c5", F.col("score"))), {"nulls": 3}),
        (lambda df: df.withColumn("prod_name", F.when((F.col("cust_id") == "c6") & (F.col("prod_name") == "rye"), "salt").otherwise(F.col("prod_name"))), {"unknown_items": 1}),
        (lambda df: df.where("cust_id <> 'c7'"), {"row_difference": -3}),
        (lambda df: df.limit(0), {"row_difference": -120}),
    ],
)
def test_failing_checks_leave_production_untouched(spark, paths, broken, found):
    with pytest.raises(ValueError) as error:
        publish(spark, broken(scores(spark)), paths)
    assert str(error.value) == f"not published: {found}"
    assert not tables.exists(spark, paths[2])


def test_repeated_keys_are_found_without_the_other_columns(spark):
    from rankweave.plans import partitions

    wide = spark.range(100).select("id", *(F.lit(str(i)).alias(f"f{i}") for i in range(50)))
    own = partitions.require_unique(wide, ["id"])
    assert own.columns == wide.columns and own.count() == 100
    assert "first(" not in own._jdf.queryExecution().optimizedPlan().toString()
    with pytest.raises(Exception, match="repeated key: 7"):
        partitions.require_unique(wide.unionByName(wide.where("id = 7")), ["id"]).count()
