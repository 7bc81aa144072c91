import uuid
from glob import glob

import pytest
from pyspark.sql import functions as F

from rankweave.plans import dataset
from rankweave.sources import layout, tables


@pytest.fixture
def settings(spark):
    changed = {"spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in changed}
    for k, v in changed.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def name(kind):
    return f"{kind}_{uuid.uuid4().hex}"


def keys(spark, n=60):
    months = F.explode(F.array(F.lit("2024-01-31"), F.lit("2024-02-29")))
    return spark.range(n).select(F.concat(F.lit("c"), "id").alias("cust_id"), months.alias("m")).select(F.to_date("m").alias("snap_date"), "cust_id", F.explode(F.array(F.lit("rye"), F.lit("malt"))).alias("prod_name"))


def test_features_join_without_an_exchange(spark, settings, tmp_path):
    own = keys(spark)
    features = own.select("snap_date", "cust_id").distinct().where("cust_id <> 'c3'").withColumn("amount", F.length("cust_id") * 1.5)
    labels = own.where("prod_name = 'rye' AND cust_id < 'c4'").withColumn("label", F.lit(1))
    made = {"k": own, "l": labels, "f": features}
    names = {k: name(k) for k in made}
    for k, df in made.items():
        layout.write_bucketed(df, names[k], 4)
    with layout.co_located(spark):
        built = dataset.build_model_input(*(spark.table(names[k]) for k in "klf"), ["amount"])
        plan = built._jdf.queryExecution().executedPlan().toString()
        assert "Exchange hashpartitioning" not in plan.replace("Subquery", "\nSubquery").split("Subquery")[0] and plan.count("SortMergeJoin") >= 2
        assert "Exchange hashpartitioning" not in plan  # nor does the check of the keys need one
    out = dataset.write_model_input(spark, *(names[k] for k in "klf"), ["amount"], f"{tmp_path}/out", {"v": "x"})
    want = dataset.build_model_input(own, labels, features, ["amount"])
    row = lambda df: sorted(map(str, df.select(F.to_date("snap_date").alias("d"), "cust_id", "prod_name", "label", "amount").collect()))
    assert row(out) == row(want) and out.where("amount IS NULL").count() == 4
    assert spark.conf.get("spark.sql.requireAllClusterKeysForCoPartition") == "true"
    layout.write_bucketed(features.unionByName(features.limit(1)), names["f"], 4)
    with pytest.raises(Exception, match="repeated key"):
        dataset.write_model_input(spark, *(names[k] for k in "klf"), ["amount"], f"{tmp_path}/out", {"v": "x"})


def test_one_file_a_bucket_and_partition(spark):
    table = name("parts")
    layout.write_bucketed(keys(spark, 500).repartition(7), table, 3, ["snap_date"])
    files = [f.rsplit("/", 2) for f in spark.table(table).inputFiles()]
    assert len(files) == 6 and len({f[1] for f in files}) == 2
    assert spark.table(table).count() == 2000


def test_balanced_writes_bound_files_and_split_hot_partitions(spark, tmp_path):
    rows = spark.range(120_000).select(F.sha2(F.col("id").cast("string"), 256).alias("x"), F.when(F.col("id") < 110_000, "hot").otherwise(F.concat(F.lit("p"), F.col("id") % 10)).alias("part")).repartition(8)
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(size)
    spark.conf.set(size, "1m")
    try:
        for balance in (False, True):
            tables.write_versioned(rows, f"{tmp_path}/{balance}", {"v": "x"}, ["part"], balance=balance)
    finally:
        spark.conf.set(size, before)
    count = lambda b, part: len(glob(f"{tmp_path}/{b}/v=x/part={part}/*.parquet"))
    assert count(False, "p1") == 8 and count(True, "p1") == 1
    assert 4 <= count(True, "hot") <= 20
    assert tables.read_versioned(spark, f"{tmp_path}/True", {"v": "x"}).count() == 120_000
