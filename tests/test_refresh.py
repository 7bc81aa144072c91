import pytest
from pyspark.sql import functions as F

from rankweave.plans import refresh
from rankweave.sources import tables


@pytest.fixture
def paths(tmp_path):
    return f"{tmp_path}/table", f"{tmp_path}/audit"


def month(spark, m, tag, n=4):
    return spark.range(n).select("id", F.lit(tag).alias("tag"), F.lit(m).alias("month"))


def months(spark, *names):
    return spark.createDataFrame([(n,) for n in names], "month string")


def content(spark, path):
    return {(r.month, r.tag): r["count"] for r in tables.read_versioned(spark, path, {"v": "x"}).groupBy(F.col("month").cast("string").alias("month"), "tag").count().collect()}


def test_broken_run_is_taken_up_again(spark, paths):
    path, audit = paths
    for m in ("m1", "m2", "m3"):
        tables.write_versioned(month(spark, m, "old"), path, {"v": "x"}, ["month"])
    built, broken = [], {"m4"}

    def build(values):
        built.append(values["month"])
        if values["month"] in broken:
            raise RuntimeError("lost source")
        return month(spark, values["month"], "new", 5).withColumn("extra", F.lit(1))

    def run():
        return refresh.refresh(spark, "t", path, ["month"], months(spark, "m2", "m3", "m4", "m5"), build, audit, "run7", {"v": "x"}, months(spark, "m3", "m5"))

    with pytest.raises(RuntimeError):
        run()
    assert built == ["m3", "m4"] and content(spark, path) == {("m1", "old"): 4, ("m2", "old"): 4, ("m3", "new"): 5}
    broken.clear()
    assert {r.month: (r.status, r.outcome) for r in run().collect()} == {
        "m1": ("surplus", "kept"), "m2": ("skip", "kept"), "m3": ("rebuild", "done before"), "m4": ("process", "built"), "m5": ("process", "built")}
    assert built == ["m3", "m4", "m4", "m5"]
    assert content(spark, path) == {("m1", "old"): 4, ("m2", "old"): 4, ("m3", "new"): 5, ("m4", "new"): 5, ("m5", "new"): 5}
    assert tables.read_versioned(spark, path, {"v": "x"}).where("extra = 1").count() == 15
    assert {r.outcome for r in run().collect()} == {"kept", "done before"} and len(built) == 4
    log = [(r.target_date, r.status, r.rows) for r in spark.read.parquet(audit).orderBy("started").collect()]
    assert log == [("month=m3", "committed", 5), ("month=m4", "failed", 0), ("month=m4", "committed", 5), ("month=m5", "committed", 5)]


def test_rows_of_another_partition_are_refused(spark, paths):
    path, audit = paths
    with pytest.raises(ValueError, match="4 rows don't belong"):
        refresh.refresh(spark, "t", path, ["month"], months(spark, "m1"), lambda v: month(spark, "m1", "a").unionByName(month(spark, "m2", "a")), audit, "r", {"v": "x"})
    assert not tables.exists(spark, path)


def test_a_partition_lost_while_it_was_replaced_is_built_again(spark, paths):
    path, audit = paths
    args = (spark, "t", path, ["month"], months(spark, "a b", "c%d"), lambda v: month(spark, v["month"], "a"), audit, "r", {"v": "x"})
    assert {r.outcome for r in refresh.refresh(*args).collect()} == {"built"}
    lost = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{tables.partition_path({'v': 'x', 'month': 'c%d'})}")
    assert lost.getFileSystem(spark._jsc.hadoopConfiguration()).delete(lost, True)
    assert {r.month: r.outcome for r in refresh.refresh(*args).collect()} == {"a b": "kept", "c%d": "built"}
    assert content(spark, path) == {("a b", "a"): 4, ("c%d", "a"): 4}


def test_empty_partitions_are_recorded(spark, paths):
    path, audit = paths
    out = refresh.refresh(spark, "t", path, ["month"], months(spark, "m1"), lambda v: month(spark, "m1", "a").limit(0), audit, "r", {"v": "x"})
    assert out.first().outcome == "empty" and spark.read.parquet(audit).first().status == "empty"
