import uuid

import pytest
from pyspark.sql import functions as F

from rankweave.plans import partitions
from rankweave.sources import tables


@pytest.fixture
def path(tmp_path):
    return f"{tmp_path}/t"


def frame(spark, date, n=2):
    return spark.range(n).select(F.concat(F.lit("c"), "id").alias("cust_id"), F.col("id").cast("double").alias("value"), F.lit(date).alias("snap_date"))


def test_dynamic_overwrite_and_listing(spark, path):
    assert tables.list_partitions(spark, path, ["snap_date"]).count() == 0
    tables.write_versioned(frame(spark, "2024-01-31"), path, {"version": "a b"}, ["snap_date"])
    tables.write_versioned(frame(spark, "2024-02-29"), path, {"version": "a b"}, ["snap_date"])
    tables.write_versioned(frame(spark, "2024-01-31", 5), path, {"version": "a b"}, ["snap_date"])
    back = tables.read_versioned(spark, path, {"version": "a b"})
    assert back.columns == ["cust_id", "value", "snap_date"] and back.count() == 7
    assert tables.list_partitions(spark, path, ["version"]).first().version == "a b"
    assert tables.list_partitions(spark, path, ["snap_date"], {"version": "other"}).count() == 0


def test_schema_evolution(spark, path):
    tables.write_versioned(frame(spark, "d1"), path, {"v": 1}, ["snap_date"])
    wide = frame(spark, "d2").drop("value").withColumn("more", F.lit(1))
    tables.write_versioned(wide, path, {"v": 1}, ["snap_date"])
    back = spark.read.option("mergeSchema", "true").parquet(path)
    assert back.where("snap_date = 'd2' AND value IS NULL AND more = 1").count() == 2
    with pytest.raises(TypeError):
        tables.write_versioned(frame(spark, "d3").withColumn("value", F.lit("text")), path, {"v": 1}, ["snap_date"])
    with pytest.raises(ValueError, match="removed"):
        tables.evolve_schema(wide, frame(spark, "d1").schema, allow_removed=False)


def test_reader_has_the_columns_of_all_partitions(spark, path):
    tables.write_versioned(frame(spark, "d1"), path, {"v": "x"}, ["snap_date"])
    tables.write_versioned(frame(spark, "d2").withColumn("more", F.lit(1)), path, {"v": "x"}, ["snap_date"])
    tables.write_versioned(frame(spark, "d3").drop("value"), path, {"v": "y"}, ["snap_date"])
    back = tables.read_versioned(spark, path, {"v": "x"})
    assert back.columns == ["cust_id", "value", "more", "snap_date"]
    assert sorted((r.snap_date, r.more) for r in back.collect()) == [("d1", None)] * 2 + [("d2", 1)] * 2
    assert tables.read_versioned(spark, path, {"v": "y"}).where("value IS NULL AND more IS NULL").count() == 2
    frame(spark, "d4").withColumn("other", F.lit(2.5)).drop("snap_date").write.parquet(f"{path}-plain/v=x/snap_date=d4")  # by another writer
    frame(spark, "d5").drop("snap_date").write.parquet(f"{path}-plain/v=x/snap_date=d5")
    assert tables.table_schema(spark, f"{path}-plain", ["v", "snap_date"]).fieldNames() == ["cust_id", "value", "other"]
    assert set(tables.read_versioned(spark, f"{path}-plain", {"v": "x"}).columns) == {"cust_id", "value", "other", "snap_date"}


def test_version_columns(spark):
    df = spark.createDataFrame([("v1", 1)], "version string, x int")
    assert tables.inject_versions(df, {"version": "v1", "y": 2}).first().y == 2
    with pytest.raises(ValueError):
        tables.inject_versions(df, {"version": "v2"})


def test_refresh_of_a_catalog_table(spark):
    name = f"t_{uuid.uuid4().hex}"
    spark.range(3).createOrReplaceTempView("src")
    sql = "-- header\nSELECT id, to_date(:d) AS snap_date FROM src WHERE id < :n"
    assert tables.refresh_table(spark, sql, name, {"snap_date": "date"}, d="2024-01-31", n=3) == "created"
    assert tables.refresh_table(spark, sql, name, {"snap_date": "date"}, d="2024-02-29", n=2) == "overwritten"
    assert tables.refresh_table(spark, sql, name, {"snap_date": "date"}, d="2024-01-31", n=1) == "overwritten"
    assert spark.table(name).count() == 3
    with pytest.raises(ValueError, match="removed"):
        tables.refresh_table(spark, "SELECT to_date(:d) AS snap_date", name, {"snap_date": "date"}, d="2024-01-31")
    tables.refresh_table(spark, "SELECT id, 1 AS extra, to_date(:d) AS snap_date FROM src", name, {"snap_date": "date"}, d="2024-03-31")
    assert spark.table(name).where("extra = 1").count() == 3
    with pytest.raises(ValueError, match="no value"):
        tables.template_sql(spark, "SELECT :missing AS x")
    spark.sql(f"DROP TABLE {name}")


def test_ddl_and_audit(spark, path):
    name = f"t_{uuid.uuid4().hex}"
    df = frame(spark, "d")
    tables.create_table(df, name, ["snap_date"], {"value": "it's a value"})
    tables.create_table(df, name, ["snap_date"])
    assert spark.table(name).columns == ["cust_id", "value", "snap_date"]
    spark.sql(f"DROP TABLE {name}")
    sink = tables.AuditSink(spark, path)
    sink.record("r", "t", "2024-01-31", "ok", 5)
    assert sink.flush() is None and spark.read.parquet(path).count() == 1
    bad = tables.AuditSink(spark, "nosuchscheme://x/y")
    bad.record("r", "t", "d", "ok")
    assert bad.flush()


def test_plan_and_guards(spark):
    df = lambda *d: spark.createDataFrame([(x,) for x in d], "d string")
    plan = {r.d: r.status for r in partitions.plan_partitions(df("a", "b", "c"), df("b", "c", "z"), ["d"], df("c")).collect()}
    assert plan == {"a": "process", "b": "skip", "c": "rebuild", "z": "surplus"}
    with pytest.raises(ValueError):
        partitions.require_single_partition(df("a", "b"), ["d"])
    assert partitions.require_single_partition(df("a", "a"), ["d"]).count() == 2
