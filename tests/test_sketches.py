import random
import shutil
import statistics

import pytest
from pyspark.sql import functions as F

from rankweave.operators import sketches
from rankweave.plans import profiles


def rows(months=4, n=3000):
    rng = random.Random(4)
    return [(f"2024-0{m + 1}", rng.gauss(m, 2) if rng.random() < 0.9 else None, rng.randrange(500 * (m + 1)), rng.choice("abc") * (m + 1)) for m in range(months) for _ in range(n)]


def test_merged_profile_is_near_the_whole(spark):
    data = rows()
    df = spark.createDataFrame(data, "month string, x double, y long, z string")
    got = {r.column: r for r in sketches.merged(sketches.column_sketches(df, ["month"], ["x", "y", "z"])).collect()}
    known = [r[1] for r in data if r[1] is not None]
    x = got["x"]
    assert x.rows == len(data) and x.null_rate == pytest.approx(1 - len(known) / len(data))
    assert x["mean"] == pytest.approx(statistics.mean(known)) and x["std"] == pytest.approx(statistics.stdev(known), rel=1e-12)
    assert (x.low, x.high) == (min(known), max(known))
    for q in (25, 50, 75):
        assert sum(v <= x[f"p{q}"] for v in known) / len(known) == pytest.approx(q / 100, abs=0.02)
    assert got["y"].distinct == pytest.approx(len({r[2] for r in data}), rel=0.07) and got["z"].distinct == 12
    assert got["z"].p50 is None and got["z"]["mean"] is None
    near = sketches.within(sketches.merged(sketches.column_sketches(df, ["month"], ["x", "y", "z"])), df)
    assert all(r.distinct_within and r.ranks_within for r in near.collect())
    moved = df.withColumns({"x": F.col("x") + 3, "y": F.col("y") % 300})
    off = {r.column: r for r in sketches.within(sketches.merged(sketches.column_sketches(moved, ["month"], ["x", "y", "z"])), df).collect()}
    assert not off["x"].ranks_within and not off["y"].distinct_within


def test_old_partitions_are_not_read_again(spark, tmp_path):
    source, path = f"{tmp_path}/source", f"{tmp_path}/sketches"
    data = rows()
    df = spark.createDataFrame(data, "month string, x double, y long, z string")
    df.where("month < '2024-03'").write.partitionBy("month").parquet(source)
    read = lambda: spark.read.schema("x double, y long, z string, month string").parquet(source)
    assert profiles.update_sketches(spark, path, read(), "month", ["x", "y"]) == []
    shutil.rmtree(f"{source}/month=2024-01")
    df.where("month >= '2024-03'").write.mode("append").partitionBy("month").parquet(source)
    assert profiles.update_sketches(spark, path, read(), "month", ["x", "y"]) == ["2024-01", "2024-02"]
    got = {r.column: r for r in profiles.read_profile(spark, path).collect()}
    assert got["x"].rows == len(data)
    part = {r.column: r for r in profiles.read_profile(spark, path, "month >= '2024-03'").collect()}
    assert part["y"].rows == len(data) // 2 and part["y"].high == max(r[2] for r in data if r[0] >= "2024-03")
    assert profiles.update_sketches(spark, path, read(), "month", ["x", "y"]) == ["2024-01", "2024-02", "2024-03", "2024-04"]
    assert {r.column: r.rows for r in profiles.read_profile(spark, path).collect()} == {"x": len(data), "y": len(data)}


def test_empty_and_null_columns(spark):
    df = spark.createDataFrame([("m", None, None)] * 3, "month string, x double, z string")
    got = {r.column: r for r in sketches.merged(sketches.column_sketches(df, ["month"], ["x", "z"])).collect()}
    assert got["x"].null_rate == 1 and got["x"]["mean"] is None and got["x"].p50 is None and got["x"].distinct == 0 and got["z"].distinct == 0
    assert sketches.merged(sketches.column_sketches(df.limit(0), ["month"], ["x"])).count() == 0
