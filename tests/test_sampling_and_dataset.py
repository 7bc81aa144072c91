import zlib

import pytest
from pyspark.sql import functions as F

from rankweave.functions.hashing import stable_bucket
from rankweave.operators import encode, filters, joins, sampling
from rankweave.plans import dataset

SCHEMA = "snap_date string, cust_id string, prod_name string, label int"


@pytest.fixture(scope="module")
def keys(spark):
    rows = [(d, f"C{c}", p, int(c % 5 == 0)) for d in ("2024-01-31", "2024-02-29") for c in range(200) for p in ("A", "B")]
    return spark.createDataFrame(rows, SCHEMA)


def test_buckets_are_crc32_of_the_joined_key(spark):
    df = spark.createDataFrame([("x", 7)], "a string, b int").withColumn("d", F.to_date(F.lit("2024-01-31")))
    got = df.select(stable_bucket(df, ["a", "d", "b"], 1000, "s", 3).alias("n")).first().n
    assert got == zlib.crc32(b"x|2024-01-31 00:00:00|7|s|3") % 1000


def test_split_is_disjoint_and_complete(keys):
    train, dev = sampling.entity_split(keys, 0.3)
    a, b = ({r.cust_id for r in x.select("cust_id").distinct().collect()} for x in (train, dev))
    assert not a & b and len(a | b) == 200 and 30 < len(b) < 90
    assert train.count() + dev.count() == keys.count()


def test_stratified_sample_uses_overrides(keys):
    out = sampling.stratified_sample(keys, ["prod_name", "label"], 0.0, {"A|1": 1.0})
    assert {(r.prod_name, r.label) for r in out.collect()} == {("A", 1)} and out.count() == 80
    assert sampling.stratified_sample(keys, ["prod_name"], 1.0).count() == keys.count()


def test_diagnosis_sample(spark):
    """Rye has 30 positives; malt has 2, fewer than the floor, so that their two queries are all taken; seven queries have none."""
    bought = {f"rye buyer {i}": "rye" for i in range(30)} | {"first malt buyer": "malt", "second malt buyer": "malt"} | {f"idle {i}": None for i in range(7)}
    df = spark.createDataFrame([("d", c, p, int(p == own)) for c, own in bought.items() for p in ("rye", "oats", "malt")], SCHEMA)
    out = sampling.diagnosis_sample(df, floor=3, budget=6)
    per = {r.cust_id: (r.stratum, r.inclusion_weight) for r in out.collect()}
    assert {c: v for c, v in per.items() if "malt" in c} == {c: ("take_all", 1.0) for c in ("first malt buyer", "second malt buyer")}
    assert {v for c, v in per.items() if "rye" in c} == {("hash_ratio", 5.0)} and not [c for c in per if "idle" in c]
    with pytest.raises(ValueError, match="reserved"):
        sampling.diagnosis_sample(df.withColumn("stratum", F.lit(1)), 2, 10)


def test_capped_queries_are_those_of_lowest_bucket(keys):
    order = [tuple(r)[:2] for r in keys.select("snap_date", "cust_id").distinct().withColumn("b", stable_bucket(keys, ["snap_date", "cust_id"], 1 << 31, "cap", 0)).orderBy("b", "snap_date", "cust_id").collect()]
    for n in (0, 1, 37, 399, 400, 900):
        out = sampling.cap_queries(keys, n)
        assert {(r.snap_date, r.cust_id) for r in out.collect()} == set(order[:n]) and out.count() == 2 * min(n, 400)


def test_months(keys):
    assert filters.restrict_to_months(keys, []).count() == 0
    assert filters.restrict_to_months_or_all(keys, []).count() == keys.count()
    assert filters.restrict_to_months(keys, ["2024-02-29"]).count() == 400
    with pytest.raises(ValueError, match="no rows"):
        filters.require_rows(filters.restrict_to_months(keys, ["2020-01-01"]), "2020", keys.select("snap_date"))


def test_encoding(spark):
    df = spark.createDataFrame([(1, "b"), (2, "a"), (3, None), (4, "z")], "id int, c string")
    vocab = encode.vocabulary(df.where("id < 4"), ["c"])
    assert [(r.value, r.code) for r in vocab.orderBy("code").collect()] == [("a", 0), ("b", 1)]
    out = encode.encode_categoricals(df, ["c"], vocab)
    assert [r.c for r in out.orderBy("id").collect()] == [1, 0, -1, -1]
    assert encode.unknown_encoding_counts(out, ["c"]).first().unknown == 2
    wide = spark.range(1500).select(F.col("id").cast("string").alias("c"))
    many = encode.encode_categoricals(wide, ["c"], encode.vocabulary(wide, ["c"]))
    assert many.select("c").distinct().count() == 1500
    assert {r.c for r in encode.encode_categoricals(df, ["c"], vocab.limit(0)).collect()} == {-1}


def test_model_input_keeps_every_key(spark, keys):
    features = keys.select("snap_date", "cust_id").distinct().where("cust_id <> 'C3'").withColumns({"amount": F.lit(1.5), "seg": F.lit("s")})
    fitted = dataset.fit_preprocessor(features, ["2024-01-31"], ["prod_name", "seg"], {"prod_name": ["A", "B"]})
    assert fitted.features == ("prod_name", "amount", "seg")
    ready = dataset.apply_preprocessor(features, fitted, ["2024-01-31", "2024-02-29"])
    labels = keys.where("label = 1").select("snap_date", "cust_id", "prod_name", "label")
    out = dataset.build_model_input(keys, labels, ready, fitted.features)
    assert out.count() == keys.count() and dict(out.dtypes)["amount"] == "float"
    assert out.where("cust_id = 'C3' AND amount IS NULL AND label = 0").count() == 4
    assert out.agg(F.sum("label")).first()[0] == keys.agg(F.sum("label")).first()[0]
    assert dataset.apply_preprocessor(features, fitted, []).count() == 0
    with pytest.raises(ValueError, match="months"):
        dataset.fit_preprocessor(features, ["1999-01-31"], ["prod_name"], {})


def test_segments_replace_and_fail(spark, keys):
    source = spark.createDataFrame([("C1", "x"), ("C1", "w")], "cust_id string, seg string")
    out = joins.join_segments(keys.withColumn("seg", F.lit("old")), source, ["cust_id"], "seg")
    assert out.where("cust_id = 'C1'").select("seg").distinct().collect()[0].seg == "w" and out.count() == keys.count()
    with pytest.raises(ValueError, match="lacks"):
        joins.join_segments(keys, source, ["cust_id"], "nope")


def test_logit_passes_through_outside_the_unit_range(spark):
    df = spark.createDataFrame([(0.5,), (0.0,)], "s double")
    assert [round(r.logit, 3) for r in filters.score_to_logit(df, "s").collect()] == [0.0, -13.816]
    assert [r.logit for r in filters.score_to_logit(spark.createDataFrame([(2.0,), (0.5,)], "s double"), "s").collect()] == [2.0, 0.5]
