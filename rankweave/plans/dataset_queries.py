"""Registered queries over filters, encoding, sampling and dataset assembly."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import frames as fr
from ..operators import encode, filters, joins, sampling
from ..sources import layout, tables
from . import dataset
from .metric_queries import rounded, with_segment

TRAIN = ["1996-01-01", "1997-01-01", "1998-01-01"]
DECLARED = {"priority": ["1-URGENT", "2-HIGH", "3-MEDIUM"]}
KEYS = ["snap_date", "cust_id", "prod_name"]


def features(spark, sf):
    orders = fr.table(spark, sf, "orders")
    return orders.groupBy(F.trunc("o_orderdate", "year").alias("snap_date"), F.col("o_custkey").alias("cust_id")).agg(
        F.count("*").alias("n_orders"), F.round(F.sum("o_totalprice"), 2).alias("total_price"), F.max("o_orderpriority").alias("priority"))


def labels(spark, sf):
    return fr.purchases(spark, sf).select(F.col("yr").alias("snap_date"), "cust_id", "prod_name", F.lit(1).alias("label"))


def months_in_as_date(spark, sf):
    orders = fr.table(spark, sf, "orders").select("o_orderkey", F.trunc("o_orderdate", "year").cast("string").alias("snap_date"))
    return filters.restrict_to_months(orders, TRAIN)


def label_join(spark, sf):
    return joins.join_labels(fr.pred(spark, sf).select(*KEYS), labels(spark, sf)).select(*KEYS, "label")


def feature_join(spark, sf):
    return joins.join_features(fr.pred(spark, sf).select(*KEYS), features(spark, sf))


def population_join(spark, sf):
    members = fr.table(spark, sf, "customer").select(F.to_date(F.lit("1996-01-01")).alias("snap_date"), F.col("c_custkey").alias("cust_id"))
    return joins.join_population(members, features(spark, sf))


def coverage_by_month(spark, sf):
    members = fr.table(spark, sf, "customer").select(F.explode(F.array(*(F.to_date(F.lit(d)) for d in TRAIN))).alias("snap_date"), F.col("c_custkey").alias("cust_id"))
    return joins.population_coverage(members, features(spark, sf))


def model_input(spark, sf):
    fitted = dataset.fit_preprocessor(features(spark, sf), TRAIN, ["prod_name", "priority"], DECLARED)
    ready = dataset.apply_preprocessor(features(spark, sf), fitted, TRAIN)
    keys = filters.restrict_to_months(with_segment(spark, sf), TRAIN)
    out = dataset.build_model_input(keys, labels(spark, sf), ready, fitted.features, ["segment"])
    return out.withColumn("total_price", F.col("total_price").cast("double"))


def bucketed_model_input(spark, sf):
    """The same model input by way of tables bucketed by customer."""
    fitted = dataset.fit_preprocessor(features(spark, sf), TRAIN, ["prod_name", "priority"], DECLARED)
    ready = dataset.apply_preprocessor(features(spark, sf), fitted, TRAIN)
    names = {n: f"{n}_" + tables.fresh_path(spark, "t").rsplit("-", 1)[1] for n in ("keys", "labels", "features")}
    for name, df in (("keys", with_segment(spark, sf).select(*KEYS, "segment")), ("labels", labels(spark, sf)), ("features", ready)):
        layout.write_bucketed(df, names[name], 8)
    out = dataset.write_model_input(spark, *names.values(), fitted.features, tables.fresh_path(spark, "bucketed"), {"version": "v1"}, ["segment"], TRAIN)
    return out.withColumns({"total_price": F.col("total_price").cast("double"), "snap_date": F.to_date("snap_date")})


def drop_groups_without_positives(spark, sf):
    return sampling.drop_groups_without_positives(fr.pred(spark, sf)).select(*KEYS, "label")


def vocabulary(spark, sf):
    return encode.vocabulary(fr.table(spark, sf, "orders"), ["o_orderpriority", "o_orderstatus"])


def encode_categoricals(spark, sf):
    orders = fr.table(spark, sf, "orders").select("o_orderkey", F.col("o_orderpriority").alias("priority"), "o_orderstatus")
    vocab = encode.declared_vocabulary(orders, DECLARED).unionByName(encode.vocabulary(orders, ["o_orderstatus"]))
    return encode.encode_categoricals(orders, ["priority", "o_orderstatus"], vocab)


def unknown_encoding_counts(spark, sf):
    return encode.unknown_encoding_counts(encode_categoricals(spark, sf), ["priority", "o_orderstatus"])


def cast_float_features(spark, sf):
    out = filters.cast_float_features(fr.table(spark, sf, "customer").select("c_custkey", "c_acctbal"), ["c_acctbal"])
    return out.select("c_custkey", F.col("c_acctbal").cast("double").alias("c_acctbal"))


def score_to_logit(spark, sf):
    return rounded(filters.score_to_logit(fr.pred(spark, sf).select(*KEYS, "score"), "score"))


OVERRIDES = {"BUILDING|0": 0.1, "MACHINERY|0": 0.29, "BUILDING|1": 1.0}


def stratified_sample(spark, sf):
    return sampling.stratified_sample(with_segment(spark, sf), ["segment", "label"], 0.5, OVERRIDES, hash="md5").select(*KEYS, "segment", "label")


def stratified_sample_crc32(spark, sf):
    return sampling.stratified_sample(with_segment(spark, sf), ["segment", "label"], 0.5, OVERRIDES).select(*KEYS, "segment", "label")


def calibration_sample(spark, sf):
    late = filters.restrict_to_months(with_segment(spark, sf), ["1999-01-01"])
    return sampling.stratified_sample(late, ["segment", "label"], 0.3, site="calibration", hash="md5").select(*KEYS)


def effective_ratio(spark, sf):
    return joins.override_join(with_segment(spark, sf), ["segment", "label"], OVERRIDES, 0.5, "ratio").select(*KEYS, "ratio")


def entity_split(spark, sf):
    train, dev = sampling.entity_split(fr.pred(spark, sf).select(*KEYS), 0.2, hash="md5")
    return train.withColumn("part", F.lit("train")).unionByName(dev.withColumn("part", F.lit("dev")))


def entity_sample(spark, sf):
    return sampling.entity_sample(fr.pred(spark, sf).select(*KEYS), 0.29, hash="md5")


def entity_bucket(spark, sf):
    customers = fr.table(spark, sf, "customer").select(F.col("c_custkey").alias("cust_id"))
    return sampling.entity_bucket(customers, 10, hash="md5")


def cap_queries(spark, sf):
    return sampling.cap_queries(fr.pred(spark, sf).select(*KEYS), 500, hash="md5")


def diagnosis_sample(spark, sf):
    return rounded(sampling.diagnosis_sample(fr.pred(spark, sf).select(*KEYS, "label"), 5200, 1000, hash="md5"))


def quadrants(spark, sf):
    return sampling.quadrants(fr.pred(spark, sf), 3).select(*KEYS, "quadrant")


def item_stratified_top_n(spark, sf):
    return sampling.stratified_top_n(sampling.quadrants(fr.pred(spark, sf), 3), ["prod_name", "quadrant"], 5, hash="md5").select(*KEYS, "quadrant")


def extreme_cases(spark, sf):
    own = sampling.quadrants(fr.pred(spark, sf), 3).withColumn("item", F.col("prod_name"))
    return rounded(sampling.extreme_cases(own, ["item", "quadrant"]).drop("prod_name"))


def required_months(spark, sf):
    return dataset.required_months(features(spark, sf), [*TRAIN, "2010-01-01", "1990-01-01"])


def unmatched_keys(spark, sf):
    return joins.unmatched_keys(with_segment(spark, sf), ["segment", "label"], [*OVERRIDES, "NOWHERE|1", "BUILDING|2"])


QUERIES = {f.__name__: f for f in (
    months_in_as_date, label_join, feature_join, population_join, coverage_by_month, model_input, bucketed_model_input, drop_groups_without_positives, vocabulary, encode_categoricals,
    unknown_encoding_counts, cast_float_features, score_to_logit, stratified_sample, stratified_sample_crc32, calibration_sample, effective_ratio, entity_split,
    entity_sample, entity_bucket, cap_queries, diagnosis_sample, quadrants, item_stratified_top_n, extreme_cases, required_months, unmatched_keys)}

_P = f"WITH {fr.PRED}"
_FEAT = "feat AS (SELECT date_trunc('year', o_orderdate)::DATE AS snap_date, o_custkey AS cust_id, count(*) AS n_orders, round(sum(o_totalprice), 2) AS total_price, max(o_orderpriority) AS priority FROM orders GROUP BY ALL)"
_TRAIN = "(DATE '1996-01-01', DATE '1997-01-01', DATE '1998-01-01')"
_CODE = "CASE {c} WHEN '1-URGENT' THEN 0 WHEN '2-HIGH' THEN 1 WHEN '3-MEDIUM' THEN 2 ELSE -1 END"
_STATUS = "(SELECT o_orderstatus AS s, (row_number() OVER (ORDER BY o_orderstatus) - 1)::INT AS code FROM (SELECT DISTINCT o_orderstatus FROM orders WHERE o_orderstatus IS NOT NULL))"
_RATIO = "CASE segment || '|' || label WHEN 'BUILDING|0' THEN 0.1 WHEN 'MACHINERY|0' THEN 0.29 WHEN 'BUILDING|1' THEN 1.0 ELSE 0.5 END"


def md5_bucket(columns: list[str], n: int = 100_000, site: str = "", seed: int = 0) -> str:
    key = " || '|' || ".join([*columns, f"'{site}'", f"'{seed}'"])
    return f"(('0x' || substr(md5({key}), 1, 8))::BIGINT % {n})"


_DATE = "strftime(snap_date, '%Y-%m-%d %H:%M:%S')"
_ID = [_DATE, "cust_id::VARCHAR", "prod_name"]
_Q = f"{_P}, qd AS (SELECT *, row_number() OVER (PARTITION BY snap_date, cust_id ORDER BY score DESC, prod_name) AS pos FROM pred), quad AS (SELECT *, CASE WHEN pos <= 3 AND label = 1 THEN 'TP' WHEN pos <= 3 THEN 'FP' WHEN label = 1 THEN 'FN' ELSE 'TN' END AS quadrant FROM qd)"
_PSEG = f"{_P}, ps AS (SELECT pred.*, segment FROM pred LEFT JOIN seg USING (cust_id))"
_MODEL_INPUT = f"{_PSEG}, {_FEAT} SELECT snap_date, cust_id, prod_name, label, n_orders, total_price::FLOAT::DOUBLE AS total_price, CASE WHEN n_orders IS NOT NULL THEN {_CODE.format(c='priority')} END AS priority, segment FROM ps LEFT JOIN feat USING (snap_date, cust_id) WHERE snap_date IN {_TRAIN}"
ORACLE_SQL = {
    "months_in_as_date": f"SELECT o_orderkey, date_trunc('year', o_orderdate)::DATE::VARCHAR AS snap_date FROM orders WHERE date_trunc('year', o_orderdate)::DATE IN {_TRAIN}",
    "label_join": f"{_P} SELECT snap_date, cust_id, prod_name, label FROM pred",
    "feature_join": f"{_P}, {_FEAT} SELECT snap_date, cust_id, prod_name, n_orders, total_price, priority FROM pred LEFT JOIN feat USING (snap_date, cust_id)",
    "population_join": f"WITH {_FEAT} SELECT DATE '1996-01-01' AS snap_date, c_custkey AS cust_id, n_orders, total_price, priority FROM customer LEFT JOIN feat ON cust_id = c_custkey AND snap_date = DATE '1996-01-01'",
    "coverage_by_month": f"WITH {_FEAT}, d AS (SELECT unnest([DATE '1996-01-01', DATE '1997-01-01', DATE '1998-01-01']) AS snap_date) SELECT d.snap_date, count(*) AS members, sum((n_orders IS NULL)::INT)::BIGINT AS without_features FROM customer CROSS JOIN d LEFT JOIN feat ON cust_id = c_custkey AND feat.snap_date = d.snap_date GROUP BY 1",
    "model_input": _MODEL_INPUT,
    "bucketed_model_input": _MODEL_INPUT,
    "drop_groups_without_positives": f"{_P} SELECT snap_date, cust_id, prod_name, label FROM pred QUALIFY sum(label) OVER (PARTITION BY snap_date, cust_id) > 0",
    "vocabulary": "SELECT \"column\", value, (row_number() OVER (PARTITION BY \"column\" ORDER BY value) - 1)::INT AS code FROM (SELECT DISTINCT 'o_orderpriority' AS \"column\", o_orderpriority AS value FROM orders UNION ALL SELECT DISTINCT 'o_orderstatus', o_orderstatus FROM orders) WHERE value IS NOT NULL",
    "encode_categoricals": f"SELECT o_orderkey, {_CODE.format(c='o_orderpriority')} AS priority, coalesce(code, -1) AS o_orderstatus FROM orders LEFT JOIN {_STATUS} ON s = o_orderstatus",
    "unknown_encoding_counts": f"SELECT 'priority' AS \"column\", sum(({_CODE.format(c='o_orderpriority')} = -1)::INT)::BIGINT AS unknown, count(*) AS rows FROM orders UNION ALL SELECT 'o_orderstatus', sum((o_orderstatus IS NULL)::INT)::BIGINT, count(*) FROM orders",
    "cast_float_features": "SELECT c_custkey, c_acctbal::FLOAT::DOUBLE AS c_acctbal FROM customer",
    "score_to_logit": f"{_P} SELECT snap_date, cust_id, prod_name, round(score, 6) AS score, round(ln(greatest(least(score, 1 - 1e-6), 1e-6) / (1 - greatest(least(score, 1 - 1e-6), 1e-6))), 6) AS logit FROM pred",
    "stratified_sample": f"{_PSEG} SELECT snap_date, cust_id, prod_name, segment, label FROM ps WHERE {md5_bucket(_ID, site='train')} < floor(({_RATIO})::DOUBLE * 100000)",
    "calibration_sample": f"{_PSEG} SELECT snap_date, cust_id, prod_name FROM ps WHERE snap_date = DATE '1999-01-01' AND {md5_bucket(_ID, site='calibration')} < floor(0.3::DOUBLE * 100000)",
    "effective_ratio": f"{_PSEG} SELECT snap_date, cust_id, prod_name, ({_RATIO})::DOUBLE AS ratio FROM ps",
    "entity_split": f"{_P} SELECT snap_date, cust_id, prod_name, CASE WHEN {md5_bucket(['cust_id::VARCHAR'], site='dev')} < 20000 THEN 'dev' ELSE 'train' END AS part FROM pred",
    "entity_sample": f"{_P} SELECT snap_date, cust_id, prod_name FROM pred WHERE {md5_bucket(['cust_id::VARCHAR'], site='val')} < 29000",
    "entity_bucket": f"SELECT c_custkey AS cust_id, {md5_bucket(['c_custkey::VARCHAR'], 10, 'bucket')}::INT AS entity_bucket FROM customer",
    "cap_queries": f"{_P}, q AS (SELECT DISTINCT snap_date, cust_id FROM pred), s AS (SELECT * FROM q ORDER BY {md5_bucket(_ID[:2], 1 << 31, 'cap')}, snap_date, cust_id LIMIT 500) SELECT snap_date, cust_id, prod_name FROM pred JOIN s USING (snap_date, cust_id)",
    "diagnosis_sample": f"""{_P}, pos AS (SELECT DISTINCT snap_date, cust_id, prod_name FROM pred WHERE label = 1),
rare AS (SELECT prod_name FROM pos GROUP BY 1 HAVING count(*) < 5200),
q AS (SELECT snap_date, cust_id, max((prod_name IN (SELECT prod_name FROM rare))::INT) AS rare FROM pos GROUP BY ALL),
r AS (SELECT least(1.0, 1000.0::DOUBLE / greatest(count(*), 1)) AS ratio FROM q WHERE rare = 0),
t AS (SELECT snap_date, cust_id, CASE WHEN rare = 1 THEN 'take_all' ELSE 'hash_ratio' END AS stratum, CASE WHEN rare = 1 THEN 1.0 ELSE 1 / ratio END AS w
  FROM q, r WHERE rare = 1 OR {md5_bucket(_ID[:2], site='diagnosis')} < floor(ratio * 100000))
SELECT snap_date, cust_id, prod_name, label, stratum, round(w::DOUBLE, 6) AS inclusion_weight FROM pred JOIN t USING (snap_date, cust_id)""",
    "quadrants": f"{_Q} SELECT snap_date, cust_id, prod_name, quadrant FROM quad",
    "item_stratified_top_n": f"{_Q} SELECT snap_date, cust_id, prod_name, quadrant FROM quad QUALIFY row_number() OVER (PARTITION BY prod_name, quadrant ORDER BY {md5_bucket(_ID, 1 << 31, 'top')}, snap_date, cust_id, prod_name) <= 5",
    "extreme_cases": f"""{_Q}, hi AS (SELECT *, 'highest' AS role FROM quad QUALIFY row_number() OVER (PARTITION BY prod_name, quadrant ORDER BY score DESC, snap_date, cust_id) = 1),
lo AS (SELECT *, 'lowest' AS role FROM quad QUALIFY row_number() OVER (PARTITION BY prod_name, quadrant ORDER BY score, snap_date DESC, cust_id DESC) = 1)
SELECT prod_name AS item, quadrant, role, snap_date, cust_id, round(score, 6) AS score FROM (SELECT * FROM hi UNION ALL SELECT * FROM lo)""",
    "required_months": f"WITH {_FEAT} SELECT month FROM (SELECT unnest([DATE '1996-01-01', DATE '1997-01-01', DATE '1998-01-01', DATE '2010-01-01', DATE '1990-01-01']) AS month) WHERE month NOT IN (SELECT snap_date FROM feat)",
    "unmatched_keys": f"{_PSEG} SELECT key FROM (SELECT unnest(['BUILDING|0', 'MACHINERY|0', 'BUILDING|1', 'NOWHERE|1', 'BUILDING|2']) AS key) WHERE key NOT IN (SELECT DISTINCT segment || '|' || label FROM ps)",
}
