"""Registered queries over sources, checks, refresh plans, source jobs, profiles, attributions and masks."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import frames as fr
from ..functions import text_mask
from ..operators import attribution, checks, joins, presence, profile, sketches
from ..operators import metrics as m
from ..sources import tables
from . import etl, partitions, profiles
from .dataset_queries import features
from .metric_queries import rounded, with_segment

D = "1998-06-15"
DE = "2024-01-25"
KEYS = ["snap_date", "cust_id", "prod_name"]
SIZED, REST = ["LARGE", "MEDIUM", "SMALL"], ["ECONOMY", "PROMO", "STANDARD"]


def feature_balances(spark, sf):
    return etl.balances(fr.table(spark, sf, "customer"), D)


def feature_card(spark, sf):
    return rounded(etl.card_features(fr.table(spark, sf, "orders"), D), 4)


def feature_savings(spark, sf):
    return rounded(etl.savings_flows(fr.table(spark, sf, "events"), DE), 4)


def feature_info(spark, sf):
    return etl.demographics(fr.table(spark, sf, "customer"), fr.table(spark, sf, "nation"), D)


def feature_concat(spark, sf):
    families = [feature_balances(spark, sf), etl.card_features(fr.table(spark, sf, "orders"), D), etl.savings_flows(fr.table(spark, sf, "events"), DE)]
    return rounded(etl.feature_concat(families, D), 4)


def purchases_by_day(spark, sf):
    orders = fr.table(spark, sf, "orders").select("o_orderkey", F.col("o_custkey").alias("cust_id"), F.to_date("o_orderdate").alias("day"))
    lines, parts = fr.table(spark, sf, "lineitem").select("l_orderkey", "l_partkey"), fr.table(spark, sf, "part").select("p_partkey", F.col("p_type").alias("item"))
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).join(parts, F.col("l_partkey") == F.col("p_partkey")).select("cust_id", "day", "item")


def label_family(spark, sf):
    return etl.label_family(purchases_by_day(spark, sf), SIZED, D)


def label_table(spark, sf):
    bought = purchases_by_day(spark, sf)
    return etl.label_table([etl.label_family(bought, SIZED, D), etl.label_family(bought, REST, D)])


def sample_pool(spark, sf):
    info = feature_info(spark, sf)
    return etl.sample_pool(info.select("cust_id"), label_table(spark, sf), info, SIZED + REST, D)


def inference_population(spark, sf):
    return etl.inference_population(features(spark, sf))


def partition_quality(spark, sf):
    lines = fr.table(spark, sf, "lineitem").withColumn("day", F.to_date("l_shipdate")).withColumn("l_tax", F.when(F.col("l_tax") > 0.05, F.col("l_tax")))
    return rounded(checks.partition_quality(lines.select("day", "l_suppkey", "l_partkey", "l_tax"), "day", ["l_suppkey", "l_tax"]))


def source_freshness(spark, sf):
    return checks.source_freshness(fr.table(spark, sf, "orders"), "o_orderdate", ["1998-06-15", "1998-06-16", "2024-01-01"], 5)


def schema_drift(spark, sf):
    return checks.schema_drift(fr.table(spark, sf, "orders"), {"o_orderkey": "bigint", "o_custkey": "int", "o_gone": "string", "o_orderdate": "timestamp_ntz"})


def schema_checks(spark, sf):
    return checks.schema_checks(fr.table(spark, sf, "orders"), ["o_totalprice", "o_orderstatus"], ["o_totalprice", "o_orderpriority", "o_custkey"], ["o_custkey", "o_orderkey"])


def item_coverage(spark, sf):
    frame = fr.pred(spark, sf)
    return checks.item_coverage(frame.where("prod_name <> 'PROMO'"), frame.where("label = 1"), ["LARGE", "MEDIUM", "SMALL", "ECONOMY", "PROMO", "EXTRA"])


def prediction_checks(spark, sf):
    ranked = m.rank_within_query(fr.pred(spark, sf), pos="rank")
    return checks.prediction_checks(ranked.where("NOT (cust_id = 7 AND prod_name = 'PROMO')"), 6)


def scored_checks(spark, sf):
    frame = fr.pred(spark, sf)
    return checks.scored_checks(frame.unionByName(frame.where("cust_id < 5")), ["LARGE", "MEDIUM", "SMALL", "ECONOMY", "PROMO"], 1000)


def observed_checks(spark, sf):
    """What the job that writes ranked predictions saw of them: some rows are missing, some come twice, some items are not declared."""
    frame = fr.pred(spark, sf).where("NOT (cust_id = 7 AND prod_name = 'PROMO')")
    ranked = m.rank_within_query(frame.unionByName(frame.where("cust_id < 5")), pos="rank")
    seen, observation = checks.observed(ranked, ["LARGE", "MEDIUM", "SMALL", "ECONOMY", "PROMO", "OTHER"])
    tables.write_versioned(seen.withColumn("snap_date", F.col("snap_date").cast("string")), tables.fresh_path(spark, "observed"), {"version": "v1"}, ["snap_date"])
    found = observation.get
    return spark.createDataFrame([tuple(found.values())], ", ".join(f"{c} long" for c in found))


def rank_order_violations(spark, sf):
    """Ranks of the raw score, against a score that a few customers' rows changed."""
    ranked = m.rank_within_query(fr.pred(spark, sf), pos="rank")
    moved = ranked.withColumn("score", F.when((F.col("cust_id") % 50 == 0) & (F.col("prod_name") == "PROMO"), 2.0).otherwise(F.col("score")))
    return checks.rank_order_violations(moved).select(*KEYS, "rank")


def plan_partitions(spark, sf):
    orders = fr.table(spark, sf, "orders").select(F.trunc("o_orderdate", "year").alias("snap_date"), "o_orderstatus")
    wanted = orders.where("o_orderstatus <> 'P' OR snap_date < DATE'1999-01-01'")
    existing = orders.where("snap_date > DATE'1996-01-01' AND o_orderstatus <> 'O'")
    return partitions.plan_partitions(wanted, existing, ["snap_date", "o_orderstatus"], orders.where("snap_date = DATE'1997-01-01'"))


def populated_buckets(spark, sf):
    from ..operators.sampling import entity_bucket

    frame = entity_bucket(fr.pred(spark, sf), 6, hash="md5")
    return partitions.populated_buckets(frame, "snap_date").select("snap_date", F.array_join("buckets", ",").alias("buckets"))


def write_versioned_roundtrip(spark, sf):
    """Two writes of versioned partitions; the second replaces one date and adds a column."""
    path = tables.fresh_path(spark, "versioned")
    frame = features(spark, sf).withColumn("snap_date", F.col("snap_date").cast("string")).drop("priority")
    tables.write_versioned(frame.where("snap_date < '1998-01-01'"), path, {"version": "v1"}, ["snap_date"])
    tables.write_versioned(frame.where("snap_date >= '1999-01-01'"), path, {"version": "v2"}, ["snap_date"])
    again = frame.where("snap_date = '1996-01-01' AND cust_id % 2 = 0").withColumn("total_price", F.col("total_price") + 1)
    tables.write_versioned(again, path, {"version": "v1"}, ["snap_date"])
    back = tables.read_versioned(spark, path, {"version": "v1"})
    return rounded(back.select(F.to_date("snap_date").alias("snap_date"), "cust_id", "n_orders", "total_price"), 2)


def evolve_schema_roundtrip(spark, sf):
    """A frame without one of the table's columns and with a new one, written next to the old rows."""
    path = tables.fresh_path(spark, "evolved")
    frame = features(spark, sf).withColumn("snap_date", F.col("snap_date").cast("string"))
    tables.write_versioned(frame.where("snap_date = '1996-01-01'"), path, {"version": "v1"}, ["snap_date"])
    later = frame.where("snap_date = '1997-01-01'").drop("priority").withColumn("half", F.col("n_orders") / 2)
    tables.write_versioned(later, path, {"version": "v1"}, ["snap_date"])
    back = tables.read_versioned(spark, path, {"version": "v1"})
    return back.select(F.to_date("snap_date").alias("snap_date"), "cust_id", "n_orders", "priority", "half")


def partition_report(spark, sf):
    """Partitions that the second of two writes added, from listings alone."""
    path = tables.fresh_path(spark, "reported")
    frame = features(spark, sf).withColumn("snap_date", F.col("snap_date").cast("string"))
    tables.write_versioned(frame.where("snap_date < '1997-01-01'"), path, {"version": "v1"}, ["snap_date"])
    before = tables.list_partitions(spark, path, ["snap_date"], {"version": "v1"})
    tables.write_versioned(frame.where("snap_date > '1995-06-01' AND snap_date < '1999-01-01'"), path, {"version": "v1"}, ["snap_date"])
    return tables.partition_report(before, tables.list_partitions(spark, path, ["snap_date"], {"version": "v1"}))


def template_query(spark, sf):
    fr.table(spark, sf, "orders").createOrReplaceTempView("template_orders")
    return tables.template_sql(spark, "-- orders of a day\nSELECT o_orderkey, o_custkey FROM IDENTIFIER(:source) WHERE to_date(o_orderdate) = to_date(:d)", source="template_orders", d=D)


def stratum_profile(spark, sf):
    return profile.stratum_profile(with_segment(spark, sf), ["segment", "prod_name"])


def ratio_surface(spark, sf):
    return rounded(profile.ratio_surface(stratum_profile(spark, sf), 0.4))


def weight_surface(spark, sf):
    return rounded(profile.weight_surface(profile.ratio_surface(stratum_profile(spark, sf), 0.4), 0.3, 0.5))


def row_weights(spark, sf):
    """Composite weights with a default of 1."""
    return joins.override_join(with_segment(spark, sf), ["segment", "prod_name"], {"BUILDING|PROMO": 2.0, "MACHINERY|SMALL": 0.5, "NOWHERE|X": 9.0}, 1.0, "weight").select(*KEYS, "weight")


def column_profile(spark, sf):
    return profile.column_profile(fr.table(spark, sf, "orders"))


SKETCHED = ["l_quantity", "l_extendedprice", "l_tax", "l_shipmode", "l_partkey"]


def merged_profile(spark, sf):
    """Line items' columns from sketches a ship year, stored in two updates of which the second reads new years alone, and whether they are as near to the data as stated."""
    lines = fr.table(spark, sf, "lineitem").withColumn("l_tax", F.when(F.col("l_tax") > 0.01, F.col("l_tax"))).withColumn("l_shipmode", F.concat("l_returnflag", "l_linestatus"))
    dated = lines.withColumn("yr", F.year("l_shipdate"))
    path = tables.fresh_path(spark, "sketches")
    profiles.update_sketches(spark, path, dated.where("yr < 1996"), "yr", SKETCHED)
    profiles.update_sketches(spark, path, dated, "yr", SKETCHED)
    found = profiles.read_profile(spark, path)
    near = sketches.within(found, lines)
    return rounded(found.join(near, "column").select("column", "kind", "rows", "null_rate", "mean", "std", "low", "high", "distinct_within", "ranks_within"), 4)


def merged_box_stats(spark, sf):
    """Scores by item and label from sketches a date: counts and ranges."""
    path = tables.fresh_path(spark, "boxes")
    profiles.update_sketches(spark, path, fr.pred(spark, sf).withColumn("snap_date", F.col("snap_date").cast("string")), "snap_date", ["score"], ["prod_name", "label"])
    found = profiles.read_profile(spark, path, keep=["prod_name", "label"])
    inside = F.col("p25").between(F.col("low"), F.col("p50")) & F.col("p75").between(F.col("p50"), F.col("high"))
    return rounded(found.select("prod_name", "label", "rows", "mean", "std", "low", "high", inside.alias("ordered")))


def feature_statistics(spark, sf):
    own = fr.table(spark, sf, "lineitem").select("l_quantity", F.when(F.col("l_tax") > 0.05, F.col("l_tax")).alias("l_tax"), "l_discount")
    return rounded(profile.feature_statistics(own, ["l_quantity", "l_tax", "l_discount"]), 4)


def entity_statistics(spark, sf):
    return rounded(presence.item_entity_statistics(fr.pred(spark, sf)))


def segment_entity_statistics(spark, sf):
    return rounded(presence.segment_entity_statistics(with_segment(spark, sf), "segment"))


def _attributions(spark, sf):
    frame = fr.pred(spark, sf).join(features(spark, sf), ["snap_date", "cust_id"], "left")
    return attribution.linear_attributions(frame, {"n_orders": 0.5, "total_price": -0.00001, "score": 2.0}, KEYS)


def linear_attributions(spark, sf):
    return rounded(_attributions(spark, sf), 5)


def signed_profile(spark, sf):
    return rounded(attribution.signed_profile(_attributions(spark, sf), ["prod_name"], 2), 5)


def profile_divergence(spark, sf):
    return rounded(attribution.profile_divergence(_attributions(spark, sf), ["snap_date"], 1))


def margin_decomposition(spark, sf):
    return rounded(attribution.margin_decomposition(_attributions(spark, sf), "PROMO", "SMALL"), 5)


def score_summary(spark, sf):
    return rounded(attribution.score_summary(fr.pred(spark, sf)))


PATTERN = "[0-9]{3}[0-9]+"


def mask_identifiers(spark, sf):
    docs = fr.table(spark, sf, "documents")
    return docs.select("doc_id", F.md5(text_mask.mask_identifiers(F.col("text"), PATTERN, 0).cast("binary")).alias("masked_md5"))


def residual_scan(spark, sf):
    docs = fr.table(spark, sf, "documents").withColumn("masked", text_mask.mask_identifiers(F.col("text"), PATTERN, 3))
    before = text_mask.residual_scan(docs, "text", {"digits": PATTERN, "mail": "@[a-z]"}).withColumn("column", F.lit("text"))
    return before.unionByName(text_mask.residual_scan(docs, "masked", {"digits": PATTERN, "mail": "@[a-z]"}).withColumn("column", F.lit("masked")))


QUERIES = {f.__name__: f for f in (
    feature_balances, feature_card, feature_savings, feature_info, feature_concat, label_family, label_table, sample_pool, inference_population, partition_quality,
    source_freshness, schema_drift, schema_checks, item_coverage, prediction_checks, scored_checks, observed_checks, rank_order_violations, plan_partitions, populated_buckets,
    write_versioned_roundtrip, evolve_schema_roundtrip, partition_report, template_query, stratum_profile, ratio_surface, weight_surface, row_weights, column_profile, merged_profile, merged_box_stats,
    feature_statistics, entity_statistics, segment_entity_statistics, linear_attributions, signed_profile, profile_divergence, margin_decomposition, score_summary,
    mask_identifiers, residual_scan)}

_P = f"WITH {fr.PRED}"
_PSEG = f"{_P}, ps AS (SELECT pred.*, segment FROM pred LEFT JOIN seg USING (cust_id))"
_FEAT = "feat AS (SELECT date_trunc('year', o_orderdate)::DATE AS snap_date, o_custkey AS cust_id, count(*) AS n_orders, round(sum(o_totalprice), 2) AS total_price, max(o_orderpriority) AS priority FROM orders GROUP BY ALL)"
_BAL = f"SELECT DATE '{D}' AS snap_date, c_custkey AS cust_id, coalesce(c_acctbal, 0) AS balance FROM customer"
_CARD = f"SELECT DATE '{D}' AS snap_date, o_custkey AS cust_id, sum(o_totalprice) AS spend, sum(CASE WHEN o_orderstatus = 'F' THEN o_totalprice ELSE 0 END) AS spend_done, max((o_orderpriority = '1-URGENT')::INT) AS urgent, CASE WHEN sum(o_totalprice) > 0 THEN sum(CASE WHEN o_orderstatus = 'F' THEN o_totalprice ELSE 0 END) / sum(o_totalprice) END AS done_ratio, count(DISTINCT o_orderdate::DATE) AS days FROM orders WHERE o_orderdate::DATE > DATE '{D}' - 30 AND o_orderdate::DATE <= DATE '{D}' GROUP BY o_custkey"
_SAV = f"SELECT DATE '{DE}' AS snap_date, user_id AS cust_id, sum(CASE WHEN event_type = 'purchase' THEN value ELSE 0 END) AS amount_in, sum(CASE WHEN event_type <> 'purchase' THEN value ELSE 0 END) AS amount_out, sum((event_type = 'purchase')::INT)::BIGINT AS n_in FROM events WHERE ts::DATE >= (DATE '{DE}' - INTERVAL 1 MONTH)::DATE AND ts::DATE < DATE '{DE}' GROUP BY user_id"
_BUY = "bought AS (SELECT o_custkey AS cust_id, o_orderdate::DATE AS day, p_type AS item FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey)"


def _family(items) -> str:
    names = ", ".join(f"'{i}'" for i in items)
    return f"""SELECT DATE '{D}' AS snap_date, g.cust_id, g.prod_name, CASE WHEN o.cust_id IS NULL THEN 0 ELSE 1 END AS label, apply_start_date, apply_end_date
FROM (SELECT DISTINCT cust_id, unnest([{names}]) AS prod_name FROM bought WHERE day > DATE '{D}' AND day <= DATE '{D}' + 30 AND item IN ({names})) g
LEFT JOIN (SELECT cust_id, item, min(day) AS apply_start_date, max(day) AS apply_end_date FROM bought WHERE day > DATE '{D}' AND day <= DATE '{D}' + 30 GROUP BY ALL) o ON o.cust_id = g.cust_id AND o.item = g.prod_name"""


_LABELS = f"{_family(SIZED)} UNION ALL {_family(REST)}"
_RK = f"{_P}, r AS (SELECT *, (row_number() OVER (PARTITION BY snap_date, cust_id ORDER BY score DESC, prod_name))::INT AS rank FROM pred)"
_STR = f"{_PSEG}, st AS (SELECT segment, prod_name, sum(label)::BIGINT AS n_pos, sum(1 - label)::BIGINT AS n_neg FROM ps GROUP BY ALL)"
_RAT = f"{_STR}, rt AS (SELECT *, CASE WHEN n_pos = 0 THEN 1.0 ELSE least(greatest(coalesce(0.4::DOUBLE * n_pos / nullif(n_neg, 0), 1.0), 0.0), 1.0) END AS ratio FROM st), rs AS (SELECT *, n_neg * ratio AS kept_neg, n_pos / nullif(n_pos + n_neg * ratio, 0) AS new_rate FROM rt)"
_ATT = f"""{_P}, {_FEAT}, j AS (SELECT pred.*, n_orders, total_price FROM pred LEFT JOIN feat USING (snap_date, cust_id)),
mean AS (SELECT avg(n_orders) AS a, avg(total_price) AS b, avg(score) AS c FROM j),
att AS (SELECT snap_date, cust_id, prod_name, 'n_orders' AS feature, 0.5::DOUBLE * (n_orders - a) AS value FROM j, mean UNION ALL
  SELECT snap_date, cust_id, prod_name, 'total_price', -0.00001::DOUBLE * (total_price - b) FROM j, mean UNION ALL SELECT snap_date, cust_id, prod_name, 'score', 2.0::DOUBLE * (score - c) FROM j, mean),
sp AS (SELECT *, row_number() OVER (PARTITION BY prod_name ORDER BY mean_abs DESC, feature) AS place FROM (SELECT prod_name, feature, avg(abs(value)) AS mean_abs, avg(value) AS mean_signed FROM att GROUP BY ALL)),
dv AS (SELECT snap_date, feature, row_number() OVER (PARTITION BY snap_date ORDER BY avg(abs(value)) DESC, feature) AS place FROM att GROUP BY snap_date, feature),
gl AS (SELECT feature, row_number() OVER (ORDER BY avg(abs(value)) DESC, feature) AS place FROM att GROUP BY feature)"""
_VER = "SELECT snap_date, cust_id, n_orders, total_price FROM feat WHERE snap_date < DATE '1998-01-01' AND snap_date <> DATE '1996-01-01' UNION ALL SELECT snap_date, cust_id, n_orders, total_price + 1 FROM feat WHERE snap_date = DATE '1996-01-01' AND cust_id % 2 = 0"


def _stat(c: str, e: str) -> str:
    return f"SELECT '{c}' AS \"column\", round(1 - count({e}) / count(*), 4) AS null_rate, count(DISTINCT {e}) AS distinct, count(DISTINCT {e}) <= 1 AS single_value, (1 - count({e}) / count(*)) > 0.5 AS high_null, round(avg({e}), 4) AS mean, round(stddev_samp({e}), 4) AS std, round(min({e}), 4) AS min, round(max({e}), 4) AS max FROM lineitem"


_MASK = f"list_reduce(list_prepend('', list_transform(range(1, len(g) + 1), lambda i: g[i] || coalesce(repeat('*', length(f[i]) - {{keep}}), ''))), lambda a, b: a || b)"
_HAVE = "WITH have AS (SELECT column_name AS c, CASE column_type WHEN 'BIGINT' THEN 'bigint' WHEN 'DOUBLE' THEN 'double' WHEN 'VARCHAR' THEN 'string' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' ELSE lower(column_type) END AS t FROM (DESCRIBE orders))"
ORACLE_SQL = {
    "schema_drift": f"{_HAVE}, want(c, t) AS (VALUES ('o_orderkey', 'bigint'), ('o_custkey', 'int'), ('o_gone', 'string'), ('o_orderdate', 'timestamp_ntz')) SELECT c AS \"column\", CASE WHEN have.t IS NULL THEN 'missing' ELSE have.t || ' is not ' || want.t END AS problem FROM want LEFT JOIN have USING (c) WHERE have.t IS DISTINCT FROM want.t UNION ALL SELECT c, 'new' FROM have WHERE c NOT IN (SELECT c FROM want)",
    "schema_checks": f"{_HAVE}, cat(c) AS (VALUES ('o_totalprice'), ('o_orderstatus')), feat(c) AS (VALUES ('o_totalprice'), ('o_orderpriority'), ('o_custkey')) SELECT c AS \"column\", 'categorical of type ' || t AS problem FROM cat JOIN have USING (c) WHERE t = 'double' UNION ALL SELECT c, 'feature of type ' || t FROM feat JOIN have USING (c) WHERE c NOT IN (SELECT c FROM cat) AND t NOT IN ('double', 'bigint', 'int') UNION ALL SELECT c, 'carried and a feature' FROM feat WHERE c IN ('o_custkey', 'o_orderkey')",
    "feature_balances": _BAL,
    "feature_card": f"WITH c AS ({_CARD}) SELECT snap_date, cust_id, round(spend, 4) AS spend, round(spend_done, 4) AS spend_done, urgent, round(done_ratio, 4) AS done_ratio, days FROM c",
    "feature_savings": f"WITH s AS ({_SAV}) SELECT snap_date, cust_id, round(amount_in, 4) AS amount_in, round(amount_out, 4) AS amount_out, n_in FROM s",
    "feature_info": f"SELECT DATE '{D}' AS snap_date, c_custkey AS cust_id, c_mktsegment AS segment, n_name AS nation FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey",
    "feature_concat": f"WITH b AS ({_BAL}), c AS ({_CARD}), s AS ({_SAV}), k AS (SELECT cust_id FROM b UNION SELECT cust_id FROM c UNION SELECT cust_id FROM s) SELECT DATE '{D}' AS snap_date, cust_id, round(balance, 4) AS balance, round(spend, 4) AS spend, round(spend_done, 4) AS spend_done, urgent, round(done_ratio, 4) AS done_ratio, days, round(amount_in, 4) AS amount_in, round(amount_out, 4) AS amount_out, n_in, round(CASE WHEN amount_out IS NULL OR amount_out < 0 THEN NULL WHEN amount_out = 0 THEN 0 ELSE amount_in / amount_out END, 4) AS flow_ratio FROM k LEFT JOIN b USING (cust_id) LEFT JOIN c USING (cust_id) LEFT JOIN s USING (cust_id)",
    "label_family": f"WITH {_BUY} {_family(SIZED)}",
    "label_table": f"WITH {_BUY} {_LABELS}",
    "sample_pool": f"WITH {_BUY}, l AS ({_LABELS}), i AS (SELECT unnest(['LARGE','MEDIUM','SMALL','ECONOMY','PROMO','STANDARD']) AS prod_name) SELECT DATE '{D}' AS snap_date, c_custkey AS cust_id, i.prod_name, coalesce(label, 0) AS label, c_mktsegment AS segment FROM customer CROSS JOIN i LEFT JOIN l ON l.cust_id = c_custkey AND l.prod_name = i.prod_name",
    "inference_population": f"WITH {_FEAT} SELECT DISTINCT snap_date, cust_id FROM feat",
    "partition_quality": "WITH l AS (SELECT l_shipdate::DATE AS day, l_suppkey, l_partkey, CASE WHEN l_tax > 0.05 THEN l_tax END AS l_tax FROM lineitem) SELECT day, count(*) AS rows, round(1 - count(DISTINCT CASE WHEN l_tax IS NOT NULL THEN (l_suppkey, l_tax) END) / count(*), 6) AS duplicate_ratio, round(sum((l_tax IS NULL)::INT) / (count(*) * 4), 6) AS null_ratio FROM l GROUP BY day",
    "source_freshness": "WITH d AS (SELECT unnest([DATE '1998-06-15', DATE '1998-06-16', DATE '2024-01-01']) AS date) SELECT d.date, count(o_orderkey) AS rows, count(o_orderkey) >= 5 AS ok FROM d LEFT JOIN orders ON o_orderdate::DATE = d.date GROUP BY 1",
    "item_coverage": "SELECT 'EXTRA' AS item, 'declared, not in pool' AS problem UNION ALL SELECT 'PROMO', 'declared, not in pool' UNION ALL SELECT DISTINCT p_type, 'in pool, not declared' FROM part WHERE p_type = 'STANDARD' UNION ALL SELECT DISTINCT p_type, 'in labels, not declared' FROM part WHERE p_type = 'STANDARD'",
    "prediction_checks": f"{_RK}, q AS (SELECT count(*) AS n, min(score) AS lo, max(score) AS hi, min(rank) AS r0, max(rank) AS r1 FROM r WHERE NOT (cust_id = 7 AND prod_name = 'PROMO') GROUP BY snap_date, cust_id) SELECT count(*) AS queries, sum((n <> 6)::INT)::BIGINT AS incomplete, sum((lo = hi AND n > 1)::INT)::BIGINT AS constant, min(r0) AS min_rank, max(r1) AS max_rank FROM q",
    "scored_checks": f"{_P}, u AS (SELECT * FROM pred UNION ALL SELECT * FROM pred WHERE cust_id < 5) SELECT 'nulls' AS \"check\", 0::BIGINT AS failures UNION ALL SELECT 'unknown_items', sum((prod_name = 'STANDARD')::INT)::BIGINT FROM u UNION ALL SELECT 'row_difference', count(*) - 1000 FROM u UNION ALL SELECT 'repeated', count(*) FROM (SELECT 1 FROM u GROUP BY snap_date, cust_id, prod_name HAVING count(*) > 1)",
    "observed_checks": f"""{_P}, f AS (SELECT * FROM pred WHERE NOT (cust_id = 7 AND prod_name = 'PROMO')), u AS (SELECT * FROM f UNION ALL SELECT * FROM f WHERE cust_id < 5),
q AS (SELECT count(*) AS n, count(DISTINCT prod_name) AS items, min(score) AS lo, max(score) AS hi FROM u GROUP BY snap_date, cust_id)
SELECT (SELECT count(*) FROM u) AS rows, 0::BIGINT AS nulls, (SELECT count(*) FROM u WHERE prod_name = 'STANDARD') AS unknown_items, count(*) AS queries, sum((n <> 6)::INT)::BIGINT AS incomplete,
  sum((lo = hi AND n > 1)::INT)::BIGINT AS constant, sum(n - items)::BIGINT AS repeated, 0::BIGINT AS rank_order FROM q""",
    "rank_order_violations": f"{_RK}, v AS (SELECT snap_date, cust_id, prod_name, rank, CASE WHEN cust_id % 50 = 0 AND prod_name = 'PROMO' THEN 2.0 ELSE score END AS s FROM r) SELECT snap_date, cust_id, prod_name, rank FROM v QUALIFY s > lag(s) OVER (PARTITION BY snap_date, cust_id ORDER BY rank)",
    "plan_partitions": "WITH o AS (SELECT DISTINCT date_trunc('year', o_orderdate)::DATE AS snap_date, o_orderstatus FROM orders), w AS (SELECT *, 1 AS w FROM o WHERE o_orderstatus <> 'P' OR snap_date < DATE '1999-01-01'), e AS (SELECT *, 1 AS e FROM o WHERE snap_date > DATE '1996-01-01' AND o_orderstatus <> 'O') SELECT snap_date, o_orderstatus, CASE WHEN w IS NULL THEN 'surplus' WHEN e IS NULL THEN 'process' WHEN snap_date = DATE '1997-01-01' THEN 'rebuild' ELSE 'skip' END AS status FROM w FULL JOIN e USING (snap_date, o_orderstatus)",
    "populated_buckets": f"{_P} SELECT snap_date, string_agg(DISTINCT b, ',' ORDER BY b) AS buckets FROM (SELECT snap_date, (('0x' || substr(md5(cust_id || '|bucket|0'), 1, 8))::BIGINT % 6)::VARCHAR AS b FROM pred) GROUP BY 1",
    "write_versioned_roundtrip": f"WITH {_FEAT} SELECT snap_date, cust_id, n_orders, round(total_price, 2) AS total_price FROM ({_VER})",
    "evolve_schema_roundtrip": f"WITH {_FEAT} SELECT snap_date, cust_id, n_orders, priority, NULL::DOUBLE AS half FROM feat WHERE snap_date = DATE '1996-01-01' UNION ALL SELECT snap_date, cust_id, n_orders, NULL, n_orders / 2 FROM feat WHERE snap_date = DATE '1997-01-01'",
    "partition_report": f"WITH {_FEAT} SELECT DISTINCT snap_date::VARCHAR AS snap_date FROM feat WHERE snap_date IN (DATE '1997-01-01', DATE '1998-01-01')",
    "template_query": f"SELECT o_orderkey, o_custkey FROM orders WHERE o_orderdate::DATE = DATE '{D}'",
    "stratum_profile": f"{_STR} SELECT * FROM st",
    "ratio_surface": f"{_RAT} SELECT segment, prod_name, n_pos, n_neg, round(ratio, 6) AS ratio, round(kept_neg, 6) AS kept_neg, round(new_rate, 6) AS new_rate FROM rs",
    "weight_surface": f"{_RAT}, w AS (SELECT *, coalesce(n_pos * 0.7::DOUBLE / nullif(0.3::DOUBLE * kept_neg, 0), 1.0) AS fl FROM rs), ms AS (SELECT *, n_pos + fl * kept_neg AS mass FROM w), a AS (SELECT *, CASE WHEN mass > 0 THEN pow(min(CASE WHEN mass > 0 THEN mass END) OVER () / mass, 0.5) ELSE 1.0 END AS att FROM ms) SELECT segment, prod_name, n_pos, n_neg, round(ratio, 6) AS ratio, round(kept_neg, 6) AS kept_neg, round(new_rate, 6) AS new_rate, round(fl, 6) AS floor, round(mass, 6) AS mass, round(att, 6) AS attention, round(att, 6) AS w_pos, round(att * fl, 6) AS w_neg FROM a",
    "merged_profile": "WITH l AS (SELECT l_quantity, l_extendedprice, CASE WHEN l_tax > 0.01 THEN l_tax END AS l_tax, l_returnflag || l_linestatus AS l_shipmode, l_partkey FROM lineitem) "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", '{k}' AS kind, count(*) AS rows, round(1 - count({c}) / count(*), 4) + 0.0 AS null_rate, {x('avg')} AS mean, {x('stddev_samp')} AS std, {x('min')} AS low, {x('max')} AS high, true AS distinct_within, true AS ranks_within FROM l"
        for c, k in (("l_quantity", "double"), ("l_extendedprice", "double"), ("l_tax", "double"), ("l_shipmode", "string"), ("l_partkey", "bigint"))
        for x in [lambda f, c=c, k=k: "NULL::DOUBLE" if k == "string" else f"round({f}({c})::DOUBLE, 4)"]
    ),
    "merged_box_stats": f"{_P} SELECT prod_name, label, count(*) AS rows, round(avg(score), 6) AS mean, round(stddev_samp(score), 6) AS std, round(min(score), 6) + 0.0 AS low, round(max(score), 6) + 0.0 AS high, true AS ordered FROM pred GROUP BY ALL",
    "row_weights": f"{_PSEG} SELECT snap_date, cust_id, prod_name, (CASE segment || '|' || prod_name WHEN 'BUILDING|PROMO' THEN 2.0 WHEN 'MACHINERY|SMALL' THEN 0.5 ELSE 1.0 END)::DOUBLE AS weight FROM ps",
    "feature_statistics": " UNION ALL ".join([_stat("l_quantity", "l_quantity"), _stat("l_tax", "(CASE WHEN l_tax > 0.05 THEN l_tax END)"), _stat("l_discount", "l_discount")]),
    "entity_statistics": f"{_P}, e AS (SELECT prod_name, cust_id, max(label) AS a, sum(label) AS n FROM pred GROUP BY ALL) SELECT prod_name, sum(a)::BIGINT AS positive_entities, (count(*) - sum(a))::BIGINT AS negative_entities, count(*) AS entities, round(sum(a) / count(*), 6) AS positive_rate, round(sum(n) / nullif(sum(a), 0), 6) AS positives_per_entity FROM e GROUP BY 1",
    "segment_entity_statistics": f"{_PSEG}, e AS (SELECT segment, cust_id, max(label) AS a FROM ps GROUP BY ALL) SELECT segment, count(*) AS entities, sum(a)::BIGINT AS positive_entities, round(avg(a), 6) AS positive_rate FROM e GROUP BY 1",
    "linear_attributions": f"{_ATT} SELECT snap_date, cust_id, prod_name, feature, round(value, 5) AS value FROM att",
    "signed_profile": f"{_ATT} SELECT prod_name, feature, round(mean_abs, 5) AS mean_abs, round(mean_signed, 5) AS mean_signed, place::INT AS place FROM sp WHERE place <= 2",
    "profile_divergence": f"{_ATT} SELECT dv.snap_date, (CASE WHEN dv.feature = gl.feature THEN 1.0 ELSE 0.0 END)::DOUBLE AS jaccard, CASE WHEN dv.feature = gl.feature THEN '' ELSE dv.feature END AS idiosyncratic FROM dv, gl WHERE dv.place = 1 AND gl.place = 1",
    "margin_decomposition": f"{_ATT} SELECT a.feature, round(avg(a.value - b.value), 5) AS mean_difference, count(*) AS queries FROM att a JOIN att b ON a.snap_date = b.snap_date AND a.cust_id = b.cust_id AND a.feature = b.feature AND a.prod_name = 'PROMO' AND b.prod_name = 'SMALL' GROUP BY 1",
    "score_summary": f"{_P} SELECT prod_name, round(min(score), 6) AS min, round(max(score), 6) AS max, round(avg(score), 6) AS mean, max(label) = 1 AS has_positive FROM pred GROUP BY 1",
    "mask_identifiers": f"WITH x AS (SELECT doc_id, regexp_split_to_array(text, '{PATTERN}') AS g, regexp_extract_all(text, '{PATTERN}') AS f FROM documents) SELECT doc_id, md5({_MASK.format(keep=0)}) AS masked_md5 FROM x",
    "residual_scan": f"SELECT 'digits' AS name, count(*) FILTER (n > 0) AS rows, sum(n)::BIGINT AS hits, 'text' AS \"column\" FROM (SELECT len(regexp_extract_all(text, '{PATTERN}')) AS n FROM documents) UNION ALL SELECT 'mail', count(*) FILTER (n > 0), sum(n)::BIGINT, 'text' FROM (SELECT len(regexp_extract_all(text, '@[a-z]')) AS n FROM documents) UNION ALL SELECT 'digits', 0, 0, 'masked' UNION ALL SELECT 'mail', count(*) FILTER (n > 0), sum(n)::BIGINT, 'masked' FROM (SELECT len(regexp_extract_all(text, '@[a-z]')) AS n FROM documents)",
}
