"""Registered queries over baselines, comparison, distributions and diagnosis."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import frames as fr
from ..operators import ability, baseline, bootstrap, compare, diagnostics, query_arrays, shift, suppression
from ..operators import metrics as m
from ..sources import tables
from .metric_queries import rounded, with_segment

KEYS = ["snap_date", "cust_id", "prod_name"]
SNAPS = ["1996-01-01", "1998-01-01", "1990-01-01"]


def daily_labels(spark, sf):
    """Purchases of part types, by order date."""
    orders = fr.table(spark, sf, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("snap_date"))
    lines = fr.table(spark, sf, "lineitem").select("l_orderkey", "l_partkey")
    parts = fr.table(spark, sf, "part").select("p_partkey", F.col("p_type").alias("prod_name"))
    joined = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).join(parts, F.col("l_partkey") == F.col("p_partkey"))
    return joined.select("snap_date", "prod_name", F.lit(1).alias("label"))


def ranked(spark, sf):
    return m.rank_within_query(fr.pred(spark, sf), pos="rank")


def popularity_counts(spark, sf):
    return baseline.popularity_counts(daily_labels(spark, sf), SNAPS, 12)


def monthly_popularity(spark, sf):
    return baseline.monthly_popularity(daily_labels(spark, sf), SNAPS, 3)


def baseline_bundle(spark, sf):
    frame = fr.pred(spark, sf).where("snap_date = DATE'1998-01-01'")
    scored = baseline.baseline_frame(frame, baseline.popularity_counts(daily_labels(spark, sf), ["1998-01-01"], 12))
    return rounded(m.overall_metrics(m.per_query_metrics(m.enrich(scored, [3]), [3]), [3]))


def _sides(frame):
    """Two sources that share some customers and items."""
    a = frame.where("cust_id % 3 <> 0 AND prod_name <> 'PROMO'")
    b = frame.where("cust_id % 4 <> 0 AND prod_name <> 'SMALL'").select(*KEYS, (1 - F.col("score")).alias("score"))
    return a.select(*KEYS, "score", "label"), b


def common_universe(spark, sf):
    a, b = _sides(fr.pred(spark, sf))
    return compare.common_universe(a, b, ["prod_name"])


def restrict_to_common(spark, sf):
    frame = tables.staged(fr.pred(spark, sf), "restricted")
    a, b = compare.restrict_to_common(*_sides(frame), frame.where("label = 1"))
    cols = [*KEYS, "label", "rank", "side"]
    return a.withColumn("side", F.lit("a")).select(*cols).unionByName(b.withColumn("side", F.lit("b")).select(*cols))


def comparison_delta(spark, sf):
    frame = tables.staged(fr.pred(spark, sf), "compared")  # both sides and the labels come from it
    found = query_arrays.comparison(*_sides(frame), frame, [3])
    return rounded(found.where("level = 'overall' AND metric IN ('map@3', 'ndcg@3') OR metric = 'map_attr@3'").withColumn("metric", F.regexp_replace("metric", "@3", "")))


def comparison_coverage(spark, sf):
    return compare.comparison_coverage(*_sides(fr.pred(spark, sf)))


def external_predictions(spark, sf):
    raw = fr.pred(spark, sf).select(F.col("snap_date").alias("d"), F.col("cust_id").alias("c"), F.col("prod_name").alias("p"), F.col("score").alias("s"))
    mapping = fr.categories(spark, sf).where("prod_name <> 'PROMO'").select(F.col("prod_name").alias("source"), F.col("category").alias("item"))
    return rounded(compare.external_predictions(raw, {"d": "snap_date", "c": "cust_id", "p": "prod_name", "s": "score"}, mapping, "1997-01-01"))


def score_histogram(spark, sf):
    return rounded(diagnostics.score_histogram(fr.pred(spark, sf), 10))


def box_stats(spark, sf):
    return rounded(diagnostics.box_stats(fr.pred(spark, sf), accuracy=1_000_000))


def rank_counts(spark, sf):
    return diagnostics.rank_counts(ranked(spark, sf), 6)


def positive_rank_counts(spark, sf):
    return diagnostics.positive_rank_counts(ranked(spark, sf), 6)


def positive_rate(spark, sf):
    return rounded(diagnostics.positive_rate(ranked(spark, sf)))


def item_share_by_rank(spark, sf):
    return rounded(diagnostics.item_share_by_rank(ranked(spark, sf)))


def calibration_bins(spark, sf):
    return rounded(diagnostics.calibration_bins(fr.pred(spark, sf), 10))


def query_centering(spark, sf):
    return rounded(ability.query_centering(fr.pred(spark, sf)).select(*KEYS, "centered"))


def weighted_auc(spark, sf):
    frame = fr.pred(spark, sf).withColumn("w", 1 + F.pmod("cust_id", F.lit(3)).cast("double"))
    return rounded(ability.weighted_auc(frame, ["prod_name"], "score", "w"))


def item_ability(spark, sf):
    return rounded(ability.item_ability(fr.pred(spark, sf)))


def candidates_per_query(spark, sf):
    return ability.candidates_per_query(fr.pred(spark, sf).where("score > 0"))


def _pairs(spark, sf):
    return suppression.suppression_pairs(fr.pred(spark, sf))


def suppression_rows(spark, sf):
    return rounded(_pairs(spark, sf))


def suppression_pairs(spark, sf):
    return rounded(suppression.by_pair(_pairs(spark, sf)))


def suppression_by_target(spark, sf):
    return rounded(suppression.by_target(_pairs(spark, sf)))


def suppression_by_suppressor(spark, sf):
    return rounded(suppression.by_suppressor(_pairs(spark, sf)))


def suppression_examples(spark, sf):
    own = _pairs(spark, sf).withColumns({"gap": F.round("gap", 6), "raw": F.round("raw", 6), "margin": F.round("margin", 6)})
    return suppression.examples(own, 50)


def cross_purchase(spark, sf):
    return rounded(suppression.cross_purchase(fr.pred(spark, sf)))


RATIOS = {"BUILDING|PROMO|0": 0.5, "BUILDING|SMALL|0": 0.25, "MACHINERY|PROMO|0": 0.8}
WEIGHTS = {"BUILDING|LARGE|1": 2.0, "FURNITURE|PROMO|1": 1.5}


def config_offset(spark, sf):
    return rounded(shift.config_offset(with_segment(spark, sf), "segment", RATIOS, WEIGHTS))


def config_shift(spark, sf):
    frame = tables.staged(with_segment(spark, sf), "configured")
    offsets = tables.staged(shift.config_offset(frame, "segment", RATIOS, WEIGHTS), "offsets")  # a row a segment and item
    return rounded(shift.config_shift(frame, offsets, "segment", 3))


def exposure_share(spark, sf):
    return rounded(shift.exposure_share(fr.pred(spark, sf), 3))


def score_shift_grid(spark, sf):
    return rounded(shift.score_shift_grid(fr.pred(spark, sf), [("PROMO", 0.25), ("PROMO", -0.25), ("SMALL", 0.5)], 3))


def weighted_quantile(spark, sf):
    frame = fr.pred(spark, sf).withColumn("w", 1 + F.pmod("cust_id", F.lit(3)).cast("double"))
    return rounded(shift.weighted_quantile(frame, ["prod_name"], "score", "w", 0.8))


def bootstrap_item_ci(spark, sf):
    return rounded(bootstrap.bootstrap_item_ci(fr.pred(spark, sf), 3, 50))


def paired_bootstrap_delta(spark, sf):
    frame = with_segment(spark, sf).withColumn("moved", F.col("score") + F.when(F.col("prod_name") == "PROMO", 0.25).otherwise(0.0))
    return rounded(bootstrap.paired_bootstrap_delta(frame, "moved", 3, 50, "segment"))


def auc_ci(spark, sf):
    return rounded(bootstrap.auc_ci(fr.pred(spark, sf), 10))


QUERIES = {f.__name__: f for f in (
    popularity_counts, monthly_popularity, baseline_bundle, common_universe, restrict_to_common, comparison_delta, comparison_coverage, external_predictions,
    score_histogram, box_stats, rank_counts, positive_rank_counts, positive_rate, item_share_by_rank, calibration_bins, query_centering, weighted_auc, item_ability,
    candidates_per_query, suppression_rows, suppression_pairs, suppression_by_target, suppression_by_suppressor, suppression_examples, cross_purchase,
    config_offset, config_shift, exposure_share, score_shift_grid, weighted_quantile, bootstrap_item_ci, paired_bootstrap_delta, auc_ci)}

_P = f"WITH {fr.PRED}"
_W = f"{_P}, {fr.enriched_sql()}"
_PSEG = f"{_P}, ps AS (SELECT pred.*, segment FROM pred LEFT JOIN seg USING (cust_id))"
_DAILY = "daily AS (SELECT o_orderdate::DATE AS day, p_type AS prod_name, count(*) AS n FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey GROUP BY ALL), win AS (SELECT s AS snapshot, (s - to_months({n}))::DATE AS start FROM (SELECT unnest([DATE '1996-01-01', DATE '1998-01-01', DATE '1990-01-01']) AS s))"
_POP = f"{_DAILY.format(n=12)}, found AS (SELECT snapshot, prod_name, sum(n)::BIGINT AS count FROM win JOIN daily ON day >= start AND day < snapshot GROUP BY ALL)"
_RANKED = f"{_P}, r AS (SELECT *, row_number() OVER (PARTITION BY snap_date, cust_id ORDER BY score DESC, prod_name) AS rk FROM pred)"
_SIDES = f"""{_P}, a AS (SELECT snap_date, cust_id, prod_name, score, label FROM pred WHERE cust_id % 3 <> 0 AND prod_name <> 'PROMO'),
b AS (SELECT snap_date, cust_id, prod_name, 1 - score AS score FROM pred WHERE cust_id % 4 <> 0 AND prod_name <> 'SMALL'),
e AS (SELECT cust_id FROM a INTERSECT SELECT cust_id FROM b), i AS (SELECT prod_name FROM a INTERSECT SELECT prod_name FROM b),
ca AS (SELECT * FROM a WHERE cust_id IN (FROM e) AND prod_name IN (FROM i)),
cb AS (SELECT b.*, pred.label FROM b JOIN pred USING (snap_date, cust_id, prod_name) WHERE cust_id IN (FROM e) AND prod_name IN (FROM i))"""
_PAIRS = f"""{_P}, rk AS (SELECT *, row_number() OVER (PARTITION BY snap_date, cust_id ORDER BY score DESC, prod_name) AS pos FROM pred),
c AS (SELECT *, sum(label) OVER w AS cum, sum(label / pos) OVER w AS inv FROM rk WINDOW w AS (PARTITION BY snap_date, cust_id ORDER BY pos ROWS UNBOUNDED PRECEDING)),
pr AS (SELECT p.snap_date, p.cust_id, p.prod_name AS target, n.prod_name AS suppressor, n.score - p.score AS margin, 1 - p.cum / p.pos AS row_gap,
  (n.cum + 1) / n.pos - p.cum / p.pos + (p.inv - 1.0::DOUBLE / p.pos - n.inv) AS raw
  FROM c p JOIN c n ON p.snap_date = n.snap_date AND p.cust_id = n.cust_id AND p.label = 1 AND n.label = 0 AND n.pos < p.pos),
pairs AS (SELECT snap_date, cust_id, target, suppressor, margin, raw, CASE WHEN sum(raw) OVER w > 0 THEN row_gap * raw / sum(raw) OVER w ELSE 0 END AS gap FROM pr WINDOW w AS (PARTITION BY snap_date, cust_id, target))"""
_OFF = f"""{_PSEG}, grid AS (SELECT DISTINCT segment, prod_name FROM ps),
off AS (SELECT segment, prod_name, ln(1.0 / CASE segment || '|' || prod_name WHEN 'BUILDING|PROMO' THEN 0.5 WHEN 'BUILDING|SMALL' THEN 0.25 WHEN 'MACHINERY|PROMO' THEN 0.8 ELSE 1.0 END)
  + ln(CASE segment || '|' || prod_name WHEN 'BUILDING|LARGE' THEN 2.0 WHEN 'FURNITURE|PROMO' THEN 1.5 ELSE 1.0 END) AS o FROM grid)"""


def _variants(rows: str) -> str:
    """Macro AP by variant of ``rows(variant, snap_date, cust_id, prod_name, label, score)``."""
    return f"""vr AS (SELECT *, row_number() OVER (PARTITION BY variant, snap_date, cust_id ORDER BY score DESC, prod_name) AS pos FROM {rows}),
vc AS (SELECT *, sum(label) OVER (PARTITION BY variant, snap_date, cust_id ORDER BY pos ROWS UNBOUNDED PRECEDING) AS cum FROM vr),
vi AS (SELECT variant, prod_name, avg(CASE WHEN pos <= 3 THEN cum / pos ELSE 0 END) AS ap FROM vc WHERE label = 1 GROUP BY ALL),
vm AS (SELECT variant, avg(ap) AS macro_ap FROM vi GROUP BY 1)
SELECT variant, round(macro_ap, 6) AS macro_ap, round(macro_ap - (SELECT macro_ap FROM vm WHERE variant = 'base'), 6) + 0.0 AS delta FROM vm"""


def _pivot(where: str) -> str:
    cols = ", ".join(f"sum((rk = {i} AND {where})::INT)::BIGINT AS rank_{i}" for i in range(1, 7))
    return f"{_RANKED} SELECT prod_name, {cols} FROM r GROUP BY 1"


_WORD = "('0x' || substr(md5({key}), 1, 15))::BIGINT"


def _draws(units: str) -> str:
    """CTEs ``u(stratum, unit, i)`` and ``times(stratum, b, i, times)`` of the distinct ``units(stratum, unit)``: counts are halved down a tree by recursion, a toss of all draws left in each step."""
    heads = f"""coalesce(list_sum(list_transform(range(0, (c + 59) // 60), lambda w: bit_count({_WORD.format(key="concat_ws('|', 0, stratum, d, j, b, t, w)")} & ((1::BIGINT << least(60, c - 60 * w)::INT) - 1)))), 0)::BIGINT"""
    return f"""
u AS (SELECT stratum, unit, row_number() OVER (PARTITION BY stratum ORDER BY md5(unit), unit) - 1 AS i FROM {units}),
st AS (SELECT *, len(list_filter(range(0, 41), lambda x: 32 * (1::BIGINT << x::INT) < n))::INT AS depth FROM (SELECT stratum, count(*) AS n FROM {units} GROUP BY 1)),
walk(stratum, n, depth, b, d, j, c0, c, a, x, t) AS (
  SELECT stratum, n, depth, b, 0, 0::BIGINT, n, n, n // 2, 0::BIGINT, 0 FROM st, range({{replicates}}) r(b)
  UNION ALL SELECT stratum, n, depth, b, CASE WHEN done THEN d + 1 ELSE d END, CASE WHEN done THEN 2 * j + side ELSE j END,
    CASE WHEN NOT done THEN c0 WHEN side = 0 THEN x ELSE c0 - x END, CASE WHEN NOT done THEN CASE WHEN up THEN c - h ELSE h END WHEN side = 0 THEN x ELSE c0 - x END,
    CASE WHEN done THEN n * (4 * j + 2 * side + 1) // (1::BIGINT << (d + 2)) - n * (2 * j + side) // (1::BIGINT << (d + 1)) WHEN up THEN 2 * a - size ELSE 2 * a END,
    CASE WHEN done THEN 0 WHEN up THEN x + h ELSE x END, CASE WHEN done THEN 0 ELSE t + 1 END
  FROM (SELECT *, 2 * a >= size AS up, CASE WHEN done THEN 0 ELSE {heads} END AS h FROM
      (SELECT *, c = 0 OR a = 0 OR t > 61 AS done, n * (j + 1) // (1::BIGINT << d) - n * j // (1::BIGINT << d) AS size FROM walk WHERE d < depth)), (VALUES (0), (1)) s(side)
  WHERE side = 0 OR done),
leaf AS (SELECT stratum, j, b, n * j // (1::BIGINT << depth) AS lo, n * (j + 1) // (1::BIGINT << depth) - n * j // (1::BIGINT << depth) AS size, unnest(range(1, c0 + 1)) AS t FROM walk WHERE d = depth),
times AS (SELECT stratum, b, lo + {_WORD.format(key="concat_ws('|', 0, stratum, 'leaf', j, b, t)")} % size AS i, count(*) AS times FROM leaf GROUP BY ALL)"""


_R = "WITH RECURSIVE " + fr.PRED
_CI = "round(quantile_cont({v}, 0.025), 6) + 0.0 AS lo, round(quantile_cont({v}, 0.975), 6) + 0.0 AS hi, round(avg({v}), 6) + 0.0 AS mean"
_DLONG = "SELECT 'overall' AS level, 'all' AS key, 'map' AS metric, avg(\"map@3\") AS value FROM {p}pq UNION ALL SELECT 'overall', 'all', 'ndcg', avg(\"ndcg@3\") FROM {p}pq UNION ALL SELECT 'item', prod_name, 'map_attr', avg(ap3) FROM {p}enr WHERE label = 1 GROUP BY prod_name"
ORACLE_SQL = {
    "bootstrap_item_ci": f"""{_R}, {fr.enriched_sql()}, units AS (SELECT DISTINCT 'all' AS stratum, cust_id::VARCHAR AS unit FROM enr WHERE label = 1), {_draws('units').format(replicates=50)},
own AS (SELECT cust_id::VARCHAR AS unit, prod_name, sum(ap3) AS s, count(*) AS n FROM enr WHERE label = 1 GROUP BY ALL),
per AS (SELECT b, prod_name, sum(s * times) / sum(n * times) AS ap FROM own JOIN u USING (unit) JOIN times USING (stratum, i) GROUP BY ALL),
every AS (FROM per UNION ALL SELECT b, 'macro', avg(ap) FROM per GROUP BY b)
SELECT prod_name, {_CI.format(v='ap')} FROM every GROUP BY 1""",
    "paired_bootstrap_delta": f"""{_R}, ps AS (SELECT pred.*, segment AS stratum FROM pred LEFT JOIN seg USING (cust_id)), pm AS (SELECT * REPLACE (score + CASE WHEN prod_name = 'PROMO' THEN 0.25 ELSE 0 END AS score) FROM ps),
{fr.enriched_sql('ps', 'a_')}, {fr.enriched_sql('pm', 'b_')}, units AS (SELECT DISTINCT stratum, cust_id::VARCHAR AS unit FROM a_enr WHERE label = 1), {_draws('units').format(replicates=50)},
own AS (SELECT a.stratum, a.cust_id::VARCHAR AS unit, a.prod_name, sum(a.ap3) AS s, sum(b.ap3) AS m, count(*) AS n FROM a_enr a JOIN b_enr b USING (snap_date, cust_id, prod_name) WHERE a.label = 1 GROUP BY ALL),
per AS (SELECT b, prod_name, sum(m * times) / sum(n * times) - sum(s * times) / sum(n * times) AS d FROM own JOIN u USING (stratum, unit) JOIN times USING (stratum, i) GROUP BY ALL),
every AS (SELECT b, avg(d) AS delta FROM per GROUP BY b) SELECT {_CI.format(v='delta')} FROM every""",
    "auc_ci": f"""{_R}, units AS (SELECT DISTINCT 'all' AS stratum, cust_id::VARCHAR AS unit FROM pred), {_draws('units').format(replicates=10)},
g AS (SELECT b, prod_name, score, sum(times * label) AS p, sum(times * (1 - label)) AS n FROM (SELECT *, cust_id::VARCHAR AS unit FROM pred) JOIN u USING (unit) JOIN times USING (stratum, i) GROUP BY ALL),
r AS (SELECT *, coalesce(sum(n) OVER (PARTITION BY b, prod_name ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM g),
per AS (SELECT b, prod_name, sum(p * (below + n / 2)) / (sum(p) * sum(n)) AS auc FROM r GROUP BY ALL HAVING sum(p) * sum(n) > 0)
SELECT prod_name, {_CI.format(v='auc')} FROM per GROUP BY 1""",
    "popularity_counts": f"WITH {_POP} SELECT snapshot, prod_name, count, false AS fallback FROM found UNION ALL SELECT snapshot, prod_name, sum(n)::BIGINT, true FROM win, daily WHERE snapshot NOT IN (SELECT snapshot FROM found) GROUP BY ALL",
    "monthly_popularity": f"WITH {_DAILY.format(n=3)} SELECT snapshot, prod_name, strftime(day, '%Y-%m') AS month, sum(n)::BIGINT AS count FROM win JOIN daily ON day >= start AND day < snapshot GROUP BY ALL",
    "baseline_bundle": f"WITH {fr.PRED}, {_POP}, bf AS (SELECT snap_date, cust_id, p.prod_name, label, coalesce(count, 0)::DOUBLE AS score FROM pred p LEFT JOIN found f ON f.prod_name = p.prod_name AND f.snapshot = p.snap_date WHERE snap_date = DATE '1998-01-01'), {fr.enriched_sql('bf')} SELECT " + ", ".join(f'round(avg("{n}"), 6) AS "{n}"' for n in m.metric_names([3])) + ", count(*) AS n_queries FROM pq",
    "common_universe": f"{_SIDES} SELECT prod_name FROM i",
    "restrict_to_common": f"{_SIDES} SELECT snap_date, cust_id, prod_name, label, (row_number() OVER (PARTITION BY snap_date, cust_id ORDER BY score DESC, prod_name))::INT AS rank, 'a' AS side FROM ca UNION ALL SELECT snap_date, cust_id, prod_name, label, (row_number() OVER (PARTITION BY snap_date, cust_id ORDER BY score DESC, prod_name))::INT, 'b' FROM cb",
    "comparison_delta": f"{_SIDES}, {fr.enriched_sql('ca', 'a_')}, {fr.enriched_sql('cb', 'b_')}, la AS ({_DLONG.format(p='a_')}), lb AS ({_DLONG.format(p='b_')}) SELECT level, key, metric, round(coalesce(la.value, 0), 6) AS a, round(coalesce(lb.value, 0), 6) AS b, round(coalesce(la.value, 0) - coalesce(lb.value, 0), 6) AS delta FROM la FULL JOIN lb USING (level, key, metric)",
    "comparison_coverage": f"{_SIDES} " + " UNION ALL ".join(f"SELECT '{s}' AS side, '{k}' AS kind, count(DISTINCT {c}) AS total, (SELECT count(*) FROM {x}) AS common, count(DISTINCT {c}) - (SELECT count(*) FROM {x}) AS dropped FROM {s}" for s in "ab" for k, c, x in (("entity", "cust_id", "e"), ("item", "prod_name", "i"))),
    "external_predictions": f"{_P} SELECT snap_date, cust_id, category AS prod_name, round(max(score), 6) AS score FROM pred JOIN cat USING (prod_name) WHERE prod_name <> 'PROMO' AND snap_date = DATE '1997-01-01' GROUP BY ALL",
    "score_histogram": f"{_P}, s AS (SELECT min(score) AS mn, (max(score) - min(score)) / 10 AS w FROM pred), h AS (SELECT prod_name, CASE WHEN w > 0 THEN least(floor((score - mn) / w), 9) ELSE 0 END::INT AS bin, mn, w FROM pred, s) SELECT prod_name, bin, round(mn + bin * w, 6) AS lo, round(mn + (bin + 1) * w, 6) AS hi, count(*) AS count FROM h GROUP BY prod_name, bin, mn, w",
    "box_stats": f"{_P}, q AS (SELECT prod_name, label, count(*) AS n, quantile_disc(score, 0.0) AS low, quantile_disc(score, 0.25) AS q1, quantile_disc(score, 0.5) AS median, quantile_disc(score, 0.75) AS q3, quantile_disc(score, 1.0) AS high FROM pred GROUP BY ALL) SELECT prod_name, label, n, round(low, 6) AS low, round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3, round(high, 6) AS high, round(greatest(low, q1 - 1.5 * (q3 - q1)), 6) AS lower_fence, round(least(high, q3 + 1.5 * (q3 - q1)), 6) AS upper_fence FROM q",
    "rank_counts": _pivot("true"),
    "positive_rank_counts": _pivot("label = 1"),
    "positive_rate": f"{_RANKED} SELECT prod_name, rk::INT AS rank, round(avg(label), 6) AS positive_rate, count(*) AS rows FROM r GROUP BY ALL",
    "item_share_by_rank": f"{_RANKED}, c AS (SELECT prod_name, rk, count(*) AS rows FROM r GROUP BY ALL) SELECT prod_name, rk::INT AS rank, rows, round(rows / sum(rows) OVER (PARTITION BY rk), 6) AS share FROM c",
    "calibration_bins": f"{_P}, c AS (SELECT prod_name, greatest(least(floor(score * 10), 9), 0)::INT AS bin, sum(score) AS s, sum(label) AS p, count(*) AS rows FROM pred GROUP BY ALL) SELECT prod_name, bin, round(s / rows, 6) AS mean_score, round(p / rows, 6) AS mean_label, rows FROM c QUALIFY sum(rows) OVER (PARTITION BY prod_name) >= 10 AND sum(p) OVER (PARTITION BY prod_name) > 0",
    "query_centering": f"{_P} SELECT snap_date, cust_id, prod_name, round(score - avg(score) OVER (PARTITION BY snap_date, cust_id), 6) AS centered FROM pred",
    "weighted_auc": f"{_P}, g AS (SELECT prod_name, score, sum(CASE WHEN label = 1 THEN 1 + cust_id % 3 ELSE 0 END)::DOUBLE AS p, sum(CASE WHEN label = 1 THEN 0 ELSE 1 + cust_id % 3 END)::DOUBLE AS n FROM pred GROUP BY ALL), b AS (SELECT *, coalesce(sum(n) OVER (PARTITION BY prod_name ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM g) SELECT prod_name, round(sum(p * (below + 0.5 * n)) / (sum(p) * sum(n)), 6) AS auc, round(sum(p), 6) AS n_pos_weight, round(sum(n), 6) AS n_neg_weight FROM b GROUP BY 1",
    "item_ability": f"{_RANKED}, c AS (SELECT *, score - avg(score) OVER (PARTITION BY snap_date, cust_id) AS z FROM r) SELECT prod_name, round(avg(z) FILTER (label = 1), 6) AS mean_positive, round(avg(z) FILTER (label = 0), 6) AS mean_negative, round(avg(z) FILTER (label = 1) - avg(z) FILTER (label = 0), 6) AS gap, " + ", ".join(f"round(quantile_cont(rk::DOUBLE, {p / 100}), 6) AS rank_p{p}" for p in (10, 50, 90)) + " FROM c GROUP BY 1",
    "candidates_per_query": f"{_P}, n AS (SELECT count(*) AS n FROM pred WHERE score > 0 GROUP BY snap_date, cust_id) SELECT min(n) AS min, quantile_cont(n::DOUBLE, 0.5) AS median, max(n) AS max FROM n",
    "suppression_rows": f"{_PAIRS} SELECT snap_date, cust_id, target, suppressor, round(gap, 6) AS gap, round(raw, 6) AS raw, round(margin, 6) AS margin FROM pairs",
    "suppression_pairs": f"{_PAIRS} SELECT target, suppressor, round(sum(gap), 6) AS gap, count(*) AS rows, round(avg(margin), 6) AS mean_margin, round(median(margin), 6) AS median_margin, round(sum(gap) / sum(sum(gap)) OVER (), 6) AS share FROM pairs GROUP BY ALL",
    "suppression_by_target": f"{_PAIRS}, t AS (SELECT target, suppressor, sum(gap) AS gap, count(*) AS n FROM pairs GROUP BY ALL), k AS (SELECT *, row_number() OVER (PARTITION BY target ORDER BY gap DESC, suppressor) AS r FROM t) SELECT target, round(sum(gap), 6) AS gap, sum(n)::BIGINT AS pairs, string_agg(suppressor, ',' ORDER BY r) FILTER (r <= 3) AS top_suppressors FROM k GROUP BY 1",
    "suppression_by_suppressor": f"{_PAIRS} SELECT suppressor, round(sum(gap), 6) AS gap, count(*) AS pairs, count(DISTINCT (snap_date, cust_id)) AS queries, round(avg(margin), 6) AS mean_margin FROM pairs GROUP BY 1",
    "suppression_examples": f"{_PAIRS} SELECT snap_date, cust_id, target, suppressor, round(gap, 6) AS gap, round(raw, 6) AS raw, round(margin, 6) AS margin FROM pairs ORDER BY round(gap, 6) DESC, round(raw, 6) DESC, snap_date, cust_id, target, suppressor LIMIT 50",
    "cross_purchase": f"{_P}, p AS (SELECT DISTINCT snap_date, cust_id, prod_name FROM pred WHERE label = 1), n AS (SELECT prod_name, count(*) AS n FROM p GROUP BY 1), j AS (SELECT a.prod_name AS item, b.prod_name AS other, count(*) AS n_joint FROM p a JOIN p b ON a.snap_date = b.snap_date AND a.cust_id = b.cust_id AND a.prod_name <> b.prod_name GROUP BY ALL) SELECT item, other, x.n AS n_item, y.n AS n_other, n_joint, round(n_joint / x.n, 6) AS p_other_given_item, round(n_joint / x.n * (SELECT count(DISTINCT (snap_date, cust_id)) FROM pred) / y.n, 6) AS lift FROM j JOIN n x ON x.prod_name = item JOIN n y ON y.prod_name = other",
    "config_offset": f"{_OFF} SELECT segment, prod_name, round(o, 6) AS \"offset\", round(o - quantile_cont(o, 0.5) OVER (PARTITION BY segment), 6) AS centered FROM off",
    "config_shift": f"{_OFF}, v AS (SELECT 'base' AS variant, NULL AS only_ UNION ALL SELECT 'all', NULL UNION ALL SELECT DISTINCT 'only ' || prod_name, prod_name FROM off), vrows AS (SELECT variant, snap_date, cust_id, prod_name, label, score - CASE WHEN variant = 'all' OR only_ = prod_name THEN coalesce(o, 0) ELSE 0 END AS score FROM ps LEFT JOIN off USING (segment, prod_name), v), {_variants('vrows')}",
    "exposure_share": f"{_RANKED}, g AS (SELECT prod_name, sum((rk <= 3)::INT) AS t, sum(label) AS p FROM r GROUP BY 1), x AS (SELECT prod_name, t / sum(t) OVER () AS e, p / sum(p) OVER () AS s FROM g) SELECT prod_name, round(e, 6) AS exposure, round(s, 6) AS positive_share, round(pow(e - s, 2), 6) AS penalty FROM x",
    "score_shift_grid": f"{_P}, v AS (SELECT * FROM (VALUES ('base', NULL, 0.0), ('PROMO +0.25', 'PROMO', 0.25), ('PROMO -0.25', 'PROMO', -0.25), ('SMALL +0.5', 'SMALL', 0.5)) t(variant, it, sh)), vrows AS (SELECT variant, snap_date, cust_id, prod_name, label, score + CASE WHEN it = prod_name THEN sh ELSE 0 END::DOUBLE AS score FROM pred, v), {_variants('vrows')}",
    "weighted_quantile": f"{_P}, g AS (SELECT prod_name, score, sum(1 + cust_id % 3) AS w FROM pred GROUP BY ALL), c AS (SELECT *, sum(w) OVER (PARTITION BY prod_name ORDER BY score) AS run, sum(w) OVER (PARTITION BY prod_name) AS tot FROM g) SELECT prod_name, round(min(score), 6) AS quantile FROM c WHERE run >= 0.8::DOUBLE * tot GROUP BY 1",
}
