"""Registered queries over guards, table lifecycles, and the finer views of AUC, offsets, weights and attributions."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import frames as fr
from ..operators import ability, attribution, compare, encode, joins, profile, sampling, shift
from ..operators import filters as fl
from ..sources import tables
from . import dataset, etl, partitions, refresh
from .dataset_queries import features, md5_bucket
from .diagnosis_queries import _OFF, RATIOS, WEIGHTS
from .metric_queries import rounded, with_segment
from .source_queries import _ATT, _FEAT, _RAT, KEYS, D, _attributions, stratum_profile


def item_auc(spark, sf):
    """Raw and query-centred AUC of every item, and their gap."""
    return rounded(ability.item_auc(fr.pred(spark, sf)))


def _offsets(spark, sf):
    frame = with_segment(spark, sf)
    return frame, shift.config_offset(frame, "segment", RATIOS, WEIGHTS)


def offset_spread(spark, sf):
    return rounded(shift.offset_spread(_offsets(spark, sf)[1], "segment"))


def query_offset_spread(spark, sf):
    return rounded(shift.query_offset_spread(*_offsets(spark, sf), "segment"))


def card_limits(spark, sf):
    return rounded(etl.card_limits(*(fr.table(spark, sf, t) for t in ("lineitem", "orders", "supplier")), D), 4)


def tune_holdout_split(spark, sf):
    tune, holdout = sampling.tune_holdout_split(fr.pred(spark, sf).select(*KEYS, "label"), 0.6, hash="md5")
    return tune.withColumn("part", F.lit("tune")).unionByName(holdout.withColumn("part", F.lit("holdout")))


def shift_search(spark, sf):
    """Shifts of two items searched on one half of the customers, judged on the other."""
    return rounded(shift.shift_search(fr.pred(spark, sf), ["PROMO", "SMALL"], 3, hash="md5"))


def shift_steps(spark, sf):
    return rounded(shift.shift_steps(fr.pred(spark, sf), 3))


def best_shifts(spark, sf):
    return rounded(shift.best_shifts(shift.shift_steps(fr.pred(spark, sf), 3)))


def weight_surface_decoupled(spark, sf):
    surface = profile.ratio_surface(stratum_profile(spark, sf), 0.4)
    return rounded(profile.weight_surface(surface, 0.3, 0.5, "decoupled", 0.5).select("segment", "prod_name", "kept_neg", "floor", "attention", "w_pos", "w_neg"))


def rank_divergence(spark, sf):
    return rounded(attribution.rank_divergence(_attributions(spark, sf), ["prod_name"]))


def signed_profile_by_quadrant(spark, sf):
    quads = sampling.quadrants(fr.pred(spark, sf), 3).select(*KEYS, "quadrant")
    return rounded(attribution.signed_profile(_attributions(spark, sf).join(quads, KEYS), ["prod_name", "quadrant"], 2), 5)


def signed_profile_of_positives(spark, sf):
    positive = fr.pred(spark, sf).where("label = 1").select(*KEYS)
    return rounded(attribution.signed_profile(_attributions(spark, sf).join(positive, KEYS), ["prod_name"], 2), 5)


def coded_row_weights(spark, sf):
    """Weights that are keyed by values, looked up over encoded columns."""
    vocabulary = {"segment": ["BUILDING", "MACHINERY"], "prod_name": ["PROMO", "SMALL"]}
    weights = joins.code_weights({"BUILDING|PROMO": 2.0, "MACHINERY|SMALL": 0.5, "NOWHERE|SMALL": 9.0}, ["segment", "prod_name"], vocabulary)
    frame = with_segment(spark, sf)
    coded = encode.encode_categoricals(frame.withColumn("item", F.col("prod_name")), ["segment", "item"], encode.declared_vocabulary(frame, {"segment": vocabulary["segment"], "item": vocabulary["prod_name"]}))
    return joins.override_join(coded, ["segment", "item"], weights, 1.0, "weight").select(*KEYS, "weight")


def sampling_keys(spark, sf):
    """Strata and keys of the wide frame, each once."""
    wide = with_segment(spark, sf)
    return sampling.sampling_keys(wide.unionByName(wide), ["segment", "prod_name"], ["label"])


def work_grid(spark, sf):
    """Dates, customer buckets and items with candidates, in the order of work."""
    frame = sampling.entity_bucket(fr.pred(spark, sf), 4, hash="md5")
    return partitions.work_grid(*(frame.select(c) for c in ("snap_date", "entity_bucket", "prod_name")))


def keep_entities(spark, sf):
    """Candidates of the customers that have ordered for more than a sum."""
    rich = features(spark, sf).where("total_price > 300000").select("cust_id").distinct()
    return joins.keep_entities(fr.pred(spark, sf).select(*KEYS, "label"), rich)


def own_predictions(spark, sf):
    versions = fr.pred(spark, sf).select(*KEYS, "score", F.concat(F.lit("v"), F.pmod("cust_id", F.lit(3)).cast("string")).alias("version"))
    return rounded(compare.own_predictions(versions, "v1", "1997-01-01"))


def selected_features(spark, sf):
    """A feature table cut to the features that are included and not excluded."""
    frame = features(spark, sf)
    names = fl.select_features(["n_orders", "total_price", "priority"], exclude=["priority"])
    return dataset.require_columns(frame, ["snap_date", "cust_id", *names]).select("snap_date", "cust_id", *names)


def single_partition(spark, sf):
    frame = features(spark, sf).where("snap_date = DATE'1997-01-01'")
    return partitions.require_single_partition(frame, ["snap_date"]).select("snap_date", "cust_id", "n_orders")


def covered_population(spark, sf):
    population = partitions.require_population_covers(etl.inference_population(features(spark, sf)), ["1996-01-01", "1997-01-01"], "snap_date")
    return population.groupBy("snap_date").agg(F.count("*").alias("members"))


def fixed_versions(spark, sf):
    """Version columns that a frame lacks, added; the columns' types as a table would have them."""
    frame = tables.inject_versions(features(spark, sf), {"version": "v7"})
    kinds = ",".join(f"{n} {t}" for n, t in tables.infer_columns(frame, ["snap_date", "version"]))
    return frame.groupBy("snap_date", "version").agg(F.count("*").alias("rows"), F.lit(kinds).alias("columns"))


def table_lifecycle(spark, sf):
    """A table made by a query for a date, refreshed for that date and another, extended by a column in a last insert, and read back."""
    name = "lifecycle_" + tables.fresh_path(spark, "t").rsplit("-", 1)[1]
    features(spark, sf).createOrReplaceTempView("lifecycle_features")
    sql = "-- features of a year\nSELECT cust_id, n_orders, snap_date FROM IDENTIFIER(:source) WHERE snap_date = to_date(:d)"
    for d in ("1996-01-01", "1997-01-01", "1996-01-01"):
        tables.refresh_table(spark, sql, name, {"snap_date": "date"}, source="lifecycle_features", d=d)
    more = features(spark, sf).where("snap_date = DATE'1997-01-01' AND cust_id % 2 = 0").select("cust_id", "n_orders", (F.col("n_orders") * 2).alias("twice"), "snap_date")
    tables.insert_overwrite(more, name, {"snap_date": "date"})
    return tables.read_source(spark, name, "n_orders > 0").select("snap_date", "cust_id", "n_orders", "twice")


def declared_table(spark, sf):
    """A table declared with comments and partitions first, then filled with one date after the other."""
    name = "declared_" + tables.fresh_path(spark, "t").rsplit("-", 1)[1]
    frame = features(spark, sf).select("cust_id", "n_orders", "snap_date")
    tables.create_table(frame, name, ["snap_date"], {"n_orders": "orders of the year"})
    for d in ("1995-01-01", "1998-01-01"):
        tables.insert_overwrite(frame.where(F.col("snap_date") == F.lit(d)), name, {"snap_date": "date"})
    return spark.table(name)


def resumed_refresh(spark, sf):
    """Yearly features of which some years are there, one is rebuilt, and the run breaks off before the last but one and is taken up again."""
    path, audit = tables.fresh_path(spark, "refreshed"), tables.fresh_path(spark, "refreshed-audit")
    frame = features(spark, sf).select("cust_id", "n_orders", F.col("snap_date").cast("string").alias("snap_date"))
    stale = frame.where("snap_date < '1996-01-01'").withColumn("n_orders", F.lit(0).cast("long"))
    tables.write_versioned(stale, path, {"version": "v1"}, ["snap_date"])
    years = spark.createDataFrame([(f"{y}-01-01",) for y in range(1994, 1999)], "snap_date string")
    attempts = []

    def build(values):
        attempts.append(values["snap_date"])
        if attempts.count("1997-01-01") == 1 and values["snap_date"] == "1997-01-01":
            raise ConnectionError("the source is away")
        return frame.where(F.col("snap_date") == values["snap_date"])

    def run():
        return refresh.refresh(spark, "features", path, ["snap_date"], years, build, audit, "run", {"version": "v1"}, years.where("snap_date = '1995-01-01'"))

    try:
        run()
    except ConnectionError:
        run()
    back = tables.read_versioned(spark, path, {"version": "v1"})
    return back.select(F.to_date("snap_date").alias("snap_date"), "cust_id", "n_orders")


def audit_log(spark, sf):
    """Records of one run a year of orders, buffered, appended as one file and read back."""
    path = tables.fresh_path(spark, "audit")
    sink = tables.AuditSink(spark, path)
    for r in features(spark, sf).groupBy("snap_date").count().orderBy("snap_date").collect():
        sink.record("run", "features", str(r.snap_date), "done", r["count"])
    if failed := sink.flush():
        raise RuntimeError(failed)
    return spark.read.parquet(path).select("table_name", "target_date", "status", "rows")


QUERIES = {f.__name__: f for f in (
    item_auc, offset_spread, query_offset_spread, card_limits, tune_holdout_split, shift_search, shift_steps, best_shifts, weight_surface_decoupled, rank_divergence, signed_profile_by_quadrant,
    signed_profile_of_positives, coded_row_weights, sampling_keys, work_grid, keep_entities, own_predictions, selected_features, single_partition, covered_population,
    fixed_versions, table_lifecycle, declared_table, resumed_refresh, audit_log)}

_P = f"WITH {fr.PRED}"
_PSEG = f"{_P}, ps AS (SELECT pred.*, segment FROM pred LEFT JOIN seg USING (cust_id))"
_AUC = "g{n} AS (SELECT prod_name, {c} AS s, sum(label)::DOUBLE AS p, sum(1 - label)::DOUBLE AS n FROM z GROUP BY ALL), b{n} AS (SELECT *, coalesce(sum(n) OVER (PARTITION BY prod_name ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM g{n}), a{n} AS (SELECT prod_name, sum(p * (below + 0.5 * n)) / (sum(p) * sum(n)) AS auc FROM b{n} GROUP BY 1)"
_SPREAD = f"{_OFF}, qs AS (SELECT snap_date, cust_id, max(coalesce(o, 0)) - min(coalesce(o, 0)) AS spread, min(segment) <> max(segment) AS varies FROM ps LEFT JOIN off USING (segment, prod_name) GROUP BY ALL)"
_PROFILE = "SELECT {cols}, feature, round(mean_abs, 5) AS mean_abs, round(mean_signed, 5) AS mean_signed, place::INT AS place FROM (SELECT *, row_number() OVER (PARTITION BY {cols} ORDER BY mean_abs DESC, feature) AS place FROM (SELECT {cols}, feature, avg(abs(value)) AS mean_abs, avg(value) AS mean_signed FROM att JOIN {rows} USING (snap_date, cust_id, prod_name) GROUP BY ALL)) WHERE place <= 2"
_QUAD = "qd AS (SELECT *, row_number() OVER (PARTITION BY snap_date, cust_id ORDER BY score DESC, prod_name) AS pos FROM pred), quad AS (SELECT snap_date, cust_id, prod_name, CASE WHEN pos <= 3 AND label = 1 THEN 'TP' WHEN pos <= 3 THEN 'FP' WHEN label = 1 THEN 'FN' ELSE 'TN' END AS quadrant FROM qd)"
_RANKS = "rank() OVER (PARTITION BY prod_name ORDER BY {c}) + (count(*) OVER (PARTITION BY prod_name, {c}) - 1) / 2.0"
_COUNTS = "SELECT snap_date, cust_id, n_orders"


def _term(place: str, hits: str) -> str:
    return f"CASE WHEN {place} <= 3 THEN ({hits}) / ({place})::DOUBLE ELSE 0 END"


def _steps(source: str, where: str = "true") -> str:
    """CTEs ``steps(item, lo, hi, macro_ap, base)`` of ``source`` from its pairs of rows, for the items that move."""
    own = f"lj * ({_term('place', 'hits + 1')} - {_term('place + 1', 'hits + li + 1')}) / a.n"
    its = f"li * ({_term('place + 1', 'hits + lj + 1')} - {_term('place', 'hits + 1')}) / b.n"
    return f"""
sr AS (SELECT *, row_number() OVER (PARTITION BY snap_date, cust_id ORDER BY score DESC, prod_name) AS pos, max(label) OVER (PARTITION BY snap_date, cust_id) AS any_ FROM {source}),
sc AS (SELECT *, sum(label) OVER (PARTITION BY snap_date, cust_id ORDER BY pos ROWS UNBOUNDED PRECEDING) - label AS cb FROM sr WHERE any_ > 0),
sn AS (SELECT prod_name, count(*) AS n, sum({_term('pos', 'cb + 1')}) AS s FROM sc WHERE label = 1 GROUP BY 1),
sb AS (SELECT avg(s / n) AS base, count(*) AS t FROM sn),
se AS (SELECT j.prod_name AS item, i.prod_name AS other, round(i.score - j.score, 12) AS edge, j.pos < i.pos AS passed, j.label AS lj, i.label AS li,
    i.pos - (j.pos < i.pos)::INT AS place, i.cb - CASE WHEN j.pos < i.pos THEN j.label ELSE 0 END AS hits
  FROM sc j JOIN sc i USING (snap_date, cust_id) WHERE j.prod_name <> i.prod_name AND j.label + i.label > 0 AND {where}),
sg AS (SELECT item, edge, passed, (coalesce({own}, 0) + coalesce({its}, 0)) / t AS gain FROM se LEFT JOIN sn a ON a.prod_name = item LEFT JOIN sn b ON b.prod_name = other, sb WHERE place <= 3),
sp AS (SELECT item, edge, sum(gain) AS gain FROM sg GROUP BY ALL),
sl AS (SELECT item, sum(CASE WHEN passed THEN gain ELSE 0 END) AS lost FROM sg GROUP BY 1),
steps AS (SELECT item, edge AS lo, lead(edge) OVER (PARTITION BY item ORDER BY edge) AS hi, base - lost + sum(gain) OVER (PARTITION BY item ORDER BY edge ROWS UNBOUNDED PRECEDING) AS macro_ap, base FROM sp JOIN sl USING (item), sb
  UNION ALL SELECT j.prod_name, NULL, (SELECT min(edge) FROM sp WHERE item = j.prod_name), base - coalesce((SELECT lost FROM sl WHERE item = j.prod_name), 0), base FROM (SELECT DISTINCT prod_name FROM {source}) j, sb WHERE {where}),
mid AS (SELECT *, CASE WHEN lo IS NULL AND hi IS NULL THEN 0 WHEN lo IS NULL THEN hi - 1 WHEN hi IS NULL THEN lo + 1 ELSE (lo + hi) / 2 END AS shift FROM steps),
near AS (SELECT *, row_number() OVER (PARTITION BY item ORDER BY abs(shift), shift) AS r FROM mid JOIN (SELECT item, max(macro_ap) AS most FROM mid GROUP BY 1) USING (item) WHERE macro_ap >= most - 1e-9),
best AS (SELECT item, CASE WHEN macro_ap > base + 1e-9 THEN shift ELSE 0 END AS shift, CASE WHEN macro_ap > base + 1e-9 THEN macro_ap ELSE base END AS macro_ap, base FROM near WHERE r = 1)"""


ORACLE_SQL = {
    "shift_steps": f"{_P}, {_steps('pred')} SELECT item AS prod_name, round(lo, 6) + 0.0 AS lo, round(hi, 6) + 0.0 AS hi, round(macro_ap, 6) AS macro_ap, round(base, 6) AS base FROM steps",
    "best_shifts": f"{_P}, {_steps('pred')} SELECT item AS prod_name, round(shift, 6) + 0.0 AS shift, round(macro_ap, 6) AS macro_ap, round(base, 6) AS base, round(macro_ap - base, 6) + 0.0 AS gain FROM best",
    "shift_search": f"""{_P}, sides AS (SELECT *, CASE WHEN {md5_bucket(['cust_id::VARCHAR'], site='tune')} < 50000 THEN 'tune' ELSE 'holdout' END AS side FROM pred),
tune AS (SELECT * FROM sides WHERE side = 'tune'), {_steps('tune', "j.prod_name IN ('PROMO', 'SMALL')")},
move AS (SELECT item, shift FROM best WHERE macro_ap - base > 1e-9 AND macro_ap - base >= (SELECT max(macro_ap - base) FROM best) - 1e-9 ORDER BY item LIMIT 1),
vr AS (SELECT side, v, snap_date, cust_id, prod_name, label, row_number() OVER (PARTITION BY v, snap_date, cust_id
    ORDER BY score + CASE WHEN v = 'shifted' AND prod_name = (SELECT item FROM move) THEN (SELECT shift FROM move) ELSE 0 END DESC, prod_name) AS pos FROM sides, (VALUES ('base'), ('shifted')) x(v)),
vc AS (SELECT *, sum(label) OVER (PARTITION BY v, snap_date, cust_id ORDER BY pos ROWS UNBOUNDED PRECEDING) AS cum FROM vr),
vi AS (SELECT side, v, prod_name, avg({_term('pos', 'cum')}) AS ap FROM vc WHERE label = 1 GROUP BY ALL),
vm AS (SELECT side, avg(ap) FILTER (v = 'base') AS base, avg(ap) FILTER (v = 'shifted') AS shifted FROM (SELECT side, v, prod_name, ap FROM vi) GROUP BY 1)
SELECT side, round(base, 6) AS base, round(shifted, 6) AS shifted, round(shifted - base, 6) + 0.0 AS delta FROM vm""",
    "item_auc": f"{_P}, z AS (SELECT *, score - avg(score) OVER (PARTITION BY snap_date, cust_id) AS centered FROM pred), {_AUC.format(n=1, c='score')}, {_AUC.format(n=2, c='round(centered, 12)')} SELECT prod_name, round(a1.auc, 6) AS raw_auc, round(a2.auc, 6) AS centered_auc, round(a1.auc - a2.auc, 6) AS auc_gap FROM a1 JOIN a2 USING (prod_name)",
    "offset_spread": f"{_OFF} SELECT segment, round(max(o) - min(o), 6) AS offset_spread FROM off GROUP BY 1",
    "query_offset_spread": f"{_SPREAD} SELECT round(quantile_cont(spread, 0.5), 6) AS p50, round(quantile_cont(spread, 0.9), 6) AS p90, round(quantile_cont(spread, 1.0), 6) AS p100, bool_or(varies) AS varies FROM qs",
    "card_limits": f"SELECT DATE '{D}' AS snap_date, o_custkey AS cust_id, count(l_orderkey) AS n_lines, round(coalesce(sum(l_extendedprice), 0), 4) AS spend, max(coalesce((s_acctbal > 5000)::INT, 0)) AS high_limit, round(max(s_acctbal), 4) AS card_limit, round(CASE WHEN max(s_acctbal) > 0 THEN coalesce(sum(l_extendedprice), 0) / max(s_acctbal) ELSE 0 END, 4) AS utilisation, count(DISTINCT s_suppkey) AS cards FROM orders JOIN lineitem ON l_orderkey = o_orderkey LEFT JOIN supplier ON l_suppkey = s_suppkey AND s_acctbal > 0 WHERE o_orderdate::DATE > DATE '{D}' - 30 AND o_orderdate::DATE <= DATE '{D}' GROUP BY o_custkey",
    "tune_holdout_split": f"{_P} SELECT snap_date, cust_id, prod_name, label, CASE WHEN {md5_bucket(['cust_id::VARCHAR'], site='tune')} < 60000 THEN 'tune' ELSE 'holdout' END AS part FROM pred",
    "weight_surface_decoupled": f"{_RAT}, k AS (SELECT *, n_neg * 0.5::DOUBLE AS kn FROM rs), w AS (SELECT *, coalesce(n_pos * 0.7::DOUBLE / nullif(0.3::DOUBLE * kn, 0), 1.0) AS fl FROM k), ms AS (SELECT *, n_pos + fl * kn AS mass FROM w), a AS (SELECT *, CASE WHEN mass > 0 THEN pow(min(CASE WHEN mass > 0 THEN mass END) OVER () / mass, 0.5) ELSE 1.0 END AS att FROM ms) SELECT segment, prod_name, round(kn, 6) AS kept_neg, round(fl, 6) AS floor, round(att, 6) AS attention, round(att, 6) AS w_pos, round(att * fl, 6) AS w_neg FROM a",
    "rank_divergence": f"{_ATT}, o AS (SELECT prod_name, feature, avg(abs(value)) AS v FROM att GROUP BY ALL), gg AS (SELECT feature, avg(abs(value)) AS g FROM att GROUP BY ALL), rr AS (SELECT prod_name, {_RANKS.format(c='v')} AS a, {_RANKS.format(c='g')} AS b FROM o JOIN gg USING (feature)) SELECT prod_name, round(coalesce((1 - corr(a, b)) / 2, 0), 6) + 0.0 AS divergence FROM rr GROUP BY 1",
    "signed_profile_by_quadrant": f"{_ATT}, {_QUAD} {_PROFILE.format(cols='prod_name, quadrant', rows='quad')}",
    "signed_profile_of_positives": f"{_ATT}, pos AS (SELECT snap_date, cust_id, prod_name FROM pred WHERE label = 1) {_PROFILE.format(cols='prod_name', rows='pos')}",
    "coded_row_weights": f"{_PSEG} SELECT snap_date, cust_id, prod_name, (CASE segment || '|' || prod_name WHEN 'BUILDING|PROMO' THEN 2.0 WHEN 'MACHINERY|SMALL' THEN 0.5 ELSE 1.0 END)::DOUBLE AS weight FROM ps",
    "sampling_keys": f"{_PSEG} SELECT DISTINCT segment, prod_name, snap_date, cust_id, label FROM ps",
    "work_grid": f"{_P}, e AS (SELECT DISTINCT {md5_bucket(['cust_id::VARCHAR'], 4, 'bucket')}::INT AS entity_bucket FROM pred), d AS (SELECT DISTINCT snap_date FROM pred) SELECT (row_number() OVER (ORDER BY snap_date, entity_bucket, prod_name))::INT AS place, snap_date, entity_bucket, prod_name FROM d, e, items",
    "keep_entities": f"{_P}, {_FEAT} SELECT snap_date, cust_id, prod_name, label FROM pred WHERE cust_id IN (SELECT cust_id FROM feat WHERE total_price > 300000)",
    "own_predictions": f"{_P} SELECT snap_date, cust_id, prod_name, round(score, 6) AS score FROM pred WHERE cust_id % 3 = 1 AND snap_date = DATE '1997-01-01'",
    "selected_features": f"WITH {_FEAT} {_COUNTS}, total_price FROM feat",
    "single_partition": f"WITH {_FEAT} {_COUNTS} FROM feat WHERE snap_date = DATE '1997-01-01'",
    "covered_population": f"WITH {_FEAT} SELECT snap_date, count(*) AS members FROM feat GROUP BY 1",
    "fixed_versions": f"WITH {_FEAT} SELECT snap_date, 'v7' AS version, count(*) AS rows, 'cust_id bigint,n_orders bigint,total_price double,priority string' AS columns FROM feat GROUP BY 1",
    "table_lifecycle": f"WITH {_FEAT} {_COUNTS}, NULL::BIGINT AS twice FROM feat WHERE snap_date = DATE '1996-01-01' UNION ALL {_COUNTS}, n_orders * 2 FROM feat WHERE snap_date = DATE '1997-01-01' AND cust_id % 2 = 0",
    "declared_table": f"WITH {_FEAT} SELECT cust_id, n_orders, snap_date FROM feat WHERE snap_date IN (DATE '1995-01-01', DATE '1998-01-01')",
    "resumed_refresh": f"WITH {_FEAT} SELECT snap_date, cust_id, CASE WHEN snap_date < DATE '1995-01-01' THEN 0 ELSE n_orders END AS n_orders FROM feat WHERE snap_date <= DATE '1998-01-01'",
    "audit_log": f"WITH {_FEAT} SELECT 'features' AS table_name, snap_date::VARCHAR AS target_date, 'done' AS status, count(*) AS rows FROM feat GROUP BY snap_date",
}
