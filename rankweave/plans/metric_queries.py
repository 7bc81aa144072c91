"""Registered queries over the metric operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import frames as fr
from ..operators import metrics as m
from ..operators import presence, query_arrays
from ..roles import ROLES

KS = (3, 5)
NAMES = m.metric_names(KS)
ITEM_NAMES = [f"{n}@{k}" for k in KS for n in ("hit_rate", "map_attr", "ndcg_attr")]


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded, and -0.0 as 0.0, so that results compare by value."""
    return df.select(*((F.round(f"`{c}`", digits) + 0.0).alias(c) if t == "double" else F.col(f"`{c}`") for c, t in df.dtypes))


def _r(names) -> str:
    return ", ".join(f'round("{n}", 6) AS "{n}"' for n in names)


def _avg(names) -> str:
    return ", ".join(f'round(avg("{n}"), 6) AS "{n}"' for n in names)


def _item_aggs() -> str:
    return ", ".join(f'round(avg(hit{k}), 6) AS "hit_rate@{k}", round(avg(ap{k}), 6) AS "map_attr@{k}", round(avg(ndcg{k}), 6) AS "ndcg_attr@{k}"' for k in KS)


def with_segment(spark: SparkSession, sf: str) -> DataFrame:
    return fr.pred(spark, sf).join(fr.segments(spark, sf), "cust_id", "left")


def _enriched(spark, sf):
    return m.enrich(fr.pred(spark, sf), KS)


def rank_within_query(spark, sf):
    return rounded(m.rank_within_query(fr.pred(spark, sf)).select("snap_date", "cust_id", "prod_name", "score", "pos"))


def row_contributions(spark, sf):
    out = _enriched(spark, sf).select("snap_date", "cust_id", "prod_name", "cum_rel", F.col("ap@3").alias("ap3"), F.col("ndcg@3").alias("ndcg3"))
    return rounded(out)


def per_query_metrics(spark, sf):
    return rounded(m.per_query_metrics(_enriched(spark, sf), KS))


def overall_map(spark, sf):
    return rounded(m.overall_metrics(m.per_query_metrics(_enriched(spark, sf), KS), KS))


def segment_metrics(spark, sf):
    own = m.per_query_metrics(m.enrich(with_segment(spark, sf), KS), KS, carry=["segment"])
    return rounded(m.segment_metrics(own, "segment", KS))


def item_metrics(spark, sf):
    return rounded(m.item_metrics(_enriched(spark, sf), ["prod_name"], KS))


def item_segment_metrics(spark, sf):
    return rounded(m.item_metrics(m.enrich(with_segment(spark, sf), KS), ["prod_name", "segment"], KS))


def macro_default(spark, sf):
    return rounded(m.macro_average(m.item_metrics(_enriched(spark, sf), ["prod_name"], KS), ["map_attr@3", "hit_rate@3"]))


def macro_shrunk_weighted(spark, sf):
    per_item = m.item_metrics(_enriched(spark, sf), ["prod_name"], KS)
    return rounded(m.macro_average(per_item, ["map_attr@3", "hit_rate@3"], min_positives=10, shrink=50.0, alpha=0.5))


def observation_items(spark, sf):
    per_item = m.item_metrics(m.enrich(with_segment(spark, sf), KS), ["prod_name", "segment"], KS)
    return m.observation_items(per_item, 1000).select("prod_name", "segment", "n_pos")


def category_metrics(spark, sf):
    frame = m.collapse_to_categories(fr.pred(spark, sf), fr.categories(spark, sf))
    return rounded(m.item_metrics(m.enrich(frame, KS), ["prod_name"], KS))


def category_map(spark, sf):
    items = fr.table(spark, sf, "part").select(F.col("p_type").alias("prod_name")).distinct()
    return m.category_map(items, fr.categories(spark, sf).where("category = 'SIZED'"))


def dataset_overview(spark, sf):
    return rounded(presence.dataset_overview(with_segment(spark, sf), ["snap_date", "prod_name", "segment"]))


def metric_bundle(spark, sf):
    out = query_arrays.metric_bundle(with_segment(spark, sf), [3], "segment", fr.categories(spark, sf))
    return rounded(out)


def mean_average_precision(spark, sf):
    """Mean AP without truncation: k is the number of items."""
    return m.overall_metrics(m.per_query_metrics(m.enrich(fr.pred(spark, sf), [6]), [6]), [6]).select(F.round("map@6", 6).alias("mean_ap"), "n_queries")


def per_item_ap(spark, sf):
    weighted = _enriched(spark, sf).withColumn("w", 1 + F.pmod("cust_id", F.lit(3)).cast("double"))
    return rounded(m.per_item_ap(weighted, 5, "w"))


def calibrated_comparison(spark, sf):
    """Metrics of both score columns, and whether any row was calibrated."""
    long = query_arrays.compared_scores(fr.pred(spark, sf), [3], {"score": "calibrated", "score_uncalibrated": "uncalibrated"})
    names = m.metric_names([3])
    wide = long.where("level = 'overall'").groupBy("grain").agg(*(F.max(F.when(F.col("metric") == n, F.col("value"))).alias(n) for n in [*names, "n_queries", "n_differing_rows"]))
    flag = wide.where("grain = 'all'").select((F.col("n_differing_rows") > 0).cast("int").alias("is_calibrated"))
    variants = wide.where("grain <> 'all'").select(*names, F.col("n_queries").cast("long").alias("n_queries"), F.col("grain").alias("variant"))
    return rounded(variants.crossJoin(F.broadcast(flag)))  # one row


_W = f"WITH {fr.PRED}, {fr.enriched_sql()}"
_PS = f"WITH {fr.PRED}, preds AS (SELECT pred.*, segment FROM pred LEFT JOIN seg USING (cust_id)), {fr.enriched_sql('preds')}"
_PER = f"per AS (SELECT prod_name, {_item_aggs().replace('round(', '(').replace(', 6)', ')')}, count(*) AS n_pos FROM enr WHERE label = 1 GROUP BY 1)"
_COLL = "coll AS (SELECT snap_date, cust_id, category AS prod_name, max(score) AS score, max(label) AS label FROM pred JOIN cat USING (prod_name) GROUP BY ALL)"


def _macro(shrink: float, alpha: float, least: int) -> str:
    def one(n):
        return (f'round(sum(pow(n_pos, {alpha}) * (n_pos / (n_pos + {shrink}) * "{n}" + {shrink} / (n_pos + {shrink}) * (SELECT sum("{n}" * n_pos) / sum(n_pos) FROM kept)))'
                f' / sum(pow(n_pos, {alpha})), 6) AS "macro_{n}"')  # fmt: skip

    return f"{_W}, {_PER}, kept AS (SELECT * FROM per WHERE n_pos >= {least}) SELECT {one('map_attr@3')}, {one('hit_rate@3')}, count(*) AS n_items FROM kept"


def _bundle_sql() -> str:
    parts = []
    for grain, p in (("item", ""), ("category", "c_")):
        src = "preds" if grain == "item" else "ccoll"
        for m_, e in (("map@3", '"map@3"'), ("ndcg@3", '"ndcg@3"'), ("precision@3", '"precision@3"'), ("recall@3", '"recall@3"')):
            parts.append(f"SELECT '{grain}' AS grain, 'overall' AS level, 'all' AS key, '{m_}' AS metric, avg({e}) AS value FROM {p}pq")
            parts.append(f"SELECT '{grain}', 'segment', segment, '{m_}', avg({e}) FROM {p}pq JOIN seg USING (cust_id) GROUP BY segment")
        parts.append(f"SELECT '{grain}', 'overall', 'all', 'n_queries', count(*) FROM {p}pq")
        parts.append(f"SELECT '{grain}', 'segment', segment, 'n_queries', count(*) FROM {p}pq JOIN seg USING (cust_id) GROUP BY segment")
        for m_, e in (("hit_rate@3", "avg(hit3)"), ("map_attr@3", "avg(ap3)"), ("ndcg_attr@3", "avg(ndcg3)"), ("mean_pos", "avg(pos)"), ("n_pos", "count(*)")):
            parts.append(f"SELECT '{grain}', 'item', prod_name, '{m_}', {e} FROM {p}enr WHERE label = 1 GROUP BY prod_name")
        parts.append(f"SELECT '{grain}', 'overall', 'all', 'n_excluded_queries', sum((x = 0)::INT) FROM (SELECT max(label) AS x FROM {src} GROUP BY snap_date, cust_id)")
    coll = "ccoll AS (SELECT snap_date, cust_id, category AS prod_name, max(score) AS score, max(label) AS label FROM pred JOIN cat USING (prod_name) GROUP BY ALL)"
    return f"{_PS}, {coll}, {fr.enriched_sql('ccoll', 'c_')} SELECT grain, level, key, metric, round(value::DOUBLE, 6) AS value FROM ({' UNION ALL '.join(parts)})"


def _over(level: str, value: str, group: str) -> str:
    return (f"SELECT '{level}' AS level, {value} AS value, count(*) AS rows, sum(label)::BIGINT AS positives, round(sum(label) / count(*), 6) AS positive_rate, "
            f"count(DISTINCT cust_id) AS entities, count(DISTINCT (snap_date, cust_id)) AS queries FROM preds {group}")  # fmt: skip


QUERIES = {f.__name__: f for f in (
    rank_within_query, row_contributions, per_query_metrics, overall_map, segment_metrics, item_metrics, item_segment_metrics, macro_default,
    macro_shrunk_weighted, observation_items, category_metrics, category_map, dataset_overview, metric_bundle, mean_average_precision, per_item_ap, calibrated_comparison)}
ORACLE_SQL = {
    "rank_within_query": f"{_W} SELECT snap_date, cust_id, prod_name, round(score, 6) AS score, pos::INT AS pos FROM ranked",
    "row_contributions": f"{_W} SELECT snap_date, cust_id, prod_name, cum_rel::BIGINT AS cum_rel, round(ap3, 6) AS ap3, round(ndcg3, 6) AS ndcg3 FROM enr",
    "per_query_metrics": f"{_W} SELECT snap_date, cust_id, {_r(NAMES)} FROM pq",
    "overall_map": f"{_W} SELECT {_avg(NAMES)}, count(*) AS n_queries FROM pq",
    "segment_metrics": f"{_W} SELECT segment, {_avg(NAMES)}, count(*) AS n_queries FROM pq JOIN seg USING (cust_id) GROUP BY segment",
    "item_metrics": f"{_W} SELECT prod_name, {_item_aggs()}, round(avg(pos), 6) AS mean_pos, count(*) AS n_pos FROM enr WHERE label = 1 GROUP BY 1",
    "item_segment_metrics": f"{_PS} SELECT prod_name, segment, {_item_aggs()}, round(avg(pos), 6) AS mean_pos, count(*) AS n_pos FROM enr WHERE label = 1 GROUP BY ALL",
    "macro_default": _macro(0.0, 0.0, 0),
    "macro_shrunk_weighted": _macro(50.0, 0.5, 10),
    "observation_items": f"{_PS} SELECT prod_name, segment, count(*) AS n_pos FROM enr WHERE label = 1 GROUP BY ALL HAVING count(*) < 1000",
    "category_metrics": f"WITH {fr.PRED}, {_COLL}, {fr.enriched_sql('coll')} SELECT prod_name, {_item_aggs()}, round(avg(pos), 6) AS mean_pos, count(*) AS n_pos FROM enr WHERE label = 1 GROUP BY 1",
    "category_map": f"WITH {fr.PRED} SELECT prod_name, CASE WHEN category = 'SIZED' THEN category ELSE prod_name END AS category FROM cat",
    "dataset_overview": f"{_PS} " + " UNION ALL ".join([_over("total", "'all'", ""), _over("snap_date", "snap_date::VARCHAR", "GROUP BY snap_date"), _over("prod_name", "prod_name", "GROUP BY prod_name"), _over("segment", "segment", "GROUP BY segment")]),
    "metric_bundle": _bundle_sql(),
    "mean_average_precision": f"{_W}, q AS (SELECT sum(label * cum_rel / pos) / max(total_rel) AS ap FROM cum GROUP BY snap_date, cust_id) SELECT round(avg(ap), 6) AS mean_ap, count(*) AS n_queries FROM q",
    "per_item_ap": f"{_W} SELECT prod_name, round(sum((1 + cust_id % 3) * ap5) / sum(1 + cust_id % 3), 6) AS ap, count(*) AS n_pos FROM enr WHERE label = 1 GROUP BY 1",
    "calibrated_comparison": f"WITH {fr.PRED}, {fr.enriched_sql()}, raw AS (SELECT snap_date, cust_id, prod_name, label, score_uncalibrated AS score FROM pred), {fr.enriched_sql('raw', 'r_')} "
    + " UNION ALL ".join(f"SELECT {_avg(m.metric_names([3]))}, count(*) AS n_queries, '{v}' AS variant, (SELECT max((score <> score_uncalibrated)::INT) FROM pred) AS is_calibrated FROM {p}pq" for v, p in (("calibrated", ""), ("uncalibrated", "r_"))),
}
