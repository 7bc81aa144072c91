"""Registered queries over evaluation flows."""

from __future__ import annotations

from .. import frames as fr
from ..operators import joins
from . import evaluation
from .dataset_queries import labels
from .diagnosis_queries import daily_labels
from .metric_queries import rounded

KEYS = ["snap_date", "cust_id", "prod_name"]


def eval_frame(spark, sf):
    predictions = fr.pred(spark, sf).select(*KEYS, "score")
    out = evaluation.eval_frame(predictions, labels(spark, sf), ["1997-01-01", "1999-01-01"], (fr.segments(spark, sf), ["cust_id"], "segment"))
    return rounded(out.select(*KEYS, "score", "label", "rank", "segment"))


def segment_join(spark, sf):
    return joins.join_segments(fr.pred(spark, sf).select(*KEYS, "label"), fr.segments(spark, sf), ["cust_id"], "segment").select(*KEYS, "label", "segment")


def report_rank_shares(spark, sf):
    """One table of the report's aggregates, over the kept projection."""
    frame = evaluation.eval_frame(fr.pred(spark, sf), labels(spark, sf), ["1997-01-01", "1999-01-01"])
    return rounded(evaluation.report_aggregates(frame, 6)["item_share_by_rank"])


def baseline_items(spark, sf):
    frame = fr.pred(spark, sf).where("snap_date = DATE'1998-01-01'")
    return rounded(evaluation.baseline_metrics(frame, daily_labels(spark, sf), ["1998-01-01"], 12, [3])["items"])


QUERIES = {f.__name__: f for f in (eval_frame, segment_join, report_rank_shares, baseline_items)}
_R = f"WITH {fr.PRED}, r AS (SELECT pred.*, segment, (row_number() OVER (PARTITION BY snap_date, cust_id ORDER BY score DESC, prod_name))::INT AS rank FROM pred LEFT JOIN seg USING (cust_id))"
_TWO = "snap_date IN (DATE '1997-01-01', DATE '1999-01-01')"
_POP = "pop AS (SELECT p_type AS prod_name, count(*)::DOUBLE AS n FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey WHERE o_orderdate::DATE >= DATE '1997-01-01' AND o_orderdate::DATE < DATE '1998-01-01' GROUP BY 1)"
ORACLE_SQL = {
    "eval_frame": f"{_R} SELECT snap_date, cust_id, prod_name, round(score, 6) AS score, label, rank, segment FROM r WHERE {_TWO}",
    "segment_join": f"{_R} SELECT snap_date, cust_id, prod_name, label, segment FROM r",
    "report_rank_shares": f"{_R}, c AS (SELECT prod_name, rank, count(*) AS rows FROM r WHERE {_TWO} GROUP BY ALL) SELECT prod_name, rank, rows, round(rows / sum(rows) OVER (PARTITION BY rank), 6) AS share FROM c",
    "baseline_items": f"WITH {fr.PRED}, {_POP}, bf AS (SELECT snap_date, cust_id, p.prod_name, label, coalesce(n, 0) AS score FROM pred p LEFT JOIN pop USING (prod_name) WHERE snap_date = DATE '1998-01-01'), {fr.enriched_sql('bf')} SELECT prod_name, round(avg(hit3), 6) AS \"hit_rate@3\", round(avg(ap3), 6) AS \"map_attr@3\", round(avg(ndcg3), 6) AS \"ndcg_attr@3\", round(avg(pos), 6) AS mean_pos, count(*) AS n_pos FROM enr WHERE label = 1 GROUP BY 1",
}
