"""Evaluation flows: the frame that metrics read, the report's aggregates, and the popularity baseline."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame

from ..operators import baseline, diagnostics, filters, joins
from ..operators import metrics as m
from ..roles import ROLES, Roles


def eval_frame(predictions: DataFrame, labels: DataFrame, months: Iterable[str], segments: tuple[DataFrame, list[str], str] | None = None, roles: Roles = ROLES) -> DataFrame:
    """Predictions of the months with labels (a miss is 0), ranks where there are none, and a segment; fails if no month matches."""
    months = list(months)
    own = filters.restrict_to_months(predictions, months, roles)
    own = filters.require_rows(own, f"months {months}", predictions.select(roles.time))
    own = joins.join_predictions(own, labels, roles)
    if roles.rank not in own.columns:
        own = m.rank_within_query(own, roles, roles.rank)
    return joins.join_segments(own, *segments) if segments else own


def report_aggregates(frame: DataFrame, n_items: int, bins: int = 10, roles: Roles = ROLES) -> dict[str, DataFrame]:
    """The report's tables, all over one narrow projection that is kept while they run; the caller unpersists ``frame``."""
    own = frame.select(*roles.identity, roles.label, roles.score, roles.rank).persist()
    return {
        "frame": own,
        "score_histogram": diagnostics.score_histogram(own, bins, roles),
        "box_stats": diagnostics.box_stats(own, roles),
        "rank_counts": diagnostics.rank_counts(own, n_items, roles),
        "positive_rank_counts": diagnostics.positive_rank_counts(own, n_items, roles),
        "positive_rate": diagnostics.positive_rate(own, roles),
        "item_share_by_rank": diagnostics.item_share_by_rank(own, roles),
        "calibration_bins": diagnostics.calibration_bins(own, bins, roles),
    }


def slim_bundle(frame: DataFrame, ks: Iterable[int], roles: Roles = ROLES) -> tuple[DataFrame, DataFrame]:
    """(overall, per item) alone."""
    ks = list(ks)
    own = m.enrich(frame, ks, roles)
    return m.overall_metrics(m.per_query_metrics(own, ks, roles), ks), m.item_metrics(own, [roles.item], ks, roles)


def baseline_metrics(frame: DataFrame, labels: DataFrame, snapshots: Iterable[str], months: int, ks: Iterable[int], roles: Roles = ROLES) -> dict[str, DataFrame]:
    """Popularity counts by window and by month, and the slim bundle of ranking by popularity."""
    snapshots = list(snapshots)
    counts = baseline.popularity_counts(labels, snapshots, months, roles)
    overall, items = slim_bundle(baseline.baseline_frame(frame, counts, roles), ks, roles)
    return {"counts": counts, "monthly": baseline.monthly_popularity(labels, snapshots, months, roles), "overall": overall, "items": items}
