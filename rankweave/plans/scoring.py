"""Scoring and publication flows."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.ml import Model
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import checks, filters, joins, ml
from ..operators.encode import encode_categoricals
from ..operators.metrics import rank_within_query
from ..operators.sampling import entity_bucket
from ..roles import ROLES, Roles
from ..sources import tables
from .dataset import Preprocessor


def population_features(members: DataFrame, features: DataFrame, fitted: Preprocessor, buckets: int, drop: Iterable[str] = (), roles: Roles = ROLES) -> DataFrame:
    """Members with encoded, narrowed features and an entity bucket, at (time, entity): not yet times the items."""
    own = filters.drop_keeping_identity(joins.join_population(members, features, roles), drop, roles)
    own = entity_bucket(own, buckets, roles=roles)
    own = encode_categoricals(own, filters.encodable_categoricals(own, fitted.categorical, roles), fitted.vocab)
    return filters.time_as_partition_string(filters.cast_float_features(own, [c for c in fitted.features if c in own.columns], roles), roles)


def score_all_items(population: DataFrame, items: DataFrame, fitted: Preprocessor, scorer: Callable[[DataFrame], DataFrame], roles: Roles = ROLES) -> DataFrame:
    """Every member times every item, scored. The item's code is its place in the vocabulary; rows multiply only here, just before the model."""
    own = encode_categoricals(items.select(roles.item).withColumn("__name", F.col(roles.item)), [roles.item], fitted.vocab)
    grid = population.crossJoin(F.broadcast(own.withColumnRenamed(roles.item, "item_code").withColumnRenamed("__name", roles.item)))  # the item list
    return scorer(grid).select(*roles.identity, F.col(roles.score).cast("double").alias(roles.score))


def score_test_set(spark: SparkSession, test: DataFrame, model: Model, features: Iterable[str], path: str, fixed: dict[str, object], held: DataFrame | None = None, method: str = "isotonic",
                   roles: Roles = ROLES) -> tuple[DataFrame, dict[str, int]]:
    """The test rows with a fitted model's scores and ranks, written by month through the partitioned writer and read back, and what the write observed.

    With ``held`` rows scores are calibrated on theirs, and the raw ones kept as
    ``score_uncalibrated``. Rows are scored where they lie and staged without their features (a fitted model's
    functions can't travel in a plan that is observed), then moved once, for the ranks; months
    that were written before are replaced, others stay. Null scores and repeated rows fail after the write
    of this version's months alone.
    """
    features, keep = list(features), [*roles.identity, roles.label]
    scored = ml.score(test.drop(roles.score), model, features, roles.score)
    if held is not None:
        scored = ml.calibrate(ml.score(held.drop(roles.score), model, features, roles.score), scored, method, roles)
        keep.append("score_uncalibrated")
    narrow = tables.staged(filters.time_as_partition_string(scored.select(*keep, roles.score), roles), "scores")
    ranked = rank_within_query(narrow, roles, roles.rank)
    seen, observation = checks.observed(ranked, [], roles)
    tables.write_versioned(seen, path, fixed, [roles.time])
    found = {c: n for c, n in observation.get.items() if c not in ("unknown_items", "incomplete")}
    if failed := {c: found[c] for c in ("nulls", "repeated", "rank_order") if found[c]}:
        raise ValueError(f"scores of {path}: {failed}")
    return tables.read_versioned(spark, path, fixed), found


def publish(spark: SparkSession, scored: DataFrame, staging: str, production: str, declared: list[str], expected_rows: int, version: str, roles: Roles = ROLES) -> DataFrame:
    """Rank into staging, then write production once; failing checks raise and leave production untouched.

    The checks are observed while staging is written: the scores are read once, and
    what landed is read for production alone. A score that is the same over a whole
    query is no failure.
    """
    ranked, observation = checks.observed(rank_within_query(scored, roles, roles.rank), declared, roles)
    tables.write_versioned(ranked, staging, {"version": version}, [roles.time])
    seen = observation.get
    failed = {c: seen[c] for c in ("nulls", "unknown_items", "incomplete", "repeated", "rank_order") if seen[c]}
    if seen["rows"] != expected_rows:
        failed["row_difference"] = seen["rows"] - expected_rows
    if failed:
        raise ValueError(f"not published: {failed}")
    tables.write_versioned(tables.read_versioned(spark, staging, {"version": version}), production, {"version": version}, [roles.time])
    return tables.read_versioned(spark, production, {"version": version})
