"""Joins of keys, labels, features and overrides. Small sides are left to Spark to broadcast by their size."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..roles import ROLES, Roles


def join_labels(keys: DataFrame, labels: DataFrame, roles: Roles = ROLES) -> DataFrame:
    """Label table joined on identity; a miss is a negative."""
    own = labels.select(*roles.identity, roles.label)
    return keys.drop(roles.label).join(own, roles.identity, "left").withColumn(roles.label, F.coalesce(roles.label, F.lit(0)).cast("int"))


def join_features(keys: DataFrame, features: DataFrame, roles: Roles = ROLES) -> DataFrame:
    """Features joined on the query; a miss is null, and no key is lost."""
    return keys.join(features, roles.query, "left")


def join_population(members: DataFrame, features: DataFrame, roles: Roles = ROLES) -> DataFrame:
    """All members, with features where there are any."""
    return members.select(*roles.query).distinct().join(features, roles.query, "left")


def population_coverage(members: DataFrame, features: DataFrame, roles: Roles = ROLES) -> DataFrame:
    """``time, members, without_features``."""
    have = features.select(*roles.query).distinct().withColumn("have", F.lit(1))
    joined = members.select(*roles.query).distinct().join(have, roles.query, "left")
    return joined.groupBy(roles.time).agg(F.count("*").alias("members"), F.sum(F.col("have").isNull().cast("long")).alias("without_features"))


def override_join(df: DataFrame, keys: Iterable[str], overrides: dict[str, float], default: float, name: str) -> DataFrame:
    """``name``: the override of the row's ``a|b|c`` key, or the default."""
    if not overrides:
        return df.withColumn(name, F.lit(float(default)))
    table = df.sparkSession.createDataFrame(list(overrides.items()), f"__key string, {name} double")
    key = F.concat_ws("|", *(F.col(k).cast("string") for k in keys))
    joined = df.drop(name).withColumn("__key", key).join(F.broadcast(table), "__key", "left")  # the overrides came from the driver
    return joined.withColumn(name, F.coalesce(name, F.lit(float(default)))).drop("__key")


def code_weights(overrides: dict[str, float], keys: list[str], vocabularies: dict[str, list[str]]) -> dict[str, float]:
    """Overrides keyed by values, keyed by codes instead for the ``keys`` that are encoded; a key with an unknown value goes."""
    code = {k: {v: i for i, v in enumerate(values)} for k, values in vocabularies.items()}
    out = {}
    for composite, weight in overrides.items():
        parts = composite.split("|")
        coded = [str(code[k].get(p, "")) if k in code else p for k, p in zip(keys, parts, strict=True)]
        if all(coded):
            out["|".join(coded)] = weight
    return out


def unmatched_keys(df: DataFrame, keys: Iterable[str], configured: Iterable[str]) -> DataFrame:
    """``key``: configured composite keys that no row has."""
    spark = df.sparkSession
    wanted = spark.createDataFrame([(k,) for k in configured], "key string")
    return wanted.join(df.select(F.concat_ws("|", *(F.col(k).cast("string") for k in keys)).alias("key")).distinct(), "key", "left_anti")


def keep_entities(df: DataFrame, entities: DataFrame, roles: Roles = ROLES) -> DataFrame:
    return df.join(entities, list(roles.entity), "left_semi")


def join_segments(df: DataFrame, source: DataFrame, keys: list[str], segment: str) -> DataFrame:
    """One segment per key, the smallest where a key has several; an existing column of that name is replaced."""
    if missing := {*keys, segment} - {*source.columns}:
        raise ValueError(f"segment source lacks {sorted(missing)}")
    own = source.groupBy(*keys).agg(F.min(segment).alias(segment))
    return df.drop(segment).join(own, keys, "left")


def join_predictions(predictions: DataFrame, labels: DataFrame, roles: Roles = ROLES) -> DataFrame:
    """Every prediction with its label; a label column of the predictions wins over the table."""
    return predictions if roles.label in predictions.columns else join_labels(predictions, labels, roles)


def union_by_name(parts: Iterable[DataFrame]) -> DataFrame:
    parts = list(parts)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
