"""Dataset flows: fit and apply a preprocessor, assemble model inputs."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import encode, filters, joins
from ..roles import ROLES, Roles
from ..sources import layout, tables
from .partitions import require_unique


@dataclass(frozen=True)
class Preprocessor:
    """A fitted vocabulary and the feature list."""

    vocab: DataFrame
    categorical: tuple[str, ...]
    features: tuple[str, ...]


def required_months(df: DataFrame, months: Iterable[str], roles: Roles = ROLES) -> DataFrame:
    """``month``: wanted months that the frame lacks."""
    wanted = df.sparkSession.createDataFrame([(m,) for m in months], "month string").select(F.to_date("month").alias("month"))
    return wanted.join(df.select(F.to_date(roles.time).alias("month")).distinct(), "month", "left_anti")


def require_columns(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    if missing := [c for c in columns if c not in df.columns]:
        raise ValueError(f"missing columns: {missing}")
    return df


def fit_preprocessor(features: DataFrame, train_months: Iterable[str], categorical: Iterable[str], declared: dict[str, list[str]], roles: Roles = ROLES) -> Preprocessor:
    """Vocabularies from the training months alone, declared ones as given; fails if a training month is missing."""
    train_months, categorical = list(train_months), list(categorical)
    absent = [str(r.month) for r in required_months(features, train_months, roles).collect()]
    if absent:
        raise ValueError(f"months not in the feature table: {absent}")
    from_data, from_config = filters.split_categoricals(categorical, declared)
    own = encode.declared_vocabulary(features, {c: declared[c] for c in from_config})
    train = filters.restrict_to_months(features, train_months, roles)
    if found := [c for c in from_data if c in features.columns]:
        own = own.unionByName(encode.vocabulary(train, found))
    names = filters.feature_columns(features, categorical, (), roles)
    if roles.item not in names:
        raise ValueError(f"{roles.item} is not a feature: it must be categorical")
    return Preprocessor(own, tuple(categorical), tuple(names))


def apply_preprocessor(features: DataFrame, fitted: Preprocessor, months: Iterable[str], roles: Roles = ROLES) -> DataFrame:
    """Encoded features of the months; none give an empty frame of the same columns."""
    kept = filters.restrict_to_months(features, months, roles)
    wanted = [c for c in fitted.features if c in features.columns and c not in roles.identity]
    kept = kept.select(*roles.query, *wanted)
    return encode.encode_categoricals(kept, filters.encodable_categoricals(kept, fitted.categorical, roles), fitted.vocab)


def build_model_input(keys: DataFrame, labels: DataFrame, features: DataFrame, feature_names: Iterable[str], carry: Iterable[str] = (), roles: Roles = ROLES) -> DataFrame:
    """Keys with labels (a miss is 0) and features (a miss is null), floats narrowed.

    As many rows as keys: the job fails if labels or features repeat a key of theirs.
    """
    require_columns(keys, [*roles.identity, *carry])
    labels, features = require_unique(labels, roles.identity), require_unique(features, roles.query)
    names = [f for f in feature_names if f not in roles.identity]
    joined = joins.join_features(joins.join_labels(keys.select(*roles.identity, *carry), labels, roles), features, roles)
    return filters.cast_float_features(joined.select(*filters.model_input_columns(names, carry, roles)), names, roles)


def write_model_input(spark: SparkSession, keys: str, labels: str, features: str, feature_names: Iterable[str], path: str, fixed: dict[str, object], carry: Iterable[str] = (), months: Iterable[str] = (), roles: Roles = ROLES) -> DataFrame:
    """Model input from three catalog tables that :func:`layout.write_bucketed` made, written by month in files of even size and read back.

    Labels and features are joined bucket by bucket, without an exchange of either; the
    finished rows are dealt out once, for the write.
    """
    with layout.co_located(spark):
        own = filters.restrict_to_months_or_all(spark.table(keys), list(months), roles)
        built = build_model_input(own, spark.table(labels), spark.table(features), feature_names, carry, roles)
        tables.write_versioned(filters.time_as_partition_string(built, roles), path, fixed, [roles.time], balance=True)
    return tables.read_versioned(spark, path, fixed)
