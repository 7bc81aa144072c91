"""Projections and filters."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..roles import ROLES, Roles

UNKNOWN_CODE = -1
FLOATS = ("double", "decimal")


def months_in_as_date(column: str, dates: Iterable[str]) -> Column:
    """``to_date(column) IN dates``, whatever the column's type; no dates select nothing."""
    dates = list(dates)
    return F.to_date(F.col(column)).isin(*(F.to_date(F.lit(d)) for d in dates)) if dates else F.lit(False)


def restrict_to_months(df: DataFrame, dates: Iterable[str], roles: Roles = ROLES) -> DataFrame:
    return df.where(months_in_as_date(roles.time, dates))


def restrict_to_months_or_all(df: DataFrame, dates: Iterable[str], roles: Roles = ROLES) -> DataFrame:
    dates = list(dates)
    return restrict_to_months(df, dates, roles) if dates else df


def require_rows(df: DataFrame, what: str, known: DataFrame | None = None) -> DataFrame:
    """The frame itself; raises if it is empty, naming up to ten of the values there are."""
    if df.isEmpty():
        seen = [tuple(r) for r in known.distinct().limit(10).collect()] if known is not None else []
        raise ValueError(f"no rows for {what}; there are {seen}")
    return df


def key_columns(group: Iterable[str], carry: Iterable[str] = (), roles: Roles = ROLES) -> list[str]:
    """Columns that sampling needs: strata, identity, carried ones, each once."""
    return list(dict.fromkeys([*group, *roles.identity, *carry]))


def feature_columns(df: DataFrame, categorical: Iterable[str], drop: Iterable[str] = (), roles: Roles = ROLES) -> list[str]:
    """Identity columns that are categorical first, then every column that isn't dropped, identity or label."""
    categorical, drop = set(categorical), {*drop}
    head = [c for c in roles.identity if c in categorical]
    return head + [c for c in df.columns if c not in drop and c not in roles.identity and c != roles.label]


def split_categoricals(categorical: Iterable[str], declared: dict[str, list[str]]) -> tuple[list[str], list[str]]:
    """Categoricals whose values come from the data, and those whose values are declared."""
    categorical = list(categorical)
    return [c for c in categorical if c not in declared], [c for c in categorical if c in declared]


def encodable_categoricals(df: DataFrame, categorical: Iterable[str], roles: Roles = ROLES) -> list[str]:
    return [c for c in categorical if c in df.columns and c not in roles.identity]


def model_input_columns(features: Iterable[str], carry: Iterable[str] = (), roles: Roles = ROLES) -> list[str]:
    return list(dict.fromkeys([*roles.identity, roles.label, *features, *carry]))


def select_features(features: Iterable[str], include: Iterable[str] | None = None, exclude: Iterable[str] = ()) -> list[str]:
    """A subset of the features in their own order; unknown names fail."""
    features = list(features)
    if stray := ({*(include or ())} | {*exclude}) - {*features}:
        raise ValueError(f"not features: {sorted(stray)}")
    return [f for f in features if (include is None or f in set(include)) and f not in set(exclude)]


def cast_float_features(df: DataFrame, features: Iterable[str], roles: Roles = ROLES) -> DataFrame:
    """Double and decimal features as float; identity and label stay as they are."""
    kinds = dict(df.dtypes)
    cast = {c: F.col(c).cast("float") for c in features if kinds[c].startswith(FLOATS) and c not in (*roles.identity, roles.label)}
    return df.withColumns(cast) if cast else df


def drop_keeping_identity(df: DataFrame, columns: Iterable[str], roles: Roles = ROLES) -> DataFrame:
    return df.drop(*(c for c in columns if c not in roles.identity))


def time_as_partition_string(df: DataFrame, roles: Roles = ROLES) -> DataFrame:
    return df.withColumn(roles.time, F.col(roles.time).cast("date").cast("string"))


def score_to_logit(df: DataFrame, column: str, eps: float = 1e-6) -> DataFrame:
    """Log-odds of a score clipped to eps; all scores stay as they are if any is outside 0 to 1."""
    span = F.broadcast(df.agg((F.coalesce(F.min(column), F.lit(0)) >= 0).alias("lo"), (F.coalesce(F.max(column), F.lit(0)) <= 1).alias("hi")))
    p = F.greatest(F.least(F.col(column), F.lit(1 - eps)), F.lit(eps))
    return df.crossJoin(span).withColumn("logit", F.when(F.col("lo") & F.col("hi"), F.ln(p / (1 - p))).otherwise(F.col(column))).drop("lo", "hi")
