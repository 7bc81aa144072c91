"""Masks for identifiers in text columns, and a scan that fails closed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def mask_identifiers(text: Column, pattern: str, keep: int = 0, sign: str = "*") -> Column:
    """Each match as a mask of its own length, but for its first ``keep`` characters.

    The text is split at the matches and put together again, so each match is masked once, where it stands.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    hidden = F.transform(found, lambda m: F.concat(F.substring(m, 1, keep) if keep else F.lit(""), F.repeat(F.lit(sign), F.greatest(F.length(m) - keep, F.lit(0)))))
    pairs = F.transform(F.arrays_zip(gaps.alias("g"), hidden.alias("h")), lambda p: F.concat(p["g"], F.coalesce(p["h"], F.lit(""))))
    return F.array_join(pairs, "")


def residual_scan(df: DataFrame, text: str, patterns: dict[str, str]) -> DataFrame:
    """``name, rows, hits`` of what still matches; a caller publishes only if every count is 0."""
    aggs = []
    for name, p in patterns.items():
        hits = F.regexp_count(F.col(text), F.lit(p))
        aggs += [F.sum(hits).alias(f"{name} hits"), F.sum((hits > 0).cast("long")).alias(f"{name} rows")]
    one = df.agg(*aggs)
    rows = [F.struct(F.lit(n).alias("name"), F.coalesce(F.col(f"`{n} rows`"), F.lit(0)).alias("rows"), F.coalesce(F.col(f"`{n} hits`"), F.lit(0)).alias("hits")) for n in patterns]
    return one.select(F.explode(F.array(*rows)).alias("x")).select("x.*")


def require_clean(df: DataFrame, text: str, patterns: dict[str, str]) -> DataFrame:
    left = [r.name for r in residual_scan(df, text, patterns).where("hits > 0").collect()]
    if left:
        raise ValueError(f"identifiers left: {left}")
    return df
