"""Stable buckets: draws that depend on a row's key alone, alike on every run and cluster."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SCALE = 100_000


def _text(df: DataFrame, name: str) -> Column:
    kind = dict(df.dtypes)[name]
    if kind in ("date", "timestamp", "timestamp_ntz"):
        return F.date_format(name, "yyyy-MM-dd HH:mm:ss")
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def stable_bucket(df: DataFrame, columns: list[str], n: int = SCALE, site: str = "", seed: int = 0, hash: str = "crc32") -> Column:
    """``hash(col1|col2|site|seed) mod n``; ``site`` names the draw, so that draws of different sites are independent."""
    key = F.concat_ws("|", *(_text(df, c) for c in columns), F.lit(site), F.lit(str(seed)))
    if hash == "crc32":
        return F.crc32(key.cast("binary")) % n
    return F.conv(F.substring(F.md5(key.cast("binary")), 1, 8), 16, 10).cast("long") % n


def threshold(ratio: float | Column, rounding: str = "floor") -> Column:
    """Buckets of SCALE that a ratio keeps: cut for rows, rounded for entities."""
    value = (ratio if isinstance(ratio, Column) else F.lit(float(ratio))) * SCALE
    return (F.floor(value) if rounding == "floor" else F.round(value)).cast("long")
