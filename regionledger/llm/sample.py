"""Bounded samples for fitting models."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def smallest_hashes(df: DataFrame, key: str, rows: int, salt: int = 0) -> DataFrame:
    """At most `rows` rows: those whose hash of `key` is smallest, ties by the key itself.

    From a large table only the share that is likely needed is ordered at all, so what tasks send for
    the final order does not grow with their number.
    """
    h = F.xxhash64(F.lit(salt), key)
    n = df.count()
    if n > 4 * rows:
        df = df.where(F.pmod(h, F.lit(1 << 40)) < int(2 * rows / n * (1 << 40)))
    return df.orderBy(F.pmod(h, F.lit(1 << 40)), key).limit(rows)
