"""Sorting, limits and sampling."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def sorted_output(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.orderBy(*keys)


def top_k(df: DataFrame, measure: str, tie: list[str], k: int) -> DataFrame:
    """k largest rows; the plan keeps k rows per task and merges them."""
    return df.orderBy(F.desc_nulls_last(measure), *tie).limit(k)


def top_k_abs(df: DataFrame, measure: str, tie: list[str], k: int) -> DataFrame:
    return df.orderBy(F.desc_nulls_last(F.abs(measure)), *tie).limit(k)


def seeded_sample(df: DataFrame, key: list[str], rows: int, seed: int = 42) -> DataFrame:
    """Repeatable sample of at most ``rows`` rows, independent of partitioning."""
    return df.orderBy(F.md5(F.concat_ws("|", *key, F.lit(str(seed)))), *key).limit(rows)
