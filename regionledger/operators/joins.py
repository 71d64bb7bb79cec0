"""Join shapes.

No broadcast hints: every lookup is left to Spark's own size check (table
statistics at planning, real shuffle sizes under AQE), with the sort-merge join
as the way beyond it. Null keys never match and are dropped where the source
treated them as matching.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def full_outer(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Full outer join with one coalesced copy of each key."""
    return left.join(right, keys, "full_outer")


def lookup(df: DataFrame, ref: DataFrame, keys: list[str]) -> DataFrame:
    return df.join(ref, keys, "left")


def lookup_with_fallback(
    df: DataFrame, ref: DataFrame, key: str, label: str, name: str
) -> DataFrame:
    """Label from the reference, the code itself where there is none."""
    found = df.join(ref.select(key, F.col(label).alias("__label")), key, "left")
    return found.withColumn(name, F.coalesce("__label", key)).drop("__label")


def many_to_one(df: DataFrame, ref: DataFrame, keys: list[str]) -> DataFrame:
    """Left join whose right side must be unique; a repeated key fails the job.

    The check rides on the join itself: the right side's keys are counted (the keys only, by
    hash), a count above one raises, and the right side is joined to its counted keys, which
    shares the exchange on the keys with the join.
    """
    counted = (
        ref.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
        .where(
            F.when(F.col("__n") == 1, F.lit(True)).otherwise(
                F.raise_error(F.lit(f"right side repeats its key {keys}")).cast("boolean")
            )
        )
        .drop("__n")
    )
    return df.join(ref.join(counted, keys), keys, "left")


def qualifying(df: DataFrame, groups: DataFrame, keys: list[str]) -> DataFrame:
    return df.join(groups, keys, "left_semi")


def unmatched(df: DataFrame, ref: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct non-null keys of ``df`` that the reference does not hold."""
    wanted = df.select(*keys).dropna(subset=keys).distinct()
    return wanted.join(ref.select(*keys).dropna(subset=keys), keys, "left_anti")


def compare(left: DataFrame, right: DataFrame, keys: list[str], suffixes: tuple[str, str]) -> DataFrame:
    """Full outer join with shared measures told apart by suffix."""
    shared = [c for c in left.columns if c in right.columns and c not in keys]
    a = left.withColumnsRenamed({c: c + suffixes[0] for c in shared})
    b = right.withColumnsRenamed({c: c + suffixes[1] for c in shared})
    return a.join(b, keys, "full_outer")


def on_differing_names(df: DataFrame, ref: DataFrame, pairs: list[tuple[str, str]]) -> DataFrame:
    """Left join on differently named composite keys; right key columns are kept."""
    return df.join(ref, [F.col(a) == F.col(b) for a, b in pairs], "left")


def chain(base: DataFrame, others: list[DataFrame | None], keys: list[str]) -> DataFrame:
    for other in others:
        if other is not None:
            base = base.join(other, keys, "left")
    return base


def marked(df: DataFrame, ref: DataFrame, keys: list[str], marker: str = "matched") -> DataFrame:
    """Left join with a true/false match marker."""
    out = df.join(ref.withColumn(marker, F.lit(True)), keys, "left")
    return out.withColumn(marker, F.coalesce(F.col(marker), F.lit(False)))


def match_rate(df: DataFrame, marker: str = "matched") -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("row_cnt"),
        F.count_if(F.col(marker)).alias("matched_cnt"),
        F.try_divide(F.count_if(F.col(marker)), F.count(F.lit(1))).alias("match_rate"),
    )
