"""Unions, generated rows, set differences and gaps."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from regionledger import schemas as S
from regionledger.operators import aggregates
from regionledger.sources.literals import literal


def stack(frames: list[DataFrame], allow_missing: bool = False) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), frames)


def append_rows(df: DataFrame, rows: list[tuple], ddl: str) -> DataFrame:
    """Append a short literal list; columns it does not give are null."""
    extra = literal(df.sparkSession, rows, ddl)
    return df.unionByName(extra, allowMissingColumns=True)


def append_absent(df: DataFrame, extra: DataFrame, keys: list[str]) -> DataFrame:
    """Append only the extra rows whose key the table does not hold."""
    return df.unionByName(extra.join(df.select(*keys), keys, "left_anti"), allowMissingColumns=True)


def state_rollup_rows(states: DataFrame) -> DataFrame:
    """Statewide (``ss000``) and unspecified (``ss999``) reference rows per state."""
    variants = F.array(
        F.struct(F.lit(S.STATEWIDE_SUFFIX).alias("sfx"), F.lit(" (statewide aggregation)").alias("txt")),
        F.struct(F.lit(S.UNSPECIFIED_SUFFIX).alias("sfx"), F.lit(" (unspecified county)").alias("txt")),
    )
    return states.select("state_fips_cd", "state_cd", "state_nm", F.inline(variants)).select(
        F.concat("state_fips_cd", "sfx").alias("state_cnty_fips_cd"),
        "state_cd",
        F.concat("state_nm", "txt").alias("cnty_nm"),
    )


def state_table(spark: SparkSession) -> DataFrame:
    return literal(spark, S.STATES, "state_fips_cd string, state_cd string, state_nm string")


def unexpected(df: DataFrame, allowed: DataFrame, column: str) -> DataFrame:
    """Distinct values of a column outside the allowed list."""
    present = df.select(column).dropna().distinct()
    return present.join(allowed.select(column), column, "left_anti")


def gaps(df: DataFrame, column: str) -> DataFrame:
    """Integers missing between the smallest and the largest value present.

    One lazy plan: the two ends are cut into blocks, and the blocks are counted out by
    the cluster, so long series are as good as a handful of years.
    """
    kind = df.schema[column].dataType
    block = 1_000_000
    ends = df.agg(F.min(column).cast("long").alias("lo"), F.max(column).cast("long").alias("hi")).where("lo IS NOT NULL")
    blocks = ends.withColumn("b", F.explode(F.sequence(F.floor(F.col("lo") / block), F.floor(F.col("hi") / block))))
    first, last = F.col("b") * block, (F.col("b") + 1) * block - 1
    full = blocks.repartition("b").select(
        F.explode(F.sequence(F.greatest("lo", first), F.least("hi", last))).alias("id")
    )
    return full.select(F.col("id").cast(kind).alias(column)).join(
        df.select(column).dropna(), column, "left_anti"
    )


def with_overrides(base: DataFrame, overrides: DataFrame, keys: list[str]) -> DataFrame:
    """Union in which an override row replaces the base row of the same key.

    Of several overrides of a key the one with the smallest values wins.
    """
    both = base.withColumn("__p", F.lit(1)).unionByName(
        overrides.withColumn("__p", F.lit(0)), allowMissingColumns=True
    )
    return aggregates.keep_one(both, keys, [F.col("__p")]).drop("__p")
