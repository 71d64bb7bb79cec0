"""Registration of named queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from regionledger.registry import ctes

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def portable(df: DataFrame, digits: int = 4) -> DataFrame:
    """Decimals and doubles as rounded doubles, the form both engines can compare.

    Exact halves are common (cents over small counts) and the engines round them
    apart, so both sides shift by ``ctes.TIE_SHIFT`` before rounding.
    """
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DecimalType, T.DoubleType, T.FloatType)):
            c = F.round(c.cast("double") + ctes.TIE_SHIFT, digits)
        out.append(c.alias(f.name))
    return df.select(out)


def query(name: str, sql: str | None = None, *doubles: str):
    """Register a query; ``doubles`` are the fractional columns of its SQL twin."""

    def register(fn: Callable[[SparkSession, str], DataFrame]) -> Query:
        def run(spark: SparkSession, d: str) -> DataFrame:
            return portable(fn(spark, d))

        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = ctes.with_ctes(ctes.rounded(sql, *doubles) if doubles else sql)
        return run

    return register
