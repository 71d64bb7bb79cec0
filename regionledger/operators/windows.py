"""Window measures.

Partitions are county or state x sector x year groups of the fact grain, whose
size is bounded by the code lists, so none of these windows can meet a hot key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from regionledger.functions import exprs
from regionledger.sources import scratch

PREVIOUS_YEARS = (Window.unboundedPreceding, -1)


def previous(measure: str, keys: list[str], order: str = "year_num") -> Column:
    """Value of the previous present row of the same key."""
    return F.lag(measure).over(Window.partitionBy(*keys).orderBy(order))


def previous_group_total(total: str, keys: list[str], order: str = "year_num") -> Column:
    """Previous year's group total, read from rows that repeat their own year's total.

    The frame holds all rows of earlier years; its last row carries the total of
    the latest earlier year, whichever of that year's rows it is. This lags at the
    total's own grain without a second aggregate or a join back.
    """
    frame = Window.partitionBy(*keys).orderBy(order).rangeBetween(*PREVIOUS_YEARS)
    return F.last(total).over(frame)


def group_sum(measure: str, keys: list[str]) -> Column:
    return F.sum(exprs.fill_zero(F.col(measure))).over(Window.partitionBy(*keys))


def share(measure: str, total: str) -> Column:
    return exprs.safe_ratio(F.col(measure).cast("double"), F.col(total).cast("double"))


def concentration(share_column: str, keys: list[str]) -> Column:
    """Sum of squared shares (Herfindahl index)."""
    return F.sum(F.pow(share_column, F.lit(2.0))).over(Window.partitionBy(*keys))


def rank_desc(measure: str, keys: list[str]) -> Column:
    order = Window.partitionBy(*keys).orderBy(F.desc_nulls_last(measure))
    return F.rank().over(order).cast("bigint")


def top_per_group(df: DataFrame, group: str, measure: str, tie: list[str], n: int) -> DataFrame:
    """n largest rows per group. Spark cuts each map task to n rows before the shuffle."""
    order = Window.partitionBy(group).orderBy(F.desc(measure), *tie)
    return (
        df.where(F.col(measure).isNotNull())
        .withColumn("rank_num", F.row_number().over(order))
        .where(F.col("rank_num") <= n)
    )


def global_row_number(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """Row number over the whole table without gathering it in one task.

    Rows are range-partitioned on the full order (so equal leading values still
    split; ``order`` should be unique, as rows that tie on all of it share a range) and numbered
    within their range; the ranges are then shifted by the row
    counts before them. The numbered rows are written once to shared storage:
    recomputing a range partition after an executor loss must not renumber it.
    """
    return _numbered(df, order, name)[0]


def _numbered(df: DataFrame, order: list[str], name: str) -> tuple[DataFrame, DataFrame]:
    """The numbered rows, and their stored copy."""
    numbered = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("__id", F.monotonically_increasing_id())
    )
    stored = scratch.materialise(numbered)
    part = F.shiftright("__id", 33)
    local = F.col("__id").bitwiseAND(F.lit((1 << 33) - 1))
    # One row per shuffle partition.
    sizes = stored.groupBy(part.alias("__part")).agg(F.count(F.lit(1)).alias("__n"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__offset")
    )
    return (
        stored.withColumn("__part", part)
        .join(F.broadcast(offsets), "__part")
        .withColumn(name, F.col("__offset") + local + 1)
        .drop("__id", "__part", "__offset")
    ), stored


def percentile_bin(df: DataFrame, measure: str, tie: list[str], name: str) -> DataFrame:
    """Bins 0..99 of the first-tie rank, cut at 100 equal quantiles of that rank.

    A null has no rank: only the others are numbered and counted, and its bin is null.
    """
    numbered, stored = _numbered(df.where(F.col(measure).isNotNull()), [measure, *tie], "__rn")
    # Counted on the stored copy, which needs no column of it.
    n = stored.agg(F.count(F.lit(1))).scalar()
    cut = F.expr("((__rn - 1) * 100 + __n - 2) div nullif(__n - 1, 0) - 1")
    binned = (
        numbered.withColumn("__n", n)
        .withColumn(name, F.greatest(F.coalesce(cut, F.lit(0)), F.lit(0)).cast("int"))
        .drop("__rn", "__n")
    )
    return binned.unionByName(df.where(F.col(measure).isNull()).withColumn(name, F.lit(None).cast("int")))


def z_scores(df: DataFrame, measure: str, name: str = "z") -> DataFrame:
    """Distance from the column mean in population deviations (two scalars, no window)."""
    stats = df.agg(F.avg(measure).alias("m"), F.stddev_pop(measure).alias("s"))
    mean, dev = stats.select("m").scalar(), stats.select("s").scalar()
    return df.where(F.col(measure).isNotNull()).withColumn(
        name, exprs.safe_ratio(F.col(measure) - mean, dev)
    )


def with_year_over_year(df: DataFrame, measures: dict[str, str]) -> DataFrame:
    """Relative change against the previous row of a one-row-per-year table."""
    w = Window.orderBy("year_num")
    before = {src: F.lag(src).over(w).cast("double") for src in measures}
    changes = [
        exprs.safe_ratio(F.col(src).cast("double") - before[src], before[src]).alias(dst)
        for src, dst in measures.items()
    ]
    return df.select("*", F.lag("year_num").over(w).alias("prev_year_num"), *changes)


def year_over_year(df: DataFrame, measures: dict[str, str]) -> DataFrame:
    """Only the changes, for years that have a previous one."""
    out = with_year_over_year(df, measures).where(F.col("prev_year_num").isNotNull())
    return out.select("year_num", *measures.values())
