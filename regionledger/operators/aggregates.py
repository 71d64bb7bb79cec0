"""Grouped and global aggregates."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from regionledger.functions import exprs
from regionledger.sources import scratch


def sum_or_zero(c) -> Column:
    """SUM whose all-null group is 0."""
    return F.coalesce(F.sum(c), F.lit(0))


def sum_or_null(c) -> Column:
    """SUM whose all-null group is null."""
    return F.sum(c)


def weekly_wage(wages: Column, employment: Column) -> Column:
    """Wages per employee and week from summed parts, null without employment."""
    return F.when(employment > 0, wages / (employment * 52))


def keep_one(df: DataFrame, keys: list[str], priority: list[Column]) -> DataFrame:
    """One row per key: the one with the lowest priority value, then the smallest other values.

    A ``min_by`` aggregate combines on the map side, so a key that holds a large
    part of all rows never lands whole in one task, as it would under a window. It sorts
    its input by key there (rows of any type have no hash aggregate).
    """
    rest = [c for c in df.columns if c not in keys]
    ties = [f.name for f in df.schema.fields if f.name in rest and not isinstance(f.dataType, (T.MapType, T.VariantType))]
    picked = df.groupBy(*keys).agg(
        F.min_by(F.struct(*rest), F.struct(*priority, *ties)).alias("__row")
    )
    return picked.select(*keys, *[F.col("__row")[c].alias(c) for c in rest]).select(df.columns)


def groups_at_least(df: DataFrame, keys: list[str], measure: str, threshold) -> DataFrame:
    """Keys whose largest value reaches the threshold."""
    top = df.groupBy(*keys).agg(F.max(measure).alias("__top"))
    return top.where(F.col("__top") >= threshold).select(*keys)


def duplicate_groups(df: DataFrame, keys: list[str], limit: int = 50) -> DataFrame:
    """The most repeated keys with their counts (a report of at most ``limit`` keys)."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_cnt"))
    return (
        counts.where(F.col("row_cnt") > 1)
        .orderBy(F.desc("row_cnt"), *keys)
        .limit(limit)
    )


def null_rate(c) -> Column:
    return F.try_divide(F.count_if(F.col(c).isNull()) * F.lit(100.0), F.count(F.lit(1)))


def coverage_by_year(df: DataFrame) -> DataFrame:
    return df.groupBy("year_num").agg(
        F.count(F.lit(1)).alias("row_cnt"),
        F.countDistinct("state_cnty_fips_cd").alias("county_cnt"),
        F.countDistinct("naics2_sector_cd").alias("sector_cnt"),
    )


def value_counts(df: DataFrame, column: str, k: int) -> DataFrame:
    """The k most frequent values with their share of non-null rows."""
    counts = (
        df.where(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("value"))
        .agg(F.count(F.lit(1)).alias("freq"))
    )
    total = counts.agg(F.sum("freq")).scalar()
    return (
        counts.orderBy(F.desc("freq"), "value")
        .limit(k)
        .withColumn("pct", F.try_divide(F.col("freq") * F.lit(100.0), total))
    )


def levels(df: DataFrame, county: list[str], state: list[str], nation: list[str], measure: str) -> DataFrame:
    """County, state and national sums in one pass, tagged by level.

    The input is reduced to its finest grain first, so the expansion into three
    grouping sets multiplies pre-aggregated rows, not raw ones.
    """
    finest = df.groupBy(*county).agg(F.sum(measure).alias(measure))
    dims = [F.col(c) for c in county]
    sets = [[F.col(c) for c in level] for level in (county, state, nation)]
    mark = {len(county) - len(level): name
            for level, name in ((county, "county"), (state, "state"), (nation, "national"))}
    lost = reduce(lambda a, b: a + b, [F.grouping(c).cast("int") for c in county])
    tag = F.create_map(*[F.lit(x) for kv in mark.items() for x in kv])
    return (
        finest.groupingSets(sets, *dims)
        .agg(F.sum(measure).alias(measure), lost.alias("__lost"))
        .withColumn("level", tag[F.col("__lost")])
        .drop("__lost")
    )


def moments(df: DataFrame, column: str) -> DataFrame:
    c = F.col(column)
    return df.agg(
        F.count(c).alias("value_cnt"),
        F.avg(c).alias("mean"),
        F.stddev_pop(c).alias("std_pop"),
        F.stddev_samp(c).alias("std_samp"),
        F.min(c).alias("min"),
        F.max(c).alias("max"),
    )


def pairwise_corr(df: DataFrame, a: str, b: str) -> DataFrame:
    both = df.dropna(subset=[a, b])
    return both.agg(F.count(F.lit(1)).alias("pair_cnt"), F.corr(a, b).alias("corr"))


def exact_quantiles(
    long: DataFrame, name: str, value: str, probs: list[float], accuracy: int = 10000
) -> DataFrame:
    """Exact, linearly interpolated quantiles per named measure, spread over the cluster.

    The built-in exact percentile keeps every distinct value of a group in one
    buffer. Here a sketch brackets each wanted rank, at any number of values; rows outside the
    brackets are only counted, in the map tasks, with the nearest value on either side, and
    only values inside (a share of about 10/accuracy) are grouped. Their ranks come
    from a range partitioning on measure and value, so a large bracket is ranked by many tasks.
    ``name`` holds one value per column of the profiled table, so the broadcast
    tables are bounded by the width of a schema.

    Returns one row per measure: ``name, value_cnt, quantiles array<double>``.
    """
    rows = long.where(F.col(value).isNotNull()).select(
        F.col(name).alias("m"), F.col(value).cast("double").alias("v")
    )
    slack = 5.0 / accuracy
    brackets = scratch.materialise(rows.groupBy("m").agg(
        F.count(F.lit(1)).alias("value_cnt"),
        F.percentile_approx("v", [max(0.0, p - slack) for p in probs], accuracy).alias("lo"),
        F.percentile_approx("v", [min(1.0, p + slack) for p in probs], accuracy).alias("hi"),
    ))
    placed = rows.join(F.broadcast(brackets), "m")

    def edges(i: int) -> Column:
        lower, upper = F.col("v") < F.col("lo")[i], F.col("v") > F.col("hi")[i]
        return F.struct(
            F.lit(i).alias("i"), F.lit(probs[i]).alias("p"), F.count_if(lower).alias("below"),
            F.max(F.when(lower, F.col("v"))).alias("prev"), F.min(F.when(upper, F.col("v"))).alias("next"),
        )

    around = placed.groupBy("m").agg(
        F.first("value_cnt").alias("value_cnt"), F.array(*[edges(i) for i in range(len(probs))]).alias("e")
    ).select("m", "value_cnt", F.inline("e"))
    hits = F.array(*[
        F.when(F.col("v").between(F.col("lo")[i], F.col("hi")[i]), F.lit(i)) for i in range(len(probs))
    ])
    near = (
        placed.select("m", "v", F.explode(F.filter(hits, lambda x: x.isNotNull())).alias("i"))
        .groupBy("m", "i", "v").agg(F.count(F.lit(1)).alias("n"))
    )
    ranked = _running_count(near, ["m", "i"], "v", "n")
    position = F.col("p") * (F.col("value_cnt") - 1)
    k = F.floor(position)

    def value_at(rank: Column) -> Column:
        first = F.col("below") + F.col("upto") - F.col("n")
        return F.max(F.when((first <= rank) & (rank < first + F.col("n")), F.col("v")))

    after = F.least(k + 1, F.col("value_cnt") - 1)
    ends = ranked.join(F.broadcast(around), ["m", "i"]).groupBy("m", "i", "value_cnt", "p", "below", "prev", "next").agg(
        value_at(k).alias("a"), value_at(after).alias("b")
    )
    # A neighbour just outside the bracket is the nearest value there.
    outside = lambda rank: F.when(rank < F.col("below"), F.col("prev")).otherwise(F.col("next"))
    a, b = F.coalesce("a", outside(k)), F.coalesce("b", outside(after))
    point = F.struct("i", (a + (b - a) * (position - k)).alias("q"))
    return ends.groupBy(F.col("m").alias(name), "value_cnt").agg(
        F.transform(F.array_sort(F.collect_list(point)), lambda x: x["q"]).alias("quantiles")
    )


def _running_count(df: DataFrame, keys: list[str], order: str, count: str) -> DataFrame:
    """``upto``: the sum of ``count`` over rows of the key up to this one, by ``order`` (unique per key).

    Rows are range-partitioned on key and order, summed up inside their range and shifted by the
    ranges before, so one key's rows need not meet in one task. The partitioning is stored
    once: a recomputed one could cut elsewhere.
    """
    cut = df.repartitionByRange(*keys, order).withColumn("__part", F.spark_partition_id())
    stored = scratch.materialise(cut)
    sums = stored.groupBy(*keys, "__part").agg(F.sum(count).alias("__n"))
    # One row per key and shuffle partition that it reaches.
    earlier = Window.partitionBy(*keys).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(*keys, "__part", F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__before"))
    inside = Window.partitionBy(*keys, "__part").orderBy(order)
    return (
        stored.withColumn("__own", F.sum(count).over(inside)).join(offsets, [*keys, "__part"])
        .withColumn("upto", F.col("__before") + F.col("__own")).drop("__part", "__own", "__before")
    )


def histogram(df: DataFrame, column: str, bins: int) -> DataFrame:
    """Equal-width bins between the column's own extremes; the top edge is inclusive."""
    span = df.agg(F.min(column).alias("lo"), F.max(column).alias("hi"))
    lo = span.select("lo").scalar()
    hi = span.select("hi").scalar()
    value = F.col(column)
    raw = F.floor(F.try_divide((value - lo) * F.lit(bins), hi - lo))
    bin_no = F.least(F.coalesce(raw, F.lit(0)), F.lit(bins - 1)).cast("int")
    return (
        df.where(value.isNotNull())
        .groupBy(bin_no.alias("bin"))
        .agg(F.count(F.lit(1)).alias("row_cnt"))
    )


def token_count(df: DataFrame, columns: list[str], tokens: list[str]) -> DataFrame:
    hits = reduce(lambda a, b: a + b, [F.count_if(F.col(c).isin(tokens)) for c in columns])
    return df.agg(hits.alias("suppressed_cnt"))


def distinct_list(df: DataFrame, column: str, name: str) -> DataFrame:
    """Sorted distinct values of a code column (code lists are short by definition)."""
    return df.select(column).distinct().agg(F.array_sort(F.collect_list(column)).alias(name))


def parse_stats(c: Column) -> list[Column]:
    """Null %, unreadable %, scientific-notation count of a numeric text column."""
    parsed = exprs.to_number(c)
    rows = F.count(F.lit(1))
    unreadable = c.isNotNull() & (F.trim(c) != "") & parsed.isNull()
    return [
        F.try_divide(F.count_if(parsed.isNull()) * F.lit(100.0), rows).alias("null_pct"),
        F.try_divide(F.count_if(unreadable) * F.lit(100.0), rows).alias("non_numeric_pct"),
        F.count_if(exprs.is_scientific(c)).alias("scientific_cnt"),
    ]
