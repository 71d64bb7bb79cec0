"""Data-quality checks.

Every check yields rows ``(check, severity, passed, failed_rows, detail)``. Checks
on the same table share one aggregation pass.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from regionledger import schemas as S
from regionledger.functions import codes, exprs

ERROR, WARN = "ERROR", "WARN"
CHECK_COLUMNS = ["check", "severity", "passed", "failed_rows", "detail"]


@dataclass(frozen=True)
class Check:
    """A named count of failing rows, as an aggregate expression."""

    name: str
    severity: str
    failed: Column
    detail: str


def run_checks(df: DataFrame, checks: list[Check], group: str | None = None) -> DataFrame:
    """All checks in one pass; with ``group`` one row per check and group value."""
    counted = [F.coalesce(c.failed, F.lit(0)).cast("long").alias(f"f{i}") for i, c in enumerate(checks)]
    agg = df.groupBy(group).agg(*counted) if group else df.agg(*counted)
    rows = F.array(
        *[
            F.struct(
                (F.concat(F.lit(c.name + " "), F.col(group).cast("string")) if group else F.lit(c.name)).alias("check"),
                F.lit(c.severity).alias("severity"),
                (F.col(f"f{i}") == 0).alias("passed"),
                F.col(f"f{i}").alias("failed_rows"),
                F.lit(c.detail).alias("detail"),
            )
            for i, c in enumerate(checks)
        ]
    )
    return agg.select(F.inline(rows))


def surplus_rows(df: DataFrame, keys: list[str]) -> DataFrame:
    """Number of repeated keys and of rows beyond the first of each key."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return counts.agg(
        F.count(F.lit(1)).alias("duplicate_keys"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("surplus_rows"),
    )


def unique_key(df: DataFrame, keys: list[str], name: str, severity: str = ERROR) -> DataFrame:
    return run_checks(
        surplus_rows(df, keys),
        [Check(name, severity, F.max("surplus_rows"), "rows beyond the first of their key")],
    )


def fail_on_duplicates(df: DataFrame, keys: list[str], what: str) -> None:
    """Gate before a write: one scalar decides, no rows reach the driver."""
    surplus = surplus_rows(df, keys).first()["surplus_rows"]
    if surplus:
        raise ValueError(f"{what}: {surplus} rows repeat their key {keys}")


def non_negative(df: DataFrame, measures: list[str], severity: str = ERROR) -> DataFrame:
    return run_checks(
        df, [Check(f"non-negative {m}", severity, F.count_if(F.col(m) < 0), "rows below zero") for m in measures]
    )


def require_non_negative(df: DataFrame, measures: list[str], what: str) -> DataFrame:
    """Pass rows through; a negative value fails the job that reads them.

    The check is a filter inside the plan, so it costs no second pass over the data.
    """
    bad = reduce(lambda a, b: a | b, [F.coalesce(F.col(m) < 0, F.lit(False)) for m in measures])
    stop = F.raise_error(F.lit(f"{what}: negative value in {measures}")).cast("boolean")
    return df.where(F.when(bad, stop).otherwise(F.lit(True)))


def in_range(df: DataFrame, ranges: dict[str, tuple[float, float]]) -> DataFrame:
    return run_checks(
        df,
        [
            Check(
                f"range {m}", WARN,
                F.count_if((F.col(m) < lo) | (F.col(m) > hi)), f"rows outside {lo} to {hi}",
            )
            for m, (lo, hi) in ranges.items()
        ],
    )


def failing_codes(df: DataFrame, ref: DataFrame, column: str = "state_cnty_fips_cd") -> DataFrame:
    """Rows whose county code is malformed or unknown; totals are exempt from lookup."""
    code = F.col(column)
    known = ref.select(column).distinct().withColumn("__known", F.lit(True))
    exempt = (code == "00000") | F.col("naics2_sector_cd").isin(S.ALL_SECTORS, S.UNCLASSIFIED)
    malformed = ~codes.is_county_code(code)
    unknown = F.col("__known").isNull() & ~exempt
    return (
        df.where(code.isNotNull())
        .join(known, column, "left")
        .where(malformed | unknown)
        .withColumn("reason", F.when(malformed, "malformed").otherwise("unknown"))
        .drop("__known")
    )


def failing_sectors(df: DataFrame, ref: DataFrame) -> DataFrame:
    """Rows whose sector is neither in the reference nor a total."""
    named = df.where(~F.col("naics2_sector_cd").isin(S.ALL_SECTORS, S.UNCLASSIFIED))
    return named.join(ref.select("naics2_sector_cd"), "naics2_sector_cd", "left_anti")


def partial_rows(measures: list[str]) -> Column:
    nulls = reduce(lambda a, b: a + b, [F.col(m).isNull().cast("int") for m in measures])
    return F.count_if(nulls.between(1, len(measures) - 1))


def coverage(df: DataFrame, left: str, right: str) -> DataFrame:
    """Rows present on one side only."""
    return df.agg(
        F.count_if(F.col(left).isNotNull() & F.col(right).isNull()).alias("left_only_cnt"),
        F.count_if(F.col(left).isNull() & F.col(right).isNotNull()).alias("right_only_cnt"),
    )


def wage_consistency(df: DataFrame) -> DataFrame:
    """Survey wage against payroll wage: correlation, wild ratios, weekly wage drift."""
    survey = exprs.safe_ratio(F.col("abs_payroll_usd_amt").cast("double"), F.col("abs_emp_num").cast("double"))
    payroll = exprs.safe_ratio(
        F.col("qcew_ttl_ann_wage_usd_amt").cast("double"), F.col("qcew_ann_avg_emp_lvl_num").cast("double")
    )
    ratio = exprs.safe_ratio(F.col("s"), F.col("p"))
    weekly = F.col("p") / 52
    drift = exprs.safe_ratio(F.abs(F.col("w") - weekly), F.abs(weekly))
    base = df.select(
        survey.alias("s"), payroll.alias("p"), F.col("qcew_avg_wkly_wage_usd_amt").cast("double").alias("w")
    )
    return base.agg(
        F.corr("s", "p").alias("wage_corr"),
        F.count_if((ratio < 0.2) | (ratio > 5)).alias("ratio_outlier_cnt"),
        F.count_if(drift > 0.10).alias("weekly_mismatch_cnt"),
    )


def expected_distincts(df: DataFrame, counties: int, sectors: int) -> DataFrame:
    """Distinct counties and sectors per year against the expected numbers."""
    per_year = df.groupBy("year_num").agg(
        F.countDistinct("state_cnty_fips_cd").alias("c"), F.countDistinct("naics2_sector_cd").alias("s")
    )
    wanted = F.array(
        F.struct(F.lit("counties").alias("what"), F.col("c").alias("found_cnt"), F.lit(counties).cast("long").alias("expected_cnt")),
        F.struct(F.lit("sectors").alias("what"), F.col("s").alias("found_cnt"), F.lit(sectors).cast("long").alias("expected_cnt")),
    )
    return per_year.select("year_num", F.inline(wanted)).withColumn(
        "passed", F.col("found_cnt") == F.col("expected_cnt")
    )


def verdict(checks: DataFrame) -> DataFrame:
    """Pass and fail counts per severity, and overall: no failed ERROR."""
    return checks.groupBy("severity").agg(
        F.count_if(F.col("passed")).alias("passed_cnt"),
        F.count_if(~F.col("passed")).alias("failed_cnt"),
    ).withColumn("acceptable", (F.col("severity") != ERROR) | (F.col("failed_cnt") == 0))


def combined_key(df: DataFrame, state: str, county: str, key: str = "state_cnty_fips_cd") -> DataFrame:
    """Five-digit key from its parts, only where the table lacks it."""
    if key in df.columns or not {state, county} <= set(df.columns):
        return df
    return df.withColumn(key, F.concat(codes.zfill(F.col(state), 2), codes.zfill(F.col(county), 3)))
