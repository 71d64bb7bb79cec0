"""Payroll census clean-up: raw annual rows to county x sector x year."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from regionledger import schemas as S
from regionledger.functions import codes, exprs
from regionledger.operators import aggregates, columns, filters, joins, quality

# Accepted source names per canonical column, best first.
SYNONYMS = {
    "state_cnty_fips_cd": ["state_cnty_fips_cd", "area_fips", "area", "fips"],
    "indstr_cd": ["indstr_cd", "industry_code", "naics", "industry"],
    "year_num": ["year_num", "year"],
    "qcew_ann_avg_emp_lvl_num": [
        "qcew_ann_avg_emp_lvl_num", "annual_avg_emplvl", "annual_avg_employment",
        "annualaverageemployment", "annual_avg_emplv",
    ],
    "qcew_ttl_ann_wage_usd_amt": [
        "qcew_ttl_ann_wage_usd_amt", "total_annual_wages", "totalannualwages",
        "annual_total_wages", "tot_annual_wages",
    ],
    "qcew_avg_wkly_wage_usd_amt": [
        "qcew_avg_wkly_wage_usd_amt", "avg_wkly_wage", "avg_weekly_wage",
        "average_weekly_wage", "annual_avg_wkly_wage",
    ],
    "agg_lvl_cd": ["agg_lvl_cd", "agglvl_code", "aggregation_level"],
    "own_code": ["own_code", "ownership", "own"],
    "qtr": ["qtr", "quarter"],
}
OPTIONAL = ("own_code", "qtr")
GRAIN = ["year_num", "state_cnty_fips_cd", "naics2_sector_cd"]


def resolve(raw: DataFrame) -> DataFrame:
    return columns.rename_synonyms(raw, SYNONYMS, OPTIONAL)


def county_rows(df: DataFrame, pad: bool = True) -> DataFrame:
    area = F.col("state_cnty_fips_cd")
    coded = df.withColumn("state_cnty_fips_cd", codes.zfill(area, 5) if pad else F.trim(area))
    return coded.where(F.length("state_cnty_fips_cd") == 5)


def summed(df: DataFrame, extra_keys: list[str], digits: int) -> DataFrame:
    """Sum employment and wages per cell; the weekly wage follows from the sums."""
    emp = aggregates.sum_or_zero(exprs.to_number(F.col("qcew_ann_avg_emp_lvl_num"), "decimal(38,0)"))
    wages = aggregates.sum_or_zero(exprs.to_money(F.col("qcew_ttl_ann_wage_usd_amt")))
    sums = df.groupBy(*GRAIN, *extra_keys).agg(
        emp.cast("bigint").alias("qcew_ann_avg_emp_lvl_num"),
        wages.cast(S.MONEY).alias("qcew_ttl_ann_wage_usd_amt"),
    )
    weekly = aggregates.weekly_wage(
        F.col("qcew_ttl_ann_wage_usd_amt").cast("double"), F.col("qcew_ann_avg_emp_lvl_num")
    )
    return (
        sums.withColumn("year_num", F.col("year_num").try_cast("int"))
        .withColumn("qcew_avg_wkly_wage_usd_amt", exprs.half_even(weekly, digits))
        .withColumn("state_fips_cd", codes.state_of(F.col("state_cnty_fips_cd")))
        .withColumn("cnty_fips_cd", codes.county_of(F.col("state_cnty_fips_cd")))
    )


def sectors(
    raw: DataFrame, years: list[int] | None = None, own: str | None = "5", level: str | None = "74",
    sector=codes.sector_from_code, digits: int = 9, annual: bool = True, pad: bool = True,
    resolved: bool = False,
) -> DataFrame:
    """Raw annual rows to the canonical payroll table.

    All years of one call share a scan and an aggregation. Parameters cover the
    private, total-ownership and detailed-code variants.
    """
    df = raw if resolved else resolve(raw)
    if years is not None:
        df = df.where(F.col("year_num").isin([str(y) for y in years]))
    if annual:
        df = filters.annual_rows(df)
    if own is not None:
        df = filters.ownership(df, own)
    df = county_rows(df, pad)
    if level is not None:
        df = filters.aggregation_level(df, level)
    df = df.withColumn("naics2_sector_cd", sector(F.trim("indstr_cd")))
    df = df.where(F.col("naics2_sector_cd").isNotNull()).withColumnRenamed("own_code", "own_cd")
    return summed(df, ["own_cd"], digits).select([f.name for f in S.PAYROLL.fields])


def private_sectors(raw: DataFrame, years: list[int] | None = None) -> DataFrame:
    """Private ownership at county x sector level, weekly wage to nine digits."""
    return sectors(raw, years)


def two_digits(c):
    """First two digits of the first digit run, kept only when both exist."""
    two = F.substring(codes.first_digits(c), 1, 2)
    return F.when(F.length(two) == 2, two)


def total_ownership(raw: DataFrame, years: list[int] | None = None) -> DataFrame:
    """All-ownership rows with plain two-digit sectors, any aggregation level, codes as given."""
    out = sectors(raw, years, own="0", level=None, sector=two_digits, annual=False, pad=False)
    return out.drop("own_cd")


def official_sectors(raw: DataFrame, years: list[int] | None = None) -> DataFrame:
    """Private rows, stricter code reading, weekly wage to cents, no negative sums."""
    out = sectors(raw, years, sector=codes.sector_from_code_strict, digits=2)
    return quality.require_non_negative(
        out, ["qcew_ann_avg_emp_lvl_num", "qcew_ttl_ann_wage_usd_amt"], "payroll sectors"
    )


def detailed_codes(raw: DataFrame, years: list[int] | None = None) -> DataFrame:
    """As the official table, from rows of every aggregation level."""
    return sectors(raw, years, level=None, sector=codes.sector_from_code_strict, digits=2)


def spot_check(raw: DataFrame, year: int, area: str, level: str | None = None) -> DataFrame:
    """Own aggregation against the published county rows (level 74, private)."""
    df = resolve(raw).where(codes.zfill(F.col("state_cnty_fips_cd"), 5) == area)
    # The prep itself always keeps level 74; ``level`` narrows the input before it.
    if level is not None:
        df = filters.aggregation_level(df, level)
    ours = sectors(df, [year], sector=codes.sector_from_code_strict, digits=2, resolved=True).select(
        F.col("naics2_sector_cd").alias("naics2"),
        F.col("qcew_ann_avg_emp_lvl_num").cast("double").alias("annual_avg_emplvl"),
        F.col("qcew_avg_wkly_wage_usd_amt").alias("avg_weekly_wage"),
        F.col("qcew_ttl_ann_wage_usd_amt").cast("double").alias("total_annual_wages"),
    )
    official = filters.aggregation_level(
        filters.ownership(filters.one_year(df, year)), "74"
    ).select(
        F.regexp_extract("indstr_cd", "^([0-9]{2})", 1).alias("naics2"),
        exprs.to_number(F.col("qcew_ann_avg_emp_lvl_num")).alias("annual_avg_emplvl"),
        exprs.to_number(F.col("qcew_avg_wkly_wage_usd_amt")).alias("avg_weekly_wage"),
        exprs.to_number(F.col("qcew_ttl_ann_wage_usd_amt")).alias("total_annual_wages"),
    )
    return (
        joins.compare(ours, official, ["naics2"], ("_pipeline", "_bls"))
        .withColumn("employment_diff", F.col("annual_avg_emplvl_pipeline") - F.col("annual_avg_emplvl_bls"))
        .withColumn("wage_diff", F.col("avg_weekly_wage_pipeline") - F.col("avg_weekly_wage_bls"))
    )


def input_diagnostics(raw: DataFrame) -> DataFrame:
    """Rows per year, aggregation level and ownership code of the raw input."""
    df = resolve(raw)
    dims = F.array(
        *[
            F.struct(F.lit(c).alias("dimension"), F.col(c).alias("value"))
            for c in ("year_num", "agg_lvl_cd", "own_code")
        ]
    )
    return df.select(F.inline(dims)).groupBy("dimension", "value").agg(F.count(F.lit(1)).alias("row_cnt"))
