"""State, all-sector and national totals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from regionledger import schemas as S
from regionledger.functions import codes, exprs
from regionledger.operators import filters, joins, windows

STATE_KEY = ["state_fips_cd", "naics2_sector_cd", "year_num"]
SURVEY_SUMS = ["abs_firm_num", "abs_emp_num", "abs_payroll_usd_amt", "abs_rcpt_usd_amt"]
PAYROLL_SUMS = ["qcew_ann_avg_emp_lvl_num", "qcew_ttl_ann_wage_usd_amt"]


def money_ratio(num: str, den: str) -> Column:
    """Money per unit, nine decimals, null on a zero or missing denominator."""
    return exprs.safe_ratio(F.col(num).cast(S.MONEY), F.col(den).cast("decimal(20,0)")).cast(S.MONEY)


def summed(c: str, df: DataFrame) -> Column:
    return F.sum(c).cast(df.schema[c].dataType).alias(c)


def survey_states(survey: DataFrame) -> DataFrame:
    df = survey.where(F.col("ind_level_num") == 2).withColumn(
        "state_fips_cd", codes.state_of(F.col("state_cnty_fips_cd"))
    )
    out = df.groupBy(*STATE_KEY).agg(
        F.min("naics2_sector_desc").alias("naics2_sector_desc"), *[summed(c, df) for c in SURVEY_SUMS]
    )
    return out.withColumn("abs_rcpt_per_emp_usd_amt", money_ratio("abs_rcpt_usd_amt", "abs_emp_num"))


def payroll_states(payroll: DataFrame) -> DataFrame:
    df = payroll.withColumn("state_fips_cd", codes.state_of(F.col("state_cnty_fips_cd")))
    out = df.groupBy(*STATE_KEY).agg(*[summed(c, df) for c in PAYROLL_SUMS])
    yearly = exprs.safe_ratio(
        F.col("qcew_ttl_ann_wage_usd_amt").cast("double"), F.col("qcew_ann_avg_emp_lvl_num").cast("double")
    )
    return out.withColumn("qcew_avg_wkly_wage_usd_amt", yearly / 52)


def state_totals(survey: DataFrame, payroll: DataFrame) -> DataFrame:
    """Survey state totals with the payroll totals of the same cell."""
    return (
        joins.lookup(survey_states(survey), payroll_states(payroll), STATE_KEY)
        .withColumn("qcew_wage_per_emp_usd_amt", money_ratio("qcew_ttl_ann_wage_usd_amt", "qcew_ann_avg_emp_lvl_num"))
        .withColumn("abs_wage_per_emp_usd_amt", money_ratio("abs_payroll_usd_amt", "abs_emp_num"))
        .withColumn("abs_rcpt_per_firm_usd_amt", money_ratio("abs_rcpt_usd_amt", "abs_firm_num"))
    )


def all_sector_rows(survey: DataFrame, payroll: DataFrame) -> DataFrame:
    """Rows of the total (``00``) and unclassified (``99``) sectors, both sources."""
    left = filters.sector_totals(survey, keep=True).select(
        *S.FACT_KEY, "cnty_nm", "geo_id", *SURVEY_SUMS, "abs_rcpt_per_emp_usd_amt"
    )
    right = filters.sector_totals(payroll, keep=True).select(
        *S.FACT_KEY, *PAYROLL_SUMS, "qcew_avg_wkly_wage_usd_amt"
    )
    return (
        joins.lookup(left, right, S.FACT_KEY)
        .withColumn("qcew_wage_per_emp_usd_amt", money_ratio("qcew_ttl_ann_wage_usd_amt", "qcew_ann_avg_emp_lvl_num"))
        .withColumn("abs_wage_per_emp_usd_amt", money_ratio("abs_payroll_usd_amt", "abs_emp_num"))
        .withColumn("abs_rcpt_per_firm_usd_amt", money_ratio("abs_rcpt_usd_amt", "abs_firm_num"))
    )


NATIONAL = {
    "abs_firm_num": "abs_firms_natl", "abs_emp_num": "abs_emp_natl",
    "abs_payroll_usd_amt": "abs_payroll_usd_natl", "abs_rcpt_usd_amt": "abs_receipts_usd_natl",
    "qcew_ann_avg_emp_lvl_num": "qcew_emp_natl", "qcew_ttl_ann_wage_usd_amt": "qcew_wages_usd_natl",
}
YOY = {
    "abs_receipts_usd_natl": "yoy_abs_receipts_pct", "abs_payroll_usd_natl": "yoy_abs_payroll_pct",
    "abs_emp_natl": "yoy_abs_emp_pct", "abs_firms_natl": "yoy_abs_firms_pct",
    "qcew_emp_natl": "yoy_qcew_emp_pct", "qcew_wages_usd_natl": "yoy_qcew_wages_pct",
}


def national(fact: DataFrame, years: list[int] | None = None) -> DataFrame:
    if years is not None:
        fact = fact.where(F.col("year_num").isin(years))
    return fact.groupBy("year_num").agg(
        F.count(F.lit(1)).alias("row_cnt"),
        F.countDistinct("state_cnty_fips_cd").alias("county_cnt"),
        F.countDistinct("naics2_sector_cd").alias("naics2_cnt"),
        *[summed(c, fact).alias(n) for c, n in NATIONAL.items()],
    )


def national_snapshot(fact: DataFrame, years: list[int] | None = None) -> DataFrame:
    """National totals per year with the change against the previous year shown."""
    return windows.with_year_over_year(national(fact, years), YOY).drop("prev_year_num")
