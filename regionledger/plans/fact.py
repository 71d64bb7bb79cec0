"""The benchmark fact: survey and payroll side by side at county x sector x year."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from regionledger import schemas as S
from regionledger.functions import codes, exprs
from regionledger.operators import columns, filters, joins, quality, sets, windows
from regionledger.plans import totals

MEASURES = {
    "abs_firm_num": ("abs_firm_prev_year_num", "state_abs_firm_rank_num"),
    "abs_emp_num": ("abs_emp_prev_year_num", "state_abs_emp_rank_num"),
    "abs_payroll_usd_amt": ("abs_payroll_prev_year_usd_amt", "state_abs_payroll_rank_num"),
    "abs_rcpt_usd_amt": ("abs_rcpt_prev_year_usd_amt", "state_abs_rcpt_rank_num"),
    "qcew_ann_avg_emp_lvl_num": ("qcew_ann_avg_emp_prev_year_num", "state_qcew_emp_rank_num"),
    "qcew_ttl_ann_wage_usd_amt": ("qcew_ttl_ann_wage_prev_year_usd_amt", "state_qcew_wage_rank_num"),
}

COLUMNS = [
    "state_cnty_fips_cd", "naics2_sector_cd", "year_num", "naics2_sector_desc", "cnty_nm", "state_nm",
    "cnty_full_nm", "population_num", "population_year", "geo_id", "ind_level_num",
    "abs_firm_num", "abs_firm_prev_year_num", "abs_emp_num", "abs_emp_prev_year_num",
    "abs_payroll_usd_amt", "abs_payroll_prev_year_usd_amt", "abs_rcpt_usd_amt",
    "abs_rcpt_prev_year_usd_amt", "abs_rcpt_per_emp_usd_amt", "cnty_abs_firm_num",
    "cnty_abs_firm_prev_year_num", "cnty_abs_rcpt_usd_amt", "cnty_firm_cncntrtn_idx",
    "qcew_ann_avg_emp_lvl_num", "qcew_ann_avg_emp_prev_year_num", "qcew_ttl_ann_wage_usd_amt",
    "qcew_ttl_ann_wage_prev_year_usd_amt", "qcew_avg_wkly_wage_usd_amt", "qcew_wage_per_emp_usd_amt",
    "abs_wage_per_emp_usd_amt", "abs_rcpt_per_firm_usd_amt", "state_abs_firm_num",
    "state_abs_firm_prev_year_num", "state_abs_emp_num", "state_abs_emp_prev_year_num",
    "state_abs_payroll_usd_amt", "state_abs_payroll_prev_year_usd_amt", "state_abs_rcpt_usd_amt",
    "state_abs_rcpt_prev_year_usd_amt", "state_qcew_ann_avg_emp_lvl_num",
    "state_qcew_ann_avg_emp_prev_year_num", "state_qcew_ttl_ann_wage_usd_amt",
    "state_qcew_ttl_ann_wage_prev_year_usd_amt", "state_abs_firm_rank_num", "state_abs_emp_rank_num",
    "state_abs_payroll_rank_num", "state_abs_rcpt_rank_num", "state_qcew_emp_rank_num",
    "state_qcew_wage_rank_num",
]


def county_names(counties: DataFrame) -> DataFrame:
    """County reference with state name (postal code where unknown) and full label."""
    names = sets.state_table(counties.sparkSession).select("state_cd", "state_nm")
    out = joins.lookup_with_fallback(counties, names, "state_cd", "state_nm", "state_nm")
    return out.select(
        "state_cnty_fips_cd", F.col("cnty_nm").alias("ref_cnty_nm"), "state_nm",
        F.concat("cnty_nm", F.lit(", "), "state_nm").alias("cnty_full_nm"),
        "population_num", "population_year",
    )


def merged(survey: DataFrame, payroll: DataFrame, keep_unclassified: bool = True) -> DataFrame:
    """Two-digit survey rows full outer payroll rows; all-sector rows left out."""
    drop = [S.ALL_SECTORS] if keep_unclassified else [S.ALL_SECTORS, S.UNCLASSIFIED]
    a = filters.county_codes(survey).where(
        (F.col("ind_level_num") == 2) & ~F.col("naics2_sector_cd").isin(drop)
    ).withColumnRenamed("naics2_sector_desc", "survey_desc")
    q = filters.county_codes(payroll).where(~F.col("naics2_sector_cd").isin(drop)).select(
        *S.FACT_KEY, "qcew_ann_avg_emp_lvl_num", "qcew_ttl_ann_wage_usd_amt",
        "qcew_avg_wkly_wage_usd_amt", F.col("naics2_sector_cd").alias("payroll_sector"),
    )
    return joins.full_outer(a, q, S.FACT_KEY)


def labelled(df: DataFrame, counties: DataFrame, sectors: DataFrame) -> DataFrame:
    """County, state and sector labels; a payroll-only sector falls back to its code."""
    out = joins.lookup(df, county_names(counties), ["state_cnty_fips_cd"])
    out = joins.lookup(
        out, sectors.select("naics2_sector_cd", F.col("naics2_sector_desc").alias("ref_desc")), ["naics2_sector_cd"]
    )
    return out.withColumn("cnty_nm", F.coalesce("ref_cnty_nm", "cnty_nm")).withColumn(
        "naics2_sector_desc", F.coalesce("ref_desc", "survey_desc", "payroll_sector")
    ).drop("ref_cnty_nm", "ref_desc", "survey_desc", "payroll_sector")


def with_ratios(df: DataFrame) -> DataFrame:
    return df.withColumn(
        "qcew_wage_per_emp_usd_amt", totals.money_ratio("qcew_ttl_ann_wage_usd_amt", "qcew_ann_avg_emp_lvl_num")
    ).withColumn("abs_wage_per_emp_usd_amt", totals.money_ratio("abs_payroll_usd_amt", "abs_emp_num"))


def state_context(state_totals: DataFrame) -> DataFrame:
    """State totals with their own previous year, lagged at state grain."""
    names = {m: "state_" + m for m in MEASURES}
    prev = {m: "state_" + p for m, (p, _) in MEASURES.items()}
    keys = ["state_fips_cd", "naics2_sector_cd"]
    return state_totals.where(F.col("naics2_sector_cd") != S.ALL_SECTORS).select(
        *totals.STATE_KEY,
        *[F.col(m).alias(n) for m, n in names.items()],
        *[windows.previous(m, keys).alias(prev[m]) for m in MEASURES],
    )


def benchmark(
    survey: DataFrame, payroll: DataFrame, counties: DataFrame, sectors: DataFrame,
    state_totals: DataFrame, rollups_first: bool = False,
) -> DataFrame:
    """The 50-column benchmark fact.

    Two exchanges above the source join: one on county, which serves every county
    window whatever else it partitions by, and one on state x sector x year, which
    serves both the state-total join and all six ranks. Statewide rows take part in
    the ranks unless ``rollups_first`` drops them before.
    """
    base = labelled(merged(survey, payroll), counties, sectors)
    if rollups_first:
        base = filters.without_statewide(base)
    base = with_ratios(base).withColumn("state_fips_cd", codes.state_of(F.col("state_cnty_fips_cd")))

    county, year = "state_cnty_fips_cd", "year_num"
    # One select per window specification: mixing them would exchange more often.
    base = base.repartition(county).select(
        "*", *[windows.previous(m, [county, "naics2_sector_cd"]).alias(p) for m, (p, _) in MEASURES.items()]
    )
    base = base.select(
        "*", windows.group_sum("abs_firm_num", [county, year]).alias("cnty_abs_firm_num"),
        windows.group_sum("abs_rcpt_usd_amt", [county, year]).alias("cnty_abs_rcpt_usd_amt"),
    ).withColumn("cnty_firm_share", windows.share("abs_firm_num", "cnty_abs_firm_num"))
    base = base.select(
        "*", windows.concentration("cnty_firm_share", [county, year]).alias("cnty_firm_cncntrtn_idx"),
    ).withColumn("cnty_abs_firm_prev_year_num", windows.previous_group_total("cnty_abs_firm_num", [county]))

    base = joins.lookup(base, state_context(state_totals), totals.STATE_KEY)
    base = base.select("*", *[windows.rank_desc(m, totals.STATE_KEY).alias(r) for m, (_, r) in MEASURES.items()])
    return filters.without_statewide(base).select(COLUMNS)


def statewide(survey: DataFrame, payroll: DataFrame, counties: DataFrame, sectors: DataFrame) -> DataFrame:
    """Statewide rows (``ss000``) of both sources, no windows."""
    only = filters.only_statewide
    base = labelled(merged(only(survey), only(payroll), keep_unclassified=False), counties, sectors)
    return with_ratios(base).withColumn(
        "abs_rcpt_per_firm_usd_amt", totals.money_ratio("abs_rcpt_usd_amt", "abs_firm_num")
    ).select(
        "state_cnty_fips_cd", "naics2_sector_cd", "year_num", "naics2_sector_desc", "cnty_nm", "state_nm",
        "cnty_full_nm", "geo_id", "ind_level_num", *totals.SURVEY_SUMS, "abs_rcpt_per_emp_usd_amt",
        *totals.PAYROLL_SUMS, "qcew_avg_wkly_wage_usd_amt", "qcew_wage_per_emp_usd_amt",
        "abs_wage_per_emp_usd_amt", "abs_rcpt_per_firm_usd_amt",
    )


def file_merge(survey: DataFrame, payroll: DataFrame, counties: DataFrame, years: list[int] | None = None) -> DataFrame:
    """File-side merge: full outer, four ratios, population; county gaps filled.

    The duplicate-key gate belongs to the write (``writers.write_years``).
    """
    if years is not None:
        survey, payroll = (d.where(F.col("year_num").isin(years)) for d in (survey, payroll))
    both = joins.full_outer(
        survey.drop("abs_rcpt_per_emp_usd_amt", "abs_rcpt_per_firm_usd_amt"),
        payroll.drop("state_fips_cd", "cnty_fips_cd"), S.FACT_KEY,
    )
    both = both.withColumn("state_fips_cd", codes.state_of(F.col("state_cnty_fips_cd")))
    ratio = totals.money_ratio
    both = both.withColumns({
        "abs_rcpt_per_emp_usd_amt": ratio("abs_rcpt_usd_amt", "abs_emp_num"),
        "abs_wage_per_emp_usd_amt": ratio("abs_payroll_usd_amt", "abs_emp_num"),
        "abs_rcpt_per_firm_usd_amt": ratio("abs_rcpt_usd_amt", "abs_firm_num"),
        "qcew_wage_per_emp_usd_amt": ratio("qcew_ttl_ann_wage_usd_amt", "qcew_ann_avg_emp_lvl_num"),
    })
    ref = counties.select(
        "state_cnty_fips_cd", "state_cd", F.col("cnty_nm").alias("cnty_nm_ref"), "population_num", "population_year"
    )
    return columns.fill_from_suffixed(joins.lookup(both, ref, ["state_cnty_fips_cd"]), "_ref")


def survey_led(survey: DataFrame, payroll: DataFrame) -> DataFrame:
    """Every survey row with its payroll measures; ratios need a positive denominator.

    A repeated payroll key or a negative measure fails the job.
    """
    def per(num: str, den: str) -> Column:
        return exprs.positive_ratio(F.col(num).cast("double"), F.col(den).cast("double"))

    right = payroll.select(*S.FACT_KEY, *totals.PAYROLL_SUMS, "qcew_avg_wkly_wage_usd_amt")
    both = joins.many_to_one(survey, right, S.FACT_KEY)
    both = quality.require_non_negative(both, totals.SURVEY_SUMS + totals.PAYROLL_SUMS, "survey-led merge")
    return both.withColumns({
        "qcew_wage_per_emp_usd": per("qcew_ttl_ann_wage_usd_amt", "qcew_ann_avg_emp_lvl_num"),
        "abs_wage_per_emp_usd": per("abs_payroll_usd_amt", "abs_emp_num"),
        "abs_receipts_per_firm_usd": per("abs_rcpt_usd_amt", "abs_firm_num"),
    })


def mean_weekly_wage_by_state(fact: DataFrame, counties: DataFrame) -> DataFrame:
    """Plain mean of the weekly wage over cells, per postal state code."""
    df = fact.where(F.col("naics2_sector_cd") != S.UNCLASSIFIED).select("state_cnty_fips_cd", "qcew_avg_wkly_wage_usd_amt")
    named = joins.lookup(df, counties.select("state_cnty_fips_cd", "state_cd"), ["state_cnty_fips_cd"])
    return named.groupBy("state_cd").agg(
        exprs.half_up(F.avg(F.col("qcew_avg_wkly_wage_usd_amt").cast(S.MONEY)), 2).alias("state_avg_weekly_wage_usd_num")
    )
