"""Queries of data-quality checks, reconciliation and profiling."""

from __future__ import annotations

from pyspark.sql import functions as F

from regionledger import schemas as S
from regionledger.functions import exprs
from regionledger.operators import aggregates, profiling, quality, sets, windows
from regionledger.plans import fact_checks, payroll, reconcile, sanity, totals
from regionledger.registry import tables as t
from regionledger.registry.combining import both_cells
from regionledger.registry.core import query
from regionledger.registry.ctes import NUMBER, SECTOR_LIST, number, sector_case
from regionledger.registry.plans import fact_frame
from regionledger.sources import scratch, writers

C = F.col
_CELL = "year_num, state_cnty_fips_cd, naics2_sector_cd"


def check_row(name: str, severity: str, failed: str, detail: str, table: str) -> str:
    return (
        f"SELECT '{name}' AS \"check\", '{severity}' AS severity, n = 0 AS passed, n AS failed_rows, '{detail}' AS detail "
        f"FROM (SELECT CAST({failed} AS BIGINT) AS n FROM {table})"
    )


@query(
    "dq1_county_code_failures",
    f"""SELECT {_CELL}, CASE WHEN bad THEN 'malformed' ELSE 'unknown' END AS reason FROM (SELECT {_CELL}, NOT regexp_matches(state_cnty_fips_cd, '^[0-9]{{5}}$') AS bad,
          state_cnty_fips_cd NOT IN (SELECT state_cnty_fips_cd FROM county_ref) AND state_cnty_fips_cd <> '00000' AND naics2_sector_cd NOT IN ('00','99') AS unknown
        FROM (SELECT year_num, naics2_sector_cd, CASE WHEN naics2_sector_cd = '11' AND year_num = 1995 THEN substr(state_cnty_fips_cd, 1, 4) ELSE state_cnty_fips_cd END AS state_cnty_fips_cd FROM payroll)) WHERE bad OR unknown""",
)
def _dq1(spark, d):
    short = (C("naics2_sector_cd") == "11") & (C("year_num") == 1995)
    code = F.when(short, F.substring("state_cnty_fips_cd", 1, 4)).otherwise(C("state_cnty_fips_cd"))
    df = t.payroll(spark, d).select("year_num", "naics2_sector_cd", code.alias("state_cnty_fips_cd"))
    return quality.failing_codes(df, t.county_ref(spark, d))


@query("dq2_sector_failures", f"SELECT {_CELL} FROM payroll WHERE naics2_sector_cd NOT IN (SELECT naics2_sector_cd FROM sector_ref) AND naics2_sector_cd NOT IN ('00','99')")
def _dq2(spark, d):
    return quality.failing_sectors(t.payroll(spark, d).select(*S.FACT_KEY), t.sector_ref(spark, d))


@query(
    "dq3_year_coverage",
    """SELECT 'missing' AS kind, y AS year_num FROM (SELECT CAST(unnest(range(1995, 2002)) AS INTEGER) AS y) WHERE y NOT IN (SELECT year_num FROM payroll_cells WHERE year_num NOT IN (1997, 1999))
       UNION ALL SELECT DISTINCT 'unexpected', year_num FROM payroll_cells WHERE year_num NOT IN (1997, 1999) AND year_num NOT IN (1995, 1996)""",
)
def _dq3(spark, d):
    years = t.payroll_cells(spark, d).where(~C("year_num").isin(1997, 1999)).select("year_num")
    extra = years.where(~C("year_num").isin(1995, 1996)).distinct()
    return sets.gaps(years, "year_num").withColumn("kind", F.lit("missing")).unionByName(extra.withColumn("kind", F.lit("unexpected")))


@query("dq4_key_uniqueness", "SELECT COUNT(*) AS duplicate_keys, CAST(COALESCE(SUM(n - 1), 0) AS BIGINT) AS surplus_rows FROM (SELECT COUNT(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) > 1)")
def _dq4(spark, d):
    return quality.surplus_rows(t.read(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "dq5_non_negative",
    check_row("non-negative c_acctbal", "ERROR", "COUNT(*) FILTER (c_acctbal < 0)", "rows below zero", "customer") + " UNION ALL "
    + check_row("non-negative c_custkey", "ERROR", "COUNT(*) FILTER (c_custkey < 0)", "rows below zero", "customer"),
)
def _dq5(spark, d):
    return quality.non_negative(t.read(spark, d, "customer"), ["c_acctbal", "c_custkey"])


_RATIO_VALUES = """(SELECT abs_payroll_usd_amt / NULLIF(abs_emp_num, 0) AS abs_wage, qcew_ttl_ann_wage_usd_amt / NULLIF(qcew_ann_avg_emp_lvl_num, 0) AS qcew_wage,
  abs_rcpt_usd_amt / NULLIF(abs_firm_num, 0) AS rcpt_per_firm FROM cells)"""


def ratio_values(spark, d):
    def per(num: str, den: str):
        return exprs.safe_ratio(C(num).cast("double"), C(den).cast("double"))

    return both_cells(spark, d).select(
        *S.FACT_KEY, per("abs_payroll_usd_amt", "abs_emp_num").alias("abs_wage"),
        per("qcew_ttl_ann_wage_usd_amt", "qcew_ann_avg_emp_lvl_num").alias("qcew_wage"), per("abs_rcpt_usd_amt", "abs_firm_num").alias("rcpt_per_firm"),
    )


_RANGES = {"abs_wage": (1500, 3500), "qcew_wage": (1300, 1600), "rcpt_per_firm": (0, 90000)}


@query(
    "dq6_ratio_ranges",
    " UNION ALL ".join(check_row(f"range {m}", "WARN", f"COUNT(*) FILTER ({m} < {lo} OR {m} > {hi})", f"rows outside {lo} to {hi}", _RATIO_VALUES) for m, (lo, hi) in _RANGES.items()),
)
def _dq6(spark, d):
    return quality.in_range(ratio_values(spark, d), _RANGES)


@query(
    "dq7_cross_source",
    """SELECT corr(s, p) AS wage_corr, COUNT(*) FILTER (s / NULLIF(p, 0) < 0.2 OR s / NULLIF(p, 0) > 5) AS ratio_outlier_cnt, COUNT(*) FILTER (abs(w - p / 52) / NULLIF(abs(p / 52), 0) > 0.10) AS weekly_mismatch_cnt
       FROM (SELECT abs_payroll_usd_amt / NULLIF(abs_emp_num, 0) AS s, qcew_ttl_ann_wage_usd_amt / NULLIF(qcew_ann_avg_emp_lvl_num, 0) AS p,
         qcew_avg_wkly_wage_usd_amt * CASE WHEN year_num = 1999 THEN 1.2 ELSE 1 END AS w FROM merged WHERE substr(state_cnty_fips_cd,3,3) <> '000')""", "wage_corr",
)
def _dq7(spark, d):
    from regionledger.plans import fact

    df = fact.merged(t.survey(spark, d, rollups=False), t.payroll(spark, d, rollups=False))
    w = C("qcew_avg_wkly_wage_usd_amt").cast("double") * F.when(C("year_num") == 1999, 1.2).otherwise(1.0)
    return quality.wage_consistency(df.withColumn("qcew_avg_wkly_wage_usd_amt", w))


@query(
    "dq8_one_sided_rows",
    "SELECT COUNT(*) FILTER (abs_firm_num IS NOT NULL AND qcew_ann_avg_emp_lvl_num IS NULL) AS left_only_cnt, COUNT(*) FILTER (abs_firm_num IS NULL AND qcew_ann_avg_emp_lvl_num IS NOT NULL) AS right_only_cnt FROM cells",
)
def _dq8(spark, d):
    return quality.coverage(both_cells(spark, d), "abs_firm_num", "qcew_ann_avg_emp_lvl_num")


_METRICS = {"abs_wage_per_emp_usd": "abs_wage", "qcew_wage_per_emp_usd": "qcew_wage", "abs_rcpt_per_firm_usd": "rcpt_per_firm"}


@query(
    "dq9_distribution_quantiles",
    " UNION ALL ".join(f"SELECT '{n}' AS name, COUNT({m}) AS value_cnt, quantile_cont({m}, 0.01) AS p1, quantile_cont({m}, 0.05) AS p5, quantile_cont({m}, 0.95) AS p95, quantile_cont({m}, 0.99) AS p99 FROM {_RATIO_VALUES}" for n, m in _METRICS.items()),
    "p1", "p5", "p95", "p99",
)
def _dq9(spark, d):
    return fact_checks.distribution(both_cells(spark, d))


@query(
    "dq9_z_outliers",
    """SELECT year_num, state_cnty_fips_cd, naics2_sector_cd, z FROM (SELECT *, (r - AVG(r) OVER ()) / stddev_pop(r) OVER () AS z FROM
       (SELECT *, abs_rcpt_usd_amt / NULLIF(abs_firm_num, 0) AS r FROM cells) WHERE r IS NOT NULL) ORDER BY abs(z) DESC, year_num, state_cnty_fips_cd, naics2_sector_cd LIMIT 20""", "z",
)
def _dq9b(spark, d):
    return fact_checks.outliers(both_cells(spark, d), "abs_rcpt_per_firm_usd")


_SUITE_RANGES = {"abs_wage_per_emp_usd": (1500, 3500), "qcew_wage_per_emp_usd": (1300, 1600), "abs_rcpt_per_firm_usd": (0, 90000)}
_SUITE_VALUES = """(SELECT abs_payroll_usd_amt / NULLIF(abs_emp_num, 0) AS abs_wage_per_emp_usd, qcew_ttl_ann_wage_usd_amt / NULLIF(qcew_ann_avg_emp_lvl_num, 0) AS qcew_wage_per_emp_usd,
  abs_rcpt_usd_amt / NULLIF(abs_firm_num, 0) AS abs_rcpt_per_firm_usd, qcew_avg_wkly_wage_usd_amt AS w FROM cells)"""


@query(
    "dq9_fact_check_suite",
    " UNION ALL ".join([
        check_row("county codes known", "ERROR", "COUNT(*)", "malformed or unknown county codes", "cells WHERE naics2_sector_cd <> '99' AND state_cnty_fips_cd NOT IN (SELECT state_cnty_fips_cd FROM county_ref)"),
        check_row("sectors known", "ERROR", "COUNT(*)", "sectors outside the reference", "cells WHERE naics2_sector_cd NOT IN (SELECT naics2_sector_cd FROM sector_ref)"),
        check_row("years without gaps", "ERROR", "MAX(year_num) - MIN(year_num) + 1 - COUNT(DISTINCT year_num)", "years missing inside the range", "cells"),
        check_row("unique fact key", "ERROR", "COUNT(*) - COUNT(DISTINCT (year_num, state_cnty_fips_cd, naics2_sector_cd))", "rows beyond the first of their key", "cells"),
        *[check_row(f"non-negative {m}", "ERROR", f"COUNT(*) FILTER ({m} < 0)", "rows below zero", "cells") for m in fact_checks.MEASURES],
        *[check_row(f"range {m}", "WARN", f"COUNT(*) FILTER ({m} < {lo} OR {m} > {hi})", f"rows outside {lo} to {hi}", _SUITE_VALUES) for m, (lo, hi) in _SUITE_RANGES.items()],
        check_row("survey to payroll wage ratio", "WARN", "COUNT(*) FILTER (abs_wage_per_emp_usd / qcew_wage_per_emp_usd < 0.2 OR abs_wage_per_emp_usd / qcew_wage_per_emp_usd > 5)", "rows with a ratio outside 0.2 to 5", _SUITE_VALUES),
        check_row("weekly wage agrees", "WARN", "COUNT(*) FILTER (abs(w - qcew_wage_per_emp_usd / 52) / (qcew_wage_per_emp_usd / 52) > 0.1)", "rows more than 10 percent off", _SUITE_VALUES),
    ]),
)
def _dq9c(spark, d):
    weekly = exprs.safe_ratio(C("qcew_ttl_ann_wage_usd_amt"), (C("qcew_ann_avg_emp_lvl_num") * 52).cast("decimal(20,0)"))
    cells = t.loaded(both_cells(spark, d).withColumn("qcew_avg_wkly_wage_usd_amt", weekly))
    return fact_checks.run(cells, t.county_ref(spark, d), t.sector_ref(spark, d), _SUITE_RANGES)


# --- reconciliation --------------------------------------------------------------------------

_SRC_SURVEY = f"""SELECT CAST(year_num AS INTEGER) AS year_num, lpad(state, 2, '0') || lpad(county, 3, '0') AS state_cnty_fips_cd, trim(NAICS2022) AS naics2_sector_cd,
  {number('FIRMPDEMP')} AS f, {number('EMP')} AS e, {number('PAYANN')} * 1000 AS p, {number('RCPPDEMP')} * 1000 AS r,
  CASE WHEN 'D' IN (FIRMPDEMP, EMP, PAYANN, RCPPDEMP) THEN 'source_suppressed' ELSE '' END AS src_notes FROM survey_raw WHERE county <> '12'"""
_SV = [("firms", "f", "source_census_firmpdemp", "stored_abs_firms", "delta_firms"), ("emp", "e", "source_census_emp", "stored_abs_emp", "delta_emp"),
       ("payroll", "p", "source_census_payann_usd", "stored_abs_payroll_usd_amt", "delta_payroll_usd"), ("receipts", "r", "source_census_rcppdemp_usd", "stored_abs_rcpt_usd_amt", "delta_receipts_usd")]


def _flag(short: str, src: str, st: str) -> str:
    return f"COALESCE({st} - {src} = 0, false)" if short in ("firms", "emp") else f"COALESCE(abs({st} - {src}) <= 1000, false)"


_RECON_SURVEY = f"""SELECT {_CELL}, substr(state_cnty_fips_cd,1,2) AS state_fips, substr(state_cnty_fips_cd,3,3) AS county_fips,
  {', '.join(f'{s} AS {src}, {st}, {st} - {s} AS {dl}, ({st} - {s}) / NULLIF({s}, 0) AS delta_{n}_pct, {_flag(n, s, st)} AS pass_{n}' for n, s, src, st, dl in _SV)},
  {' AND '.join(_flag(n, s, st) for n, s, _, st, _ in _SV)} AS pass_all,
  concat_ws(';', NULLIF(src_notes, ''), CASE WHEN f IS NULL AND stored_abs_firms IS NULL THEN 'missing_from_both' WHEN f IS NULL THEN 'missing_from_census' WHEN stored_abs_firms IS NULL THEN 'missing_from_stored' END) AS notes
  FROM (SELECT COALESCE(a.year_num, b.year_num) AS year_num, COALESCE(a.state_cnty_fips_cd, b.state_cnty_fips_cd) AS state_cnty_fips_cd, COALESCE(a.naics2_sector_cd, b.naics2_sector_cd) AS naics2_sector_cd,
      f, e, p, r, src_notes, CAST(stored_abs_firms AS BIGINT) AS stored_abs_firms, CAST(stored_abs_emp AS BIGINT) AS stored_abs_emp, stored_abs_payroll_usd_amt, stored_abs_rcpt_usd_amt
    FROM ({_SRC_SURVEY}) a FULL OUTER JOIN stored_survey b ON a.year_num = b.year_num AND a.state_cnty_fips_cd = b.state_cnty_fips_cd AND a.naics2_sector_cd = b.naics2_sector_cd)"""
_RS_DOUBLES = [x for n, _, src, st, dl in _SV for x in (src, dl, f"delta_{n}_pct")] + ["stored_abs_payroll_usd_amt", "stored_abs_rcpt_usd_amt"]


def _survey_report(spark, d):
    cells = t.loaded(t.survey_cells(spark, d))
    source = reconcile.survey_source(t.survey_raw(spark, d, cells).where(C("county") != "12"))
    return reconcile.survey_by_digest(source, t.stored_survey(spark, d, cells))


@query("dq10_reconcile_survey", _RECON_SURVEY, *_RS_DOUBLES)
def _dq10(spark, d):
    return _survey_report(spark, d)


_P2 = "substr(industry_code,1,2)"
_SRC_PAYROLL = f"""SELECT CAST(year AS INTEGER) AS year_num, fips AS state_cnty_fips_cd, sector AS naics2_sector_cd, x.e AS te, x.w AS tw, x.k AS tk FROM (
  SELECT year, lpad(area_fips, 5, '0') AS fips, {sector_case(_P2)} AS sector,
    min({{'e': annual_avg_emplvl, 'w': total_annual_wages, 'k': annual_avg_wkly_wage}}) AS x
  FROM payroll_raw WHERE upper(qtr) = 'A' AND own_code = '5' AND agglvl_code = '74' GROUP BY 1, 2, 3)"""
_STORED_PAYROLL = f"""SELECT {_CELL}, COALESCE(TRY_CAST(te AS DOUBLE), 10.0) AS stored_qcew_emp,
  TRY_CAST(tw AS DOUBLE) + CASE WHEN (year_num + CAST(state_cnty_fips_cd AS INTEGER) + CAST(substr(naics2_sector_cd,1,2) AS INTEGER)) % 5 = 0 THEN 1 ELSE 0 END AS stored_qcew_wages_usd,
  CASE WHEN (year_num + CAST(state_cnty_fips_cd AS INTEGER) + CAST(substr(naics2_sector_cd,1,2) AS INTEGER)) % 3 = 0 THEN NULL ELSE 101.0 END AS w0
  FROM ({_SRC_PAYROLL}) WHERE state_cnty_fips_cd <> '02002'"""
_RECON_PAYROLL = f"""SELECT {_CELL}, substr(state_cnty_fips_cd,1,2) AS state_fips, substr(state_cnty_fips_cd,3,3) AS county_fips,
  e AS source_qcew_annual_avg_emplvl, w AS source_qcew_total_annual_wages_usd, k AS source_qcew_avg_weekly_wage_usd,
  stored_qcew_emp, stored_qcew_wages_usd, sk AS stored_qcew_avg_weekly_wage_usd, stored_qcew_emp - e AS delta_emp, stored_qcew_wages_usd - w AS delta_wages_usd, sk - k AS delta_avg_weekly_wage_usd,
  (stored_qcew_emp - e) / NULLIF(e, 0) AS delta_emp_pct, (stored_qcew_wages_usd - w) / NULLIF(w, 0) AS delta_wages_pct, (sk - k) / NULLIF(k, 0) AS delta_avg_weekly_wage_pct,
  stored_qcew_emp - e = 0 AS pass_emp, stored_qcew_wages_usd - w = 0 AS pass_wages, abs(sk - k) <= 1 AS pass_avg_weekly_wage,
  CASE WHEN e IS NULL THEN NULL WHEN stored_qcew_emp IS NULL THEN false ELSE (stored_qcew_emp - e = 0) AND (stored_qcew_wages_usd - w = 0) END AS pass_all,
  concat_ws(';', CASE WHEN te = '(D)' THEN 'source_suppressed' END, CASE WHEN e IS NULL AND stored_qcew_emp IS NULL THEN 'missing_from_both' WHEN e IS NULL THEN 'missing_from_source' WHEN stored_qcew_emp IS NULL THEN 'missing_from_stored' END) AS notes
  FROM (SELECT *, COALESCE(w0, CASE WHEN stored_qcew_emp > 0 THEN stored_qcew_wages_usd / (stored_qcew_emp * 52) END) AS sk FROM (
    SELECT COALESCE(a.year_num, b.year_num) AS year_num, COALESCE(a.state_cnty_fips_cd, b.state_cnty_fips_cd) AS state_cnty_fips_cd, COALESCE(a.naics2_sector_cd, b.naics2_sector_cd) AS naics2_sector_cd,
      te, TRY_CAST(te AS DOUBLE) AS e, TRY_CAST(tw AS DOUBLE) AS w, TRY_CAST(tk AS DOUBLE) AS k, stored_qcew_emp, stored_qcew_wages_usd, w0
    FROM (SELECT * FROM ({_SRC_PAYROLL}) WHERE state_cnty_fips_cd <> '03003') a FULL OUTER JOIN ({_STORED_PAYROLL}) b
      ON a.year_num = b.year_num AND a.state_cnty_fips_cd = b.state_cnty_fips_cd AND a.naics2_sector_cd = b.naics2_sector_cd))"""
_RP_DOUBLES = ["source_qcew_annual_avg_emplvl", "source_qcew_total_annual_wages_usd", "source_qcew_avg_weekly_wage_usd", "stored_qcew_emp", "stored_qcew_wages_usd",
               "stored_qcew_avg_weekly_wage_usd", "delta_emp", "delta_wages_usd", "delta_avg_weekly_wage_usd", "delta_emp_pct", "delta_wages_pct", "delta_avg_weekly_wage_pct"]


def _payroll_report(spark, d):
    source = t.loaded(reconcile.payroll_source(t.payroll_raw(spark, d)))
    return reconcile.payroll(source.where(C("state_cnty_fips_cd") != "03003"), t.stored_payroll(source))


@query("dq11_reconcile_payroll", _RECON_PAYROLL, *_RP_DOUBLES)
def _dq11(spark, d):
    return _payroll_report(spark, d)


@query(
    "dq12_whole_surface",
    f"""SELECT 'inside' AS part, COUNT(*) AS row_cnt, COUNT(*) FILTER (pass_all) AS passed_cnt FROM ({_RECON_SURVEY.replace("WHERE county <> '12'", "WHERE NAICS2022 <> '81'").replace("stored_survey b", "(SELECT * FROM stored_survey WHERE naics2_sector_cd <> '81') b")})
        UNION ALL SELECT 'outside', COUNT(*), CAST(0 AS BIGINT) FROM survey_raw WHERE NAICS2022 = '81'""",
)
def _dq12(spark, d):
    cells = t.loaded(t.survey_cells(spark, d))
    stored = t.stored_survey(spark, d, cells).where(C("naics2_sector_cd") != "81")
    report, outside = reconcile.survey_whole_surface(reconcile.survey_source(t.survey_raw(spark, d, cells)), stored)
    inside = report.agg(F.count(F.lit(1)).alias("row_cnt"), F.count_if("pass_all").alias("passed_cnt")).withColumn("part", F.lit("inside"))
    return inside.unionByName(outside.agg(F.count(F.lit(1)).alias("row_cnt"), F.lit(0).cast("bigint").alias("passed_cnt")).withColumn("part", F.lit("outside")))


@query(
    "dq13_combined_summary",
    f"""SELECT 'abs' AS source_system, COUNT(*) AS row_cnt, COUNT(*) FILTER (pass_all) AS passed_cnt, COUNT(*) FILTER (NOT pass_all) AS failed_cnt FROM ({_RECON_SURVEY})
        UNION ALL SELECT 'qcew', COUNT(*), COUNT(*) FILTER (pass_all), COUNT(*) FILTER (NOT pass_all) FROM ({_RECON_PAYROLL})""",
)
def _dq13(spark, d):
    return reconcile.summary(reconcile.combined(_survey_report(spark, d), _payroll_report(spark, d)))


@query(
    "dq13_failing_rows",
    f"""SELECT 'abs' AS source_system, year_num, state_cnty_fips_cd, naics2_sector_cd FROM ({_RECON_SURVEY}) WHERE NOT pass_all
        UNION ALL SELECT 'qcew', year_num, state_cnty_fips_cd, naics2_sector_cd FROM ({_RECON_PAYROLL}) WHERE NOT pass_all""",
)
def _dq13_failing(spark, d):
    report = reconcile.combined(_survey_report(spark, d), _payroll_report(spark, d))
    return reconcile.failures(report).select("source_system", *S.FACT_KEY)


# --- export checks ---------------------------------------------------------------------------


_X = "export_text"
_PAYV = number("abs_payroll_usd_amt")


_ROW_CHECKS = " UNION ALL ".join([
        check_row("fact: county code format", "ERROR", "COUNT(*) FILTER (NOT regexp_matches(fips, '^[0-9]{5}$'))", "rows without a five-digit code", _X),
        check_row("fact: year numeric", "ERROR", f"COUNT(*) FILTER ({number('year_num')} IS NULL)", "rows without a numeric year", _X),
        check_row("fact: year integer", "ERROR", f"COUNT(*) FILTER ({number('year_num')} % 1 <> 0)", "rows with a fractional year", _X),
        check_row("fact: year expected", "WARN", "COUNT(*) FILTER (year_num NOT IN ('1995','1996','1997','1998','1999','2000'))", "rows of other years", _X),
        check_row("fact: sector present", "ERROR", "COUNT(*) FILTER (naics2_sector_cd IS NULL OR trim(naics2_sector_cd) = '')", "rows without a sector", _X),
        check_row("fact: partial survey rows", "WARN", f"COUNT(*) FILTER (CAST(abs_firm_num IS NOT NULL AS INT) + CAST(abs_emp_num IS NOT NULL AS INT) + CAST({_PAYV} IS NOT NULL AS INT) + CAST({number('abs_rcpt_usd_amt')} IS NOT NULL AS INT) BETWEEN 1 AND 3)", "rows with some survey measures only", _X),
        check_row("fact: negative counts", "ERROR", "0", "negative firms or employment", "(SELECT 1)"),
        check_row("fact: negative dollars", "WARN", f"COUNT(*) FILTER ({_PAYV} < 0)", "negative dollar values", _X),
        check_row("fact: scientific notation", "WARN", "COUNT(*) FILTER (regexp_matches(abs_payroll_usd_amt, '[eE][+-]?[0-9]+'))", "cells in scientific notation", _X),
])


@query("dq14_export_row_checks", _ROW_CHECKS)
def _dq14b(spark, d):
    return sanity.row_checks(sanity.canonical(t.export_text(spark, d), sanity.FACT_NAMES)[0], t.YEARS[:6])


def _heads(label: str, width: int) -> str:
    facts = (("required columns", "all present"), ("delimiter", f"{width} columns"), ("non-empty headers", "column names present"), ("unique headers", "column names unique"))
    return ", ".join(f"('{label}: {n}', 'ERROR', true, CAST(0 AS BIGINT), '{detail}')" for n, detail in facts)


def _missing(name: str, severity: str, detail: str, key: str, table: str, ref_key: str, ref: str) -> str:
    return check_row(name, severity, "COUNT(*)", detail, f"(SELECT DISTINCT {key} FROM {table} WHERE {key} NOT IN (SELECT {ref_key} FROM {ref}))")


_REF_SECTORS = "(SELECT * FROM sector_ref WHERE naics2_sector_cd <> '00')"
_COVERAGE = """SELECT 'coverage: distinct ' || what || ' ' || year_num AS "check", 'WARN' AS severity, n = e AS passed, abs(n - e) AS failed_rows, n || ' found, ' || e || ' expected' AS detail FROM
  (SELECT year_num, 'counties' AS what, COUNT(DISTINCT fips) AS n, CAST(25 AS BIGINT) AS e FROM export_text GROUP BY 1 UNION ALL SELECT year_num, 'sectors', COUNT(DISTINCT naics2_sector_cd), 21 FROM export_text GROUP BY 1)"""


@query(
    "dq14_export_sanity_suite",
    " UNION ALL ".join([
        f"SELECT * FROM (VALUES {_heads('fact', 10)}, {_heads('sectors', 2)}, {_heads('counties', 6)}) h(\"check\", severity, passed, failed_rows, detail)", _ROW_CHECKS,
        check_row("fact: duplicate keys", "ERROR", "COUNT(*)", "keys used more than once", "(SELECT 1 FROM export_text GROUP BY year_num, fips, naics2_sector_cd HAVING COUNT(*) > 1)"),
        _missing("join: fact to counties", "ERROR", "codes not in the reference", "fips", _X, "state_cnty_fips_cd", "county_ref"),
        _missing("join: counties to fact", "WARN", "reference codes not used", "state_cnty_fips_cd", "county_ref", "fips", _X),
        _missing("join: fact to sectors", "ERROR", "codes not in the reference", "naics2_sector_cd", _X, "naics2_sector_cd", _REF_SECTORS),
        _missing("join: sectors to fact", "WARN", "reference codes not used", "naics2_sector_cd", _REF_SECTORS, "naics2_sector_cd", _X),
        _COVERAGE,
    ]),
)
def _dq14(spark, d):
    sectors = t.sector_ref(spark, d).where(C("naics2_sector_cd") != "00")
    return sanity.run(t.loaded(t.export_text(spark, d)), sectors, t.county_ref(spark, d), t.YEARS[:6], 25, 21)


@query(
    "dq14_export_file_gate",
    f"""SELECT * FROM (VALUES ('fact: file exists', 'ERROR', true, CAST(0 AS BIGINT), 'found'), ('fact: file non-empty', 'ERROR', true, CAST(0 AS BIGINT), 'header read'),
        ('fact: rows parse cleanly', 'ERROR', true, CAST(0 AS BIGINT), 'rows with more cells than the header'), ('absent: file exists', 'ERROR', false, CAST(1 AS BIGINT), 'no such file')) h("check", severity, passed, failed_rows, detail)
        UNION ALL {_ROW_CHECKS}""",
)
def _dq14_gate(spark, d):
    """The export is written, read back through the file checks, and its rows are checked then."""
    path = scratch.folder(spark)
    writers.write_csv(t.export_text(spark, d), f"{path}/fact.csv")
    df, found = sanity.load_checked(spark, f"{path}/fact.csv", "fact")
    _, absent = sanity.load_checked(spark, f"{path}/absent.csv", "absent")
    checked = sanity.row_checks(sanity.canonical(df, sanity.FACT_NAMES)[0], t.YEARS[:6])
    return sets.stack([found, absent, checked])


@query(
    "dq15_combined_key",
    """SELECT FIPS_STATE AS state_fips, FIPS_COUNTY AS county_fips, lpad(FIPS_STATE, 2, '0') || lpad(FIPS_COUNTY, 3, '0') AS state_cnty_fips_cd, COUNT(*) AS row_cnt FROM facilities_raw GROUP BY 1, 2, 3""",
)
def _dq15(spark, d):
    parts = t.facilities_raw(spark, d).groupBy(C("FIPS_STATE").alias("state_fips"), C("FIPS_COUNTY").alias("county_fips")).agg(F.count(F.lit(1)).alias("row_cnt"))
    return quality.combined_key(parts, "state_fips", "county_fips")


@query(
    "dq16_numeric_parse_stats",
    f"""SELECT 100.0 * COUNT(*) FILTER (v IS NULL) / COUNT(*) AS null_pct, 100.0 * COUNT(*) FILTER (x IS NOT NULL AND trim(x) <> '' AND v IS NULL) / COUNT(*) AS non_numeric_pct,
        COUNT(*) FILTER (regexp_matches(x, '[eE][+-]?[0-9]+')) AS scientific_cnt FROM (SELECT abs_rcpt_usd_amt AS x, {number('abs_rcpt_usd_amt')} AS v FROM export_text)""",
    "null_pct", "non_numeric_pct",
)
def _dq16(spark, d):
    return t.export_text(spark, d).agg(*aggregates.parse_stats(C("abs_rcpt_usd_amt")))


@query(
    "dq17_expected_distincts",
    """SELECT year_num, 'counties' AS what, COUNT(DISTINCT state_cnty_fips_cd) AS found_cnt, CAST(25 AS BIGINT) AS expected_cnt, COUNT(DISTINCT state_cnty_fips_cd) = 25 AS passed FROM cells GROUP BY 1
       UNION ALL SELECT year_num, 'sectors', COUNT(DISTINCT naics2_sector_cd), 20, COUNT(DISTINCT naics2_sector_cd) = 20 FROM cells GROUP BY 1""",
)
def _dq17(spark, d):
    return quality.expected_distincts(both_cells(spark, d), 25, 20)


@query(
    "dq18_partial_rows",
    """SELECT COUNT(*) FILTER (CAST(a IS NULL AS INT) + CAST(abs_emp_num IS NULL AS INT) + CAST(qcew_ann_avg_emp_lvl_num IS NULL AS INT) BETWEEN 1 AND 2) AS partial_cnt
       FROM (SELECT *, CASE WHEN year_num <> 1996 THEN abs_firm_num END AS a FROM cells)""",
)
def _dq18(spark, d):
    df = both_cells(spark, d).withColumn("a", F.when(C("year_num") != 1996, C("abs_firm_num")))
    return df.agg(quality.partial_rows(["a", "abs_emp_num", "qcew_ann_avg_emp_lvl_num"]).alias("partial_cnt"))


_CANON = f"CASE WHEN {sector_case(_P2)} IN {SECTOR_LIST} THEN {sector_case(_P2)} END"


@query(
    "dq19_county_spot_check",
    f"""SELECT COALESCE(a.naics2, b.naics2) AS naics2, a.e AS annual_avg_emplvl_pipeline, a.k AS avg_weekly_wage_pipeline, a.w AS total_annual_wages_pipeline,
        b.e AS annual_avg_emplvl_bls, b.k AS avg_weekly_wage_bls, b.w AS total_annual_wages_bls, a.e - b.e AS employment_diff, a.k - b.k AS wage_diff FROM
        (SELECT naics2, e, w, CASE WHEN e > 0 THEN round_even(w / (e * 52), 2) END AS k FROM (SELECT {_CANON} AS naics2, COALESCE(SUM(TRY_CAST(annual_avg_emplvl AS DOUBLE)), 0) AS e,
            COALESCE(CAST(SUM(TRY_CAST(total_annual_wages AS DECIMAL(18,2))) AS DOUBLE), 0) AS w FROM payroll_raw
            WHERE area_fips = '1001' AND year = '1998' AND upper(qtr) = 'A' AND own_code = '5' AND agglvl_code = '74' GROUP BY 1) WHERE naics2 IS NOT NULL) a
        FULL OUTER JOIN (SELECT {_P2} AS naics2, TRY_CAST(annual_avg_emplvl AS DOUBLE) AS e, TRY_CAST(total_annual_wages AS DOUBLE) AS w, TRY_CAST(annual_avg_wkly_wage AS DOUBLE) AS k FROM payroll_raw
            WHERE area_fips = '1001' AND year = '1998' AND own_code = '5' AND agglvl_code = '74') b ON a.naics2 = b.naics2""",
    "annual_avg_emplvl_pipeline", "avg_weekly_wage_pipeline", "total_annual_wages_pipeline", "annual_avg_emplvl_bls", "avg_weekly_wage_bls", "total_annual_wages_bls", "employment_diff", "wage_diff",
)
def _dq19(spark, d):
    return payroll.spot_check(t.payroll_raw(spark, d), 1998, "01001")


@query(
    "dq20_weekly_wage_recomputed",
    f"""SELECT {_CELL}, shown, again FROM (SELECT {_CELL}, round_even(k * CASE WHEN year_num = 1997 THEN 1.01 ELSE 1 END, 2) AS shown, round_even(k, 2) AS again
        FROM (SELECT {_CELL}, qcew_ttl_ann_wage_usd_amt / NULLIF(qcew_ann_avg_emp_lvl_num * 52, 0) AS k FROM payroll_cells)) WHERE abs(shown - again) > 0.01""", "shown", "again",
)
def _dq20(spark, d):
    k = exprs.safe_ratio(C("qcew_ttl_ann_wage_usd_amt").cast("double"), (C("qcew_ann_avg_emp_lvl_num") * 52).cast("double"))
    factor = F.when(C("year_num") == 1997, 1.01).otherwise(1.0)
    df = t.payroll_cells(spark, d).select(*S.FACT_KEY, exprs.half_even(k * factor, 2).alias("shown"), exprs.half_even(k, 2).alias("again"))
    return df.where(F.abs(C("shown") - C("again")) > 0.01)


@query(
    "dq21_shares_sum_to_one",
    "SELECT state_cnty_fips_cd, year_num, SUM(s) AS share_sum FROM (SELECT *, qcew_ttl_ann_wage_usd_amt / SUM(qcew_ttl_ann_wage_usd_amt) OVER (PARTITION BY state_cnty_fips_cd, year_num) AS s FROM payroll_cells) GROUP BY 1, 2", "share_sum",
)
def _dq21(spark, d):
    key = ["state_cnty_fips_cd", "year_num"]
    df = t.payroll_cells(spark, d).withColumn("total", windows.group_sum("qcew_ttl_ann_wage_usd_amt", key))
    df = df.withColumn("s", windows.share("qcew_ttl_ann_wage_usd_amt", "total"))
    return df.groupBy(*key).agg(F.sum("s").alias("share_sum"))


_NUM = ["abs_firm_num", "abs_emp_num", "qcew_ann_avg_emp_lvl_num"]


@query(
    "dq22_missing_and_summary",
    " UNION ALL ".join(
        f"SELECT '{c}' AS name, COUNT(*) - COUNT({c}) AS missing_cnt, MIN({c}) * 1.0 AS min, quantile_cont({c}, 0.25) AS p25, quantile_cont({c}, 0.5) AS p50, quantile_cont({c}, 0.75) AS p75, MAX({c}) * 1.0 AS max, AVG({c}) AS mean, stddev_samp({c}) AS std FROM cells" for c in _NUM
    ),
    "min", "p25", "p50", "p75", "max", "mean", "std",
)
def _dq22(spark, d):
    df = both_cells(spark, d).select(*_NUM)
    missing = profiling.numeric_long(df, _NUM).groupBy("name").agg(F.count_if(C("value").isNull()).alias("missing_cnt"))
    return missing.join(profiling.numeric_stats(df, _NUM, (0.25, 0.5, 0.75)), "name")


@query(
    "dq23_input_diagnostics",
    " UNION ALL ".join(f"SELECT '{n}' AS dimension, {c} AS value, COUNT(*) AS row_cnt FROM payroll_raw GROUP BY 2" for n, c in (("year_num", "year"), ("agg_lvl_cd", "agglvl_code"), ("own_code", "own_code"))),
)
def _dq23(spark, d):
    return payroll.input_diagnostics(t.payroll_raw(spark, d))


# --- profiling -------------------------------------------------------------------------------

_CUSTOMER = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]
_LONG = " UNION ALL ".join(f"SELECT '{c}' AS name, CAST({c} AS VARCHAR) AS value FROM (SELECT *, CASE WHEN c_custkey % 9 <> 0 THEN c_mktsegment END AS seg FROM customer)".replace("CAST(c_mktsegment", "CAST(seg") for c in _CUSTOMER)


def profiled(spark, d):
    """Customers with some segments blanked out."""
    seg = F.when(C("c_custkey") % 9 != 0, C("c_mktsegment"))
    return t.read(spark, d, "customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal", seg.alias("c_mktsegment"))


@query("pf1_dataset_summary", "SELECT COUNT(*) AS row_cnt, CAST(6 AS BIGINT) AS col_cnt FROM part")
def _pf1(spark, d):
    return profiling.dataset_summary(t.read(spark, d, "part"))


_COUNTS = "COUNT(*) AS row_cnt, COUNT(*) - COUNT(value) AS missing_cnt, round_even(100.0 * (COUNT(*) - COUNT(value)) / COUNT(*), 3) AS missing_pct"


@query(
    "pf2_field_counts",
    f"SELECT name, {_COUNTS}, COUNT(DISTINCT value) AS distinct_cnt, COUNT(DISTINCT value) <= 60 AS is_enum_candidate FROM ({_LONG}) GROUP BY 1", "missing_pct",
)
def _pf2(spark, d):
    return profiling.field_counts(profiled(spark, d))


@query("pf2_approximate_counts", f"SELECT name, {_COUNTS}, true AS near FROM ({_LONG}) GROUP BY 1", "missing_pct")
def _pf2_approximate(spark, d):
    """Sketched distincts lie within 15 percent of the exact ones."""
    exact = profiling.field_counts(profiled(spark, d)).select("name", C("distinct_cnt").alias("exact"))
    got = profiling.field_counts(profiled(spark, d), approximate=True).join(exact, "name")
    near = F.abs(C("distinct_cnt") - C("exact")) <= 0.15 * C("exact")
    return got.select("name", "row_cnt", "missing_cnt", "missing_pct", near.alias("near"))


@query(
    "pf3_top_values",
    f"""SELECT name, CAST(rn AS INTEGER) AS rank_num, value, freq, freq * 100.0 / total AS pct FROM (SELECT *, row_number() OVER (PARTITION BY name ORDER BY freq DESC, value) AS rn, SUM(freq) OVER (PARTITION BY name) AS total
        FROM (SELECT name, value, COUNT(*) AS freq FROM ({_LONG}) WHERE value IS NOT NULL GROUP BY 1, 2)) WHERE rn <= 10""", "pct",
)
def _pf3(spark, d):
    return profiling.top_values(profiling.field_values(profiled(spark, d)))


_PNUM = ["p_partkey", "p_size", "p_retailprice"]


@query(
    "pf4_numeric_stats",
    " UNION ALL ".join(f"SELECT '{c}' AS name, MIN({c}) AS min, quantile_cont({c}, 0.05) AS p5, quantile_cont({c}, 0.5) AS p50, quantile_cont({c}, 0.95) AS p95, MAX({c}) AS max, AVG({c}) AS mean, stddev_samp({c}) AS std FROM part" for c in _PNUM),
    "min", "p5", "p50", "p95", "max", "mean", "std",
)
def _pf4(spark, d):
    return profiling.numeric_stats(t.read(spark, d, "part"), _PNUM)


@query(
    "pf5_text_lengths",
    " UNION ALL ".join(f"SELECT '{c}' AS name, CAST(MAX(length({c})) AS INTEGER) AS max_len, AVG(length({c})) AS avg_len FROM documents" for c in ("text", "lang", "source")), "avg_len",
)
def _pf5(spark, d):
    return profiling.text_lengths(t.read(spark, d, "documents"), ["text", "lang", "source"])


@query(
    "pf6_constraints",
    """SELECT 'c_acctbal' AS name, 'min' AS rule, COUNT(*) FILTER (c_acctbal < 0) = 0 AS passed, COUNT(*) FILTER (c_acctbal < 0) AS failed_rows FROM customer
       UNION ALL SELECT 'c_acctbal', 'max', COUNT(*) FILTER (c_acctbal > 10000) = 0, COUNT(*) FILTER (c_acctbal > 10000) FROM customer
       UNION ALL SELECT 'c_nationkey', 'max', COUNT(*) FILTER (c_nationkey > 24) = 0, COUNT(*) FILTER (c_nationkey > 24) FROM customer
       UNION ALL SELECT 'c_mktsegment', 'allowed: ' || c_mktsegment, false, COUNT(*) FROM customer WHERE c_mktsegment NOT IN ('BUILDING','MACHINERY') GROUP BY c_mktsegment""",
)
def _pf6(spark, d):
    return profiling.validate(t.read(spark, d, "customer"), {
        "c_acctbal": {"min": 0, "max": 10000}, "c_nationkey": {"max": 24},
        "c_mktsegment": {"allowed_values": ["BUILDING", "MACHINERY"]}, "absent": {"min": 1},
    })


@query("pf7_low_cardinality", f"SELECT name, COUNT(DISTINCT value) AS distinct_cnt, COUNT(DISTINCT value) <= 60 AS is_enum_candidate FROM ({_LONG}) GROUP BY 1")
def _pf7(spark, d):
    return profiling.field_counts(profiled(spark, d)).select("name", "distinct_cnt", "is_enum_candidate")


def _text(v: str | None) -> str:
    return "NULL" if v is None else "'" + v.replace("'", "''") + "'"


_GIVEN = {"own_code": "Owner, as this office codes it.", "unknown_here": "Not a column."}
_AUTOFILL = [
    *[(n, profiling.PAYROLL_DEFINITIONS[n], 0.98, "preset:qcew") for n in (
        "area_fips", "industry_code", "agglvl_code", "year", "qtr", "annual_avg_emplvl", "total_annual_wages", "annual_avg_wkly_wage")],
    ("own_code", _GIVEN["own_code"], None, "given"), ("NAME", profiling.SURVEY_DEFINITIONS["NAME"], 0.9, "preset:abs"),
    ("my_wage", "Wage or payroll amount (units likely USD).", 0.6, "heuristic:regex"), ("other", None, 0.0, "none"),
]


@query(
    "pf8_definition_autofill",
    "SELECT v.*, (SELECT COUNT(*) FROM payroll_raw) AS row_cnt FROM (VALUES "
    + ", ".join(f"({_text(n)}, {_text(x)}, CAST({'NULL' if c is None else c} AS DOUBLE), {_text(o)})" for n, x, c, o in _AUTOFILL)
    + ") v(name, definition, confidence, origin)", "confidence",
)
def _pf8(spark, d):
    raw = t.payroll_raw(spark, d).withColumns({"NAME": F.lit("x"), "my_wage": F.lit("1"), "other": F.lit("2")})
    found = profiling.definitions(spark, profiling.names_of(raw), "QCEW annual file", _GIVEN)
    return found.join(profiling.field_counts(raw, approximate=True).select("name", "row_cnt"), "name")


@query(
    "pf9_declared_types",
    """SELECT name, declared_type, observed_type, contains(observed_type, declared_type) AS type_match, (SELECT COUNT(*) FROM part) AS row_cnt FROM (VALUES ('p_partkey','bigint','bigint'), ('p_name','string','string'),
       ('p_brand',NULL,'string'), ('p_type',NULL,'string'), ('p_size','double','int'), ('p_retailprice',NULL,'double')) v(name, declared_type, observed_type)""",
)
def _pf9(spark, d):
    df = t.read(spark, d, "part")
    kinds = profiling.types_table(df, {"p_partkey": "bigint", "p_name": "string", "p_size": "double"})
    return kinds.join(profiling.field_counts(df, approximate=True).select("name", "row_cnt"), "name")


@query(
    "pf10_example_values",
    f"SELECT name, list(value ORDER BY value) AS examples FROM (SELECT *, row_number() OVER (PARTITION BY name ORDER BY value) AS rn FROM (SELECT DISTINCT name, value FROM ({_LONG}) WHERE value IS NOT NULL)) WHERE rn <= 10 GROUP BY 1",
)
def _pf10(spark, d):
    return profiling.examples(profiling.field_values(profiled(spark, d)))


_PART = [("p_partkey", "bigint"), ("p_name", "string"), ("p_brand", "string"), ("p_type", "string"), ("p_size", "int"), ("p_retailprice", "double")]


def _flat(c: str, kind: str) -> str:
    spread = f"MIN({c}) * 1.0 AS min, quantile_cont({c}, 0.5) AS p50, MAX({c}) * 1.0 AS max" if kind != "string" else "NULL AS min, NULL AS p50, NULL AS max"
    text = f"CAST({c} AS VARCHAR)"
    return f"""SELECT '{c}' AS name, CAST(NULL AS VARCHAR) AS definition, 'none' AS origin, 0.0 AS confidence, {"'bigint'" if c == 'p_partkey' else 'NULL'} AS declared_type, '{kind}' AS observed_type,
      COUNT(DISTINCT {c}) AS distinct_cnt, 0.0 AS missing_pct, {spread}, (SELECT string_agg(v, ', ' ORDER BY v) FROM (SELECT DISTINCT {text} AS v FROM part ORDER BY 1 LIMIT 3)) AS examples,
      CASE WHEN COUNT(DISTINCT {c}) <= 60 THEN 'Enum candidate (low cardinality)' ELSE '' END AS notes FROM part"""


@query("pf11_flat_profile", " UNION ALL ".join(_flat(c, k) for c, k in _PART), "confidence", "missing_pct", "min", "p50", "max")
def _pf11(spark, d):
    return profiling.flat_profile(t.read(spark, d, "part"), {"p_partkey": "bigint"}, "census")
