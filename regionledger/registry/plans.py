"""Queries of the multi-step plans."""

from __future__ import annotations


from pyspark.sql import DataFrame, functions as F

from regionledger.functions import codes
from regionledger.plans import fact, gdp, metro, payroll, reference, releases, survey, totals
from regionledger.registry import tables as t
from regionledger.registry.core import query
from regionledger.registry.ctes import SECTOR_LIST, number, sector_case, zfill

# --- totals and fact -------------------------------------------------------------------------

_STATE_RATIOS = """qcew_ttl_ann_wage_usd_amt / NULLIF(qcew_ann_avg_emp_lvl_num, 0) AS qcew_wage_per_emp_usd_amt,
  abs_payroll_usd_amt / NULLIF(abs_emp_num, 0) AS abs_wage_per_emp_usd_amt,
  abs_rcpt_usd_amt / NULLIF(abs_firm_num, 0) AS abs_rcpt_per_firm_usd_amt"""


@query(
    "pl22_state_totals",
    f"SELECT *, abs_rcpt_usd_amt / NULLIF(abs_emp_num, 0) AS abs_rcpt_per_emp_usd_amt, {_STATE_RATIOS} FROM state_totals",
    "abs_payroll_usd_amt", "abs_rcpt_usd_amt", "abs_rcpt_per_emp_usd_amt", "qcew_ttl_ann_wage_usd_amt",
    "qcew_avg_wkly_wage_usd_amt", "qcew_wage_per_emp_usd_amt", "abs_wage_per_emp_usd_amt", "abs_rcpt_per_firm_usd_amt",
)
def _state_totals(spark, d):
    return totals.state_totals(t.survey(spark, d), t.payroll(spark, d))


_MEASURES = [
    ("abs_firm_num", "abs_firm_prev_year_num", "state_abs_firm_rank_num"),
    ("abs_emp_num", "abs_emp_prev_year_num", "state_abs_emp_rank_num"),
    ("abs_payroll_usd_amt", "abs_payroll_prev_year_usd_amt", "state_abs_payroll_rank_num"),
    ("abs_rcpt_usd_amt", "abs_rcpt_prev_year_usd_amt", "state_abs_rcpt_rank_num"),
    ("qcew_ann_avg_emp_lvl_num", "qcew_ann_avg_emp_prev_year_num", "state_qcew_emp_rank_num"),
    ("qcew_ttl_ann_wage_usd_amt", "qcew_ttl_ann_wage_prev_year_usd_amt", "state_qcew_wage_rank_num"),
]
_POSTAL = "(SELECT * FROM (VALUES ('AR','Arkansas'), ('MI','Michigan')) v(code, full_nm))"
_GEO_NAMES = f"""SELECT state_cnty_fips_cd, cnty_nm, COALESCE(full_nm, state_cd) AS state_nm,
  cnty_nm || ', ' || COALESCE(full_nm, state_cd) AS cnty_full_nm, population_num, population_year
  FROM county_ref LEFT JOIN {_POSTAL} ON state_cd = code"""
_FACT = f"""
SELECT state_cnty_fips_cd, naics2_sector_cd, year_num, naics2_sector_desc, cnty_nm, state_nm, cnty_full_nm, population_num,
  population_year, geo_id, ind_level_num, abs_rcpt_per_emp_usd_amt, qcew_avg_wkly_wage_usd_amt, abs_rcpt_per_firm_usd_amt,
  qcew_wage_per_emp_usd_amt, abs_wage_per_emp_usd_amt, cnty_abs_firm_num, cnty_abs_firm_prev_year_num, cnty_abs_rcpt_usd_amt,
  cnty_firm_cncntrtn_idx, {', '.join(f'{m}, {p}, {r}, state_{m}, state_{p}' for m, p, r in _MEASURES)}
FROM (
  SELECT b.*, n.naics2_sector_desc AS nd, COALESCE(n.naics2_sector_desc, survey_desc, payroll_sector) AS naics2_sector_desc,
    COALESCE(g.cnty_nm, b.survey_cnty) AS cnty_nm, g.state_nm, g.cnty_full_nm, g.population_num, g.population_year,
    c.prev_firms AS cnty_abs_firm_prev_year_num, h.idx AS cnty_firm_cncntrtn_idx,
    {', '.join(f's.{m} AS state_{m}, s.{p} AS state_{p}' for m, p, _ in _MEASURES)}
  FROM (SELECT m.* EXCLUDE (cnty_nm), m.cnty_nm AS survey_cnty,
      qcew_ttl_ann_wage_usd_amt / NULLIF(qcew_ann_avg_emp_lvl_num, 0) AS qcew_wage_per_emp_usd_amt,
      abs_payroll_usd_amt / NULLIF(abs_emp_num, 0) AS abs_wage_per_emp_usd_amt,
      CAST(SUM(COALESCE(abs_firm_num, 0)) OVER (PARTITION BY state_cnty_fips_cd, year_num) AS BIGINT) AS cnty_abs_firm_num,
      SUM(COALESCE(abs_rcpt_usd_amt, 0)) OVER (PARTITION BY state_cnty_fips_cd, year_num) AS cnty_abs_rcpt_usd_amt,
      {', '.join(f'LAG({m}) OVER (PARTITION BY state_cnty_fips_cd, naics2_sector_cd ORDER BY year_num) AS {p}' for m, p, _ in _MEASURES)},
      {', '.join(f'RANK() OVER (PARTITION BY substr(state_cnty_fips_cd,1,2), year_num, naics2_sector_cd ORDER BY {m} DESC NULLS LAST) AS {r}' for m, _, r in _MEASURES)}
    FROM merged m) b
  LEFT JOIN ({_GEO_NAMES}) g ON b.state_cnty_fips_cd = g.state_cnty_fips_cd
  LEFT JOIN sector_ref n ON b.naics2_sector_cd = n.naics2_sector_cd
  LEFT JOIN (SELECT *, {', '.join(f'LAG({m}) OVER (PARTITION BY state_fips_cd, naics2_sector_cd ORDER BY year_num) AS {p}' for m, p, _ in _MEASURES)}
      FROM state_totals WHERE naics2_sector_cd <> '00') s
    ON substr(b.state_cnty_fips_cd,1,2) = s.state_fips_cd AND b.naics2_sector_cd = s.naics2_sector_cd AND b.year_num = s.year_num
  LEFT JOIN (SELECT state_cnty_fips_cd, year_num, LAG(f) OVER (PARTITION BY state_cnty_fips_cd ORDER BY year_num) AS prev_firms
      FROM (SELECT state_cnty_fips_cd, year_num, CAST(SUM(COALESCE(abs_firm_num, 0)) AS BIGINT) AS f FROM merged GROUP BY 1, 2)) c
    ON b.state_cnty_fips_cd = c.state_cnty_fips_cd AND b.year_num = c.year_num
  LEFT JOIN (SELECT state_cnty_fips_cd, year_num, SUM((abs_firm_num / t) * (abs_firm_num / t)) AS idx FROM (
      SELECT *, CAST(NULLIF(SUM(abs_firm_num) OVER (PARTITION BY state_cnty_fips_cd, year_num), 0) AS DOUBLE) AS t FROM merged) GROUP BY 1, 2) h
    ON b.state_cnty_fips_cd = h.state_cnty_fips_cd AND b.year_num = h.year_num
) WHERE substr(state_cnty_fips_cd, 3, 3) <> '000'"""


def fact_frame(spark, d):
    s, q = t.loaded(t.survey(spark, d)), t.loaded(t.payroll(spark, d))
    return fact.benchmark(s, q, t.county_ref(spark, d), t.sector_ref(spark, d), totals.state_totals(s, q))


_MONEY = [c for m, p, _ in _MEASURES for c in (m, p, f"state_{m}", f"state_{p}") if m.endswith("_amt")]
query(
    "pl23_benchmark_fact", _FACT, "abs_rcpt_per_emp_usd_amt", "qcew_avg_wkly_wage_usd_amt", "abs_rcpt_per_firm_usd_amt",
    "qcew_wage_per_emp_usd_amt", "abs_wage_per_emp_usd_amt", "cnty_abs_rcpt_usd_amt", "cnty_firm_cncntrtn_idx", *_MONEY,
)(fact_frame)


# --- payroll clean-up ------------------------------------------------------------------------


def _payroll_sql(sector: str, where: str, digits: int, own: bool = True) -> str:
    return f"""SELECT CAST(year AS INTEGER) AS year_num, sector AS naics2_sector_cd, fips AS state_cnty_fips_cd, substr(fips,1,2) AS state_fips_cd,
      substr(fips,3,3) AS cnty_fips_cd, {"own_code AS own_cd," if own else ""} e AS qcew_ann_avg_emp_lvl_num, w AS qcew_ttl_ann_wage_usd_amt,
      CASE WHEN e > 0 THEN round_even(w / (e * 52), {digits}) END AS qcew_avg_wkly_wage_usd_amt
      FROM (SELECT year, {sector} AS sector, lpad(area_fips, 5, '0') AS fips, own_code, COALESCE(CAST(SUM(TRY_CAST(annual_avg_emplvl AS BIGINT)) AS BIGINT), 0) AS e,
          COALESCE(CAST(SUM(TRY_CAST(total_annual_wages AS DECIMAL(18,2))) AS DOUBLE), 0) AS w FROM payroll_raw WHERE {where} GROUP BY 1, 2, 3, 4)
      WHERE sector IS NOT NULL"""


_CANON = sector_case("substr(industry_code,1,2)")
_CANON = f"CASE WHEN {_CANON} IN {SECTOR_LIST} THEN {_CANON} END"
_PAY = ["qcew_ttl_ann_wage_usd_amt", "qcew_avg_wkly_wage_usd_amt"]


@query("pl1_private_payroll", _payroll_sql(_CANON, "upper(qtr) = 'A' AND own_code = '5' AND agglvl_code = '74'", 9), *_PAY)
def _pl1(spark, d):
    return payroll.private_sectors(t.payroll_raw(spark, d))


@query("pl2_total_ownership_payroll", _payroll_sql("substr(industry_code,1,2)", "own_code = '0'", 9, own=False), *_PAY)
def _pl2(spark, d):
    raw = t.payroll_raw(spark, d)
    return payroll.total_ownership(raw.withColumn("area_fips", codes.zfill(F.col("area_fips"), 5)))


@query(
    "pl3_official_sector_payroll",
    _payroll_sql(_CANON, "upper(qtr) = 'A' AND own_code = '5' AND agglvl_code = '74'", 2), *_PAY,
)
def _pl3(spark, d):
    return payroll.official_sectors(t.payroll_raw(spark, d))


@query("pl3_detailed_codes", _payroll_sql(_CANON, "upper(qtr) = 'A' AND own_code = '5'", 2), *_PAY)
def _pl3_detailed(spark, d):
    return payroll.detailed_codes(t.payroll_raw(spark, d))


# --- survey clean-up -------------------------------------------------------------------------

_N = {c: number(c) for c in ("FIRMPDEMP", "EMP", "PAYANN", "RCPPDEMP")}


@query(
    "pl4_survey_table",
    f"""SELECT CAST(year_num AS INTEGER) AS year_num, lpad(state, 2, '0') || lpad(county, 3, '0') AS state_cnty_fips_cd, trim(NAICS2022) AS naics2_sector_cd,
        NAME AS cnty_nm, GEO_ID AS geo_id, NAICS2022_LABEL AS naics2_sector_desc, CAST(INDLEVEL AS BIGINT) AS ind_level_num,
        CAST({_N['FIRMPDEMP']} AS BIGINT) AS abs_firm_num, CAST({_N['EMP']} AS BIGINT) AS abs_emp_num, {_N['PAYANN']} * 1000 AS abs_payroll_usd_amt,
        {_N['RCPPDEMP']} * 1000 AS abs_rcpt_usd_amt, {_N['RCPPDEMP']} * 1000 / NULLIF({_N['EMP']}, 0) AS abs_rcpt_per_emp_usd_amt,
        {_N['RCPPDEMP']} * 1000 / NULLIF({_N['FIRMPDEMP']}, 0) AS abs_rcpt_per_firm_usd_amt
        FROM survey_raw WHERE {_N['FIRMPDEMP']} > 0 AND trim(NAICS2022) <> '92'""",
    "abs_payroll_usd_amt", "abs_rcpt_usd_amt", "abs_rcpt_per_emp_usd_amt", "abs_rcpt_per_firm_usd_amt",
)
def _pl4(spark, d):
    return survey.table(t.survey_raw(spark, d))


@query(
    "pl5_one_state_survey",
    f"""SELECT lpad(state, 2, '0') AS state, lpad(county, 3, '0') AS county, substr(regexp_replace(NAICS2022, '[^0-9]', '', 'g'), 1, 2) AS naics2, CAST(year_num AS INTEGER) AS year,
        COALESCE(SUM({_N['FIRMPDEMP']}), 0) AS abs_firms, COALESCE(SUM({_N['EMP']}), 0) AS abs_emp, COALESCE(SUM({_N['PAYANN']} * 1000), 0) AS abs_payroll_usd,
        COALESCE(SUM({_N['RCPPDEMP']} * 1000), 0) AS abs_receipts_usd FROM survey_raw WHERE lpad(state, 2, '0') = '01' GROUP BY 1, 2, 3, 4""",
    "abs_firms", "abs_emp", "abs_payroll_usd", "abs_receipts_usd",
)
def _pl5(spark, d):
    return survey.one_state(t.survey_raw(spark, d).withColumnRenamed("year_num", "year"), "01")


def _pos(num: str, den: str) -> str:
    return f"CASE WHEN {den} > 0 THEN {num} / {den} END"


@query(
    "pl6_survey_metrics",
    f"""SELECT state, county, NAICS2022, year_num, {_pos(_N['PAYANN'] + ' * 1000', _N['EMP'])} AS avg_wage_per_emp_dollars,
        {_pos(_N['RCPPDEMP'] + ' * 1000', _N['FIRMPDEMP'])} AS receipts_per_firm_dollars, {_pos(_N['PAYANN'], _N['RCPPDEMP'])} AS payroll_to_receipts,
        {_pos(_N['RCPPDEMP'] + ' * 1000', _N['EMP'])} AS receipts_per_emp_dollars, {_pos(_N['FIRMPDEMP'] + ' * 1000', _N['EMP'])} AS firms_per_1k_emp FROM survey_raw""",
    "avg_wage_per_emp_dollars", "receipts_per_firm_dollars", "payroll_to_receipts", "receipts_per_emp_dollars", "firms_per_1k_emp",
)
def _pl6(spark, d):
    return survey.derived_metrics(t.survey_raw(spark, d)).drop("NAME", "GEO_ID", "FIRMPDEMP", "EMP", "PAYANN", "RCPPDEMP", "INDLEVEL", "NAICS2022_LABEL")


_ROUNDS = {"avg_wage_per_emp_dollars": 2, "receipts_per_firm_dollars": 2, "payroll_to_receipts": 4, "receipts_per_emp_dollars": 2, "firms_per_1k_emp": 3}


@query(
    "pl6_rounded_metrics",
    f"""SELECT state, county, NAICS2022, year_num, {', '.join(f'round_even({c}, {n}) AS {c}' for c, n in _ROUNDS.items())} FROM
        (SELECT state, county, NAICS2022, year_num, {_pos(_N['PAYANN'] + ' * 1000', _N['EMP'])} AS avg_wage_per_emp_dollars,
        {_pos(_N['RCPPDEMP'] + ' * 1000', _N['FIRMPDEMP'])} AS receipts_per_firm_dollars, {_pos(_N['PAYANN'], _N['RCPPDEMP'])} AS payroll_to_receipts,
        {_pos(_N['RCPPDEMP'] + ' * 1000', _N['EMP'])} AS receipts_per_emp_dollars, {_pos(_N['FIRMPDEMP'] + ' * 1000', _N['EMP'])} AS firms_per_1k_emp FROM survey_raw)""",
    *_ROUNDS,
)
def _pl6_rounded(spark, d):
    out = survey.derived_metrics(t.survey_raw(spark, d), rounded=True)
    return out.drop("NAME", "GEO_ID", "FIRMPDEMP", "EMP", "PAYANN", "RCPPDEMP", "INDLEVEL", "NAICS2022_LABEL")


# --- metro -----------------------------------------------------------------------------------

_SHORT = {"FIRMPDEMP": "firms", "EMP": "emp", "PAYANN": "pay", "RCPPDEMP": "rcpts"}


def _recon_sql() -> str:
    sums = ", ".join(
        f"SUM({c}) FILTER (naics3 <> '000') AS sum_{s}, SUM({c}) FILTER (naics3 = '000') AS tot_{s}" for c, s in _SHORT.items()
    )
    outs = ", ".join(
        f"sum_{s}, tot_{s}, sum_{s} - tot_{s} AS delta_{s}, (sum_{s} - tot_{s}) / NULLIF(tot_{s}, 0) AS pct_delta_{s}, COALESCE(abs(sum_{s} - tot_{s}) > 1, false) AS flag_{s}"
        for s in _SHORT.values()
    )
    ok = " OR ".join(f"COALESCE(abs(sum_{s} - tot_{s}) > 1, false)" for s in _SHORT.values())
    return f"""SELECT year, state, county, {outs}, NOT ({ok}) AS recon_ok, CASE WHEN nt = 0 THEN 'total' WHEN np = 0 THEN 'parts' END AS missing_side
      FROM (SELECT CAST(year AS INTEGER) AS year, state, county, {sums}, COUNT(*) FILTER (naics3 = '000') AS nt, COUNT(*) FILTER (naics3 <> '000') AS np FROM metro GROUP BY 1, 2, 3)"""


_RECON_DOUBLES = [f"{p}_{s}" for s in _SHORT.values() for p in ("sum", "tot", "delta", "pct_delta")]


def _metro(spark, d):
    return metro.normalise(t.metro_raw(spark, d))


def _reconciled(spark, d):
    m = t.loaded(_metro(spark, d))
    out = metro.reconcile_totals(m, keys=("year",))
    return out.select(*[c for c in out.columns if c != "year"], "year")


@query("pl7_parts_vs_total", _recon_sql(), *_RECON_DOUBLES)
def _pl7(spark, d):
    return _reconciled(spark, d)


_CBSA = """SELECT p.*, cbsa_tot_firms, cbsa_tot_emp, cbsa_tot_payroll, cbsa_tot_receipts FROM
  (SELECT CAST(year AS INTEGER) AS year, cbsa_code, cbsa_title, naics3, SUM(FIRMPDEMP) AS FIRMPDEMP, SUM(EMP) AS EMP, SUM(PAYANN) AS PAYANN, SUM(RCPPDEMP) AS RCPPDEMP
   FROM metro JOIN crosswalk ON state = state_fips AND county = county_fips WHERE naics3 <> '000' GROUP BY 1, 2, 3, 4) p
  LEFT JOIN (SELECT year, cbsa_code, SUM(FIRMPDEMP) AS cbsa_tot_firms, SUM(EMP) AS cbsa_tot_emp, SUM(PAYANN) AS cbsa_tot_payroll, SUM(RCPPDEMP) AS cbsa_tot_receipts
   FROM metro JOIN crosswalk ON state = state_fips AND county = county_fips WHERE naics3 = '000' GROUP BY 1, 2) w ON p.cbsa_code = w.cbsa_code AND p.year = w.year"""
_CBSA_DOUBLES = ["FIRMPDEMP", "EMP", "PAYANN", "RCPPDEMP", "cbsa_tot_firms", "cbsa_tot_emp", "cbsa_tot_payroll", "cbsa_tot_receipts"]


def _rolled(spark, d):
    m, x = t.loaded(_metro(spark, d)), metro.crosswalk(t.crosswalk(spark, d))
    out = metro.roll_up(m, x, keys=("year",))
    return out.select(*[c for c in out.columns if c != "year"], "year")


@query("pl8_metro_roll_up", _CBSA, *_CBSA_DOUBLES)
def _pl8(spark, d):
    return _rolled(spark, d)


@query(
    "pl9_large_metros",
    f"""SELECT 'firms' AS by_what, * FROM ({_CBSA}) WHERE (year, cbsa_code) IN (SELECT (year, cbsa_code) FROM ({_CBSA}) WHERE cbsa_tot_firms >= 1300) UNION ALL
        SELECT 'population', * FROM ({_CBSA}) WHERE cbsa_code IN (SELECT cbsa_code FROM crosswalk GROUP BY 1 HAVING MAX(cbsa_pop) >= 65000)""",
    *_CBSA_DOUBLES,
)
def _pl9(spark, d):
    rolled, x = t.loaded(_rolled(spark, d)), metro.crosswalk(t.crosswalk(spark, d))
    a = metro.large_metros(rolled, x, threshold=1300, within=("year",)).withColumn("by_what", F.lit("firms"))
    return a.unionByName(metro.large_metros(rolled, x, "population", 65000).withColumn("by_what", F.lit("population")))


@query(
    "pl10_metro_discrepancies",
    f"""SELECT r.*, cbsa_code, cbsa_title, cbsa_pop FROM ({_recon_sql()}) r LEFT JOIN crosswalk ON state = state_fips AND county = county_fips WHERE NOT recon_ok""",
    *_RECON_DOUBLES,
)
def _pl10(spark, d):
    return metro.discrepancies(_reconciled(spark, d), metro.crosswalk(t.crosswalk(spark, d)))


# --- GDP -------------------------------------------------------------------------------------

_GY = t.YEARS
_GCOLS = [gdp.value_column(y) for y in _GY]
_TIDY = (
    f"SELECT {zfill('fips', 5)} AS state_county_fips_cd, LineCode AS line_cd, IndustryClassification AS naics_sector_cd, Description AS naics_sector_desc, "
    + ", ".join(f"""{number(f'"{y}"')} * 1000 AS "{c}\"""" for y, c in zip(_GY, _GCOLS))
    + """ FROM (SELECT *, trim(replace(GeoFIPS, '"', '')) AS fips FROM gdp_wide)"""
)
_TIDY = f"""SELECT * FROM ({_TIDY}) WHERE length(state_county_fips_cd) = 5 AND state_county_fips_cd <> '00000' AND ({' OR '.join(f'"{c}" IS NOT NULL' for c in _GCOLS)})"""


def _quoted_round(sql: str, cols: list[str]) -> str:
    items = ", ".join(f'round(CAST("{c}" AS DOUBLE) + 1e-7, 4) AS "{c}"' for c in cols)
    return f"SELECT * REPLACE ({items}) FROM ({sql})"


@query("pl11_gdp_tidy", _quoted_round(_TIDY, _GCOLS))
def _pl11(spark, d):
    return gdp.tidy(t.gdp_wide(spark, d), _GY)


@query(
    "pl11_gdp_long_and_checks",
    f"""SELECT CAST(substr(y, 1, 4) AS INTEGER) AS year_num, COUNT(*) AS row_cnt, COUNT(v) AS value_cnt, SUM(v) AS total, (SELECT COUNT(*) FROM ({_TIDY}) WHERE "{_GCOLS[0]}" < 0) AS failed_rows
        FROM ({' UNION ALL '.join(f"SELECT '{c}' AS y, " + f'"{c}" AS v FROM ({_TIDY})' for c in _GCOLS)}) GROUP BY 1""", "total",
)
def _pl11b(spark, d):
    tidied = t.loaded(gdp.tidy(t.gdp_wide(spark, d), _GY))
    failed = gdp.checks(tidied, _GY).agg(F.sum("failed_rows").alias("failed_rows"))
    return gdp.long_form(tidied, _GY).groupBy("year_num").agg(
        F.count(F.lit(1)).alias("row_cnt"), F.count("gdp_amt").alias("value_cnt"),
        F.sum(F.col("gdp_amt").cast("decimal(30,2)")).alias("total"),
    ).withColumn("failed_rows", failed.scalar())


_PAYLOAD = """SELECT state_cnty_fips_cd AS geofips, 'Area ' || state_cnty_fips_cd AS geoname, CAST(year_num AS VARCHAR) AS timeperiod,
  CASE naics2_sector_cd WHEN '31-33' THEN '31G' WHEN '44-45' THEN '44RT' WHEN '48-49' THEN '48TW' WHEN '92' THEN 'G' ELSE naics2_sector_cd END AS industryclassification,
  CAST(CAST(floor(abs_rcpt_usd_amt) AS BIGINT) AS VARCHAR) AS v, 'Sector ' || naics2_sector_cd AS description FROM survey_cells"""


def payload_rows(spark, d):
    """Accounts payload rows, every cell twice, values with thousands commas."""
    group = {"31-33": "31G", "44-45": "44RT", "48-49": "48TW", "92": "G"}
    sector = F.col("naics2_sector_cd")
    code = sector
    for k, v in group.items():
        code = F.when(sector == k, v).otherwise(code)
    rows = t.survey_cells(spark, d).select(
        F.col("state_cnty_fips_cd").alias("GeoFips"), F.concat(F.lit("Area "), "state_cnty_fips_cd").alias("GeoName"),
        F.col("year_num").cast("string").alias("TimePeriod"),
        F.coalesce(F.format_number(F.floor("abs_rcpt_usd_amt").cast("bigint"), 0), F.lit("(NA)")).alias("DataValue"),
        code.alias("IndustryClassification"), F.concat(F.lit("Sector "), sector).alias("Description"),
    )
    return rows.select("*", F.explode(F.array(F.lit(1), F.lit(2))).alias("copy")).drop("copy")


@query(
    "pl12_gdp_from_payload",
    f"""SELECT DISTINCT geofips AS county_fips, CASE industryclassification WHEN '31G' THEN '31' WHEN '44RT' THEN '44' WHEN '48TW' THEN '48' WHEN 'G' THEN '92' ELSE industryclassification END AS naics2,
        CAST(timeperiod AS INTEGER) AS year, TRY_CAST(v AS DOUBLE) AS gdp_current_usd, geoname, industryclassification, description FROM ({_PAYLOAD})""",
    "gdp_current_usd",
)
def _pl12(spark, d):
    from regionledger.operators import columns

    return gdp.from_payload(columns.clean_names(payload_rows(spark, d)))


@query(
    "pl13_gdp_line_reference",
    f"""SELECT c.state, c.naics_sector, c.line_code, c.value, r.line_desc, r.national_gdp FROM
        (SELECT GeoFIPS AS state, CASE WHEN IndustryClassification = '23' THEN 'X' ELSE IndustryClassification END AS naics_sector, LineCode AS line_code, "1997" AS value FROM gdp_wide) c
        LEFT JOIN (SELECT LineCode, IndustryClassification, Description AS line_desc, {number('"1997"')} AS national_gdp FROM gdp_wide WHERE replace(GeoFIPS, '"', '') = '00000') r
        ON c.naics_sector = r.IndustryClassification AND c.line_code = r.LineCode WHERE national_gdp IS NULL""", "national_gdp",
)
def _pl13(spark, d):
    wide = t.loaded(t.gdp_wide(spark, d))
    sector = F.when(F.col("IndustryClassification") == "23", "X").otherwise(F.col("IndustryClassification"))
    county = wide.select(F.col("GeoFIPS").alias("state"), sector.alias("naics_sector"), F.col("LineCode").alias("line_code"), F.col("1997").alias("value"))
    attached = gdp.attach_lines(county, gdp.line_reference(wide, 1997))
    return gdp.without_national_value(attached).drop("IndustryClassification")


# --- releases --------------------------------------------------------------------------------


@query("pl14_facility_releases", "SELECT * FROM county_releases WHERE state IN ('01','03')", "tri_releases_lbs")
def _pl14(spark, d):
    return releases.by_county(releases.facilities(t.facilities_raw(spark, d)), ["1", "3"])


@query("pl15_named_releases", "SELECT * FROM named_releases", "tri_ttl_rls_lbs_amt")
def _pl15(spark, d):
    return releases.by_county_name(t.releases_raw(spark, d))


_OVERRIDES = "(VALUES ('CT','fairfield','09001'), ('CT','hartford','09003'), ('CT','litchfield','09005'), ('CT','middlesex','09007'), ('CT','newhaven','09009'), ('CT','newlondon','09011'), ('CT','tolland','09013'), ('CT','windham','09015'), ('AK','valdezcordova','02261')) o(state_code, county_name_norm, county_fips_5)"
_LOOKUP = f"""SELECT state_cd AS state_code, replace(lower(n_name), '_', '') AS county_name_norm, state_cnty_fips_cd AS county_fips_5 FROM geo
  WHERE n_nationkey NOT IN (7, 19) UNION ALL SELECT * FROM {_OVERRIDES}"""


@query("pl16_county_name_lookup", _LOOKUP)
def _pl16(spark, d):
    return releases.county_lookup(t.county_names(spark, d))


_CODED = f"""SELECT r.state_cd, r.cnty_nm, l.county_fips_5 AS state_cnty_fips_cd, r.naics2_sector_cd, r.tri_ttl_rls_lbs_amt FROM named_releases r
  LEFT JOIN ({_LOOKUP}) l ON r.state_cd = l.state_code AND replace(replace(lower(r.cnty_nm), ' county', ''), '_', '') = l.county_name_norm"""


def coded_releases(spark, d):
    named = releases.by_county_name(t.releases_raw(spark, d))
    return releases.with_county_codes(named, releases.county_lookup(t.county_names(spark, d)))


@query("pl17_releases_with_codes", _CODED, "tri_ttl_rls_lbs_amt")
def _pl17(spark, d):
    return coded_releases(spark, d)


@query(
    "pl17_resolve_rate",
    f"""SELECT s.*, (SELECT COUNT(*) FROM (SELECT DISTINCT state_cd, cnty_nm FROM ({_CODED}) WHERE state_cnty_fips_cd IS NULL)) AS unresolved_cnt FROM (SELECT COUNT(*) AS resolvable_cnt, COUNT(state_cnty_fips_cd) AS resolved_cnt,
        COUNT(state_cnty_fips_cd) * 1.0 / COUNT(*) AS resolve_rate, CAST(0 AS BIGINT) AS bad_length_cnt FROM ({_CODED})) s""", "resolve_rate",
)
def _pl17b(spark, d):
    coded = t.loaded(coded_releases(spark, d))
    misses = releases.unresolved(coded).agg(F.count(F.lit(1)))
    return releases.resolve_rate(coded).withColumn("unresolved_cnt", misses.scalar())


@query(
    "pl18_release_intensity",
    """SELECT r.state, r.county, r.naics2, r.tri_releases_lbs, a.abs_firms, q.qcew_emp, CASE WHEN qcew_emp > 0 THEN tri_releases_lbs / qcew_emp END AS tri_lbs_per_emp,
       CASE WHEN abs_firms > 0 THEN tri_releases_lbs / abs_firms END AS tri_lbs_per_firm FROM county_releases r
       LEFT JOIN (SELECT substr(state_cnty_fips_cd,1,2) AS state, substr(state_cnty_fips_cd,3,3) AS county, naics2_sector_cd AS naics2, CAST(SUM(abs_firm_num) AS BIGINT) AS abs_firms FROM survey_cells GROUP BY 1, 2, 3) a
         ON r.state = a.state AND r.county = a.county AND r.naics2 = a.naics2
       LEFT JOIN (SELECT substr(state_cnty_fips_cd,1,2) AS state, substr(state_cnty_fips_cd,3,3) AS county, naics2_sector_cd AS naics2, CAST(SUM(qcew_ann_avg_emp_lvl_num) AS BIGINT) AS qcew_emp FROM payroll_cells GROUP BY 1, 2, 3) q
         ON r.state = q.state AND r.county = q.county AND r.naics2 = q.naics2""",
    "tri_releases_lbs", "tri_lbs_per_emp", "tri_lbs_per_firm",
)
def _pl18(spark, d):
    def side(df, measure: str, name: str):
        fips = F.col("state_cnty_fips_cd")
        return df.groupBy(
            codes.state_of(fips).alias("state"), codes.county_of(fips).alias("county"), F.col("naics2_sector_cd").alias("naics2")
        ).agg(F.sum(measure).alias(name))

    total = t.loaded(releases.by_county(releases.facilities(t.facilities_raw(spark, d))))
    return releases.intensity(
        total, side(t.survey_cells(spark, d), "abs_firm_num", "abs_firms"),
        side(t.payroll_cells(spark, d), "qcew_ann_avg_emp_lvl_num", "qcew_emp"),
    )


# --- reference tables ------------------------------------------------------------------------


def gazetteer(spark, d):
    g = t.geography(spark, d)
    twice = g.select("*", F.explode(F.array(F.lit(" County"), F.lit(" Parish"))).alias("tail"))
    return twice.select(
        F.concat(F.col("state_cnty_fips_cd").cast("int").cast("string"), F.lit(" ")).alias("GEOID"), F.col("state_cd").alias("USPS"),
        F.col("n_nationkey").cast("string").alias("ANSICODE"), F.concat("n_name", "tail").alias("NAME"),
        (F.col("n_nationkey") * 1000).cast("string").alias("ALAND"), F.lit("n/a").alias("AWATER"),
        (F.col("n_nationkey") / 4).cast("string").alias("INTPTLAT"), F.lit("-80.5").alias("INTPTLONG"),
    )


def _literal_rows(rows) -> str:
    return ", ".join("(" + ", ".join("'" + v.replace("'", "''") + "'" for v in r) + ")" for r in rows)


def _county_build_sql() -> str:
    from regionledger import schemas as S

    extra = f"""SELECT code || sfx AS c, st, nm || txt AS n FROM (VALUES {_literal_rows(S.STATES)}) s(code, st, nm),
        (VALUES ('000',' (statewide aggregation)'), ('999',' (unspecified county)')) x(sfx, txt)
      UNION ALL SELECT * FROM (VALUES {_literal_rows(S.COUNTY_SUPPLEMENTS)}) m(a, b, c)"""
    return f"""SELECT state_cnty_fips_cd, state_cd, CAST(n_nationkey AS VARCHAR) AS cnty_ansi_nm, n_name || ' County' AS cnty_nm,
        CAST(n_nationkey * 1000 AS BIGINT) AS land_area_num, CAST(NULL AS BIGINT) AS water_area_num, n_nationkey / 4.0 AS lat_num, -80.5 AS long_num FROM geo
      UNION ALL SELECT c, st, NULL, n, NULL, NULL, NULL, NULL FROM ({extra}) WHERE c NOT IN (SELECT state_cnty_fips_cd FROM geo)"""


@query("pl19_county_reference", _county_build_sql(), "lat_num", "long_num")
def _pl19(spark, d):
    return reference.counties(gazetteer(spark, d))


@query(
    "pl20_population_attach",
    "SELECT g.state_cnty_fips_cd, g.n_name AS cnty_nm, population_num, CASE WHEN population_num IS NOT NULL THEN CAST(2022 AS BIGINT) END AS population_year FROM geo g LEFT JOIN (SELECT * FROM population WHERE n_nationkey <> 3) p ON g.n_nationkey = p.n_nationkey",
)
def _pl20(spark, d):
    fips = F.col("state_cnty_fips_cd")
    geo = t.geography(spark, d)
    pop = geo.join(t.population(spark, d), "n_nationkey").where(F.col("n_nationkey") != 3).select(
        codes.state_of(fips).cast("int").cast("string").alias("state"), codes.county_of(fips).cast("int").cast("string").alias("county"),
        F.col("population_num").alias("population"),
    )
    return reference.with_population(geo.select("state_cnty_fips_cd", F.col("n_name").alias("cnty_nm")), pop, 2022)


@query(
    "pl21_sector_reference",
    "SELECT DISTINCT naics2_sector_cd, 'Sector ' || naics2_sector_cd AS naics2_sector_desc FROM industry WHERE naics2_sector_cd <> '99' UNION ALL SELECT '00', 'Total for all sectors' UNION ALL SELECT '99', 'Unclassified (suppression bucket)'",
)
def _pl21(spark, d):
    raw = t.industries(spark, d).where(F.col("naics2_sector_cd") != "99").select(
        F.concat(F.lit(" "), "naics2_sector_cd").alias("naics2_sector_cd"), F.concat(F.lit("Sector "), "naics2_sector_cd", F.lit(" ")).alias("naics2_sector_desc")
    ).distinct()
    return reference.sectors(raw)


# --- other merged tables ---------------------------------------------------------------------

_PAIR = "a.year_num = q.year_num AND a.state_cnty_fips_cd = q.state_cnty_fips_cd AND a.naics2_sector_cd = q.naics2_sector_cd"
_RATIOS = """qcew_ttl_ann_wage_usd_amt / NULLIF(qcew_ann_avg_emp_lvl_num, 0) AS qcew_wage_per_emp_usd_amt,
  abs_payroll_usd_amt / NULLIF(abs_emp_num, 0) AS abs_wage_per_emp_usd_amt, abs_rcpt_usd_amt / NULLIF(abs_firm_num, 0) AS abs_rcpt_per_firm_usd_amt"""
_SUMS = "abs_firm_num, abs_emp_num, abs_payroll_usd_amt, abs_rcpt_usd_amt"
_MERGED_DOUBLES = [
    "abs_payroll_usd_amt", "abs_rcpt_usd_amt", "abs_rcpt_per_emp_usd_amt", "qcew_ttl_ann_wage_usd_amt", "qcew_avg_wkly_wage_usd_amt",
    "qcew_wage_per_emp_usd_amt", "abs_wage_per_emp_usd_amt", "abs_rcpt_per_firm_usd_amt",
]


@query(
    "pl24_statewide_rows",
    f"""SELECT m.state_cnty_fips_cd, m.naics2_sector_cd, year_num, COALESCE(n.naics2_sector_desc, survey_desc, payroll_sector) AS naics2_sector_desc,
        COALESCE(g.cnty_nm, m.cnty_nm) AS cnty_nm, CAST(g.state_nm AS VARCHAR) AS state_nm, CAST(g.cnty_full_nm AS VARCHAR) AS cnty_full_nm, geo_id, ind_level_num, {_SUMS}, abs_rcpt_per_emp_usd_amt,
        qcew_ann_avg_emp_lvl_num, qcew_ttl_ann_wage_usd_amt, qcew_avg_wkly_wage_usd_amt, {_RATIOS}
        FROM merged m LEFT JOIN ({_GEO_NAMES}) g ON m.state_cnty_fips_cd = g.state_cnty_fips_cd LEFT JOIN sector_ref n ON m.naics2_sector_cd = n.naics2_sector_cd
        WHERE substr(m.state_cnty_fips_cd, 3, 3) = '000' AND m.naics2_sector_cd NOT IN ('00', '99')""",
    *_MERGED_DOUBLES,
)
def _pl24(spark, d):
    return fact.statewide(t.survey(spark, d), t.payroll(spark, d), t.county_ref(spark, d), t.sector_ref(spark, d))


@query(
    "pl25_all_sector_rows",
    f"""SELECT a.year_num, a.naics2_sector_cd, a.state_cnty_fips_cd, cnty_nm, geo_id, {_SUMS}, abs_rcpt_per_emp_usd_amt, qcew_ann_avg_emp_lvl_num, qcew_ttl_ann_wage_usd_amt,
        qcew_avg_wkly_wage_usd_amt, {_RATIOS} FROM survey a LEFT JOIN payroll q ON {_PAIR} WHERE a.naics2_sector_cd IN ('00','99')""",
    *_MERGED_DOUBLES,
)
def _pl25(spark, d):
    return totals.all_sector_rows(t.survey(spark, d), t.payroll(spark, d))


@query(
    "pl26_file_merge",
    f"""SELECT m.state_cnty_fips_cd, m.naics2_sector_cd, m.year_num, COALESCE(m.cnty_nm, g.cnty_nm) AS cnty_nm, geo_id, naics2_sector_desc, ind_level_num, {_SUMS}, own_cd,
        qcew_ann_avg_emp_lvl_num, qcew_ttl_ann_wage_usd_amt, qcew_avg_wkly_wage_usd_amt, substr(m.state_cnty_fips_cd,1,2) AS state_fips_cd,
        abs_rcpt_usd_amt / NULLIF(abs_emp_num, 0) AS abs_rcpt_per_emp_usd_amt, {_RATIOS}, state_cd, population_num, population_year
        FROM (SELECT COALESCE(a.state_cnty_fips_cd, q.state_cnty_fips_cd) AS state_cnty_fips_cd, COALESCE(a.naics2_sector_cd, q.naics2_sector_cd) AS naics2_sector_cd, COALESCE(a.year_num, q.year_num) AS year_num,
          cnty_nm, geo_id, naics2_sector_desc, ind_level_num, {_SUMS}, own_cd, qcew_ann_avg_emp_lvl_num, qcew_ttl_ann_wage_usd_amt, qcew_avg_wkly_wage_usd_amt
          FROM survey_plain a FULL OUTER JOIN payroll_plain q ON {_PAIR}) m
        LEFT JOIN county_ref g ON m.state_cnty_fips_cd = g.state_cnty_fips_cd""",
    *_MERGED_DOUBLES,
)
def _pl26(spark, d):
    return fact.file_merge(t.survey(spark, d, rollups=False), t.payroll(spark, d, rollups=False), t.county_ref(spark, d), t.YEARS)


@query(
    "pl27_survey_led_merge",
    f"""SELECT a.year_num, a.state_cnty_fips_cd, a.naics2_sector_cd, abs_firm_num, qcew_ann_avg_emp_lvl_num,
        CASE WHEN qcew_ann_avg_emp_lvl_num > 0 THEN qcew_ttl_ann_wage_usd_amt / qcew_ann_avg_emp_lvl_num END AS qcew_wage_per_emp_usd,
        CASE WHEN abs_emp_num > 0 THEN abs_payroll_usd_amt / abs_emp_num END AS abs_wage_per_emp_usd,
        CASE WHEN abs_firm_num > 0 THEN abs_rcpt_usd_amt / abs_firm_num END AS abs_receipts_per_firm_usd FROM survey_plain a LEFT JOIN payroll_plain q ON {_PAIR}""",
    "qcew_wage_per_emp_usd", "abs_wage_per_emp_usd", "abs_receipts_per_firm_usd",
)
def _pl27(spark, d):
    out = fact.survey_led(t.survey(spark, d, rollups=False), t.payroll(spark, d, rollups=False))
    return out.select(
        "year_num", "state_cnty_fips_cd", "naics2_sector_cd", "abs_firm_num", "qcew_ann_avg_emp_lvl_num", "qcew_wage_per_emp_usd",
        "abs_wage_per_emp_usd", "abs_receipts_per_firm_usd",
    )


@query(
    "pl28_weekly_wage_by_state",
    "SELECT state_cd, round(AVG(qcew_avg_wkly_wage_usd_amt), 2) AS state_avg_weekly_wage_usd_num FROM payroll_plain p LEFT JOIN county_ref g ON p.state_cnty_fips_cd = g.state_cnty_fips_cd WHERE naics2_sector_cd <> '99' GROUP BY 1",
    "state_avg_weekly_wage_usd_num",
)
def _pl28(spark, d):
    return fact.mean_weekly_wage_by_state(t.payroll(spark, d, rollups=False), t.county_ref(spark, d))


_NATL_COLS = {
    "abs_firm_num": "abs_firms_natl", "abs_emp_num": "abs_emp_natl", "abs_payroll_usd_amt": "abs_payroll_usd_natl",
    "abs_rcpt_usd_amt": "abs_receipts_usd_natl", "qcew_ann_avg_emp_lvl_num": "qcew_emp_natl", "qcew_ttl_ann_wage_usd_amt": "qcew_wages_usd_natl",
}


@query(
    "pl29_national_snapshot",
    f"""SELECT *, {', '.join(f'(CAST({s} AS DOUBLE) - LAG({s}) OVER (ORDER BY year_num)) / NULLIF(CAST(LAG({s}) OVER (ORDER BY year_num) AS DOUBLE), 0) AS {n}' for s, n in totals.YOY.items())}
        FROM (SELECT year_num, COUNT(*) AS row_cnt, COUNT(DISTINCT state_cnty_fips_cd) AS county_cnt, COUNT(DISTINCT naics2_sector_cd) AS naics2_cnt,
          {', '.join(f"CAST(SUM({c}) AS {'DOUBLE' if c.endswith('_amt') else 'BIGINT'}) AS {n}" for c, n in _NATL_COLS.items())}
          FROM cells GROUP BY 1)""",
    "abs_payroll_usd_natl", "abs_receipts_usd_natl", "qcew_wages_usd_natl", *totals.YOY.values(),
)
def _pl29(spark, d):
    from regionledger.registry.combining import both_cells

    return totals.national_snapshot(both_cells(spark, d), t.YEARS)
