"""SQL twins of the derived inputs, added to a query only where it names them."""

from __future__ import annotations

import re

from regionledger.registry.tables import INDUSTRIES, UNLISTED, YEARS

_CODES = "[" + ", ".join(f"'{c}'" for c in INDUSTRIES) + "]"
_UNLISTED = ", ".join(map(str, UNLISTED))


def sector_case(c: str) -> str:
    """Range label of a two-digit text."""
    return (
        f"CASE WHEN {c} IN ('31','32','33') THEN '31-33' WHEN {c} IN ('44','45') THEN '44-45' "
        f"WHEN {c} IN ('48','49') THEN '48-49' ELSE {c} END"
    )


SECTOR_LIST = (
    "('11','21','22','23','31-33','42','44-45','48-49','51','52','53','54','55','56','61','62','71','72','81','92')"
)
NUMBER = r"'^\s*[-+]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][-+]?[0-9]+)?\s*$'"
TIE_SHIFT = 1e-7
KEY_NUMBER = "(year_num + CAST(state_cnty_fips_cd AS INTEGER) + CAST(substr(naics2_sector_cd,1,2) AS INTEGER))"


def number(c: str) -> str:
    return f"CASE WHEN regexp_matches({c}, {NUMBER}) THEN TRY_CAST({c} AS DOUBLE) END"


def zfill(c: str, n: int) -> str:
    return f"CASE WHEN length({c}) < {n} THEN lpad({c}, {n}, '0') ELSE {c} END"


def _rollups(cells: str, sums: str) -> str:
    return f"""
      SELECT year_num, f AS state_cnty_fips_cd, s AS naics2_sector_cd, {sums} FROM (
        SELECT *, state_cnty_fips_cd AS f, naics2_sector_cd AS s FROM {cells}
        UNION ALL SELECT *, substr(state_cnty_fips_cd,1,2) || '000', naics2_sector_cd FROM {cells}
        UNION ALL SELECT *, state_cnty_fips_cd, '00' FROM {cells}) GROUP BY 1, 2, 3"""


def _survey(cells: str) -> str:
    return f"""
      SELECT c.year_num, c.state_cnty_fips_cd, c.naics2_sector_cd, lower(g.n_name) AS cnty_nm,
        '0500000US' || c.state_cnty_fips_cd AS geo_id, 'survey ' || c.naics2_sector_cd AS naics2_sector_desc,
        CAST(2 AS BIGINT) AS ind_level_num, abs_firm_num, abs_emp_num, abs_payroll_usd_amt, abs_rcpt_usd_amt,
        abs_rcpt_usd_amt / NULLIF(abs_emp_num, 0) AS abs_rcpt_per_emp_usd_amt,
        abs_rcpt_usd_amt / NULLIF(abs_firm_num, 0) AS abs_rcpt_per_firm_usd_amt
      FROM {cells} c LEFT JOIN geo g ON c.state_cnty_fips_cd = g.state_cnty_fips_cd"""


def _payroll(cells: str) -> str:
    return f"""
      SELECT year_num, state_cnty_fips_cd, naics2_sector_cd, substr(state_cnty_fips_cd,1,2) AS state_fips_cd,
        substr(state_cnty_fips_cd,3,3) AS cnty_fips_cd, '5' AS own_cd, qcew_ann_avg_emp_lvl_num,
        qcew_ttl_ann_wage_usd_amt,
        qcew_ttl_ann_wage_usd_amt / NULLIF(qcew_ann_avg_emp_lvl_num * 52, 0) AS qcew_avg_wkly_wage_usd_amt
      FROM {cells}"""


_SURVEY_SUMS = """CAST(SUM(abs_firm_num) AS BIGINT) AS abs_firm_num, CAST(SUM(abs_emp_num) AS BIGINT) AS abs_emp_num,
        CAST(SUM(CAST(abs_payroll_usd_amt AS DECIMAL(30,4))) AS DOUBLE) AS abs_payroll_usd_amt,
        CAST(SUM(CAST(abs_rcpt_usd_amt AS DECIMAL(30,2))) AS DOUBLE) AS abs_rcpt_usd_amt"""
_PAYROLL_SUMS = """CAST(SUM(qcew_ann_avg_emp_lvl_num) AS BIGINT) AS qcew_ann_avg_emp_lvl_num,
        CAST(SUM(CAST(qcew_ttl_ann_wage_usd_amt AS DECIMAL(30,2))) AS DOUBLE) AS qcew_ttl_ann_wage_usd_amt"""

# Order matters: a table may use the ones above it. Money is DOUBLE after exact decimal sums.
CTES: dict[str, str] = {
    "geo": """
      SELECT n_nationkey, lpad(CAST(n_regionkey + 1 AS VARCHAR), 2, '0') AS state_fips_cd,
        lpad(CAST(n_regionkey + 1 AS VARCHAR), 2, '0') || lpad(CAST(n_nationkey + 1 AS VARCHAR), 3, '0') AS state_cnty_fips_cd,
        n_name, r_name, substr(r_name, 1, 2) AS state_cd
      FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "industry": f"""
      SELECT p_partkey, code AS indstr_cd, {sector_case('code')} AS naics2_sector_cd
      FROM (SELECT p_partkey, {_CODES}[CAST(regexp_extract(p_brand, '([0-9]+)', 1) AS INTEGER)] AS code FROM part)""",
    "survey_cells": """
      SELECT year_num, state_cnty_fips_cd, naics2_sector_cd,
        CASE WHEN f >= 3 THEN f END AS abs_firm_num, CASE WHEN f >= 3 THEN e END AS abs_emp_num,
        CASE WHEN f >= 3 THEN p END AS abs_payroll_usd_amt, CASE WHEN f >= 3 THEN r END AS abs_rcpt_usd_amt
      FROM (SELECT CAST(year(o_orderdate) AS INTEGER) AS year_num, state_cnty_fips_cd, naics2_sector_cd,
          COUNT(DISTINCT c_custkey) AS f, COUNT(DISTINCT o_orderkey) AS e,
          CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_discount AS DECIMAL(4,2))) AS DOUBLE) AS p,
          CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS r
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
          JOIN geo ON c_nationkey = n_nationkey JOIN industry ON l_partkey = p_partkey
        WHERE n_nationkey % 9 <> 4 GROUP BY 1, 2, 3)""",
    "payroll_lines": """
      SELECT l.*, n_nationkey, state_cnty_fips_cd, state_cd, n_name, indstr_cd, naics2_sector_cd,
        CAST(year(l_shipdate) AS INTEGER) AS year_num
      FROM lineitem l JOIN supplier ON l_suppkey = s_suppkey JOIN geo ON s_nationkey = n_nationkey
        JOIN industry ON l_partkey = p_partkey WHERE n_nationkey % 7 <> 3""",
    "payroll_cells": """
      SELECT year_num, state_cnty_fips_cd, naics2_sector_cd,
        CAST(SUM(CAST(l_quantity AS BIGINT)) AS BIGINT) AS qcew_ann_avg_emp_lvl_num,
        CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS qcew_ttl_ann_wage_usd_amt
      FROM payroll_lines WHERE l_returnflag = 'R' GROUP BY 1, 2, 3""",
    "survey_rolled": _rollups("survey_cells", _SURVEY_SUMS),
    "payroll_rolled": _rollups("payroll_cells", _PAYROLL_SUMS),
    "survey": _survey("survey_rolled"),
    "survey_plain": _survey("survey_cells"),
    "payroll": _payroll("payroll_rolled"),
    "payroll_plain": _payroll("payroll_cells"),
    "payroll_raw": """
      SELECT CAST(CAST(state_cnty_fips_cd AS INTEGER) AS VARCHAR) AS area_fips,
        CASE l_returnflag WHEN 'R' THEN '5' WHEN 'A' THEN '0' ELSE '1' END AS own_code,
        indstr_cd || CAST(l_linenumber AS VARCHAR) AS industry_code,
        CASE l_linestatus WHEN 'F' THEN '74' ELSE '75' END AS agglvl_code, CAST(year_num AS VARCHAR) AS year,
        CASE WHEN l_linenumber % 4 = 3 THEN '1' ELSE 'a' END AS qtr,
        CASE WHEN l_linenumber % 7 = 0 THEN '(D)' ELSE CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) END AS annual_avg_emplvl,
        CASE WHEN l_linenumber % 7 = 0 THEN '(D)' ELSE CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR) END AS total_annual_wages,
        CASE WHEN l_linenumber % 7 = 0 THEN '(D)' ELSE CAST(l_linenumber * 100 AS VARCHAR) END AS annual_avg_wkly_wage
      FROM payroll_lines""",
    "survey_raw": """
      SELECT CAST(year_num AS VARCHAR) AS year_num, 'Area ' || state_cnty_fips_cd AS NAME,
        '0500000US' || state_cnty_fips_cd AS GEO_ID,
        COALESCE(CAST(abs_firm_num AS VARCHAR), 'D') AS FIRMPDEMP, COALESCE(CAST(abs_emp_num AS VARCHAR), 'D') AS EMP,
        COALESCE(CAST(CAST(floor(abs_payroll_usd_amt / 1000) AS BIGINT) AS VARCHAR), 'D') AS PAYANN,
        COALESCE(CAST(CAST(floor(abs_rcpt_usd_amt / 1000) AS BIGINT) AS VARCHAR), 'D') AS RCPPDEMP,
        '2' AS INDLEVEL, naics2_sector_cd AS NAICS2022, 'Sector ' || naics2_sector_cd AS NAICS2022_LABEL,
        CAST(CAST(substr(state_cnty_fips_cd,1,2) AS INTEGER) AS VARCHAR) AS state,
        CAST(CAST(substr(state_cnty_fips_cd,3,3) AS INTEGER) AS VARCHAR) AS county
      FROM survey_cells""",
    "population": """
      SELECT c_nationkey AS n_nationkey, CAST(COUNT(*) * 1000 AS BIGINT) AS population_num FROM customer GROUP BY 1""",
    "county_ref": f"""
      SELECT state_cnty_fips_cd, state_cd, CAST(g.n_nationkey AS VARCHAR) AS cnty_ansi_nm, n_name AS cnty_nm,
        population_num, CAST(2022 AS BIGINT) AS population_year
      FROM geo g LEFT JOIN population p ON g.n_nationkey = p.n_nationkey WHERE g.n_nationkey NOT IN ({_UNLISTED})""",
    "sector_ref": """
      SELECT DISTINCT naics2_sector_cd, 'Sector ' || naics2_sector_cd AS naics2_sector_desc FROM industry
      WHERE naics2_sector_cd NOT IN ('92', '99')
      UNION ALL SELECT '00', 'Total for all sectors' UNION ALL SELECT '99', 'Unclassified (suppression bucket)'""",
    "gdp_both": """
      SELECT state_cnty_fips_cd, naics2_sector_cd, year_num, abs_rcpt_usd_amt AS v FROM survey_cells
      UNION ALL SELECT '00000', naics2_sector_cd, year_num, CAST(SUM(CAST(abs_rcpt_usd_amt AS DECIMAL(30,2))) AS DOUBLE)
      FROM survey_cells GROUP BY 2, 3""",
    "gdp_wide": """
      SELECT '"' || CASE WHEN state_cnty_fips_cd = '00000' THEN '00000'
          ELSE CAST(CAST(state_cnty_fips_cd AS INTEGER) AS VARCHAR) END || '"' AS GeoFIPS,
        'L' || naics2_sector_cd AS LineCode, naics2_sector_cd AS IndustryClassification,
        'Line ' || naics2_sector_cd AS Description, """ + ", ".join(
        f"""COALESCE(MAX(CASE WHEN year_num = {y} THEN COALESCE(CAST(CAST(floor(v / 1000) AS BIGINT) AS VARCHAR), '(D)') END), '(NA)') AS "{y}\""""
        for y in YEARS
    ) + " FROM gdp_both GROUP BY state_cnty_fips_cd, naics2_sector_cd",
    "facilities_raw": """
      SELECT CAST(CAST(substr(state_cnty_fips_cd,1,2) AS INTEGER) AS VARCHAR) AS FIPS_STATE,
        CAST(CAST(substr(state_cnty_fips_cd,3,3) AS INTEGER) AS VARCHAR) AS FIPS_COUNTY,
        indstr_cd || '0000' AS PRIMARY_NAICS, CAST(CAST(l_tax * 100 AS DECIMAL(18,2)) AS VARCHAR) AS AIR_RELEASE_LBS,
        CASE WHEN l_linenumber = 2 THEN 'NA' ELSE CAST(CAST(l_discount * 100 AS DECIMAL(18,2)) AS VARCHAR) END AS WATER_RELEASE_LBS
      FROM payroll_lines""",
    "county_releases": f"""
      SELECT lpad(FIPS_STATE, 2, '0') AS state, lpad(FIPS_COUNTY, 3, '0') AS county, substr(PRIMARY_NAICS, 1, 2) AS naics2,
        SUM(COALESCE({number('AIR_RELEASE_LBS')}, 0) + COALESCE({number('WATER_RELEASE_LBS')}, 0)) AS tri_releases_lbs
      FROM facilities_raw GROUP BY 1, 2, 3""",
    "named_releases": """
      SELECT upper(state_cd) AS state_cd, upper(n_name) || ' COUNTY' AS cnty_nm, substr(indstr_cd || '1110', 1, 2) AS naics2_sector_cd,
        CAST(SUM(CAST(l_tax * 100 AS DECIMAL(18,2)) + CASE WHEN l_linenumber = 3 THEN 0 ELSE CAST(l_discount * 100 AS DECIMAL(18,2)) END) AS DOUBLE)
          AS tri_ttl_rls_lbs_amt
      FROM payroll_lines GROUP BY 1, 2, 3""",
    "metro_parts": """
      SELECT n_nationkey, state_cnty_fips_cd, year_num, indstr_cd || CAST(l_linenumber % 3 AS VARCHAR) AS naics,
        COUNT(*) AS FIRMPDEMP, SUM(CAST(l_quantity AS BIGINT)) AS EMP, SUM(l_linenumber) AS PAYANN,
        SUM(CAST(l_quantity AS BIGINT) * 2) AS RCPPDEMP
      FROM payroll_lines GROUP BY 1, 2, 3, 4""",
    "metro": """
      SELECT substr(state_cnty_fips_cd,1,2) AS state, substr(state_cnty_fips_cd,3,3) AS county, year_num AS year,
        CASE WHEN naics = '00' THEN '000' ELSE naics END AS naics3, CAST(FIRMPDEMP AS DOUBLE) AS FIRMPDEMP,
        CAST(EMP AS DOUBLE) AS EMP, CAST(PAYANN AS DOUBLE) * 1000 AS PAYANN, CAST(RCPPDEMP AS DOUBLE) * 1000 AS RCPPDEMP
      FROM (SELECT * FROM metro_parts UNION ALL
        SELECT n_nationkey, state_cnty_fips_cd, year_num, '00', SUM(FIRMPDEMP),
          SUM(EMP) + CASE WHEN n_nationkey % 5 = 0 THEN 5 ELSE 0 END, SUM(PAYANN), SUM(RCPPDEMP)
        FROM metro_parts WHERE n_nationkey % 8 <> 6 GROUP BY 1, 2, 3)""",
    "crosswalk": """
      SELECT substr(state_cnty_fips_cd,1,2) AS state_fips, substr(state_cnty_fips_cd,3,3) AS county_fips,
        '1000' || CAST(g.n_nationkey % 6 AS VARCHAR) AS cbsa_code, 'Metro ' || CAST(g.n_nationkey % 6 AS VARCHAR) AS cbsa_title,
        population_num AS cbsa_pop
      FROM geo g LEFT JOIN population p ON g.n_nationkey = p.n_nationkey WHERE g.n_nationkey <> 11""",
    "stored_survey": f"""
      SELECT year_num, state_cnty_fips_cd, naics2_sector_cd, abs_firm_num AS stored_abs_firms,
        abs_emp_num + CASE WHEN {KEY_NUMBER} % 17 = 0 THEN 1 ELSE 0 END AS stored_abs_emp,
        floor(abs_payroll_usd_amt / 1000) * 1000 + CASE WHEN {KEY_NUMBER} % 5 = 0 THEN 500 ELSE 0 END AS stored_abs_payroll_usd_amt,
        floor(abs_rcpt_usd_amt / 1000) * 1000 + CASE WHEN {KEY_NUMBER} % 11 = 0 THEN 2500 ELSE 0 END AS stored_abs_rcpt_usd_amt
      FROM survey_cells WHERE state_cnty_fips_cd <> '04004'""",
    "merged": """
      SELECT COALESCE(a.state_cnty_fips_cd, q.state_cnty_fips_cd) AS state_cnty_fips_cd,
        COALESCE(a.naics2_sector_cd, q.naics2_sector_cd) AS naics2_sector_cd, COALESCE(a.year_num, q.year_num) AS year_num,
        a.cnty_nm, a.geo_id, a.naics2_sector_desc AS survey_desc, q.naics2_sector_cd AS payroll_sector, a.ind_level_num,
        a.abs_firm_num, a.abs_emp_num, a.abs_payroll_usd_amt, a.abs_rcpt_usd_amt, a.abs_rcpt_per_emp_usd_amt,
        a.abs_rcpt_per_firm_usd_amt, q.qcew_ann_avg_emp_lvl_num, q.qcew_ttl_ann_wage_usd_amt, q.qcew_avg_wkly_wage_usd_amt
      FROM (SELECT * FROM survey WHERE naics2_sector_cd <> '00') a
      FULL OUTER JOIN (SELECT * FROM payroll WHERE naics2_sector_cd <> '00') q
        ON a.year_num = q.year_num AND a.state_cnty_fips_cd = q.state_cnty_fips_cd AND a.naics2_sector_cd = q.naics2_sector_cd""",
    "cells": """
      SELECT COALESCE(a.state_cnty_fips_cd, q.state_cnty_fips_cd) AS state_cnty_fips_cd,
        COALESCE(a.naics2_sector_cd, q.naics2_sector_cd) AS naics2_sector_cd, COALESCE(a.year_num, q.year_num) AS year_num,
        abs_firm_num, abs_emp_num, abs_payroll_usd_amt, abs_rcpt_usd_amt, qcew_ann_avg_emp_lvl_num, qcew_ttl_ann_wage_usd_amt,
        qcew_ttl_ann_wage_usd_amt / NULLIF(qcew_ann_avg_emp_lvl_num * 52, 0) AS qcew_avg_wkly_wage_usd_amt
      FROM survey_cells a FULL OUTER JOIN payroll_cells q
        ON a.year_num = q.year_num AND a.state_cnty_fips_cd = q.state_cnty_fips_cd AND a.naics2_sector_cd = q.naics2_sector_cd""",
    "export_text": f"""
      SELECT CAST(year_num AS VARCHAR) AS year_num,
        CASE WHEN {KEY_NUMBER} % 97 = 0 THEN substr(state_cnty_fips_cd, 1, 4) ELSE state_cnty_fips_cd END AS fips,
        naics2_sector_cd, CAST(abs_firm_num AS VARCHAR) AS abs_firm_num,
        CASE WHEN {KEY_NUMBER} % 29 = 0 THEN NULL ELSE CAST(abs_emp_num AS VARCHAR) END AS abs_emp_num,
        CASE WHEN {KEY_NUMBER} % 13 = 0 THEN '1e5' WHEN {KEY_NUMBER} % 31 = 0 THEN '-5'
          ELSE CAST(CAST(floor(abs_payroll_usd_amt) AS BIGINT) AS VARCHAR) END AS abs_payroll_usd_amt,
        CASE WHEN {KEY_NUMBER} % 37 = 0 THEN 'n/a' ELSE CAST(CAST(floor(abs_rcpt_usd_amt) AS BIGINT) AS VARCHAR) END AS abs_rcpt_usd_amt,
        CAST(qcew_ann_avg_emp_lvl_num AS VARCHAR) AS qcew_ann_avg_emp_lvl_num,
        CAST(CAST(floor(qcew_ttl_ann_wage_usd_amt) AS BIGINT) AS VARCHAR) AS qcew_ttl_ann_wage_usd_amt,
        '100' AS qcew_avg_wkly_wage_usd_amt
      FROM cells""",
    "state_totals": """
      SELECT a.*, q.qcew_ann_avg_emp_lvl_num, q.qcew_ttl_ann_wage_usd_amt, q.qcew_avg_wkly_wage_usd_amt FROM (
        SELECT substr(state_cnty_fips_cd,1,2) AS state_fips_cd, naics2_sector_cd, year_num,
          MIN(naics2_sector_desc) AS naics2_sector_desc, """ + _SURVEY_SUMS + """
        FROM survey WHERE ind_level_num = 2 GROUP BY 1, 2, 3) a
      LEFT JOIN (SELECT state_fips_cd, naics2_sector_cd, year_num, qcew_ann_avg_emp_lvl_num, qcew_ttl_ann_wage_usd_amt,
          qcew_ttl_ann_wage_usd_amt / NULLIF(qcew_ann_avg_emp_lvl_num, 0) / 52 AS qcew_avg_wkly_wage_usd_amt FROM (
          SELECT substr(state_cnty_fips_cd,1,2) AS state_fips_cd, naics2_sector_cd, year_num, """ + _PAYROLL_SUMS + """
          FROM payroll GROUP BY 1, 2, 3)) q
        ON a.state_fips_cd = q.state_fips_cd AND a.naics2_sector_cd = q.naics2_sector_cd AND a.year_num = q.year_num""",
}


def with_ctes(body: str) -> str:
    """Prefix a query with the derived tables it uses, directly or through others."""
    needed: set[str] = set()

    def visit(text: str) -> None:
        for name in CTES:
            if name not in needed and re.search(rf"(?<![\w.']){name}(?![\w'])", text):
                needed.add(name)
                visit(CTES[name])

    visit(body)
    if not needed:
        return body
    parts = [f"{n} AS ({CTES[n].strip()})" for n in CTES if n in needed]
    return "WITH " + ",\n".join(parts) + "\n" + body


def rounded(body: str, *cols: str, digits: int = 4) -> str:
    """Round fractional outputs; sums of doubles differ in their last bits by order."""
    items = ", ".join(f"round(CAST({c} AS DOUBLE) + {TIE_SHIFT}, {digits}) AS {c}" for c in cols)
    return f"SELECT * REPLACE ({items}) FROM ({body})"
