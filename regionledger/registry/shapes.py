"""Queries of projections, reshapes and filters."""

from __future__ import annotations

from pyspark.sql import functions as F, types as T

from regionledger import schemas as S
from regionledger.functions import codes, exprs
from regionledger.operators import columns, filters
from regionledger.plans import gdp, payroll, sanity
from regionledger.registry import tables as t
from regionledger.registry.core import query
from regionledger.registry.ctes import SECTOR_LIST, number, sector_case, zfill
from regionledger.registry.scalars import choose, sql_list

C = F.col

_RAW = """area_fips AS state_cnty_fips_cd, own_code, industry_code AS indstr_cd, agglvl_code AS agg_lvl_cd, year AS year_num,
  qtr, annual_avg_emplvl AS qcew_ann_avg_emp_lvl_num, total_annual_wages AS qcew_ttl_ann_wage_usd_amt,
  annual_avg_wkly_wage AS qcew_avg_wkly_wage_usd_amt"""


@query("prj1_resolve_synonyms", f"SELECT {_RAW} FROM payroll_raw")
def _prj1(spark, d):
    raw = t.payroll_raw(spark, d)
    return payroll.resolve(raw.toDF(*[c.upper() for c in raw.columns]))


@query(
    "prj2_canonical_map",
    """SELECT year_num, fips AS state_cnty_fips_cd, naics2_sector_cd, abs_firm_num AS abs_firms, abs_emp_num AS abs_emp,
       abs_payroll_usd_amt, abs_rcpt_usd_amt, qcew_ann_avg_emp_lvl_num AS qcew_emp, qcew_ttl_ann_wage_usd_amt AS qcew_wages_usd,
       qcew_avg_wkly_wage_usd_amt AS qcew_avg_weekly_wage_usd FROM export_text""",
)
def _prj2(spark, d):
    return sanity.canonical(t.export_text(spark, d), sanity.FACT_NAMES)[0]


@query(
    "prj3_find_column",
    "SELECT upper(state_cd) AS state, COUNT(*) AS row_cnt FROM payroll_lines GROUP BY 1",
)
def _prj3(spark, d):
    raw = t.releases_raw(spark, d)
    state = columns.quoted(columns.find_column(raw.columns, "facility state"))
    return raw.groupBy(F.upper(F.trim(state)).alias("state")).agg(F.count(F.lit(1)).alias("row_cnt"))


@query("prj4_duplicate_headers", "SELECT c_custkey, c_name FROM customer")
def _prj4(spark, d):
    twice = t.read(spark, d, "customer").select("c_custkey", "c_name", F.lower("c_name").alias("c_name"))
    return columns.drop_duplicate_headers(twice)


@query("prj5_required_columns", "SELECT n_nationkey, n_name FROM nation")
def _prj5(spark, d):
    return columns.require_columns(t.read(spark, d, "nation"), ["n_nationkey", "n_name"]).select("n_nationkey", "n_name")


@query("prj6_drop_unnamed", "SELECT s_suppkey, s_name FROM supplier")
def _prj6(spark, d):
    df = t.read(spark, d, "supplier").select("s_suppkey", "s_name", F.lit("").alias("Unnamed: 2"), F.lit("").alias("Unnamed: 3"))
    return columns.drop_unnamed(df)


@query(
    "prj7_canonical_schema",
    """SELECT state_cnty_fips_cd, state_cd, cnty_ansi_nm, cnty_nm, CAST(population_num * 2 AS BIGINT) AS land_area_num,
       CAST(NULL AS BIGINT) AS water_area_num, CAST(CAST(cnty_ansi_nm AS DOUBLE) AS DOUBLE) AS lat_num, CAST(NULL AS DOUBLE) AS long_num,
       population_num, population_year FROM county_ref""",
)
def _prj7(spark, d):
    none = F.lit(None)
    return columns.conform(
        t.county_ref(spark, d), S.COUNTY_REF,
        {"land_area_num": C("population_num") * 2, "water_area_num": none, "lat_num": C("cnty_ansi_nm"), "long_num": none},
    )


@query(
    "prj8_fill_and_drop_suffixed",
    """SELECT c_custkey, c_nationkey, COALESCE(CASE WHEN c_custkey % 2 = 0 THEN c_name END, n_name) AS label
       FROM customer JOIN nation ON c_nationkey = n_nationkey""",
)
def _prj8(spark, d):
    c = t.read(spark, d, "customer").select("c_custkey", "c_nationkey", F.when(C("c_custkey") % 2 == 0, C("c_name")).alias("label"))
    n = t.read(spark, d, "nation").select(C("n_nationkey").alias("c_nationkey"), C("n_name").alias("label_ref"), C("n_regionkey").alias("region_ref"))
    return columns.fill_from_suffixed(c.join(n, "c_nationkey", "left"), "_ref")


@query("prj9_constant_columns", "SELECT o_orderkey, o_orderstatus AS own_cd, 'abs' AS source_system, CAST(2022 AS INTEGER) AS year_num FROM orders")
def _prj9(spark, d):
    df = t.read(spark, d, "orders").select("o_orderkey", C("o_orderstatus").alias("own_cd"))
    for name, value in (("own_cd", "5"), ("source_system", "abs"), ("year_num", 2022)):
        df = columns.with_default(df, name, value)
    return df


@query(
    "prj10_row_sum_dynamic",
    f"""SELECT FIPS_STATE, FIPS_COUNTY, PRIMARY_NAICS, COALESCE({number('AIR_RELEASE_LBS')}, 0) + COALESCE({number('WATER_RELEASE_LBS')}, 0) AS pounds
        FROM facilities_raw""", "pounds",
)
def _prj10(spark, d):
    raw = t.facilities_raw(spark, d)
    parts = [C(c) for c in raw.columns if c.endswith("_RELEASE_LBS")]
    return raw.select("FIPS_STATE", "FIPS_COUNTY", "PRIMARY_NAICS", exprs.sum_filled(parts).alias("pounds"))


@query(
    "prj11_melt",
    """SELECT c_custkey, 'c_name' AS variant, c_name AS label FROM customer UNION ALL
       SELECT c_custkey, 'c_mktsegment', c_mktsegment FROM customer""",
)
def _prj11(spark, d):
    return columns.melt(t.read(spark, d, "customer"), ["c_custkey"], ["c_name", "c_mktsegment"], "variant", "label")


_PIVOT = [*S.SECTORS, S.UNCLASSIFIED]


@query(
    "prj12_pivot_first",
    "SELECT state_cnty_fips_cd, year_num, "
    + ", ".join(f"""MIN(CASE WHEN naics2_sector_cd = '{c}' THEN abs_firm_num END) AS "{c}\"""" for c in _PIVOT)
    + " FROM survey_cells GROUP BY 1, 2",
)
def _prj12(spark, d):
    return columns.pivot_first(t.survey_cells(spark, d), ["state_cnty_fips_cd", "year_num"], "naics2_sector_cd", "abs_firm_num", _PIVOT)


@query(
    "prj13_tidy_year_columns",
    "SELECT GeoFIPS, LineCode, " + ", ".join(f"""{number(f'"{y}"')} * 1000 AS "{gdp.value_column(y)}\"""" for y in t.YEARS) + " FROM gdp_wide",
)
def _prj13(spark, d):
    values = [exprs.from_thousands(exprs.to_number(columns.quoted(str(y)))).alias(gdp.value_column(y)) for y in t.YEARS]
    return t.gdp_wide(spark, d).select("GeoFIPS", "LineCode", *values)


@query("prj14_clean_names", "SELECT p_partkey AS part_key, p_brand AS brand FROM part")
def _prj14(spark, d):
    return columns.clean_names(t.read(spark, d, "part").select(C("p_partkey").alias(" Part_Key "), C("p_brand").alias("BRAND ")))


@query(
    "prj15_split_area_code",
    """SELECT state_cnty_fips_cd, substr(state_cnty_fips_cd,1,2) AS state_fips_cd, substr(state_cnty_fips_cd,3,3) AS cnty_fips_cd,
       COUNT(*) AS row_cnt FROM payroll_lines GROUP BY 1""",
)
def _prj15(spark, d):
    fips = C("state_cnty_fips_cd")
    return t.payroll_lines(spark, d).groupBy(fips).agg(F.count(F.lit(1)).alias("row_cnt")).select(
        fips, codes.state_of(fips).alias("state_fips_cd"), codes.county_of(fips).alias("cnty_fips_cd"), "row_cnt"
    )


# --- filters ---------------------------------------------------------------------------------


@query("flt1_employers_only", f"SELECT * FROM survey_raw WHERE {number('FIRMPDEMP')} > 0")
def _flt1(spark, d):
    return filters.employers(t.survey_raw(spark, d), "FIRMPDEMP")


@query("flt2_without_public_administration", "SELECT NAICS2022, COUNT(*) AS row_cnt FROM survey_raw WHERE trim(NAICS2022) <> '92' GROUP BY 1")
def _flt2(spark, d):
    return filters.without_public_administration(t.survey_raw(spark, d), "NAICS2022").groupBy("NAICS2022").agg(F.count(F.lit(1)).alias("row_cnt"))


@query("flt3_year_as_text", f"SELECT {_RAW} FROM payroll_raw WHERE year = '1998'")
def _flt3(spark, d):
    return filters.one_year(payroll.resolve(t.payroll_raw(spark, d)), 1998)


@query("flt4_annual_rows", "SELECT qtr, year, COUNT(*) AS row_cnt FROM payroll_raw WHERE upper(qtr) = 'A' GROUP BY 1, 2")
def _flt4(spark, d):
    return filters.annual_rows(t.payroll_raw(spark, d)).groupBy("qtr", "year").agg(F.count(F.lit(1)).alias("row_cnt"))


@query(
    "flt5_private_ownership",
    """SELECT own_code, year, COUNT(*) AS row_cnt FROM payroll_raw WHERE own_code = '5' GROUP BY 1, 2
       UNION ALL SELECT '5', 'backfilled', COUNT(*) FROM payroll_raw""",
)
def _flt5(spark, d):
    raw = t.payroll_raw(spark, d)
    kept = filters.ownership(raw).groupBy("own_code", "year").agg(F.count(F.lit(1)).alias("row_cnt"))
    filled = filters.ownership(raw.drop("own_code")).groupBy("own_code").agg(F.count(F.lit(1)).alias("row_cnt"))
    return kept.unionByName(filled.withColumn("year", F.lit("backfilled")))


@query(
    "flt6_total_or_private_ownership",
    "SELECT own_code, agglvl_code, COUNT(*) AS row_cnt FROM payroll_raw WHERE own_code = (SELECT CASE WHEN bool_or(own_code = '0') THEN '0' ELSE '5' END FROM payroll_raw) GROUP BY 1, 2",
)
def _flt6(spark, d):
    return filters.total_ownership_or_private(t.payroll_raw(spark, d)).groupBy("own_code", "agglvl_code").agg(F.count(F.lit(1)).alias("row_cnt"))


@query("flt7_aggregation_level", f"SELECT {_RAW} FROM payroll_raw WHERE agglvl_code = '74'")
def _flt7(spark, d):
    return filters.aggregation_level(payroll.resolve(t.payroll_raw(spark, d)))


@query("flt8_sector_allow_list", f"SELECT p_partkey, naics2_sector_cd FROM industry WHERE naics2_sector_cd IN {SECTOR_LIST}")
def _flt8(spark, d):
    return filters.canonical_sectors(t.industries(spark, d)).select("p_partkey", "naics2_sector_cd")


@query("flt9_five_digit_code", "SELECT p_partkey, code FROM (SELECT p_partkey, CAST(p_partkey * 37 AS VARCHAR) AS code FROM part) WHERE regexp_matches(code, '^[0-9]{5}$')")
def _flt9(spark, d):
    df = t.read(spark, d, "part").select("p_partkey", (C("p_partkey") * 37).cast("string").alias("code"))
    return filters.county_codes(df, "code")


_ROLL = "SELECT '{}' AS part, state_cnty_fips_cd, naics2_sector_cd, year_num, qcew_ann_avg_emp_lvl_num FROM payroll WHERE {}"


@query(
    "flt10_rollup_rows",
    _ROLL.format("county", "substr(state_cnty_fips_cd,3,3) <> '000'") + " UNION ALL " + _ROLL.format("statewide", "substr(state_cnty_fips_cd,3,3) = '000'"),
)
def _flt10(spark, d):
    df = t.payroll(spark, d).select("state_cnty_fips_cd", "naics2_sector_cd", "year_num", "qcew_ann_avg_emp_lvl_num")
    return filters.without_statewide(df).withColumn("part", F.lit("county")).unionByName(
        filters.only_statewide(df).withColumn("part", F.lit("statewide"))
    )


@query(
    "flt11_sector_totals",
    _ROLL.format("total", "naics2_sector_cd IN ('00','99')") + " UNION ALL " + _ROLL.format("sector", "naics2_sector_cd NOT IN ('00','99')"),
)
def _flt11(spark, d):
    df = t.payroll(spark, d).select("state_cnty_fips_cd", "naics2_sector_cd", "year_num", "qcew_ann_avg_emp_lvl_num")
    return filters.sector_totals(df, True).withColumn("part", F.lit("total")).unionByName(
        filters.sector_totals(df, False).withColumn("part", F.lit("sector"))
    )


@query(
    "flt12_five_long_not_national",
    "SELECT c_custkey, code FROM (SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN '00000' WHEN c_custkey % 3 = 1 THEN lpad(CAST(c_nationkey AS VARCHAR), 5, '0') ELSE '123456' END AS code FROM customer) WHERE length(code) = 5 AND code <> '00000'",
)
def _flt12(spark, d):
    code = F.when(C("c_custkey") % 3 == 0, "00000").when(
        C("c_custkey") % 3 == 1, codes.zfill(C("c_nationkey").cast("string"), 5)
    ).otherwise("123456")
    return filters.five_long_not_national(t.read(spark, d, "customer").select("c_custkey", code.alias("code")), "code")


_GAPPY = """SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN o_custkey END AS a, CASE WHEN o_orderkey % 3 = 0 THEN o_custkey END AS b FROM orders"""


@query(
    "flt13_drop_null_rows",
    f"SELECT 'all' AS how, * FROM ({_GAPPY}) WHERE a IS NOT NULL OR b IS NOT NULL UNION ALL SELECT 'any', * FROM ({_GAPPY}) WHERE a IS NOT NULL AND b IS NOT NULL",
)
def _flt13(spark, d):
    df = t.read(spark, d, "orders").select(
        "o_orderkey", F.when(C("o_orderkey") % 2 == 0, C("o_custkey")).alias("a"), F.when(C("o_orderkey") % 3 == 0, C("o_custkey")).alias("b")
    )
    return filters.drop_null_rows(df, ["a", "b"], "all").withColumn("how", F.lit("all")).unionByName(
        filters.drop_null_rows(df, ["a", "b"], "any").withColumn("how", F.lit("any"))
    )


@query("flt14_state_list", "SELECT c_custkey, state_fips_cd AS state FROM customer JOIN geo ON c_nationkey = n_nationkey WHERE state_fips_cd IN ('01','04')")
def _flt14(spark, d):
    df = t.read(spark, d, "customer").join(t.geography(spark, d), C("c_nationkey") == C("n_nationkey"))
    return filters.states(df.select("c_custkey", C("state_fips_cd").alias("state")), ["1", "04"])


@query(
    "flt15_county_sector_list",
    "SELECT * FROM survey_cells WHERE state_cnty_fips_cd IN ('01001','02002','03003') AND naics2_sector_cd IN ('42','62')",
    "abs_payroll_usd_amt", "abs_rcpt_usd_amt",
)
def _flt15(spark, d):
    return filters.counties_and_sectors(t.survey_cells(spark, d), ["01001", "02002", "03003"], ["42", "62"])


@query("flt16_industries_under_prefix", "SELECT p_partkey, code FROM (SELECT p_partkey, CAST(p_partkey AS VARCHAR) AS code FROM part) WHERE code LIKE '5%' AND length(code) = 3")
def _flt16(spark, d):
    df = t.read(spark, d, "part").select("p_partkey", C("p_partkey").cast("string").alias("code"))
    return filters.industries_under(df, "5", 3, "code")


@query(
    "flt17_hierarchy_levels",
    "SELECT code, CAST(length(code) AS INTEGER) AS code_level FROM (SELECT CAST(o_orderkey AS VARCHAR) AS code FROM orders) WHERE regexp_matches(code, '^[0-9]{2,6}$')",
)
def _flt17(spark, d):
    return filters.hierarchy_level(t.read(spark, d, "orders").select(C("o_orderkey").cast("string").alias("code")), "code")


@query("flt18_out_of_range", "SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal < 0 OR c_acctbal > 9000", "c_acctbal")
def _flt18(spark, d):
    return filters.out_of_range(t.read(spark, d, "customer"), "c_acctbal", 0, 9000).select("c_custkey", "c_acctbal")


@query(
    "flt19_non_numeric_tokens",
    "SELECT DISTINCT token FROM (SELECT annual_avg_emplvl AS token FROM payroll_raw UNION ALL SELECT qtr FROM payroll_raw) WHERE NOT regexp_matches(token, '^[0-9,.\\-]+$')",
)
def _flt19(spark, d):
    return filters.non_numeric_tokens(t.payroll_raw(spark, d), ["annual_avg_emplvl", "qtr"])


@query("flt20_national_lines", """SELECT * FROM gdp_wide WHERE regexp_replace(GeoFIPS, '[" ]', '', 'g') = '00000'""")
def _flt20(spark, d):
    return filters.national_lines(t.gdp_wide(spark, d), "GeoFIPS")
