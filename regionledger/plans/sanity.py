"""Check suite over an exported fact (all text) and its two reference tables."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from regionledger.functions import codes, exprs
from regionledger.operators import columns, joins, quality, sets
from regionledger.operators.quality import ERROR, WARN, Check
from regionledger.sources import readers
from regionledger.sources.literals import literal

# Accepted export names per canonical column, best first.
FACT_NAMES = {
    "year_num": ["year_num", "year"],
    "state_cnty_fips_cd": ["state_cnty_fips_cd", "county_fips", "fips"],
    "naics2_sector_cd": ["naics2_sector_cd", "naics2", "naics2_cd"],
    "abs_firms": ["abs_firms", "abs_num_firms", "abs_firm_num"],
    "abs_emp": ["abs_emp", "abs_employment", "abs_emp_num"],
    "abs_payroll_usd_amt": ["abs_payroll_usd_amt", "abs_payroll"],
    "abs_rcpt_usd_amt": ["abs_rcpt_usd_amt", "abs_receipts"],
    "qcew_emp": ["qcew_emp", "qcew_employment", "qcew_ann_avg_emp_lvl_num"],
    "qcew_wages_usd": ["qcew_wages_usd", "qcew_wages", "qcew_ttl_ann_wage_usd_amt"],
    "qcew_avg_weekly_wage_usd": ["qcew_avg_weekly_wage_usd", "qcew_avg_weekly_wage", "qcew_avg_wkly_wage_usd_amt"],
}
SECTOR_NAMES = {
    "naics2_sector_cd": ["naics2_sector_cd", "naics2", "naics2_cd"],
    "naics2_sector_name": ["naics2_sector_name", "sector_name", "sector_label", "naics2_name", "naics2_sector_desc"],
}
COUNTY_NAMES = {
    "state_cnty_fips_cd": ["state_cnty_fips_cd", "fips", "county_fips"],
    "state_fips": ["state_fips", "state_fips_cd"],
    "county_fips": ["county_fips", "county_fips_cd"],
    "county_name": ["county_name", "cnty_name", "cnty_nm"],
    "state_abbr": ["state_abbr", "state_cd"],
}
COUNTY_REQUIRED = ["state_cnty_fips_cd", "county_name", "state_abbr"]
SURVEY = ["abs_firms", "abs_emp", "abs_payroll_usd_amt", "abs_rcpt_usd_amt"]
COUNTS = ["abs_firms", "abs_emp", "qcew_emp"]
DOLLARS = ["abs_payroll_usd_amt", "abs_rcpt_usd_amt", "qcew_wages_usd", "qcew_avg_weekly_wage_usd"]
KEY = ["year_num", "state_cnty_fips_cd", "naics2_sector_cd"]
# What a complete export holds.
EXPECTED_YEARS = [2022, 2023]
EXPECTED_COUNTIES = 3283
EXPECTED_SECTORS = 20
CHECK_DDL = "check string, severity string, passed boolean, failed_rows bigint, detail string"


def canonical(df: DataFrame, names: dict[str, list[str]]) -> tuple[DataFrame, list[str]]:
    found, missing = columns.match_columns(df.columns, names)
    return df.select([columns.quoted(src).alias(dst) for dst, src in found.items()]), missing


def load_checked(spark: SparkSession, path: str, label: str) -> tuple[DataFrame | None, DataFrame]:
    """Export file and its file-level checks; no frame when it is missing or empty.

    A row with more cells than the header is a malformed row. Reading one column
    more than the header has makes exactly those rows show a value there.
    """
    def rows(*facts: tuple) -> DataFrame:
        return literal(spark, [(f"{label}: {n}", ERROR, bad == 0, bad, d) for n, bad, d in facts], CHECK_DDL)

    try:
        df = readers.csv_text(spark, path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return None, rows(("file exists", 1, "no such file"))
    if not df.columns:
        return None, rows(("file exists", 0, "found"), ("file non-empty", 1, "no header"))
    wide = readers.text_schema([f"c{i}" for i in range(len(df.columns))] + ["overflow"])
    cells = spark.read.schema(wide).option("header", True).option("escape", '"').option("enforceSchema", True).csv(path)
    parsed = quality.run_checks(
        cells, [Check(f"{label}: rows parse cleanly", ERROR, F.count("overflow"), "rows with more cells than the header")]
    )
    return df, rows(("file exists", 0, "found"), ("file non-empty", 0, "header read")).unionByName(parsed)


def header_checks(label: str, df: DataFrame, missing: list[str]) -> list[tuple]:
    """Checks that need the header only; they read no rows."""
    names = df.columns
    blank = sum(1 for c in names if not c.strip())
    facts = [
        ("required columns", len(missing), "missing: " + ", ".join(missing) if missing else "all present"),
        ("delimiter", int(len(names) < 2), f"{len(names)} columns"),
        ("non-empty headers", blank, "column names present"),
        ("unique headers", len(names) - len(set(names)), "column names unique"),
    ]
    return [(f"{label}: {n}", ERROR, bad == 0, bad, detail) for n, bad, detail in facts]


def row_checks(fact: DataFrame, expected_years: list[int]) -> DataFrame:
    """Every per-row check of the fact in one aggregation."""
    year = exprs.to_number(F.col("year_num"))
    number = {c: exprs.to_number(F.col(c)) for c in SURVEY + ["qcew_emp", "qcew_wages_usd", "qcew_avg_weekly_wage_usd"]}
    filled = sum((number[c].isNotNull().cast("int") for c in SURVEY[1:]), number[SURVEY[0]].isNotNull().cast("int"))
    below = lambda names: sum(
        (F.count_if(number[c] < 0) for c in names[1:]), F.count_if(number[names[0]] < 0)
    )
    science = sum((F.count_if(exprs.is_scientific(F.col(c))) for c in list(number)[1:]), F.count_if(exprs.is_scientific(F.col("abs_firms"))))
    sector = F.col("naics2_sector_cd")
    return quality.run_checks(fact, [
        Check("fact: county code format", ERROR, F.count_if(~F.coalesce(codes.is_county_code(F.col("state_cnty_fips_cd")), F.lit(False))), "rows without a five-digit code"),
        Check("fact: year numeric", ERROR, F.count_if(year.isNull()), "rows without a numeric year"),
        Check("fact: year integer", ERROR, F.count_if(exprs.not_integral(year)), "rows with a fractional year"),
        Check("fact: year expected", WARN, F.count_if(~year.isin([float(y) for y in expected_years])), "rows of other years"),
        Check("fact: sector present", ERROR, F.count_if(sector.isNull() | (F.trim(sector) == "")), "rows without a sector"),
        Check("fact: partial survey rows", WARN, F.count_if(filled.between(1, len(SURVEY) - 1)), "rows with some survey measures only"),
        Check("fact: negative counts", ERROR, below(COUNTS), "negative firms or employment"),
        Check("fact: negative dollars", WARN, below(DOLLARS), "negative dollar values"),
        Check("fact: scientific notation", WARN, science, "cells in scientific notation"),
    ])


def key_check(fact: DataFrame) -> DataFrame:
    dup = quality.surplus_rows(fact, KEY)
    return quality.run_checks(dup, [Check("fact: duplicate keys", ERROR, F.max("duplicate_keys"), "keys used more than once")])


def join_checks(fact: DataFrame, ref: DataFrame, key: str, label: str) -> DataFrame:
    """Codes missing from the reference (error) and reference codes never used (warning)."""
    def counted(df: DataFrame, name: str, severity: str, detail: str) -> DataFrame:
        return quality.run_checks(df, [Check(name, severity, F.count(F.lit(1)), detail)])

    missing = counted(joins.unmatched(fact, ref, [key]), f"join: fact to {label}", ERROR, "codes not in the reference")
    unused = counted(joins.unmatched(ref, fact, [key]), f"join: {label} to fact", WARN, "reference codes not used")
    return missing.unionByName(unused)


def coverage_checks(fact: DataFrame, counties: int, sectors: int) -> DataFrame:
    """Distinct counties and sectors per year against the expected numbers."""
    typed = fact.withColumn("year_num", exprs.to_number(F.col("year_num")).cast("int")).where(F.col("year_num").isNotNull())
    found = quality.expected_distincts(typed, counties, sectors)
    return found.select(
        F.concat(F.lit("coverage: distinct "), "what", F.lit(" "), F.col("year_num").cast("string")).alias("check"),
        F.lit(WARN).alias("severity"), "passed",
        F.abs(F.col("found_cnt") - F.col("expected_cnt")).alias("failed_rows"),
        F.concat(F.col("found_cnt").cast("string"), F.lit(" found, "), F.col("expected_cnt").cast("string"), F.lit(" expected")).alias("detail"),
    )


def run(
    fact: DataFrame, sectors: DataFrame, counties: DataFrame, expected_years: list[int] = EXPECTED_YEARS,
    expected_counties: int = EXPECTED_COUNTIES, expected_sectors: int = EXPECTED_SECTORS,
) -> DataFrame:
    """All checks as rows; the caller writes them or asks :func:`quality.verdict`."""
    spark = fact.sparkSession
    counties = quality.combined_key(counties, "state_fips", "county_fips")
    f, fact_missing = canonical(fact, FACT_NAMES)
    s, sector_missing = canonical(sectors, SECTOR_NAMES)
    c, county_missing = canonical(counties, COUNTY_NAMES)
    county_missing = [m for m in county_missing if m in COUNTY_REQUIRED]
    heads = (
        header_checks("fact", fact, fact_missing) + header_checks("sectors", sectors, sector_missing)
        + header_checks("counties", counties, county_missing)
    )
    parts = [literal(spark, heads, CHECK_DDL)]
    if not (fact_missing or sector_missing or county_missing):
        parts += [
            row_checks(f, expected_years), key_check(f),
            join_checks(f, c, "state_cnty_fips_cd", "counties"), join_checks(f, s, "naics2_sector_cd", "sectors"),
            coverage_checks(f, expected_counties, expected_sectors),
        ]
    return sets.stack(parts)
