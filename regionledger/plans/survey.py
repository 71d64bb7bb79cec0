"""Business survey clean-up: published rows in $1,000s to the canonical table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from regionledger import schemas as S
from regionledger.functions import codes, exprs
from regionledger.operators import aggregates, columns, filters, quality

FIELDS = ["NAME", "GEO_ID", "FIRMPDEMP", "EMP", "PAYANN", "RCPPDEMP", "INDLEVEL"]

# Accepted source names per canonical column, best first.
SYNONYMS = {
    "state": ["state", "state_fips"],
    "county": ["county", "county_fips"],
    "naics_any": ["naics2022", "naics"],
    "FIRMPDEMP": ["firmpdemp", "firms", "firmpdem"],
    "EMP": ["emp", "employment"],
    "PAYANN": ["payann", "annual_payroll"],
    "RCPPDEMP": ["rcppdemp", "receipts"],
    "year": ["year"],
}


def sector_field(year: int) -> str:
    """Name of the industry field in a year's payload; county data begin in 2022."""
    if year < 2022:
        raise ValueError(f"county survey data begin in 2022, not {year}")
    return "NAICS2022" if year in (2022, 2023) else f"NAICS{year}"


def private_employers(raw: DataFrame, sector: str = "NAICS2022") -> DataFrame:
    return filters.without_public_administration(filters.employers(raw, "FIRMPDEMP"), sector)


def normalise(raw: DataFrame, sector: str = "NAICS2022", label: str = "NAICS2022_LABEL") -> DataFrame:
    """Published text columns to the 13-column survey table, money in dollars."""
    money = lambda c: exprs.from_thousands(exprs.to_money(F.col(c))).cast(S.MONEY)
    count = lambda c: exprs.to_number(F.col(c), "decimal(38,0)").cast("bigint")
    base = columns.drop_duplicate_headers(raw).select(
        F.col("year_num").try_cast("int").alias("year_num"),
        F.concat(codes.zfill(F.col("state"), 2), codes.zfill(F.col("county"), 3)).alias("state_cnty_fips_cd"),
        F.trim(sector).alias("naics2_sector_cd"),
        F.col("NAME").alias("cnty_nm"),
        F.col("GEO_ID").alias("geo_id"),
        F.col(label).alias("naics2_sector_desc"),
        count("INDLEVEL").alias("ind_level_num"),
        count("FIRMPDEMP").alias("abs_firm_num"),
        count("EMP").alias("abs_emp_num"),
        money("PAYANN").alias("abs_payroll_usd_amt"),
        money("RCPPDEMP").alias("abs_rcpt_usd_amt"),
    )
    # Divided as doubles, as the source does: a decimal quotient would be rounded twice.
    per = lambda den: exprs.half_even(
        exprs.safe_ratio(F.col("abs_rcpt_usd_amt").cast("double"), F.col(den).cast("double")), 6
    ).cast(S.MONEY)
    return base.withColumns(
        {"abs_rcpt_per_emp_usd_amt": per("abs_emp_num"), "abs_rcpt_per_firm_usd_amt": per("abs_firm_num")}
    ).select([f.name for f in S.SURVEY.fields])


def table(raw: DataFrame) -> DataFrame:
    return normalise(private_employers(raw))


def one_state(raw: DataFrame, state: str, year: int | None = None) -> DataFrame:
    """County x two-digit totals of one state; a negative total fails the job."""
    df = columns.rename_synonyms(raw, SYNONYMS, ("year",))
    df = df.withColumn("state", codes.zfill_digits(F.col("state"), 2)).where(F.col("state") == state)
    keys = ["state", "county", "naics2"]
    if "year" in df.columns:
        df = df.withColumn("year", exprs.to_number(F.col("year")).cast("int"))
        keys.append("year")
        if year is not None:
            df = df.where(F.col("year") == year)
    df = df.withColumn("county", codes.zfill_digits(F.col("county"), 3)).withColumn(
        "naics2", F.substring(codes.digits_only(F.col("naics_any")), 1, 2)
    ).where(F.col("naics2").rlike("^[0-9]{2}$"))
    total = lambda c, k: aggregates.sum_or_zero(exprs.to_money(F.col(c)) * F.lit(k))
    out = df.groupBy(*keys).agg(
        total("FIRMPDEMP", 1).alias("abs_firms"), total("EMP", 1).alias("abs_emp"),
        total("PAYANN", 1000).alias("abs_payroll_usd"), total("RCPPDEMP", 1000).alias("abs_receipts_usd"),
    )
    return quality.require_non_negative(
        out, ["abs_firms", "abs_emp", "abs_payroll_usd", "abs_receipts_usd"], "survey state table"
    )


def derived_metrics(df: DataFrame, rounded: bool = False) -> DataFrame:
    """Wage per employee, receipts per firm and employee, payroll share, firm density."""
    n = {c: exprs.to_number(F.col(c).cast("string")) for c in ("FIRMPDEMP", "EMP", "PAYANN", "RCPPDEMP")}
    out = {
        "avg_wage_per_emp_dollars": (exprs.positive_ratio(n["PAYANN"] * 1000, n["EMP"]), 2),
        "receipts_per_firm_dollars": (exprs.positive_ratio(n["RCPPDEMP"] * 1000, n["FIRMPDEMP"]), 2),
        "payroll_to_receipts": (exprs.positive_ratio(n["PAYANN"], n["RCPPDEMP"]), 4),
        "receipts_per_emp_dollars": (exprs.positive_ratio(n["RCPPDEMP"] * 1000, n["EMP"]), 2),
        "firms_per_1k_emp": (exprs.positive_ratio(n["FIRMPDEMP"] * 1000, n["EMP"]), 3),
    }
    return df.withColumns({k: exprs.half_even(v, d) if rounded else v for k, (v, d) in out.items()})
