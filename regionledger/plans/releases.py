"""Toxic releases: facility rows to county x sector, with county codes from names."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from regionledger import schemas as S
from regionledger.functions import codes, exprs
from regionledger.operators import aggregates, columns, joins, quality, sets
from regionledger.sources.literals import literal

TOTAL_NAMES = ["TOTAL_RELEASES_LBS", "TOTAL_RELEASE_LBS"]
INDUSTRY_NAMES = ["PRIMARY_NAICS", "PRIMARY_NAICS_CODE", "NAICS_CODE"]
KEY = ["state", "county", "naics2"]
NAME_VARIANTS = ["county", "county_ascii", "county_full"]


def facilities(raw: DataFrame) -> DataFrame:
    """State, county, sector and pounds; pounds from a total or from its parts."""
    columns.require_columns(raw, ["FIPS_STATE", "FIPS_COUNTY"])
    total = next((n for n in TOTAL_NAMES if n in raw.columns), None)
    if total:
        pounds = exprs.to_money(F.col(total))
    else:
        parts = [c for c in raw.columns if c.upper().endswith("_RELEASE_LBS")]
        if not parts:
            raise ValueError("no release columns in the facility file")
        pounds = exprs.sum_filled([columns.quoted(c) for c in parts])
    industry = next((n for n in INDUSTRY_NAMES if n in raw.columns), None)
    if industry is None:
        raise ValueError("no industry column in the facility file")
    return raw.select(
        codes.zfill_digits(F.col("FIPS_STATE"), 2).alias("state"),
        codes.zfill_digits(F.col("FIPS_COUNTY"), 3).alias("county"),
        F.substring(industry, 1, 2).alias("naics2"),
        pounds.alias("tri_releases_lbs"),
    )


def by_county(df: DataFrame, states: list[str] | None = None) -> DataFrame:
    if states:
        df = df.where(F.col("state").isin([s.zfill(2) for s in states]))
    return df.where(F.col("naics2").isNotNull()).groupBy(*KEY).agg(
        aggregates.sum_or_zero("tri_releases_lbs").alias("tri_releases_lbs")
    )


def by_county_name(raw: DataFrame) -> DataFrame:
    """On-site plus off-site pounds per state, county name and sector."""
    wanted = {
        "naics": "PRIMARY NAICS CODE", "state": "FACILITY STATE", "county": "FACILITY COUNTY",
        "on_site": "TOTAL ON-SITE RELEASES", "off_site": "TOTAL TRANSFERRED OFF SITE FOR DISPOSAL",
    }
    found = {k: columns.find_column(raw.columns, v) for k, v in wanted.items()}
    missing = [k for k, v in found.items() if v is None]
    if missing:
        raise ValueError(f"release file is missing columns: {missing}")
    col = {k: columns.quoted(v) for k, v in found.items()}
    sector = F.nullif(F.substring(codes.first_digits(col["naics"]), 1, 2), F.lit(""))
    pounds = lambda k: F.coalesce(exprs.to_money(col[k]), F.lit(0).cast(S.MONEY))
    rows = raw.select(
        F.substring(F.upper(F.trim(col["state"])), 1, 2).alias("state_cd"),
        F.upper(F.trim(col["county"])).alias("cnty_nm"),
        sector.alias("naics2_sector_cd"),
        (pounds("on_site") + pounds("off_site")).alias("tri_ttl_rls_lbs_amt"),
    ).dropna(subset=["state_cd", "cnty_nm", "naics2_sector_cd"])
    return rows.groupBy("state_cd", "cnty_nm", "naics2_sector_cd").agg(
        F.sum("tri_ttl_rls_lbs_amt").alias("tri_ttl_rls_lbs_amt")
    )


def county_lookup(reference: DataFrame, overrides: DataFrame | None = None) -> DataFrame:
    """(state, name key) to county code from three name spellings; overrides win.

    Where two counties of a state share a key, the spelling order and then the
    smaller code decide.
    """
    keyed = reference.select(
        F.upper("state_id").alias("state_code"),
        codes.zfill(F.col("county_fips"), 5).alias("county_fips_5"),
        *[codes.county_name_key(F.col(c)).alias(c) for c in NAME_VARIANTS],
    )
    long = columns.melt(keyed, ["state_code", "county_fips_5"], NAME_VARIANTS, "variant", "county_name_norm")
    order = F.create_map(*[F.lit(x) for i, c in enumerate(NAME_VARIANTS) for x in (c, i)])
    base = aggregates.keep_one(
        long, ["state_code", "county_name_norm"], [order[F.col("variant")], F.col("county_fips_5")]
    ).drop("variant")
    if overrides is None:
        overrides = literal(
            reference.sparkSession, S.COUNTY_NAME_OVERRIDES,
            "state_code string, county_name_norm string, county_fips_5 string",
        )
    return sets.with_overrides(base, overrides, ["state_code", "county_name_norm"])


def with_county_codes(totals: DataFrame, lookup: DataFrame) -> DataFrame:
    """Attach county codes by state and normalised name."""
    keyed = totals.withColumn("state_code", F.upper("state_cd")).withColumn(
        "county_name_norm", codes.county_name_key(F.col("cnty_nm"))
    )
    return keyed.join(lookup, ["state_code", "county_name_norm"], "left").select(
        "state_cd", "cnty_nm", F.col("county_fips_5").alias("state_cnty_fips_cd"), "naics2_sector_cd",
        exprs.half_even(exprs.fill_zero(F.col("tri_ttl_rls_lbs_amt").cast("double")), 2).alias("tri_ttl_rls_lbs_amt"),
    )


def resolve_rate(coded: DataFrame) -> DataFrame:
    """Share of rows with a code; territories without counties do not count."""
    scope = coded.where(~F.upper("state_cd").isin(S.TERRITORIES_WITHOUT_COUNTIES))
    hit = F.col("state_cnty_fips_cd").isNotNull()
    return scope.agg(
        F.count(F.lit(1)).alias("resolvable_cnt"), F.count_if(hit).alias("resolved_cnt"),
        F.try_divide(F.count_if(hit), F.count(F.lit(1))).alias("resolve_rate"),
        F.count_if(hit & (F.length("state_cnty_fips_cd") != 5)).alias("bad_length_cnt"),
    )


def unresolved(coded: DataFrame) -> DataFrame:
    scope = coded.where(~F.upper("state_cd").isin(S.TERRITORIES_WITHOUT_COUNTIES))
    return scope.where(F.col("state_cnty_fips_cd").isNull()).select("state_cd", "cnty_nm").distinct()


def intensity(totals: DataFrame, survey: DataFrame | None, payroll: DataFrame | None) -> DataFrame:
    """Releases with survey and payroll measures and pounds per employee and firm.

    Repeated full rows of the other sources collapse; a key that still repeats
    fails the job, so the result stays one row per release cell.
    """
    out = quality.require_non_negative(totals, ["tri_releases_lbs"], "release totals")
    for other in (survey, payroll):
        if other is not None:
            out = joins.many_to_one(out, other.distinct(), KEY)
    pounds = F.col("tri_releases_lbs").cast("double")
    if payroll is not None:
        out = out.withColumn("tri_lbs_per_emp", exprs.positive_ratio(pounds, F.col("qcew_emp").cast("double")))
    if survey is not None:
        out = out.withColumn("tri_lbs_per_firm", exprs.positive_ratio(pounds, F.col("abs_firms").cast("double")))
    return out
