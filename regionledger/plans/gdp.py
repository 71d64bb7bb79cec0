"""Regional GDP clean-up."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from regionledger import schemas as S
from regionledger.functions import codes, exprs
from regionledger.operators import aggregates, columns, filters, joins, quality

KEY = ["state_county_fips_cd", "line_cd", "naics_sector_cd"]


def value_column(year: int) -> str:
    return f"{year}_gdp_num"


def tidy(raw: DataFrame, years: list[int]) -> DataFrame:
    """Wide file in $1,000s to county rows with one dollar column per year."""
    columns.require_columns(
        raw, ["GeoFIPS", "LineCode", "IndustryClassification", "Description", *map(str, years)]
    )
    fips = codes.zfill(codes.strip_quotes(F.col("GeoFIPS")), 5)
    values = [
        exprs.from_thousands(exprs.to_number(columns.quoted(str(y)))).alias(value_column(y)) for y in years
    ]
    out = raw.select(
        fips.alias("state_county_fips_cd"),
        F.col("LineCode").alias("line_cd"),
        F.col("IndustryClassification").alias("naics_sector_cd"),
        F.col("Description").alias("naics_sector_desc"),
        *values,
    )
    out = filters.five_long_not_national(out, "state_county_fips_cd")
    return filters.drop_null_rows(out, [value_column(y) for y in years], "all")


def long_form(tidied: DataFrame, years: list[int]) -> DataFrame:
    """One row per county, line and year."""
    ids = [*KEY, "naics_sector_desc"]
    long = columns.melt(tidied, ids, [value_column(y) for y in years], "year_label", "gdp_amt")
    return long.withColumn("year_num", F.substring("year_label", 1, 4).cast("int")).drop("year_label")


def suppressed(raw: DataFrame, years: list[int]) -> DataFrame:
    return aggregates.token_count(raw, [f"`{y}`" for y in years], S.GDP_SUPPRESSION_TOKENS)


def checks(tidied: DataFrame, years: list[int]) -> DataFrame:
    """Repeated keys and negative values."""
    negatives = quality.non_negative(tidied, [value_column(y) for y in years])
    return quality.unique_key(tidied, KEY, "unique county line").unionByName(negatives)


def from_payload(data: DataFrame) -> DataFrame:
    """Accounts payload rows to county x sector values, overlaps removed."""
    out = data.where(F.length("geofips") == 5).select(
        F.col("geofips").alias("county_fips"),
        codes.gdp_group_sector(F.col("industryclassification")).alias("naics2"),
        exprs.to_number(F.col("timeperiod")).cast("int").alias("year"),
        exprs.to_number(codes.strip_thousands(F.col("datavalue"))).alias("gdp_current_usd"),
        "geoname", "industryclassification", "description",
    )
    keys = ["county_fips", "naics2", "year", "gdp_current_usd"]
    # The first copy wins there by file order; here the smallest labels win.
    return aggregates.keep_one(
        out.where(F.col("naics2").isNotNull()), keys,
        [F.col("geoname"), F.col("industryclassification"), F.col("description")],
    )


def line_reference(raw: DataFrame, year: int) -> DataFrame:
    """National rows as the line reference."""
    return filters.national_lines(raw, "GeoFIPS").select(
        "LineCode", "IndustryClassification", F.col("Description").alias("line_desc"),
        exprs.to_number(columns.quoted(str(year))).alias("national_gdp"),
    )


def attach_lines(county: DataFrame, lines: DataFrame) -> DataFrame:
    """Left join on (sector, line code) under their two spellings."""
    ref = lines.withColumnRenamed("LineCode", "ref_line_code")
    return joins.on_differing_names(
        county, ref, [("naics_sector", "IndustryClassification"), ("line_code", "ref_line_code")]
    ).drop("ref_line_code")


def without_national_value(attached: DataFrame) -> DataFrame:
    return attached.where(F.col("national_gdp").isNull())


