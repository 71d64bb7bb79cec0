"""Reference tables: counties, population, sectors."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from regionledger import schemas as S
from regionledger.functions import codes, exprs
from regionledger.operators import aggregates, columns, filters, sets
from regionledger.sources.literals import literal

GAZETTEER_NAMES = {
    "GEOID": "state_cnty_fips_cd", "USPS": "state_cd", "ANSICODE": "cnty_ansi_nm", "NAME": "cnty_nm",
    "ALAND": "land_area_num", "AWATER": "water_area_num", "INTPTLAT": "lat_num", "INTPTLONG": "long_num",
}
TEXT = ["state_cnty_fips_cd", "state_cd", "cnty_ansi_nm", "cnty_nm"]


def counties(gazetteer: DataFrame, supplements: bool = True) -> DataFrame:
    """County file plus statewide, unspecified and no longer listed counties."""
    columns.require_columns(gazetteer, GAZETTEER_NAMES)
    types = {"land_area_num": "bigint", "water_area_num": "bigint", "lat_num": "double", "long_num": "double"}
    out = gazetteer.select(
        *[
            (F.trim(src) if dst in TEXT else exprs.to_number(F.col(src), types[dst])).alias(dst)
            for src, dst in GAZETTEER_NAMES.items()
        ]
    ).withColumn("state_cnty_fips_cd", codes.zfill(F.col("state_cnty_fips_cd"), 5))
    out = filters.county_codes(out)
    out = aggregates.keep_one(out, ["state_cnty_fips_cd"], [F.col("cnty_nm"), F.col("cnty_ansi_nm")])
    return sets.append_absent(out, supplement_rows(out), ["state_cnty_fips_cd"]) if supplements else out


def supplement_rows(df: DataFrame) -> DataFrame:
    spark = df.sparkSession
    manual = literal(spark, S.COUNTY_SUPPLEMENTS, "state_cnty_fips_cd string, state_cd string, cnty_nm string")
    return sets.state_rollup_rows(sets.state_table(spark)).unionByName(manual)


def with_population(ref: DataFrame, population: DataFrame, year: int) -> DataFrame:
    """Attach population by county code."""
    pop = population.select(
        F.concat(codes.zfill(F.col("state"), 2), codes.zfill(F.col("county"), 3)).alias("state_cnty_fips_cd"),
        exprs.to_number(F.col("population").cast("string"), "bigint").alias("population_num"),
        F.lit(year).cast("bigint").alias("population_year"),
    )
    return ref.join(pop, "state_cnty_fips_cd", "left")


def population_matches(ref: DataFrame) -> DataFrame:
    return ref.agg(F.count(F.lit(1)).alias("county_cnt"), F.count("population_num").alias("matched_cnt"))


def sectors(raw: DataFrame) -> DataFrame:
    """Sector labels plus the all-sector and unclassified rows."""
    base = raw.select(F.trim("naics2_sector_cd").alias("naics2_sector_cd"), F.trim("naics2_sector_desc").alias("naics2_sector_desc"))
    return sets.append_rows(base, S.SECTOR_EXTRAS, "naics2_sector_cd string, naics2_sector_desc string")
