"""Reusable row filters. Each keeps the predicate plain so that it reaches the scan."""

from __future__ import annotations


from pyspark.sql import DataFrame, functions as F

from regionledger import schemas as S
from regionledger.functions import codes, exprs


def employers(df: DataFrame, firms: str) -> DataFrame:
    return df.where(exprs.to_number(F.col(firms)) > 0)


def without_public_administration(df: DataFrame, sector: str) -> DataFrame:
    return df.where(F.trim(sector) != "92")


def one_year(df: DataFrame, year: int, column: str = "year_num") -> DataFrame:
    return df.where(F.col(column) == str(year))


def annual_rows(df: DataFrame, column: str = "qtr") -> DataFrame:
    return df.where(F.upper(column) == "A") if column in df.columns else df


def ownership(df: DataFrame, code: str = "5", column: str = "own_code") -> DataFrame:
    """Keep one ownership code; a file without the column is taken to hold only it."""
    if column not in df.columns:
        return df.withColumn(column, F.lit(code))
    return df.withColumn(column, F.trim(column)).where(F.col(column) == code)


def total_ownership_or_private(df: DataFrame, column: str = "own_code") -> DataFrame:
    """Code ``0`` when the file has any such row, else ``5``; one scalar decides."""
    wanted = df.agg(
        F.when(F.bool_or(F.col(column) == "0"), F.lit("0")).otherwise(F.lit("5"))
    ).scalar()
    return df.where(F.col(column) == wanted)


def aggregation_level(df: DataFrame, level: str = "74", column: str = "agg_lvl_cd") -> DataFrame:
    return df.where(F.col(column) == level) if column in df.columns else df


def canonical_sectors(df: DataFrame, column: str = "naics2_sector_cd") -> DataFrame:
    return df.where(F.col(column).isin(S.SECTORS))


def county_codes(df: DataFrame, column: str = "state_cnty_fips_cd") -> DataFrame:
    return df.where(codes.is_county_code(F.col(column)))


def without_statewide(df: DataFrame, column: str = "state_cnty_fips_cd") -> DataFrame:
    return df.where(~codes.is_statewide(F.col(column)))


def only_statewide(df: DataFrame, column: str = "state_cnty_fips_cd") -> DataFrame:
    return df.where(codes.is_statewide(F.col(column)))


def sector_totals(df: DataFrame, keep: bool, column: str = "naics2_sector_cd") -> DataFrame:
    total = F.col(column).isin(S.ALL_SECTORS, S.UNCLASSIFIED)
    return df.where(total if keep else ~total)


def five_long_not_national(df: DataFrame, column: str) -> DataFrame:
    return df.where((F.length(column) == 5) & (F.col(column) != "00000"))


def states(df: DataFrame, wanted: list[str], column: str = "state") -> DataFrame:
    return df.where(F.col(column).isin([s.zfill(2) for s in wanted]))


def counties_and_sectors(df: DataFrame, counties: list[str], sectors: list[str]) -> DataFrame:
    return df.where(
        F.col("state_cnty_fips_cd").isin(counties) & F.col("naics2_sector_cd").isin(sectors)
    )


def industries_under(df: DataFrame, prefix: str, digits: int, column: str) -> DataFrame:
    return df.where(F.col(column).startswith(prefix) & (F.length(column) == digits))


def hierarchy_level(df: DataFrame, column: str) -> DataFrame:
    """Pure-digit codes tagged 2..6 by length (sector to national industry)."""
    return df.where(F.col(column).rlike("^[0-9]{2,6}$")).withColumn(
        "code_level", F.length(column)
    )


def out_of_range(df: DataFrame, column: str, low: float, high: float) -> DataFrame:
    return df.where((F.col(column) < low) | (F.col(column) > high))


def non_numeric_tokens(df: DataFrame, columns: list[str]) -> DataFrame:
    """Distinct tokens that are not numbers, over several text columns."""
    tokens = df.select(F.explode(F.array(*columns)).alias("token"))
    return tokens.where(~F.col("token").rlike("^[0-9,.\\-]+$")).distinct()


def national_lines(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.regexp_replace(column, '[" ]', "") == "00000")


def drop_null_rows(df: DataFrame, columns: list[str], how: str) -> DataFrame:
    """``how='all'`` drops fully empty rows, ``how='any'`` incomplete ones."""
    return df.dropna(how=how, subset=columns)
