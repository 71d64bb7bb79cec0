"""Code and name standardisation as Column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

from regionledger import schemas as S


def zfill(c: Column, width: int) -> Column:
    """Left-pad with zeros; longer text is kept whole (``lpad`` alone would cut it)."""
    return F.when(F.length(c) < width, F.lpad(c, width, "0")).otherwise(c)


def first_digits(c: Column) -> Column:
    """First run of digits, ``''`` when there is none."""
    return F.regexp_extract(F.coalesce(c, F.lit("")), "([0-9]+)", 1)


def zfill_digits(c: Column, width: int) -> Column:
    return zfill(first_digits(c), width)


def digits_only(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def sector_label(two_digits: Column) -> Column:
    """Two-digit prefix to its published label (ranges folded)."""
    out = two_digits
    for label in dict.fromkeys(S.SECTOR_RANGES.values()):
        members = [k for k, v in S.SECTOR_RANGES.items() if v == label]
        out = F.when(two_digits.isin(members), F.lit(label)).otherwise(out)
    return out


def sector_from_code(c: Column) -> Column:
    """Canonical sector of an industry code, null outside the 20 sectors."""
    label = sector_label(F.substring(digits_only(c), 1, 2))
    return F.when(label.isin(S.SECTORS), label)


def sector_from_code_strict(c: Column) -> Column:
    """As :func:`sector_from_code`, but the code must begin with a digit."""
    return F.when(F.trim(c).rlike("^[0-9]"), sector_from_code(c))


def sector_for_checks(c: Column) -> Column:
    """Canonical label without the allow-list: any two-digit prefix survives."""
    kept = F.regexp_replace(c, "[^0-9-]", "")
    ranged = F.when(
        F.substring(kept, 1, 2).isin(list(S.SECTOR_RANGES)),
        sector_label(F.substring(kept, 1, 2)),
    )
    prefix = F.substring(digits_only(kept), 1, 2)
    return F.coalesce(ranged, F.when(F.length(prefix) == 2, prefix))


def industry3(c: Column) -> Column:
    """Three-digit industry; any all-zero code becomes the total ``000``."""
    three = F.substring(digits_only(c), 1, 3)
    total = c.rlike("^0+$") | three.isin("000", "00")
    return F.when(total, F.lit("000")).otherwise(three)


def gdp_group_sector(c: Column) -> Column:
    """Two-digit codes pass; known group codes map to a sector; others are null."""
    code = F.trim(c)
    pairs = [F.lit(x) for kv in S.GDP_GROUP_SECTORS.items() for x in kv]
    return F.when(code.rlike("^[0-9]{2}$"), code).otherwise(
        F.try_element_at(F.create_map(*pairs), code)
    )


def county_name_key(c: Column) -> Column:
    """Join key for county names: suffix words dropped, ``st`` spelled out, no spaces."""
    start = F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), "[^a-z0-9\\s]", " ")
    patterns = ["\\b" + t.replace(" ", "\\s+") + "\\b" for t in S.COUNTY_SUFFIX_TERMS]
    bare = reduce(lambda acc, p: F.regexp_replace(acc, p, " "), patterns, start)
    saint = F.regexp_replace(bare, "\\bst\\b", "saint")
    return F.regexp_replace(saint, "\\s+", "")


def county_name_key_simple(c: Column) -> Column:
    """Older key: punctuation deleted, suffix words cut anywhere, single spaces kept."""
    start = F.regexp_replace(
        F.trim(F.lower(F.coalesce(c, F.lit("")))), "[^a-z0-9\\s]", ""
    )
    cut = F.regexp_replace(start, "(" + "|".join(S.LEGACY_COUNTY_TERMS) + ")", "")
    return F.trim(F.regexp_replace(cut, "\\s+", " "))


def state_of(fips: Column) -> Column:
    return F.substring(fips, 1, 2)


def county_of(fips: Column) -> Column:
    return F.substring(fips, 3, 3)


def is_county_code(fips: Column) -> Column:
    return fips.rlike("^[0-9]{5}$")


def is_statewide(fips: Column) -> Column:
    return county_of(fips) == S.STATEWIDE_SUFFIX


def strip_quotes(c: Column) -> Column:
    return F.trim(F.translate(c, '"', ""))


def strip_thousands(c: Column) -> Column:
    return F.translate(c, ",", "")


def clean_title(c: Column) -> Column:
    """Drop the trilateral marker (a final ``T``) from an industry title."""
    return F.regexp_replace(F.trim(c), "\\s*T$", "")


def clean_code(c: Column) -> Column:
    """``11.0`` read from a spreadsheet becomes ``11``."""
    return F.regexp_replace(F.trim(c), "\\.0$", "")
