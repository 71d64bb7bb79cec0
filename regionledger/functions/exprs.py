"""Numbers, ratios, notes and pass flags as Column expressions."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, functions as F

from regionledger import schemas as S

NUMBER_PATTERN = r"^\s*[-+]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][-+]?[0-9]+)?\s*$"
SCIENTIFIC_PATTERN = "[eE][+-]?[0-9]+"


def to_number(c: Column, as_type: str = "double") -> Column:
    """Numeric text to a number, anything else to null.

    The pattern guard matters: a bare cast to double also reads Java suffixes,
    so ``12D`` would become 12 instead of null.
    """
    return F.when(c.rlike(NUMBER_PATTERN), c.try_cast(as_type))


def to_money(c: Column) -> Column:
    return to_number(c, "decimal(38,9)")


def parse_published(c: Column) -> Column:
    """Published cell as ``struct(value, note)``; the note says why value is null."""
    text = F.trim(c)
    value = to_number(text)
    note = (
        F.when(c.isNull(), F.lit("source_missing"))
        .when(text.isin(S.SUPPRESSION_TOKENS), F.lit("source_suppressed"))
        .when(value.isNull(), F.lit("source_non_numeric"))
    )
    return F.struct(F.when(note.isNull(), value).alias("value"), note.alias("note"))


def safe_ratio(num: Column, den: Column) -> Column:
    """Null when either side is null or the denominator is zero."""
    return F.try_divide(num, den)


def positive_ratio(num: Column, den: Column) -> Column:
    """Null unless the denominator is above zero."""
    return F.when(den > 0, F.try_divide(num, den))


def from_thousands(c: Column) -> Column:
    return c * F.lit(1000)


def half_even(c: Column, digits: int) -> Column:
    """Rounding of the file-side sources."""
    return F.bround(c, digits)


def half_up(c: Column, digits: int) -> Column:
    """Rounding of the table-side sources."""
    return F.round(c, digits)


def fill_zero(c: Column) -> Column:
    return F.coalesce(c, F.lit(0))


def sum_filled(columns: list[Column]) -> Column:
    """Row-wise sum with unreadable cells as zero."""
    return reduce(add, [F.coalesce(to_number(c), F.lit(0.0)) for c in columns])


def log10_positive(c: Column) -> Column:
    return F.when(c > 0, F.log10(c))


def finite_or_null(c: Column) -> Column:
    return F.when(~F.isnan(c) & (F.abs(c) != float("inf")), c)


def not_integral(c: Column) -> Column:
    return c % 1 != 0


def is_scientific(c: Column) -> Column:
    return c.rlike(SCIENTIFIC_PATTERN)


def join_notes(*notes: Column) -> Column:
    """Distinct non-empty notes, sorted, joined by ``;`` (empty string when none)."""
    present = F.filter(F.array(*notes), lambda n: n.isNotNull() & (n != ""))
    return F.array_join(F.array_sort(F.array_distinct(present)), ";")


def append_note(notes: Column, extra: Column) -> Column:
    """Notes then the extra flag, keeping order; null and empty parts are skipped."""
    return F.concat_ws(";", F.when(notes != "", notes), extra)


def passes_exact(delta: Column) -> Column:
    """Two-valued: a missing side fails."""
    return F.coalesce(delta == 0, F.lit(False))


def passes_within(delta: Column, tolerance: float) -> Column:
    return F.coalesce(F.abs(delta) <= tolerance, F.lit(False))


def passes_exact_or_unknown(delta: Column) -> Column:
    """Three-valued: a missing side stays unknown."""
    return delta == 0


def passes_within_or_unknown(delta: Column, tolerance: float) -> Column:
    return F.abs(delta) <= tolerance
