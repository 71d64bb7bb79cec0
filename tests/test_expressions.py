"""Codes, numbers and flags on small inputs."""

import pytest
from pyspark.sql import functions as F

from regionledger.functions import codes, exprs


def apply(spark, values, fn, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("x")).alias("y")).collect()]


def test_zfill_pads_but_never_cuts(spark):
    assert apply(spark, ["7", "06075", "123456", "", None], lambda c: codes.zfill(c, 5)) == [
        "00007", "06075", "123456", "00000", None,
    ]


def test_zfill_digits_takes_first_run(spark):
    assert apply(spark, ["ab12cd3", "x", None, "0612345"], lambda c: codes.zfill_digits(c, 3)) == ["012", "000", "000", "0612345"]


@pytest.mark.parametrize("code,want", [
    ("31", "31-33"), ("3345", "31-33"), ("44-45", "44-45"), ("491", "48-49"), ("92", "92"), ("99", None),
    ("1", None), ("abc", None), ("n54", "54"), (None, None), ("00", None),
])
def test_sector_canoniser(spark, code, want):
    assert apply(spark, [code], codes.sector_from_code) == [want]


def test_sector_variants(spark):
    assert apply(spark, ["n54", " 541"], codes.sector_from_code_strict) == [None, "54"]
    assert apply(spark, ["32-x", "99", "7", "45", "-31"], codes.sector_for_checks) == ["31-33", "99", None, "44-45", "31"]


def test_industry3_total(spark):
    assert apply(spark, ["0", "00", "000", "5412", "44-45"], codes.industry3) == ["000", "000", "000", "541", "444"]


def test_gdp_groups(spark):
    assert apply(spark, ["31G", " 23", "44RT", "48TW", "G", "...", None], codes.gdp_group_sector) == [
        "31", "23", "44", "48", "92", None, None,
    ]


def test_county_name_key_keeps_term_order(spark):
    # ``borough`` and ``city`` go before ``city and borough`` is tried, so ``and`` stays.
    got = apply(spark, ["St. Louis City", "Juneau City and Borough", "Anchorage Municipality", "O'Brien County", None], codes.county_name_key)
    assert got == ["saintlouis", "juneauand", "anchorage", "obrien", ""]


def test_to_number_rejects_java_suffixes(spark):
    assert apply(spark, ["12D", "1e3", " 7 ", "abc", "", None, "-.5", "3f"], exprs.to_number) == [
        None, 1000.0, 7.0, None, None, None, -0.5, None,
    ]


def test_published_cells(spark):
    got = apply(spark, [None, "(D)", " S ", "x1", "42"], exprs.parse_published)
    assert [tuple(r) for r in got] == [
        (None, "source_missing"), (None, "source_suppressed"), (None, "source_suppressed"),
        (None, "source_non_numeric"), (42.0, None),
    ]


def test_ratios(spark):
    df = spark.createDataFrame([(1.0, 0.0), (1.0, -2.0), (None, 2.0), (3.0, 2.0)], "a double, b double")
    got = df.select(exprs.safe_ratio(F.col("a"), F.col("b")), exprs.positive_ratio(F.col("a"), F.col("b"))).collect()
    assert [tuple(r) for r in got] == [(None, None), (-0.5, None), (None, None), (1.5, 1.5)]


def test_golden_ratios(spark):
    from regionledger.plans import totals

    df = spark.createDataFrame([(3149576106, 25815, 8782781000, 3512)], "w long, e long, r long, f long")
    row = df.select(totals.money_ratio("w", "e").alias("wage"), totals.money_ratio("r", "f").alias("rcpt")).first()
    assert str(row["wage"]) == "122005.659732714"
    assert round(float(row["rcpt"]), 6) == 2500791.856492


def test_rounding_modes(spark):
    assert apply(spark, [0.125, 0.375], lambda c: exprs.half_even(c, 2), "double") == [0.12, 0.38]
    assert apply(spark, [0.125, 0.375], lambda c: exprs.half_up(c, 2), "double") == [0.13, 0.38]


def test_flags_two_and_three_valued(spark):
    assert apply(spark, [0.0, 2.0, None], exprs.passes_exact, "double") == [True, False, False]
    assert apply(spark, [0.0, 2.0, None], exprs.passes_exact_or_unknown, "double") == [True, False, None]
