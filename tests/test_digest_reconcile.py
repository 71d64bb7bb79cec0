"""Reconciliation by county digests: the same report as the cell join, which only takes differing counties."""

import math

from pyspark.sql import functions as F

from regionledger.plans import reconcile
from regionledger.registry import tables as t

SF = "/root/testdata/sf0.001"


def rows(df):
    cols = sorted(df.columns)
    norm = lambda v: "nan" if isinstance(v, float) and math.isnan(v) else repr(v)
    return sorted(tuple(norm(r[c]) for c in cols) for r in df.collect())


def sides(spark):
    cells = t.loaded(t.survey_cells(spark, SF))
    return reconcile.survey_source(t.survey_raw(spark, SF, cells)), t.stored_survey(spark, SF, cells)


def test_same_report_as_the_cell_join(spark):
    source, stored = sides(spark)
    assert rows(reconcile.survey_by_digest(source, stored)) == rows(reconcile.survey(source, stored))


def test_join_input_falls_with_differing_counties(spark):
    source, _ = sides(spark)
    source = source.cache()
    pairs = {a: b for a, b, _ in reconcile.SURVEY_PAIRS.values()}
    # A stored table equal to the source in every county but one.
    county = source.select("state_cnty_fips_cd").first()[0]
    stored = source.select(
        "year_num", "state_cnty_fips_cd", "naics2_sector_cd",
        *[(F.col(a) + F.when(F.col("state_cnty_fips_cd") == county, 1).otherwise(0)).alias(b) for a, b in pairs.items()],
    )
    src_diff, stored_diff, src_equal = reconcile.digest_split(source, stored, reconcile.SURVEY_PAIRS)
    in_county = source.where(F.col("state_cnty_fips_cd") == county).count()
    assert src_diff.count() == in_county and stored_diff.count() == in_county
    assert src_equal.count() == source.dropna(subset=["year_num", "state_cnty_fips_cd", "naics2_sector_cd"]).count() - in_county
    assert rows(reconcile.survey_by_digest(source, stored)) == rows(reconcile.survey(source, stored))


def test_repeated_keys_go_through_the_join(spark):
    source, stored = sides(spark)
    twice_src, twice_stored = source.unionByName(source), stored.unionByName(stored)
    _, _, equal = reconcile.digest_split(twice_src, twice_stored, reconcile.SURVEY_PAIRS)
    assert equal.count() == 0
    assert rows(reconcile.survey_by_digest(twice_src, twice_stored)) == rows(reconcile.survey(twice_src, twice_stored))
