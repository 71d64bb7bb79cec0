"""Stored values against their source, cell by cell."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from regionledger import schemas as S
from regionledger.functions import codes, exprs
from regionledger.operators import joins, sets
from regionledger.plans import payroll as payroll_plan
from regionledger.operators import aggregates, filters

SURVEY_PAIRS = {
    # short name: (source column, stored column, tolerance; None = exact)
    "firms": ("source_census_firmpdemp", "stored_abs_firms", None),
    "emp": ("source_census_emp", "stored_abs_emp", None),
    "payroll": ("source_census_payann_usd", "stored_abs_payroll_usd_amt", 1000.0),
    "receipts": ("source_census_rcppdemp_usd", "stored_abs_rcpt_usd_amt", 1000.0),
}
SURVEY_DELTAS = {"firms": "delta_firms", "emp": "delta_emp", "payroll": "delta_payroll_usd", "receipts": "delta_receipts_usd"}

PAYROLL_PAIRS = {
    "emp": ("source_qcew_annual_avg_emplvl", "stored_qcew_emp", None),
    "wages": ("source_qcew_total_annual_wages_usd", "stored_qcew_wages_usd", None),
    "avg_weekly_wage": ("source_qcew_avg_weekly_wage_usd", "stored_qcew_avg_weekly_wage_usd", 1.0),
}
PAYROLL_DELTAS = {"emp": "delta_emp", "wages": "delta_wages_usd", "avg_weekly_wage": "delta_avg_weekly_wage_usd"}


def survey_source(rows: DataFrame) -> DataFrame:
    """Published payload rows (text) to dollars with a note on withheld cells."""
    parsed = {c: exprs.parse_published(F.col(c)) for c in ("FIRMPDEMP", "EMP", "PAYANN", "RCPPDEMP")}
    df = rows.select("*", *[p.alias("p_" + c) for c, p in parsed.items()])
    note = F.col("note") if "note" in rows.columns else F.lit(None).cast("string")
    return df.select(
        F.col("year_num").try_cast("int").alias("year_num"),
        F.concat(codes.zfill(F.col("state"), 2), codes.zfill(F.col("county"), 3)).alias("state_cnty_fips_cd"),
        F.trim("NAICS2022").alias("naics2_sector_cd"),
        F.col("p_FIRMPDEMP.value").alias("source_census_firmpdemp"),
        F.col("p_EMP.value").alias("source_census_emp"),
        exprs.from_thousands(F.col("p_PAYANN.value")).alias("source_census_payann_usd"),
        exprs.from_thousands(F.col("p_RCPPDEMP.value")).alias("source_census_rcppdemp_usd"),
        exprs.join_notes(note, *[F.col(f"p_{c}.note") for c in parsed]).alias("notes"),
    )


def _located(both: DataFrame) -> DataFrame:
    fips = codes.zfill(F.col("state_cnty_fips_cd"), 5)
    return both.withColumn("state_cnty_fips_cd", fips).withColumn("state_fips", codes.state_of(fips)).withColumn(
        "county_fips", codes.county_of(fips)
    )


def _outer(source: DataFrame, stored: DataFrame) -> DataFrame:
    keyed = [d.dropna(subset=S.FACT_KEY) for d in (source, stored)]
    return _located(joins.full_outer(*keyed, S.FACT_KEY))


#: Tables of up to so many counties are sent to every task; larger ones are joined by shuffle.
FEW_COUNTIES = 200_000


def county_digests(cells: DataFrame, values: list[str]) -> DataFrame:
    """Per county: cells, distinct keys and two order-independent 64-bit digest sums.

    A cell's hash covers its key and its values as doubles (the comparison's own
    terms), so equal digests on both sides mean, but for a chance of about 2^-128, the
    same cells with the same values, whatever the order or partitioning.
    """
    keys = [F.col("year_num").cast("long"), F.col("state_cnty_fips_cd").cast("string"), F.col("naics2_sector_cd").cast("string")]
    vals = [F.col(v).cast("double") for v in values]
    wide = lambda h: F.sum(h.cast("decimal(38,0)"))
    return cells.dropna(subset=S.FACT_KEY).groupBy(F.col("state_cnty_fips_cd").alias("_county")).agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct(F.xxhash64(*keys)).alias("k"),
        wide(F.xxhash64(*keys, *vals)).alias("d1"), wide(F.xxhash64(F.lit("second"), *keys, *vals)).alias("d2"),
    )


def digest_split(source: DataFrame, stored: DataFrame, pairs: dict) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(source cells of differing counties, stored cells of differing counties, source cells of equal counties).

    Counties are equal when both sides hold the same number of cells with unique keys
    and the same two digests; only the others are joined cell by cell.
    """
    a = county_digests(source, [p[0] for p in pairs.values()])
    b = county_digests(stored, [p[1] for p in pairs.values()])
    equal = a.join(b, ["_county", "n", "k", "d1", "d2"]).where(F.col("n") == F.col("k")).select("_county")
    few = equal.limit(FEW_COUNTIES + 1).count() <= FEW_COUNTIES
    equal = F.broadcast(equal) if few else equal
    county = lambda d: d["state_cnty_fips_cd"] == equal["_county"]
    return (
        source.join(equal, county(source), "left_anti"),
        stored.join(equal, county(stored), "left_anti"),
        source.join(equal, county(source), "left_semi"),
    )


def _with_deltas(df: DataFrame, pairs: dict, deltas: dict) -> DataFrame:
    for short, (src, stored, _) in pairs.items():
        d = F.col(stored).cast("double") - F.col(src).cast("double")
        df = df.withColumn(deltas[short], d).withColumn(
            f"delta_{short}_pct", exprs.safe_ratio(F.col(deltas[short]), F.col(src).cast("double"))
        )
    return df


def _presence(src: str, stored: str, source_label: str):
    a, b = F.col(src).isNull(), F.col(stored).isNull()
    return (
        F.when(a & b, "missing_from_both").when(a, f"missing_from_{source_label}").when(b, "missing_from_stored")
    )


def survey(source: DataFrame, stored: DataFrame) -> DataFrame:
    """Survey reconciliation: counts must be equal, money within 1,000; two-valued flags."""
    return _survey_report(_outer(source, stored))


def survey_by_digest(source: DataFrame, stored: DataFrame) -> DataFrame:
    """The same report as `survey`; counties whose digests agree are reported from the source alone.

    In an equal county every cell is on both sides with equal values, so its stored
    values are the source's (cast to the stored types) and no cell crosses the network
    to meet its twin; the cell join only takes the counties that differ.
    """
    src_diff, stored_diff, src_equal = digest_split(source, stored, SURVEY_PAIRS)
    types = dict(stored.dtypes)
    mirrored = src_equal.dropna(subset=S.FACT_KEY).select(
        *source.columns, *[F.col(a).cast(types[b]).alias(b) for a, b, _ in SURVEY_PAIRS.values()]
    )
    return survey(src_diff, stored_diff).unionByName(_survey_report(_located(mirrored)))


def _survey_report(both: DataFrame) -> DataFrame:
    df = _with_deltas(both, SURVEY_PAIRS, SURVEY_DELTAS)
    flags = []
    for short, (_, _, tol) in SURVEY_PAIRS.items():
        d = F.col(SURVEY_DELTAS[short])
        df = df.withColumn(f"pass_{short}", exprs.passes_exact(d) if tol is None else exprs.passes_within(d, tol))
        flags.append(F.col(f"pass_{short}"))
    extra = _presence("source_census_firmpdemp", "stored_abs_firms", "census")
    return df.withColumn("pass_all", flags[0] & flags[1] & flags[2] & flags[3]).withColumn(
        "notes", exprs.append_note(F.col("notes"), extra)
    ).select(
        "year_num", "state_cnty_fips_cd", "state_fips", "county_fips", "naics2_sector_cd",
        *[p[0] for p in SURVEY_PAIRS.values()], *[p[1] for p in SURVEY_PAIRS.values()],
        *SURVEY_DELTAS.values(), *[f"delta_{s}_pct" for s in SURVEY_PAIRS],
        *[f"pass_{s}" for s in SURVEY_PAIRS], "pass_all", "notes",
    )


def payroll_source(
    raw: DataFrame, years: list[int] | None = None, counties: list[str] | None = None,
    sectors: list[str] | None = None, own: str = "5", level: str = "74",
) -> DataFrame:
    """Published payroll cells (text) with the looser sector reading of the checks."""
    df = payroll_plan.resolve(raw)
    if years is not None:
        df = df.where(F.col("year_num").isin([str(y) for y in years]))
    df = filters.aggregation_level(filters.ownership(filters.annual_rows(df), own), level)
    df = payroll_plan.county_rows(df).withColumn("naics2_sector_cd", codes.sector_for_checks(F.col("indstr_cd")))
    df = df.where(F.col("naics2_sector_cd").isNotNull())
    if counties is not None:
        df = df.where(F.col("state_cnty_fips_cd").isin(counties))
    if sectors is not None:
        df = df.where(F.col("naics2_sector_cd").isin(sectors))
    values = {"qcew_ann_avg_emp_lvl_num": "annual_avg_emplvl", "qcew_ttl_ann_wage_usd_amt": "total_annual_wages",
              "qcew_avg_wkly_wage_usd_amt": "annual_avg_wkly_wage"}
    out = df.select(
        F.col("year_num").alias("year"), "state_cnty_fips_cd", "naics2_sector_cd",
        *[F.col(c).alias(n) for c, n in values.items()],
    )
    # The first row of a repeated cell wins there by file order; here the smallest texts win.
    return aggregates.keep_one(out, ["year", "state_cnty_fips_cd", "naics2_sector_cd"], [F.col(n) for n in values.values()])


def payroll(source: DataFrame, stored: DataFrame, allow_wage_tolerance: bool = True) -> DataFrame:
    """Payroll reconciliation: three-valued flags, weekly wage reported but not decisive."""
    raw = ["annual_avg_emplvl", "total_annual_wages", "annual_avg_wkly_wage"]
    src = source.select("*", *[exprs.parse_published(F.col(c)).alias("p_" + c) for c in raw]).select(
        F.col("year").try_cast("int").alias("year_num"), "state_cnty_fips_cd", "naics2_sector_cd",
        *[F.col(f"p_{c}.value").alias(p[0]) for c, p in zip(raw, PAYROLL_PAIRS.values())],
        exprs.join_notes(*[F.col(f"p_{c}.note") for c in raw]).alias("notes"),
    )
    df = _outer(src, stored)
    fallback = exprs.positive_ratio(
        F.col("stored_qcew_wages_usd").cast("double"), F.col("stored_qcew_emp").cast("double") * 52
    )
    df = df.withColumn(
        "stored_qcew_avg_weekly_wage_usd", F.coalesce(F.col("stored_qcew_avg_weekly_wage_usd").cast("double"), fallback)
    ).withColumn("notes", F.coalesce("notes", F.lit("")))
    df = _with_deltas(df, PAYROLL_PAIRS, PAYROLL_DELTAS)
    for short, (_, _, tol) in PAYROLL_PAIRS.items():
        d = F.col(PAYROLL_DELTAS[short])
        within = tol is not None and allow_wage_tolerance
        df = df.withColumn(
            f"pass_{short}", exprs.passes_within_or_unknown(d, tol) if within else exprs.passes_exact_or_unknown(d)
        )
    no_source = F.col("source_qcew_annual_avg_emplvl").isNull()
    no_stored = F.col("stored_qcew_emp").isNull()
    unknown = F.col("pass_emp").isNull() | F.col("pass_wages").isNull()
    pass_all = (
        F.when(no_source, F.lit(None).cast("boolean")).when(no_stored, F.lit(False))
        .when(~unknown, F.col("pass_emp") & F.col("pass_wages"))
    )
    extra = _presence("source_qcew_annual_avg_emplvl", "stored_qcew_emp", "source")
    return df.withColumn("pass_all", pass_all).withColumn("notes", exprs.append_note(F.col("notes"), extra)).select(
        "year_num", "state_cnty_fips_cd", "state_fips", "county_fips", "naics2_sector_cd",
        *[p[0] for p in PAYROLL_PAIRS.values()], *[p[1] for p in PAYROLL_PAIRS.values()],
        *PAYROLL_DELTAS.values(), *[f"delta_{s}_pct" for s in PAYROLL_PAIRS],
        *[f"pass_{s}" for s in PAYROLL_PAIRS], "pass_all", "notes",
    )


def survey_whole_surface(source: DataFrame, stored: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All cells in both directions: ``(report, source rows outside the stored sectors)``.

    A whole-surface pull also holds finer industries, which the stored table never
    has; they are set aside instead of counting as missing.
    """
    sectors = stored.select("naics2_sector_cd").distinct()
    inside = joins.qualifying(source, sectors, ["naics2_sector_cd"])
    outside = source.join(sectors, "naics2_sector_cd", "left_anti")
    return survey_by_digest(inside, stored), outside


def combined(survey_report: DataFrame, payroll_report: DataFrame) -> DataFrame:
    """Both reports stacked under their source tag; columns of one side are null on the other."""
    tagged = [d.withColumn("source_system", F.lit(n)) for d, n in ((survey_report, "abs"), (payroll_report, "qcew"))]
    return sets.stack(tagged, allow_missing=True)


def summary(report: DataFrame) -> DataFrame:
    return report.groupBy("source_system").agg(
        F.count(F.lit(1)).alias("row_cnt"),
        F.count_if(F.col("pass_all")).alias("passed_cnt"),
        F.count_if(~F.col("pass_all")).alias("failed_cnt"),
    )


def failures(report: DataFrame) -> DataFrame:
    return report.where(~F.col("pass_all"))
