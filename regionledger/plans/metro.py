"""Three-digit industries: parts against totals, and the metro roll-up."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from regionledger.functions import codes, exprs
from regionledger.operators import aggregates, columns, joins
from regionledger.plans import survey

MEASURES = {"FIRMPDEMP": "firms", "EMP": "emp", "PAYANN": "pay", "RCPPDEMP": "rcpts"}
TOTAL = "000"


def normalise(raw: DataFrame) -> DataFrame:
    """Published rows with three-digit industry, padded codes and dollars."""
    df = columns.rename_synonyms(raw, survey.SYNONYMS, ("year",))
    scale = {"FIRMPDEMP": 1, "EMP": 1, "PAYANN": 1000, "RCPPDEMP": 1000}
    out = df.withColumns(
        {c: exprs.to_money(F.col(c)) * F.lit(k) for c, k in scale.items()}
        | {
            "naics3": codes.industry3(F.col("naics_any")),
            "state": codes.zfill_digits(F.col("state"), 2),
            "county": codes.zfill_digits(F.col("county"), 3),
        }
    )
    if "year" in out.columns:
        out = out.withColumn("year", exprs.to_number(F.col("year").cast("string")).cast("int"))
    return out


def crosswalk(raw: DataFrame) -> DataFrame:
    columns.require_columns(raw, ["state_fips", "county_fips", "cbsa_code", "cbsa_title"])
    out = raw.withColumn("state_fips", codes.zfill_digits(F.col("state_fips"), 2)).withColumn(
        "county_fips", codes.zfill_digits(F.col("county_fips"), 3)
    )
    if "cbsa_pop" in out.columns:
        out = out.withColumn("cbsa_pop", exprs.to_number(F.col("cbsa_pop").cast("string")).cast("bigint"))
    return out


def _year(df: DataFrame, year: int | None) -> DataFrame:
    return df.where(F.col("year") == year) if year is not None and "year" in df.columns else df


def reconcile_totals(df: DataFrame, year: int | None = None, tolerance: float = 1.0, keys: tuple[str, ...] = ()) -> DataFrame:
    """Summed parts against the reported county total, per measure.

    Parts and total are told apart inside one aggregation, so the input is read
    and shuffled once where two aggregates and an outer join would do it twice.
    `keys` (such as year) are grouped as well, so all years are one plan.
    """
    is_total = F.col("naics3") == TOTAL
    sums = []
    for c, short in MEASURES.items():
        sums.append(F.sum(F.when(~is_total, F.col(c))).alias(f"sum_{short}"))
        sums.append(F.sum(F.when(is_total, F.col(c))).alias(f"tot_{short}"))
    rep = _year(df, year).dropna(subset=["state", "county"]).groupBy(*keys, "state", "county").agg(
        *sums, F.count_if(is_total).alias("__t"), F.count_if(~is_total).alias("__p")
    )
    flags = []
    for short in MEASURES.values():
        delta = F.col(f"sum_{short}") - F.col(f"tot_{short}")
        rep = rep.withColumn(f"delta_{short}", delta).withColumn(
            f"pct_delta_{short}",
            F.try_divide(F.col(f"delta_{short}").cast("double"), F.col(f"tot_{short}").cast("double")),
        )
        flag = F.coalesce(F.abs(F.col(f"delta_{short}")) > tolerance, F.lit(False))
        rep = rep.withColumn(f"flag_{short}", flag)
        flags.append(F.col(f"flag_{short}"))
    any_flag = flags[0] | flags[1] | flags[2] | flags[3]
    missing = F.when(F.col("__t") == 0, "total").when(F.col("__p") == 0, "parts")
    return rep.withColumn("recon_ok", ~any_flag).withColumn("missing_side", missing).drop("__t", "__p")


def roll_up(df: DataFrame, xwalk: DataFrame, year: int | None = None, keys: tuple[str, ...] = ()) -> DataFrame:
    """Metro x industry sums with the metro's reported totals alongside; `keys` (such as year) are grouped as well."""
    base = _year(df, year).withColumn("state_fips", F.col("state")).withColumn("county_fips", F.col("county"))
    # Reduce to county grain first: the crosswalk then joins a few thousand rows.
    sums = base.groupBy(*keys, "state_fips", "county_fips", "naics3").agg(*[F.sum(c).alias(c) for c in MEASURES])
    merged = joins.many_to_one(sums, xwalk, ["state_fips", "county_fips"]).dropna(
        subset=["cbsa_code", "cbsa_title"]
    )
    metro = [*keys, "cbsa_code", "cbsa_title"]
    parts = merged.where(F.col("naics3") != TOTAL).groupBy(*metro, "naics3").agg(
        *[aggregates.sum_or_null(c).alias(c) for c in MEASURES]
    )
    names = {"FIRMPDEMP": "cbsa_tot_firms", "EMP": "cbsa_tot_emp",
             "PAYANN": "cbsa_tot_payroll", "RCPPDEMP": "cbsa_tot_receipts"}
    totals = merged.where(F.col("naics3") == TOTAL).groupBy(*metro).agg(
        *[aggregates.sum_or_null(c).alias(names[c]) for c in MEASURES]
    )
    return parts.join(totals, metro, "left")


def large_metros(metros: DataFrame, xwalk: DataFrame, by: str = "firms", threshold: int = 20000, within: tuple[str, ...] = ()) -> DataFrame:
    """Rows of metros whose firms or population reach the threshold; firms are judged within `within` (such as year)."""
    keys = ["cbsa_code", "cbsa_title"]
    if by == "population" and "cbsa_pop" in xwalk.columns:
        big = aggregates.groups_at_least(xwalk, keys, "cbsa_pop", threshold)
    else:
        keys = [*within, *keys]
        big = aggregates.groups_at_least(metros, keys, "cbsa_tot_firms", threshold)
    return joins.qualifying(metros, big, keys)


def discrepancies(report: DataFrame, xwalk: DataFrame) -> DataFrame:
    """Counties that do not add up, with their metro."""
    context = xwalk.withColumnsRenamed({"state_fips": "state", "county_fips": "county"})
    return report.where(~F.col("recon_ok")).join(context, ["state", "county"], "left")
