"""Check suite over the typed benchmark fact."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from regionledger import schemas as S
from regionledger.functions import exprs
from regionledger.operators import aggregates, ordering, quality, sets, windows
from regionledger.operators.quality import ERROR, WARN, Check
from regionledger.plans import totals

# Plausible yearly dollars per employee and receipts per firm.
RANGES = {
    "abs_wage_per_emp_usd": (12000, 500000),
    "qcew_wage_per_emp_usd": (12000, 500000),
    "abs_rcpt_per_firm_usd": (0, 250000000),
}
MEASURES = [*totals.SURVEY_SUMS, *totals.PAYROLL_SUMS, "qcew_avg_wkly_wage_usd_amt"]


def with_ratios(fact: DataFrame) -> DataFrame:
    """The three ratios the range and distribution checks look at."""
    def per(num: str, den: str):
        return exprs.safe_ratio(F.col(num).cast("double"), F.col(den).cast("double"))

    return fact.withColumns({
        "abs_wage_per_emp_usd": per("abs_payroll_usd_amt", "abs_emp_num"),
        "qcew_wage_per_emp_usd": per("qcew_ttl_ann_wage_usd_amt", "qcew_ann_avg_emp_lvl_num"),
        "abs_rcpt_per_firm_usd": per("abs_rcpt_usd_amt", "abs_firm_num"),
    })


def run(fact: DataFrame, counties: DataFrame, sectors: DataFrame, ranges: dict[str, tuple[float, float]] = RANGES) -> DataFrame:
    """Structure, uniqueness, sign, range and cross-source checks as rows."""
    def counted(df: DataFrame, name: str, severity: str, detail: str) -> DataFrame:
        return quality.run_checks(df, [Check(name, severity, F.count(F.lit(1)), detail)])

    wages = quality.run_checks(quality.wage_consistency(fact), [
        Check("survey to payroll wage ratio", WARN, F.max("ratio_outlier_cnt"), "rows with a ratio outside 0.2 to 5"),
        Check("weekly wage agrees", WARN, F.max("weekly_mismatch_cnt"), "rows more than 10 percent off"),
    ])
    return sets.stack([
        counted(quality.failing_codes(fact, counties), "county codes known", ERROR, "malformed or unknown county codes"),
        counted(quality.failing_sectors(fact, sectors), "sectors known", ERROR, "sectors outside the reference"),
        counted(sets.gaps(fact, "year_num"), "years without gaps", ERROR, "years missing inside the range"),
        quality.unique_key(fact, S.FACT_KEY, "unique fact key"),
        quality.non_negative(fact, MEASURES), quality.in_range(with_ratios(fact), ranges), wages,
    ])


def distribution(fact: DataFrame) -> DataFrame:
    """Exact 1, 5, 95 and 99 percent points of the three ratios."""
    names = list(RANGES)
    long = with_ratios(fact).select(*names).unpivot([], names, "name", "value")
    q = aggregates.exact_quantiles(long, "name", "value", [0.01, 0.05, 0.95, 0.99])
    return q.select("name", "value_cnt", *[F.col("quantiles")[i].alias(n) for i, n in enumerate(("p1", "p5", "p95", "p99"))])


def outliers(fact: DataFrame, ratio: str, k: int = 20) -> DataFrame:
    """The k rows farthest from a ratio's mean, in population deviations."""
    z = windows.z_scores(with_ratios(fact), ratio).select(*S.FACT_KEY, "z")
    return ordering.top_k_abs(z, "z", S.FACT_KEY, k)
