"""Queries of aggregates and windows."""

from __future__ import annotations

from pyspark.sql import functions as F

from regionledger import schemas as S
from regionledger.functions import codes, exprs
from regionledger.operators import aggregates, ordering, windows
from regionledger.plans import totals
from regionledger.registry import tables as t
from regionledger.registry.combining import both_cells
from regionledger.registry.core import query
from regionledger.registry.ctes import number

C = F.col
_CELL = "state_cnty_fips_cd, naics2_sector_cd, year_num"


@query(
    "ag1_sum_null_as_zero",
    "SELECT state_cnty_fips_cd, naics2_sector_cd, COALESCE(CAST(SUM(CASE WHEN right(state_cnty_fips_cd, 1) <> '3' THEN abs_firm_num END) AS BIGINT), 0) AS firms FROM survey_cells GROUP BY 1, 2",
)
def _ag1(spark, d):
    # All years count; the cells of some counties are null.
    firms = F.when(F.right("state_cnty_fips_cd", F.lit(1)) != "3", C("abs_firm_num"))
    return t.survey_cells(spark, d).groupBy("state_cnty_fips_cd", "naics2_sector_cd").agg(aggregates.sum_or_zero(firms).alias("firms"))


@query(
    "ag2_sum_null_as_null",
    "SELECT state_cnty_fips_cd, naics2_sector_cd, CAST(SUM(CASE WHEN right(state_cnty_fips_cd, 1) <> '4' THEN abs_firm_num END) AS BIGINT) AS firms FROM survey_cells GROUP BY 1, 2",
)
def _ag2(spark, d):
    firms = F.when(F.right("state_cnty_fips_cd", F.lit(1)) != "4", C("abs_firm_num"))
    return t.survey_cells(spark, d).groupBy("state_cnty_fips_cd", "naics2_sector_cd").agg(aggregates.sum_or_null(firms).alias("firms"))


@query(
    "ag3_ratio_of_sums",
    """SELECT naics2_sector_cd, e AS emp, CASE WHEN e > 0 THEN w / (e * 52) END AS weekly FROM (SELECT naics2_sector_cd, CAST(SUM(CAST(l_quantity AS BIGINT)) AS BIGINT) AS e,
       CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS w FROM payroll_lines GROUP BY 1)""", "weekly",
)
def _ag3(spark, d):
    sums = t.payroll_lines(spark, d).groupBy("naics2_sector_cd").agg(
        F.sum(C("l_quantity").cast("bigint")).alias("emp"), F.sum(t.money("l_extendedprice")).cast("double").alias("w")
    )
    return sums.select("naics2_sector_cd", "emp", aggregates.weekly_wage(C("w"), C("emp")).alias("weekly"))


@query(
    "ag4_survey_state_sums",
    """SELECT substr(state_cnty_fips_cd,1,2) AS state_fips_cd, naics2_sector_cd, year_num, MIN(naics2_sector_desc) AS naics2_sector_desc,
       CAST(SUM(abs_firm_num) AS BIGINT) AS abs_firm_num, CAST(SUM(abs_emp_num) AS BIGINT) AS abs_emp_num, SUM(abs_payroll_usd_amt) AS abs_payroll_usd_amt,
       SUM(abs_rcpt_usd_amt) AS abs_rcpt_usd_amt, SUM(abs_rcpt_usd_amt) / NULLIF(SUM(abs_emp_num), 0) AS abs_rcpt_per_emp_usd_amt
       FROM survey_plain WHERE ind_level_num = 2 GROUP BY 1, 2, 3""",
    "abs_payroll_usd_amt", "abs_rcpt_usd_amt", "abs_rcpt_per_emp_usd_amt",
)
def _ag4(spark, d):
    return totals.survey_states(t.survey(spark, d, rollups=False))


@query(
    "ag5_payroll_state_weekly",
    """SELECT substr(state_cnty_fips_cd,1,2) AS state_fips_cd, naics2_sector_cd, year_num, CAST(SUM(qcew_ann_avg_emp_lvl_num) AS BIGINT) AS qcew_ann_avg_emp_lvl_num,
       SUM(qcew_ttl_ann_wage_usd_amt) AS qcew_ttl_ann_wage_usd_amt,
       SUM(qcew_ttl_ann_wage_usd_amt) / NULLIF(SUM(qcew_ann_avg_emp_lvl_num), 0) / 52 AS qcew_avg_wkly_wage_usd_amt FROM payroll_cells GROUP BY 1, 2, 3""",
    "qcew_ttl_ann_wage_usd_amt", "qcew_avg_wkly_wage_usd_amt",
)
def _ag5(spark, d):
    return totals.payroll_states(t.payroll(spark, d, rollups=False))


_NATL = """SELECT year_num, COUNT(*) AS row_cnt, COUNT(DISTINCT state_cnty_fips_cd) AS county_cnt, COUNT(DISTINCT naics2_sector_cd) AS naics2_cnt,
  CAST(SUM(abs_firm_num) AS BIGINT) AS abs_firms_natl, CAST(SUM(abs_emp_num) AS BIGINT) AS abs_emp_natl, SUM(abs_payroll_usd_amt) AS abs_payroll_usd_natl,
  SUM(abs_rcpt_usd_amt) AS abs_receipts_usd_natl, CAST(SUM(qcew_ann_avg_emp_lvl_num) AS BIGINT) AS qcew_emp_natl, SUM(qcew_ttl_ann_wage_usd_amt) AS qcew_wages_usd_natl
  FROM cells GROUP BY 1"""


@query("ag6_national_totals", _NATL, "abs_payroll_usd_natl", "abs_receipts_usd_natl", "qcew_wages_usd_natl")
def _ag6(spark, d):
    return totals.national(both_cells(spark, d))


@query(
    "ag7_mean_by_state",
    "SELECT substr(state_cnty_fips_cd,1,2) AS state, round(AVG(CAST(qcew_ttl_ann_wage_usd_amt AS DECIMAL(18,2))) + 1e-7, 2) AS mean_wage FROM payroll_cells GROUP BY 1", "mean_wage",
)
def _ag7(spark, d):
    mean = F.avg("qcew_ttl_ann_wage_usd_amt").cast("double") + 1e-7
    return t.payroll_cells(spark, d).groupBy(codes.state_of(C("state_cnty_fips_cd")).alias("state")).agg(exprs.half_up(mean, 2).alias("mean_wage"))


@query("ag8_max_threshold", "SELECT c_nationkey FROM customer GROUP BY 1 HAVING MAX(c_acctbal) >= 9950")
def _ag8(spark, d):
    return aggregates.groups_at_least(t.read(spark, d, "customer"), ["c_nationkey"], "c_acctbal", 9950)


@query("ag9_full_row_distinct", "SELECT DISTINCT l_returnflag, l_linestatus, l_linenumber, l_tax FROM lineitem", "l_tax")
def _ag9(spark, d):
    return t.read(spark, d, "lineitem").select("l_returnflag", "l_linestatus", "l_linenumber", "l_tax").distinct()


@query(
    "ag10_keep_one_per_key",
    """SELECT o_custkey, first.k AS first_key, first.s AS first_status, last.k AS last_key, last.s AS last_status FROM (SELECT o_custkey,
       arg_min({'k': o_orderkey, 's': o_orderstatus}, o_orderkey) AS first, arg_max({'k': o_orderkey, 's': o_orderstatus}, o_orderkey) AS last FROM orders GROUP BY 1)""",
)
def _ag10(spark, d):
    o = t.read(spark, d, "orders").select("o_custkey", "o_orderkey", "o_orderstatus")
    first = aggregates.keep_one(o, ["o_custkey"], [C("o_orderkey")]).toDF("o_custkey", "first_key", "first_status")
    last = aggregates.keep_one(o, ["o_custkey"], [-C("o_orderkey")]).toDF("o_custkey", "last_key", "last_status")
    return first.join(last, "o_custkey")


@query(
    "ag11_three_levels",
    """SELECT CASE GROUPING_ID(state, county) WHEN 0 THEN 'county' WHEN 1 THEN 'state' ELSE 'national' END AS level, state, county, naics2, SUM(tri_releases_lbs) AS tri_releases_lbs
       FROM county_releases GROUP BY GROUPING SETS ((state, county, naics2), (state, naics2), (naics2))""", "tri_releases_lbs",
)
def _ag11(spark, d):
    from regionledger.plans import releases

    df = releases.by_county(releases.facilities(t.facilities_raw(spark, d)))
    return aggregates.levels(df, ["state", "county", "naics2"], ["state", "naics2"], ["naics2"], "tri_releases_lbs")


@query("ag12_duplicate_groups", "SELECT l_orderkey, l_linenumber, COUNT(*) AS row_cnt FROM lineitem GROUP BY 1, 2 HAVING COUNT(*) > 1 ORDER BY row_cnt DESC, 1, 2 LIMIT 50")
def _ag12(spark, d):
    return aggregates.duplicate_groups(t.read(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "ag13_null_rate",
    "SELECT year_num, 100.0 * COUNT(*) FILTER (abs_firm_num IS NULL) / COUNT(*) AS survey_null_pct, 100.0 * COUNT(*) FILTER (qcew_ann_avg_emp_lvl_num IS NULL) / COUNT(*) AS payroll_null_pct FROM cells GROUP BY 1",
    "survey_null_pct", "payroll_null_pct",
)
def _ag13(spark, d):
    return both_cells(spark, d).groupBy("year_num").agg(
        aggregates.null_rate("abs_firm_num").alias("survey_null_pct"), aggregates.null_rate("qcew_ann_avg_emp_lvl_num").alias("payroll_null_pct")
    )


@query(
    "ag14_coverage_by_year",
    "SELECT year_num, COUNT(*) AS row_cnt, COUNT(DISTINCT state_cnty_fips_cd) AS county_cnt, COUNT(DISTINCT naics2_sector_cd) AS sector_cnt FROM cells GROUP BY 1",
)
def _ag14(spark, d):
    return aggregates.coverage_by_year(both_cells(spark, d))


@query(
    "ag15_value_frequencies",
    "SELECT event_type AS value, COUNT(*) AS freq, COUNT(*) * 100.0 / (SELECT COUNT(event_type) FROM events) AS pct FROM events WHERE event_type IS NOT NULL GROUP BY 1 ORDER BY freq DESC, value LIMIT 3", "pct",
)
def _ag15(spark, d):
    return aggregates.value_counts(t.read(spark, d, "events"), "event_type", 3)


_PROBS = [0.01, 0.05, 0.5, 0.95, 0.99]


def quantile_sql(name: str, column: str, table: str) -> str:
    qs = ", ".join(f"quantile_cont({column}, {p}) AS p{round(p * 100)}" for p in _PROBS)
    return f"SELECT '{name}' AS name, COUNT({column}) AS value_cnt, {qs} FROM {table}"


_QCOLS = [f"p{round(p * 100)}" for p in _PROBS]


@query(
    "ag16_exact_quantiles",
    quantile_sql("quantity", "l_quantity", "lineitem") + " UNION ALL " + quantile_sql("price", "l_extendedprice", "lineitem")
    + " UNION ALL " + quantile_sql("tax", "l_tax", "lineitem"), *_QCOLS,
)
def _ag16(spark, d):
    long = t.read(spark, d, "lineitem").select(
        C("l_quantity").alias("quantity"), C("l_extendedprice").alias("price"), C("l_tax").alias("tax")
    ).unpivot([], ["quantity", "price", "tax"], "name", "value")
    q = aggregates.exact_quantiles(long, "name", "value", _PROBS)
    return q.select("name", "value_cnt", *[C("quantiles")[i].alias(c) for i, c in enumerate(_QCOLS)])


@query(
    "ag17_moments",
    "SELECT COUNT(c_acctbal) AS value_cnt, AVG(c_acctbal) AS mean, stddev_pop(c_acctbal) AS std_pop, stddev_samp(c_acctbal) AS std_samp, MIN(c_acctbal) AS min, MAX(c_acctbal) AS max FROM customer",
    "mean", "std_pop", "std_samp", "min", "max",
)
def _ag17(spark, d):
    return aggregates.moments(t.read(spark, d, "customer"), "c_acctbal")


@query(
    "ag18_correlation",
    "SELECT COUNT(*) AS pair_cnt, corr(abs_emp_num, qcew_ann_avg_emp_lvl_num) AS corr FROM cells WHERE abs_emp_num IS NOT NULL AND qcew_ann_avg_emp_lvl_num IS NOT NULL", "corr",
)
def _ag18(spark, d):
    return aggregates.pairwise_corr(both_cells(spark, d), "abs_emp_num", "qcew_ann_avg_emp_lvl_num")


@query(
    "ag19_describe_ratio",
    """SELECT COUNT(r) AS count, AVG(r) AS mean, stddev_samp(r) AS std, MIN(r) AS min, quantile_cont(r, 0.25) AS p25, quantile_cont(r, 0.5) AS p50, quantile_cont(r, 0.75) AS p75, MAX(r) AS max
       FROM (SELECT qcew_ttl_ann_wage_usd_amt / qcew_ann_avg_emp_lvl_num AS r FROM payroll_cells)""",
    "mean", "std", "min", "p25", "p50", "p75", "max",
)
def _ag19(spark, d):
    from regionledger.operators import profiling

    wage = exprs.safe_ratio(C("qcew_ttl_ann_wage_usd_amt").cast("double"), C("qcew_ann_avg_emp_lvl_num").cast("double"))
    df = t.payroll_cells(spark, d).select(wage.alias("wage_per_emp"))
    n = df.agg(F.count("wage_per_emp").alias("count"))
    stats = profiling.numeric_stats(df, ["wage_per_emp"], (0.25, 0.5, 0.75)).drop("name")
    return stats.withColumn("count", n.scalar())


@query(
    "ag20_histogram",
    """SELECT CAST(least(floor((v - lo) * 50 / (hi - lo)), 49) AS INTEGER) AS bin, COUNT(*) AS row_cnt FROM (SELECT log10(o_totalprice) AS v FROM orders WHERE o_totalprice > 0),
       (SELECT MIN(log10(o_totalprice)) AS lo, MAX(log10(o_totalprice)) AS hi FROM orders WHERE o_totalprice > 0) GROUP BY 1""",
)
def _ag20(spark, d):
    df = t.read(spark, d, "orders").select(exprs.log10_positive(C("o_totalprice")).alias("v"))
    return aggregates.histogram(df, "v", 50)


@query(
    "ag21_conditional_counts",
    "SELECT COUNT(*) FILTER (c_acctbal < 0) AS negative_cnt, COUNT(*) FILTER (c_acctbal > 9000) AS high_cnt, COUNT(*) FILTER (regexp_matches(c_name, '[eE][+-]?[0-9]+')) AS scientific_cnt FROM customer",
)
def _ag21(spark, d):
    return t.read(spark, d, "customer").agg(
        F.count_if(C("c_acctbal") < 0).alias("negative_cnt"), F.count_if(C("c_acctbal") > 9000).alias("high_cnt"),
        F.count_if(exprs.is_scientific(C("c_name"))).alias("scientific_cnt"),
    )


@query(
    "ag22_text_length",
    "SELECT CAST(MAX(length(text)) AS BIGINT) AS max_len, AVG(length(text)) AS avg_len FROM documents", "avg_len",
)
def _ag22(spark, d):
    return t.read(spark, d, "documents").agg(F.max(F.length("text")).cast("bigint").alias("max_len"), F.avg(F.length("text")).alias("avg_len"))


@query("ag23_distinct_list", "SELECT list_sort(list(DISTINCT naics2_sector_cd)) AS sectors FROM industry")
def _ag23(spark, d):
    return aggregates.distinct_list(t.industries(spark, d), "naics2_sector_cd", "sectors")


@query(
    "ag24_suppression_tokens",
    "SELECT COUNT(*) FILTER (annual_avg_emplvl IN ('(D)','(NA)')) + COUNT(*) FILTER (total_annual_wages IN ('(D)','(NA)')) AS suppressed_cnt FROM payroll_raw",
)
def _ag24(spark, d):
    return aggregates.token_count(t.payroll_raw(spark, d), ["annual_avg_emplvl", "total_annual_wages"], S.GDP_SUPPRESSION_TOKENS)


# --- windows ---------------------------------------------------------------------------------

_M = ["abs_firm_num", "abs_emp_num", "abs_payroll_usd_amt", "abs_rcpt_usd_amt", "qcew_ann_avg_emp_lvl_num", "qcew_ttl_ann_wage_usd_amt"]


@query(
    "wn1_previous_year",
    f"SELECT {_CELL}, " + ", ".join(f"LAG({m}) OVER (PARTITION BY state_cnty_fips_cd, naics2_sector_cd ORDER BY year_num) AS prev_{m}" for m in _M) + " FROM cells",
    *[f"prev_{m}" for m in _M if m.endswith("_amt")],
)
def _wn1(spark, d):
    return both_cells(spark, d).select(
        "state_cnty_fips_cd", "naics2_sector_cd", "year_num",
        *[windows.previous(m, ["state_cnty_fips_cd", "naics2_sector_cd"]).alias(f"prev_{m}") for m in _M],
    )


@query(
    "wn2_state_total_previous_year",
    "SELECT state_fips_cd, naics2_sector_cd, year_num, " + ", ".join(
        f"{m} AS state_{m}, LAG({m}) OVER (PARTITION BY state_fips_cd, naics2_sector_cd ORDER BY year_num) AS prev_{m}" for m in _M
    ) + " FROM state_totals WHERE naics2_sector_cd <> '00'",
    *[f"{p}_{m}" for m in _M if m.endswith("_amt") for p in ("state", "prev")],
)
def _wn2(spark, d):
    from regionledger.plans import fact

    out = fact.state_context(totals.state_totals(t.survey(spark, d), t.payroll(spark, d)))
    return out.withColumnsRenamed({"state_" + p: "prev_" + m for m, (p, _) in fact.MEASURES.items()})


@query(
    "wn3_county_total_previous_year",
    f"""SELECT {', '.join('c.' + k.strip() for k in _CELL.split(','))}, total, prev_total FROM cells c JOIN (SELECT state_cnty_fips_cd, year_num, total,
          LAG(total) OVER (PARTITION BY state_cnty_fips_cd ORDER BY year_num) AS prev_total FROM
          (SELECT state_cnty_fips_cd, year_num, CAST(SUM(COALESCE(abs_firm_num, 0)) AS BIGINT) AS total FROM cells GROUP BY 1, 2)) p
        ON c.state_cnty_fips_cd = p.state_cnty_fips_cd AND c.year_num = p.year_num""",
)
def _wn3(spark, d):
    df = both_cells(spark, d).select(*S.FACT_KEY, windows.group_sum("abs_firm_num", ["state_cnty_fips_cd", "year_num"]).alias("total"))
    return df.withColumn("prev_total", windows.previous_group_total("total", ["state_cnty_fips_cd"]))


_CY = "OVER (PARTITION BY state_cnty_fips_cd, year_num)"


@query(
    "wn4_county_year_sum",
    f"SELECT {_CELL}, CAST(SUM(COALESCE(abs_firm_num, 0)) {_CY} AS BIGINT) AS firms, SUM(COALESCE(abs_rcpt_usd_amt, 0)) {_CY} AS receipts FROM cells", "receipts",
)
def _wn4(spark, d):
    key = ["state_cnty_fips_cd", "year_num"]
    return both_cells(spark, d).select(
        *S.FACT_KEY, windows.group_sum("abs_firm_num", key).alias("firms"), windows.group_sum("abs_rcpt_usd_amt", key).alias("receipts")
    )


@query("wn5_share_of_total", f"SELECT {_CELL}, abs_firm_num / CAST(NULLIF(SUM(COALESCE(abs_firm_num, 0)) {_CY}, 0) AS DOUBLE) AS firm_share FROM cells", "firm_share")
def _wn5(spark, d):
    df = both_cells(spark, d).withColumn("total", windows.group_sum("abs_firm_num", ["state_cnty_fips_cd", "year_num"]))
    return df.select(*S.FACT_KEY, windows.share("abs_firm_num", "total").alias("firm_share"))


@query(
    "wn6_concentration_index",
    f"SELECT DISTINCT state_cnty_fips_cd, year_num, SUM(s * s) {_CY} AS idx FROM (SELECT *, abs_firm_num / CAST(NULLIF(SUM(COALESCE(abs_firm_num, 0)) {_CY}, 0) AS DOUBLE) AS s FROM cells)", "idx",
)
def _wn6(spark, d):
    key = ["state_cnty_fips_cd", "year_num"]
    df = both_cells(spark, d).withColumn("total", windows.group_sum("abs_firm_num", key))
    df = df.withColumn("s", windows.share("abs_firm_num", "total"))
    return df.withColumn("idx", F.round(windows.concentration("s", key), 9)).select(*key, "idx").distinct()


@query(
    "wn7_rank_in_state",
    f"SELECT {_CELL}, " + ", ".join(f"RANK() OVER (PARTITION BY substr(state_cnty_fips_cd,1,2), year_num, naics2_sector_cd ORDER BY {m} DESC NULLS LAST) AS rank_{m}" for m in _M) + " FROM cells",
)
def _wn7(spark, d):
    df = both_cells(spark, d).withColumn("state", codes.state_of(C("state_cnty_fips_cd")))
    return df.select(*S.FACT_KEY, *[windows.rank_desc(m, ["state", "year_num", "naics2_sector_cd"]).alias(f"rank_{m}") for m in _M])


@query(
    "wn8_wage_share",
    f"SELECT {_CELL}, qcew_ttl_ann_wage_usd_amt / NULLIF(SUM(qcew_ttl_ann_wage_usd_amt) {_CY}, 0) AS wage_share FROM payroll_cells", "wage_share",
)
def _wn8(spark, d):
    df = t.payroll_cells(spark, d).withColumn("total", windows.group_sum("qcew_ttl_ann_wage_usd_amt", ["state_cnty_fips_cd", "year_num"]))
    return df.select(*S.FACT_KEY, windows.share("qcew_ttl_ann_wage_usd_amt", "total").alias("wage_share"))


@query(
    "wn9_percentile_bin",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 11 <> 0 THEN CAST(greatest(((rn - 1) * 100 + n - 2) // (n - 1) - 1, 0) AS INTEGER) END AS pctile FROM
       (SELECT o_orderkey, row_number() OVER (PARTITION BY o_orderkey % 11 = 0 ORDER BY o_custkey, o_orderkey) AS rn, COUNT(*) OVER (PARTITION BY o_orderkey % 11 = 0) AS n FROM orders)""",
)
def _wn9(spark, d):
    """A measure that is null for some rows: they get no bin and shift no other."""
    df = t.read(spark, d, "orders").select("o_orderkey", F.when(C("o_orderkey") % 11 != 0, C("o_custkey")).alias("o_custkey"))
    return windows.percentile_bin(df, "o_custkey", ["o_orderkey"], "pctile").select("o_orderkey", "pctile")


@query(
    "wn10_z_score_top",
    "SELECT o_orderkey, (o_totalprice - m) / s AS z FROM orders, (SELECT AVG(o_totalprice) AS m, stddev_pop(o_totalprice) AS s FROM orders) ORDER BY abs(z) DESC, o_orderkey LIMIT 20", "z",
)
def _wn10(spark, d):
    z = windows.z_scores(t.read(spark, d, "orders").select("o_orderkey", "o_totalprice"), "o_totalprice")
    return ordering.top_k_abs(z.select("o_orderkey", "z"), "z", ["o_orderkey"], 20)


@query(
    "wn11_year_over_year",
    "SELECT year_num, " + ", ".join(f"(CAST({s} AS DOUBLE) - p_{s}) / NULLIF(p_{s}, 0) AS {n}" for s, n in totals.YOY.items()) + " FROM (SELECT year_num, "
    + ", ".join(f"{s}, CAST(LAG({s}) OVER (ORDER BY year_num) AS DOUBLE) AS p_{s}" for s in totals.YOY) + f", LAG(year_num) OVER (ORDER BY year_num) AS py FROM ({_NATL})) WHERE py IS NOT NULL",
    *totals.YOY.values(),
)
def _wn11(spark, d):
    return windows.year_over_year(totals.national(both_cells(spark, d)), totals.YOY)


@query(
    "wn12_top_n_per_year",
    f"SELECT {_CELL}, abs_rcpt_usd_amt, CAST(rn AS INTEGER) AS rank_num FROM (SELECT *, row_number() OVER (PARTITION BY year_num ORDER BY abs_rcpt_usd_amt DESC, state_cnty_fips_cd, naics2_sector_cd) AS rn FROM survey_cells WHERE abs_rcpt_usd_amt IS NOT NULL) WHERE rn <= 10",
    "abs_rcpt_usd_amt",
)
def _wn12(spark, d):
    df = t.survey_cells(spark, d).select(*S.FACT_KEY, "abs_rcpt_usd_amt")
    return windows.top_per_group(df, "year_num", "abs_rcpt_usd_amt", ["state_cnty_fips_cd", "naics2_sector_cd"], 10)
