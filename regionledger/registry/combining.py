"""Queries of joins, set operations, sorting and sampling."""

from __future__ import annotations

from pyspark.sql import functions as F

from regionledger import schemas as S
from regionledger.functions import exprs
from regionledger.operators import aggregates, joins, ordering, sets, windows
from regionledger.plans import fact, totals
from regionledger.registry import tables as t
from regionledger.registry.core import query

C = F.col
_SIDE = ["abs_firm_num", "abs_emp_num", "abs_payroll_usd_amt", "abs_rcpt_usd_amt", "qcew_ann_avg_emp_lvl_num", "qcew_ttl_ann_wage_usd_amt"]


def both_cells(spark, d):
    """Survey and payroll cells side by side."""
    return joins.full_outer(t.survey_cells(spark, d), t.payroll_cells(spark, d), S.FACT_KEY)


@query(
    "jn1_full_outer_sources", "SELECT * EXCLUDE (qcew_avg_wkly_wage_usd_amt) FROM cells",
    "abs_payroll_usd_amt", "abs_rcpt_usd_amt", "qcew_ttl_ann_wage_usd_amt",
)
def _jn1(spark, d):
    return both_cells(spark, d)


@query(
    "jn2_lookup_on_coalesced_key",
    """SELECT c.state_cnty_fips_cd, c.naics2_sector_cd, c.year_num, cnty_nm, population_num, naics2_sector_desc
       FROM cells c LEFT JOIN county_ref g ON c.state_cnty_fips_cd = g.state_cnty_fips_cd LEFT JOIN sector_ref s ON c.naics2_sector_cd = s.naics2_sector_cd""",
)
def _jn2(spark, d):
    df = both_cells(spark, d).select(*S.FACT_KEY)
    df = joins.lookup(df, t.county_ref(spark, d).select("state_cnty_fips_cd", "cnty_nm", "population_num"), ["state_cnty_fips_cd"])
    return joins.lookup(df, t.sector_ref(spark, d), ["naics2_sector_cd"])


@query(
    "jn3_left_of_aggregates",
    """SELECT a.*, q.wages FROM (SELECT state_cnty_fips_cd, year_num, CAST(SUM(abs_firm_num) AS BIGINT) AS firms FROM survey_cells GROUP BY 1, 2) a
       LEFT JOIN (SELECT state_cnty_fips_cd, year_num, SUM(qcew_ttl_ann_wage_usd_amt) AS wages FROM payroll_cells GROUP BY 1, 2) q
       ON a.state_cnty_fips_cd = q.state_cnty_fips_cd AND a.year_num = q.year_num""", "wages",
)
def _jn3(spark, d):
    key = ["state_cnty_fips_cd", "year_num"]
    a = t.survey_cells(spark, d).groupBy(*key).agg(F.sum("abs_firm_num").alias("firms"))
    q = t.payroll_cells(spark, d).groupBy(*key).agg(F.sum("qcew_ttl_ann_wage_usd_amt").alias("wages"))
    return joins.lookup(a, q, key)


@query(
    "jn4_lookup_with_fallback",
    "SELECT p_partkey, i.naics2_sector_cd, COALESCE(naics2_sector_desc, i.naics2_sector_cd) AS sector_label FROM industry i LEFT JOIN sector_ref s ON i.naics2_sector_cd = s.naics2_sector_cd",
)
def _jn4(spark, d):
    df = t.industries(spark, d).select("p_partkey", "naics2_sector_cd")
    return joins.lookup_with_fallback(df, t.sector_ref(spark, d), "naics2_sector_cd", "naics2_sector_desc", "sector_label")


@query("jn5_many_to_one", "SELECT o_orderkey, o_custkey, c_mktsegment FROM orders LEFT JOIN customer ON o_custkey = c_custkey")
def _jn5(spark, d):
    ref = t.read(spark, d, "customer").select(C("c_custkey").alias("o_custkey"), "c_mktsegment")
    return joins.many_to_one(t.read(spark, d, "orders").select("o_orderkey", "o_custkey"), ref, ["o_custkey"])


@query(
    "jn6_parts_full_outer_totals",
    """SELECT COALESCE(a.state_cnty_fips_cd, b.state_cnty_fips_cd) AS state_cnty_fips_cd, parts, total FROM
       (SELECT state_cnty_fips_cd, CAST(SUM(FIRMPDEMP) AS BIGINT) AS parts FROM metro_parts GROUP BY 1) a FULL OUTER JOIN
       (SELECT state_cnty_fips_cd, CAST(SUM(abs_firm_num) AS BIGINT) AS total FROM survey_cells GROUP BY 1) b ON a.state_cnty_fips_cd = b.state_cnty_fips_cd""",
)
def _jn6(spark, d):
    parts = t.payroll_lines(spark, d).groupBy("state_cnty_fips_cd").agg(F.count(F.lit(1)).alias("parts"))
    total = t.survey_cells(spark, d).groupBy("state_cnty_fips_cd").agg(F.sum("abs_firm_num").alias("total"))
    return joins.full_outer(parts, total, ["state_cnty_fips_cd"])


@query(
    "jn7_qualifying_groups",
    "SELECT year_num, state_cnty_fips_cd, naics2_sector_cd, abs_firm_num FROM survey_cells WHERE state_cnty_fips_cd IN (SELECT state_cnty_fips_cd FROM survey_cells GROUP BY 1 HAVING MAX(abs_firm_num) >= 30)",
)
def _jn7(spark, d):
    df = t.survey_cells(spark, d).select(*S.FACT_KEY, "abs_firm_num")
    return joins.qualifying(df, aggregates.groups_at_least(df, ["state_cnty_fips_cd"], "abs_firm_num", 30), ["state_cnty_fips_cd"])


@query(
    "jn8_membership",
    "SELECT year_num, state_cnty_fips_cd, naics2_sector_cd FROM payroll_cells WHERE state_cnty_fips_cd IN (SELECT state_cnty_fips_cd FROM survey_cells)",
)
def _jn8(spark, d):
    known = t.survey_cells(spark, d).select("state_cnty_fips_cd").distinct()
    return joins.qualifying(t.payroll_cells(spark, d).select(*S.FACT_KEY), known, ["state_cnty_fips_cd"])


@query(
    "jn9_unmatched_both_ways",
    """SELECT 'fact' AS side, state_cnty_fips_cd FROM (SELECT DISTINCT state_cnty_fips_cd FROM cells) WHERE state_cnty_fips_cd NOT IN (SELECT state_cnty_fips_cd FROM county_ref)
       UNION ALL SELECT 'reference', state_cnty_fips_cd FROM county_ref WHERE state_cnty_fips_cd NOT IN (SELECT state_cnty_fips_cd FROM survey_cells)""",
)
def _jn9(spark, d):
    ref, key = t.county_ref(spark, d), ["state_cnty_fips_cd"]
    a = joins.unmatched(both_cells(spark, d), ref, key).withColumn("side", F.lit("fact"))
    return a.unionByName(joins.unmatched(ref, t.survey_cells(spark, d), key).withColumn("side", F.lit("reference")))


@query(
    "jn10_outer_compare",
    """SELECT COALESCE(a.area, b.area) AS area, COALESCE(a.naics2, b.naics2) AS naics2, a.emp AS emp_pipeline, b.emp AS emp_bls FROM
       (SELECT state_cnty_fips_cd AS area, naics2_sector_cd AS naics2, CAST(SUM(CAST(l_quantity AS BIGINT)) AS BIGINT) AS emp FROM payroll_lines WHERE l_linestatus = 'F' GROUP BY 1, 2) a
       FULL OUTER JOIN (SELECT state_cnty_fips_cd AS area, indstr_cd AS naics2, CAST(SUM(CAST(l_quantity AS BIGINT)) AS BIGINT) AS emp FROM payroll_lines GROUP BY 1, 2) b ON a.area = b.area AND a.naics2 = b.naics2""",
)
def _jn10(spark, d):
    lines = t.payroll_lines(spark, d)
    emp = F.sum(C("l_quantity").cast("bigint")).alias("emp")
    area = C("state_cnty_fips_cd").alias("area")
    ours = lines.where(C("l_linestatus") == "F").groupBy(area, C("naics2_sector_cd").alias("naics2")).agg(emp)
    official = lines.groupBy(area, C("indstr_cd").alias("naics2")).agg(emp)
    return joins.compare(ours, official, ["area", "naics2"], ("_pipeline", "_bls"))


@query(
    "jn11_state_and_name",
    """SELECT c_custkey, g.state_cnty_fips_cd FROM (SELECT c_custkey, substr(r_name,1,2) AS state_cd, CASE WHEN c_custkey % 4 = 0 THEN 'unknown' ELSE lower(n_name) END AS name_key
         FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey) x
       LEFT JOIN county_ref g ON x.state_cd = g.state_cd AND x.name_key = lower(g.cnty_nm)""",
)
def _jn11(spark, d):
    df = t.read(spark, d, "customer").join(t.geography(spark, d), C("c_nationkey") == C("n_nationkey"))
    df = df.select("c_custkey", "state_cd", F.when(C("c_custkey") % 4 == 0, "unknown").otherwise(F.lower("n_name")).alias("name_key"))
    ref = t.county_ref(spark, d).select("state_cd", F.lower("cnty_nm").alias("name_key"), "state_cnty_fips_cd")
    return joins.lookup(df, ref, ["state_cd", "name_key"]).select("c_custkey", "state_cnty_fips_cd")


@query(
    "jn12_differing_key_names",
    """SELECT c.naics2_sector_cd, c.line_cd, c.row_cnt, s.naics2_sector_desc FROM
       (SELECT naics2_sector_cd, 'L' || naics2_sector_cd AS line_cd, COUNT(*) AS row_cnt FROM industry GROUP BY 1, 2) c
       LEFT JOIN sector_ref s ON c.naics2_sector_cd = s.naics2_sector_cd AND c.line_cd = 'L' || s.naics2_sector_cd""",
)
def _jn12(spark, d):
    df = t.industries(spark, d).groupBy("naics2_sector_cd").agg(F.count(F.lit(1)).alias("row_cnt")).withColumn(
        "line_cd", F.concat(F.lit("L"), "naics2_sector_cd")
    )
    ref = t.sector_ref(spark, d).select(
        C("naics2_sector_cd").alias("IndustryClassification"), F.concat(F.lit("L"), "naics2_sector_cd").alias("LineCode"), "naics2_sector_desc"
    )
    out = joins.on_differing_names(df, ref, [("naics2_sector_cd", "IndustryClassification"), ("line_cd", "LineCode")])
    return out.select("naics2_sector_cd", "line_cd", "row_cnt", "naics2_sector_desc")


@query(
    "jn13_optional_chain",
    """SELECT r.state_cnty_fips_cd, r.naics2_sector_cd, r.year_num, abs_firm_num, qcew_ann_avg_emp_lvl_num FROM
       (SELECT DISTINCT state_cnty_fips_cd, naics2_sector_cd, year_num FROM payroll_lines) r
       LEFT JOIN survey_cells a ON r.state_cnty_fips_cd = a.state_cnty_fips_cd AND r.naics2_sector_cd = a.naics2_sector_cd AND r.year_num = a.year_num
       LEFT JOIN payroll_cells q ON r.state_cnty_fips_cd = q.state_cnty_fips_cd AND r.naics2_sector_cd = q.naics2_sector_cd AND r.year_num = q.year_num""",
)
def _jn13(spark, d):
    base = t.payroll_lines(spark, d).select(*S.FACT_KEY).distinct()
    others = [t.survey_cells(spark, d).select(*S.FACT_KEY, "abs_firm_num"), None, t.payroll_cells(spark, d).select(*S.FACT_KEY, "qcew_ann_avg_emp_lvl_num")]
    return joins.chain(base, others, S.FACT_KEY)


@query(
    "jn14_population_matches",
    "SELECT COUNT(*) AS county_cnt, COUNT(population_num) AS matched_cnt FROM (SELECT DISTINCT state_cnty_fips_cd FROM cells) c LEFT JOIN county_ref g ON c.state_cnty_fips_cd = g.state_cnty_fips_cd",
)
def _jn14(spark, d):
    from regionledger.plans import reference

    counties = both_cells(spark, d).select("state_cnty_fips_cd").distinct()
    return reference.population_matches(joins.lookup(counties, t.county_ref(spark, d), ["state_cnty_fips_cd"]))


@query(
    "jn15_match_indicator",
    """SELECT 'rate' AS item, COUNT(g.state_cnty_fips_cd) * 1.0 / COUNT(*) AS figure FROM cells c LEFT JOIN county_ref g ON c.state_cnty_fips_cd = g.state_cnty_fips_cd
       UNION ALL SELECT * FROM (SELECT c.state_cnty_fips_cd, CAST(COUNT(*) AS DOUBLE) AS n FROM cells c WHERE c.state_cnty_fips_cd NOT IN (SELECT state_cnty_fips_cd FROM county_ref) GROUP BY 1 ORDER BY n DESC, 1 LIMIT 10)""",
    "figure",
)
def _jn15(spark, d):
    ref = t.county_ref(spark, d).select("state_cnty_fips_cd")
    out = joins.marked(both_cells(spark, d).select("state_cnty_fips_cd"), ref, ["state_cnty_fips_cd"])
    top = aggregates.value_counts(out.where(~C("matched")), "state_cnty_fips_cd", 10)
    return joins.match_rate(out).select(F.lit("rate").alias("item"), C("match_rate").alias("figure")).unionByName(
        top.select(C("value").alias("item"), C("freq").cast("double").alias("figure"))
    )


@query(
    "jn16_split_key_grouped",
    """SELECT g.state_cd, SUM(q.qcew_ttl_ann_wage_usd_amt) AS wages FROM payroll q LEFT JOIN county_ref g
       ON q.state_fips_cd = substr(g.state_cnty_fips_cd,1,2) AND q.cnty_fips_cd = substr(g.state_cnty_fips_cd,3,3)
       WHERE q.naics2_sector_cd <> '99' GROUP BY 1""", "wages",
)
def _jn16(spark, d):
    fips = C("state_cnty_fips_cd")
    ref = t.county_ref(spark, d).select(F.substring(fips, 1, 2).alias("state_fips_cd"), F.substring(fips, 3, 3).alias("cnty_fips_cd"), "state_cd")
    df = t.payroll(spark, d).where(C("naics2_sector_cd") != "99")
    return joins.lookup(df, ref, ["state_fips_cd", "cnty_fips_cd"]).groupBy("state_cd").agg(F.sum("qcew_ttl_ann_wage_usd_amt").alias("wages"))


# --- sorting and sampling --------------------------------------------------------------------


@query("st1_total_sort", "SELECT * FROM survey_cells ORDER BY year_num, state_cnty_fips_cd, naics2_sector_cd", "abs_payroll_usd_amt", "abs_rcpt_usd_amt")
def _st1(spark, d):
    return ordering.sorted_output(t.survey_cells(spark, d), S.FACT_KEY)


@query("st2_global_top_k", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10", "o_totalprice")
def _st2(spark, d):
    return ordering.top_k(t.read(spark, d, "orders").select("o_orderkey", "o_totalprice"), "o_totalprice", ["o_orderkey"], 10)


@query("st3_top_k_absolute", "SELECT c_custkey, c_acctbal - 4500 AS diff FROM customer ORDER BY abs(c_acctbal - 4500) DESC, c_custkey LIMIT 5", "diff")
def _st3(spark, d):
    df = t.read(spark, d, "customer").select("c_custkey", (C("c_acctbal") - 4500).alias("diff"))
    return ordering.top_k_abs(df, "diff", ["c_custkey"], 5)


@query("st4_seeded_sample", "SELECT o_orderkey, o_custkey FROM orders ORDER BY md5(CAST(o_orderkey AS VARCHAR) || '|42'), o_orderkey LIMIT 1000")
def _st4(spark, d):
    return ordering.seeded_sample(t.read(spark, d, "orders").select("o_orderkey", "o_custkey"), ["o_orderkey"], 1000)


@query(
    "st5_county_top_rows",
    "SELECT naics2_sector_cd, year_num, qcew_ttl_ann_wage_usd_amt FROM payroll_cells WHERE state_cnty_fips_cd = '01001' ORDER BY qcew_ttl_ann_wage_usd_amt DESC, naics2_sector_cd, year_num LIMIT 10",
    "qcew_ttl_ann_wage_usd_amt",
)
def _st5(spark, d):
    df = t.payroll_cells(spark, d).where(C("state_cnty_fips_cd") == "01001").select("naics2_sector_cd", "year_num", "qcew_ttl_ann_wage_usd_amt")
    return ordering.top_k(df, "qcew_ttl_ann_wage_usd_amt", ["naics2_sector_cd", "year_num"], 10)


# --- set operations --------------------------------------------------------------------------


@query("so1_union_years", "SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS year_num FROM orders")
def _so1(spark, d):
    df = t.read(spark, d, "orders").select("o_orderkey", F.year("o_orderdate").alias("year_num"))
    years = [r[0] for r in df.select("year_num").distinct().orderBy("year_num").collect()]
    return sets.stack([df.where(C("year_num") == y) for y in years])


@query(
    "so2_union_differing_columns",
    "SELECT c_custkey AS id, c_mktsegment AS segment, CAST(NULL AS VARCHAR) AS name FROM customer UNION ALL SELECT s_suppkey, NULL, s_name FROM supplier",
)
def _so2(spark, d):
    a = t.read(spark, d, "customer").select(C("c_custkey").alias("id"), C("c_mktsegment").alias("segment"))
    b = t.read(spark, d, "supplier").select(C("s_suppkey").alias("id"), C("s_name").alias("name"))
    return sets.stack([a, b], allow_missing=True)


@query("so3_append_literal_rows", "SELECT * FROM sector_ref")
def _so3(spark, d):
    return t.sector_ref(spark, d)


@query(
    "so4_append_absent",
    """SELECT state_cnty_fips_cd, cnty_nm FROM county_ref UNION ALL
       SELECT state_cnty_fips_cd, n_name FROM geo WHERE state_cnty_fips_cd NOT IN (SELECT state_cnty_fips_cd FROM county_ref)""",
)
def _so4(spark, d):
    extra = t.geography(spark, d).select("state_cnty_fips_cd", C("n_name").alias("cnty_nm"))
    return sets.append_absent(t.county_ref(spark, d).select("state_cnty_fips_cd", "cnty_nm"), extra, ["state_cnty_fips_cd"])


@query(
    "so5_state_rollup_rows",
    """SELECT lpad(CAST(r_regionkey + 1 AS VARCHAR), 2, '0') || x.sfx AS state_cnty_fips_cd, substr(r_name,1,2) AS state_cd, r_name || x.txt AS cnty_nm
       FROM region, (VALUES ('000',' (statewide aggregation)'), ('999',' (unspecified county)')) x(sfx, txt)""",
)
def _so5(spark, d):
    states = t.read(spark, d, "region").select(
        F.lpad((C("r_regionkey") + 1).cast("string"), 2, "0").alias("state_fips_cd"), F.substring("r_name", 1, 2).alias("state_cd"), C("r_name").alias("state_nm")
    )
    return sets.state_rollup_rows(states)


@query("so6_unexpected_codes", "SELECT DISTINCT naics2_sector_cd FROM industry WHERE naics2_sector_cd NOT IN (SELECT naics2_sector_cd FROM sector_ref)")
def _so6(spark, d):
    return sets.unexpected(t.industries(spark, d), t.sector_ref(spark, d), "naics2_sector_cd")


@query(
    "so7_integer_gaps",
    "SELECT CAST(v AS BIGINT) AS o_orderkey FROM (SELECT unnest(range(lo, hi + 1)) AS v FROM (SELECT min(l_orderkey) AS lo, max(l_orderkey) AS hi FROM lineitem)) WHERE v NOT IN (SELECT l_orderkey FROM lineitem)",
)
def _so7(spark, d):
    return sets.gaps(t.read(spark, d, "lineitem").select(C("l_orderkey").alias("o_orderkey")), "o_orderkey")


@query(
    "so8_overrides_win",
    "SELECT c_custkey, CASE WHEN c_custkey % 20 = 0 THEN 'AAA' WHEN c_custkey % 10 = 0 THEN upper(c_mktsegment) || '!' ELSE c_mktsegment END AS label FROM customer",
)
def _so8(spark, d):
    base = t.read(spark, d, "customer").select("c_custkey", C("c_mktsegment").alias("label"))
    wins = base.where(C("c_custkey") % 10 == 0).withColumn("label", F.concat(F.upper("label"), F.lit("!")))
    # Some keys have two overrides.
    second = wins.where(C("c_custkey") % 20 == 0).withColumn("label", F.lit("AAA"))
    return sets.with_overrides(base, wins.unionByName(second), ["c_custkey"])
