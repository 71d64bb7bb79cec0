"""Queries of readers and writers: tables go out to shared storage and come back."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F, types as T

from regionledger import schemas as S
from regionledger.operators import quality
from regionledger.plans import fact
from regionledger.registry import tables as t
from regionledger.registry.core import query
from regionledger.registry.checks import check_row
from regionledger.registry.plans import _GEO_NAMES, payload_rows
from regionledger.sources import readers, scratch, writers

C = F.col
_CUSTOMER_TEXT = "CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey, c_mktsegment"


def _customers(spark, d):
    return t.read(spark, d, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")


@query("src1_csv_all_text", f"SELECT lpad(CAST(c_custkey AS VARCHAR), 9, '0') AS code, {_CUSTOMER_TEXT} FROM customer")
def _src1(spark, d):
    path = scratch.folder(spark)
    writers.write_csv(_customers(spark, d).select(F.lpad(C("c_custkey").cast("string"), 9, "0").alias("code"), "*"), path)
    return readers.csv_text(spark, path)


@query("src2_csv_latin1", "SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, 'é' || c_mktsegment || 'ñ' AS label FROM customer")
def _src2(spark, d):
    path = scratch.folder(spark)
    df = _customers(spark, d).select("c_custkey", F.concat(F.lit("é"), "c_mktsegment", F.lit("ñ")).alias("label"))
    df.write.option("header", True).option("encoding", "ISO-8859-1").csv(path)
    return readers.csv_latin1(spark, path)


@query(
    "src3_tsv_trimmed_header",
    "SELECT CAST(c_custkey AS VARCHAR) AS GEOID, CASE WHEN c_custkey % 2 = 0 THEN c_name ELSE '' END AS NAME, c_mktsegment AS INTPTLONG FROM customer",
)
def _src3(spark, d):
    path = scratch.folder(spark)
    name = F.when(C("c_custkey") % 2 == 0, C("c_name"))
    df = _customers(spark, d).select(C("c_custkey").alias("GEOID"), name.alias("NAME "), C("c_mktsegment").alias("INTPTLONG   "))
    df.write.option("header", True).option("sep", "\t").csv(path)
    return readers.tsv_trimmed(spark, path)


@query("src4_csv_headerless", "SELECT CAST(p_partkey AS VARCHAR) AS code, p_name AS title FROM part")
def _src4(spark, d):
    path = scratch.folder(spark)
    t.read(spark, d, "part").select("p_partkey", "p_name").write.csv(path, header=False)
    return readers.csv_headerless(spark, path, ["code", "title"])


@query(
    "src5_ragged_tsv",
    """SELECT 'row' AS kind, CAST(c_custkey AS VARCHAR) AS ID,
       CASE WHEN c_custkey % 50 = 0 THEN c_name || chr(10) || 'second line' WHEN c_custkey % 7 = 1 THEN 'SITE NAME depot'
            WHEN c_custkey % 11 = 3 THEN c_name || ' pipe 5" works' WHEN c_custkey % 13 = 5 THEN c_name || ' say "hi"' ELSE c_name END AS "SITE NAME",
       CASE c_custkey % 3 WHEN 0 THEN '' WHEN 1 THEN c_mktsegment ELSE c_mktsegment || chr(9) || 'extra' END AS SEGMENT
       FROM customer UNION ALL SELECT 'rejected', CAST(0 AS VARCHAR), NULL, NULL""",
)
def _src5(spark, d):
    """Data rows that hold the header's keyword, records of two lines, short and long rows, a trailer,
    inch marks in unquoted fields and doubled quotes in quoted ones."""
    path = scratch.folder(spark)
    seg = (
        F.when(C("c_custkey") % 3 == 1, F.concat(F.lit("\t"), "c_mktsegment"))
        .when(C("c_custkey") % 3 == 2, F.concat(F.lit("\t"), "c_mktsegment", F.lit("\textra"))).otherwise("")
    )
    name = (
        F.when(C("c_custkey") % 50 == 0, F.concat("c_name", F.lit("\nsecond line"))).when(C("c_custkey") % 7 == 1, "SITE NAME depot")
        .when(C("c_custkey") % 13 == 5, F.concat("c_name", F.lit(' say ""hi""'))).otherwise(C("c_name"))
    )
    quoted = F.concat(F.lit('"'), name, F.lit('"'))
    inch = (C("c_custkey") % 50 != 0) & (C("c_custkey") % 7 != 1) & (C("c_custkey") % 11 == 3)
    quoted = F.when(inch, F.concat("c_name", F.lit(' pipe 5" works'))).otherwise(quoted)
    lines = _customers(spark, d).select(F.concat(C("c_custkey").cast("string"), F.lit("\t"), quoted, seg).alias("value"))
    trailer = t.read(spark, d, "region").where("r_regionkey = 0").select(F.lit("Total output lines: 99").alias("value"))

    def headed(batches):
        # Every part file opens with the header.
        yield pd.DataFrame({"value": ["\ufeffID\tSITE NAME\tSEGMENT\t20240131"]})
        yield from batches

    lines.unionByName(trailer).mapInPandas(headed, "value string").write.text(path)
    rows, rejected = readers.ragged_tsv(spark, path, "SITE NAME")
    none = F.lit(None).cast("string")
    misses = rejected.agg(F.count(F.lit(1)).cast("string").alias("ID")).select(F.lit("rejected").alias("kind"), "ID", none.alias("SITE NAME"), none.alias("SEGMENT"))
    return rows.withColumn("kind", F.lit("row")).unionByName(misses)


_FIELDS = ["NAICS2022", "FIRMPDEMP", "EMP", "PAYANN", "RCPPDEMP", "state", "county"]


@query("src6_json_header_rows", f"SELECT CAST(year_num AS INTEGER) AS year_num, {', '.join(_FIELDS)}, CAST(NULL AS VARCHAR) AS note FROM survey_raw")
def _src6(spark, d):
    path = scratch.folder(spark)
    header = F.array(*[F.lit(f) for f in _FIELDS], F.lit("NAICS2022"))
    row = F.array(*_FIELDS, "NAICS2022")
    # One payload per year and state, as the source serves them.
    payloads = t.survey_raw(spark, d).groupBy("year_num", C("state").alias("state_part")).agg(
        F.to_json(F.concat(F.array(header), F.collect_list(row))).alias("value")
    )
    payloads.repartition("year_num", "state_part").write.partitionBy("year_num", "state_part").text(path)
    return readers.json_header_rows(spark, path, _FIELDS, keep=("year_num",))


@query(
    "src7_json_nested_results",
    """SELECT state_cnty_fips_cd AS geofips, 'Area ' || state_cnty_fips_cd AS geoname, CAST(year_num AS VARCHAR) AS timeperiod,
       CASE naics2_sector_cd WHEN '31-33' THEN '31G' WHEN '44-45' THEN '44RT' WHEN '48-49' THEN '48TW' WHEN '92' THEN 'G' ELSE naics2_sector_cd END AS industryclassification,
       'Sector ' || naics2_sector_cd AS description, COUNT(*) * 2 AS copies FROM survey_cells GROUP BY ALL""",
)
def _src7(spark, d):
    path = scratch.folder(spark)
    rows = payload_rows(spark, d)
    data = F.struct(F.struct(F.collect_list(F.struct(*rows.columns)).alias("Data")).alias("Results"))
    # One payload per industry line and year, as the source serves them.
    payloads = rows.groupBy(C("TimePeriod").alias("y"), C("IndustryClassification").alias("line")).agg(data.alias("BEAAPI"))
    payloads.repartition("y", "line").write.partitionBy("y", "line").json(path)
    back = readers.json_nested_results(spark, path).drop("datavalue")
    return back.groupBy(*back.columns).agg(F.count(F.lit(1)).alias("copies"))


@query("src8_typed_load", "SELECT * FROM payroll", "qcew_ttl_ann_wage_usd_amt", "qcew_avg_wkly_wage_usd_amt")
def _src8(spark, d):
    path = scratch.folder(spark)
    writers.write_csv(t.payroll(spark, d).select([f.name for f in S.PAYROLL.fields]), path)
    return readers.csv_typed(spark, path, S.PAYROLL)


@query("src9_file_per_year", "SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_orderstatus, CAST(year(o_orderdate) AS INTEGER) AS file_year FROM orders")
def _src9(spark, d):
    base = scratch.folder(spark)
    orders = t.read(spark, d, "orders").select("o_orderkey", "o_orderstatus", F.year("o_orderdate").alias("file_year"))
    orders.write.option("header", True).option("escape", '"').partitionBy("file_year").csv(base)
    years = [r[0] for r in orders.select("file_year").distinct().orderBy("file_year").collect()]
    return readers.csv_per_year(spark, base + "/file_year={year}", years)


@query("src10_inline_literals", f"SELECT state_cnty_fips_cd, cnty_nm AS ref_cnty_nm, state_nm, cnty_full_nm, population_num, population_year FROM ({_GEO_NAMES})")
def _src10(spark, d):
    return fact.county_names(t.county_ref(spark, d))


@query("src11_parameterised_scan", "SELECT * FROM payroll_cells WHERE year_num IN (1996, 1997) AND state_cnty_fips_cd IN ('01001','02002') AND naics2_sector_cd IN ('42','62')", "qcew_ttl_ann_wage_usd_amt")
def _src11(spark, d):
    return readers.parameterised(t.payroll_cells(spark, d), [1996, 1997], ["01001", "02002"], ["42", "62"])


@query("src12_csv_columns", "SELECT CAST(s_suppkey AS VARCHAR) AS s_suppkey, s_name FROM supplier")
def _src12(spark, d):
    path = scratch.folder(spark)
    writers.write_csv(t.read(spark, d, "supplier"), path)
    return readers.csv_columns(spark, path, ["s_suppkey", "s_name", "absent"])


@query(
    "src13_csv_after_preamble",
    "SELECT CASE WHEN p_partkey % 9 = 4 THEN '-' ELSE CAST(p_partkey AS VARCHAR) END AS code, p_name AS title, p_retailprice AS price FROM part", "price",
)
def _src13(spark, d):
    """Data lines whose first field is quoted, or no number at all, are data."""
    path = scratch.folder(spark)
    number = C("p_partkey").cast("string")
    code = F.when(C("p_partkey") % 9 == 4, "-").when(C("p_partkey") % 5 == 2, F.concat(F.lit('"'), number, F.lit('"'))).otherwise(number)
    data = t.read(spark, d, "part").select(F.concat_ws(",", code, "p_name", "p_retailprice").alias("value"))
    preamble = t.read(spark, d, "region").select(F.concat(F.lit("Bureau table, "), "r_name").alias("value"))
    preamble.unionByName(data).write.text(path)
    schema = T.StructType([T.StructField("code", T.StringType()), T.StructField("title", T.StringType()), T.StructField("price", T.DoubleType())])
    return readers.csv_after_preamble(spark, path, "^Bureau table, ", schema)


# --- sinks -----------------------------------------------------------------------------------


@query("snk1_csv_export", f"SELECT {_CUSTOMER_TEXT} FROM customer")
def _snk1(spark, d):
    path = scratch.folder(spark)
    writers.write_csv(_customers(spark, d), path)
    return readers.csv_text(spark, path)


@query(
    "snk2_years_stacked",
    "SELECT * REPLACE (CASE WHEN year_num = 1998 THEN abs_emp_num + 1 ELSE abs_emp_num END AS abs_emp_num) FROM survey_cells", "abs_payroll_usd_amt", "abs_rcpt_usd_amt",
)
def _snk2(spark, d):
    """All years, then one of them again: the rerun replaces its year and no other."""
    path = scratch.folder(spark)
    cells = scratch.materialise(t.survey_cells(spark, d))
    writers.write_years(cells, path, S.FACT_KEY)
    again = cells.where(C("year_num") == 1998).withColumn("abs_emp_num", C("abs_emp_num") + 1)
    writers.write_years(again, path, S.FACT_KEY)
    return spark.read.schema(cells.schema).parquet(path)


@query("snk3_replace_table", "SELECT o_orderstatus, COUNT(*) AS row_cnt FROM orders GROUP BY 1")
def _snk3(spark, d):
    path = scratch.folder(spark)
    name = f"regionledger_orders_{path.rsplit('/', 1)[-1]}"
    writers.replace_table(t.read(spark, d, "orders"), name, path)
    return spark.table(name).groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("row_cnt"))


@query("snk4_append_runs", "SELECT 2 * COUNT(*) AS row_cnt, CAST(2 AS BIGINT) AS run_cnt FROM supplier")
def _snk4(spark, d):
    path = scratch.folder(spark)
    for _ in range(2):
        writers.append_run(t.read(spark, d, "supplier"), path)
    return writers.runs(spark, path).agg(F.count(F.lit(1)).alias("row_cnt"), F.countDistinct("run_id").alias("run_cnt"))


@query("snk5_latest_run", "SELECT s_suppkey, s_name FROM supplier WHERE s_suppkey % 2 = 0")
def _snk5(spark, d):
    path = scratch.folder(spark)
    s = t.read(spark, d, "supplier").select("s_suppkey", "s_name")
    writers.append_run(s, path)
    writers.append_run(s.where(C("s_suppkey") % 2 == 0), path)
    return writers.latest_run(spark, path).drop("run_id", "run_ts")


@query("snk6_view", "SELECT c_mktsegment, COUNT(*) AS row_cnt FROM customer GROUP BY 1")
def _snk6(spark, d):
    writers.publish_view(_customers(spark, d), "regionledger_customers")
    return spark.sql("SELECT c_mktsegment, count(*) AS row_cnt FROM regionledger_customers GROUP BY c_mktsegment")


@query("snk7_failing_rows", "SELECT CAST(year_num AS VARCHAR) AS year_num, state_cnty_fips_cd, naics2_sector_cd FROM payroll_cells WHERE naics2_sector_cd = '92'")
def _snk7(spark, d):
    path = scratch.folder(spark)
    bad = quality.failing_sectors(t.payroll_cells(spark, d).select(*S.FACT_KEY), t.sector_ref(spark, d))
    writers.write_failures(bad, path)
    return readers.csv_text(spark, path)


@query(
    "snk8_check_report",
    check_row("non-negative c_acctbal", "ERROR", "COUNT(*) FILTER (c_acctbal < 0)", "rows below zero", "customer"),
)
def _snk8(spark, d):
    path = scratch.folder(spark)
    writers.write_report(quality.non_negative(t.read(spark, d, "customer"), ["c_acctbal"]), path)
    return spark.read.schema("check string, severity string, passed boolean, failed_rows bigint, detail string").json(path)
