"""Survey, payroll, GDP and release shaped inputs derived from the provided tables.

The provided tables hold no economic data, so nations play counties, regions
states, part brands industries and order or ship years the reference year. The
reductions below are written for large inputs: line items are summed per order
and sector before they meet the orders, and distinct firms and orders fall out of
two further sums instead of a row-multiplying distinct aggregate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from regionledger import schemas as S
from regionledger.functions import codes
from regionledger.operators import sets
from regionledger.plans import totals
from regionledger.sources import scratch

# Two-digit industry prefixes, one per part brand 1..25.
INDUSTRIES = [
    "11", "21", "22", "23", "31", "32", "33", "42", "44", "45", "48", "49", "51",
    "52", "53", "54", "55", "56", "61", "62", "71", "72", "81", "92", "99",
]
# Counties absent from the county references, so that lookups can miss.
UNLISTED = [7, 19]
YEARS = list(range(1995, 2002))
# The order level sums have nearly one group per line item, so a task holds its share of
# the lines. The share is fixed and the number of tasks follows the input.
LINES_PER_TASK = 250_000


_SCHEMAS: dict[str, T.StructType] = {}


def read(spark: SparkSession, d: str, table: str) -> DataFrame:
    """Provided table; its schema is looked up once per process, not once per use."""
    path = f"{d}/{table}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def money(c: str):
    return F.col(c).cast("decimal(18,2)")


def hundredths(c: str):
    """A two-digit amount as whole hundredths.

    Line level sums run on long integers, which is exact and several times faster
    than wide decimals; a cell's sum is widened before anything is added across cells.
    """
    return F.round(F.col(c) * 100).cast("bigint")


def from_units(c: str, units: int):
    return (F.col(c).cast("decimal(28,0)") / F.lit(units).cast("decimal(6,0)")).cast(S.MONEY)


def geography(spark: SparkSession, d: str) -> DataFrame:
    state = codes.zfill((F.col("n_regionkey") + 1).cast("string"), 2)
    county = codes.zfill((F.col("n_nationkey") + 1).cast("string"), 3)
    return read(spark, d, "nation").join(
        read(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    ).select(
        "n_nationkey", state.alias("state_fips_cd"), F.concat(state, county).alias("state_cnty_fips_cd"),
        "n_name", "r_name", F.substring("r_name", 1, 2).alias("state_cd"),
    )


def industries(spark: SparkSession, d: str) -> DataFrame:
    brand = codes.first_digits(F.col("p_brand")).cast("int")
    code = F.element_at(F.array(*[F.lit(i) for i in INDUSTRIES]), brand)
    return read(spark, d, "part").select(
        "p_partkey", code.alias("indstr_cd"), codes.sector_label(code).alias("naics2_sector_cd")
    )


def line_tasks(spark: SparkSession, d: str) -> int:
    """Tasks of the order level steps; the row counts come from the file footers."""
    rows = max(read(spark, d, table).count() for table in ("lineitem", "orders"))
    return max(spark.sparkContext.defaultParallelism, -(-rows // LINES_PER_TASK))


def survey_cells(spark: SparkSession, d: str) -> DataFrame:
    """County x sector x year; firms are customers, employment is orders."""
    tasks = line_tasks(spark, d)
    lines = read(spark, d, "lineitem").select(
        "l_orderkey", "l_partkey", hundredths("l_extendedprice").alias("rcpt"),
        (hundredths("l_extendedprice") * hundredths("l_discount")).alias("pay"),
    )
    per_order = (
        lines.join(industries(spark, d), F.col("l_partkey") == F.col("p_partkey"))
        # One exchange serves the sum and the join with orders.
        .repartition(tasks, "l_orderkey").groupBy("l_orderkey", "naics2_sector_cd")
        .agg(F.sum("pay").alias("pay"), F.sum("rcpt").alias("rcpt"))
    )
    buyers = read(spark, d, "customer").join(
        geography(spark, d), F.col("c_nationkey") == F.col("n_nationkey")
    ).where(F.col("n_nationkey") % 9 != 4).select("c_custkey", "state_cnty_fips_cd")
    orders = read(spark, d, "orders").select(
        "o_orderkey", "o_custkey", F.year("o_orderdate").alias("year_num")
    ).join(buyers, F.col("o_custkey") == F.col("c_custkey"))
    per_firm = (
        per_order.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        # A firm's orders are spread over all tasks: sums before this exchange would save no rows.
        .repartition(tasks, *S.FACT_KEY, "c_custkey").groupBy(*S.FACT_KEY, "c_custkey")
        .agg(F.count(F.lit(1)).alias("emp"), F.sum("pay").alias("pay"), F.sum("rcpt").alias("rcpt"))
    )
    cells = per_firm.groupBy(*S.FACT_KEY).agg(
        F.count(F.lit(1)).alias("firms"), F.sum("emp").alias("emp"),
        F.sum("pay").alias("pay"), F.sum("rcpt").alias("rcpt"),
    ).withColumns({"pay": from_units("pay", 10000), "rcpt": from_units("rcpt", 100)})
    shown = F.col("firms") >= 3
    return cells.select(
        *S.FACT_KEY,
        F.when(shown, F.col("firms")).alias("abs_firm_num"), F.when(shown, F.col("emp")).alias("abs_emp_num"),
        F.when(shown, F.col("pay")).alias("abs_payroll_usd_amt"), F.when(shown, F.col("rcpt")).alias("abs_rcpt_usd_amt"),
    )


def payroll_lines(spark: SparkSession, d: str) -> DataFrame:
    """Line items with the supplier's county and the part's industry."""
    sites = read(spark, d, "supplier").join(
        geography(spark, d), F.col("s_nationkey") == F.col("n_nationkey")
    ).where(F.col("n_nationkey") % 7 != 3).select("s_suppkey", "n_nationkey", "state_cnty_fips_cd", "state_cd", "n_name")
    return (
        read(spark, d, "lineitem")
        .join(sites, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(industries(spark, d), F.col("l_partkey") == F.col("p_partkey"))
        .withColumn("year_num", F.year("l_shipdate"))
    )


def payroll_cells(spark: SparkSession, d: str) -> DataFrame:
    return payroll_lines(spark, d).where(F.col("l_returnflag") == "R").groupBy(*S.FACT_KEY).agg(
        F.sum(F.col("l_quantity").cast("bigint")).alias("qcew_ann_avg_emp_lvl_num"),
        F.sum(hundredths("l_extendedprice")).alias("qcew_ttl_ann_wage_usd_amt"),
    ).withColumn("qcew_ttl_ann_wage_usd_amt", from_units("qcew_ttl_ann_wage_usd_amt", 100))


def _with_rollups(cells: DataFrame, measures: list[str]) -> DataFrame:
    """Cells plus statewide rows (county replaced) and all-sector rows (sector replaced)."""
    fips, sector = F.col("state_cnty_fips_cd"), F.col("naics2_sector_cd")
    pairs = [
        (fips, sector), (F.concat(codes.state_of(fips), F.lit(S.STATEWIDE_SUFFIX)), sector),
        (fips, F.lit(S.ALL_SECTORS)),
    ]
    variants = F.array(*[F.struct(f.alias("f"), s.alias("s")) for f, s in pairs])
    return cells.select("year_num", *measures, F.inline(variants)).groupBy(
        "year_num", F.col("f").alias("state_cnty_fips_cd"), F.col("s").alias("naics2_sector_cd")
    ).agg(*[F.sum(m).cast(cells.schema[m].dataType).alias(m) for m in measures])


def loaded(df: DataFrame) -> DataFrame:
    """A derived input as a stored table, for plans that read it more than once.

    The plans expect loaded tables. Left as a view, each of their branches would
    derive it from the line items again, under its own filters.
    """
    return scratch.materialise(df)


def survey(spark: SparkSession, d: str, rollups: bool = True) -> DataFrame:
    cells = survey_cells(spark, d)
    if rollups:
        cells = _with_rollups(cells, totals.SURVEY_SUMS)
    names = geography(spark, d).select("state_cnty_fips_cd", F.lower("n_name").alias("cnty_nm"))
    return cells.join(names, "state_cnty_fips_cd", "left").select(
        *S.FACT_KEY, "cnty_nm", F.concat(F.lit("0500000US"), "state_cnty_fips_cd").alias("geo_id"),
        F.concat(F.lit("survey "), "naics2_sector_cd").alias("naics2_sector_desc"),
        F.lit(2).cast("bigint").alias("ind_level_num"), *totals.SURVEY_SUMS,
        totals.money_ratio("abs_rcpt_usd_amt", "abs_emp_num").alias("abs_rcpt_per_emp_usd_amt"),
        totals.money_ratio("abs_rcpt_usd_amt", "abs_firm_num").alias("abs_rcpt_per_firm_usd_amt"),
    )


def payroll(spark: SparkSession, d: str, rollups: bool = True) -> DataFrame:
    cells = payroll_cells(spark, d)
    if rollups:
        cells = _with_rollups(cells, totals.PAYROLL_SUMS)
    weekly = F.try_divide(
        F.col("qcew_ttl_ann_wage_usd_amt"), (F.col("qcew_ann_avg_emp_lvl_num") * 52).cast("decimal(20,0)")
    )
    return cells.select(
        *S.FACT_KEY, codes.state_of(F.col("state_cnty_fips_cd")).alias("state_fips_cd"),
        codes.county_of(F.col("state_cnty_fips_cd")).alias("cnty_fips_cd"), F.lit("5").alias("own_cd"),
        *totals.PAYROLL_SUMS, weekly.cast(S.MONEY).alias("qcew_avg_wkly_wage_usd_amt"),
    )


def payroll_raw(spark: SparkSession, d: str) -> DataFrame:
    """Published payroll rows as text: short area codes, detailed industries, withheld cells."""
    withheld = F.col("l_linenumber") % 7 == 0
    own = F.when(F.col("l_returnflag") == "R", "5").when(F.col("l_returnflag") == "A", "0").otherwise("1")
    return payroll_lines(spark, d).select(
        F.col("state_cnty_fips_cd").cast("int").cast("string").alias("area_fips"),
        own.alias("own_code"),
        F.concat("indstr_cd", F.col("l_linenumber").cast("string")).alias("industry_code"),
        F.when(F.col("l_linestatus") == "F", "74").otherwise("75").alias("agglvl_code"),
        F.col("year_num").cast("string").alias("year"),
        F.when(F.col("l_linenumber") % 4 == 3, "1").otherwise("a").alias("qtr"),
        F.when(withheld, "(D)").otherwise(F.col("l_quantity").cast("int").cast("string")).alias("annual_avg_emplvl"),
        F.when(withheld, "(D)").otherwise(money("l_extendedprice").cast("string")).alias("total_annual_wages"),
        F.when(withheld, "(D)").otherwise((F.col("l_linenumber") * 100).cast("string")).alias("annual_avg_wkly_wage"),
    )


def survey_raw(spark: SparkSession, d: str, cells: DataFrame | None = None) -> DataFrame:
    """Published survey rows as text, money in $1,000s, withheld cells as ``D``."""
    def text(c: str, k: int = 1):
        return F.coalesce(F.floor(F.col(c) / k).cast("bigint").cast("string"), F.lit("D"))

    cells = survey_cells(spark, d) if cells is None else cells
    return cells.select(
        F.col("year_num").cast("string").alias("year_num"),
        F.concat(F.lit("Area "), "state_cnty_fips_cd").alias("NAME"),
        F.concat(F.lit("0500000US"), "state_cnty_fips_cd").alias("GEO_ID"),
        text("abs_firm_num").alias("FIRMPDEMP"), text("abs_emp_num").alias("EMP"),
        text("abs_payroll_usd_amt", 1000).alias("PAYANN"), text("abs_rcpt_usd_amt", 1000).alias("RCPPDEMP"),
        F.lit("2").alias("INDLEVEL"), F.col("naics2_sector_cd").alias("NAICS2022"),
        F.concat(F.lit("Sector "), "naics2_sector_cd").alias("NAICS2022_LABEL"),
        codes.state_of(F.col("state_cnty_fips_cd")).cast("int").cast("string").alias("state"),
        codes.county_of(F.col("state_cnty_fips_cd")).cast("int").cast("string").alias("county"),
    )


def population(spark: SparkSession, d: str) -> DataFrame:
    """Customers per nation, in thousands."""
    return read(spark, d, "customer").groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(
        (F.count(F.lit(1)) * 1000).alias("population_num")
    )


def county_ref(spark: SparkSession, d: str) -> DataFrame:
    listed = geography(spark, d).where(~F.col("n_nationkey").isin(UNLISTED))
    return listed.join(population(spark, d), "n_nationkey", "left").select(
        "state_cnty_fips_cd", "state_cd", F.col("n_nationkey").cast("string").alias("cnty_ansi_nm"),
        F.col("n_name").alias("cnty_nm"), "population_num", F.lit(2022).cast("bigint").alias("population_year"),
    )


def sector_ref(spark: SparkSession, d: str) -> DataFrame:
    base = industries(spark, d).select("naics2_sector_cd").where(
        ~F.col("naics2_sector_cd").isin("92", "99")
    ).distinct().withColumn("naics2_sector_desc", F.concat(F.lit("Sector "), "naics2_sector_cd"))
    return sets.append_rows(base, S.SECTOR_EXTRAS, "naics2_sector_cd string, naics2_sector_desc string")


def gdp_wide(spark: SparkSession, d: str) -> DataFrame:
    """Receipts as GDP text in $1,000s, one column per year, plus national lines."""
    cells = survey_cells(spark, d).select("state_cnty_fips_cd", "naics2_sector_cd", "year_num", "abs_rcpt_usd_amt")
    cells = cells.groupBy("state_cnty_fips_cd", "naics2_sector_cd", "year_num").agg(F.sum("abs_rcpt_usd_amt").alias("v"))
    nation = cells.groupBy(F.lit("00000").alias("state_cnty_fips_cd"), "naics2_sector_cd", "year_num").agg(F.sum("v").alias("v"))
    both = cells.unionByName(nation)
    wide = both.groupBy("state_cnty_fips_cd", "naics2_sector_cd").pivot("year_num", YEARS).agg(
        F.max(F.coalesce(F.floor(F.col("v") / 1000).cast("bigint").cast("string"), F.lit("(D)")))
    )
    area = F.when(F.col("state_cnty_fips_cd") == "00000", F.lit("00000")).otherwise(
        F.col("state_cnty_fips_cd").cast("int").cast("string")
    )
    return wide.select(
        F.concat(F.lit('"'), area, F.lit('"')).alias("GeoFIPS"),
        F.concat(F.lit("L"), "naics2_sector_cd").alias("LineCode"),
        F.col("naics2_sector_cd").alias("IndustryClassification"),
        F.concat(F.lit("Line "), "naics2_sector_cd").alias("Description"),
        *[F.coalesce(F.col(f"`{y}`"), F.lit("(NA)")).alias(str(y)) for y in YEARS],
    )


def facilities_raw(spark: SparkSession, d: str) -> DataFrame:
    """Facility release rows with pounds per medium as text."""
    def pounds(c: str):
        return (F.col(c) * 100).cast("decimal(18,2)").cast("string")

    fips = F.col("state_cnty_fips_cd")
    return payroll_lines(spark, d).select(
        codes.state_of(fips).cast("int").cast("string").alias("FIPS_STATE"),
        codes.county_of(fips).cast("int").cast("string").alias("FIPS_COUNTY"),
        F.concat("indstr_cd", F.lit("0000")).alias("PRIMARY_NAICS"),
        pounds("l_tax").alias("AIR_RELEASE_LBS"),
        F.when(F.col("l_linenumber") == 2, "NA").otherwise(pounds("l_discount")).alias("WATER_RELEASE_LBS"),
    )


def releases_raw(spark: SparkSession, d: str) -> DataFrame:
    """Facility release rows that carry county names instead of codes."""
    def pounds(c: str):
        return (F.col(c) * 100).cast("decimal(18,2)").cast("string")

    return payroll_lines(spark, d).select(
        F.concat(F.lit(" "), F.lower("state_cd")).alias("10. FACILITY STATE"),
        F.concat(F.initcap("n_name"), F.lit(" County")).alias("9. FACILITY COUNTY"),
        F.concat(F.lit("N"), "indstr_cd", F.lit("1110")).alias("41. PRIMARY NAICS CODE"),
        pounds("l_tax").alias("107. TOTAL ON-SITE RELEASES"),
        F.when(F.col("l_linenumber") == 3, "").otherwise(pounds("l_discount")).alias(
            "145. TOTAL TRANSFERRED OFF SITE FOR DISPOSAL"
        ),
    )


def county_names(spark: SparkSession, d: str) -> DataFrame:
    listed = geography(spark, d).where(~F.col("n_nationkey").isin(UNLISTED))
    return listed.select(
        F.lower("state_cd").alias("state_id"), F.col("state_cnty_fips_cd").cast("int").cast("string").alias("county_fips"),
        F.col("n_name").alias("county"), F.lower("n_name").alias("county_ascii"),
        F.concat("n_name", F.lit(" Parish")).alias("county_full"),
    )


def metro_raw(spark: SparkSession, d: str) -> DataFrame:
    """Three-digit industries per county and year, and reported totals that sometimes differ."""
    lines = payroll_lines(spark, d).select(
        "n_nationkey", "state_cnty_fips_cd", "year_num",
        F.concat("indstr_cd", (F.col("l_linenumber") % 3).cast("string")).alias("naics"),
        F.col("l_quantity").cast("bigint").alias("q"), F.col("l_linenumber").cast("bigint").alias("n"),
    )
    keys = ["n_nationkey", "state_cnty_fips_cd", "year_num", "naics"]
    measures = [F.count(F.lit(1)).alias("FIRMPDEMP"), F.sum("q").alias("EMP"),
                F.sum("n").alias("PAYANN"), F.sum(F.col("q") * 2).alias("RCPPDEMP")]
    parts = lines.groupBy(*keys).agg(*measures)
    whole = parts.groupBy("n_nationkey", "state_cnty_fips_cd", "year_num").agg(
        F.sum("FIRMPDEMP").alias("FIRMPDEMP"), F.sum("EMP").alias("EMP"), F.sum("PAYANN").alias("PAYANN"),
        F.sum("RCPPDEMP").alias("RCPPDEMP"),
    ).where(F.col("n_nationkey") % 8 != 6).withColumn("naics", F.lit("00")).withColumn(
        "EMP", F.col("EMP") + F.when(F.col("n_nationkey") % 5 == 0, 5).otherwise(0)
    )
    fips = F.col("state_cnty_fips_cd")
    return parts.unionByName(whole).select(
        codes.state_of(fips).alias("state"), codes.county_of(fips).alias("county"), F.col("naics").alias("NAICS2022"),
        F.col("year_num").cast("string").alias("year"),
        *[F.col(c).cast("string").alias(c) for c in ("FIRMPDEMP", "EMP", "PAYANN", "RCPPDEMP")],
    )


def crosswalk(spark: SparkSession, d: str) -> DataFrame:
    group = (F.col("n_nationkey") % 6).cast("string")
    geo = geography(spark, d).where(F.col("n_nationkey") != 11).join(population(spark, d), "n_nationkey", "left")
    fips = F.col("state_cnty_fips_cd")
    return geo.select(
        codes.state_of(fips).alias("state_fips"), codes.county_of(fips).alias("county_fips"),
        F.concat(F.lit("1000"), group).alias("cbsa_code"), F.concat(F.lit("Metro "), group).alias("cbsa_title"),
        F.col("population_num").alias("cbsa_pop"),
    )


def key_number():
    """A number per fact key, used to plant deviations."""
    return (
        F.col("year_num") + F.col("state_cnty_fips_cd").cast("int")
        + F.substring("naics2_sector_cd", 1, 2).cast("int")
    )


def stored_survey(spark: SparkSession, d: str, cells: DataFrame | None = None) -> DataFrame:
    """The survey table as stored: small and large deviations, one county missing."""
    k = key_number()
    cells = survey_cells(spark, d) if cells is None else cells
    return cells.where(F.col("state_cnty_fips_cd") != "04004").select(
        *S.FACT_KEY, F.col("abs_firm_num").alias("stored_abs_firms"),
        (F.col("abs_emp_num") + F.when(k % 17 == 0, 1).otherwise(0)).alias("stored_abs_emp"),
        (F.floor(F.col("abs_payroll_usd_amt") / 1000) * 1000 + F.when(k % 5 == 0, 500).otherwise(0)).cast("double").alias("stored_abs_payroll_usd_amt"),
        (F.floor(F.col("abs_rcpt_usd_amt") / 1000) * 1000 + F.when(k % 11 == 0, 2500).otherwise(0)).cast("double").alias("stored_abs_rcpt_usd_amt"),
    )


def stored_payroll(source: DataFrame) -> DataFrame:
    """Published payroll cells as stored: every fifth one off, weekly wages partly absent."""
    k = key_number()
    return source.where(F.col("state_cnty_fips_cd") != "02002").select(
        F.col("year").cast("int").alias("year_num"), "state_cnty_fips_cd", "naics2_sector_cd",
        F.col("annual_avg_emplvl").try_cast("double").alias("e"), F.col("total_annual_wages").try_cast("double").alias("w"),
    ).select(
        *S.FACT_KEY, F.coalesce("e", F.lit(10.0)).alias("stored_qcew_emp"),
        (F.col("w") + F.when(k % 5 == 0, 1).otherwise(0)).alias("stored_qcew_wages_usd"),
        F.when(k % 3 == 0, F.lit(None)).otherwise(F.lit(101.0)).cast("double").alias("stored_qcew_avg_weekly_wage_usd"),
    )


def export_text(spark: SparkSession, d: str) -> DataFrame:
    """The merged fact as an all-text export with a few planted defects."""
    from regionledger.plans import fact

    df = fact.merged(survey(spark, d, rollups=False), payroll(spark, d, rollups=False))
    k = key_number()
    text = lambda c: F.col(c).cast("string")
    money_text = lambda c: F.floor(c).cast("bigint").cast("string")
    return df.select(
        text("year_num").alias("year_num"), F.when(k % 97 == 0, F.substring("state_cnty_fips_cd", 1, 4)).otherwise(F.col("state_cnty_fips_cd")).alias("fips"),
        F.col("naics2_sector_cd"), text("abs_firm_num").alias("abs_firm_num"),
        F.when(k % 29 == 0, F.lit(None)).otherwise(text("abs_emp_num")).alias("abs_emp_num"),
        F.when(k % 13 == 0, "1e5").when(k % 31 == 0, "-5").otherwise(money_text("abs_payroll_usd_amt")).alias("abs_payroll_usd_amt"),
        F.when(k % 37 == 0, "n/a").otherwise(money_text("abs_rcpt_usd_amt")).alias("abs_rcpt_usd_amt"),
        text("qcew_ann_avg_emp_lvl_num").alias("qcew_ann_avg_emp_lvl_num"),
        money_text("qcew_ttl_ann_wage_usd_amt").alias("qcew_ttl_ann_wage_usd_amt"),
        F.lit("100").alias("qcew_avg_wkly_wage_usd_amt"),
    )
