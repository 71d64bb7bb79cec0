"""Fact semantics, physical plans, readers and writers, release names, metro totals."""

import re

import pytest
from pyspark.sql import functions as F

from regionledger import schemas as S
from regionledger.operators import quality
from regionledger.plans import fact, gdp, metro, payroll, reference, releases, sanity, survey, totals
from regionledger.sources import readers, scratch, writers

SURVEY_DDL = (
    "year_num int, state_cnty_fips_cd string, naics2_sector_cd string, cnty_nm string, geo_id string, naics2_sector_desc string,"
    "ind_level_num long, abs_firm_num long, abs_emp_num long, abs_payroll_usd_amt decimal(38,9), abs_rcpt_usd_amt decimal(38,9),"
    "abs_rcpt_per_emp_usd_amt decimal(38,9), abs_rcpt_per_firm_usd_amt decimal(38,9)"
)
PAYROLL_DDL = (
    "year_num int, naics2_sector_cd string, state_cnty_fips_cd string, state_fips_cd string, cnty_fips_cd string, own_cd string,"
    "qcew_ann_avg_emp_lvl_num long, qcew_ttl_ann_wage_usd_amt decimal(38,9), qcew_avg_wkly_wage_usd_amt decimal(38,9)"
)


def inputs(spark):
    from decimal import Decimal as D

    def s(y, f, sec, firms):
        money = None if firms is None else D(firms * 100)
        return (y, f, sec, "survey name", "g" + f, "desc " + sec, 2, firms, firms, money, money, None, None)

    survey_rows = [
        s(2022, "06001", "11", 10), s(2022, "06001", "21", 30), s(2023, "06001", "11", 20), s(2022, "06003", "11", 40),
        s(2022, "06000", "11", 50), s(2022, "06001", "00", 999), s(2023, "06003", "11", None),
    ]
    pay = lambda y, f, sec, e: (y, sec, f, f[:2], f[2:], "5", e, D(e * 52), D(1))
    payroll_rows = [pay(2022, "06001", "11", 5), pay(2022, "06005", "42", 7), pay(2023, "06001", "11", 0)]
    counties = spark.createDataFrame(
        [("06001", "CA", "Alameda", 100, 2022), ("06003", "ZZ", "Alpine", 10, 2022)],
        "state_cnty_fips_cd string, state_cd string, cnty_nm string, population_num long, population_year long",
    )
    sectors = spark.createDataFrame([("11", "Agriculture")], "naics2_sector_cd string, naics2_sector_desc string")
    return (
        spark.createDataFrame(survey_rows, SURVEY_DDL), spark.createDataFrame(payroll_rows, PAYROLL_DDL), counties, sectors,
    )


def build(spark, **kw):
    sv, pr, counties, sectors = inputs(spark)
    df = fact.benchmark(sv, pr, counties, sectors, totals.state_totals(sv, pr), **kw)
    return df, {(r["year_num"], r["state_cnty_fips_cd"], r["naics2_sector_cd"]): r for r in df.collect()}


def test_fact_columns_keys_and_labels(spark):
    df, rows = build(spark)
    assert df.columns == fact.COLUMNS and len(fact.COLUMNS) == 50
    assert len(rows) == 6 and not any(k[1].endswith("000") or k[2] == "00" for k in rows)
    one = rows[(2022, "06001", "11")]
    assert (one["cnty_full_nm"], one["naics2_sector_desc"]) == ("Alameda, California", "Agriculture")
    assert rows[(2022, "06003", "11")]["state_nm"] == "ZZ"
    assert rows[(2022, "06001", "21")]["naics2_sector_desc"] == "desc 21"
    lone = rows[(2022, "06005", "42")]
    assert (lone["naics2_sector_desc"], lone["cnty_nm"], lone["geo_id"]) == ("42", None, None)


def test_fact_measures(spark):
    _, rows = build(spark)
    one, later = rows[(2022, "06001", "11")], rows[(2023, "06001", "11")]
    assert one["cnty_abs_firm_num"] == 40 and one["cnty_firm_cncntrtn_idx"] == pytest.approx(0.25**2 + 0.75**2)
    assert (later["abs_firm_prev_year_num"], later["cnty_abs_firm_prev_year_num"]) == (10, 40)
    assert later["state_abs_firm_prev_year_num"] == 100 and one["state_abs_firm_num"] == 100
    assert later["qcew_wage_per_emp_usd_amt"] is None and float(one["qcew_wage_per_emp_usd_amt"]) == 52


def test_statewide_rows_take_part_in_ranks_unless_dropped_first(spark):
    assert build(spark)[1][(2022, "06003", "11")]["state_abs_firm_rank_num"] == 2
    assert build(spark, rollups_first=True)[1][(2022, "06003", "11")]["state_abs_firm_rank_num"] == 1


def test_fact_plan_has_two_window_exchanges_and_no_python(spark, tmp_path):
    sv, pr, counties, sectors = (scratch.materialise(df) for df in inputs(spark))
    df = fact.benchmark(sv, pr, counties, sectors, scratch.materialise(totals.state_totals(sv, pr)))
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    windows = [line for line in plan.splitlines() if "Window [" in line]
    assert len(windows) >= 5 and "Python" not in plan
    # Above the source join: the first exchange under the window stack, once per hash key set.
    fact_side = [x for x in plan.splitlines() if re.search(r"Exchange hashpartitioning\((state_cnty_fips_cd|state_fips_cd)", x)]
    keyed = {re.search(r"hashpartitioning\(([a-z_#0-9, ]+), 8\)", x).group(1) for x in fact_side}
    names = sorted(re.sub(r"#\d+", "", k) for k in keyed)
    assert names.count("state_cnty_fips_cd") == 1
    assert names.count("state_fips_cd, naics2_sector_cd, year_num") == 1


def test_all_sector_and_statewide_tables(spark):
    sv, pr, counties, sectors = inputs(spark)
    total = totals.all_sector_rows(sv, pr).collect()
    assert [(r["state_cnty_fips_cd"], r["naics2_sector_cd"]) for r in total] == [("06001", "00")]
    wide = fact.statewide(sv, pr, counties, sectors).collect()
    assert [(r["state_cnty_fips_cd"], r["abs_firm_num"]) for r in wide] == [("06000", 50)]


def test_metro_missing_side_is_ok_and_named(spark):
    df = spark.createDataFrame(
        [("6", "1", "541", "3", "9"), ("6", "1", "00", "3", "9"), ("6", "3", "541", "5", "5"), ("6", "5", "541", "5", None), ("6", "5", "000", "9", "1")],
        "state string, county string, naics string, firms string, emp string",
    ).withColumns({"PAYANN": F.lit("1"), "RCPPDEMP": F.lit("1")})
    rows = {r["county"]: r for r in metro.reconcile_totals(metro.normalise(df)).collect()}
    assert rows["001"]["recon_ok"] and rows["001"]["missing_side"] is None
    assert rows["003"]["recon_ok"] and rows["003"]["missing_side"] == "total"
    assert not rows["005"]["recon_ok"] and rows["005"]["sum_emp"] is None


def test_ragged_file(spark, tmp_path):
    (tmp_path / "r.txt").write_text(
        "\ufeff1. FACILITY STATE\tB\tC\t20240101\nCA\tx\ty\nNV\nacme FACILITY STATE depot\tCA\nOR\t1\t2\t3\n\"A\"\t\"b\tc \"\"q\"\"\"\td\\e\n"
        "WA\t\"two\nlines\"\tz\n\nTX\t\"open\nTotal output lines: 5\n",
        encoding="utf-8",
    )
    (tmp_path / "s.txt").write_text("1. FACILITY STATE\tB\tC\t20240101\nID\tFACILITY STATE\n")
    rows, rejected = readers.ragged_tsv(spark, str(tmp_path), "FACILITY STATE")
    assert rows.columns == ["1. FACILITY STATE", "B", "C"]
    got = sorted(tuple(r) for r in rows.collect())
    # Of fifteen lines two are headers, one is blank, one a trailer, two are one record.
    assert got == [
        ("A", 'b\tc "q"', "de"), ("CA", "x", "y"), ("ID", "FACILITY STATE", ""), ("NV", "", ""), ("OR", "1", "2\t3"),
        ("WA", "two\nlines", "z"), ("acme FACILITY STATE depot", "CA", ""),
    ]
    # The quote after TX opens a field that never closes: the rest of the file is that record.
    assert sorted(r[0] for r in rejected.collect()) == ['TX\t"open', "Total output lines: 5"]
    with pytest.raises(ValueError):
        readers.ragged_tsv(spark, str(tmp_path), "no such keyword")


def test_preamble_is_told_by_its_own_pattern(spark, tmp_path):
    (tmp_path / "p.csv").write_text('Bureau table, 1\n"2",b\n-,c\n\n3,d\n')
    got = readers.csv_after_preamble(spark, str(tmp_path), "^Bureau", readers.text_schema(["code", "title"])).collect()
    assert sorted(map(tuple, got)) == [("-", "c"), ("2", "b"), ("3", "d")]


def test_latest_run_reads_one_partition(spark, tmp_path):
    from regionledger.sources import writers

    path = str(tmp_path / "runs")
    for n in (3, 2):
        writers.append_run(spark.range(n).toDF("x"), path)
    latest = writers.latest_run(spark, path)
    assert latest.count() == 2
    assert "PartitionFilters: [isnotnull(run" in latest._jdf.queryExecution().executedPlan().toString()


def test_payload_error_raises(spark, tmp_path):
    (tmp_path / "e.json").write_text('{"BEAAPI": {"Error": {"APIErrorDescription": "bad table"}}}')
    with pytest.raises(Exception, match="bad table"):
        readers.json_nested_results(spark, str(tmp_path)).collect()


def test_typed_load_fails_on_malformed_row(spark, tmp_path):
    (tmp_path / "s.csv").write_text("naics2_sector_cd,naics2_sector_desc\n11,x\n")
    assert readers.csv_typed(spark, str(tmp_path), S.SECTOR_REF).count() == 1
    (tmp_path / "s.csv").write_text("y,v\nabc,1\n")
    from pyspark.sql import types as T

    schema = T.StructType([T.StructField("y", T.IntegerType()), T.StructField("v", T.IntegerType())])
    with pytest.raises(Exception):
        readers.csv_typed(spark, str(tmp_path), schema).collect()


def test_write_gate_and_latest_run(spark, tmp_path):
    df = spark.createDataFrame([(2022, "a"), (2022, "a")], "year_num int, k string")
    with pytest.raises(ValueError, match="repeat"):
        writers.write_years(df, str(tmp_path / "y"), ["year_num", "k"])
    writers.write_years(df.distinct(), str(tmp_path / "y"), ["year_num", "k"])
    assert (tmp_path / "y" / "year_num=2022").is_dir()
    writers.append_run(df, str(tmp_path / "runs"), "one")
    writers.append_run(df.limit(1), str(tmp_path / "runs"), "two")
    assert [r["run_id"] for r in writers.latest_run(spark, str(tmp_path / "runs")).collect()] == ["two"]


def test_county_reference(spark):
    src = spark.createDataFrame(
        [("1001 ", "AL", "01", "Autauga County", "1", "x", "32.5", "-86"), ("1001", "AL", "01", "Autauga County", "1", "x", "32.5", "-86"),
         ("9001", "CT", "02", "Fairfield", "2", "3", "41", "-73"), ("bad", "AL", "", "", "", "", "", "")],
        "GEOID string, USPS string, ANSICODE string, NAME string, ALAND string, AWATER string, INTPTLAT string, INTPTLONG string",
    )
    rows = {r["state_cnty_fips_cd"]: r for r in reference.counties(src).collect()}
    assert len(rows) == 2 + 2 * 53 + 10
    assert rows["09001"]["cnty_nm"] == "Fairfield" and rows["09003"]["cnty_nm"] == "Hartford County"
    assert rows["06000"]["cnty_nm"] == "California (statewide aggregation)" and rows["01001"]["water_area_num"] is None


def test_county_name_lookup_overrides(spark):
    ref = spark.createDataFrame(
        [("ct", "9999", "Fairfield", "Fairfield", "Fairfield County"), ("mo", "29510", "St. Louis", "St. Louis", "St. Louis City")],
        "state_id string, county_fips string, county string, county_ascii string, county_full string",
    )
    look = {(r["state_code"], r["county_name_norm"]): r["county_fips_5"] for r in releases.county_lookup(ref).collect()}
    assert look[("CT", "fairfield")] == "09001" and look[("MO", "saintlouis")] == "29510" and len(look) == 10
    named = spark.createDataFrame(
        [("MO", "ST LOUIS CITY", "11", 5.0), ("PR", "PONCE", "11", 1.0), ("MO", "NOWHERE", "11", 2.0)],
        "state_cd string, cnty_nm string, naics2_sector_cd string, tri_ttl_rls_lbs_amt double",
    )
    coded = releases.with_county_codes(named, releases.county_lookup(ref))
    rate = releases.resolve_rate(coded).first()
    assert (rate["resolvable_cnt"], rate["resolved_cnt"]) == (2, 1)
    assert [r["cnty_nm"] for r in releases.unresolved(coded).collect()] == ["NOWHERE"]


def test_facility_total_column_wins(spark):
    df = spark.createDataFrame([("6", "1", "325180", "7.5", "1")], "FIPS_STATE string, FIPS_COUNTY string, NAICS_CODE string, TOTAL_RELEASE_LBS string, AIR_RELEASE_LBS string")
    assert tuple(releases.facilities(df).first())[:3] == ("06", "001", "32")
    assert float(releases.facilities(df).first()[3]) == 7.5
    with pytest.raises(ValueError, match="release columns"):
        releases.facilities(df.drop("TOTAL_RELEASE_LBS", "AIR_RELEASE_LBS"))


def test_gdp_tidy_and_tokens(spark):
    raw = spark.createDataFrame(
        [(' "01001"', "1", "11", "Farm", "5", "(D)"), ("00000", "1", "11", "Farm", "9", "9"), ("01003", "1", "11", "Farm", "(NA)", "(D)")],
        ["GeoFIPS", "LineCode", "IndustryClassification", "Description", "2021", "2022"],
    )
    rows = gdp.tidy(raw, [2021, 2022]).collect()
    assert [(r["state_county_fips_cd"], r["2021_gdp_num"], r["2022_gdp_num"]) for r in rows] == [("01001", 5000.0, None)]
    assert gdp.suppressed(raw, [2021, 2022]).first()[0] == 3


def test_spot_check_level_filter(spark):
    raw = spark.createDataFrame(
        [("6087", "5", "11", "74", "2022", "A", "10", "5200", "10"), ("6087", "5", "111", "75", "2022", "A", "4", "52", "1")],
        "area_fips string, own_code string, industry_code string, agglvl_code string, year string, qtr string, annual_avg_emplvl string, total_annual_wages string, annual_avg_wkly_wage string",
    )
    row = payroll.spot_check(raw, 2022, "06087").first()
    assert (row["naics2"], row["employment_diff"], row["wage_diff"]) == ("11", 0.0, 0.0)


def test_survey_table_drops_public_and_empty(spark):
    raw = spark.createDataFrame(
        [("2022", "A", "g", f, "4", "2", "8", "2", n, "lab", "6", "75") for f, n in (("2", "42"), ("0", "42"), ("D", "51"), ("3", "92"), ("1", "99"))],
        "year_num string, NAME string, GEO_ID string, FIRMPDEMP string, EMP string, PAYANN string, RCPPDEMP string, INDLEVEL string, NAICS2022 string, NAICS2022_LABEL string, state string, county string",
    )
    rows = {r["naics2_sector_cd"]: r for r in survey.table(raw).collect()}
    assert sorted(rows) == ["42", "99"] and rows["42"]["state_cnty_fips_cd"] == "06075"
    assert rows["42"]["abs_payroll_usd_amt"] == 2000 and rows["42"]["abs_rcpt_per_firm_usd_amt"] == 4000
    assert survey.table(raw).schema == S.SURVEY or [f.name for f in survey.table(raw).schema] == [f.name for f in S.SURVEY]


def test_sanity_stops_at_missing_columns(spark):
    bad = spark.createDataFrame([("x",)], ["year"])
    ref = spark.createDataFrame([("11", "a")], ["naics2", "sector_name"])
    cty = spark.createDataFrame([("06", "001", "A", "CA")], ["state_fips", "county_fips", "cnty_nm", "state_cd"])
    checks = sanity.run(bad, ref, cty, [2022], 1, 1)
    rows = {r["check"]: r for r in checks.collect()}
    assert not rows["fact: required columns"]["passed"] and not rows["fact: delimiter"]["passed"]
    verdict = {r["severity"]: r for r in quality.verdict(checks).collect()}
    assert verdict["ERROR"]["acceptable"] is False


def test_load_checked(spark, tmp_path):
    missing, checks = sanity.load_checked(spark, str(tmp_path / "none.csv"), "fact")
    assert missing is None and [r["passed"] for r in checks.collect()] == [False]
    path = tmp_path / "f.csv"
    path.write_text("a,b\n1,2\n1,2,3\n4\n")
    df, checks = sanity.load_checked(spark, str(path), "fact")
    rows = {r["check"]: r["failed_rows"] for r in checks.collect()}
    assert df.columns == ["a", "b"] and rows["fact: rows parse cleanly"] == 1


def test_year_files_fall_back(spark, tmp_path):
    (tmp_path / "b").mkdir()
    (tmp_path / "b" / "2022.csv").write_text("x\n007\n")
    df = readers.csv_per_year(spark, str(tmp_path / "a/{year}.csv"), [2022], fallback=str(tmp_path / "b/{year}.csv"))
    assert [tuple(r) for r in df.collect()] == [("007", 2022)]
    with pytest.raises(FileNotFoundError):
        readers.csv_per_year(spark, str(tmp_path / "a/{year}.csv"), [2022])


def test_sector_field_by_year():
    assert (survey.sector_field(2023), survey.sector_field(2027)) == ("NAICS2022", "NAICS2027")
    with pytest.raises(ValueError):
        survey.sector_field(2021)
