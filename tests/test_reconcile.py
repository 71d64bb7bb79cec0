"""Payload parsing, unit scaling, tolerances and suppression."""

from regionledger.plans import payroll, reconcile
from regionledger.sources import readers

PAYLOAD = (
    '[["NAICS2022","NAME","FIRMPDEMP","EMP","PAYANN","RCPPDEMP","state","county","NAICS2022"],'
    '["42","Sample County","10","100","200","300","06","075","42"]]'
)
FIELDS = ["NAICS2022", "FIRMPDEMP", "EMP", "PAYANN", "RCPPDEMP", "state", "county"]
RAW = (
    "area_fips,own_code,industry_code,agglvl_code,year,qtr,annual_avg_emplvl,total_annual_wages,annual_avg_wkly_wage\n"
    "06075,5,42,74,2022,A,100,5200000,1000\n06085,5,62,74,2022,A,D,D,D\n06085,1,62,74,2022,A,5,5,5\n"
)


def payload_rows(spark, text):
    return readers.header_rows(spark.createDataFrame([(2022, text)], "year_num int, value string"), "value", FIELDS, ("year_num",))


def test_payload_scaled_to_dollars(spark):
    row = reconcile.survey_source(payload_rows(spark, PAYLOAD)).first()
    assert (row["state_cnty_fips_cd"], row["naics2_sector_cd"]) == ("06075", "42")
    assert (row["source_census_payann_usd"], row["source_census_rcppdemp_usd"], row["notes"]) == (200000.0, 300000.0, "")


def test_payload_empty_and_broken(spark):
    assert payload_rows(spark, '[["EMP"]]').first()["note"] == "payload_empty"
    assert payload_rows(spark, "not json").first()["note"] == "payload_unreadable"


def test_survey_tolerance(spark):
    source = reconcile.survey_source(payload_rows(spark, PAYLOAD))
    stored = spark.createDataFrame(
        [(2022, "06075", "42", 10, 100, 200500.0, 302500.0)],
        "year_num int, state_cnty_fips_cd string, naics2_sector_cd string, stored_abs_firms long, stored_abs_emp long,"
        "stored_abs_payroll_usd_amt double, stored_abs_rcpt_usd_amt double",
    )
    row = reconcile.survey(source, stored).first()
    assert (row["pass_firms"], row["pass_emp"], row["pass_payroll"], row["pass_receipts"], row["pass_all"]) == (
        True, True, True, False, False,
    )


def stored_payroll(spark, rows):
    return spark.createDataFrame(
        rows, "year_num int, state_cnty_fips_cd string, naics2_sector_cd string, stored_qcew_emp double,"
        "stored_qcew_wages_usd double, stored_qcew_avg_weekly_wage_usd double",
    )


def read_raw(spark, tmp_path):
    path = tmp_path / "2022.annual.singlefile.csv"
    path.write_text(RAW)
    return readers.csv_per_year(spark, str(tmp_path / "{year}.annual.singlefile.csv"), [2022])


def test_payroll_source_slice(spark, tmp_path):
    got = reconcile.payroll_source(read_raw(spark, tmp_path), [2022], ["06075", "06085"], ["42", "62"])
    assert sorted(r["state_cnty_fips_cd"] for r in got.collect()) == ["06075", "06085"]


def test_payroll_suppression_and_tolerance(spark, tmp_path):
    source = reconcile.payroll_source(read_raw(spark, tmp_path))
    stored = stored_payroll(spark, [
        (2022, "06075", "42", 100.0, 5200000.0, 1001.0), (2022, "06085", "62", 100.0, 5200000.0, 1000.0),
        (2022, "06001", "42", 1.0, 52.0, None),
    ])
    rows = {r["state_cnty_fips_cd"]: r for r in reconcile.payroll(source, stored).collect()}
    assert rows["06075"]["pass_avg_weekly_wage"] is True and rows["06075"]["pass_all"] is True
    assert rows["06085"]["notes"] == "source_suppressed;missing_from_source" and rows["06085"]["pass_all"] is None
    # A row only in the stored data has no note to read; the weekly wage falls back to wages.
    assert rows["06001"]["notes"] == "missing_from_source"
    assert rows["06001"]["stored_qcew_avg_weekly_wage_usd"] == 1.0


def test_payroll_strict_weekly_wage(spark, tmp_path):
    source = reconcile.payroll_source(read_raw(spark, tmp_path))
    stored = stored_payroll(spark, [(2022, "06075", "42", 100.0, 5200000.0, 1001.0)])
    rows = {r["state_cnty_fips_cd"]: r for r in reconcile.payroll(source, stored, allow_wage_tolerance=False).collect()}
    assert rows["06075"]["pass_avg_weekly_wage"] is False
    assert rows["06085"]["notes"] == "source_suppressed;missing_from_both"


def test_private_payroll_from_file(spark, tmp_path):
    rows = {r["state_cnty_fips_cd"]: r for r in payroll.private_sectors(read_raw(spark, tmp_path), [2022]).collect()}
    assert rows["06075"]["qcew_avg_wkly_wage_usd_amt"] == 1000.0
    # A withheld cell sums to zero there, and zero employment has no weekly wage.
    assert rows["06085"]["qcew_ann_avg_emp_lvl_num"] == 0 and rows["06085"]["qcew_avg_wkly_wage_usd_amt"] is None


def test_combined_reports(spark, tmp_path):
    source = reconcile.payroll_source(read_raw(spark, tmp_path))
    left = reconcile.payroll(source, stored_payroll(spark, [(2022, "06075", "42", 100.0, 5200000.0, 1001.0)]))
    survey = reconcile.survey(
        reconcile.survey_source(payload_rows(spark, PAYLOAD)),
        spark.createDataFrame([], "year_num int, state_cnty_fips_cd string, naics2_sector_cd string, stored_abs_firms long,"
                                  "stored_abs_emp long, stored_abs_payroll_usd_amt double, stored_abs_rcpt_usd_amt double"),
    )
    got = {r["source_system"]: r for r in reconcile.summary(reconcile.combined(survey, left)).collect()}
    assert (got["abs"]["passed_cnt"], got["abs"]["failed_cnt"]) == (0, 1)
    assert (got["qcew"]["passed_cnt"], got["qcew"]["failed_cnt"]) == (1, 0)
