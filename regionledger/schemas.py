"""Canonical schemas and fixed code lists."""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(38, 9)

# The 20 canonical two-digit sectors.
SECTORS = [
    "11", "21", "22", "23", "31-33", "42", "44-45", "48-49", "51", "52",
    "53", "54", "55", "56", "61", "62", "71", "72", "81", "92",
]
# Two-digit prefixes published under a range label.
SECTOR_RANGES = {
    "31": "31-33", "32": "31-33", "33": "31-33",
    "44": "44-45", "45": "44-45",
    "48": "48-49", "49": "48-49",
}
ALL_SECTORS = "00"
UNCLASSIFIED = "99"
STATEWIDE_SUFFIX = "000"
UNSPECIFIED_SUFFIX = "999"

# Text that stands for a withheld cell (the empty string too).
SUPPRESSION_TOKENS = ["", "D", "N", "S", "NA", "N/A", "(D)", "(N)", "(S)"]
GDP_SUPPRESSION_TOKENS = ["(D)", "(NA)"]

# GDP group codes and the sector they stand for.
GDP_GROUP_SECTORS = {"31G": "31", "44RT": "44", "48TW": "48", "G": "92"}

# Words removed from county names, in the order they are tried.
COUNTY_SUFFIX_TERMS = [
    "county", "parish", "borough", "boro", "municipio", "municipality",
    "census area", "census are", "censu", "census district",
    "city and borough", "city", "island",
]
LEGACY_COUNTY_TERMS = [
    "county", "parish", "borough", "municipio", "census area",
    "city and borough", "city",
]
TERRITORIES_WITHOUT_COUNTIES = ["PR", "VI"]

# State code, postal code, name.
STATES = [
    ("01", "AL", "Alabama"), ("02", "AK", "Alaska"), ("04", "AZ", "Arizona"),
    ("05", "AR", "Arkansas"), ("06", "CA", "California"), ("08", "CO", "Colorado"),
    ("09", "CT", "Connecticut"), ("10", "DE", "Delaware"),
    ("11", "DC", "District of Columbia"), ("12", "FL", "Florida"),
    ("13", "GA", "Georgia"), ("15", "HI", "Hawaii"), ("16", "ID", "Idaho"),
    ("17", "IL", "Illinois"), ("18", "IN", "Indiana"), ("19", "IA", "Iowa"),
    ("20", "KS", "Kansas"), ("21", "KY", "Kentucky"), ("22", "LA", "Louisiana"),
    ("23", "ME", "Maine"), ("24", "MD", "Maryland"), ("25", "MA", "Massachusetts"),
    ("26", "MI", "Michigan"), ("27", "MN", "Minnesota"), ("28", "MS", "Mississippi"),
    ("29", "MO", "Missouri"), ("30", "MT", "Montana"), ("31", "NE", "Nebraska"),
    ("32", "NV", "Nevada"), ("33", "NH", "New Hampshire"), ("34", "NJ", "New Jersey"),
    ("35", "NM", "New Mexico"), ("36", "NY", "New York"),
    ("37", "NC", "North Carolina"), ("38", "ND", "North Dakota"), ("39", "OH", "Ohio"),
    ("40", "OK", "Oklahoma"), ("41", "OR", "Oregon"), ("42", "PA", "Pennsylvania"),
    ("44", "RI", "Rhode Island"), ("45", "SC", "South Carolina"),
    ("46", "SD", "South Dakota"), ("47", "TN", "Tennessee"), ("48", "TX", "Texas"),
    ("49", "UT", "Utah"), ("50", "VT", "Vermont"), ("51", "VA", "Virginia"),
    ("53", "WA", "Washington"), ("54", "WV", "West Virginia"),
    ("55", "WI", "Wisconsin"), ("56", "WY", "Wyoming"), ("72", "PR", "Puerto Rico"),
    ("78", "VI", "U.S. Virgin Islands"),
]

# Counties the yearly county file no longer lists.
COUNTY_SUPPLEMENTS = [
    ("09001", "CT", "Fairfield County"), ("09003", "CT", "Hartford County"),
    ("09005", "CT", "Litchfield County"), ("09007", "CT", "Middlesex County"),
    ("09009", "CT", "New Haven County"), ("09011", "CT", "New London County"),
    ("09013", "CT", "Tolland County"), ("09015", "CT", "Windham County"),
    ("78010", "VI", "St. Croix Island"), ("78020", "VI", "St. John Island"),
    ("78030", "VI", "St. Thomas Island"),
]

# Name-to-code pairs that win over the county reference.
COUNTY_NAME_OVERRIDES = [
    ("CT", "fairfield", "09001"), ("CT", "hartford", "09003"),
    ("CT", "litchfield", "09005"), ("CT", "middlesex", "09007"),
    ("CT", "newhaven", "09009"), ("CT", "newlondon", "09011"),
    ("CT", "tolland", "09013"), ("CT", "windham", "09015"),
    ("AK", "valdezcordova", "02261"),
]

# The two synthetic sector reference rows.
SECTOR_EXTRAS = [
    ("00", "Total for all sectors"),
    ("99", "Unclassified (suppression bucket)"),
]

SURVEY = T.StructType([
    T.StructField("year_num", T.IntegerType()),
    T.StructField("state_cnty_fips_cd", T.StringType()),
    T.StructField("naics2_sector_cd", T.StringType()),
    T.StructField("cnty_nm", T.StringType()),
    T.StructField("geo_id", T.StringType()),
    T.StructField("naics2_sector_desc", T.StringType()),
    T.StructField("ind_level_num", T.LongType()),
    T.StructField("abs_firm_num", T.LongType()),
    T.StructField("abs_emp_num", T.LongType()),
    T.StructField("abs_payroll_usd_amt", MONEY),
    T.StructField("abs_rcpt_usd_amt", MONEY),
    T.StructField("abs_rcpt_per_emp_usd_amt", MONEY),
    T.StructField("abs_rcpt_per_firm_usd_amt", MONEY),
])

PAYROLL = T.StructType([
    T.StructField("year_num", T.IntegerType()),
    T.StructField("naics2_sector_cd", T.StringType()),
    T.StructField("state_cnty_fips_cd", T.StringType()),
    T.StructField("state_fips_cd", T.StringType()),
    T.StructField("cnty_fips_cd", T.StringType()),
    T.StructField("own_cd", T.StringType()),
    T.StructField("qcew_ann_avg_emp_lvl_num", T.LongType()),
    T.StructField("qcew_ttl_ann_wage_usd_amt", MONEY),
    T.StructField("qcew_avg_wkly_wage_usd_amt", MONEY),
])

COUNTY_REF = T.StructType([
    T.StructField("state_cnty_fips_cd", T.StringType()),
    T.StructField("state_cd", T.StringType()),
    T.StructField("cnty_ansi_nm", T.StringType()),
    T.StructField("cnty_nm", T.StringType()),
    T.StructField("land_area_num", T.LongType()),
    T.StructField("water_area_num", T.LongType()),
    T.StructField("lat_num", T.DoubleType()),
    T.StructField("long_num", T.DoubleType()),
    T.StructField("population_num", T.LongType()),
    T.StructField("population_year", T.LongType()),
])

SECTOR_REF = T.StructType([
    T.StructField("naics2_sector_cd", T.StringType()),
    T.StructField("naics2_sector_desc", T.StringType()),
])

FACT_KEY = ["year_num", "state_cnty_fips_cd", "naics2_sector_cd"]
