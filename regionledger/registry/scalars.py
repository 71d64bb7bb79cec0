"""Queries of the scalar expressions."""

from __future__ import annotations

from pyspark.sql import functions as F

from regionledger import schemas as S
from regionledger.functions import codes, exprs
from regionledger.registry import tables as t
from regionledger.registry.core import query
from regionledger.registry.ctes import NUMBER, SECTOR_LIST, number, sector_case, zfill

C = F.col


def text(c: str):
    return C(c).cast("string")


def choose(values: list[str], position):
    return F.element_at(F.array(*[F.lit(v) for v in values]), position)


def sql_list(values: list[str]) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


@query(
    "sc1_zfill",
    f"SELECT c_custkey, {zfill('CAST(c_custkey AS VARCHAR)', 5)} AS code5, {zfill('c_name', 5)} AS long_kept FROM customer",
)
def _sc1(spark, d):
    return t.read(spark, d, "customer").select(
        "c_custkey", codes.zfill(text("c_custkey"), 5).alias("code5"), codes.zfill(C("c_name"), 5).alias("long_kept")
    )


@query(
    "sc2_zfill_first_digits",
    f"""SELECT p_partkey, {zfill("regexp_extract(p_brand, '([0-9]+)', 1)", 3)} AS brand_code,
        {zfill("regexp_extract(p_name, '([0-9]+)', 1)", 2)} AS no_digits FROM part""",
)
def _sc2(spark, d):
    return t.read(spark, d, "part").select(
        "p_partkey", codes.zfill_digits(C("p_brand"), 3).alias("brand_code"),
        codes.zfill_digits(C("p_name"), 2).alias("no_digits"),
    )


@query("sc3_digits_only", "SELECT c_custkey, regexp_replace(c_name, '[^0-9]', '', 'g') AS digits FROM customer")
def _sc3(spark, d):
    return t.read(spark, d, "customer").select("c_custkey", codes.digits_only(C("c_name")).alias("digits"))


_BASE2 = "substr(regexp_replace({}, '[^0-9]', '', 'g'), 1, 2)"


def _canon(x: str) -> str:
    label = sector_case(_BASE2.format(x))
    return f"CASE WHEN {label} IN {SECTOR_LIST} THEN {label} END"


@query(
    "sc4_sector_canoniser",
    f"""SELECT p_partkey, {_canon('a')} AS sector, CASE WHEN regexp_matches(trim(b), '^[0-9]') THEN {_canon('b')} END AS strict_tail,
        CASE WHEN regexp_matches(trim(a), '^[0-9]') THEN {_canon('a')} END AS strict_head
        FROM (SELECT p_partkey, p_brand || CAST(p_size AS VARCHAR) AS a, CAST(p_size AS VARCHAR) || p_brand AS b FROM part)""",
)
def _sc4(spark, d):
    p = t.read(spark, d, "part").select(
        "p_partkey", F.concat("p_brand", text("p_size")).alias("a"), F.concat(text("p_size"), "p_brand").alias("b")
    )
    return p.select(
        "p_partkey", codes.sector_from_code(C("a")).alias("sector"),
        codes.sector_from_code_strict(C("b")).alias("strict_tail"),
        codes.sector_from_code_strict(C("a")).alias("strict_head"),
    )


@query(
    "sc5_sector_for_checks",
    f"""SELECT p_partkey, CASE WHEN k2 IN ('31','32','33','44','45','48','49') THEN {sector_case('k2')}
        WHEN length({_BASE2.format('a')}) = 2 THEN {_BASE2.format('a')} END AS sector
        FROM (SELECT p_partkey, a, substr(regexp_replace(a, '[^0-9-]', '', 'g'), 1, 2) AS k2 FROM
          (SELECT p_partkey, CAST(p_size AS VARCHAR) || '-' || p_brand AS a FROM part))""",
)
def _sc5(spark, d):
    a = F.concat(text("p_size"), F.lit("-"), "p_brand")
    return t.read(spark, d, "part").select("p_partkey", codes.sector_for_checks(a).alias("sector"))


@query(
    "sc6_industry3_total",
    """SELECT p_partkey, CASE WHEN regexp_matches(x, '^0+$') OR substr(x,1,3) IN ('000','00') THEN '000' ELSE substr(x,1,3) END AS industry
       FROM (SELECT p_partkey, CASE WHEN p_partkey % 7 = 0 THEN '00' ELSE CAST(p_partkey * 10 AS VARCHAR) END AS x FROM part)""",
)
def _sc6(spark, d):
    x = F.when(C("p_partkey") % 7 == 0, "00").otherwise((C("p_partkey") * 10).cast("string"))
    return t.read(spark, d, "part").select("p_partkey", codes.industry3(x).alias("industry"))


_GROUPS = ["31G", "44RT", "48TW", "G", " 23 ", "XX"]


@query(
    "sc7_gdp_group_sector",
    f"""SELECT p_partkey, CASE WHEN regexp_matches(trim(x), '^[0-9]{{2}}$') THEN trim(x)
          ELSE CASE trim(x) WHEN '31G' THEN '31' WHEN '44RT' THEN '44' WHEN '48TW' THEN '48' WHEN 'G' THEN '92' END END AS sector
        FROM (SELECT p_partkey, {sql_list(_GROUPS)}[CAST(p_size % 6 + 1 AS INTEGER)] AS x FROM part)""",
)
def _sc7(spark, d):
    x = choose(_GROUPS, C("p_size") % 6 + 1)
    return t.read(spark, d, "part").select("p_partkey", codes.gdp_group_sector(x).alias("sector"))


_TAILS = ["COUNTY", "Parish", "Census  Area", "City and Borough", "St. Clair", "Boro", "Island City", "Municipality"]


def name_key_sql(x: str) -> str:
    out = f"regexp_replace(lower(COALESCE({x}, '')), '[^a-z0-9\\s]', ' ', 'g')"
    for term in S.COUNTY_SUFFIX_TERMS:
        pattern = "\\b" + term.replace(" ", "\\s+") + "\\b"
        out = f"regexp_replace({out}, '{pattern}', ' ', 'g')"
    out = f"regexp_replace({out}, '\\bst\\b', 'saint', 'g')"
    return f"regexp_replace({out}, '\\s+', '', 'g')"


_LEGACY = "|".join(S.LEGACY_COUNTY_TERMS)


@query(
    "sc8_county_name_key",
    f"""SELECT s_suppkey, {name_key_sql('x')} AS name_key,
        trim(regexp_replace(regexp_replace(regexp_replace(trim(lower(x)), '[^a-z0-9\\s]', '', 'g'), '({_LEGACY})', '', 'g'), '\\s+', ' ', 'g')) AS old_key
        FROM (SELECT s_suppkey, n_name || ' ' || {sql_list(_TAILS)}[CAST(s_suppkey % 8 + 1 AS INTEGER)] AS x
          FROM supplier JOIN nation ON s_nationkey = n_nationkey)""",
)
def _sc8(spark, d):
    s = t.read(spark, d, "supplier").join(t.read(spark, d, "nation"), C("s_nationkey") == C("n_nationkey"))
    x = F.concat("n_name", F.lit(" "), choose(_TAILS, (C("s_suppkey") % 8 + 1).cast("int")))
    return s.select(
        "s_suppkey", codes.county_name_key(x).alias("name_key"), codes.county_name_key_simple(x).alias("old_key")
    )


@query(
    "sc9_trim_case_prefix",
    "SELECT c_custkey, lower(c_mktsegment) AS lo, upper(trim('  ' || c_name || ' ')) AS up, substr(upper(c_mktsegment), 1, 2) AS two FROM customer",
)
def _sc9(spark, d):
    return t.read(spark, d, "customer").select(
        "c_custkey", F.lower("c_mktsegment").alias("lo"),
        F.upper(F.trim(F.concat(F.lit("  "), "c_name", F.lit(" ")))).alias("up"),
        F.substring(F.upper("c_mktsegment"), 1, 2).alias("two"),
    )


@query(
    "sc10_concat_label",
    """SELECT c_custkey, state_cnty_fips_cd AS code, n_name || ', ' || CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE r_name END AS label
       FROM customer JOIN geo ON c_nationkey = n_nationkey""",
)
def _sc10(spark, d):
    g = t.read(spark, d, "customer").join(t.geography(spark, d), C("c_nationkey") == C("n_nationkey"))
    return g.select(
        "c_custkey", C("state_cnty_fips_cd").alias("code"),
        F.concat("n_name", F.lit(", "), F.when(C("c_custkey") % 3 != 0, C("r_name"))).alias("label"),
    )


@query(
    "sc11_coalesce_chain",
    """SELECT o_orderkey, COALESCE(CASE WHEN o_orderkey % 3 = 0 THEN o_orderpriority END,
       CASE WHEN o_orderkey % 2 = 0 THEN o_orderstatus END, CAST(o_custkey AS VARCHAR)) AS label FROM orders""",
)
def _sc11(spark, d):
    return t.read(spark, d, "orders").select(
        "o_orderkey",
        F.coalesce(
            F.when(C("o_orderkey") % 3 == 0, C("o_orderpriority")), F.when(C("o_orderkey") % 2 == 0, C("o_orderstatus")),
            text("o_custkey"),
        ).alias("label"),
    )


@query(
    "sc12_strip_quotes_commas",
    """SELECT o_orderkey, trim(replace('" ' || o_orderstatus || '"', '"', '')) AS bare,
       replace(CAST(o_orderkey AS VARCHAR) || ',000', ',', '') AS digits FROM orders""",
)
def _sc12(spark, d):
    return t.read(spark, d, "orders").select(
        "o_orderkey", codes.strip_quotes(F.concat(F.lit('" '), "o_orderstatus", F.lit('"'))).alias("bare"),
        codes.strip_thousands(F.concat(text("o_orderkey"), F.lit(",000"))).alias("digits"),
    )


@query(
    "sc13_clean_title_code",
    """SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN p_name ELSE regexp_replace(trim(p_name || ' T '), '\\s*T$', '') END AS title,
       regexp_replace(trim(CAST(p_size AS VARCHAR) || '.0'), '\\.0$', '') AS code FROM part""",
)
def _sc13(spark, d):
    title = F.when(C("p_size") % 2 == 0, C("p_name")).otherwise(F.concat("p_name", F.lit(" T ")))
    return t.read(spark, d, "part").select(
        "p_partkey", codes.clean_title(title).alias("title"),
        codes.clean_code(F.concat(text("p_size"), F.lit(".0"))).alias("code"),
    )


_TOKENS = ["12D", " 7.5 ", "abc", "1.5E+3", "-4", "(D)", "", "3e"]


def _token():
    return choose(_TOKENS, (C("event_id") % 8 + 1).cast("int"))


_TOKEN_SQL = f"{sql_list(_TOKENS)}[CAST(event_id % 8 + 1 AS INTEGER)]"


@query(
    "sc14_scientific_notation",
    f"SELECT event_id, regexp_matches({_TOKEN_SQL}, '[eE][+-]?[0-9]+') AS scientific FROM events",
)
def _sc14(spark, d):
    return t.read(spark, d, "events").select("event_id", exprs.is_scientific(_token()).alias("scientific"))


@query(
    "sc15_coercing_number",
    f"SELECT event_id, {number('x')} AS parsed FROM (SELECT event_id, {_TOKEN_SQL} AS x FROM events)", "parsed",
)
def _sc15(spark, d):
    return t.read(spark, d, "events").select("event_id", exprs.to_number(_token()).alias("parsed"))


@query(
    "sc16_published_cell",
    f"""SELECT event_id, CASE WHEN note IS NULL THEN v END AS value, note FROM (SELECT event_id, {number('trim(x)')} AS v,
          CASE WHEN x IS NULL THEN 'source_missing' WHEN trim(x) IN ('','D','N','S','NA','N/A','(D)','(N)','(S)') THEN 'source_suppressed'
          WHEN NOT regexp_matches(trim(x), {NUMBER}) THEN 'source_non_numeric' END AS note
        FROM (SELECT event_id, CASE WHEN event_id % 11 = 0 THEN NULL ELSE {_TOKEN_SQL} END AS x FROM events))""", "value",
)
def _sc16(spark, d):
    x = F.when(C("event_id") % 11 != 0, _token())
    return t.read(spark, d, "events").select("event_id", exprs.parse_published(x).alias("p")).select(
        "event_id", "p.value", "p.note"
    )


@query(
    "sc17_safe_ratio", "SELECT c_custkey, c_acctbal / NULLIF(c_custkey % 3, 0) AS ratio FROM customer", "ratio",
)
def _sc17(spark, d):
    return t.read(spark, d, "customer").select("c_custkey", exprs.safe_ratio(C("c_acctbal"), C("c_custkey") % 3).alias("ratio"))


@query(
    "sc18_positive_ratio", "SELECT c_custkey, CASE WHEN c_acctbal > 0 THEN c_custkey / c_acctbal END AS ratio FROM customer", "ratio",
)
def _sc18(spark, d):
    return t.read(spark, d, "customer").select(
        "c_custkey", exprs.positive_ratio(C("c_custkey").cast("double"), C("c_acctbal")).alias("ratio")
    )


@query("sc19_from_thousands", "SELECT p_partkey, CAST(p_retailprice AS DECIMAL(18,2)) * 1000 AS dollars FROM part", "dollars")
def _sc19(spark, d):
    return t.read(spark, d, "part").select("p_partkey", exprs.from_thousands(t.money("p_retailprice")).alias("dollars"))


@query(
    "sc20_rounding",
    "SELECT c_custkey, round_even(c_custkey / 8.0, 2) AS even2, round(c_custkey / 8.0, 2) AS up2, round_even(c_custkey / 16.0, 3) AS even3, round(c_custkey / 16.0, 3) AS up3 FROM customer",
    "even2", "up2", "even3", "up3",
)
def _sc20(spark, d):
    x, y = C("c_custkey") / 8.0, C("c_custkey") / 16.0
    return t.read(spark, d, "customer").select(
        "c_custkey", exprs.half_even(x, 2).alias("even2"), exprs.half_up(x, 2).alias("up2"),
        exprs.half_even(y, 3).alias("even3"), exprs.half_up(y, 3).alias("up3"),
    )


@query(
    "sc21_power_log_abs",
    "SELECT c_custkey, pow(c_acctbal / 1000, 2) AS squared, CASE WHEN c_acctbal > 0 THEN log10(c_acctbal) END AS log_amt, abs(c_acctbal) AS abs_amt FROM customer",
    "squared", "log_amt", "abs_amt",
)
def _sc21(spark, d):
    a = C("c_acctbal")
    return t.read(spark, d, "customer").select(
        "c_custkey", F.pow(a / 1000, F.lit(2.0)).alias("squared"), exprs.log10_positive(a).alias("log_amt"), F.abs(a).alias("abs_amt")
    )


@query(
    "sc22_infinity_to_null",
    "SELECT c_custkey, CASE WHEN c_custkey % 5 = 0 OR c_custkey % 7 = 0 THEN NULL ELSE c_acctbal END AS finite FROM customer", "finite",
)
def _sc22(spark, d):
    x = F.when(C("c_custkey") % 5 == 0, F.lit(float("inf"))).when(C("c_custkey") % 7 == 0, F.lit(float("nan"))).otherwise(C("c_acctbal"))
    return t.read(spark, d, "customer").select("c_custkey", exprs.finite_or_null(x).alias("finite"))


@query(
    "sc23_fill_zero", "SELECT c_custkey, COALESCE(CASE WHEN c_custkey % 2 = 0 THEN c_acctbal END, 0) AS filled FROM customer", "filled",
)
def _sc23(spark, d):
    return t.read(spark, d, "customer").select(
        "c_custkey", exprs.fill_zero(F.when(C("c_custkey") % 2 == 0, C("c_acctbal"))).alias("filled")
    )


@query("sc24_not_integral", "SELECT p_partkey, p_retailprice % 1 <> 0 AS fractional FROM part")
def _sc24(spark, d):
    return t.read(spark, d, "part").select("p_partkey", exprs.not_integral(C("p_retailprice")).alias("fractional"))


@query(
    "sc25_join_notes",
    """SELECT o_orderkey, array_to_string(list_sort(list_distinct(list_filter([CASE WHEN o_orderkey % 2 = 0 THEN o_orderstatus END,
       o_orderpriority, CASE WHEN o_orderkey % 3 = 0 THEN o_orderpriority ELSE '' END], lambda x: x IS NOT NULL AND x <> ''))), ';') AS notes FROM orders""",
)
def _sc25(spark, d):
    return t.read(spark, d, "orders").select(
        "o_orderkey",
        exprs.join_notes(
            F.when(C("o_orderkey") % 2 == 0, C("o_orderstatus")), C("o_orderpriority"),
            F.when(C("o_orderkey") % 3 == 0, C("o_orderpriority")).otherwise(""),
        ).alias("notes"),
    )


_SIDES = """SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE CAST(o_custkey AS DOUBLE) END AS a,
  CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE CAST(o_custkey + o_orderkey % 4 AS DOUBLE) END AS b FROM orders"""


def _sides(spark, d):
    return t.read(spark, d, "orders").select(
        "o_orderkey", F.when(C("o_orderkey") % 7 != 0, C("o_custkey").cast("double")).alias("a"),
        F.when(C("o_orderkey") % 11 != 0, (C("o_custkey") + C("o_orderkey") % 4).cast("double")).alias("b"),
    )


@query(
    "sc26_difference", f"SELECT o_orderkey, b - a AS delta, (b - a) / NULLIF(a, 0) AS relative FROM ({_SIDES})", "delta", "relative",
)
def _sc26(spark, d):
    delta = C("b") - C("a")
    return _sides(spark, d).select("o_orderkey", delta.alias("delta"), exprs.safe_ratio(delta, C("a")).alias("relative"))


@query(
    "sc27_two_valued_pass",
    f"SELECT o_orderkey, COALESCE(b - a = 0, false) AS exact, COALESCE(abs(b - a) <= 2, false) AS within FROM ({_SIDES})",
)
def _sc27(spark, d):
    delta = C("b") - C("a")
    return _sides(spark, d).select("o_orderkey", exprs.passes_exact(delta).alias("exact"), exprs.passes_within(delta, 2).alias("within"))


@query(
    "sc28_three_valued_pass", f"SELECT o_orderkey, b - a = 0 AS exact, abs(b - a) <= 2 AS within FROM ({_SIDES})",
)
def _sc28(spark, d):
    delta = C("b") - C("a")
    return _sides(spark, d).select(
        "o_orderkey", exprs.passes_exact_or_unknown(delta).alias("exact"), exprs.passes_within_or_unknown(delta, 2).alias("within")
    )
