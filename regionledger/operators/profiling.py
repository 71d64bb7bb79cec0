"""Column profiles.

One (field, value) count table feeds top values, examples and allowed-value checks:
the input is read once for all columns and combined before the shuffle. Counts and
distincts do without the values. Quantiles and moments of numeric columns take their
own pass.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from regionledger.functions import exprs
from regionledger.operators import aggregates, sets
from regionledger.sources.literals import literal

# Definitions of well-known source columns.
PAYROLL_DEFINITIONS = {
    "area_fips": "Five-digit FIPS code identifying the geographic area (state/county).",
    "own_code": "Ownership code: 0=Total, 1=Private, 2=Federal, 3=State, 5=Local, 8=All Government.",
    "industry_code": "NAICS-based industry classification code (2–6 digits).",
    "agglvl_code": "Aggregation level code (geography/industry grouping).",
    "size_code": "Establishment size class code (0=All sizes).",
    "year": "Calendar year of data.",
    "qtr": "Quarter; 'A' indicates annual summary.",
    "disclosure_code": "Confidentiality flag: blank=published; 'N'=suppressed.",
    "annual_avg_estabs": "Annual average number of establishments (quarterly average).",
    "annual_avg_emplvl": "Annual average monthly employment level (12-month average).",
    "total_annual_wages": "Total wages paid (sum over four quarters), USD.",
    "taxable_annual_wages": "Wages subject to state unemployment insurance taxes, USD.",
    "annual_contributions": "Employer contributions to unemployment insurance, USD.",
    "annual_avg_wkly_wage": "Average weekly wage = total wages / avg employment / 52, USD.",
    "avg_annual_pay": "Average annual pay per employee, USD.",
}
SURVEY_DEFINITIONS = {
    "NAME": "Geographic area name (e.g., county or state).",
    "GEO_ID": "Census geographic identifier (e.g., 0500000USssccc for counties).",
    "STATE": "State postal or FIPS code (context-dependent).",
    "state": "State FIPS code (2-digit).",
    "county": "County FIPS code (3-digit).",
    "NAICS2022": "2022 NAICS industry code (2–6 digits).",
    "NAICS2022_LABEL": "Industry title for NAICS2022 code.",
    "INDLEVEL": "Industry aggregation level indicator (e.g., 2-digit sector).",
    "FIRMPDEMP": "Count of firms with paid employees.",
    "EMP": "Number of paid employees.",
    "PAYANN": "Annual payroll (USD).",
    "RCPPDEMP": "Receipts or revenue per paid employees (context-specific ABS metric).",
}
# Name patterns tried in order where no preset matches.
NAME_PATTERNS = [
    ("naics", "NAICS industry classification code."),
    ("fips", "FIPS geographic code."),
    ("^geo[_-]?id$", "Geographic identifier code (agency-specific format)."),
    ("^name$", "Human-readable name for the record (e.g., geography)."),
    ("^year$", "Calendar year."),
    ("^qtr$|^quarter$", "Quarter of year; 'A' indicates annual summary in some series."),
    ("wage", "Wage or payroll amount (units likely USD)."),
    ("empl", "Employment count (number of employees)."),
    ("estab", "Establishment count (number of establishments)."),
]


def numeric_fields(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def dataset_summary(df: DataFrame) -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("row_cnt"), F.lit(len(df.columns)).cast("long").alias("col_cnt")
    )


def field_values(df: DataFrame) -> DataFrame:
    """``(name, value, freq)`` for every column at once; null values are one group."""
    as_text = df.select([F.col(c).cast("string").alias(c) for c in df.columns])
    return (
        as_text.unpivot([], df.columns, "name", "value")
        .groupBy("name", "value")
        .agg(F.count(F.lit(1)).alias("freq"))
    )


def field_counts(df: DataFrame, enum_threshold: int = 60, approximate: bool = False) -> DataFrame:
    """Count, missing, missing %, distinct and the low-cardinality flag per column.

    Counts are one aggregate without a shuffle of values. Exact distincts are counted over a
    128-bit digest of each value, so that no text crosses the network; ``approximate`` sketches
    them in the same pass as the counts.
    """
    if approximate:
        counts = approximate_counts(df)
    else:
        digests = F.array(*[
            F.struct(F.lit(c).alias("name"), F.when(F.col(c).isNotNull(), F.xxhash64(F.col(c).cast("string"))).alias("h1"),
                     F.xxhash64(F.lit(1), F.col(c).cast("string")).alias("h2"))
            for c in df.columns
        ])
        distinct = (
            df.select(F.inline(digests)).where("h1 IS NOT NULL").groupBy("name", "h1", "h2").agg(F.lit(1).alias("one"))
            .groupBy("name").agg(F.count("one").alias("distinct_cnt"))
        )
        counts = approximate_counts(df, distincts=False).join(distinct, "name", "left").withColumn(
            "distinct_cnt", F.coalesce("distinct_cnt", F.lit(0))
        )
    share = F.try_divide(F.col("missing_cnt") * F.lit(100.0), F.col("row_cnt"))
    return counts.select(
        "name", "row_cnt", "missing_cnt", exprs.half_even(share, 3).alias("missing_pct"), "distinct_cnt",
        (F.col("distinct_cnt") <= enum_threshold).alias("is_enum_candidate"),
    )


def approximate_counts(df: DataFrame, distincts: bool = True) -> DataFrame:
    """Rows, missing and (sketched) distincts per column in one pass."""
    kinds = ["n", "m", "d"] if distincts else ["n", "m"]
    titles = {"n": "row_cnt", "m": "missing_cnt", "d": "distinct_cnt"}
    rows = F.array(
        *[
            F.struct(F.lit(c).alias("name"), *[F.col(f"{k}{i}").alias(titles[k]) for k in kinds])
            for i, c in enumerate(df.columns)
        ]
    )
    aggs = []
    for i, c in enumerate(df.columns):
        aggs += [
            F.count(F.lit(1)).alias(f"n{i}"),
            F.count_if(F.col(c).isNull()).alias(f"m{i}"),
            *([F.approx_count_distinct(c).alias(f"d{i}")] if distincts else []),
        ]
    return df.agg(*aggs).select(F.inline(rows))


def top_values(values: DataFrame, k: int = 10) -> DataFrame:
    """k most frequent values per column with their share of non-null rows."""
    present = values.where(F.col("value").isNotNull())
    totals = present.groupBy("name").agg(F.sum("freq").alias("total"))
    order = Window.partitionBy("name").orderBy(F.desc("freq"), "value")
    return (
        present.withColumn("rank_num", F.row_number().over(order))
        .where(F.col("rank_num") <= k)
        .join(totals, "name")
        .select(
            "name", "rank_num", "value", "freq",
            F.try_divide(F.col("freq") * F.lit(100.0), F.col("total")).alias("pct"),
        )
    )


def examples(values: DataFrame, k: int = 10) -> DataFrame:
    """First k values per column in value order (k rows per column, never a whole set)."""
    order = Window.partitionBy("name").orderBy("value")
    return (
        values.where(F.col("value").isNotNull())
        .withColumn("pos", F.row_number().over(order))
        .where(F.col("pos") <= k)
        .groupBy("name")
        .agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "value"))), lambda s: s["value"]).alias("examples"))
    )


def text_lengths(df: DataFrame, columns: list[str]) -> DataFrame:
    rows = F.array(
        *[
            F.struct(
                F.lit(c).alias("name"), F.coalesce(F.col(f"x{i}"), F.lit(0)).alias("max_len"),
                F.coalesce(F.col(f"a{i}"), F.lit(0.0)).alias("avg_len"),
            )
            for i, c in enumerate(columns)
        ]
    )
    aggs = []
    for i, c in enumerate(columns):
        aggs += [F.max(F.length(c)).alias(f"x{i}"), F.avg(F.length(c)).alias(f"a{i}")]
    return df.agg(*aggs).select(F.inline(rows))


def numeric_long(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.select([F.col(c).cast("double").alias(c) for c in columns]).unpivot(
        [], columns, "name", "value"
    )


def numeric_stats(df: DataFrame, columns: list[str], probs: tuple[float, ...] = (0.05, 0.5, 0.95)) -> DataFrame:
    """Min, exact quantiles, max, mean and sample deviation per numeric column."""
    long = numeric_long(df, columns)
    simple = long.groupBy("name").agg(
        F.min("value").alias("min"), F.max("value").alias("max"),
        F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"),
    )
    q = aggregates.exact_quantiles(long, "name", "value", list(probs))
    named = [F.col("quantiles")[i].alias(f"p{round(p * 100)}") for i, p in enumerate(probs)]
    return simple.join(q.select("name", *named), "name", "left").select(
        "name", "min", *[f"p{round(p * 100)}" for p in probs], "max", "mean", "std"
    )


def validate_bounds(df: DataFrame, bounds: dict[str, tuple[float | None, float | None]]) -> DataFrame:
    rules = []
    for c, (lo, hi) in bounds.items():
        if lo is not None:
            rules.append((c, "min", F.count_if(F.col(c) < lo)))
        if hi is not None:
            rules.append((c, "max", F.count_if(F.col(c) > hi)))
    agg = df.agg(*[r[2].alias(f"f{i}") for i, r in enumerate(rules)])
    rows = [
        F.struct(
            F.lit(c).alias("name"), F.lit(rule).alias("rule"),
            (F.col(f"f{i}") == 0).alias("passed"), F.col(f"f{i}").alias("failed_rows"),
        )
        for i, (c, rule, _) in enumerate(rules)
    ]
    return agg.select(F.inline(F.array(*rows)))


def unexpected_values(values: DataFrame, name: str, allowed: list[str], limit: int = 50) -> DataFrame:
    """Values of one column outside its allowed list (a listing of at most ``limit``)."""
    return (
        values.where((F.col("name") == name) & F.col("value").isNotNull())
        .where(~F.col("value").isin(allowed))
        .select("name", "value", "freq")
        .orderBy(F.desc("freq"), "value")
        .limit(limit)
    )


def names_of(df: DataFrame) -> DataFrame:
    """The column names, from the schema alone."""
    return literal(df.sparkSession, [(c,) for c in df.columns], "name string")


def definitions(spark: SparkSession, names: DataFrame, source: str = "", given: dict[str, str] | None = None) -> DataFrame:
    """Best definition per column name: as given, source preset, any preset, then name pattern.

    A description that came with the request wins and has no confidence of its own.
    """
    source = source.lower()
    ranked = [(n, d, None, "given", 0) for n, d in (given or {}).items() if d]
    if "qcew" in source:
        ranked += [(n, d, 0.98, "preset:qcew", 1) for n, d in PAYROLL_DEFINITIONS.items()]
    if "census" in source or "abs" in source:
        ranked += [(n, d, 0.95, "preset:abs", 2) for n, d in SURVEY_DEFINITIONS.items()]
    ranked += [(n, d, 0.9, "preset:qcew", 3) for n, d in PAYROLL_DEFINITIONS.items()]
    ranked += [(n, d, 0.9, "preset:abs", 4) for n, d in SURVEY_DEFINITIONS.items()]
    preset = literal(spark, ranked, "name string, definition string, confidence double, origin string, p int")
    best = aggregates.keep_one(preset, ["name"], [F.col("p")]).drop("p")
    guess = F.lit(None).cast("string")
    for pattern, text in reversed(NAME_PATTERNS):
        guess = F.when(F.lower("name").rlike(pattern), F.lit(text)).otherwise(guess)
    found = names.join(best, "name", "left").withColumn("guess", guess)
    hit = F.col("definition").isNotNull()
    return found.select(
        "name",
        F.coalesce("definition", "guess").alias("definition"),
        F.when(hit, F.col("confidence")).when(F.col("guess").isNotNull(), F.lit(0.6)).otherwise(0.0).alias("confidence"),
        F.when(hit, F.col("origin")).when(F.col("guess").isNotNull(), F.lit("heuristic:regex")).otherwise("none").alias("origin"),
    )


def types_table(df: DataFrame, declared: dict[str, str]) -> DataFrame:
    """Declared against observed type, one row per column of the schema."""
    rows = [(f.name, declared.get(f.name), f.dataType.simpleString()) for f in df.schema.fields]
    t = literal(df.sparkSession, rows, "name string, declared_type string, observed_type string")
    return t.withColumn("type_match", F.contains("observed_type", F.lower("declared_type")))


def validate(df: DataFrame, fields: dict[str, dict]) -> DataFrame:
    """The constraints of given fields (min, max, allowed_values) as pass rows.

    A field with other than its allowed values gives a row for each such value, at most 50.
    """
    bounds = {c: (f.get("min"), f.get("max")) for c, f in fields.items() if c in df.columns and (f.get("min") is not None or f.get("max") is not None)}
    rows = [validate_bounds(df, bounds)] if bounds else []
    listed = {c: f["allowed_values"] for c, f in fields.items() if c in df.columns and f.get("allowed_values") is not None}
    if listed:
        values = field_values(df.select(*listed))
        for c, allowed in listed.items():
            rows.append(unexpected_values(values, c, allowed).select(
                "name", F.concat(F.lit("allowed: "), "value").alias("rule"), F.lit(False).alias("passed"), F.col("freq").alias("failed_rows")
            ))
    return sets.stack(rows) if rows else literal(df.sparkSession, [], "name string, rule string, passed boolean, failed_rows bigint")


def flat_profile(
    df: DataFrame, declared: dict[str, str] | None = None, source: str = "", given: dict[str, str] | None = None
) -> DataFrame:
    """One row per column: definition, types, counts, spread, three examples, note."""
    spark = df.sparkSession
    values = field_values(df)
    out = types_table(df, declared or {}).join(field_counts(df), "name", "left")
    out = out.join(definitions(spark, names_of(df), source, given), "name", "left")
    out = out.join(examples(values, 3), "name", "left")
    numeric = numeric_fields(df)
    if numeric:
        out = out.join(numeric_stats(df, numeric).select("name", "min", "p50", "max"), "name", "left")
    note = F.when(F.col("is_enum_candidate"), "Enum candidate (low cardinality)").otherwise("")
    return out.select(
        "name", "definition", "origin", "confidence", "declared_type", "observed_type",
        "distinct_cnt", "missing_pct",
        *(["min", "p50", "max"] if numeric else []),
        F.array_join("examples", ", ").alias("examples"), note.alias("notes"),
    )
