"""File readers. Text stays text until a plan types it; nothing is inferred."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from regionledger.operators import columns
from regionledger.sources import scratch



def text_schema(names: list[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def csv_text(spark: SparkSession, path: str, sep: str = ",", encoding: str = "UTF-8") -> DataFrame:
    """CSV with a header, every column string (leading zeros survive)."""
    return (
        spark.read.option("header", True).option("inferSchema", False)
        .option("sep", sep).option("encoding", encoding).option("escape", '"').csv(path)
    )


def csv_latin1(spark: SparkSession, path: str) -> DataFrame:
    return csv_text(spark, path, encoding="ISO-8859-1")


def tsv_trimmed(spark: SparkSession, path: str) -> DataFrame:
    """Tab-separated file; header names trimmed, blanks kept as empty text."""
    df = csv_text(spark, path, sep="\t")
    return df.toDF(*[c.strip() for c in df.columns]).na.fill("")


def csv_headerless(spark: SparkSession, path: str, names: list[str]) -> DataFrame:
    return spark.read.schema(text_schema(names)).option("escape", '"').csv(path, header=False)


def csv_typed(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Typed load with one header row; a malformed row fails the load."""
    return (
        spark.read.schema(schema).option("header", True).option("escape", '"')
        .option("mode", "FAILFAST").csv(path)
    )


def csv_columns(spark: SparkSession, path: str, wanted: list[str]) -> DataFrame:
    """Only the wanted columns that exist, pruned at the scan."""
    df = csv_text(spark, path)
    return df.select([columns.quoted(c) for c in df.columns if c in set(wanted)])


def csv_first_found(spark: SparkSession, paths: list[str]) -> DataFrame:
    """CSV text from the first path that exists; none is an error."""
    for path in paths:
        try:
            return csv_text(spark, path)
        except AnalysisException as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
    raise FileNotFoundError(f"none of {paths} exists")


def csv_per_year(
    spark: SparkSession, template: str, years: list[int], single: str | None = None, fallback: str | None = None
) -> DataFrame:
    """One file per year from a ``{year}`` template, each tagged with its year.

    ``single`` replaces the template for a one-year run; ``fallback`` is a second
    template tried where the first has no file.
    """
    frames = []
    for y in years:
        first = single if single and len(years) == 1 else template.format(year=y)
        paths = [first] + ([fallback.format(year=y)] if fallback else [])
        frames.append(csv_first_found(spark, paths).withColumn("file_year", F.lit(y)))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def csv_after_preamble(
    spark: SparkSession, path: str, preamble_pattern: str, schema: T.StructType
) -> DataFrame:
    """CSV below free-text lines.

    Line numbers mean nothing across file splits, so the free text is told by its own
    pattern; every other line that is not blank is a data row, whatever it looks like.
    """
    lines = spark.read.text(path).where(~F.col("value").rlike(preamble_pattern) & (F.trim("value") != ""))
    parsed = F.from_csv("value", schema.simpleString()[len("struct<"):-1].replace(":", " "), {"escape": '"'})
    return lines.select(parsed.alias("r")).select("r.*")


# A record's state where a line begins: a new record, inside a quoted field, or inside an
# unquoted field whose line break was escaped.
_NEW, _QUOTED, _FIELD = 0, 1, 2
_SPECIAL = re.compile(r'["\t\\]')
#: Longest field the reference's csv reader accepts (its field size limit); a longer record spanning lines is rejected line by line.
FIELD_LIMIT = 131072


def _after(line: str, state: int) -> int:
    """State at the next line of a tab-separated csv reader (quote ", doubled quotes, escape \\).

    A quote opens a quoted field only at the start of a field; elsewhere it is a character.
    """
    st = {_NEW: "start", _QUOTED: "quoted", _FIELD: "field"}[state]
    pos, n = 0, len(line)
    while True:
        m = _SPECIAL.search(line, pos)
        if m is None:
            if pos < n and st in ("start", "closed"):
                st = "field"
            break
        if m.start() > pos and st in ("start", "closed"):
            st = "field"
        c, pos = m.group(), m.end()
        if st == "quoted":
            if c == '"':
                st = "closed"
            elif c == "\\":
                if pos == n:
                    return _QUOTED
                pos += 1
        elif st == "closed":
            st = "quoted" if c == '"' else "start" if c == "\t" else "field"
        elif c == "\t":
            st = "start"
        elif c == "\\":
            if pos == n:
                return _FIELD
            pos, st = pos + 1, "field"
        elif st == "start":
            st = "quoted"
    return _QUOTED if st == "quoted" else _NEW


def _line_maps(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Per line, in order within each split, for each state x at the split's start: the state
    at the line's start (p<x>), after it (a<x>), and the last line at or before it that
    starts a record (s<x>). A split's lines are consecutive in its task."""
    last, cur, starts = None, [0, 1, 2], [None, None, None]
    for batch in batches:
        out = {f"{k}{x}": [] for k in "psa" for x in range(3)}
        for r, split, value in zip(batch["_r"], batch["split"], batch["value"]):
            if split != last:
                cur, starts, last = [0, 1, 2], [None, None, None], split
            plain = '"' not in value and "\\" not in value
            for x in range(3):
                out[f"p{x}"].append(cur[x])
                if cur[x] == _NEW:
                    starts[x] = int(r)
                out[f"s{x}"].append(starts[x])
                cur[x] = (_QUOTED if cur[x] == _QUOTED else _NEW) if plain else _after(value, cur[x])
                out[f"a{x}"].append(cur[x])
        frame = batch.copy()
        for k, v in out.items():
            frame[k] = pd.Series(v, dtype="Int64")
        yield frame


_FIELD_RE = r'(?s)(?:^|\t)("(?:[^"\\]|\\.|"")*"(?:[^\t\\]|\\.)*|(?:[^\t"\\]|\\.)(?:[^\t\\]|\\.)*|)'


def _fields(record: Column) -> Column:
    """Fields of a record as a csv reader splits them: quoted fields keep tabs and line breaks."""
    return F.regexp_extract_all(record, F.lit(_FIELD_RE), 1)


def _cell(field: Column) -> Column:
    """A field's value: outer quotes off, doubled quotes and escapes resolved."""
    quoted = F.regexp_extract(field, r'(?s)^"((?:[^"\\]|\\.|"")*)"(.*)$', 1)
    rest = F.regexp_extract(field, r'(?s)^"(?:[^"\\]|\\.|"")*"(.*)$', 1)
    unescape = lambda c: F.regexp_replace(c, r'(?s)\\(.)', "$1")
    inner = F.regexp_replace(quoted, r'(?s)\\(.)|"(")', "$1$2")
    return F.when(field.startswith('"'), F.concat(inner, unescape(rest))).otherwise(unescape(field))


def ragged_tsv(spark: SparkSession, path: str, header_keyword: str) -> tuple[DataFrame, DataFrame]:
    """Tab-separated lines of uneven width: ``(rows, rejected lines)``.

    The header is the first line of a file that is not blank, and must hold
    ``header_keyword``; records equal to it are left out of the rows. A byte-order mark
    at a line's start and a trailing run stamp of the header are cut. Records are read as
    a csv reader reads them (tab, quote ", doubled quotes, escape \\): a quote opens a
    quoted field only at the start of a field, and a quoted field may hold tabs and line
    breaks. Short rows are padded, overflow is glued into the last field, blank records
    and count trailers are dropped.

    Files are read in splits. Each line gets the map from the state at its split's start
    to the state at its own start, built in order inside the split's task; one small row
    per split carries the split's whole map, and a scan over the splits of a file (in
    file order, inside one aggregate of those rows) gives each split its starting state.
    Only lines of records that span lines are grouped, by their record's first line.
    A record still inside a quoted field at the end of its file, and a record spanning
    lines that is longer than FIELD_LIMIT characters, go to the second frame line by
    line, so every line is in a row or a reject.
    """
    bare = F.regexp_replace("value", "^(\u00ef\u00bb\u00bf|\ufeff)+|\r$", "")
    lines = spark.read.text(path).select(
        F.monotonically_increasing_id().alias("_r"), bare.alias("value"),
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at"),
    ).withColumn("split", F.concat_ws("@", "file", F.col("at").cast("string")))
    # The first line of a file that is not blank is its header.
    first = lines.where((F.col("at") == 0) & (F.col("value") != "")).agg(F.min(F.struct("file", "_r", "value")).alias("h")).first()["h"]
    if first is None or header_keyword not in first["value"]:
        raise ValueError(f"no header line with {header_keyword!r} in {path}")
    header = first["value"]
    names = header.split("\t")
    if names[-1] == "" or names[-1].isdigit():
        names = names[:-1]
    width = len(names)

    mapped = scratch.materialise(lines.mapInPandas(
        _line_maps, "_r long, value string, file string, at long, split string" + "".join(f", {k}{x} long" for k in "psa" for x in range(3))
    ))
    # One row per split: its whole map, and its last record start for each starting state.
    ends = mapped.groupBy("file", "at").agg(F.max_by(F.struct(F.array("a0", "a1", "a2").alias("a"), F.array("s0", "s1", "s2").alias("s")), "_r").alias("e")).select("file", "at", "e.a", "e.s")
    # A file's splits are scanned in order inside one aggregate of those rows.
    walk = F.aggregate(
        F.array_sort(F.collect_list(F.struct("at", "a", "s"))),
        F.struct(F.lit(_NEW).cast("long").alias("state"), F.lit(None).cast("long").alias("open"), F.array().cast("array<struct<at:long,state:long,open:long>>").alias("out")),
        lambda acc, x: F.struct(
            F.element_at(x["a"], acc["state"].cast("int") + 1).alias("state"),
            F.coalesce(F.element_at(x["s"], acc["state"].cast("int") + 1), acc["open"]).alias("open"),
            F.array_append(acc["out"], F.struct(x["at"].alias("at"), acc["state"].alias("state"), acc["open"].alias("open"))).alias("out"),
        ),
    )
    files = ends.groupBy("file").agg(walk.alias("w")).select("file", F.col("w.state").alias("final"), F.col("w.open").alias("last"), F.explode("w.out").alias("o"))
    splits = files.select("file", F.col("o.at").alias("at"), F.col("o.state").alias("entry"), F.col("o.open").alias("carry"), "final", "last")
    few = splits.limit(100_001).count() <= 100_000
    placed = mapped.join(F.broadcast(splits) if few else splits, ["file", "at"])
    x = F.col("entry").cast("int") + 1
    state = F.element_at(F.array("p0", "p1", "p2"), x)
    after = F.element_at(F.array("a0", "a1", "a2"), x)
    record = F.coalesce(F.element_at(F.array("s0", "s1", "s2"), x), F.col("carry"))
    placed = placed.select(
        "_r", "value", record.alias("record"),
        # A line of a record that spans lines: it continues one, or the next line continues it.
        ((state != _NEW) | (after != _NEW)).alias("spans"),
        # Still inside a quoted field at the end of the file.
        ((F.col("final") == _QUOTED) & (record == F.col("last"))).alias("open"),
    )
    single = placed.where(~F.col("spans") & ~F.col("open")).select("value")
    multi = placed.where(F.col("spans") & ~F.col("open"))
    sizes = multi.groupBy("record").agg(F.sum(F.length("value") + 1).alias("_chars"))
    multi = multi.join(sizes, "record")
    joined = multi.where(F.col("_chars") <= FIELD_LIMIT).groupBy("record").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_r", "value"))), lambda v: v["value"]), "\n").alias("value")
    ).select("value")
    rejected = placed.where("open").select("value").unionByName(multi.where(F.col("_chars") > FIELD_LIMIT).select("value"))

    f = F.transform(_fields(F.col("value")), _cell)
    sized = (
        F.when(F.size("f") < width, F.concat("f", F.array_repeat(F.lit(""), F.lit(width) - F.size("f"))))
        .when(F.size("f") > width, F.concat(F.slice("f", 1, width - 1), F.array(F.array_join(F.slice("f", width, F.size("f")), "\t"))))
        .otherwise(F.col("f"))
    )
    records = single.unionByName(joined).where((F.col("value") != "") & (F.col("value") != header)).select(f.alias("f"))
    records = records.where(~F.lower(F.col("f")[0]).startswith("total output lines"))
    rows = records.select(sized.alias("g")).select(
        [F.col("g")[i].alias(n) for i, n in enumerate(names) if n and not n.startswith("Unnamed:")]
    )
    return rows, rejected


def json_header_rows(
    spark: SparkSession, path: str, wanted: list[str], keep: tuple[str, ...] = ()
) -> DataFrame:
    """Payload files ``[[header], [row], ...]``, one row out per payload row.

    Fields are taken by the first header position of their name, so a header that
    repeats a name is harmless. An empty or broken payload gives one row of nulls
    with a note. ``keep`` names path columns (year, state) to carry along.
    """
    return header_rows(spark.read.text(path, wholetext=True), "value", wanted, keep)


def header_rows(df: DataFrame, payload: str, wanted: list[str], keep: tuple[str, ...] = ()) -> DataFrame:
    parsed = df.select(*keep, F.from_json(payload, "array<array<string>>").alias("p"))
    note = F.when(F.col("p").isNull(), "payload_unreadable").when(F.size("p") < 2, "payload_empty")
    rows = parsed.select(
        *keep,
        note.alias("note"),
        F.get("p", F.lit(0)).alias("h"),
        F.explode_outer(F.when(F.size("p") >= 2, F.slice("p", 2, F.greatest(F.size("p") - 1, F.lit(0))))).alias("r"),
    )
    return rows.select(
        *keep,
        *[F.get("r", F.nullif(F.array_position("h", name), F.lit(0)) - 1).alias(name) for name in wanted],
        "note",
    )


def json_nested_results(spark: SparkSession, path: str) -> DataFrame:
    """Regional accounts payload files: ``BEAAPI.Results.Data[]`` as rows, names lower-cased."""
    schema = (
        "BEAAPI struct<Error: struct<APIErrorDescription: string>, Results: struct<Data: array<struct<"
        "GeoFips: string, GeoName: string, TimePeriod: string, DataValue: string,"
        "IndustryClassification: string, Description: string>>>>"
    )
    return nested_results(spark.read.schema(schema).json(path, multiLine=True))


def nested_results(payloads: DataFrame) -> DataFrame:
    error = F.col("BEAAPI.Error")
    checked = payloads.where(
        F.when(error.isNull(), F.lit(True)).otherwise(
            F.raise_error(F.concat(F.lit("payload error: "), F.to_json(error))).cast("boolean")
        )
    )
    data = checked.select(F.explode("BEAAPI.Results.Data").alias("d")).select("d.*")
    return columns.clean_names(data)


def parameterised(
    df: DataFrame, years: list[int], counties: list[str] | None = None, sectors: list[str] | None = None
) -> DataFrame:
    """Slice of a stored table by lists; the lists reach the scan as pushed filters."""
    out = df.where(F.col("year_num").isin(years))
    if counties is not None:
        out = out.where(F.col("state_cnty_fips_cd").isin(counties))
    if sectors is not None:
        out = out.where(F.col("naics2_sector_cd").isin(sectors))
    return out
