"""Schema handling: synonyms, renames, reshapes."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F, types as T


def quoted(name: str) -> Column:
    """Column by exact name, safe for spaces and dots."""
    return F.col("`" + name.replace("`", "``") + "`")


def match_columns(
    columns: Iterable[str], synonyms: dict[str, list[str]], ignore_case: bool = False
) -> tuple[dict[str, str], list[str]]:
    """Map canonical names to the first synonym present; also list the misses."""
    present = {}
    for c in columns:
        present[c.lower() if ignore_case else c] = c
    found, missing = {}, []
    for canonical, options in synonyms.items():
        hit = next((present[o] for o in options if o in present), None)
        if hit is None:
            missing.append(canonical)
        else:
            found[canonical] = hit
    return found, missing


def rename_synonyms(
    df: DataFrame, synonyms: dict[str, list[str]], optional: Iterable[str] = ()
) -> DataFrame:
    """Rename columns to canonical names (case-insensitive, first synonym wins)."""
    df = drop_duplicate_headers(df)
    found, missing = match_columns(df.columns, synonyms, ignore_case=True)
    fatal = [m for m in missing if m not in set(optional)]
    if fatal:
        raise ValueError(f"required columns not found: {fatal}")
    back = {src: dst for dst, src in found.items()}
    return df.select([quoted(c).alias(back.get(c, c)) for c in df.columns])


def find_column(columns: Iterable[str], keyword: str) -> str | None:
    """First column whose name contains the keyword, in any case."""
    return next((c for c in columns if keyword.lower() in c.lower()), None)


def drop_duplicate_headers(df: DataFrame) -> DataFrame:
    """Keep the first of equally named columns."""
    names = df.columns
    if len(set(names)) == len(names):
        return df
    numbered = df.toDF(*[f"c{i}" for i in range(len(names))])
    first = {n: i for i, n in reversed(list(enumerate(names)))}
    return numbered.select(
        [F.col(f"c{i}").alias(n) for n, i in sorted(first.items(), key=lambda x: x[1])]
    )


def require_columns(df: DataFrame, names: Iterable[str]) -> DataFrame:
    missing = sorted(set(names) - set(df.columns))
    if missing:
        raise ValueError(f"input is missing columns: {missing}")
    return df


def drop_unnamed(df: DataFrame) -> DataFrame:
    keep = [c for c in df.columns if c and not c.startswith("Unnamed:")]
    return df.select([quoted(c) for c in keep])


def conform(df: DataFrame, schema: T.StructType, mapping: dict[str, Column] | None = None) -> DataFrame:
    """Select, reorder, rename and type to a declared schema."""
    mapping = mapping or {}
    return df.select(
        [
            mapping.get(f.name, quoted(f.name)).try_cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def fill_from_suffixed(df: DataFrame, suffix: str) -> DataFrame:
    """Fill ``x`` from ``x<suffix>`` where both exist, then drop all suffixed columns."""
    names = set(df.columns)
    out = []
    for c in df.columns:
        if c.endswith(suffix):
            continue
        twin = c + suffix
        out.append(F.coalesce(quoted(c), quoted(twin)).alias(c) if twin in names else quoted(c))
    return df.select(out)


def with_default(df: DataFrame, name: str, value) -> DataFrame:
    """Add a constant column only where it is missing."""
    return df if name in df.columns else df.withColumn(name, F.lit(value))


def melt(df: DataFrame, ids: list[str], values: list[str], name: str, value: str) -> DataFrame:
    return df.unpivot(ids, values, name, value)


def pivot_first(
    df: DataFrame, keys: list[str], code: str, value: str, codes: list[str]
) -> DataFrame:
    """Long to wide, one value per cell (the smallest if repeated), columns in code order.

    ``codes`` is part of the declared schema; without it Spark would run an
    extra job over the data just to list them.
    """
    return df.groupBy(*keys).pivot(code, sorted(codes)).agg(F.min(value))


def clean_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.strip().lower() for c in df.columns])
