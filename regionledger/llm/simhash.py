"""SimHash near-duplicates: fingerprints of shingles, linked by a positional-byte index.

A text's shingles are its 4-word windows with repeats (the whole word sequence when it is
shorter, none without words), space-joined after A-Z are lower-cased. Each shingle's
XXH64 (UTF-8, seed 42, Spark's own `xxhash64`) votes on 64 bits; a fingerprint bit is 1
when over half the shingles have it. Two fingerprints link at `DISTANCE` or fewer
differing bits, and documents are grouped by the components of these links.

Links come from an inverted index on positional bytes. Fingerprints differing in at most
4 bits differ in at most 4 of their 8 bytes, so a linked pair shares at least 4 bytes at
the same positions: that is the guaranteed minimum of the count filter. Posting lists of
single bytes hold 1/256 of all fingerprints each and would tally O(N^2) pairs, so the
index is keyed by 4 positional bytes at once (70 position sets): a pair meets under a key
only when those 4 positions agree, i.e. when its tally already reaches the minimum. The
pair is emitted under the first such set only (the first four positions where it agrees),
its tally of shared positional bytes is recounted and filtered, and its bit distance is
verified. Copies are merged before indexing: only distinct fingerprints are indexed, so
a group of thousands of equal texts is one posting.

Defined results for odd input: a null or empty text, or one without words, has fingerprint
zero and links like any other. A null doc_id is carried; its component is the smallest
non-null doc_id reachable, or null. Repeated rows get equal results. Other columns are
ignored, so names may clash freely.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regionledger.llm.components import components
from regionledger.sources import scratch

# Fixed values of the contract: shingle width, hash seed, link distance.
WIDTH = 4
SEED = 42
DISTANCE = 4
#: Bytes of a fingerprint, and how many must agree at least for a link.
BYTES = 8
LEAST = BYTES - DISTANCE
_SETS = list(itertools.combinations(range(BYTES), LEAST))
#: A fingerprint shared by more documents than this is joined by broadcast (at most HOT_KEYS of them).
HOT_ROWS, HOT_KEYS = 1000, 10_000
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: Column) -> Column:
    """Words of a text with A-Z lower-cased; none for null."""
    return F.filter(F.split(F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER), r"[ \t-\r]+"), lambda w: w != "")


def shingles(words: Column, width: int = WIDTH) -> Column:
    """Space-joined windows of `width` words, repeats included; fewer words: all of them.

    `words` must be a column, not an expression: a lambda would evaluate an expression
    again for every window.
    """
    n = F.size(words)
    windows = F.transform(F.sequence(F.lit(1), n - (width - 1)), lambda i: F.array_join(F.slice(words, i, width), " "))
    return F.when(n >= width, windows).when(n > 0, F.array(F.array_join(words, " "))).otherwise(F.array().cast("array<string>"))


def _fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Majority of each bit over a document's shingle hashes."""
    for batch in batches:
        h = batch.column("h")
        offsets = np.asarray(h.offsets)
        values = np.asarray(h.values, dtype=np.int64).view(np.uint64)
        n = np.diff(offsets)
        fp = np.zeros(len(batch), np.uint64)
        for b in range(64):
            ones = np.zeros(len(values) + 1, np.int64)
            np.cumsum((values >> np.uint64(b)) & np.uint64(1), out=ones[1:])
            fp |= (2 * (ones[offsets[1:]] - ones[offsets[:-1]]) > n).astype(np.uint64) << np.uint64(b)
        yield pa.RecordBatch.from_arrays([batch.column("_row"), pa.array(fp.view(np.int64))], ["_row", "fp"])


def fingerprints(docs: DataFrame, text: str = "text", keep: list[str] | tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """`keep` columns and `fp` (signed long holding the 64 bits) of every row."""
    listed = docs.select(F.struct(*keep).alias("_row"), words(F.col(text)).alias("_w"))
    rows = listed.select("_row", F.transform(shingles(F.col("_w")), lambda s: F.xxhash64(s)).alias("h"))
    schema = f"_row {rows.schema['_row'].dataType.simpleString()}, fp long"
    return rows.mapInArrow(_fold, schema).select("_row.*", "fp")


def hex16(fp: Column) -> Column:
    """The 64 bits as 16 lowercase hex digits."""
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def _byte(fp: Column, at: int) -> Column:
    """Byte `at` of a fingerprint, 0 being the most significant."""
    return F.shiftrightunsigned(fp, 8 * (BYTES - 1 - at)).bitwiseAND(F.lit(255))


def _keys(fp: Column) -> Column:
    """One key per position set: its number above 32 bits, its 4 bytes below."""
    keys = []
    for n, positions in enumerate(_SETS):
        packed = F.lit(n).cast("long") * F.lit(1 << 32)
        for i, at in enumerate(positions):
            packed = packed + F.shiftleft(_byte(fp, at), 8 * (LEAST - 1 - i))
        keys.append(packed)
    return F.array(*keys)


def _agreeing(x: Column) -> Column:
    """Bit `at` is set when byte `at` of the xor is zero."""
    out = F.lit(0)
    for at in range(BYTES):
        out = out + F.when(_byte(x, at) == 0, 1 << at).otherwise(0)
    return out


def _before(n: int) -> int:
    """Positions before the last of set n that are not in it: they must disagree for set n to be the first."""
    s = _SETS[n]
    return sum(1 << p for p in range(s[-1]) if p not in s)


def links(prints: DataFrame) -> DataFrame:
    """(a, b), a < b: distinct fingerprints within DISTANCE bits, from the positional-byte index."""
    keyed = prints.select("fp", F.explode(_keys(F.col("fp"))).alias("key"))
    # Spark sizes the index as if every fingerprint had one key, so its size check would broadcast 70 times too much.
    a, b = keyed.alias("a"), keyed.alias("b").hint("merge")
    pairs = a.join(b, (F.col("a.key") == F.col("b.key")) & (F.col("a.fp") < F.col("b.fp"))).select(
        F.col("a.fp").alias("a"), F.col("b.fp").alias("b"), F.shiftright(F.col("a.key"), 32).cast("int").alias("set")
    )
    x = F.col("a").bitwiseXOR(F.col("b"))
    first = F.element_at(F.array(*[F.lit(_before(n)) for n in range(len(_SETS))]), F.col("set") + 1)
    return (
        pairs.withColumn("agree", _agreeing(x))
        .where(F.col("agree").bitwiseAND(first) == 0)
        .where(F.bit_count(F.col("agree")) >= LEAST)
        .where(F.bit_count(x) <= DISTANCE)
        .select("a", "b")
    )


def _hot_join(rows: DataFrame, table: DataFrame, key: str, counts: DataFrame) -> DataFrame:
    """rows join table on key; keys of over HOT_ROWS rows (at most HOT_KEYS of them) go by broadcast."""
    hot = counts.where(F.col("n") > HOT_ROWS).orderBy(F.col("n").desc()).limit(HOT_KEYS).select(key)
    hot_table = F.broadcast(table.join(F.broadcast(hot), key))
    flagged = rows.join(F.broadcast(hot.withColumn("_hot", F.lit(True))), key, "left")
    return flagged.where("_hot").drop("_hot").join(hot_table, key).unionByName(
        flagged.where(F.col("_hot").isNull()).drop("_hot").join(table, key)
    )


def groups(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, fp, fingerprint (hex) and component_id of every row."""
    fps = scratch.materialise(fingerprints(docs, text))
    prints = scratch.materialise(fps.groupBy("fp").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("n")))
    edges = scratch.materialise(links(prints.select("fp")))
    labels = components(edges.select("a", "b")).select(F.col("node").alias("fp"), "label")
    labelled = prints.join(labels, "fp", "left").select("fp", "n", "rep", F.coalesce("label", "fp").alias("label"))
    least = labelled.groupBy("label").agg(F.min("rep").alias("component_id"))
    per_print = scratch.materialise(labelled.join(least, "label").select("fp", "n", "component_id"))
    out = _hot_join(fps, per_print.drop("n"), "fp", per_print)
    return out.select("doc_id", "fp", hex16(F.col("fp")).alias("fingerprint"), "component_id")
