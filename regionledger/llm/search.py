"""Ranked lexical search: every benchmark item against all documents, by an Aho-Corasick scan.

Terms are maximal runs of letters, digits and non-ASCII characters (`TERM`), with only A-Z
lower-cased. No index of the documents is built: the distinct terms of all items form one
automaton, sent to every task, that counts term frequencies straight from the texts. The
automaton is boundary-guarded: a text is rewritten with every run of separators as one
space and a space at each end, and every term enters the automaton as " term ", so a match
is always a whole term and overlapping matches (" a a ") are all counted. Its outputs are
terms, and terms map to the items that hold them.

Scores are integer BM25-like sums (see `score`): N counts documents with a term, L all
their terms, n a document's terms, df the documents that hold a term, tf its occurrences.
A term's weight is floor(1000 ln((2N+2)/(2df+1))); a document's length factor
m = 10 + (90 n N) div L; an item scores a document with the sum, over its distinct terms,
of w * ((10^9 tf) div (1000 tf + 8 m)). Each item keeps its `TOP` highest scores above 0,
equal scores by ascending doc_id (nulls last), ranked from 1.

Scale: the automaton is bounded. Distinct item terms are cut into blocks of at most about
`BLOCK_TERMS` by hash and the documents are scanned once per block, so any benchmark fits.
Documents are never grouped by term; a term present in every document only produces one
row per (document, item holding it), which the item-term table (broadcast after a size
check) expands. The top list is taken per (item, salt) first, then per item, so a hot item
is ranked by many tasks.

Defined results for odd input: a null or empty text has no terms and is not counted in N;
a null item text has no terms and no rows; rows of one item_id share their terms. Every
document row is its own document, so repeated rows are ranked separately (equal scores,
equal ids). Other columns are ignored, so names may clash freely. An empty table of
documents or items gives no rows.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from regionledger.sources import scratch

# Fixed values of the contract: the separator class (terms are the runs outside it) and the list length.
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
TOP = 10
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Terms in one automaton at most (about); more are scanned in several passes.
BLOCK_TERMS = 500_000
#: Tables of up to so many (item, term) or term rows are broadcast; larger ones are joined by shuffle.
FEW_ROWS = 2_000_000
#: Salts of the first top list of an item.
SALTS = 64


def lowered(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER)


def terms(text: Column) -> Column:
    """Array of the terms of a text, in order, repeats included."""
    return F.regexp_extract_all(lowered(text), F.lit(f"({TERM})"), 1)


def count(text: Column) -> Column:
    """Number of terms of a text."""
    return F.regexp_count(lowered(text), F.lit(TERM)).cast("long")


def guarded(text: Column) -> Column:
    """The text as its terms separated by single spaces, with a space before and after."""
    return F.concat(F.lit(" "), F.regexp_replace(lowered(text), f"{SEPARATORS}+", " "), F.lit(" "))


def _checked(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.limit(FEW_ROWS + 1).count() <= FEW_ROWS else df


_FOUND = "_r long, doc_id long, n long, term string, tf long"


def _scanner(words: list[str], docs_too: bool):
    """Per task: the automaton of `words`; rows of every (document, term) found, and with
    `docs_too` one row per document with a null term."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import ahocorasick

        automaton = ahocorasick.Automaton()
        for w in words:
            automaton.add_word(f" {w} ", w)
        if words:
            automaton.make_automaton()
        for batch in batches:
            at, terms_, tfs = [], [], []
            for i, text in enumerate(batch["_text"]):
                if words and len(text) > 2:
                    for term, tf in Counter(v for _, v in automaton.iter(text)).items():
                        at.append(i)
                        terms_.append(term)
                        tfs.append(tf)
            own = batch.iloc[at]
            found = pd.DataFrame({"_r": own["_r"].values, "doc_id": own["doc_id"].values, "n": own["n"].values, "term": pd.Series(terms_, dtype=object).values, "tf": pd.Series(tfs, dtype="int64").values})
            if docs_too:
                found = pd.concat([batch[["_r", "doc_id", "n"]].assign(term=None, tf=None), found], ignore_index=True)
            yield found

    return run


def scan(docs: DataFrame, items: DataFrame, text: str = "text") -> tuple[DataFrame, DataFrame, DataFrame]:
    """(documents: _r, doc_id, n), (matches: _r, doc_id, n, term, tf) and the item terms (item_id, term).

    `_r` numbers the document rows; all three are written tables. With one block of terms
    the texts are read once; with more they are written once, numbered, and scanned per block.
    """
    item_terms = scratch.materialise(items.select("item_id", F.explode(terms(F.col(text))).alias("term")).distinct())
    every = item_terms.select("term").distinct()
    blocks = max(1, math.ceil(every.count() / BLOCK_TERMS))
    base = docs.select(F.monotonically_increasing_id().alias("_r"), F.col("doc_id").cast("long").alias("doc_id"), count(F.col(text)).alias("n"), guarded(F.col(text)).alias("_text"))
    if blocks > 1:
        base = scratch.materialise(base)
    found = None
    for b in range(blocks):
        words = [r.term for r in every.where(F.pmod(F.xxhash64("term"), F.lit(blocks)) == b).collect()]
        part = base.mapInPandas(_scanner(words, b == 0), _FOUND)
        found = part if found is None else found.unionByName(part)
    table = scratch.materialise(found)
    return table.where(F.col("term").isNull()).select("_r", "doc_id", "n"), table.where(F.col("term").isNotNull()), item_terms


def score(documents: DataFrame, matches: DataFrame, item_terms: DataFrame) -> DataFrame:
    """(item_id, _r, doc_id, score) of every (item, document) with a common term."""
    stats = documents.agg(F.count(F.when(F.col("n") > 0, 1)).alias("N"), F.coalesce(F.sum("n"), F.lit(0)).alias("L")).first()
    big_n, big_l = int(stats["N"]), int(stats["L"])
    if big_l == 0:
        return matches.select(F.lit(None).cast("long").alias("item_id"), "_r", "doc_id", F.lit(0).cast("long").alias("score")).where("false")
    weights = matches.groupBy("term").agg(F.count(F.lit(1)).alias("df")).select(
        "term", F.floor(F.lit(1000.0) * F.log(F.lit(float(2 * big_n + 2)) / (F.col("df") * 2 + 1).cast("double"))).cast("long").alias("w")
    )
    m = F.expr(f"10L + (90L * n * {big_n}L) div {big_l}L")
    part = F.col("w") * F.expr("(1000000000L * tf) div (1000L * tf + 8L * m)")
    per_term = matches.join(_checked(weights), "term").withColumn("m", m).select("_r", "doc_id", "term", part.alias("part"))
    return per_term.join(_checked(item_terms), "term").groupBy("item_id", "_r", "doc_id").agg(F.sum("part").cast("long").alias("score"))


def top(scores: DataFrame, k: int = TOP) -> DataFrame:
    """item_id, rank, doc_id, score: the k highest scores above 0 of each item."""
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("_r")]
    first = scores.where("score > 0").withColumn("_salt", F.pmod(F.col("_r"), F.lit(SALTS)))
    first = first.withColumn("_n", F.row_number().over(Window.partitionBy("item_id", "_salt").orderBy(*order))).where(F.col("_n") <= k)
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("item_id").orderBy(*order))).where(F.col("rank") <= k)
    return ranked.select("item_id", "rank", "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, k: int = TOP, text: str = "text") -> DataFrame:
    """The k best documents of every item, as `top` gives them."""
    return top(score(*scan(docs, items, text)), k)
