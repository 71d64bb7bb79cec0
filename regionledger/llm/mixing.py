"""Temperature mixing: source shares raised to an exponent, realised as whole passes and a cut.

Weights are `share ** a`, normalised. The exponent is bisected: either the largest that
reaches a target entropy, or the smallest at which no source is repeated more often than
a limit. A source with weight w and t tokens is passed `w * budget / t` times: whole
passes take every document, the last, partial pass takes documents in a block
permutation until its token budget is met. A document's key is its block's place in the
permutation of its source followed by its own hash, so the partial pass is "all keys up
to a cut", and the cut is found by narrowing: tokens are summed per key prefix, the
prefix in which the budget ends is opened, and so on. No task orders a whole source.

Only built-in functions are used. Documents with equal id, text and source have equal
keys and are taken together; a document is taken if the keys before it leave budget. A
null source is a source of its own, a null text has no tokens and an empty key part;
documents without tokens are in every pass that is taken whole. An empty table gives an
empty result. Columns named like working columns are kept as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from regionledger.sources import scratch

#: Lengths of the key prefixes at which tokens are summed: block, twice finer, whole key.
_LEVELS = (8, 12, 16, 20)
STEPS = 60
#: Tables of up to so many sources, by count, are sent to every task; larger ones are joined by shuffle.
FEW_SOURCES = 50_000


def _small(sources: DataFrame) -> DataFrame:
    """The table, to be broadcast if its size allows, so that a hot source stays spread out."""
    return F.broadcast(sources) if sources.limit(FEW_SOURCES + 1).count() <= FEW_SOURCES else sources


def tokens(text: Column) -> Column:
    """Words of a text."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^ \t-\r]+")), F.lit(0)).cast("long")


def source_key(source: Column) -> Column:
    """A string for every source, null included."""
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit(""))


def key(doc_id: Column, text: Column, source: Column, seed: int) -> Column:
    """Place of the document in its source's block permutation, as 20 hex digits."""
    own = F.substr(F.md5(F.concat_ws("|", F.coalesce(doc_id.cast("string"), F.lit("")), F.coalesce(text, F.lit("")))), F.lit(1), F.lit(12))
    block = F.md5(F.concat_ws("|", F.lit(str(seed)), source_key(source), F.substr(own, F.lit(1), F.lit(2))))
    return F.concat(F.substr(block, F.lit(1), F.lit(8)), own)


def exponent(sources: DataFrame, target_entropy: float | None, repetition_limit: float | None) -> Column:
    """Scalar: the bisected exponent for a table of sources with their tokens `t`.

    With `target_entropy` (a part of the largest entropy, 0 to 1) the largest exponent
    whose weights reach it; with `repetition_limit` the smallest one at which the
    most repeated source is passed at most that often for each pass of the least
    repeated one. Runs as one expression over the array of source sizes.
    """
    if (target_entropy is None) == (repetition_limit is None):
        raise ValueError("give a target entropy or a repetition limit")
    if repetition_limit is not None:
        # Passes of a source relative to the largest one: (share of largest / share) ** (1 - a).
        fits = f"pow(array_max(ts) / array_min(ts), 1 - (acc.lo + acc.hi) / 2) <= {float(repetition_limit)!r}D"
        step = f"if({fits}, struct(acc.lo AS lo, (acc.lo + acc.hi) / 2 AS hi), struct((acc.lo + acc.hi) / 2 AS lo, acc.hi AS hi))"
        end = "hi"
    else:
        # Entropy of weights x / z is ln z - sum(x ln x) / z.
        x = "transform(ts, t -> pow(t / array_max(ts), (acc.lo + acc.hi) / 2))"
        z = f"aggregate({x}, 0D, (s, v) -> s + v)"
        xl = f"aggregate({x}, 0D, (s, v) -> s + if(v > 0, v * ln(v), 0D))"
        fits = f"ln({z}) - ({xl}) / ({z}) >= {float(target_entropy)!r}D * ln(size(ts))"
        step = f"if({fits}, struct((acc.lo + acc.hi) / 2 AS lo, acc.hi AS hi), struct(acc.lo AS lo, (acc.lo + acc.hi) / 2 AS hi))"
        end = "lo"
    found = f"aggregate(sequence(1, {STEPS}), struct(0D AS lo, 1D AS hi), (acc, i) -> {step}, acc -> acc.{end})"
    sizes = sources.where("t > 0").agg(F.sort_array(F.collect_list(F.col("t").cast("double"))).alias("ts"))
    return sizes.select(F.expr(found)).scalar()


def weights(
    docs: DataFrame, budget: float | None = None, target_entropy: float | None = None,
    repetition_limit: float | None = None,
) -> DataFrame:
    """One row per source of a table (src, tokens): t, whole passes and the rest in tokens.

    Without a budget the least repeated source is passed once, so no document is lost.
    """
    sources = docs.groupBy("src").agg(F.sum("tokens").alias("t"))
    raised = sources.withColumn("x", F.when(F.col("t") > 0, F.pow(F.col("t").cast("double"), exponent(sources, target_entropy, repetition_limit))).otherwise(0.0))
    if budget is None:
        least = raised.where("t > 0").agg(F.max(F.col("t") / F.col("x"))).scalar()
        share = F.col("x") * least
    else:
        total = raised.agg(F.sum("x")).scalar()
        share = F.col("x") / total * float(budget)
    passes = F.when(F.col("t") > 0, share / F.col("t")).otherwise(1.0)
    # A share that misses a whole pass by rounding only counts as whole.
    whole = F.floor(passes + 1e-9)
    return raised.select(
        "src", "t", whole.alias("whole"),
        F.greatest(F.round((passes - whole) * F.col("t")), F.lit(0.0)).cast("long").alias("rest"),
    )


def cuts(docs: DataFrame, plan: DataFrame) -> DataFrame:
    """Per source: whole passes, and the last key of the partial pass (null: none).

    `docs` holds src, key and tokens. Each level sums tokens per key prefix inside the
    prefix found before: at most 2^32 prefixes of which one is opened per source.
    """
    few = plan.limit(FEW_SOURCES + 1).count() <= FEW_SOURCES
    open_ = plan.where("rest > 0").select("src", "rest", F.lit("").alias("prefix"))
    for n in _LEVELS:
        sums = (
            docs.join(F.broadcast(open_) if few else open_, "src").where(F.startswith(F.col("key"), F.col("prefix")))
            .groupBy("src", "rest", F.substr("key", F.lit(1), F.lit(n)).alias("part")).agg(F.sum("tokens").alias("t"))
        )
        order = Window.partitionBy("src").orderBy("part")
        before = F.coalesce(F.sum("t").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        open_ = (
            sums.withColumn("before", before).where(F.col("before") < F.col("rest"))
            .groupBy("src").agg(F.max_by(F.struct((F.col("rest") - F.col("before")).alias("rest"), F.col("part").alias("prefix")), "part").alias("o"))
            .select("src", "o.rest", "o.prefix")
        )
    return plan.select("src", "whole").join(open_.select("src", F.col("prefix").alias("cut")), "src", "left")


def mix(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", seed: int = 7,
    budget: float | None = None, target_entropy: float | None = None, repetition_limit: float | None = None,
    keep: list[str] | None = None,
) -> DataFrame:
    """The mixed table: columns `keep` (all of `docs` if not given), `epoch` and `block`.

    A document appears once for every pass it is in, numbered from 0. Sorting by epoch
    and block gives the order in which the blocks of all sources are interleaved.
    """
    keep = docs.columns if keep is None else keep
    src, k = source_key(F.col(source)), key(F.col(doc_id), F.col(text), F.col(source), seed)
    small = scratch.materialise(docs.select(src.alias("src"), k.alias("key"), tokens(F.col(text)).alias("tokens")))
    plan = scratch.materialise(weights(small, budget, target_entropy, repetition_limit))
    found = scratch.materialise(cuts(small, plan))
    rows = docs.select(F.struct(*keep).alias("row"), src.alias("src"), k.alias("key"))
    passes = F.col("whole") + F.when(F.col("key") <= F.col("cut"), 1).otherwise(0)
    return (
        rows.join(_small(found), "src").withColumn("passes", passes).where("passes > 0")
        .withColumn("epoch", F.explode(F.sequence(F.lit(0), (F.col("passes") - 1).cast("int"))))
        .select("row.*", "epoch", F.substr("key", F.lit(1), F.lit(8)).alias("block"))
    )
