"""Queries op1 to op10: each operator over its whole table, reduced to its digest columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from regionledger.llm import codes, jaccard, search, simhash, mixing, oracle, pii, quality, secrets, sharding, substring, templates, tokens, toxicity
from regionledger.sources import scratch

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _listed(spans: Column, kinds: list[str] | tuple[str, ...]) -> Column:
    """kind:start:end of an array of spans, joined by commas."""
    name = lambda k: F.element_at(F.array(*[F.lit(x) for x in kinds]), k + 1)
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", name(x["kind"]), x["start"].cast("string"), x["end"].cast("string"))), ",")


def _digest(found: DataFrame, kinds: list[str] | tuple[str, ...], base: int) -> DataFrame:
    """Counts and digest of the first `base` kinds, and all spans, of a table (doc_id, found)."""
    of = lambda k: F.filter("found", lambda x: x["kind"] == k)
    return found.select(
        "doc_id", *[F.size(of(k)).cast("long").alias(f"n_{kinds[k]}") for k in range(base)],
        F.sha2(_listed(F.filter("found", lambda x: x["kind"] < base), kinds), 256).alias("base_sha256"), _listed(F.col("found"), kinds).alias("spans"),
    )


@query
def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base and linked secret spans of every document."""
    return _digest(secrets.scan(table(spark, sf_dir, "documents")), secrets.KINDS, 3)


@query
def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document, counted by a scan of flat token files made of the table."""
    path = f"{scratch.folder(spark)}/tokens"
    tokens.write(table(spark, sf_dir, "documents"), path)
    return tokens.count(spark, path).select("doc_id", "n_tokens", "closed")


@query
def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that repeat passages of earlier ones are removed."""
    return substring.dedup(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256")
    )


@query
def op4_semi_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base spans of personal data of every document, and those of the semi-Markov field."""
    docs = table(spark, sf_dir, "documents")
    return _digest(pii.scan(docs, pii.fit(docs)), pii.KINDS, len(pii.BASE))


@query
def op5_template_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the benchmark items that it leaks, values changed or not."""
    docs = table(spark, sf_dir, "documents")
    found = templates.matches(docs, table(spark, sf_dir, "benchmark"), whole=True)
    return templates.mark(docs, found, keep=["doc_id"]).select(
        "doc_id", (F.size("items") > 0).alias("contaminated"), F.array_join(F.transform("items", lambda x: x.cast("string")), ",").alias("item_ids"), "copied"
    )


@query
def op6_subword_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document under the model fitted to the training part of the labels."""
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).select(
        "doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score",
        F.when(F.col("score") >= toxicity.THRESHOLD, 1).otherwise(0).alias("predicted"),
    )


@query
def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics and verdict of every document under the learned list."""
    docs = table(spark, sf_dir, "documents")
    rules = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.apply(docs, rules).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rule"
    )


#: The most repeated source is passed at most so often for a pass of the largest.
REPETITION_LIMIT = 2.0


@query
def op8_temperature_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every pass of every document in the mixture."""
    docs = table(spark, sf_dir, "documents")
    return mixing.mix(docs, repetition_limit=REPETITION_LIMIT, keep=["doc_id", "source"])


@query
def op9_bin_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of every document; shards have nearly equal bytes."""
    return sharding.assign(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


@query
def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Set size and component of every document; four words, 85 percent."""
    return jaccard.groups(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


#: Tables of up to so many labels are sent to every task; larger ones are joined by shuffle.
FEW_LABELS = 100_000


@query
def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product-quantisation code and error of every usable vector, error summed per label, and the codebooks' digest."""
    vectors = table(spark, sf_dir, "embeddings")
    if "label" not in vectors.columns:
        vectors = vectors.withColumn("label", F.lit(None).cast("long"))
    book = codes.fit(vectors)
    coded = codes.encode(vectors, book, keep=["vec_id", "label"])
    per_label = coded.groupBy(F.col("label").alias("_label")).agg(F.sum("error").cast("long").alias("label_error"))
    few = per_label.limit(FEW_LABELS + 1).count() <= FEW_LABELS
    joined = coded.join(F.broadcast(per_label) if few else per_label, coded["label"].eqNullSafe(per_label["_label"]))
    return joined.select(
        "vec_id", codes.hex_code(F.col("codes")).alias("code"), "error", "label_error",
        F.lit(book.digest if book is not None else None).cast("string").alias("codebooks_sha256"),
    )


@query
def op12_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash fingerprint and near-duplicate component of every document; 4-word shingles, 4 bits."""
    return simhash.groups(table(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")


@query
def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents of every benchmark item, by an automaton of all item terms."""
    return search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLE["op1_secret_scan"] = oracle.secret_scan()
ORACLE["op2_token_counts"] = oracle.token_counts()
ORACLE["op3_substring_dedup"] = oracle.substring_dedup()
ORACLE["op8_temperature_mix"] = oracle.temperature_mix(REPETITION_LIMIT)
ORACLE["op10_jaccard_join"] = oracle.jaccard_join()
ORACLE["op11_vector_codes"] = oracle.vector_codes()
ORACLE["op13_ranked_search"] = oracle.ranked_search()


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
