"""Temperature mixing: weights, budgets and the cut, against a plain ordering."""

import math

import pytest
from pyspark.sql import functions as F

from regionledger.llm import mixing


def table(spark, rows):
    return spark.createDataFrame([(i, t, s, 0, "e") for i, t, s in rows], "doc_id long, text string, source string, t int, epoch0 string")


ROWS = [(i, "w " * (1 + i % 7), "big") for i in range(400)] + [(1000 + i, "w " * (2 + i % 3), "mid") for i in range(60)] + [(2000 + i, "a b", None) for i in range(20)]
ROWS += [(3000, None, "void"), (3001, "", "big"), (None, "x y z", "mid"), (5, "w " * 6, "big"), (5, "w " * 6, "big")]


def sizes(rows):
    out = {}
    for _, t, s in rows:
        out[s] = out.get(s, 0) + len((t or "").split())
    return out


def test_repetition_limit_loses_nothing(spark):
    got = mixing.mix(table(spark, ROWS), repetition_limit=3.0, keep=["doc_id", "source", "text"]).collect()
    assert {r.doc_id for r in got} == {i for i, _, _ in ROWS}
    t = sizes(ROWS)
    share = {s: sum(len((r.text or "").split()) for r in got if r.source == s) / t[s] for s in t if t[s]}
    assert share["big"] == 1.0
    assert max(share.values()) == pytest.approx(3.0, abs=0.15)
    assert 1.0 < share["mid"] < share[None]
    assert sum(r.source == "void" for r in got) == 1


def test_target_entropy_and_budget(spark):
    docs = table(spark, ROWS)
    t = {s: n for s, n in sizes(ROWS).items() if n}
    got = mixing.mix(docs, budget=900, target_entropy=0.9, keep=["doc_id", "source", "text", "t"]).collect()
    mixed = {s: sum(len((r.text or "").split()) for r in got if r.source == s) for s in t}
    total = sum(mixed.values())
    assert total == pytest.approx(900, abs=25)
    entropy = -sum(n / total * math.log(n / total) for n in mixed.values())
    assert entropy == pytest.approx(0.9 * math.log(len(t)), abs=0.03)


def test_partial_pass_is_a_prefix_of_the_key_order(spark):
    docs = table(spark, ROWS)
    keyed = docs.select("*", mixing.key(F.col("doc_id"), F.col("text"), F.col("source"), 7).alias("k"), mixing.tokens(F.col("text")).alias("n"))
    order = sorted((r.k, r.n, r.doc_id) for r in keyed.where("source = 'big'").collect())
    got = mixing.mix(docs, budget=700, target_entropy=0.5, keep=["doc_id", "source", "text"]).where("source = 'big'").collect()
    taken = sum(len((r.text or "").split()) for r in got)
    keys = sorted({k for k, _, i in order if i in {r.doc_id for r in got}})
    assert keys == sorted({k for k, _, _ in order})[: len(keys)]
    last = sum(n for k, n, _ in order if k == keys[-1])
    # The document that crosses the budget is the last one.
    plan = mixing.weights(docs.select(mixing.source_key(F.col("source")).alias("src"), mixing.tokens(F.col("text")).alias("tokens")), budget=700, target_entropy=0.5)
    rest = {r.src: r for r in plan.collect()}["=big"]
    assert rest["whole"] == 0 and taken - last < rest["rest"] <= taken


def test_one_source_and_empty_table(spark):
    one = table(spark, [(1, "a b", "s"), (2, "c", "s")])
    assert sorted(r.doc_id for r in mixing.mix(one, repetition_limit=2.0).collect()) == [1, 2]
    assert mixing.mix(table(spark, []), repetition_limit=2.0).collect() == []
    with pytest.raises(ValueError):
        mixing.mix(one)
