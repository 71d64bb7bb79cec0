"""Statistics against a brute-force version; the decision list on planted rules."""

import collections
import re

import numpy as np
from pyspark.sql import functions as F

from regionledger.llm import quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")
TEXTS = [
    None, "", "  ", "a b c a b c", "a a a a", "x y z\nx y z\n\n \nx y z", "# a $b 50%\t<x>|", "one two", "a b c d a b e", "é ü é ü é ü", "A.B!C, d;\x0be\x0cf\rg\n",
    "w " * 3000, " ".join(str(i) for i in range(2000)), "a b\n a b\na b", "\n".join(["line one here"] * 40),
]


def brute(t):
    t = t or ""
    w = WORD.findall(t)
    three = collections.Counter(zip(w, w[1:], w[2:]))
    inside = set()
    for i in range(len(w) - 2):
        if three[tuple(w[i : i + 3])] > 1:
            inside |= {i, i + 1, i + 2}
    lines = [x for x in t.split("\n") if WORD.search(x)]
    return (
        len(w), sum(map(len, w)), sum(c in quality.SYMBOLS for c in t), sum("A" <= c <= "Z" for c in t), sum(c in "!?.,;:" for c in t), len(lines), len(lines) - len(set(lines)), len(set(w)), len(inside),
    )


def test_statistics(spark):
    rows = list(enumerate(TEXTS)) + [(3, TEXTS[3]), (None, TEXTS[4])]
    docs = spark.createDataFrame([(i, t, 1, "w") for i, t in rows], "doc_id long, text string, n int, t string")
    got = sorted((tuple(r) for r in quality.statistics(docs).collect()), key=repr)
    assert got == sorted(((i, *brute(t)) for i, t in rows), key=repr)


def test_learned_list_finds_planted_rules():
    rng = np.random.default_rng(1)
    n = 3000
    x = {k: rng.uniform(0, 1, n) for k in quality.FEATURES}
    bad = (x["symbol_rate"] > 0.8) | ((x["repeat_rate"] > 0.6) & (x["n_words"] <= 0.5))
    rules = quality.learn(x, bad)
    hit = np.zeros(n, bool)
    for r in rules:
        hit |= quality._covers(r, x, n)
    assert (hit == bad).mean() > 0.97
    assert (hit & ~bad).sum() < 0.01 * n
    assert quality.learn(x, np.zeros(n, bool)) == [] == quality.learn({k: v[:0] for k, v in x.items()}, bad[:0])


def test_list_is_applied_in_order(spark):
    good = " ".join(f"word{i}" for i in range(80))
    docs = spark.createDataFrame([(1, good), (2, good + " ###" * 30), (3, "short"), (4, "same " * 90), (None, None)], "doc_id long, text string")
    rules = [(quality.Condition("symbol_rate", True, 0.05),), (quality.Condition("distinct_rate", False, 0.1), quality.Condition("n_words", True, 10.0))]
    got = {r.doc_id: (r.base_failed, r.kept, r.rule) for r in quality.apply(docs, rules).collect()}
    assert got == {1: (False, True, None), 2: (False, False, 0), 3: (True, False, None), 4: (True, False, 1), None: (True, False, None)}


def test_fit_on_labels(spark):
    good = [(i, " ".join(f"w{i}x{j}" for j in range(70))) for i in range(120)]
    bad = [(1000 + i, " ".join(f"w{i}x{j} |" for j in range(70))) for i in range(120)]
    docs = spark.createDataFrame(good + bad + [(9999, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1) for i, _ in good] + [(i, 0) for i, _ in bad] + [(None, 0), (5, None)], "doc_id long, quality int")
    rules = quality.fit(docs, labels)
    kept = {r.doc_id for r in quality.apply(docs, rules).where("kept").collect()}
    assert kept == {i for i, _ in good}
    assert quality.fit(docs, labels.where(F.lit(False))) == []
    assert quality.apply(docs.where(F.lit(False)), rules).collect() == []
