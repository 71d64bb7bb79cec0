"""Substring dedup against a brute-force version."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from regionledger.llm import substring

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, k):
    found = [(i, WORD.findall(t or "")) for i, t in rows]
    least = {}
    for i, w in found:
        if i is not None:
            for a in range(len(w) - k + 1):
                key = tuple(w[a : a + k])
                least[key] = min(least.get(key, i), i)
    out = []
    for i, w in found:
        gone = set()
        if i is not None:
            for a in range(len(w) - k + 1):
                if least[tuple(w[a : a + k])] < i:
                    gone.update(range(a, a + k))
        out.append((i, len(w), len(gone), " ".join(x for a, x in enumerate(w) if a not in gone)))
    return sorted(out, key=repr)


def run(spark, rows, k, **more):
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, anchor string, n int")
    return sorted(map(tuple, substring.dedup(docs, k=k, **more).collect()), key=repr)


def test_odd_rows(spark):
    rows = [
        (5, "a b c d e f g"), (3, "x a b c d y"), (9, None), (8, ""), (None, "a b c d"), (5, "a b c d e"), (7, "é  ü\tb\x0bc d e f"),
        (7, "é  ü\tb\x0bc d e f"), (2, "q " * 40), (1, "q " * 30), (4, "short"), (11, "a b c d e f g"),
    ]
    for k in (1, 2, 3, 4, 7):
        assert run(spark, rows, k) == brute(rows, k)


def test_empty_table(spark):
    assert run(spark, [], 3) == []


def test_random_copies_with_a_tiny_sketch(spark):
    rng = random.Random(4)
    words = [f"w{i}" for i in range(30)]
    rows = []
    for i in range(300):
        w = [rng.choice(words) for _ in range(rng.randint(0, 60))]
        if rows and rng.random() < 0.5:
            src = (rng.choice(rows)[1] or "").split()
            a = rng.randint(0, max(0, len(src) - 1))
            w[rng.randint(0, len(w)) : 0] = src[a : a + rng.randint(5, 40)]
        rows.append((i, " ".join(w)))
    # Sixteen bits of sketch let nearly everything through; the result is the same.
    assert run(spark, rows, 6, max_cells=1 << 16) == brute(rows, 6) == run(spark, rows, 6)


def test_hot_passage_and_small_gathers(spark, monkeypatch):
    monkeypatch.setattr(substring, "GATHER", 50)
    rows = [(i, f"own{i} " + "the common passage of many documents here " + f"tail{i}") for i in range(200)]
    assert run(spark, rows, 5) == brute(rows, 5)


@pytest.mark.parametrize("sf", ["sf0.001"])
def test_provided_documents(spark, sf):
    docs = spark.read.parquet(f"/root/testdata/{sf}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    got = substring.dedup(docs).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256)).collect()
    want = [(i, n, g, hashlib.sha256(t.encode()).hexdigest()) for i, n, g, t in brute(rows, 50)]
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
