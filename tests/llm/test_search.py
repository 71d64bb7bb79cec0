"""Ranked search against a brute force: every document tokenised, every item scored."""

import math
import random
import re
from collections import Counter

from regionledger.llm import search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def toks(text):
    return TERM.findall((text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))


def brute(docs, items, k=10):
    ts = [toks(t) for _, t in docs]
    big_n, big_l = sum(1 for t in ts if t), sum(len(t) for t in ts)
    tfs = [Counter(t) for t in ts]
    df = Counter(w for c in tfs for w in c)
    of_item = {}
    for i, t in items:
        of_item.setdefault(i, set()).update(toks(t))
    out = []
    for i, words in of_item.items():
        scored = []
        for (d, _), t, c in zip(docs, ts, tfs):
            if not t:
                continue
            m = 100 - 90 + (90 * len(t) * big_n) // big_l
            s = sum(math.floor(1000 * math.log((2 * big_n + 2) / (2 * df[w] + 1))) * ((1000000000 * c[w]) // (1000 * c[w] + 8 * m)) for w in words if c[w])
            if s > 0:
                scored.append((s, d))
        scored.sort(key=lambda x: (-x[0], x[1] is None, x[1] or 0))
        out += [(i, r + 1, d, s) for r, (s, d) in enumerate(scored[:k])]
    return sorted(out, key=repr)


def run(spark, docs, items):
    d = spark.createDataFrame([(i, t, "x", 1) for i, t in docs], "doc_id long, text string, term string, _r int")
    b = spark.createDataFrame([(i, t, 2.0) for i, t in items], "item_id long, text string, score double")
    return sorted(((r.item_id, r.rank, r.doc_id, r.score) for r in search.search(d, b).collect()), key=repr)


def corpus(seed, n):
    rnd = random.Random(seed)
    vocab = ["alpha", "Beta", "gamma", "δέλτα", "x1", "2024", "the", "of", "日本語", "naïve", "a"]
    seps = [" ", ", ", ".", "\n", "--", "'", "\t", "_", "ü"]
    make = lambda m: "".join(rnd.choice(vocab) + rnd.choice(seps) for _ in range(m))
    return [(i, make(rnd.randrange(0, 40))) for i in range(n)], [(j, make(rnd.randrange(1, 8))) for j in range(6)]


def test_random_against_brute(spark):
    docs, items = corpus(1, 80)
    assert run(spark, docs, items) == brute(docs, items)


def test_odd_rows(spark):
    docs = [(1, None), (2, ""), (3, "..."), (4, "a a a"), (4, "a a a"), (None, "a b"), (5, "A-B a_b"), (6, "ab " * 30000 + "a"), (7, "aa ba ab a")]
    items = [(1, "a"), (2, None), (3, "A b"), (3, "zzz"), (None, "ab"), (4, "")]
    got = run(spark, docs, items)
    assert got == brute(docs, items)
    assert [r for r in got if r[0] == 1][0][2] == 4  # ties by doc_id


def test_many_ties_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(search, "BLOCK_TERMS", 2)
    docs = [(i, "same words here") for i in range(30)] + [(100, "words")]
    items = [(1, "same words"), (2, "here here words"), (3, "nothing")]
    assert run(spark, docs, items) == brute(docs, items)


def test_empty(spark):
    assert run(spark, [], [(1, "a")]) == []
    assert run(spark, [(1, "a")], []) == []
