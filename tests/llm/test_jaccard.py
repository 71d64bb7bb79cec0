"""The heavy-light join against a brute-force version."""

import random
import re

import pytest

from regionledger.llm import jaccard
from regionledger.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(t, k):
    w = WORD.findall((t or "").translate(LOWER))
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def brute(rows, like):
    sets = [shingles(t, like.k) for _, t in rows]
    up = list(range(len(rows)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and like.den * len(a & b) >= like.num * len(a | b):
                up[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return sorted(((d, len(sets[i]), least.get(find(i)) if sets[i] else d) for i, (d, _) in enumerate(rows)), key=repr)


def run(spark, rows, like=jaccard.Likeness()):
    docs = spark.createDataFrame([(i, t, 1, "k") for i, t in rows], "doc_id long, text string, cls int, key string")
    got = jaccard.groups(docs, like).select("doc_id", "n_shingles", "component_id").collect()
    return sorted(map(tuple, got), key=repr)


def edited(rng, words, vocabulary, n):
    words = list(words)
    for _ in range(n):
        at = rng.randrange(len(words))
        if rng.random() < 0.5:
            words[at] = rng.choice(vocabulary)
        else:
            del words[at]
    return words


def corpus(seed, docs, longest):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    rows, texts = [], []
    for i in range(docs):
        if texts and rng.random() < 0.6:
            base = rng.choice(texts)
            w = edited(rng, base, vocabulary, rng.randint(0, max(1, len(base) // 40))) if len(base) > 12 else base
        else:
            w = [rng.choice(vocabulary) for _ in range(rng.randint(1, longest))]
        texts.append(w or ["x"])
        rows.append((i * 3 % docs + 1000 * (i % 2), " ".join(w)))
    return rows


def test_odd_rows(spark):
    rows = [
        (5, "a b c d e"), (3, "A b\tC d  e"), (4, None), (6, ""), (7, " \n"), (8, "a b"), (9, "a b"), (2, "b a"), (None, "a b c d e"),
        (None, None), (5, "other words stand here now"), (5, "a b c d e"), (1, "x" * 50_000), (0, "x" * 50_000),
    ]
    assert run(spark, rows) == brute(rows, jaccard.Likeness())


def test_empty_table(spark):
    assert run(spark, []) == []


@pytest.mark.parametrize("short", [2, 16])
def test_small_and_large_sets(spark, monkeypatch, short):
    monkeypatch.setattr(jaccard, "SHORT_LIST", short)
    rows = corpus(1, 250, 120) + [(5000 + i, t) for i, (_, t) in enumerate(corpus(2, 150, 30))]
    for like in (jaccard.Likeness(), jaccard.Likeness(5, 4, 5)):
        assert run(spark, rows, like) == brute(rows, like)


def test_every_boundary_gives_the_same_groups(spark, monkeypatch):
    rows = corpus(3, 150, 60)
    want = brute(rows, jaccard.Likeness())
    for heavy in (0, 15, 40, 1000):
        monkeypatch.setattr(jaccard, "boundary", lambda *_: heavy)
        assert run(spark, rows) == want


def test_long_lists_of_near_copies(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "SHORT_LIST", 4)
    rng = random.Random(9)
    vocabulary = [f"v{i}" for i in range(3000)]
    base = [rng.choice(vocabulary) for _ in range(150)]
    rows = [(i, " ".join(edited(rng, base, vocabulary, rng.randint(1, 8)))) for i in range(150)]
    assert run(spark, rows) == brute(rows, jaccard.Likeness())


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, i) for i in range(101, 130)] + [(7, 7)]
    got = dict(map(tuple, components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 130)}}


def test_keep_one(spark):
    like = jaccard.Likeness(5, 4, 5)
    rows = corpus(7, 120, 60) + [(None, "a b c d e f g h"), (4000, "a b c d e f g h"), (4000, "a b c d e f g h"), (None, ""), (None, None), (4001, ""), (None, "only null here x y z")]
    rows += [(None, "only null here x y z"), (6000, "Two texts of one id one"), (6000, "two TEXTS of one id one")]
    docs = spark.createDataFrame([(i, t, 1, "k") for i, t in rows], "doc_id long, text string, cls int, row string")
    got = jaccard.keep_one(docs, like)
    assert got.columns == docs.columns
    left = [(r.doc_id, r.text) for r in got.collect()]
    sets = [shingles(t, like.k) for _, t in rows]
    up = list(range(len(rows)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and like.den * len(a & sets[j]) >= like.num * len(a | sets[j]):
                up[find(i)] = find(j)
    groups = {}
    for i, (d, t) in enumerate(rows):
        if sets[i]:
            groups.setdefault(find(i), []).append((d, t))
    assert len(left) == len(groups) + sum(not s for s in sets)
    for g in groups.values():
        stay = [x for x in left if x in g]
        ids = [d for d, _ in g if d is not None]
        assert len(stay) == 1 and stay[0][0] == (min(ids) if ids else None)
