"""SimHash groups against a brute force: Python's xxhash, every pair compared, union-find."""

import random
import re

import xxhash

from regionledger.llm import simhash


def fingerprint(text):
    words = [w for w in re.split(r"[ \t-\r]+", (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))) if w]
    if len(words) >= 4:
        sh = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)]
    else:
        sh = [" ".join(words)] if words else []
    hs = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute(rows):
    fps = [fingerprint(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= 4:
                parent[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            r = find(i)
            least[r] = min(least.get(r, d), d)
    return sorted(((d, f"{fps[i]:016x}", least.get(find(i))) for i, (d, _) in enumerate(rows)), key=repr)


def run(spark, rows):
    df = spark.createDataFrame([(d, t, "x", 1, 2) for d, t in rows], "doc_id long, text string, fp string, key int, n int")
    return sorted(((r.doc_id, r.fingerprint, r.component_id) for r in simhash.groups(df).collect()), key=repr)


def texts(seed, n):
    rnd = random.Random(seed)
    vocab = [f"w{i}" for i in range(40)] + ["Ünï", "日本", "X"]
    base = [" ".join(rnd.choice(vocab) for _ in range(rnd.randrange(1, 60))) for _ in range(n)]
    out = []
    for t in base:
        out.append(t)
        ws = t.split(" ")
        for _ in range(rnd.randrange(3)):
            v = list(ws)
            v[rnd.randrange(len(v))] = rnd.choice(vocab).upper()
            out.append(" ".join(v))
    return out


def test_random_against_brute(spark):
    rows = list(enumerate(texts(3, 40)))
    assert run(spark, rows) == brute(rows)


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "One two three"), (6, "one two three four"), (None, "one two three four"),
            (7, "a b c d e " * 2000), (7, "a b c d e " * 2000), (8, "A B C D E " * 2000), (None, None), (9, "x\x0by\x0cz")]
    got = run(spark, rows)
    assert got == brute(rows)
    zero = {r[0]: r for r in got}
    assert zero[1][1] == zero[2][1] == "0" * 16 and zero[1][2] == 1


def test_hot_copies(spark, monkeypatch):
    monkeypatch.setattr(simhash, "HOT_ROWS", 3)
    rows = [(i, "the same words over and over " * 3) for i in range(10)] + list(enumerate(texts(5, 10), 100))
    assert run(spark, rows) == brute(rows)


def test_empty(spark):
    assert run(spark, []) == []


def test_first_set_and_tally():
    # Every pair of fingerprints agreeing on at least 4 bytes is emitted under exactly one position set.
    rnd = random.Random(1)
    for _ in range(300):
        agree = set(rnd.sample(range(8), rnd.randrange(4, 9)))
        first = sorted(agree)[:4]
        n = simhash._SETS.index(tuple(first))
        assert not simhash._before(n) & sum(1 << p for p in agree)
        assert sum(1 for k, s in enumerate(simhash._SETS) if set(s) <= agree and not simhash._before(k) & sum(1 << p for p in agree)) == 1
