"""Vector codes against plain integer k-means with direct distances."""

import hashlib
import math
import random

import numpy as np
import pytest

from regionledger.llm import codes


def brute(rows):
    """rows: (vec_id, vector, label); returns {row index: (code, error)}, digest."""
    kept = [(i, r) for i, r in enumerate(rows) if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    if not kept:
        return {}, None
    ints = {i: [math.floor(4096 * float(x)) for x in r[1]] for i, r in kept}
    m = -(-max(len(v) for v in ints.values()) // 8)
    for v in ints.values():
        v.extend([0] * (8 * m - len(v)))
    order = sorted(kept, key=lambda t: (t[1][0] is None, t[1][0] if t[1][0] is not None else 0, ints[t[0]]))
    book = [[ints[i][p * m : (p + 1) * m] for i, _ in order[:16]] for p in range(8)]

    def assign(v, p):
        d = [sum((a - b) ** 2 for a, b in zip(v[p * m : (p + 1) * m], e)) for e in book[p]]
        k = min(range(len(d)), key=lambda j: (d[j], j))
        return k, d[k]

    for _ in range(6):
        for p in range(8):
            members = {}
            for i, v in ints.items():
                members.setdefault(assign(v, p)[0], []).append(v[p * m : (p + 1) * m])
            for k, vs in members.items():
                book[p][k] = [sum(c) // len(vs) for c in zip(*vs)]
    out = {}
    for i, v in ints.items():
        got = [assign(v, p) for p in range(8)]
        out[i] = ("".join(f"{k:02x}" for k, _ in got), sum(d for _, d in got))
    digest = hashlib.sha256(",".join(str(c) for p in book for e in p for c in e).encode()).hexdigest()
    return out, digest


def run(spark, rows):
    df = spark.createDataFrame([(r[0], r[1], r[2], i, "x") for i, r in enumerate(rows)], "vec_id long, embedding array<float>, label int, row int, codes string")
    book = codes.fit(df)
    got = codes.encode(df, book, keep=["row"]).collect()
    return {r.row: ("".join(f"{k:02x}" for k in r.codes), r.error) for r in got}, (book.digest if book else None)


def f32(x):
    return float(np.float32(x))


def vectors(seed, n, dim=16, spread=1.0):
    rnd = random.Random(seed)
    return [(rnd.randrange(1000), [f32(rnd.gauss(0, spread)) for _ in range(dim)], rnd.choice([0, 1, None])) for _ in range(n)]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_random_against_brute(spark, seed):
    rows = vectors(seed, 60)
    assert run(spark, rows) == brute(rows)


def test_odd_rows(spark):
    rows = vectors(4, 30, dim=8) + [
        (1, None, 0), (2, [f32(0.5), None] + [0.0] * 6, 1), (3, [float("nan")] * 8, 1), (4, [float("inf")] + [0.0] * 7, None),
        (5, [0.0] * 8, None), (5, [0.0] * 8, None), (None, [f32(0.25)] * 8, 2), (6, [f32(-0.001)] * 8, 2),
    ]
    got = run(spark, rows)
    assert got == brute(rows)
    assert not {30, 31, 32, 33} & set(got[0])  # null vector, null, NaN and infinite components are dropped
    assert got[0][35] == got[0][34]  # equal vectors, equal codes


def test_ties_short_and_mixed_lengths(spark):
    rows = [(i, [f32(0.5 * (i % 2))] * 8, 0) for i in range(5)] + [(9, [f32(0.25)] * 3, 1), (10, [], 1)]
    assert run(spark, rows) == brute(rows)


def test_fewer_than_sixteen_and_empty(spark):
    rows = vectors(5, 3, dim=24)
    assert run(spark, rows) == brute(rows)
    assert run(spark, [(1, None, 0)]) == ({}, None)
    assert run(spark, []) == ({}, None)


def test_nearest_is_exact():
    rnd = np.random.default_rng(7)
    for m in (1, 3, 8, 13):
        parts, entries = rnd.integers(-50, 50, (200, m)), rnd.integers(-50, 50, (16, m))
        entries[5] = entries[2]  # a tie goes to the lower index
        d = ((parts[:, None, :] - entries[None]) ** 2).sum(axis=2)
        k, dist = codes.nearest(parts, entries)
        assert (k == d.argmin(axis=1)).all() and (dist == d.min(axis=1)).all()


def test_query_twin_columns(spark):
    from regionledger.llm import registry

    out = registry.op11_vector_codes(spark, "/root/testdata/sf0.001")
    assert out.columns[:5] == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    rows = out.collect()
    assert rows and all(len(r.code) == 16 for r in rows)
    assert len({r.codebooks_sha256 for r in rows}) == 1
