"""Personal data: base spans against the stated patterns, the field's algebra and accuracy."""

import itertools
import random
import re

import numpy as np
import pytest

from regionledger.llm import pii


def brute(t):
    t = t or ""
    out = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t):
        out.append((m.start(), 0, m.end()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t):
        if all(int(p) <= 255 for p in m.group().split(".")):
            out.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = re.sub("[^0-9]", "", m.group())
        if 14 <= len(d) <= 19 and pii.luhn(d):
            out.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t):
        if 10 <= len(re.findall("[0-9]", m.group())) <= 15:
            out.append((m.start(), 3, m.end()))
    return sorted(out)


TEXTS = [
    None, "", "a@b.c", "a@b.c@d.e.f", "x..y@z-.q.-", "é@b.c ü.x@y.z", "a@b a@b. a@.b @c.d", "1.2.3.4.5.6.7.8", "256.1.1.1 0001.2.3.255 1.2.3", "1.2.3.4444444444",
    "4785380592391139", "4785 3805-9239 1139", "4785  380592391139", "+1 (988) 555-2485 x +12 345", "+1-2-3-4-5-6-7-8-9-0-", "😀 +49 171 1234567 😀 a.b@c.de", "1" * 3000, "a" * 3000 + "@", "+" * 50 + "1234567890 1",
    "1.2.3.4@x.y 9.9.9.9",
]


def test_base_spans():
    rng = random.Random(1)
    bits = ["a", "@", ".", "b.c", "1", "22", "255", "300", " ", "-", "+", "(", ")", "4785380592391139", "x@y.z", "é", "1.2.3.4"]
    for t in TEXTS + ["".join(rng.choice(bits) for _ in range(rng.randint(0, 25))) for _ in range(3000)]:
        assert pii.base_spans(t or "") == brute(t), t


def _segmentations(n, most, k):
    def of(i):
        if i == n:
            yield []
            return
        for j in range(i + 1, min(n, i + most) + 1):
            for label in range(k):
                if label or j == i + 1:
                    for rest in of(j):
                        yield [(i, label, j), *rest]

    yield from of(0)


@pytest.fixture(scope="module")
def small():
    rng = np.random.default_rng(0)
    weights, moves = rng.normal(size=(len(pii.LABELS), pii.N_FEATURES)), rng.normal(size=(len(pii.LABELS),) * 2)
    t = "call 555 123 now"
    return t, pii.tokens(t), weights, moves


def _score(lattice, seg, weights, moves):
    s = sum(weights[label, lattice[j - 1][j - i - 1]].sum() for i, label, j in seg)
    return s + sum(moves[a[1], b[1]] for a, b in itertools.pairwise(seg))


def test_decoding_is_the_best_of_all_segmentations(small):
    t, at, weights, moves = small
    lattice = pii._lattice(t, at)
    best = max(_segmentations(len(at), pii.MOST, len(pii.LABELS)), key=lambda s: _score(lattice, s, weights, moves))
    assert pii.decode(lattice, weights, moves) == [x for x in best if x[1]]


def test_gradient_is_that_of_the_likelihood(small):
    t, at, weights, moves = small
    lattice = pii._lattice(t, at)
    gold = [(0, 0, 1), (1, 4, 3), (3, 0, 4)]
    g_weights, g_moves = np.zeros_like(weights), np.zeros_like(moves)
    value = pii._gradient(lattice, gold, weights, moves, g_weights, g_moves)
    total = np.logaddexp.reduce([_score(lattice, s, weights, moves) for s in _segmentations(len(at), pii.MOST, len(pii.LABELS))])
    assert value == pytest.approx(_score(lattice, gold, weights, moves) - total)
    f = lattice[2][1][0]
    for array, grad, place in ((weights, g_weights, (4, f)), (moves, g_moves, (0, 4)), (moves, g_moves, (4, 0))):
        array[place] += 1e-5
        up = pii._gradient(lattice, gold, weights, moves, np.zeros_like(weights), np.zeros_like(moves))
        array[place] -= 2e-5
        down = pii._gradient(lattice, gold, weights, moves, np.zeros_like(weights), np.zeros_like(moves))
        array[place] += 1e-5
        assert grad[place] == pytest.approx((up - down) / 2e-5, abs=1e-6)


def test_held_out_accuracy():
    words = "the red fox runs over a lazy dog and then some more of it".split()
    weights, moves = pii.train([" ".join(words)])
    rng, right, wrong, extra = random.Random(77), 0, 0, 0
    for _ in range(400):
        label, text = pii._made(rng, words)
        t = f"{rng.choice(words)} {rng.choice(words)} {text} {rng.choice(words)} {rng.choice(words)}"
        a = len(t.split(text)[0])
        found = [(x, k - len(pii.BASE) + 1, y) for x, k, y in pii.field_spans(t, weights, moves)]
        if label:
            right += any(k == label and x <= a + 1 and y >= a + len(text) - 1 for x, k, y in found)
            wrong += 1
        else:
            extra += bool(found)
    assert right / wrong > 0.9
    assert extra / (400 - wrong) < 0.05


def test_rows(spark):
    rows = list(enumerate(TEXTS)) + [(3, TEXTS[3]), (None, "call (555) 123-4567 now")]
    docs = spark.createDataFrame([(i, t, 1, "s") for i, t in rows], "doc_id long, text string, kind int, start string")
    model = pii.fit(docs)
    got = pii.scan(docs, model).collect()
    assert len(got) == len(rows)
    base = sorted(((r.doc_id, [tuple(x) for x in r.found if x["kind"] < len(pii.BASE)]) for r in got), key=repr)
    assert base == sorted(((i, brute(t)) for i, t in rows), key=repr)
    for r in got:
        s = sorted((x["start"], x["end"]) for x in r.found if x["kind"] >= len(pii.BASE))
        assert all(a[1] <= b[0] for a, b in itertools.pairwise(s))
    assert pii.scan(docs.limit(0), model).collect() == []


@pytest.fixture(scope="module")
def trained():
    return pii.train(["call me at the office, the number is on the card", "write to the desk or ring the front", "room 12 on floor 3"] * 5)


def test_spelled_out_marks_are_looked_at_without_a_digit(trained):
    for t in ("write to anna{at}example.com now", "reach JOHN (AT) EXAMPLE.COM today", "mail bob [at] mail [dot] org"):
        alone, beside = pii.field_spans(t, *trained), pii.field_spans(t + " 7", *trained)
        assert alone == [s for s in beside if s[2] <= len(t)]


@pytest.mark.parametrize("before", [10, 399, 400, 401, 1234])
def test_long_stretches_are_decoded_whole(trained, before):
    tail = "call (555) 123 4567 or 4785 3805 9239 1139"
    t = " ".join(["7"] * before) + " " + tail
    near = pii.field_spans("7 " + tail, *trained)
    got = [(a - len(t) + len(tail), k, b - len(t) + len(tail)) for a, k, b in pii.field_spans(t, *trained) if b > len(t) - len(tail)]
    assert got == [(a - 2, k, b - 2) for a, k, b in near if b > 2]


def test_long_words_are_cut_at_marks():
    t = "a" * 250 + "(555)123-4567," + "b" * 10
    pieces = [t[a:b] for a, b in pii.tokens(t)]
    assert pieces == ["a" * 250, "555", "123-4567", "b" * 10]
    assert all(pii._TRIGGER.search(p) for p in pieces[1:3])
