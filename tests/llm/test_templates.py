"""Template leaks against a brute-force version and against re-parameterised questions."""

import random
import re

from regionledger.llm import templates

STRIP = ".,;:!?()[]{}\"'"


def template(text):
    out, before = [], False
    for w in re.findall(r"[^\x20\x09-\x0D]+", text or ""):
        for _ in range(3):
            if len(w) > 1 and w[0] in STRIP:
                w = w[1:]
            if len(w) > 1 and w[-1] in STRIP:
                w = w[:-1]
        low = w.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
        number = w[0] in "0123456789" or (w[0] in "+-$" and len(w) > 1 and w[1] in "0123456789") or low in templates.NUMBERS
        if number:
            kind = "<number>"
        elif before and low in templates.UNITS:
            kind = "<unit>"
        elif ("A" <= w[0] <= "Z" or "À" <= w[0] <= "Þ") and low not in templates.PLAIN:
            kind = "<name>"
        else:
            kind = None
        before = number
        out.append((kind or low, low if kind else None))
    return out


def brute(docs, items, k=templates.K):
    out = []
    for d, text in docs:
        t, hits = template(text), []
        for i, q in items:
            q = template(q)
            n = min(k, len(q))
            spots = {}
            for a in range(len(q) - n + 1 if n else 0):
                own = q[a : a + n]
                if 2 * sum(v is None for _, v in own) < n:
                    continue
                for p in range(len(t) - n + 1):
                    seen = t[p : p + n]
                    if [x for x, _ in own] == [x for x, _ in seen]:
                        spots.setdefault(p - a, []).append((a, {(x[1], y[1]) for x, y in zip(own, seen) if x[1] is not None}))
            for found in spots.values():
                cover = set().union(*(range(a, a + n) for a, _ in found))
                s = set().union(*(x for _, x in found))
                if len(cover) >= templates.COVER * len(q) and len({a for a, _ in s}) == len(s) == len({b for _, b in s}):
                    hits.append(i)
        out.append((d, sorted(set(hits))))
    return sorted(out, key=repr)


def run(spark, docs, items):
    d = spark.createDataFrame([(i, t, 1, "x") for i, t in docs], "doc_id long, text string, a int, print string")
    b = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, pos int")
    found = templates.matches(d, b)
    marked = sorted(((r.doc_id, r["items"]) for r in templates.mark(d, found).collect()), key=repr)
    left = sorted((r.doc_id for r in templates.clean(d, b).collect()), key=repr)
    assert left == sorted((i for i, x in marked if not x), key=repr)
    return marked


QUESTION = "Tom has 5 apples and buys 12 more for 3 dollars each, then Tom walks 7 km to see Anna. How many apples does Tom have?"


def test_changed_values_are_found_if_consistent(spark):
    items = [(1, QUESTION), (2, "What is the capital city of France today?"), (3, None), (4, ""), (5, "Who wrote it"), (5, "Who wrote it")]
    changed = QUESTION.replace("Tom", "Lisa").replace("Anna", "Olaf").replace("5 ", "81 ").replace("12 ", "4 ").replace("km", "miles")
    mixed = QUESTION.replace("Tom has", "Lisa has", 1)
    docs = [
        (10, "Some words before it. " + QUESTION + " And after."), (11, "so " + changed), (12, mixed), (13, QUESTION[:40]), (14, None), (15, ""),
        (None, "we ask: what is the capital city of Spain today? ok"), (16, "who wrote it and why"), (17, "what is the capital"), (10, "clean text"),
        (18, "He said: " + "word " * 3000 + changed), (18, "He said: " + "word " * 3000 + changed),
    ]
    got = run(spark, docs, items)
    assert got == brute(docs, items)
    hit = {i: x for i, x in got if i in (11, 12, 13, 18)}
    assert hit == {11: [1], 12: [], 13: [], 18: [1]}


def test_random_texts(spark):
    rng = random.Random(3)
    words = ["the", "of", "Ann", "Bob", "3", "44", "km", "red", "fox", "runs", "and", "Über", "(so)", "twelve"]
    items = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(1, 20)))) for i in range(25)]
    docs = []
    for i in range(120):
        w = [rng.choice(words) for _ in range(rng.randint(0, 30))]
        if rng.random() < 0.5:
            q = rng.choice(items)[1].split()
            w[len(w) // 2 : 0] = q[: rng.randint(1, len(q))]
        docs.append((i, " ".join(w)))
    assert run(spark, docs, items) == brute(docs, items)


def test_empty_tables(spark):
    assert run(spark, [], [(1, QUESTION)]) == []
    assert run(spark, [(1, QUESTION)], []) == [(1, [])]
