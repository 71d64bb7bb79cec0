"""Bin packing: the tree, the packing, and slots of every row."""

import random
import zlib

from regionledger.llm import sharding


def test_tree_finds_the_tightest_room():
    rng, tree, plain = random.Random(1), sharding.Capacities(), []
    for i in range(2000):
        if plain and rng.random() < 0.5:
            size = rng.randint(0, 100)
            want = min((x for x in plain if x[0] >= size), default=None)
            assert tree.take(size) == want
            if want:
                plain.remove(want)
        else:
            plain.append((rng.randint(0, 100), i))
            tree.add(*plain[-1])


def test_best_fit_against_a_plain_search():
    rng = random.Random(5)
    for _ in range(200):
        sizes = sorted((rng.randint(1, 50) for _ in range(rng.randint(0, 40))), reverse=True)
        rooms, want = [], []
        for s in sizes:
            fits = [(r, b) for b, r in enumerate(rooms) if r >= s]
            if fits:
                b = min(fits)[1]
            else:
                rooms.append(60)
                b = len(rooms) - 1
            rooms[b] -= s
            want.append(b)
        assert sharding.best_fit(sizes, 60, 100) == want
        assert (sharding.best_fit(sizes, 60, len(rooms)) is not None) and (not rooms or sharding.best_fit(sizes, 60, len(rooms) - 1) is None)


def test_pack_is_even():
    rng = random.Random(3)
    sizes = sorted((rng.randint(1, 1000) for _ in range(3000)), reverse=True)
    load = [0] * 16
    for s, b in zip(sizes, sharding.pack(sizes, 16)):
        load[b] += s
    assert max(load) - min(load) <= 0.002 * sum(sizes) / 16
    # One group with a third of everything gets a shard of its own, and the others stay even.
    big = [sum(sizes) // 2, *sizes]
    load = [0] * 16
    for s, b in zip(big, sharding.pack(big, 16)):
        load[b] += s
    assert load[0] == big[0] and max(load[1:]) - min(load[1:]) <= 0.002 * sum(sizes) / 15
    assert sharding.pack([], 4) == [] and sharding.pack([5, 3], 4) == [0, 1]


def test_assign(spark, monkeypatch):
    monkeypatch.setattr(sharding, "CELL_ROWS", 7)
    rng = random.Random(8)
    rows = [(i % 150, "".join(rng.choice("aé ") for _ in range(rng.randint(0, 60)))) for i in range(300)]
    rows += [(1000 + i, "hot copy of a text") for i in range(200)] + [(None, None), (None, None), (7, ""), (7, "")]
    docs = spark.createDataFrame([(i, t, 0, "r") for i, t in rows], "doc_id long, text string, size int, rid string")
    got = sharding.assign(docs, 8).collect()
    want = sorted(((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows), key=repr)
    assert sorted(((r.doc_id, r.size, r.text_crc32) for r in got), key=repr) == want
    for s in range(8):
        assert sorted(r.slot for r in got if r.shard == s) == list(range(sum(r.shard == s for r in got)))
    assert len({r.shard for r in got if r.doc_id is not None and r.doc_id >= 1000}) == 1
    assert len({(r.size, r.text_crc32) for r in got if r.size > 1}) == len({(r.size, r.text_crc32, r.shard) for r in got if r.size > 1})


def test_empty_table(spark):
    assert sharding.assign(spark.createDataFrame([], "doc_id long, text string")).collect() == []
