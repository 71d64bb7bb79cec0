"""What the heavy-light join leaves on disk: keys per text, tables nobody reads any more, shuffle files."""

import os
import random
import time

import numpy as np
import pytest

from regionledger.llm import jaccard
from regionledger.sources import scratch


def folder_of(df):
    return os.path.dirname(df.inputFiles()[0].removeprefix("file://"))


def shuffle_files(spark):
    files = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllFiles()
    return {str(files.apply(i)) for i in range(files.size()) if "/shuffle_" in str(files.apply(i))}


def test_the_boundary_does_not_grow_with_the_table():
    sizes = [(n, 100) for n in range(1, 1000)]
    like = jaccard.Likeness()
    # Mean counts of a used counter as on 6 GB and on 30 GB, when all counters are in use.
    assert jaccard.boundary(sizes, like, 360.0) == jaccard.boundary(sizes, like, 1800.0) == jaccard.boundary(sizes, like, 16.0)
    assert jaccard.boundary(sizes, like, 1.0) <= jaccard.boundary(sizes, like, 16.0)


@pytest.mark.parametrize("like", [jaccard.Likeness(), jaccard.Likeness(5, 4, 5)])
def test_texts_of_usual_length_are_heavy_on_any_table(like):
    # 470 shingles a text; the mean count of a used counter as on 0.1 GB, 0.5 GB and 6 GB.
    for length in (5.7, 30.0, 384.0):
        assert jaccard.boundary([(470, 3_000_000)], like, length) <= 470


def test_full_counters_do_not_multiply_the_keys(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "COUNTERS", 64)
    asked = []
    cells_for = jaccard.sketch.cells_for
    monkeypatch.setattr(jaccard.sketch, "cells_for", lambda items, most: asked.append(items) or cells_for(items, most))
    rng = random.Random(4)
    texts = [" ".join(f"w{rng.randrange(5000)}" for _ in range(200)) for _ in range(400)]
    docs = spark.createDataFrame(list(enumerate([*texts, texts[0] + " end"])), "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in jaccard.groups(docs).collect()}
    assert got == {**{i: i for i in range(400)}, 400: 0}
    # Sets of 197 shingles post 30 single ones each, not their 465 pairs.
    assert asked[0] <= 31 * 401


def test_counts_survive_their_packing():
    counts = np.array([0, 1, 255, 256, 70_000, 2**32 - 1], np.uint32)
    assert jaccard._of_planes(jaccard._planes(counts)).tolist() == counts.tolist()


def test_materialise_leaves_no_shuffle_files(spark):
    before = shuffle_files(spark)
    setting = spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", None)
    made = scratch.materialise(spark.range(1000).groupBy("id").count())
    for _ in range(50):
        if not shuffle_files(spark) - before:
            break
        time.sleep(0.2)
    assert not shuffle_files(spark) - before
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", None) == setting
    assert made.count() == 1000


def test_drop(spark, tmp_path):
    gone, stays = scratch.materialise(spark.range(3)), scratch.materialise(spark.range(4))
    paths = folder_of(gone), folder_of(stays)
    scratch.drop(gone)
    assert not os.path.exists(paths[0]) and os.path.exists(paths[1])
    assert stays.count() == 4
    spark.range(2).write.parquet(str(tmp_path / "table"))
    with pytest.raises(ValueError):
        scratch.drop(spark.read.parquet(str(tmp_path / "table")))
    assert spark.read.parquet(str(tmp_path / "table")).count() == 2


def test_join_keeps_no_sets_counts_or_entries(spark, monkeypatch):
    kept = []
    write = scratch.materialise

    def recorded(df):
        kept.append(write(df))
        return kept[-1]

    monkeypatch.setattr(scratch, "materialise", recorded)
    texts = [" ".join([*(f"w{i}" for i in range(80)), f"end{c}"]) for c in range(4)]
    members, links = jaccard.join(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    assert members.count() == 4 and links.count() == 6
    for column in ("counts", "members", "far"):
        tables = [t for t in kept if column in t.columns]
        assert tables and not any(t.inputFiles() and os.path.exists(folder_of(t)) for t in tables)
    entries = [t for t in kept if set(t.columns) == {"key", "cls", "subset", "n", "pos"}]
    assert not os.path.exists(folder_of(entries[0]))
