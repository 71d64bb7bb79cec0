"""Separator scan: round trips through flat files, and blocks of every size."""

import re

import numpy as np
import pytest

from regionledger.llm import tokens
from regionledger.sources import scratch

ROWS = [(3, "a b c"), (1, ""), (None, "x y"), (-5, None), (2**62 + 11, "é  ü\tb\x0bc"), (3, "a b c"), (7, "w " * 5000), (0, "z"), (None, None)]


def words(t):
    return len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))


@pytest.mark.parametrize("block", [1, 2, 3, 7, 64, 1 << 20])
def test_round_trip(spark, block):
    docs = spark.createDataFrame([(i, t, 1) for i, t in ROWS], "doc_id long, text string, bits int")
    path = f"{scratch.folder(spark)}/t"
    tokens.write(docs, path, rows_per_file=2)
    got = tokens.count(spark, path, block=block).collect()
    assert sorted(((r.doc_id, r.n_tokens) for r in got), key=repr) == sorted(((i, words(t)) for i, t in ROWS), key=repr)
    assert all(r.closed for r in got)
    for f in {r.file for r in got}:
        assert sorted(r.number for r in got if r.file == f) == list(range(sum(r.file == f for r in got)))


def test_flat_file_without_a_last_separator(spark, tmp_path):
    ids = np.array([5, 6, 9, 0, 0, 7, 9, 9], "<u4")
    ids.tofile(tmp_path / "a.bin")
    np.array([], "<u4").tofile(tmp_path / "b.bin")
    for block in (1, 2, 3, 100):
        got = sorted((r.number, r.start, r.n_tokens, r.closed) for r in tokens.count(spark, str(tmp_path), block=block).collect())
        assert got == [(0, 0, 3, True), (1, 4, 0, True), (2, 5, 3, False)]


def test_other_separator(spark, tmp_path):
    np.array([1, 2, 50256, 3, 50256], "<u4").tofile(tmp_path / "a.bin")
    got = sorted((r.number, r.n_tokens) for r in tokens.count(spark, str(tmp_path), end=50256, block=2).collect())
    assert got == [(0, 2), (1, 1)]


def test_empty_table(spark):
    path = f"{scratch.folder(spark)}/t"
    tokens.write(spark.createDataFrame([], "doc_id long, text string"), path)
    assert tokens.count(spark, path).collect() == []
