"""Ragged TSV records against Python's csv reader with the same settings, over many splits."""

import csv
import io
import random

import pytest

from regionledger.sources import readers

HEADER = "ID\tSITE NAME\tSEGMENT\t20240131"


def reference(text):
    """Rows as a csv reader gives them below the header line: padded, glued, trailers and blanks skipped."""
    lines = text.split("\n", 1)
    rows = []
    for record in csv.reader(io.StringIO(lines[1], newline=""), delimiter="\t", quotechar='"', doublequote=True, escapechar="\\"):
        if not record or record[0].lower().startswith("total output lines"):
            continue
        if len(record) < 3:
            record = record + [""] * (3 - len(record))
        if len(record) > 3:
            record = record[:2] + ["\t".join(record[2:])]
        rows.append(tuple(record))
    return sorted(rows)


def body(seed, n):
    rnd = random.Random(seed)
    cells = ['pipe 5" works', '"quoted\ttab"', '"two\nlines"', '"say ""hi"""', "a\\\tb", '"esc \\" q"', "plain", "", '"x"y', 'in"ch', '"blank\n\nline"']
    out = []
    for i in range(n):
        k = rnd.randrange(1, 5)
        out.append("\t".join([str(i)] + [rnd.choice(cells) for _ in range(k)]))
    return "\n".join(out) + "\n"


def read(spark, tmp_path, text, split="128m"):
    (tmp_path / "f.txt").write_text(HEADER + "\n" + text, encoding="utf-8")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        rows, rejected = readers.ragged_tsv(spark, str(tmp_path), "SITE NAME")
        return sorted(tuple(r) for r in rows.collect()), [r[0] for r in rejected.collect()]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_inch_marks_keep_every_row(spark, tmp_path):
    text = 'ID1\tpipe 5" works\tA\nID2\tplain\tB\nID3\tplain\tC\nID4\tbolt 3" long\tD\nID5\tx\tE\n'
    rows, rejected = read(spark, tmp_path, text)
    assert rows == reference(HEADER + "\n" + text) and len(rows) == 5 and rejected == []


@pytest.mark.parametrize("seed", [1, 2])
def test_equal_to_csv_reader_in_many_splits(spark, tmp_path, seed):
    text = body(seed, 400)
    want = reference(HEADER + "\n" + text)
    whole = read(spark, tmp_path, text)
    assert whole == (want, [])
    assert read(spark, tmp_path, text, split="1k") == (want, [])


def test_every_line_in_a_row_or_a_reject(spark, tmp_path):
    text = body(3, 50) + 'X\t"never closed\nmore\nTotal output lines: 9\n'
    rows, rejected = read(spark, tmp_path, text, split="512")
    assert rejected == ['X\t"never closed', "more", "Total output lines: 9"]
    assert rows == reference(HEADER + "\n" + body(3, 50))


def test_long_record_is_rejected_line_by_line(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(readers, "FIELD_LIMIT", 20)
    text = 'A\t"first line\nsecond line\nthird"\tz\nB\tb\tc\n'
    rows, rejected = read(spark, tmp_path, text)
    assert rows == [("B", "b", "c")]
    assert sorted(rejected) == ['A\t"first line', "second line", 'third"\tz']
