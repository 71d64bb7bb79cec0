"""Substring dedup: windows of words that also start in an earlier document are removed.

Three passes over the texts, in numpy inside tasks, with Spark moving the rows:

1. Count-min prefilter. Each window of `k` words is anchored at the smallest fingerprint of
   the half-length word sequences inside it, so equal windows have equal anchors and
   neighbouring windows mostly share one. Every task lists its anchors' cells, once
   per document; the lists are merged slice by slice. The estimate for an anchor is never
   below the number of documents that hold a window with it.
2. Exact grouping. Only windows whose anchor is estimated to be in two documents or more go
   on, as runs of windows with a common anchor. A task settles first what it can itself:
   of equal windows it sends only those of the smallest document, and lists the others as
   repeats. Runs meet by anchor, where equal windows (96 bits of fingerprint) get their smallest
   document, and all others are listed as repeats.
3. The lists of repeats are joined to the documents, whose covered words are dropped.

The prefilter only saves work: whatever it lets through is grouped exactly, and it loses
nothing. Its width follows the input's bytes up to `max_cells`; beyond, more windows
are let through, with equal results.

Rules for odd input: a null text has no words. Rows with a null id neither lose words nor
make others lose any. Rows with equal ids count as one document, so they don't remove each
other's words; rows that are equal altogether get equal results. An empty table gives an empty
result. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regionledger.llm import sketch, words
from regionledger.sources import scratch

WINDOW = 50
MAX_CELLS = 1 << 28
#: Candidate windows a task gathers before it settles and sends them.
GATHER = 2_000_000
_RUNS = "anchor long, doc_id long, fp long, start int, n int, prints binary"


def _least(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of the `width` values from each position on (short at the end)."""
    done = 1
    while done * 2 <= width:
        x = np.minimum(x[:-done], x[done:]) if len(x) > done else x[:0]
        done *= 2
    rest = width - done
    return (np.minimum(x[:-rest], x[rest:]) if rest else x) if len(x) > rest else x[:0]


def _anchored(w: words.Words, k: int):
    """Starts of windows, their texts, anchors, and the indexes where a run begins."""
    whole = w.sequences(k)[1]
    at = np.flatnonzero(whole)
    half = (k + 1) // 2
    anchor = _least(w.sequences(half)[0][: len(whole) - half + 1], k - half + 1)[at]
    text = np.repeat(np.arange(len(w.first) - 1), w.counts)[at]
    new = np.ones(len(at), bool)
    new[1:] = (at[1:] != at[:-1] + 1) | (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])
    return at, text, anchor, np.flatnonzero(new)


def _items(k: int):
    """The anchors of a chunk, once per text."""

    def of(w: words.Words) -> np.ndarray:
        _, text, anchor, runs = _anchored(w, k)
        text, anchor = text[runs], anchor[runs]
        order = np.lexsort((anchor, text))
        text, anchor = text[order], anchor[order]
        first = np.ones(len(text), bool)
        first[1:] = (text[1:] != text[:-1]) | (anchor[1:] != anchor[:-1])
        return anchor[first]

    return of


def _settle(h: np.ndarray, h2: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """For each window whether an equal one is in a document with a smaller id."""
    order = np.lexsort((doc, h2, h))
    h, h2, d = h[order], h2[order], doc[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (h2[1:] != h2[:-1])
    least = d[new][np.cumsum(new) - 1]
    out = np.empty(len(h), bool)
    out[order] = d > least
    return out


def _rows(run: np.ndarray, start: np.ndarray, doc_id, fp, anchor=None, h=None, h2=None) -> pa.RecordBatch:
    """Rows for maximal runs of windows: `run` numbers the run each window came from."""
    new = np.ones(len(run), bool)
    new[1:] = (run[1:] != run[:-1]) | (start[1:] != start[:-1] + 1)
    at = np.flatnonzero(new)
    n = np.diff(np.append(at, len(run)))
    if anchor is not None:
        prints = np.empty(len(h), np.dtype([("h", "<u8"), ("h2", "<u4")]))
        prints["h"], prints["h2"] = h, h2
        offsets = np.append(at, len(run)).astype(np.int32) * 12
        blob = pa.Array.from_buffers(pa.binary(), len(at), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(prints.tobytes())])
        anchors = pa.array(anchor[at].view(np.int64))
    else:
        blob, anchors = pa.nulls(len(at), pa.binary()), pa.nulls(len(at), pa.int64())
    return pa.RecordBatch.from_arrays(
        [anchors, pa.array(doc_id[at]), pa.array(fp[at]), pa.array(start[at].astype(np.int32)), pa.array(n.astype(np.int32)), blob],
        ["anchor", "doc_id", "fp", "start", "n", "prints"],
    )


def _candidates(bits, k: int, cells: int):
    """Runs of windows that may be repeated: to be grouped by anchor, or settled (null anchor)."""

    def flush(parts: list[tuple]) -> Iterator[pa.RecordBatch]:
        doc, fp, run, start, anchor, h, h2 = (np.concatenate(x) for x in zip(*parts))
        run = np.cumsum(np.append(True, run[1:] != run[:-1]))
        known = _settle(h, h2, doc)
        for repeated in (True, False):
            m = known == repeated
            if m.any():
                more = () if repeated else (anchor[m], h[m], h2[m])
                yield _rows(run[m], start[m], doc[m], fp[m], *more)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = bits.value
        gathered, n, serial = [], 0, 0
        for batch in batches:
            ids, fps = batch.column("doc_id").to_numpy(), batch.column("fp").to_numpy()
            for a, b, w in words.chunks(batch.column("text")):
                at, text, anchor, runs = _anchored(w, k)
                if not len(at):
                    continue
                often = sketch.holds(rows, anchor[runs], cells)
                size = np.diff(np.append(runs, len(at)))
                m = np.repeat(often, size)
                run = np.repeat(np.arange(len(runs)), size)[m] + serial
                serial += len(runs)
                at, text = at[m], text[m]
                gathered.append((
                    ids[a:b][text], fps[a:b][text], run, at - w.first[text], anchor[m],
                    w.sequences(k)[0][at], w.sequences(k, 1)[0][at].astype(np.uint32),
                ))
                n += len(at)
                if n >= GATHER:
                    yield from flush(gathered)
                    gathered, n = [], 0
        if n:
            yield from flush(gathered)

    return of


def _grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by anchor: the settled ones as they are, the others as far as repeated."""

    def settle(t: pa.Table) -> pa.RecordBatch | None:
        n = t["n"].to_numpy()
        prints = np.frombuffer(b"".join(t["prints"].to_pylist()), np.dtype([("h", "<u8"), ("h2", "<u4")]))
        # Equal windows have equal anchors; the anchor need not be compared.
        doc, fp = np.repeat(t["doc_id"].to_numpy(), n), np.repeat(t["fp"].to_numpy(), n)
        repeated = _settle(prints["h"], prints["h2"], doc)
        run = np.repeat(np.arange(len(n)), n)
        start = np.repeat(t["start"].to_numpy() - (np.cumsum(n) - n), n) + np.arange(n.sum())
        return _rows(run[repeated], start[repeated], doc[repeated], fp[repeated]) if repeated.any() else None

    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        settled = batch.column("anchor").is_null()
        if settled.true_count:
            yield batch.filter(settled)
            batch = batch.filter(pc.invert(settled))
        if not len(batch):
            continue
        anchor = batch.column("anchor").to_numpy()
        size += batch.column("n").to_numpy().sum()
        if size < GATHER or anchor[0] == anchor[-1]:
            held.append(batch)
            continue
        cut = int(np.searchsorted(anchor, anchor[-1]))
        out = settle(pa.Table.from_batches([*held, batch.slice(0, cut)]))
        if out is not None:
            yield out
        held = [batch.slice(cut)]
        size = held[0].column("n").to_numpy().sum()
    if held:
        out = settle(pa.Table.from_batches(held))
        if out is not None:
            yield out


def _kept(k: int):
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total, removed, texts = [], [], []
            for text, runs in zip(batch.column("text"), batch.column("runs")):
                found = (text.as_py() or "").encode().split()
                total.append(len(found))
                if runs.is_valid:
                    r = np.asarray(runs.values)
                    start, n = r >> 32, r & 0xFFFFFFFF
                    edge = np.zeros(len(found) + 1, np.int32)
                    np.add.at(edge, start, 1)
                    np.add.at(edge, start + n + k - 1, -1)
                    stay = np.cumsum(edge)[:-1] == 0
                    found = [x for x, s in zip(found, stay.tolist()) if s]
                removed.append(total[-1] - len(found))
                texts.append(b" ".join(found))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(total, pa.int64()), pa.array(removed, pa.int64()), pa.array(texts, pa.binary()).cast(pa.string())],
                ["doc_id", "n_words", "n_removed", "kept"],
            )

    return of


def dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", k: int = WINDOW, max_cells: int = MAX_CELLS) -> DataFrame:
    """doc_id, n_words, n_removed and the kept words, joined by one space, of every row."""
    spark = docs.sparkSession
    t = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"), F.xxhash64(text).alias("fp"))
    known = t.where(F.col("doc_id").isNotNull())
    size = known.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    # About an anchor for every 13 words.
    cells = sketch.cells_for(size / 88, max_cells)
    bits = spark.sparkContext.broadcast(sketch.twice(known, _items(k), cells))
    runs = known.mapInArrow(_candidates(bits, k, cells), _RUNS)
    # Rows that are settled already are dealt by document, not to one task.
    meet = F.coalesce("anchor", F.xxhash64("doc_id", "start"))
    repeats = runs.repartition(meet).sortWithinPartitions("anchor").mapInArrow(_grouped, _RUNS)
    packed = scratch.materialise(repeats.select("doc_id", "fp", (F.col("start").cast("long") * (1 << 32) + F.col("n")).alias("run")))
    listed = packed.groupBy(F.col("doc_id").alias("d"), F.col("fp").alias("f")).agg(F.collect_list("run").alias("runs"))
    joined = t.join(listed, (t["doc_id"] == listed["d"]) & (t["fp"] == listed["f"]), "left")
    return joined.select("doc_id", "text", "runs").mapInArrow(_kept(k), "doc_id long, n_words long, n_removed long, kept string")
