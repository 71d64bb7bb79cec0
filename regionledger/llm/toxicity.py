"""Toxicity: subword-bag embeddings averaged into a linear softmax, trained jointly in numpy.

A word is the bag of its byte n-grams (with word marks) and of itself, hashed into buckets; a bucket has an
embedding. A window of three words is the average of all embeddings in it, and a two-class
softmax on that average gives its probability. A document is as toxic as its worst window,
so a single insult in a long text counts as much as in a short one. Embeddings and
softmax are trained together by gradient steps on each document's worst window.
Misspellings that were never seen share most n-grams with the word they come from.

The model is fitted on a bounded sample: `rows` documents at most of either label, chosen by a hash of the id,
each of at most `longest` bytes. Scoring covers every whole text. Only the text enters a score.

A null or blank text has the score of an empty bag. Null ids are never in the training part.
Repeated rows get equal scores. An empty table gives an empty result, and with no labels (or one label only)
every score is 0.5. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regionledger.llm import sample, words

FIT_ROWS = 2500
LONGEST = 1 << 16
BUCKETS = 1 << 19
WIDTH = 8
WINDOW = 3
GRAMS = (3, 4, 5, 6)
THRESHOLD = 0.7
#: First epochs, and the words of a text that they look at.
WARM, STRETCH = 8, 40


@dataclass
class Model:
    """What scoring needs: a bucket's embedding times the difference of the class weights."""

    pull: np.ndarray
    bias: float


def subwords(w: words.Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(buckets, bounds, which): per distinct word its buckets, and each word's distinct word."""
    distinct, first, which = np.unique(w.hashes, return_index=True, return_inverse=True)
    start, size = w.starts[first], w.ends[first] - w.starts[first]
    wide = size + 2
    begin = np.cumsum(wide) - wide
    data = np.empty(int(wide.sum()), np.uint64)
    data[begin], data[begin + wide - 1] = 1, 2
    inner = np.repeat(start - begin - 1, wide) + np.arange(len(data))
    body = np.ones(len(data), bool)
    body[begin] = body[begin + wide - 1] = False
    data[body] = words.lowered(w.data[inner[body]])
    left = np.repeat(begin + wide, wide) - np.arange(len(data))
    found, owner = [words.mix(distinct, 21)], [np.arange(len(distinct))]
    word = np.repeat(np.arange(len(distinct)), wide)
    for n in GRAMS:
        if len(data) < n:
            continue
        h = np.zeros(len(data) - n + 1, np.uint64)
        for j in range(n):
            h = h * np.uint64(0x100000001B3) + data[j : len(data) - n + 1 + j]
        ok = left[: len(h)] >= n
        found.append(words.mix(h[ok], n))
        owner.append(word[: len(h)][ok])
    owner = np.concatenate(owner)
    order = np.argsort(owner, kind="stable")
    buckets = (np.concatenate(found)[order] & np.uint64(BUCKETS - 1)).astype(np.int64)
    return buckets, np.searchsorted(owner[order], np.arange(len(distinct) + 1)), which


def _worst(sums: np.ndarray, counts: np.ndarray, first: np.ndarray, empty: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per text the largest mean over its windows, and that window's first and last word."""
    s, c = np.append(0.0, np.cumsum(sums)), np.append(0, np.cumsum(counts))
    n = np.diff(first)
    windows = np.maximum(n - WINDOW + 1, np.minimum(n, 1))
    text = np.repeat(np.arange(len(n)), windows)
    a = np.repeat(first[:-1] - (np.cumsum(windows) - windows), windows) + np.arange(windows.sum())
    b = np.minimum(a + WINDOW, first[1:][text])
    mean = (s[b] - s[a]) / np.maximum(c[b] - c[a], 1)
    out, lo, hi = np.full(len(n), empty), first[:-1].copy(), first[:-1].copy()
    some = np.flatnonzero(windows)
    if len(some):
        at = np.cumsum(windows) - windows
        top = np.maximum.reduceat(mean, at[some])
        hit = np.flatnonzero(mean == np.repeat(top, windows[some]))
        best = hit[np.unique(text[hit], return_index=True)[1]]
        out[some], lo[some], hi[some] = top, a[best], b[best]
    return out, lo, hi


def train(texts: list[str], toxic: np.ndarray, epochs: int = 60, rate: float = 8.0, seed: int = 5) -> Model:
    """Joint training; each step takes every document's worst window at the time."""
    if not len(texts) or toxic.all() or not toxic.any():
        return Model(np.zeros(BUCKETS), 0.0)
    seen: dict[bytes, int] = {}
    found = [[seen.setdefault(w, len(seen)) for w in t.encode().lower().split()] for t in texts]
    first = np.append(0, np.cumsum([len(f) for f in found]))
    which = np.concatenate([np.array(f, np.int32) for f in found])
    del found, texts
    # Word by word in slices, so that the n-grams' working arrays stay small.
    vocabulary, parts, own = list(seen), [], np.empty(len(seen), np.int32)
    del seen
    for i in range(0, len(vocabulary), 20_000):
        text = pa.array([b" ".join(vocabulary[i : i + 20_000]).decode()])
        part, edges, order = subwords(next(words.chunks(text, lower=True))[2])
        own[i : i + 20_000] = order + sum(len(x) for _, x in parts)
        parts.append((part.astype(np.int32), np.diff(edges)))
    buckets, sizes = (np.concatenate(x) for x in zip(*parts))
    bounds, which = np.append(0, np.cumsum(sizes)), own[which]
    del vocabulary, parts, own
    sizes, starts = np.diff(bounds).astype(np.int32), bounds[:-1]
    clean = np.flatnonzero(~toxic)
    rng = np.random.default_rng(seed)
    # From zero, so that a bucket that training never met says nothing.
    table = np.zeros((BUCKETS, WIDTH), np.float32)
    weight, bias = rng.normal(0, 1, WIDTH), 0.0
    top, g_weight, g_bias = 1e-12, np.full(WIDTH, 1e-12), 1e-12
    for epoch in range(epochs):
        pull = table @ weight
        if epoch < WARM:
            # No window stands out yet: the bag is a longer stretch from anywhere in the text.
            lo = rng.integers(first[:-1], np.maximum(first[1:] - STRETCH, first[:-1]) + 1)
            hi = np.minimum(lo + STRETCH, first[1:])
        else:
            own = np.add.reduceat(pull[buckets], starts)
            lo, hi = first[:-1].copy(), first[1:].copy()
            for d in range(0, len(lo), 100):
                part = first[d : d + 101]
                word = which[part[0] : part[-1]]
                _, a, b = _worst(own[word], sizes[word], part - part[0], 0.0)
                lo[d : d + 100], hi[d : d + 100] = a + part[0], b + part[0]
            # Harmless texts also show a window that is not their worst.
            more = rng.integers(first[:-1], np.maximum(first[1:] - WINDOW, first[:-1]) + 1)[clean]
            lo = np.append(lo, more)
            hi = np.append(hi, np.minimum(more + WINDOW, first[1:][clean]))
        n = hi - lo
        y = np.append(toxic.astype(float), np.zeros(len(n) - len(toxic)))
        share = np.where(y == 1, 0.5 / y.sum(), 0.5 / (1 - y).sum())
        doc = np.repeat(np.arange(len(n), dtype=np.int32), n)
        word = which[np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(n.sum())]
        k = sizes[word]
        doc = np.repeat(doc, k)
        gram = buckets[np.repeat(starts[word] - (np.cumsum(k) - k), k) + np.arange(k.sum())]
        count = np.maximum(np.bincount(doc, minlength=len(n)), 1)
        average = np.stack([np.bincount(doc, table[gram, d], len(n)) for d in range(WIDTH)], 1) / count[:, None]
        p = 1 / (1 + np.exp(-np.clip(average @ weight + bias, -30, 30)))
        error = (p - y) * share
        step = np.bincount(gram, (error / count)[doc], BUCKETS)
        to_weight, to_bias = error @ average, error.sum()
        # One scale for all buckets: what many texts agree on moves far, a rare bucket hardly.
        top = max(top, np.abs(step).max())
        moved = np.flatnonzero(step)
        table[moved] -= (rate * step[moved] / top)[:, None] * weight
        g_weight += to_weight**2
        g_bias += to_bias**2
        weight = weight - 0.1 * to_weight / np.sqrt(g_weight)
        bias -= 0.3 * to_bias / np.sqrt(g_bias)
    return Model((table @ weight).astype(np.float32), float(bias))


def scores(model: Model, w: words.Words) -> np.ndarray:
    buckets, bounds, which = subwords(w)
    own = np.add.reduceat(model.pull[buckets], bounds[:-1]) if len(buckets) else np.zeros(0)
    worst, _, _ = _worst(own[which], np.diff(bounds)[which], w.first, 0.0)
    return 1 / (1 + np.exp(-np.clip(worst + model.bias, -30, 30)))


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from training: crc32 of the id as text leaves 1 by 3."""
    return F.coalesce(F.pmod(F.crc32(F.encode(doc_id.cast("string"), "UTF-8")), F.lit(3)) == 1, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", rows: int = FIT_ROWS, longest: int = LONGEST) -> Model:
    """Fit on at most `rows` documents of either label, none of them held out."""
    known = (
        labels.select(F.col("doc_id").alias("id"), F.col(label).alias("y")).where("id IS NOT NULL AND y IN (0, 1)")
        .where(~held_out(F.col("id"))).groupBy("id").agg(F.max("y").alias("y"))
    )
    order = [F.xxhash64("id"), F.col("id")]
    chosen = sample.smallest_hashes(known.where("y = 1"), "id", rows).unionAll(sample.smallest_hashes(known.where("y = 0"), "id", rows))
    texts = docs.select(F.col("doc_id").alias("id"), F.col("text").alias("t")).where(F.octet_length("t") <= longest)
    # At most 2 * rows ids.
    got = texts.join(F.broadcast(chosen), "id").orderBy(*order, "t").limit(4 * rows).collect()
    texts, toxic = [r["t"] for r in got], np.array([r["y"] == 1 for r in got], bool)
    del got
    return train(texts, toxic)


def score(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and score of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [scores(shared.value, w) for _, _, w in words.chunks(batch.column("text"), lower=True)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(np.concatenate(out) if out else np.zeros(0))], ["doc_id", "score"])

    t = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return t.mapInArrow(of, "doc_id long, score double")
