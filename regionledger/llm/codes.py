"""Vector code compression: product quantisation by integer k-means.

A vector's components become integers floor(4096 * x); the vector is cut into `PARTS`
equal consecutive parts, and each part position has its own codebook of up to `ENTRIES`
entries. The codebooks start as the parts of the kept rows with the smallest vec_ids;
every round assigns each part to its nearest entry and moves every used entry to the
componentwise floor of the mean of its parts. Everything is integer arithmetic.

The nearest entry is found without floating point: parts and entries are zero-padded to a
power of two and put through an unnormalised Walsh-Hadamard transform (integer butterflies),
which scales every squared distance by the padded length exactly. The scaled squared
differences are then summed coefficient by coefficient in sequency order (fewest sign
changes first, where smooth parts hold their weight); an entry is dropped as soon as its
partial sum exceeds the full distance of a first candidate (the entry closest on the
first coefficient). Sums only grow, so no dropped entry can be nearest, and the
survivors' full sums decide: smallest distance, ties to the lower index.

Spark does the work: each round is one pass over the vectors in Arrow batches
(`mapInPandas`) that sums parts per (part, entry) inside the task, and a grouped sum of
at most PARTS x ENTRIES rows per task; the driver only holds the codebooks, whose size is
PARTS x ENTRIES x part length and so does not grow with the rows.

Defined results for odd input: rows whose vector is null or holds a null, NaN or infinite
component are dropped. Vectors shorter than the longest kept one are padded with zeros,
and the dimension is rounded up to a multiple of PARTS (an empty vector is all padding).
Fewer than ENTRIES kept rows give as many entries as rows; an empty table gives an empty
result. Equal vec_ids are ordered by their integer vector for the starting codebook and
are otherwise separate rows; equal vectors give equal codes. Other input columns are
passed through by name only if asked for (`keep`), so clashing names do not matter.
Exact while |floor(4096 x)| < 2^27 (sums of squares stay within 64 bits).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the contract: parts, entries, rounds and the integer scale.
PARTS = 8
ENTRIES = 16
ROUNDS = 6
SCALE = 4096


def integers(embedding: Column) -> Column:
    """floor(4096 * x) of every component, as longs."""
    return F.transform(embedding, lambda x: F.floor(x.cast("double") * SCALE).cast("long"))


def usable(embedding: Column) -> Column:
    """True for a vector without null, NaN or infinite components."""
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf"))
    return embedding.isNotNull() & ~F.exists(embedding, bad)


@dataclass(frozen=True)
class Codebook:
    """entries[p, k, j]: component j of entry k of part p; `length`: components of a part."""

    entries: np.ndarray

    @property
    def length(self) -> int:
        return self.entries.shape[2]

    @property
    def digest(self) -> str:
        """sha256 of all components by part, entry and position, comma-joined."""
        return hashlib.sha256(",".join(str(int(v)) for v in self.entries.ravel()).encode()).hexdigest()


def _padded(length: int) -> int:
    return 1 << max(0, length - 1).bit_length()


def transform(x: np.ndarray) -> np.ndarray:
    """Unnormalised Walsh-Hadamard transform over the last axis (a power of two), in integers."""
    x = np.array(x, dtype=np.int64)
    n, h = x.shape[-1], 1
    while h < n:
        y = x.reshape(*x.shape[:-1], n // (2 * h), 2, h)
        x = np.stack([y[..., 0, :] + y[..., 1, :], y[..., 0, :] - y[..., 1, :]], axis=-2).reshape(x.shape)
        h *= 2
    return x


def sequency(n: int) -> np.ndarray:
    """Coefficient indexes of the natural-order transform, by the sign changes of their rows."""
    rows = transform(np.eye(n, dtype=np.int64))
    changes = (np.diff(np.sign(rows), axis=1) != 0).sum(axis=1)
    return np.argsort(changes, kind="stable")


def nearest(parts: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest entry for every part, and its squared distance.

    `parts` (n, m) and `entries` (K, m) are integer; the search runs on transformed,
    padded copies with early elimination, as the module says.
    """
    n, m = parts.shape
    size = _padded(m)
    pad = lambda a: np.pad(a.astype(np.int64), ((0, 0), (0, size - m)))
    x, c = transform(pad(parts)), transform(pad(entries))
    order = sequency(size)
    first = order[0]
    guess = np.abs(x[:, first, None] - c[None, :, first]).argmin(axis=1)
    bound = ((x - c[guess]) ** 2).sum(axis=1)
    rows = np.repeat(np.arange(n), len(c))
    ks = np.tile(np.arange(len(c)), n)
    acc = np.zeros(len(rows), np.int64)
    for j in order:
        acc += (x[rows, j] - c[ks, j]) ** 2
        alive = acc <= bound[rows]
        rows, ks, acc = rows[alive], ks[alive], acc[alive]
    pick = np.lexsort((ks, acc, rows))
    rows, ks, acc = rows[pick], ks[pick], acc[pick]
    head = np.ones(len(rows), bool)
    head[1:] = rows[1:] != rows[:-1]
    best, dist = np.zeros(n, np.int64), np.zeros(n, np.int64)
    best[rows[head]], dist[rows[head]] = ks[head], acc[head] // size
    return best, dist


def _matrix(column: pd.Series, width: int) -> np.ndarray:
    out = np.zeros((len(column), width), np.int64)
    for i, v in enumerate(column):
        out[i, : len(v)] = v
    return out


def _encode(ints: np.ndarray, book: Codebook) -> tuple[np.ndarray, np.ndarray]:
    """Codes (n, PARTS) and squared distances (n, PARTS) of integer vectors."""
    m = book.length
    codes = np.zeros((len(ints), PARTS), np.int64)
    dists = np.zeros((len(ints), PARTS), np.int64)
    for p in range(PARTS):
        codes[:, p], dists[:, p] = nearest(ints[:, p * m : (p + 1) * m], book.entries[p])
    return codes, dists


def _prepared(vectors: DataFrame, column: str, key: str) -> DataFrame:
    return vectors.where(usable(F.col(column))).select(F.col(key).alias("_key"), integers(F.col(column)).alias("_ints"))


def fit(vectors: DataFrame, column: str = "embedding", key: str = "vec_id", rounds: int = ROUNDS) -> Codebook | None:
    """The codebooks after `rounds` rounds; None for a table without usable vectors."""
    ints = _prepared(vectors, column, key)
    longest = ints.agg(F.max(F.size("_ints"))).first()[0]
    if longest is None:
        return None
    m = -(-longest // PARTS)
    start = ints.orderBy(F.col("_key").asc_nulls_last(), "_ints").limit(ENTRIES).collect()
    seed = _matrix(pd.Series([r["_ints"] for r in start], dtype=object), m * PARTS)
    book = Codebook(seed.reshape(len(start), PARTS, m).transpose(1, 0, 2).copy())
    names = [f"s{j}" for j in range(m)]
    schema = "part int, entry int, n long" + "".join(f", {s} long" for s in names)

    for _ in range(rounds):
        def tally(batches: Iterator[pd.DataFrame], book: Codebook = book) -> Iterator[pd.DataFrame]:
            sums = np.zeros((PARTS, len(book.entries[0]), m), np.int64)
            counts = np.zeros((PARTS, len(book.entries[0])), np.int64)
            for batch in batches:
                x = _matrix(batch["_ints"], m * PARTS)
                codes, _ = _encode(x, book)
                for p in range(PARTS):
                    np.add.at(sums[p], codes[:, p], x[:, p * m : (p + 1) * m])
                    np.add.at(counts[p], codes[:, p], 1)
            p, k = np.nonzero(counts)
            frame = pd.DataFrame({"part": p.astype(np.int32), "entry": k.astype(np.int32), "n": counts[p, k]})
            for j, s in enumerate(names):
                frame[s] = sums[p, k, j]
            yield frame

        moved = ints.mapInPandas(tally, schema).groupBy("part", "entry").agg(
            F.sum("n").alias("n"), *[F.sum(s).alias(s) for s in names]
        ).collect()
        entries = book.entries.copy()
        for r in moved:
            entries[r["part"], r["entry"]] = [int(r[s]) // int(r["n"]) for s in names]
        book = Codebook(entries)
    return book


def encode(vectors: DataFrame, book: Codebook | None, column: str = "embedding", keep: list[str] | tuple[str, ...] = ()) -> DataFrame:
    """Usable rows with `codes` (array of entry indexes by part) and `error` (summed squared distances).

    `keep` columns of the input ride along unchanged.
    """
    kept = vectors.where(usable(F.col(column)))
    carried = [F.col(c).alias(f"_keep{i}") for i, c in enumerate(keep)]
    fields = ", ".join(f"_keep{i} {kept.schema[c].dataType.simpleString()}" for i, c in enumerate(keep))
    schema = (fields + ", " if fields else "") + "codes array<int>, error long"
    if book is None:
        return kept.sparkSession.createDataFrame([], schema).select(*[F.col(f"_keep{i}").alias(c) for i, c in enumerate(keep)], "codes", "error")
    width = book.length * PARTS

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            codes, dists = _encode(_matrix(batch["_ints"], width), book)
            out = batch.drop(columns="_ints")
            out["codes"] = list(codes.astype(np.int32))
            out["error"] = dists.sum(axis=1)
            yield out

    return kept.select(*carried, integers(F.col(column)).alias("_ints")).mapInPandas(run, schema).select(
        *[F.col(f"_keep{i}").alias(c) for i, c in enumerate(keep)], "codes", "error"
    )


def hex_code(codes: Column) -> Column:
    """Entry indexes as two lowercase hex digits each, in part order."""
    return F.array_join(F.transform(codes, lambda k: F.lpad(F.lower(F.hex(k)), 2, "0")), "")
