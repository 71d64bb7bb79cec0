"""Words of many texts as flat arrays: one vectorised pass over an Arrow batch.

A word is a maximal run of bytes other than space and \\x09-\\x0D. Words and word
sequences are told apart by 64-bit fingerprints: a polynomial modulo 2^64, computed for
every word and every sequence from prefix sums, then mixed. Two different words or
sequences share a fingerprint with a probability of about 2^-63.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Odd, and 3 modulo 4, so that neighbours that swap places lose one bit only.
_BYTE_BASE = 0x9E3779B97F4A7C17
_WORD_BASE = 0xC2B2AE3D27D4EB4F
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Bytes of text handled at once; a longer text is handled alone.
CHUNK_BYTES = 1 << 20


class _Powers:
    """Powers of a base and of its inverse modulo 2^64, grown on demand."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 2 * len(self.up))
            self.up, self.down = (
                np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(size - 1, b, np.uint64))])
                for b in (self.base, self.inverse)
            )
        return self.up[:n], self.down[:n]


_BYTES, _WORDS = _Powers(_BYTE_BASE), _Powers(_WORD_BASE)


def mix(h: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijection of 64 bits that spreads every input bit over all output bits."""
    h = h + np.uint64((0x9E3779B97F4A7C15 * (2 * int(seed) + 1)) & (2**64 - 1))
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def spanned(hashes: np.ndarray, at: np.ndarray, size: np.ndarray) -> np.ndarray:
    """A fingerprint of `size` words from each `at` on; that of a single word is its own."""
    up, down = _WORDS.upto(len(hashes) + 1)
    sums = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(hashes * up[: len(hashes)], out=sums[1:])
    return np.where(size == 1, hashes[at], mix((sums[at + size] - sums[at]) * down[at] + size.astype(np.uint64)))


class Words:
    """Flat words of a chunk of texts.

    `starts`, `ends`: byte positions in `data`; `first`: for each text the index of its
    first word, and the number of words at the end; `hashes`: a fingerprint per word.
    """

    def __init__(self, data: np.ndarray, bounds: np.ndarray, lower: bool):
        self.data, self.bounds = data, bounds
        inside = ~_BLANK[data]
        edge = np.zeros(len(data) + 1, bool)
        edge[bounds] = True
        left = inside.copy()
        left[1:] &= ~inside[:-1] | edge[1:-1]
        right = inside.copy()
        right[:-1] &= ~inside[1:] | edge[1:-1]
        self.starts = np.flatnonzero(left)
        self.ends = np.flatnonzero(right) + 1
        self.first = np.searchsorted(self.starts, bounds)
        up, down = _BYTES.upto(len(data) + 1)
        values = (_LOWER[data] if lower else data).astype(np.uint64) + np.uint64(1)
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(values * up[: len(data)], out=sums[1:])
        self._sums, self._down = sums, down
        self.hashes = self.prints(self.starts, self.ends)

    def prints(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Fingerprints of the bytes from `starts` to `ends`."""
        size = (ends - starts).astype(np.uint64)
        raw = (self._sums[ends] - self._sums[starts]) * self._down[starts]
        return mix(raw ^ (size * np.uint64(0xD6E8FEB86659FD93)))

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def sequences(self, k: int, seed: int = 0, hashes: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Fingerprint of the k words from each word on, and whether they are in one text.

        `hashes` stand in for the words' own.
        """
        hashes = self.hashes if hashes is None else hashes
        n = len(hashes)
        out = np.zeros(n, np.uint64)
        m = n - k + 1
        ok = np.zeros(n, bool)
        if m <= 0:
            return out, ok
        up, down = _WORDS.upto(n + 1)
        h = mix(hashes, seed) if seed else hashes
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(h * up[:n], out=sums[1:])
        out[:m] = mix((sums[k:] - sums[:-k]) * down[:m] + np.uint64(k), seed)
        last = np.repeat(self.first[1:], self.counts)
        ok[:m] = np.arange(k, n + 1) <= last[:m]
        return out, ok

    def shingles(self, k: int) -> Iterator[np.ndarray]:
        """Per text: sorted distinct fingerprints of k words, or of all if there are fewer."""
        full, _ = self.sequences(k)
        for a, b in zip(self.first[:-1], self.first[1:]):
            n = b - a
            if n >= k:
                yield np.unique(full[a : b - k + 1])
            elif n:
                h = np.uint64(0)
                for x in self.hashes[a:b]:
                    h = mix(np.array([h ^ x]), n)[0]
                yield np.array([h], np.uint64)
            else:
                yield np.empty(0, np.uint64)


#: Rows that are looked at together, so that no copy of a whole batch is made.
SLICE_ROWS = 256


def chunks(column: pa.Array | pa.ChunkedArray, lower: bool = False) -> Iterator[tuple[int, int, Words]]:
    """(from, to, words of the texts from..to), in order; a null text has no words."""
    for begin in range(0, len(column), SLICE_ROWS):
        part = column.slice(begin, SLICE_ROWS)
        if isinstance(part, pa.ChunkedArray):
            part = part.combine_chunks()
        part = part.fill_null("").cast(pa.large_string())
        offsets = np.frombuffer(part.buffers()[1], np.int64)[part.offset : part.offset + len(part) + 1]
        data = np.frombuffer(part.buffers()[2] or b"", np.uint8)
        at = 0
        while at < len(part):
            to = int(np.searchsorted(offsets, offsets[at] + CHUNK_BYTES, "right")) - 1
            to = min(max(to, at + 1), len(part))
            piece = data[offsets[at] : offsets[to]]
            yield begin + at, begin + to, Words(piece, offsets[at : to + 1] - offsets[at], lower)
            at = to


def lowered(data: np.ndarray) -> np.ndarray:
    """Bytes with A-Z in lower case."""
    return _LOWER[data]
