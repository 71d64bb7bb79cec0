"""Bit sketches built by tasks, merged slice by slice and sent to every task."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from regionledger.llm import words

#: Cells of a slice: what one merging step holds in memory, in bytes.
SLICE = 1 << 20
DEPTH = 2
LISTED = "row int, slice int, blob binary"
_SCHEMA = pa.schema([("row", pa.int32()), ("slice", pa.int32()), ("blob", pa.binary())])


def cells_for(items: float, most: int) -> int:
    """A power of two of about four cells for each item, at most `most`."""
    return 1 << max(16, min(int(most).bit_length() - 1, int(4 * items).bit_length()))


def cell(items: np.ndarray, row: int, cells: int) -> np.ndarray:
    return words.mix(items, row + 2) & np.uint64(cells - 1)


def listed(items: np.ndarray, cells: int) -> pa.RecordBatch:
    """The cells of `items` in every row of the sketch, one compressed list per slice."""
    pack = zstandard.ZstdCompressor(1)
    out: dict[str, list] = {"row": [], "slice": [], "blob": []}
    for row in range(DEPTH):
        at = np.sort(cell(items, row, cells)).astype(np.int64)
        edges = np.searchsorted(at, np.arange(0, max(cells, SLICE) + 1, SLICE))
        for s in np.flatnonzero(np.diff(edges)):
            steps = np.diff(at[edges[s] : edges[s + 1]] - s * SLICE, prepend=0).astype(np.uint32)
            out["row"].append(row)
            out["slice"].append(int(s))
            out["blob"].append(pack.compress(steps.tobytes()))
    return pa.RecordBatch.from_pydict(out, _SCHEMA)


def bits(lists: DataFrame, cells: int, least: int) -> list[np.ndarray]:
    """Per row a bit for every cell that is listed `least` (1 or 2) times or more.

    The result is bounded: DEPTH * cells bits.
    """
    size = min(SLICE, cells)

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        sums: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for row, s, blob in zip(*(batch.column(i).to_pylist() for i in range(3))):
                have = sums.setdefault((row, s), np.zeros(size, np.uint8))
                at = np.cumsum(np.frombuffer(unpack.decompress(blob), np.uint32), dtype=np.int64)
                # Only the listed cells are touched, however short a list is.
                at, times = np.unique(at, return_counts=True)
                have[at] = np.minimum(have[at] + np.minimum(times, 2), 2)
        yield pa.RecordBatch.from_pydict({
            "row": [r for r, _ in sums], "slice": [s for _, s in sums],
            "blob": [np.packbits(v >= least, bitorder="little").tobytes() for v in sums.values()],
        }, _SCHEMA)

    out = [np.zeros((cells + 7) // 8, np.uint8) for _ in range(DEPTH)]
    for r in lists.repartition("row", "slice").mapInArrow(merged, LISTED).collect():
        out[r["row"]][r["slice"] * size // 8 : (r["slice"] + 1) * size // 8] = np.frombuffer(r["blob"], np.uint8)
    return out


def holds(rows: list[np.ndarray], items: np.ndarray, cells: int) -> np.ndarray:
    """Whether the bits of an item are set in every row."""
    out = np.ones(len(items), bool)
    for row in range(DEPTH):
        c = cell(items, row, cells)
        out &= (rows[row][c >> np.uint64(3)] >> (c & np.uint64(7)).astype(np.uint8)) & 1 == 1
    return out


def twice(texts: DataFrame, items: Callable[[words.Words], np.ndarray], cells: int, lower: bool = False) -> list[np.ndarray]:
    """Bits of what `items` lists for two texts or more; it lists an item once per text."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, w in words.chunks(batch.column("text"), lower):
                yield listed(items(w), cells)

    return bits(texts.select("text").mapInArrow(of, LISTED), cells, 2)
