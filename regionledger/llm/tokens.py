"""Token counts: separator scan of flat, unindexed token files.

A file is a plain sequence of little-endian 32-bit token ids in which an end-of-document id closes
every document; nothing tells where documents begin. The scan cuts a file into blocks, finds the separators of
a block in one vectorised comparison, and lists what lies between them as pieces. A
document that crosses blocks is in several pieces. How many separators lie before a block - a
prefix scan over one small row per block - numbers all pieces by document, and pieces at block
edges with one number are added up. Pieces inside a block are whole documents and are
never shuffled to be counted.

Token ids: END closes a document. Ids with the top bit set are control ids: `write` opens a document with
its id in up to three of them, so the files need no index to be traced back.

An empty document has no tokens and is counted (0). Tokens after the last separator are reported as a
document that is not closed. Null and repeated document ids are kept, row by row. An
empty file or folder gives an empty result. A file must fit one value (2 GB); `write`
makes files of at most `rows_per_file` documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from regionledger.llm import words
from regionledger.sources import scratch

END = 0
CONTROL = np.uint32(1 << 31)
#: A control id holds a place (0 to 2; 3 for a null id) and 22 bits of the id.
_PLACE, _BITS = 24, 22
BLOCK = 1 << 20
#: One row per block goes to every task up to this many; beyond, blocks are joined by shuffle.
FEW_BLOCKS = 100_000


def _opened(doc_id: int | None) -> np.ndarray:
    if doc_id is None:
        return np.array([CONTROL | np.uint32(3 << _PLACE)], np.uint32)
    bits = doc_id & (2**64 - 1)
    return np.array([(1 << 31) | (p << _PLACE) | (bits >> (_BITS * p) & ((1 << _BITS) - 1)) for p in range(3)], np.uint32)


def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Token bytes of (doc_id, text), without the separator: hashed words as 31-bit ids."""
    for batch in batches:
        ids = batch.column("doc_id").to_pylist()
        for a, b, w in words.chunks(batch.column("text")):
            token = np.maximum(w.hashes >> np.uint64(33), 1).astype("<u4")
            out = [
                _opened(i).astype("<u4").tobytes() + token[s:e].tobytes()
                for i, s, e in zip(ids[a:b], w.first[:-1], w.first[1:])
            ]
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["value"])


def write(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", rows_per_file: int = 20_000) -> None:
    """Flat token files of a table: the line end of Spark's text writer is the separator."""
    t = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    flat = t.mapInArrow(encode, "value binary").select(F.col("value").cast("string").alias("value"))
    flat.write.option("lineSep", "\0\0\0\0").option("maxRecordsPerFile", rows_per_file).text(path)


_PIECES = "file string, block long, piece long, start long, tokens long, bits long, null_id boolean, closed boolean, edge boolean"


def _scan(end: int, block: int):
    def pieces(name: str, number: int, ids: np.ndarray) -> pa.RecordBatch:
        at = np.flatnonzero(ids == end)
        begin = np.append(0, at + 1)
        stop = np.append(at, len(ids))
        control = ids >= CONTROL
        place = (ids >> np.uint32(_PLACE)) & np.uint32(3)
        value = (ids & np.uint32((1 << _BITS) - 1)).astype(np.uint64) << (np.uint64(_BITS) * place.astype(np.uint64))
        bits = np.append(np.uint64(0), np.cumsum(np.where(control & (place < 3), value, np.uint64(0))))
        plain = np.append(0, np.cumsum(~control & (ids != end)))
        none = np.append(0, np.cumsum(control & (place == 3)))
        n = len(begin)
        closed = np.arange(n) < len(at)
        edge = ~closed
        edge[0] = True
        return pa.RecordBatch.from_arrays(
            [pa.array([name] * n), pa.array(np.full(n, number)), pa.array(np.arange(n)), pa.array(begin + number * block), pa.array(plain[stop] - plain[begin]),
             pa.array((bits[stop] - bits[begin]).view(np.int64)), pa.array(none[stop] > none[begin]), pa.array(closed), pa.array(edge)],
            ["file", "block", "piece", "start", "tokens", "bits", "null_id", "closed", "edge"],
        )

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column("path").to_pylist(), batch.column("content")):
                ids = np.frombuffer(content.as_buffer(), "<u4", len(content.as_buffer()) // 4)
                for k in range(0, len(ids), block):
                    yield pieces(name, k // block, ids[k : k + block])

    return of


def count(spark: SparkSession, path: str, end: int = END, block: int = BLOCK) -> DataFrame:
    """file, number (of the document in its file), start (in tokens), doc_id, n_tokens, closed."""
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    pieces = scratch.materialise(files.mapInArrow(_scan(end, block), _PIECES))
    blocks = pieces.where(~F.col("closed")).select("file", "block", F.col("piece").alias("ends"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    before = scratch.materialise(blocks.select("file", "block", F.coalesce(F.sum("ends").over(earlier), F.lit(0)).alias("before")))
    few = before.limit(FEW_BLOCKS + 1).count() <= FEW_BLOCKS
    numbered = pieces.join(F.broadcast(before) if few else before, ["file", "block"]).withColumn("number", F.col("before") + F.col("piece"))
    columns = ["file", "number", "start", "tokens", "bits", "null_id", "closed"]
    stitched = numbered.where("edge").groupBy("file", "number").agg(
        F.min("start").alias("start"), F.sum("tokens").alias("tokens"), F.sum("bits").alias("bits"),
        F.max("null_id").alias("null_id"), F.max("closed").alias("closed"),
    )
    # What follows the last separator is a document only if something is there.
    stitched = stitched.where("closed OR tokens > 0 OR bits != 0 OR null_id").select(*columns)
    every = numbered.where(~F.col("edge")).select(*columns).unionAll(stitched)
    return every.select(
        "file", "number", "start", F.when(~F.col("null_id"), F.col("bits")).alias("doc_id"), F.col("tokens").alias("n_tokens"), "closed"
    )
