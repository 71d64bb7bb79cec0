"""N-gram Jaccard join: size-aware heavy-light join of shingle sets, and its components.

Documents are sets of `k`-word shingles; two link when |intersection| / |union| reaches
num/den. Equal sets are one class from the start. For different classes:

1. A shared order of shingles, rare ones first, is fixed by a count-min sketch of all sets
   (estimates only have to be the same for all). In that order two linked sets share one of
   their first `n - need + 1` shingles, and two of their first `n - need + 2`.
2. Light sets, smaller than a boundary, enumerate the pairs (two-subsets) of that longer prefix as
   keys; heavy sets, and light ones that a heavy one can reach, post the single shingles of the
   shorter prefix to inverted lists, which are scanned. The boundary is the size at which the
   subsets of a set cost more than its share of the lists, summed over the sizes that occur.
   A bit sketch of the keys keeps those of one set only off the network.
3. Short lists give all their pairs. A long list gives each member's pair with the list's
   two leaders, and after these are verified only pairs of members that are still in different
   components, one of them outside the list's largest component. So a group of thousands
   of near copies costs a few pairs each, and no pair that could join components is left out.
4. Pairs are cut by size, by position and by the number of keys they share, then verified on the whole sets.

Words are lower-cased (A-Z). A text with fewer than `k` words is one shingle; an empty or null
text has none and links with nothing. Null ids are allowed; the smallest non-null id
names a component. Repeated rows are equal sets. An empty table gives an empty
result. Columns other than id and text are not read. Shingles and sets are told apart by
64-bit fingerprints.
"""

from __future__ import annotations

import contextlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from regionledger.llm import sketch, words
from regionledger.llm.components import components
from regionledger.sources import scratch

#: Counters of a row of the frequency sketch. Only shares matter: shingles that more than about
#: 1 / COUNTERS of all set members are get to the end of the order.
COUNTERS = 1 << 22
MAX_CELLS = 1 << 28
PARTS = 64
#: Lists of up to so many classes give all their pairs.
SHORT_LIST = 16
#: Cost of looking at a list's entry, as a part of the cost of posting a key.
SCAN_COST = 0.1


@dataclass(frozen=True)
class Likeness:
    """What links two sets."""

    k: int = 4
    num: int = 85
    den: int = 100

    def least(self, n):
        """Shingles that a partner must share with a set of n."""
        return -(-self.num * n // self.den)

    def least_column(self, n: Column) -> Column:
        return F.ceil(self.num * n / self.den - 1e-9)

    def together(self, n: Column, m: Column) -> Column:
        """Shingles that sets of n and m must share."""
        return F.ceil(self.num * (n + m) / (self.num + self.den) - 1e-9)

    def alone(self, n):
        """Whether a set of n can only link with its equal."""
        return (self.den * n < self.num * (n + 1)) & (self.den * (n - 1) < self.num * n)


def _set_print(x: np.ndarray) -> int:
    with np.errstate(over="ignore"):
        both = words.mix(x, 11).sum(dtype=np.uint64) ^ (np.uint64(len(x)) * np.uint64(0x9E3779B97F4A7C15))
    return int(words.mix(np.array([both]), 12).view(np.int64)[0])


def _sets(batch: pa.RecordBatch, k: int) -> Iterator[tuple[int, np.ndarray]]:
    """(row, set) of every text of the batch."""
    for a, _, w in words.chunks(batch.column("text"), lower=True):
        yield from enumerate(w.shingles(k), a)


def _planes(counts: np.ndarray) -> bytes:
    """Counts byte by byte: all lowest bytes, then the next ones, which are nearly all zero and pack to nothing."""
    return np.ascontiguousarray(counts.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes()


def _of_planes(blob: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(blob, np.uint8).reshape(4, -1).T).view("<u4").ravel()


def _counted(k: int, counters: int):
    """A row per document, and the task's counts at its end."""
    kinds = pa.schema([("doc_id", pa.int64()), ("fp", pa.int64()), ("cls", pa.int64()), ("n", pa.int64()), ("part", pa.int32()), ("counts", pa.binary())])

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((sketch.DEPTH, counters), np.uint32)
        for batch in batches:
            ids, prints, sizes, held, members = batch.column("doc_id").to_pylist(), [], [], [], 0
            for _, x in _sets(batch, k):
                prints.append(_set_print(x))
                sizes.append(len(x))
                held.append(x)
                members += len(x)
                if members > 1 << 20:
                    _add(sums, held)
                    held, members = [], 0
            _add(sums, held)
            none = [None] * len(ids)
            yield pa.RecordBatch.from_pydict({"doc_id": ids, "fp": batch.column("fp"), "cls": prints, "n": sizes, "part": none, "counts": none}, kinds)
        pack = zstandard.ZstdCompressor(1)
        # Small parts, so that many tasks share the merging of many tasks' counts.
        step = max(1, counters // PARTS)
        for row in range(sketch.DEPTH):
            for p in range(0, counters, step):
                part = sums[row, p : p + step]
                if part.any():
                    blob = pack.compress(_planes(part))
                    yield pa.RecordBatch.from_pydict({"doc_id": [None], "fp": [None], "cls": [None], "n": [None], "part": [row * counters + p], "counts": [blob]}, kinds)

    def _add(sums: np.ndarray, held: list[np.ndarray]) -> None:
        if held:
            flat = np.concatenate(held)
            for row in range(sketch.DEPTH):
                np.add.at(sums[row], sketch.cell(flat, row, counters), np.uint32(1))

    return of


def _levels(parts: DataFrame, counters: int) -> tuple[np.ndarray, float]:
    """Counts of all tasks as levels (eight per doubling), and the mean count of a used cell."""
    schema = "part int, levels binary, total double, used double"

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack, sums = zstandard.ZstdDecompressor(), {}
        for batch in batches:
            for part, blob in zip(batch.column("part").to_pylist(), batch.column("counts").to_pylist()):
                new = _of_planes(unpack.decompress(blob))
                sums[part] = sums[part] + new if part in sums else new.astype(np.uint64)
        level = [np.minimum(np.round(8 * np.log2(np.maximum(v, 1).astype(float))) + (v > 0), 255).astype(np.uint8) for v in sums.values()]
        yield pa.RecordBatch.from_pydict({
            "part": pa.array(list(sums), pa.int32()), "levels": pa.array([x.tobytes() for x in level], pa.binary()),
            "total": pa.array([float(v.sum()) for v in sums.values()], pa.float64()), "used": pa.array([float((v > 0).sum()) for v in sums.values()], pa.float64()),
        })

    out = np.zeros(sketch.DEPTH * counters, np.uint8)
    total = used = 0.0
    # Bounded: DEPTH * counters bytes.
    for r in parts.repartition("part").mapInArrow(merged, schema).collect():
        x = np.frombuffer(r["levels"], np.uint8)
        out[r["part"] : r["part"] + len(x)] = x
        total, used = total + r["total"], used + r["used"]
    return out.reshape(sketch.DEPTH, counters), total / max(used, 1.0)


def boundary(sizes: list[tuple[int, int]], like: Likeness, list_length: float) -> int:
    """The size from which on sets are heavy: the cheapest for a histogram of (size, sets).

    `list_length` is the mean count of a used counter. It grows with the table once all counters are in use, but
    an entry of a list is never compared with more than SHORT_LIST others.
    """
    best, cost = 0, None
    list_length = min(list_length, SHORT_LIST)
    tail = sum(c * (n - like.least(n) + 1) * (1 + SCAN_COST * list_length) for n, c in sizes)
    head = 0.0
    for n, c in [(0, 0), *sorted(sizes)]:
        longer = n - like.least(n) + 2
        head += c * longer * (longer - 1) / 2
        tail -= c * (longer - 1) * (1 + SCAN_COST * list_length)
        if cost is None or head + tail < cost:
            best, cost = n + 1, head + tail
    return best


def _keys(x: np.ndarray, levels: np.ndarray, like: Likeness, heavy: int):
    """(key, position, is a subset) of the prefix of one set; keys of one set only may be left out."""
    n = len(x)
    level = np.minimum(levels[0][sketch.cell(x, 0, levels.shape[1])], levels[1][sketch.cell(x, 1, levels.shape[1])])
    single = n - like.least(n) + 1
    order = np.lexsort((x, level))[: single + 1]
    # A level of 1 is a count of 1, which is exact: no other set has the shingle.
    shared = level[order] > 1
    keys, at, subset = [], [], []
    if n < heavy:
        i, j = np.triu_indices(len(order), 1)
        both = shared[i] & shared[j]
        i, j = i[both], j[both]
        keys.append(words.mix(words.mix(x[order[i]], 5) + x[order[j]], 6))
        at.append(j)
        subset.append(np.ones(len(j), bool))
    if n >= heavy or like.den * n >= like.num * heavy:
        i = np.flatnonzero(shared[:single])
        keys.append(x[order[i]])
        at.append(i)
        subset.append(np.zeros(len(i), bool))
    return np.concatenate(keys), np.concatenate(at), np.concatenate(subset)


def _join_keys(levels, like: Likeness, heavy: int, bits, cells: int):
    """Rows (key, cls, n, pos, subset); with no bits yet, the keys' cells instead."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            out, size = [], 0
            for _, x in _sets(batch, like.k):
                n = len(x)
                if n == 0 or like.alone(n):
                    continue
                cls = _set_print(x)
                if cls in seen:
                    continue
                seen.add(cls)
                key, pos, subset = _keys(x, levels.value, like, heavy)
                if bits is not None:
                    m = sketch.holds(bits.value, key, cells)
                    key, pos, subset = key[m], pos[m], subset[m]
                if len(key):
                    out.append((key, np.full(len(key), cls), np.full(len(key), n), pos, subset))
                    size += len(key)
                if size > 1 << 20:
                    yield from rows(out)
                    out, size = [], 0
            yield from rows(out)

    def rows(out: list[tuple]) -> Iterator[pa.RecordBatch]:
        if out:
            key, cls, n, pos, subset = (np.concatenate(c) for c in zip(*out))
            if bits is None:
                yield sketch.listed(key, cells)
            else:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key.view(np.int64)), pa.array(cls.astype(np.int64)), pa.array(n.astype(np.int32)), pa.array(pos.astype(np.int32)), pa.array(subset)],
                    ["key", "cls", "n", "pos", "subset"],
                )

    return of


def _meetings(a: DataFrame, b: DataFrame, like: Likeness, heavy: int, more: Column) -> DataFrame:
    """Entries of one list (columns as they are, and with `_b`) whose sizes allow a link, pair by pair.

    `reach`: whether the positions allow it, too. For a pair's first shared key they do.
    """
    both = a.join(b, (a["key"] == b["key_b"]) & more & (F.col("cls") != F.col("cls_b")))
    n, m = F.col("n"), F.col("n_b")
    shared = F.when(F.col("subset"), 2).otherwise(1)
    reach = shared + F.least(n - F.col("pos") - 1, m - F.col("pos_b") - 1) >= like.together(n, m)
    fit = (like.den * n >= like.num * m) & (like.den * m >= like.num * n)
    # Two light sets meet by their subsets only.
    fit = fit & (F.col("subset") | (n >= heavy) | (m >= heavy))
    return both.where(fit).withColumn("reach", reach)


def _pair() -> list[Column]:
    return [F.least("cls", "cls_b").alias("a"), F.greatest("cls", "cls_b").alias("b")]


def _candidates(a: DataFrame, b: DataFrame, like: Likeness, heavy: int, more: Column) -> DataFrame:
    return _meetings(a, b, like, heavy, more).where("reach").select(*_pair())


def _counted_candidates(short: DataFrame, like: Likeness, heavy: int) -> DataFrame:
    """Pairs of short lists that can still link, given how many keys of their prefixes they share.

    Behind the prefix that ends first a set has at most its own rest in common with the other. `far` is
    how many keys of long lists a class has, which may be shared but are not counted here.
    """
    met = _meetings(short, _other(short, "far"), like, heavy, F.col("cls") < F.col("cls_b"))
    counted = met.groupBy(*_pair()).agg(
        F.max("reach").alias("reach"), F.max("subset").alias("subset"), F.count_if(~F.col("subset")).alias("shared"),
        F.first(like.together(F.col("n"), F.col("n_b"))).alias("need"),
        F.first(F.least("far", "far_b")).alias("far"),
        F.first(like.least_column(F.greatest("n", "n_b")) - 1).alias("rest"),
    )
    return counted.where("reach AND (subset OR shared + far + rest >= need)").select("a", "b")


def _other(df: DataFrame, *more: str) -> DataFrame:
    return df.select(*[F.col(c).alias(f"{c}_b") for c in ("key", "cls", "n", "pos", *more)])


def verified(texts: DataFrame, pairs: DataFrame, like: Likeness, max_cells: int = MAX_CELLS) -> DataFrame:
    """The pairs (a, b) of classes whose whole sets link."""
    spark = texts.sparkSession
    classes = scratch.materialise(pairs.select(F.explode(F.array("a", "b")).alias("cls")).distinct())
    n = classes.count()
    if not n:
        return pairs
    cells = sketch.cells_for(n, max_cells)

    def of_classes(batches):
        for batch in batches:
            yield sketch.listed(batch.column("cls").to_numpy().view(np.uint64), cells)

    bits = spark.sparkContext.broadcast(sketch.bits(classes.mapInArrow(of_classes, sketch.LISTED), cells, 1))

    def wanted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            cls, members, size = [], [], 0
            for _, x in _sets(batch, like.k):
                p = _set_print(x)
                if p not in seen and sketch.holds(bits.value, np.array([p]).view(np.uint64), cells)[0]:
                    seen.add(p)
                    cls.append(p)
                    members.append(x.tobytes())
                    size += len(members[-1])
                if size > 1 << 24:
                    yield pa.RecordBatch.from_arrays([pa.array(cls, pa.int64()), pa.array(members, pa.binary())], ["cls", "members"])
                    cls, members, size = [], [], 0
            yield pa.RecordBatch.from_arrays([pa.array(cls, pa.int64()), pa.array(members, pa.binary())], ["cls", "members"])

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("x"), batch.column("y")):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = len(x) + len(y) - len(np.unique(np.concatenate([x, y])))
                keep.append(like.den * both >= like.num * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    found = texts.select("text").mapInArrow(wanted, "cls long, members binary")
    sets = scratch.materialise(found.dropDuplicates(["cls"]).join(classes, "cls", "left_semi"))
    x = sets.select(F.col("cls").alias("a"), F.col("members").alias("x"))
    y = sets.select(F.col("cls").alias("b"), F.col("members").alias("y"))
    links = scratch.materialise(pairs.join(x, "a").join(y, "b").select("a", "b", "x", "y").mapInArrow(linked, "a long, b long"))
    scratch.drop(classes, sets)
    return links


@contextlib.contextmanager
def _small_batches(spark: SparkSession, rows: int = 1000) -> Iterator[None]:
    """Fewer rows per Arrow batch for the jobs inside, which move whole texts and sets."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(min(rows, int(before) if int(before) > 0 else rows)))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def join(docs: DataFrame, like: Likeness = Likeness(), doc_id: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(members, links): doc_id, fp (a hash of the text), cls and n of every row, and the verified links of classes (a, b).

    Links suffice to connect whatever is linked; of a group of near copies not all are listed.
    """
    with _small_batches(docs.sparkSession), scratch.released(docs.sparkSession):
        return _join(docs, like, doc_id, text)


def _join(docs: DataFrame, like: Likeness, doc_id: str, text: str) -> tuple[DataFrame, DataFrame]:
    spark = docs.sparkSession
    texts = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.xxhash64(text).alias("fp"), F.col(text).alias("text"))
    first = scratch.materialise(texts.mapInArrow(_counted(like.k, COUNTERS), "doc_id long, fp long, cls long, n long, part int, counts binary"))
    members = scratch.materialise(first.where("part IS NULL").select("doc_id", "fp", "cls", "n"))
    levels, length = _levels(first.where("part IS NOT NULL").select("part", "counts"), COUNTERS)
    scratch.drop(first)
    levels = spark.sparkContext.broadcast(levels)
    # Sizes in steps of an eighth: a histogram of a bounded number of rows.
    step = F.when(F.col("n") < 64, F.col("n")).otherwise(F.floor(F.pow(2.0, F.floor(F.log2("n") * 8) / 8)))
    sizes = [(int(r[0]), int(r[1])) for r in members.where("n > 0").groupBy(step).count().collect()]
    heavy = boundary(sizes, like, length)
    posted = sum(
        c * (((n - like.least(n) + 2) * (n - like.least(n) + 1) / 2 if n < heavy else 0) + (n - like.least(n) + 1)) for n, c in sizes
    )
    cells = sketch.cells_for(posted, MAX_CELLS)
    lists = texts.select("text").mapInArrow(_join_keys(levels, like, heavy, None, cells), sketch.LISTED)
    bits = spark.sparkContext.broadcast(sketch.bits(lists, cells, 2))
    entries = texts.select("text").mapInArrow(_join_keys(levels, like, heavy, bits, cells), "key long, cls long, n int, pos int, subset boolean")
    entries = scratch.materialise(
        entries.groupBy("key", "cls", "subset").agg(F.first("n").alias("n"), F.min("pos").alias("pos"))
    )
    # Entries move once more, with their lists' sizes; keys of one set go.
    size = entries.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    listed = scratch.materialise(entries.join(size, "key"))
    scratch.drop(entries)
    long = scratch.materialise(listed.where(F.col("size") > SHORT_LIST).select(*entries.columns))
    # Only long lists have leaders.
    order = F.xxhash64("cls")
    head = scratch.materialise(long.groupBy("key").agg(
        F.min(F.struct("pos", order.alias("o"), "cls", "n")).alias("central"), F.min(F.struct(order.alias("o"), "pos", "cls", "n")).alias("any"),
    ))
    far = long.groupBy(F.col("cls").alias("c")).agg(F.count(F.lit(1)).alias("far"))
    short = listed.where(F.col("size") <= SHORT_LIST).select(*entries.columns)
    short = short.join(far, short["cls"] == far["c"], "left").select(*entries.columns, F.coalesce("far", F.lit(0)).alias("far"))
    short = scratch.materialise(short)
    pairs = _counted_candidates(short, like, heavy)
    for leader in ("central", "any"):
        lead = head.select(
            F.col("key").alias("key_b"), *[F.col(f"{leader}.{c}").alias(f"{c}_b") for c in ("cls", "n", "pos")]
        )
        pairs = pairs.unionAll(_candidates(long, lead, like, heavy, F.lit(True)))
    pairs = scratch.materialise(pairs.distinct())
    scratch.drop(short)
    links = verified(texts, pairs, like)
    if long.limit(1).count():
        labels = components(links)
        named = long.join(labels, long["cls"] == labels["node"], "left").select(*long.columns, F.coalesce("label", "cls").alias("comp"))
        named = scratch.materialise(named)
        largest = named.groupBy("key", "comp").count().groupBy("key").agg(
            F.max_by("comp", F.struct("count", "comp")).alias("most"), F.count(F.lit(1)).alias("parts")
        ).where("parts > 1")
        open_ = scratch.materialise(named.join(largest, "key"))
        outside = open_.where(F.col("comp") != F.col("most")).drop("most", "parts")
        rest = _candidates(outside, _other(open_, "comp"), like, heavy, F.col("comp") != F.col("comp_b")).distinct()
        rest = scratch.materialise(rest.join(pairs, ["a", "b"], "left_anti"))
        if rest.limit(1).count():
            links = links.unionAll(verified(texts, rest, like))
    return members, links


def groups(docs: DataFrame, like: Likeness = Likeness(), doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, fp, n_shingles, component (null: links with nothing) and component_id of every row.

    `component` is the component's smallest class, `component_id` its smallest document id.
    """
    members, links = join(docs, like, doc_id, text)
    labels = components(links)
    least = members.where("n > 0").groupBy("cls").agg(F.min("doc_id").alias("own"))
    named = least.join(labels, least["cls"] == labels["node"], "left").select("cls", "own", F.coalesce("label", "cls").alias("component"))
    named = scratch.materialise(named)
    whole = named.groupBy(F.col("component").alias("l")).agg(F.min("own").alias("component_id"))
    names = named.join(whole, named["component"] == whole["l"]).select(F.col("cls").alias("c"), "component", "component_id")
    return members.join(names, (members["cls"] == names["c"]) & (members["n"] > 0), "left").select(
        "doc_id", "fp", F.col("n").alias("n_shingles"), "component",
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
    )


def keep_one(docs: DataFrame, like: Likeness = Likeness(), doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of `docs` without all but one document of each group.

    The smallest id stays (a null one last, then by a hash of the text); of rows with that id and text
    one stays. Texts without words are in no group and stay.
    """
    found = scratch.materialise(groups(docs, like, doc_id, text).where("component IS NOT NULL"))
    first = found.groupBy(F.col("component").alias("c")).agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "fp")).alias("k")
    )
    marks = found.join(first, found["component"] == first["c"]).groupBy(F.col("doc_id").alias("d"), F.col("fp").alias("f")).agg(
        F.max(~(F.col("doc_id").eqNullSafe(F.col("k.doc_id")) & (F.col("fp") == F.col("k.fp")))).alias("gone"), F.count(F.lit(1)).alias("rows")
    ).where("gone OR rows > 1")
    marks = scratch.materialise(marks)
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col(doc_id).cast("long").alias("d1"), F.xxhash64(text).alias("f1"))
    marked = rows.join(marks, rows["d1"].eqNullSafe(marks["d"]) & (rows["f1"] == marks["f"]), "left")
    alone = marked.where("gone IS NULL").select("row.*")
    if not marks.where("NOT gone").limit(1).count():
        return alone
    repeated = marked.where("NOT gone").dropDuplicates(["d1", "f1"]).select("row.*")
    return alone.unionAll(repeated)
