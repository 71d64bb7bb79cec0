"""Sharding by best-fit-decreasing bin packing of indivisible groups.

Documents with equal texts form a group that stays together. Groups are packed, largest
first, each into the bin whose remaining capacity is the tightest that still holds it;
remaining capacities are kept in a balanced search tree. The capacity is the smallest at
which the wanted number of bins suffices, found by bisection, so that the shards come out
nearly equal; a group larger than a fair share gets a shard of its own first.

Only groups that can upset the balance are packed one by one: those of at least
1 / (bins * FINE) of all bytes, of which there are at most bins * FINE. All smaller groups are
tied by hash into bins * FINE bundles, packed as items. So the packing sees at most
2 * bins * FINE items, whatever the input, and that bound is why they may go to the driver.

A null text has no bytes and is a group of its own. Repeated rows are members of their
group; null and repeated ids are allowed and every input row gets a slot of its own. An
empty table gives an empty result. Columns other than the id and the text are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from regionledger.sources import scratch

FINE = 256
#: Rows numbered by one task.
CELL_ROWS = 50_000


class Capacities:
    """Remaining capacities as an AVL tree of (room, bin)."""

    class _Node:
        __slots__ = ("at", "left", "right", "height")

        def __init__(self, at):
            self.at, self.left, self.right, self.height = at, None, None, 1

    def __init__(self):
        self._root = None

    @staticmethod
    def _h(n):
        return n.height if n else 0

    def _fix(self, n):
        h = self._h
        if h(n.left) > h(n.right) + 1:
            if h(n.left.left) < h(n.left.right):
                n.left = self._turn(n.left, True)
            n = self._turn(n, False)
        elif h(n.right) > h(n.left) + 1:
            if h(n.right.right) < h(n.right.left):
                n.right = self._turn(n.right, False)
            n = self._turn(n, True)
        n.height = 1 + max(h(n.left), h(n.right))
        return n

    def _turn(self, n, left):
        up = n.right if left else n.left
        if left:
            n.right, up.left = up.left, n
        else:
            n.left, up.right = up.right, n
        n.height = 1 + max(self._h(n.left), self._h(n.right))
        up.height = 1 + max(self._h(up.left), self._h(up.right))
        return up

    def add(self, room: int, bin_: int) -> None:
        def into(n):
            if n is None:
                return self._Node((room, bin_))
            if (room, bin_) < n.at:
                n.left = into(n.left)
            else:
                n.right = into(n.right)
            return self._fix(n)

        self._root = into(self._root)

    def take(self, size: int) -> tuple[int, int] | None:
        """Remove and return the tightest (room, bin) with room for `size`."""
        n, best = self._root, None
        while n:
            if n.at[0] >= size:
                best, n = n.at, n.left
            else:
                n = n.right
        if best:
            self._root = self._drop(self._root, best)
        return best

    def _drop(self, n, at):
        if at < n.at:
            n.left = self._drop(n.left, at)
        elif at > n.at:
            n.right = self._drop(n.right, at)
        elif n.left is None or n.right is None:
            return n.left or n.right
        else:
            low = n.right
            while low.left:
                low = low.left
            n.at = low.at
            n.right = self._drop(n.right, low.at)
        return self._fix(n)


def best_fit(sizes: list[int], capacity: int, bins: int) -> list[int] | None:
    """Bin of each size (largest first), or None if `bins` bins don't suffice."""
    rooms, out, opened = Capacities(), [], 0
    for size in sizes:
        found = rooms.take(size)
        if found is None:
            if opened == bins or size > capacity:
                return None
            found, opened = (capacity, opened), opened + 1
        out.append(found[1])
        rooms.add(found[0] - size, found[1])
    return out


def pack(sizes: list[int], bins: int) -> list[int]:
    """Bin of each item; sizes must not increase. Bins come out as equal as items allow."""
    alone, rest = 0, sum(sizes)
    while alone < len(sizes) and bins - alone > 1 and sizes[alone] * (bins - alone) > rest:
        rest -= sizes[alone]
        alone += 1
    tail, left = sizes[alone:], bins - alone
    if not tail:
        return list(range(len(sizes)))
    low, high = max(tail[0], -(-rest // left)), max(tail[0], -(-rest // left)) + tail[0]
    while best_fit(tail, high, left) is None:
        high *= 2
    while low < high:
        middle = (low + high) // 2
        if best_fit(tail, middle, left) is None:
            low = middle + 1
        else:
            high = middle
    return list(range(alone)) + [alone + b for b in best_fit(tail, high, left)]


def assign(docs: DataFrame, bins: int = 16, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, size (UTF-8 bytes + 1), text_crc32, shard and slot of every row.

    Slots count from 0 without gaps in each shard. The table without the texts is
    written once, rows numbered, so that a lost executor can't change the numbers.
    """
    spark, t = docs.sparkSession, F.col("t")
    rows = scratch.materialise(
        docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("t")).select(
            F.monotonically_increasing_id().alias("rid"), "doc_id",
            (F.coalesce(F.octet_length(t), F.lit(0)) + 1).cast("long").alias("size"),
            F.crc32(F.encode(F.coalesce(t, F.lit("")), "UTF-8")).alias("text_crc32"),
            # Two hashes with different seeds; a null leaves the seed as it is.
            F.xxhash64(t).alias("g1"), F.xxhash64(F.lit(1), t).alias("g2"),
        )
    )
    most = bins * FINE
    bundle = F.pmod("g1", F.lit(most)).cast("int")
    groups = scratch.materialise(
        rows.groupBy("size", "g1", "g2").agg((F.count(F.lit(1)) * F.col("size")).alias("bytes"), F.count(F.lit(1)).alias("n"))
    )
    total, n = groups.agg(F.coalesce(F.sum("bytes"), F.lit(0)), F.coalesce(F.sum("n"), F.lit(0))).first()
    large = F.col("bytes") * most >= F.lit(total)
    alone = groups.where(large).select(F.lit(-1).alias("bundle"), "size", "g1", "g2", "bytes")
    tied = groups.where(~large).groupBy(bundle.alias("bundle")).agg(
        F.lit(0).cast("long").alias("size"), F.lit(0).cast("long").alias("g1"), F.lit(0).cast("long").alias("g2"), F.sum("bytes").alias("bytes")
    )
    # At most `most` of either kind.
    items = sorted(alone.unionByName(tied).collect(), key=lambda r: (-r["bytes"], *r[:4]))
    where = pack([r["bytes"] for r in items], bins)
    placed = spark.createDataFrame(
        [(*r[:4], b) for r, b in zip(items, where)], "bundle int, s long, h1 long, h2 long, shard int"
    )
    own = placed.where("bundle < 0").select("s", "h1", "h2", F.col("shard").alias("own"))
    tied = placed.where("bundle >= 0").select("bundle", F.col("shard").alias("tied"))
    cells = max(1, -(-n // (bins * CELL_ROWS)))
    put = (
        rows.join(F.broadcast(own), (rows["size"] == own["s"]) & (rows["g1"] == own["h1"]) & (rows["g2"] == own["h2"]), "left")
        .withColumn("bundle", bundle).join(F.broadcast(tied), "bundle", "left")
        .select("rid", "doc_id", "size", "text_crc32", F.coalesce("own", "tied").alias("shard"), F.pmod(F.xxhash64("rid"), F.lit(cells)).alias("cell"))
    )
    counts = put.groupBy("shard", "cell").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("shard").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("shard", "cell", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("offset"))
    inside = F.row_number().over(Window.partitionBy("shard", "cell").orderBy("rid")) - 1
    return put.withColumn("inside", inside).join(offsets, ["shard", "cell"]).select(
        "doc_id", "size", "text_crc32", "shard", (F.col("offset") + F.col("inside")).alias("slot")
    )
