"""Sharding by best-fit-decreasing bin packing of indivisible groups.

Equal texts are one group and stay in one shard. Groups of at least
``1 / items`` of all bytes are items of their own, so there are at most
``items`` of them. All smaller groups are hashed into ``items`` bundles, each an
item. These at most ``2 * items`` items, whatever the input, are sorted by size
and enter the bin with the tightest remaining capacity, found in a balanced
tree. The capacity is the smallest for which no more than the wanted number of
bins is opened, found by bisection. A group larger than a shard can't stay
whole; it is cut, by document, into pieces of a bundle's size.
"""

from __future__ import annotations

from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quernel.llm.common import text_bytes, whole
from quernel.session import materialize

#: Items of each kind at most; a shard of eight then has items of about 1/512 of its size.
ITEMS = 4096


class CapacityTree:
    """Bins in order of remaining capacity: a balanced (AVL) tree of (room, bin)."""

    @dataclass
    class Node:
        key: tuple[int, int]
        left: CapacityTree.Node | None = None
        right: CapacityTree.Node | None = None
        height: int = 1

    def __init__(self):
        self.root = None

    @staticmethod
    def _tall(node):
        return node.height if node else 0

    def _fixed(self, node):
        """Heights set, and rotated where one side is two taller."""
        lean = self._tall(node.left) - self._tall(node.right)
        if lean > 1:
            if self._tall(node.left.left) < self._tall(node.left.right):
                node.left = self._turn(node.left, "right", "left")
            return self._turn(node, "left", "right")
        if lean < -1:
            if self._tall(node.right.right) < self._tall(node.right.left):
                node.right = self._turn(node.right, "left", "right")
            return self._turn(node, "right", "left")
        node.height = 1 + max(self._tall(node.left), self._tall(node.right))
        return node

    def _turn(self, node, up, down):
        top = getattr(node, up)
        setattr(node, up, getattr(top, down))
        node.height = 1 + max(self._tall(node.left), self._tall(node.right))
        setattr(top, down, node)
        top.height = 1 + max(self._tall(top.left), self._tall(top.right))
        return top

    def add(self, key):
        def down(node):
            if node is None:
                return self.Node(key)
            side = "left" if key < node.key else "right"
            setattr(node, side, down(getattr(node, side)))
            return self._fixed(node)

        self.root = down(self.root)

    def take_at_least(self, room: int):
        """Remove and return the smallest key with at least this room, or None."""
        best, node = None, self.root
        while node:
            if node.key[0] >= room:
                best, node = node.key, node.left
            else:
                node = node.right
        if best is not None:
            self.root = self._without(self.root, best)
        return best

    def _without(self, node, key):
        if key != node.key:
            side = "left" if key < node.key else "right"
            setattr(node, side, self._without(getattr(node, side), key))
            return self._fixed(node)
        if node.left is None or node.right is None:
            return node.left or node.right
        least = node.right
        while least.left:
            least = least.left
        node.key, node.right = least.key, self._without(node.right, least.key)
        return self._fixed(node)


def best_fit_decreasing(sizes: list[int], capacity: int) -> list[int]:
    """Bin of each item; a bin is opened only when no open one has room.

    Sizes are in descending order and none exceeds the capacity.
    """
    tree, bins, opened = CapacityTree(), [], 0
    for size in sizes:
        found = tree.take_at_least(size)
        if found is None:
            found = (capacity, opened)
            opened += 1
        bins.append(found[1])
        tree.add((found[0] - size, found[1]))
    return bins


def pack(sizes: list[int], shards: int) -> list[int]:
    """Bin of each item (sizes in descending order) at the least capacity that needs no more than ``shards`` bins."""
    if not sizes:
        return []
    low = max(sizes[0], -(-sum(sizes) // shards))
    # A bin that is left unopened has room for any item, so this much always suffices.
    high = low + sizes[0]
    while low < high:
        middle = (low + high) // 2
        if max(best_fit_decreasing(sizes, middle)) < shards:
            high = middle
        else:
            low = middle + 1
    return best_fit_decreasing(sizes, high)


def _group(docs: DataFrame, items: int) -> DataFrame:
    """Slim rows: 128 bits name a group; no text is shuffled."""
    text = whole()
    return docs.select(
        "doc_id",
        (text_bytes(text) + 1).alias("size"),
        F.crc32(text).cast("bigint").alias("text_crc32"),
        F.xxhash64(text).alias("g1"),
        F.xxhash64(F.lit(1), text).alias("g2"),
    ).withColumn("bundle", F.pmod("g2", F.lit(items)).cast("int"))


def shard(docs: DataFrame, shards: int = 8, items: int = ITEMS) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard), a row per document.

    The law is ``bytes``: the sizes of the shards are near equal. ``size`` is the
    UTF-8 bytes of the text plus 1; a null text has none. ``slot`` numbers a
    shard's documents from 0, by doc_id (null first). ``grown_shard`` is null under this law.
    Rows with the same id and text are all kept. An empty table gives an
    empty table.
    """
    rows = materialize(_group(docs, items), "shard-rows")
    total = rows.agg(F.sum("size")).first()[0] or 0
    large = max(1, -(-total // items))
    groups = rows.groupBy("g1", "g2").agg(F.sum("size").alias("group_size"))
    fair = -(-total // shards)
    pieces = F.when(F.col("group_size") > fair, F.ceil(F.col("group_size") / large)).otherwise(1)
    # Each has at least 1/items of all bytes, so there are no more than that.
    heavy = groups.filter(F.col("group_size") >= large).select("g1", "g2", pieces.cast("int").alias("pieces"))
    named = (
        rows.join(F.broadcast(heavy), ["g1", "g2"], "left")
        .withColumn(
            "piece", F.when(F.col("pieces") > 1, F.pmod(F.xxhash64("doc_id"), F.col("pieces"))).otherwise(0).cast("int")
        )
        .withColumn("h1", F.when(F.col("pieces").isNotNull(), F.col("g1")).otherwise(F.col("bundle").cast("bigint")))
        .withColumn("h2", F.when(F.col("pieces").isNotNull(), F.col("g2")))
    )
    # At most items bundles, items heavy groups, and 2 * items pieces of those above a shard.
    parts = (
        named.groupBy("h1", "h2", "piece")
        .agg(F.sum("size").alias("part_size"))
        .orderBy(F.desc("part_size"), "h1", "h2", "piece")
        .collect()
    )
    bins = pack([r.part_size for r in parts], shards)
    columns = [pa.array([r[c] for r in parts], t) for c, t in (("h1", pa.int64()), ("h2", pa.int64()), ("piece", pa.int32()))]
    placed = docs.sparkSession.createDataFrame(
        pa.table([*columns, pa.array(bins, pa.int32())], ["h1", "h2", "piece", "shard"])
    )
    out = (
        named.alias("n")
        .join(
            F.broadcast(placed).alias("p"),
            (F.col("n.h1") == F.col("p.h1"))
            & F.col("n.h2").eqNullSafe(F.col("p.h2"))
            & (F.col("n.piece") == F.col("p.piece")),
        )
        .select("n.doc_id", "n.size", "n.text_crc32", F.lit("bytes").alias("law"), "p.shard")
    )
    return _slots(out).withColumn("grown_shard", F.lit(None).cast("int"))


def _slots(rows: DataFrame) -> DataFrame:
    """``slot``: a gapless number in each shard, without gathering a shard.

    Ranges of (shard, doc_id) are sorted and written; a row's number in its range
    is fixed by that. Counts of (range, shard), a few rows per range, give the offsets.
    """
    written = materialize(
        rows.repartitionByRange("shard", "doc_id", "text_crc32")
        .sortWithinPartitions("shard", "doc_id", "text_crc32")
        .withColumn("place", F.monotonically_increasing_id()),
        "shard-ranges",
    )
    part = F.shiftright("place", 33)
    numbered = written.withColumn("range", part)
    counts = numbered.groupBy("shard", "range").agg(F.count("*").alias("n"), F.min("place").alias("first"))
    before = Window.partitionBy("shard").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        "shard", "range", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("shift")
    )
    return (
        numbered.join(offsets, ["shard", "range"])
        .withColumn("slot", F.col("place") + F.col("shift"))
        .select("doc_id", "size", "text_crc32", "law", "shard", "slot")
    )
