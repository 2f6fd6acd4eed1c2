"""Sharding by best-fit-decreasing bin packing.

Rows of equal texts are one indivisible group.  Groups, sorted by falling size, enter the
open shard with the least remaining capacity that still holds them, found in a balanced tree; where
none does, a new shard opens.

*High multiplicity.*  Groups of one size follow each other in that order, and the shard that takes one
takes the next ones too until it is full.  So the packing of a whole run of equal sizes is a few
steps, exactly those that group after group would take.  Only (size, number of groups) reach the
driver: distinct sizes are fewer than the square root of twice the corpus' bytes (14 M for 100 TB,
``MAX_SIZES`` checks it), in practice far fewer.  The steps come back as pieces
(size, first and last place among the groups of that size, shard), which Spark joins to the groups.

*A fixed number of shards.*  A group as large as an even share of what is left gets a shard of its
own; the capacity for the others is their even share plus the smallest slack of a doubling row
that packs them into the remaining shards.  ``pack(docs, capacity=...)`` takes a fixed
capacity instead and opens as many shards as it needs; a larger group is a shard alone.

*Spark.*  Texts never move: a row is its id, size, checksum and a 128-bit key of the text.  Sizes
of groups are partial sums, so a hot text is one row a task.  Places among groups of one size, and slots
within a shard, are ranks in parts of bounded size plus the sums of the parts before; rows are numbered in a written table first, so that
neither a hot size, a hot text nor a shard is ever sorted in one task.

Cases: a NULL text has no bytes, size 1, checksum 0, and is a group apart from the empty text.  Repeated
rows and ids are rows of their own.  Slots follow the rows' numbers.  An empty table has no rows.  Two
different texts with one key (2**-128) would share a shard, and nothing else.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tierline.llm.common import drop_path, table, written

SHARDS = 16
LAW = "bytes"
MAX_SIZES = 1 << 24
#: Groups, or rows, that are ranked together.
PART_BITS = 16


# ---------------------------------------------------------------- the balanced tree

class Node:
    __slots__ = ("key", "rank", "left", "right")

    def __init__(self, key: tuple[int, int], rank: int):
        self.key, self.rank, self.left, self.right = key, rank, None, None


def _split(node, key):
    """(nodes below key, the others)."""
    if node is None:
        return None, None
    if node.key < key:
        node.right, high = _split(node.right, key)
        return node, high
    low, node.left = _split(node.left, key)
    return low, node


def _joined(low, high):
    if low is None or high is None:
        return low or high
    if low.rank > high.rank:
        low.right = _joined(low.right, high)
        return low
    high.left = _joined(low, high.left)
    return high


class Remaining:
    """The open shards by (remaining capacity, shard): a treap, balanced by mixed numbers."""

    def __init__(self):
        self.root, self.made = None, 0

    def add(self, room: int, shard: int) -> None:
        self.made += 1
        node = Node((room, shard), (self.made * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF)
        low, high = _split(self.root, node.key)
        self.root = _joined(_joined(low, node), high)

    def take_tightest(self, size: int) -> tuple[int, int] | None:
        """Remove and return the shard with the least room that holds ``size``."""
        low, high = _split(self.root, (size, -1))
        if high is None:
            self.root = low
            return None
        least = high
        while least.left is not None:
            least = least.left
        own, rest = _split(high, (least.key[0], least.key[1] + 1))
        self.root = _joined(low, rest)
        return own.key


def best_fit(sizes: list[int], counts: list[int], capacity: int, first: int = 0, most: int | None = None):
    """Pieces (size, from, to, shard) of groups of falling ``sizes``, ``counts`` of each; None when
    more than ``most`` shards would open.  Places are counted from 0 within a size."""
    open_, opened, pieces = Remaining(), 0, []
    for size, count in zip(sizes, counts):
        at = 0
        while at < count:
            found = open_.take_tightest(size)
            if found is None:
                if most is not None and opened == most:
                    return None
                found, opened = (max(capacity, size), first + opened), opened + 1
            room, shard = found
            n = min(count - at, room // size)
            pieces.append((size, at, at + n, shard))
            open_.add(room - n * size, shard)
            at += n
    return pieces


def even(sizes: list[int], counts: list[int], shards: int) -> list[tuple[int, int, int, int]]:
    """Pieces over exactly the shards 0 to ``shards`` - 1, of sizes as near equal as the packing gets."""
    left, alone, pieces = sum(s * c for s, c in zip(sizes, counts)), 0, []
    at = 0
    counts = list(counts)
    while at < len(sizes) and alone < shards - 1 and sizes[at] * (shards - alone) >= left:
        done = sum(1 for p in pieces if p[0] == sizes[at])
        pieces.append((sizes[at], done, done + 1, alone))
        left, alone, counts[at] = left - sizes[at], alone + 1, counts[at] - 1
        if not counts[at]:
            at += 1
    if at == len(sizes):
        return pieces
    skipped = {s: sum(1 for p in pieces if p[0] == s) for s in sizes[at:at + 1]}
    capacity, slack = -(-left // (shards - alone)), 0
    while True:
        rest = best_fit(sizes[at:], counts[at:], capacity + slack, alone, shards - alone)
        if rest is not None:
            return pieces + [(s, a + skipped.get(s, 0), b + skipped.get(s, 0), j) for s, a, b, j in rest]
        slack = max(1, slack * 2)


# ---------------------------------------------------------------- on Spark

def number_rows(docs: DataFrame, paths: list[str] | None = None) -> DataFrame:
    """doc_id, size, text_crc32, the text's key and the row's number, written once."""
    text = F.col("text").cast("string").cast("binary")
    return written(docs.select(
        F.col("doc_id"), (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
        F.coalesce(F.crc32(text), F.lit(0)).cast("long").alias("text_crc32"),
        F.coalesce(F.unhex(F.md5(text)), F.lit(b"")).alias("key"),
        F.monotonically_increasing_id().alias("row")), "shard-rows", paths)


def _ranked(rows: DataFrame, within: str, part, order: str, name: str) -> DataFrame:
    """Rows with their rank (from 0) among those of one ``within``, by (part, order): a rank inside
    the part plus the sizes of the parts before it."""
    rows = rows.withColumn("part", part)
    sizes = rows.groupBy(within, "part").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy(within).orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    starts = sizes.select(within, "part", F.coalesce(before, F.lit(0)).alias("start"))
    inside = F.row_number().over(Window.partitionBy(within, "part").orderBy(order)) - 1
    return (rows.withColumn("inside", inside).join(starts, [within, "part"])
            .withColumn(name, (F.col("start") + F.col("inside")).cast("long")).drop("part", "inside", "start"))


def pack(docs: DataFrame, shards: int | None = SHARDS, capacity: int | None = None) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot and group_size of every row of ``docs``."""
    spark, paths = docs.sparkSession, []
    rows = number_rows(docs, paths)
    groups = written(rows.groupBy("key").agg(F.sum("size").alias("group_size")), "shard-groups", paths)
    runs = written(groups.groupBy("group_size").agg(F.count(F.lit(1)).alias("n")), "shard-sizes", paths)
    if (distinct := runs.count()) > MAX_SIZES:
        raise ValueError(f"{distinct} distinct group sizes; at most {MAX_SIZES} are packed")
    held = runs.orderBy(F.desc("group_size")).toArrow()  # at most MAX_SIZES pairs of numbers
    sizes, counts = held.column("group_size").to_pylist(), held.column("n").to_pylist()
    total = sum(counts)
    pieces = best_fit(sizes, counts, capacity) if capacity else even(sizes, counts, shards)
    cols = list(zip(*pieces)) if pieces else [[], [], [], []]
    pieces = spark.createDataFrame(pa.table({
        "group_size": pa.array(cols[0], pa.int64()), "from_place": pa.array(cols[1], pa.int64()),
        "to_place": pa.array(cols[2], pa.int64()), "shard": pa.array(cols[3], pa.int32())}))
    parts = max(1, -(-total // (1 << PART_BITS)))
    placed = (_ranked(groups, "group_size", F.pmod(F.xxhash64("key"), F.lit(parts)), "key", "place")
              .join(pieces, "group_size").filter("place >= from_place AND place < to_place").select("key", "group_size", "shard"))
    found = written(rows.join(placed, "key").select("doc_id", "size", "text_crc32", "shard", "group_size", "row"), "shard-found")
    for path in paths:
        drop_path(spark, path)
    return _ranked(found, "shard", F.shiftright("row", PART_BITS), "row", "slot").drop("row")


def op12_bfd_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit(LAW).alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
