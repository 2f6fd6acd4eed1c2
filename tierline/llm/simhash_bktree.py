"""SimHash near-duplicates: 64-bit fingerprints, linked through BK-trees.

*Fingerprint.*  Words are runs of non-blank characters, A-Z lower-cased; each shingle of
``size`` words (a shorter text is one shingle) gives XXH64 with seed 42; a bit of the
fingerprint is 1 when it is set in over half the hashes.  A text without words has
fingerprint zero.

*Links.*  Two fingerprints link at ``radius`` or fewer differing bits.  Radius + 1 bands of
the 64 bits route every distinct fingerprint to radius + 1 shards: two fingerprints that
differ in at most ``radius`` bits agree in one band at least, so every link is found in the
shard of that band.  A shard is a BK-tree: children hang below their parent by their integer
Hamming distance to it, and a search with distance d at a node follows only the edges
d - radius to d + radius.  The trees meet their queries by a shuffle on the shard key; all
trees together grow with the corpus, so they are not broadcast.  A shard with more than
``tree_size`` fingerprints becomes several trees of bounded size, and each of its
fingerprints then searches all of them, in chunks of bounded size too.  A tree reports a spanning forest of its links, not
all pairs: components need no more, and a group of a million near copies yields under a
million rows.

Cases: NULL and blank texts share fingerprint zero and link like any others.  Repeated rows
each get a row.  A NULL doc_id never becomes a component id unless its whole component has
none.  An empty table gives an empty result.  Only doc_id and text are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierline.llm.common import free_name, table, with_columns, written
from tierline.llm.components import connected_components

SHINGLE_WORDS = 3
RADIUS = 2
SEED = 42
TREE_SIZE = 4096
#: Trees whose fingerprints visit another tree together, as one group.
VISITING_TREES = 8


def fingerprint(text: bytes, size: int = SHINGLE_WORDS) -> int:
    """SimHash of one text, as an unsigned 64-bit integer."""
    import xxhash

    words = text.lower().split()  # bytes: lowers A-Z only, splits at 09-0D and 20
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    size = min(size, len(words))
    one = xxhash.xxh64_intdigest
    n = len(words) - size + 1
    h = np.fromiter((one(joined[a:b], SEED) for a, b in zip(starts[:n].tolist(), ends[size - 1:].tolist())),
                    np.uint64, n)
    ones = np.zeros(64, np.int64)
    for i in range(0, n, 4096):
        ones += np.unpackbits(h[i:i + 4096].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > n).tobytes(), "big")


def fingerprints(docs: DataFrame, size: int = SHINGLE_WORDS) -> DataFrame:
    """doc_id and ``fp``, the fingerprint's bits as a signed long."""
    def start():
        def handle(data, off):
            out = [fingerprint(data[off[i]:off[i + 1]].tobytes(), size) for i in range(len(off) - 1)]
            return [[x - (1 << 64) if x >> 63 else x for x in out]]
        return handle

    return with_columns(docs, start, "fp long")


class BKTree:
    """Children keyed by their integer Hamming distance to the parent."""

    def __init__(self):
        self.values: list[int] = []
        self.children: list[dict[int, int]] = []

    def add(self, value: int) -> None:
        node = 0
        while self.values:
            d = (self.values[node] ^ value).bit_count()
            if d not in self.children[node]:
                self.children[node][d] = len(self.values)
                break
            node = self.children[node][d]
        self.values.append(value)
        self.children.append({})

    def search(self, value: int, radius: int) -> list[int]:
        found, todo = [], [0] if self.values else []
        while todo:
            node = todo.pop()
            d = (self.values[node] ^ value).bit_count()
            if d <= radius:
                found.append(self.values[node])
            todo += [c for e, c in self.children[node].items() if d - radius <= e <= d + radius]
        return found


def shard_links(members: list[int], visitors: list[int], radius: int, home: bool = True) -> list[tuple[int, int]]:
    """Spanning forest of the links inside one shard tree and from its visitors to it; without
    the links inside it, which another group reports, when the group is not ``home``."""
    tree, parent, links = BKTree(), {}, []

    def root(x):
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for value, own in [(m, True) for m in members] + [(v, False) for v in visitors]:
        for near in tree.search(value, radius):
            a, b = root(value), root(near)
            if a != b:
                parent[a] = b
                if home or not own:
                    links.append((value, near))
        if own:
            tree.add(value)
    return links


def bands(radius: int) -> list[tuple[int, int]]:
    """(shift, width) of radius + 1 bands that cover the 64 bits."""
    cut = [64 * i // (radius + 1) for i in range(radius + 2)]
    return [(a, b - a) for a, b in zip(cut, cut[1:])]


def placed(fps: DataFrame, radius: int, tree_size: int) -> DataFrame:
    """The groups (band, part, tree, chunk) of each distinct ``fp``, as a member or a visitor."""
    keys = F.array(*[F.struct(F.lit(i).alias("band"), F.shiftrightunsigned("fp", shift).bitwiseAND((1 << width) - 1).alias("part"))
                     for i, (shift, width) in enumerate(bands(radius))])
    routed = fps.select("fp", F.explode(keys).alias("k")).select("fp", "k.band", "k.part")
    # Shards above one tree's size are few and known by count; only they get a number over 1.
    large = (routed.groupBy("band", "part").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > tree_size)
             .select("band", "part", F.ceil(F.col("n") / tree_size).cast("int").alias("trees")))
    routed = routed.join(large, ["band", "part"], "left").withColumn("trees", F.coalesce("trees", F.lit(1)))
    own = F.pmod(F.xxhash64(F.lit(7), "fp"), F.col("trees")).cast("int")
    routed = routed.withColumn("own", own).withColumn("home", F.floor(F.col("own") / VISITING_TREES).cast("int"))
    # A fingerprint lives in its own tree and searches the trees numbered above it.  Visitors
    # come in chunks, and a tree is there once for each chunk: no group grows with the shard.
    group = lambda tree, chunk, member: F.struct(tree.alias("tree"), chunk.alias("chunk"), member.alias("member"))
    searched = F.transform(F.sequence("own", F.col("trees") - 1), lambda t: group(t, F.col("home"), t == F.col("own")))
    visited = F.transform(F.sequence(F.lit(0), F.col("home")), lambda c: group(F.col("own"), c, F.lit(True)))
    visited = F.filter(visited, lambda g: g["chunk"] < F.col("home"))
    return (routed.select("fp", "band", "part", F.explode(F.concat(searched, visited)).alias("g"))
            .select("fp", "band", "part", "g.tree", "g.chunk", "g.member"))


def links(fps: DataFrame, radius: int = RADIUS, tree_size: int = TREE_SIZE) -> DataFrame:
    """Links ``(a, b)`` between the distinct ``fp`` that connect all within ``radius`` bits."""
    group = ["band", "part", "tree", "chunk"]
    dealt = placed(fps, radius, tree_size).repartition(*group).sortWithinPartitions(*group, F.desc("member"), "fp")

    def search(batches):
        key, members, visitors = None, [], []

        def flush():
            home = key is None or key[2] // VISITING_TREES == key[3]
            found = shard_links(members, visitors, radius, home) if len(members) + len(visitors) > 1 else []
            return [(a - (1 << 64) if a >> 63 else a, b - (1 << 64) if b >> 63 else b) for a, b in found]

        out = []
        for batch in batches:
            for fp, band, part, tree, chunk, member in zip(*(c.to_pylist() for c in batch.columns)):
                if (band, part, tree, chunk) != key:
                    out += flush()
                    key, members, visitors = (band, part, tree, chunk), [], []
                (members if member else visitors).append(fp & ((1 << 64) - 1))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], pa.int64()) for i in (0, 1)], ["a", "b"])
                out = []
        out = flush()
        yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], pa.int64()) for i in (0, 1)], ["a", "b"])

    return dealt.mapInArrow(search, "a long, b long")


def _groups(distinct: DataFrame, radius: int, tree_size: int) -> DataFrame:
    """(fp, root) of distinct fingerprints, equal for all that links connect."""
    roots = connected_components(links(distinct.select("fp"), radius, tree_size))
    return distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))


def near_duplicates(docs: DataFrame, size: int = SHINGLE_WORDS, radius: int = RADIUS,
                    tree_size: int = TREE_SIZE) -> DataFrame:
    """doc_id, fingerprint (hex) and component_id, the least doc_id reachable over links."""
    prints = written(fingerprints(docs, size), "simhash")
    distinct = written(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "simhash-distinct")
    named = _groups(distinct, radius, tree_size)
    least = named.groupBy("root").agg(F.min("first_id").alias("component_id"))
    group = named.join(least, "root").select("fp", "component_id")
    return prints.join(group, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_first(docs: DataFrame, size: int = SHINGLE_WORDS, radius: int = RADIUS, tree_size: int = TREE_SIZE) -> DataFrame:
    """Rows of ``docs`` that stay when one row of each near-duplicate group is kept: the one
    with the least doc_id (NULL last), among these with the least text hash.  Ids may be NULL or
    repeated: groups are of texts, and the verdict is carried by the row's written number."""
    number = free_name(docs, "_row_number")
    rows = written(docs.withColumn(number, F.monotonically_increasing_id()), "simhash-rows")
    # The row number goes through the fingerprints in the place of the id.
    prints = fingerprints(rows.select(F.col(number).alias("doc_id"), "text"), size).withColumnRenamed("doc_id", "row")
    ranks = rows.select(F.col(number).alias("row"), "doc_id", F.xxhash64(F.col("text").cast("string")).alias("hash"))
    prints = written(prints.join(ranks, "row"), "simhash")
    rank = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "hash", "row")
    distinct = written(prints.groupBy("fp").agg(F.min(rank).alias("first")), "simhash-distinct")
    kept = _groups(distinct, radius, tree_size).groupBy("root").agg(F.min("first").alias("first"))
    kept = kept.select(F.col("first.row").alias(number))
    return rows.join(kept, number, "left_semi").select(*(rows[f"`{c}`"] for c in docs.columns))


def op8_simhash_bktree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
