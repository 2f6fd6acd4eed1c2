"""Language-model scoring by context-tree weighting over bytes.

*Model.*  A text is its words (runs of characters other than 20 and 09-0D hex, A-Z
lower-cased) joined by one blank, as UTF-8, and one end (FF, which UTF-8 never holds).  The context of
a symbol is the ``DEPTH`` symbols before it (FF before the first).  A symbol is coded as
eight binary decisions; each decision has one node for each prefix of the symbol's bits and
each context of 0 to DEPTH bytes.  A node holds how often the decision was 0 and 1 in
training.  Its Krichevsky-Trofimov probability KT and the weighted probability of its
subtree are

    Pw(leaf) = KT,    Pw(node) = 1/2 KT + 1/2 product of Pw over its child contexts.

A decision's probability mixes the KT estimates of all depths: w * KT estimate + (1 - w) *
that of the child, with w = 1/2 KT / Pw(node).  The mix ends at the deepest context that
training has seen (going on with the even odds of an unseen one costs 2.6 % in code length on
held-out texts of sf0.1).  A text's score is the log10 probability of its symbols; code
length per byte follows from it.

*Spark.*  Each block of documents is written with its texts (compressed), its distinct (DEPTH + 1)-grams, numbered in
order, and its distinct words, and how often training documents of the block hold them; Spark sums the
counts over the blocks.  The nodes below each three last bytes are one independent group (at
most 256^(DEPTH-2) grams, however large the corpus).  A first pass over the groups yields only their heads; these
give the small top of the tree, the contexts of 0 to 2 bytes, which is broadcast: 256^3 nodes bound it at any size
of the corpus.  A second pass weighs the groups again and answers the blocks' grams that meet them
in the same shuffle with their log10 probability, held-out ones too.  So every node is used, none is ever
gathered or written, and the blocks get back one number a distinct gram.

*Base score.*  Word counts of the corpus may be of any size, so they are never broadcast: blocks
and counts meet by joins.

Cases: NULL and blank text have only the end.  Without training documents every decision has
probability 1/2 and the base score is 0 a token.  Repeated rows are counted and scored each
by itself.  Only doc_id and text are read.
"""

from __future__ import annotations

import itertools
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.pandas.types import to_arrow_schema

from tierline.llm.common import blocks, drop_path, hash_mod, scratch, table, texts_of, written

DEPTH = 5
#: Bytes of context that deal the nodes into groups.
TOP = 3
END = 255
#: Text bytes scored at once.
PIECE = 1 << 20
#: Text bytes of a block of documents, which one task holds; the larger, the fewer grams repeat.
BLOCK_TEXT = 64 << 20
#: Grams of a block held before equal ones merge.
MERGE_GRAMS = 1 << 21
#: Rows a task collects before it works on whole groups.
GROUP_ROWS = 1 << 18


def normal(data: np.ndarray, off: np.ndarray) -> list[bytes]:
    """The texts as their words joined by one blank."""
    return [b" ".join(data[off[i]:off[i + 1]].tobytes().lower().split()) for i in range(len(off) - 1)]


def symbols(texts: list[bytes], depth: int = DEPTH) -> tuple[np.ndarray, np.ndarray]:
    """The gram (context, symbol) of each symbol as one integer, the latest byte lowest; and the
    offsets of the texts among them (each has its bytes and one end)."""
    gap = bytes([END]) * (depth + 1)
    padded = np.frombuffer(gap[1:] + gap.join(texts) + gap, np.uint8)
    grams = np.zeros(len(padded) - depth, np.uint64)
    for j in range(depth + 1):
        grams <<= np.uint64(8)
        grams |= padded[j:len(padded) - depth + j]
    size = np.array([len(t) + 1 for t in texts], np.int64)
    starts = np.concatenate(([0], np.cumsum(size + depth)))[:-1]
    out = np.concatenate(([0], np.cumsum(size)))
    parts = [grams[i:i + n] for i, n in zip(starts.tolist(), size.tolist())]
    return np.concatenate(parts) if parts else grams[:0], out


def counted_grams(grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct grams in order and how often each occurs."""
    grams = np.sort(grams)
    first = np.flatnonzero(np.concatenate(([True], grams[1:] != grams[:-1]))) if len(grams) else np.empty(0, np.int64)
    return grams[first], np.diff(np.append(first, len(grams)))


def merge(keys: list, counts: list) -> tuple[np.ndarray, np.ndarray]:
    k, n = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(k)
    k, n = k[order], n[order]
    first = np.flatnonzero(np.concatenate(([True], k[1:] != k[:-1]))) if len(k) else np.empty(0, np.int64)
    return k[first], np.add.reduceat(n, first) if len(first) else n


#: Log gamma of n + 1/2 and of n + 1 for small whole n.
HALVES = np.array([math.lgamma(n + 0.5) for n in range(1 << 14)])
WHOLES = np.array([math.lgamma(n + 1.0) for n in range(1 << 14)])


def log_gamma(n: np.ndarray, add: float, small: np.ndarray) -> np.ndarray:
    out = small[np.minimum(n, len(small) - 1).astype(np.int64)]
    large = np.flatnonzero(n >= len(small))
    out[large] = [math.lgamma(x + add) for x in n[large].tolist()]
    return out


def log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Log of the Krichevsky-Trofimov probability of so many zeros and ones."""
    return (log_gamma(zeros, 0.5, HALVES) + log_gamma(ones, 0.5, HALVES)
            - log_gamma(zeros + ones, 1.0, WHOLES) - math.log(math.pi))


def weigh(kt: np.ndarray, children: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(log Pw, weight of the node's own estimate) from log KT and the sum of the children's log Pw."""
    pw = np.logaddexp(kt, children) - math.log(2)
    return pw, np.exp(kt - math.log(2) - pw)


def group_by(keys: np.ndarray, *values: np.ndarray) -> list[np.ndarray]:
    uniq, code = np.unique(keys, return_inverse=True)
    return [uniq, *(np.bincount(code, v, len(uniq)) for v in values)]


def parent(nodes: np.ndarray, depth: int) -> np.ndarray:
    """The node one byte of context shorter: the byte farthest back goes."""
    return nodes & np.uint64((1 << (8 * depth)) - 1)


def subtree(grams: np.ndarray, n: np.ndarray, depth: int, top: int, only_heads: bool = False) -> tuple[np.ndarray, list[np.ndarray]]:
    """What the nodes of ``depth`` up to ``top`` bytes of context say of whole groups of
    distinct grams, of which training holds ``n`` each (0: none): the probability of each
    gram's eight decisions, -1 where training has seen no context of ``top`` bytes (not
    worked out for ``only_heads``); and the seen nodes of ``top``: [node, zeros, ones, log Pw].  A node's integer is its context and, in
    the lowest byte, its bit prefix behind a leading 1."""
    p = np.full((8, len(grams)), -1.0)
    below: list = [None] * 8
    heads = []
    for d in range(depth, top - 1, -1):
        # The grams by their last d + 1 bytes; all nodes of a bit prefix are runs of these.
        tails, first, code = np.unique(parent(grams, d + 1), return_index=True, return_inverse=True)
        count = np.bincount(code, n, len(tails))
        for k in range(8):
            prefix = tails >> np.uint64(8 - k)
            start = np.flatnonzero(np.concatenate(([True], prefix[1:] != prefix[:-1])))
            run = np.repeat(np.arange(len(start)), np.diff(np.append(start, len(tails))))
            bit = ((tails >> np.uint64(7 - k)) & np.uint64(1)).astype(bool)
            ones = np.bincount(run, np.where(bit, count, 0), len(start))
            zeros = np.bincount(run, np.where(bit, 0, count), len(start))
            pw = kt = log_kt(zeros, ones)
            weight = np.ones(len(start))
            if d < depth:
                example, lower = below[k]  # a gram of each node below, and its log Pw
                pw, weight = weigh(kt, np.bincount(run[code[example]], lower, len(start)))
            below[k] = first[start], pw
            if not only_heads:
                own = (ones + 0.5) / (zeros + ones + 1)
                own = np.where(bit, own[run], 1 - own[run])
                p[k] = mixed(p[k], (zeros + ones > 0)[run][code], weight[run][code], own[code])
            if d == top:
                seen = zeros + ones > 0
                node = ((tails[start] & ~np.uint64(255)) | np.uint64(1 << k) | (prefix[start] & np.uint64((1 << k) - 1)))
                heads.append((node[seen], zeros[seen], ones[seen], pw[seen]))
    return p, [np.concatenate(x) for x in zip(*heads)]


def mixed(deeper: np.ndarray, seen: np.ndarray, weight: np.ndarray, own: np.ndarray) -> np.ndarray:
    """Probabilities of the deeper contexts (-1: unseen) mixed with a context's own."""
    return np.where(seen, np.where(deeper < 0, own, weight * own + (1 - weight) * deeper), deeper)


class Top:
    """The nodes of few bytes of context, sorted: of each depth the nodes, P(1) by KT, weights."""

    def __init__(self, depths: list[tuple[np.ndarray, np.ndarray, np.ndarray]]):
        self.depths = depths

    def log10(self, grams: np.ndarray, p: np.ndarray) -> np.ndarray:
        """log10 probability of each gram's symbol, from what the nodes below the top say."""
        total = np.zeros(len(grams))
        for k in range(8):
            q = p[k]
            bit = ((grams >> np.uint64(7 - k)) & np.uint64(1)).astype(bool)
            for d in range(len(self.depths) - 1, -1, -1):
                nodes, p1, weight = self.depths[d]
                if not len(nodes):
                    continue
                x = grams & np.uint64(255)
                node = parent(grams & ~np.uint64(255), d + 1) | np.uint64(1 << k) | (x >> np.uint64(8 - k))
                at = np.minimum(np.searchsorted(nodes, node), len(nodes) - 1)
                q = mixed(q, nodes[at] == node, weight[at], np.where(bit, p1[at], 1 - p1[at]))
            total += np.log10(np.where(q < 0, 0.5, q))
        return total


def context(column: str, size: int) -> Column:
    """The last ``size`` bytes of the context of a gram or node."""
    return F.shiftright(column, 8).bitwiseAND((1 << (8 * size)) - 1)


def near(keys: np.ndarray, size: int) -> np.ndarray:
    return (keys >> 8) & ((1 << (8 * size)) - 1)


def whole_groups(batches, size: int, least: int = GROUP_ROWS):
    """Columns of a partition sorted by the context of its first column, in pieces of whole groups."""
    held: list = []
    for batch in batches:
        held.append(batch)
        if sum(x.num_rows for x in held) >= least:
            rows = pa.Table.from_batches(held)
            group = near(rows.column(0).to_numpy(), size)
            cut = int(np.searchsorted(group, group[-1]))
            if cut:
                yield [c.to_numpy()[:cut] for c in rows.columns]
                held = rows.slice(cut).to_batches()
    if held and sum(x.num_rows for x in held):
        yield [c.to_numpy() for c in pa.Table.from_batches(held).columns]


def _batch(schema: pa.Schema, n: int, **cols) -> pa.RecordBatch:
    """``n`` rows with the given columns; the others NULL."""
    return pa.RecordBatch.from_arrays([
        pa.nulls(n, f.type) if f.name not in cols else cols[f.name] if isinstance(cols[f.name], pa.Array)
        else pa.array(cols[f.name], f.type) for f in schema], schema=schema)


def _sliced(schema: pa.Schema, rows: int, **cols):
    n = len(next(iter(cols.values())))
    for i in range(0, n, rows):
        own = {k: v[i:i + rows] for k, v in cols.items()}
        yield _batch(schema, len(next(iter(own.values()))), **own)


def top_of(counts: DataFrame, depth: int = DEPTH) -> Top:
    """The top of the tree of all grams (gram, n): the contexts of fewer than ``TOP`` bytes."""
    spark, paths = counts.sparkSession, []
    top = min(TOP, depth)
    head_schema = StructType.fromDDL("node long, zeros double, ones double, pw double")
    head_arrow = to_arrow_schema(head_schema)
    middle_schema = StructType.fromDDL("depth int, node long, p1 double, weight double, zeros double, ones double, pw double")
    middle_arrow = to_arrow_schema(middle_schema)

    def heads_part(batches):
        for gram, n in whole_groups(batches, top):
            node, zeros, ones, pw = subtree(gram.astype(np.uint64), n, depth, top, only_heads=True)[1]
            yield from _sliced(head_arrow, 1 << 16, node=node.astype(np.int64), zeros=zeros, ones=ones, pw=pw)

    def middle_part(batches):
        for node, zeros, ones, pw in whole_groups(batches, 1):
            node = node.astype(np.uint64)
            for d in range(top - 1, 0, -1):
                node, zeros, ones, below = group_by(parent(node, d + 1), zeros, ones, pw)
                pw, weight = weigh(log_kt(zeros, ones), below)
                needed = {"zeros": zeros, "ones": ones, "pw": pw} if d == 1 else {}  # by the level above
                yield _batch(middle_arrow, len(node), depth=np.full(len(node), d), node=node.astype(np.int64),
                             p1=(ones + 0.5) / (zeros + ones + 1), weight=weight, **needed)

    own = counts.filter("n > 0").select("gram", "n")
    heads = own.repartition(context("gram", top)).sortWithinPartitions(context("gram", top)).mapInArrow(heads_part, head_schema)
    depths = []
    if top > 1:
        dealt = heads.repartition(context("node", 1)).sortWithinPartitions(context("node", 1))
        middle = written(dealt.mapInArrow(middle_part, middle_schema), "ctw-middle", paths)
        for d in range(1, top):  # fewer than 256 ** (d + 1) nodes
            rows = middle.filter(F.col("depth") == d).select("node", "p1", "weight").sort("node").toArrow()
            depths.append((rows.column("node").to_numpy().astype(np.uint64),
                           *(rows.column(c).to_numpy() for c in ("p1", "weight"))))
        heads = middle.filter(F.col("depth") == 1)
    rows = heads.select("node", "zeros", "ones", "pw").toArrow()  # fewer than 256 * 256
    for path in paths:
        drop_path(spark, path)
    node, zeros, ones, below = group_by(parent(rows.column("node").to_numpy().astype(np.uint64), 1),
                                        *(rows.column(c).to_numpy() for c in ("zeros", "ones", "pw")))
    _, weight = weigh(log_kt(zeros, ones), below)
    return Top([(node, (ones + 0.5) / (zeros + ones + 1), weight), *depths])


def bundled(block: np.ndarray, place: np.ndarray, log10: np.ndarray) -> tuple[np.ndarray, list[bytes], list[bytes]]:
    """For each block the places, as compressed steps, and their values, as doubles."""
    order = np.lexsort((place, block))
    block, place, log10 = block[order], place[order], log10[order]
    start = np.flatnonzero(np.concatenate(([True], block[1:] != block[:-1])))
    cuts = list(zip(start.tolist(), [*start[1:].tolist(), len(block)]))
    steps = [np.diff(place[a:b], prepend=0).astype(np.int32).tobytes() for a, b in cuts]
    return block[start], [pa.compress(x, codec="zstd", asbytes=True) for x in steps], [log10[a:b].tobytes() for a, b in cuts]


def unbundled(places: list[bytes], values: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    steps = [np.frombuffer(pa.decompress(p, decompressed_size=len(v) // 2, codec="zstd", asbytes=True), np.int32)
             for p, v in zip(places, values)]
    return np.concatenate([np.cumsum(x) for x in steps]), np.frombuffer(b"".join(values))


ASKED = "block long, places binary, log10 binary"


def answers(counts: DataFrame, asked: DataFrame, depth: int = DEPTH) -> DataFrame:
    """(block, places, log10), bundles of the ``asked`` grams (block, place, gram), each among ``counts`` (gram,
    n; 0: training has none).  Asked grams meet their group's counts in one shuffle, behind them in the sort
    order, and stream past the weighed group: a group holds its counts in memory, never what is asked of it."""
    top = min(TOP, depth)
    shared = counts.sparkSession.sparkContext.broadcast(top_of(counts, depth).depths)
    schema = StructType.fromDDL(ASKED)
    arrow = to_arrow_schema(schema)

    def part(batches):
        model = Top(shared.value)
        held: list = []  # counts not weighed yet, and what their groups are asked
        known = np.empty(0, np.int64), np.empty(0)

        def weighed(rows):
            gram = np.concatenate([r[0] for r in rows])
            p, _ = subtree(gram.astype(np.uint64), np.concatenate([r[1] for r in rows]), depth, top)
            order = np.argsort(gram)
            return gram[order], model.log10(gram.astype(np.uint64), p)[order]

        def answer(rows):
            gram, block, place = (np.concatenate([r[c] for r in rows]) for c in range(3))
            if len(gram):
                order = np.argsort(gram)  # sorted needles are found faster
                value = known[1][np.searchsorted(known[0], gram[order])]
                of, places, values = bundled(block[order], place[order], value)
                yield from _sliced(arrow, 1 << 12, block=of, places=places, log10=values)

        # Batches run count rows, asked rows, count rows ... by group; several groups are weighed at once.
        fresh, waiting, open_group = [], [], None
        for batch in batches:
            gram = batch.column(0).to_numpy()
            is_count = np.asarray(batch.column(1).is_valid())
            if not len(gram):
                continue
            group = near(gram, top)
            n = batch.column(1).fill_null(0).to_numpy()
            block, place = (batch.column(c).fill_null(0).to_numpy() for c in (2, 3))
            cut = int(np.searchsorted(group, group[-1]))  # where the batch's last group begins
            for own, closes in ((slice(0, cut), True), (slice(cut, len(gram)), False)):
                if group[own].size == 0:
                    continue
                if closes is False and open_group != group[-1] and sum(len(r[0]) for r in fresh) + sum(len(r[0]) for r in waiting) >= GROUP_ROWS:
                    known = weighed(fresh)
                    yield from answer(waiting)
                    fresh, waiting = [], []
                c = is_count[own]
                fresh.append((gram[own][c], n[own][c]))
                waiting.append((gram[own][~c], block[own][~c], place[own][~c]))
            open_group = group[-1]
            # A group asked so much that it fills the memory: its counts came first and are whole.
            if not is_count[-1] and sum(len(r[0]) for r in waiting) >= 4 * GROUP_ROWS:
                known = weighed(fresh)
                yield from answer(waiting)
                waiting = []
                last = [(g[near(g, top) == open_group], m[near(g, top) == open_group]) for g, m in fresh]
                fresh = last
        if fresh:
            known = weighed(fresh)
            yield from answer(waiting)

    rows = (counts.select("gram", "n", F.lit(None).cast("long").alias("block"), F.lit(None).cast("int").alias("place"))
            .unionByName(asked.select("gram", F.lit(None).cast("long").alias("n"), "block", "place")))
    group = context("gram", top)
    return rows.repartition(group).sortWithinPartitions(group, F.col("n").isNull()).mapInArrow(part, schema)


class Trained:
    """The model of some training texts, for scoring given grams."""

    def __init__(self, counts: DataFrame, depth: int):
        self.counts, self.depth = counts, depth

    def log10(self, grams: np.ndarray) -> np.ndarray:
        """log10 probability of each gram's symbol in its context."""
        spark = self.counts.sparkSession
        asked = spark.createDataFrame([(0, i, int(g)) for i, g in enumerate(grams)], "block long, place int, gram long")
        counts = self.counts.union(asked.selectExpr("gram", "0L")).groupBy("gram").agg(F.sum("n").alias("n"))
        rows = answers(counts, asked, self.depth).collect()
        place, value = unbundled([r["places"] for r in rows], [r["log10"] for r in rows])
        return value[np.argsort(place)]


def train(docs: DataFrame, depth: int = DEPTH) -> Trained:
    """The model of all texts of ``docs``."""
    rows = _read_blocks(docs, F.lit(False), depth).filter(F.col("kind") == GRAM)
    return Trained(written(rows.groupBy("gram").agg(F.sum("n_train").alias("n")), "ctw-grams"), depth)


TEXT, GRAM, WORD = range(3)
BLOCK = "kind int, block long, texts binary, ends long, gram long, place int, word binary, n_train long"


def _read_blocks(docs: DataFrame, held_out: Column, depth: int) -> DataFrame:
    """For each block of documents: a row for each piece of its documents (id, whether held out and words joined by
    blanks, compressed) with its number of training documents, a row a distinct gram with its place in order, and a row a distinct
    word, both with their training counts in the block."""
    schema = StructType.fromDDL(BLOCK)
    arrow = to_arrow_schema(schema)
    texts_of(docs)  # bounds the batches

    def read(batches):
        from collections import Counter

        from pyspark import TaskContext

        number = (TaskContext.get().partitionId() << 24) - 1

        def counted(keys, counts, words):
            gram, n = merge(keys, counts)
            yield from _sliced(arrow, 1 << 16, kind=np.full(len(gram), GRAM), block=np.full(len(gram), number), gram=gram.astype(np.int64),
                               place=np.arange(len(gram)), n_train=n)
            yield from _sliced(arrow, 1 << 15, kind=np.full(len(words), WORD), block=np.full(len(words), number), word=list(words), n_train=list(words.values()))

        keys: list = []
        for rows, raw, cut in blocks(batches, limit=PIECE):
            if not keys:
                number += 1
                counts, words, size, fresh = [], Counter(), 0, 0
            kept = ~np.array(rows.column(2).to_pylist(), bool)
            texts = normal(raw, cut)
            for training in (True, False):
                own = [t for t, k in zip(texts, kept.tolist()) if k == training]
                if own:
                    uniq, n = counted_grams(symbols(own, depth)[0])
                    keys.append(uniq)
                    counts.append(n if training else np.zeros_like(n))
                    fresh += len(uniq)
                    for t in own:
                        words.update(t.split() if training else dict.fromkeys(t.split(), 0))
            yield _batch(arrow, 1, kind=[TEXT], block=[number], texts=[packed(rows.column(0), rows.column(2), texts)], ends=[int(kept.sum())])
            size += len(raw)
            if size > BLOCK_TEXT:
                yield from counted(keys, counts, words)
                keys = []
            elif fresh > MERGE_GRAMS:
                gram, n = merge(keys, counts)
                keys, counts, fresh = [gram], [n], 0
        if keys:
            yield from counted(keys, counts, words)

    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"), held_out.alias("held_out"))
    return rows.mapInArrow(read, schema)


def _written_by_kind(rows: DataFrame) -> tuple[DataFrame, str]:
    """The block rows in one folder a kind, so that one kind can be deleted before the others."""
    spark, path = rows.sparkSession, scratch(rows.sparkSession, "ctw-blocks")
    # A file a kind is open at once, so that rows need no sort before they are written.
    writers = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(writers)
    spark.conf.set(writers, "3")
    try:
        rows.write.partitionBy("kind").parquet(path, compression="zstd")
    finally:
        spark.conf.set(writers, before)
    return spark.read.schema(rows.schema).option("basePath", path).parquet(path), path


def packed(doc_id: pa.Array, held_out: pa.Array, texts: list[bytes]) -> bytes:
    """Documents as one compressed Arrow stream."""
    batch = pa.RecordBatch.from_arrays([doc_id, held_out, pa.array(texts, pa.binary())], ["doc_id", "held_out", "text"])
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", 3))) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def score(docs: DataFrame, held_out: Column, depth: int = DEPTH) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score and bits_per_byte."""
    spark, paths = docs.sparkSession, []
    docs = docs.select("doc_id", "text", held_out.alias("held_out"))
    rows, folder = _written_by_kind(_read_blocks(docs, F.col("held_out"), depth))
    paths.append(folder)
    grams = rows.filter(F.col("kind") == GRAM)
    words = rows.filter(F.col("kind") == WORD).select("block", "word", "n_train")
    pieces = rows.filter(F.col("kind") == TEXT).select("block", "texts", "ends")
    counts = written(words.groupBy("word").agg(F.sum("n_train").alias("n")).filter("n > 0"), "ctw-words", paths)
    total, distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    ends = pieces.agg(F.coalesce(F.sum("ends"), F.lit(0))).first()[0]
    total, distinct = total + ends, distinct + (ends > 0)
    unit = math.log10(total + distinct + 1)
    summed = written(grams.groupBy("gram").agg(F.sum("n_train").alias("n")), "ctw-grams", paths, compression="zstd")
    scores = written(answers(summed, grams.select("block", "place", "gram"), depth), "ctw-answers", paths)
    drop_path(spark, paths.pop(-2))  # the summed grams
    drop_path(spark, f"{folder}/kind={GRAM}")
    none = F.lit(None)
    known = (scores.select(F.col("block").alias("of_block"), "places", "log10", none.cast("binary").alias("word"), none.cast("long").alias("n"))
             .union(words.join(counts, "word").select("block", none.cast("binary"), none.cast("binary"), "word", "n")))

    schema = StructType([docs.schema["doc_id"], *StructType.fromDDL(
        "held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, "
        "bits_per_byte double").fields])
    arrow = to_arrow_schema(schema)

    def finish(texts_of_block, known_of_block):
        import pandas as pd
        import pyarrow.compute as pc

        scored = known_of_block.filter(pc.is_valid(known_of_block.column("places")))
        place, log10 = unbundled(scored.column("places").to_pylist(), scored.column("log10").to_pylist())
        of_place = np.empty(len(place))
        of_place[place] = log10
        counted = known_of_block.filter(pc.is_valid(known_of_block.column("word")))
        n_of = dict(zip(counted.column("word").to_pylist(), counted.column("n").to_pylist()))
        streams = texts_of_block.column("texts").to_pylist()
        of_piece = lambda t: pa.ipc.open_stream(t).read_next_batch()
        # The block's grams, in the order that numbered them.
        found: list = []
        for t in streams:
            found.append(counted_grams(symbols(of_piece(t).column("text").to_pylist(), depth)[0])[0])
            if sum(map(len, found[1:])) > MERGE_GRAMS:
                found = [counted_grams(np.concatenate(found))[0]]
        order = counted_grams(np.concatenate(found))[0]
        out = []
        for batch in map(of_piece, streams):
            texts = batch.column("text").to_pylist()
            size = np.array([len(t) for t in texts], np.int64)
            code, uniq = pd.factorize(symbols(texts, depth)[0])
            by = np.argsort(uniq)
            value = np.empty(len(uniq))
            value[by] = of_place[np.searchsorted(order, uniq[by])]
            own = np.add.reduceat(value[code], np.concatenate(([0], np.cumsum(size + 1)))[:-1])
            split = [t.split() for t in texts]
            tokens = np.array([len(x) + 1 for x in split])
            n = np.fromiter(itertools.chain.from_iterable(itertools.chain(map(n_of.get, x, itertools.repeat(0)), (ends,)) for x in split),
                            np.int64, int(tokens.sum()))
            at = np.concatenate(([0], np.cumsum(tokens)))[:-1]
            known_tokens = np.add.reduceat((n > 0).astype(np.int64), at)
            base = np.add.reduceat(np.log10(n + 1), at) - tokens * unit
            out.append(pa.RecordBatch.from_arrays([
                batch.column("doc_id").cast(arrow.field(0).type), batch.column("held_out"), pa.array(tokens, pa.int64()),
                pa.array(known_tokens, pa.int64()), pa.array(np.full(len(texts), total)), pa.array(base, pa.float64()),
                pa.array(own), pa.array(-own * math.log2(10) / np.maximum(size, 1))], schema=arrow))
        return pa.Table.from_batches(out, schema=arrow)

    done = written(pieces.select("block", "texts").groupBy("block").cogroup(known.groupBy("of_block")).applyInArrow(finish, schema), "ctw-scores")
    for path in paths:
        drop_path(spark, path)
    return done


def op7_ctw_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(table(spark, sf_dir, "documents"), hash_mod(F.col("doc_id"), 7) == 2)
