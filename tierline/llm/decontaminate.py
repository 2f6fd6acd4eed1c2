"""Benchmark decontamination over suffix arrays of the training documents.

Words are runs of letters, digits and characters beyond ASCII, A-Z lower-cased.  Each task
builds suffix arrays over shards of its documents: the word positions of a shard sorted by
the words that follow.  Words that the benchmark lacks end a match, so a position is in the
array only if benchmark words reach from it as far as the shortest window; all others can
match nothing.  Every suffix of every benchmark item is then searched in each shard's array
by bisection, all suffixes at once; the ranges found give the places of each window
(``window`` words, or a whole shorter item), and places that follow one another along item
and document are one longer match.

The benchmark is the small side and its size is checked: it is read to the driver in blocks of at most
``block_bytes`` of text, each broadcast for one pass over the documents.

Cases: NULL has no words; a document without words is clean.  Items without words have no
window.  Equal windows of several items count for each item.  Items that repeat an item_id
are one item; a NULL item_id is listed as "null".  Repeated document rows each get a row.
Other columns are not read, or come back as they were.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.pandas.types import to_arrow_schema

from tierline.llm.common import blocks, free_name, table, texts_of, written

WINDOW = 10
BLOCK_BYTES = 32 << 20
SHARD_BYTES = 2 << 20

#: Word bytes to themselves, A-Z to a-z, all others to a blank.
WORD_TABLE = bytes(c if 48 <= c < 58 or 97 <= c < 123 or c >= 128 else c + 32 if 65 <= c < 91 else 32 for c in range(256))
_PER_KEY = 3  # word ids in one sort column
_BITS = 21


def words_of(text: bytes) -> list[bytes]:
    return text.translate(WORD_TABLE).split()


class Benchmark:
    """Benchmark windows in word ids, for searching shards.  ``items``: (name, words)."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int = WINDOW):
        self.window = window
        names: dict[str, int] = {}
        self.vocabulary: dict[bytes, int] = {}
        windows: dict[tuple, int] = {}
        self.places: list[list[tuple[int, int]]] = []  # of each window: (item, its word)
        for name, words in items:
            item = names.setdefault(name, len(names))
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words]
            for i in range(max(len(ids) - window, 0) + 1) if ids else ():
                w = windows.setdefault(tuple(ids[i:i + window]), len(self.places))
                if w == len(self.places):
                    self.places.append([])
                self.places[w].append((item, i))
        if len(self.vocabulary) >= 1 << _BITS:
            raise ValueError("a benchmark block holds too many different words; lower block_bytes")
        self.names = list(names)
        self.size = np.array([len(w) for w in windows], np.int64)
        self.least = int(self.size.min()) if windows else 0
        padded = np.zeros((len(windows), window), np.int64)
        for k, w in enumerate(windows):
            padded[k, :len(w)] = w
        self.low = pack(padded)
        top = np.arange(window) >= self.size[:, None]
        self.high = pack(np.where(top, (1 << _BITS) - 1, padded))

    def find(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(window, place) of all occurrences of the windows in a shard's word ids, where 0
        stands for other words and for the gap between two documents."""
        none = np.empty(0, np.int64), np.empty(0, np.int64)
        if not self.least or len(ids) < self.least:
            return none
        gap = np.flatnonzero(ids == 0)
        ahead = np.append(gap, len(ids))[np.searchsorted(gap, np.arange(len(ids)))] - np.arange(len(ids))
        suffix = np.flatnonzero(ahead >= self.least)
        if not len(suffix):
            return none
        padded = np.concatenate((ids, np.zeros(self.window, np.int64)))
        keys = pack(padded[suffix[:, None] + np.arange(self.window)])
        order = np.lexsort(keys.T[::-1])
        suffix, keys = suffix[order], keys[order]  # the shard's suffix array
        first, last = bisect(keys, self.low, False), bisect(keys, self.high, True)
        n = last - first
        window = np.repeat(np.arange(len(n)), n)
        at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + first[window]
        return window, suffix[at]


def pack(ids: np.ndarray) -> np.ndarray:
    """Rows of word ids as rows of few integers that sort alike."""
    cols = [sum(ids[:, j] << (_BITS * (_PER_KEY - 1 - (j - i))) for j in range(i, min(i + _PER_KEY, ids.shape[1])))
            for i in range(0, ids.shape[1], _PER_KEY)]
    return np.stack(cols, axis=1)


def bisect(keys: np.ndarray, wanted: np.ndarray, after: bool) -> np.ndarray:
    """Index in the sorted rows ``keys`` before (or behind) all equal to each wanted row."""
    lo, hi = np.zeros(len(wanted), np.int64), np.full(len(wanted), len(keys), np.int64)
    while (open_ := lo < hi).any():
        mid = (lo + hi) // 2
        row = keys[np.minimum(mid, len(keys) - 1)]
        less, same = np.zeros(len(wanted), bool), np.ones(len(wanted), bool)
        for c in range(keys.shape[1]):
            less |= same & (row[:, c] < wanted[:, c])
            same &= row[:, c] == wanted[:, c]
        go = (less | same if after else less) & open_
        lo = np.where(go, mid + 1, lo)
        hi = np.where(open_ & ~go, mid, hi)
    return lo


def longest(bench: Benchmark, hits: list[tuple[int, int]]) -> list[tuple[str, int, int, int]]:
    """Longest verbatim match of each item in one document: (item, document word, item word,
    words), from the (window, place) of all its hits."""
    runs: dict[tuple[int, int], list[int]] = {}
    best: dict[int, tuple[int, int, int]] = {}
    for w, p in sorted(hits, key=lambda x: x[1]):
        for item, i in bench.places[w]:
            run = runs.get((item, p - i))
            if run is None or run[1] != p:
                run = runs[item, p - i] = [p, p, i]
            run[1] = p + 1
            words = p - run[0] + int(bench.size[w])
            if item not in best or words > best[item][2]:
                best[item] = (run[0], run[2], words)
    return sorted((bench.names[k], *v) for k, v in best.items())


MATCH = "array<struct<item:string,doc_word:long,item_word:long,n_words:long>>"


def _pass(docs: DataFrame, bench) -> DataFrame:
    """doc_id, _row, n_words, spans of hit words and the longest match of each item."""
    schema = StructType([docs.schema["doc_id"], *StructType.fromDDL(
        f"_row long, n_words long, spans array<struct<a:long,b:long>>, matches {MATCH}").fields])
    arrow = to_arrow_schema(schema)

    def search(batches):
        b = Benchmark.__new__(Benchmark)
        vars(b).update(bench.value)
        known = b.vocabulary.get
        for rows, data, off in blocks(batches, limit=SHARD_BYTES):
            n_words, ids, starts = [], [], [0]
            for i in range(len(off) - 1):
                words = words_of(data[off[i]:off[i + 1]].tobytes())
                n_words.append(len(words))
                ids += [known(w, 0) for w in words]
                ids.append(0)
                starts.append(len(ids))
            window, place = b.find(np.array(ids, np.int64))
            doc = np.searchsorted(np.array(starts), place, "right") - 1
            spans, matches = [[] for _ in n_words], [[] for _ in n_words]
            for k in np.unique(doc):
                mine = doc == k
                hits = list(zip(window[mine].tolist(), (place[mine] - starts[k]).tolist()))
                spans[k] = merged(hits, b.size)
                matches[k] = [dict(zip(("item", "doc_word", "item_word", "n_words"), m)) for m in longest(b, hits)]
            yield pa.RecordBatch.from_arrays(
                [rows.column(0).cast(arrow.field(0).type), rows.column(2), pa.array(n_words, pa.int64()),
                 pa.array(spans, arrow.field("spans").type), pa.array(matches, arrow.field("matches").type)], schema=arrow)

    numbered = texts_of(docs).withColumn("_row", F.monotonically_increasing_id())
    return numbered.mapInArrow(search, schema)


def merged(hits, size) -> list[dict]:
    """Document words that the hits cover, as disjoint spans."""
    out: list[dict] = []
    for a, b in sorted((p, p + int(size[w])) for w, p in hits):
        if out and a <= out[-1]["b"]:
            out[-1]["b"] = max(out[-1]["b"], b)
        else:
            out.append({"a": a, "b": b})
    return out


def locate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, n_words, n_hit, items (sorted names), contaminated, spans and the longest match
    of each item."""
    spark = docs.sparkSession
    texts = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item"),
                             F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    size = texts.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    n = max(1, math.ceil(2 * size / block_bytes)) if size > block_bytes else 1
    parts = []
    for k in range(n):
        own = texts if n == 1 else texts.filter(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == k)
        items = sorted((r["item"], r["text"]) for r in own.distinct().collect())  # one block, bounded above
        block = Benchmark([(name, words_of(text.encode())) for name, text in items], window)
        parts.append(_pass(docs, spark.sparkContext.broadcast(vars(block))))
    found = parts[0]
    for p in parts[1:]:
        found = found.unionByName(p)
    if n > 1:  # spans and matches of one document from several blocks
        found = found.groupBy("_row").agg(
            F.first("doc_id").alias("doc_id"), F.first("n_words").alias("n_words"),
            F.flatten(F.collect_list("spans")).alias("spans"), F.flatten(F.collect_list("matches")).alias("matches"))
    reach = F.aggregate(F.array_sort("spans"), F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("to")),
                        lambda t, s: F.struct((t["n"] + F.greatest(F.lit(0), s["b"] - F.greatest(s["a"], t["to"]))).alias("n"),
                                              F.greatest(t["to"], s["b"]).alias("to")))["n"]
    items = F.array_sort(F.array_distinct(F.transform("matches", lambda m: m["item"])))
    return found.select("doc_id", "n_words", reach.alias("n_hit"), items.alias("items"),
                        (F.size("spans") > 0).alias("contaminated"), "spans", "matches")


def remove(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Rows of ``docs`` without the contaminated ones.  Ids may be NULL or repeated: the verdict
    is carried by the row's written number."""
    number = free_name(docs, "_row_number")
    rows = written(docs.withColumn(number, F.monotonically_increasing_id()), "decontaminate-rows")
    found = locate(rows.select(F.col(number).alias("doc_id"), "text"), benchmark, window)
    bad = found.filter("contaminated").select(F.col("doc_id").alias(number))
    return rows.join(bad, number, "left_anti").select(*(rows[f"`{c}`"] for c in docs.columns))


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = locate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), "contaminated")


ORACLE = r"""
WITH b AS (SELECT item_id, list_filter(string_split_regex(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS words FROM benchmark WHERE text IS NOT NULL),
i AS (SELECT item_id, words, unnest(range(1, greatest(len(words) - 10, 0) + 2)) AS pos FROM b WHERE len(words) > 0),
win AS (SELECT DISTINCT item_id, least(len(words), 10) AS n, array_to_string(words[pos:pos+9], ' ') AS w FROM i),
d AS (SELECT row_number() OVER () AS r, doc_id,
        list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS words FROM documents),
p AS (SELECT r, words, unnest(range(1, len(words) + 1)) AS pos FROM d),
sizes AS (SELECT DISTINCT n FROM win),
hit AS (SELECT p.r, p.pos, win.n, win.item_id
        FROM p, sizes, win WHERE win.n = sizes.n AND p.pos + sizes.n - 1 <= len(p.words)
          AND array_to_string(p.words[p.pos:p.pos + sizes.n - 1], ' ') = win.w),
cover AS (SELECT r, count(DISTINCT q) AS n_hit FROM (SELECT r, unnest(range(pos, pos + n)) AS q FROM hit) GROUP BY r),
its AS (SELECT r, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
        FROM (SELECT DISTINCT r, item_id::VARCHAR AS id FROM hit) GROUP BY r)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN cover USING (r) LEFT JOIN its USING (r)
"""
