"""Removal of long repeated byte strings, over a logarithmic family of sampled suffix arrays.

Every byte covered by a ``LENGTH``-byte string that also starts anywhere else goes.

*Sampled suffixes.*  In each string of ``LENGTH`` bytes the leftmost of its ``HEAD``-byte pieces with
the least fingerprint is its anchor; it depends on the string's bytes alone, so equal strings
have equal anchors at equal places.  Consecutive strings share an anchor, which leaves about one suffix
in thirty.  A suffix is ordered by the fingerprint of its first ``HEAD`` bytes: only equal
heads of one fixed length must stand together, so any fixed order serves.

*Index family.*  Each batch of documents gets its suffix array: a table of (head, number of
places), sorted by head.  It is merge-scanned against the existing levels; heads found there
or twice in the batch are repeated.  Then it joins the family as a run of level 0, and two
runs of a level merge into one of the next.  The arrays hold heads only; the places of
repeated heads are found by one more scan of the texts, which keeps the family small.

*Long matches.*  All strings with one anchor form one span.  Equal spans (head, and fingerprint
of all bytes with the anchor's place in them) are repeated in whole.  Where equal heads stand
in unequal spans, a match ends inside: there the strings are compared one by one, one span of
each kind standing for all equal ones.  Fingerprints count in pairs of 64 bits.

Cases: NULL is the empty text.  Texts under ``LENGTH`` bytes keep everything.  Rows that
repeat a document repeat its strings too, so both lose them.  A removal may cut a UTF-8
character; what is kept is bytes.  Very long texts are worked through in pieces.  Only doc_id and text are
read; rows are told apart by doc_id and 64 bits of a hash of the text, NULL and repeated ids too.  Rows equal in both
have equal ranges, which are held once for all of them.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.pandas.types import to_arrow_schema

from tierline.llm.common import blocks, bounded_batches, drop_path, scratch, table, text_buffer, written

LENGTH = 200
HEAD = 140
BATCHES = 3
#: Strings worked on at once; bounds a task's memory for a text of any length.
PIECE = 1 << 20


class Fingerprints:
    """Polynomial fingerprints modulo 2^64 of all pieces of a buffer, from prefix sums."""

    _power = 0x9E3779B97F4A7C15

    def __init__(self, size: int):
        self.table = np.random.default_rng(20240131).integers(0, 1 << 64, 256, dtype=np.uint64)
        self.up = self._powers(size, self._power)
        self.down = self._powers(size, pow(self._power, -1, 1 << 64))

    @staticmethod
    def _powers(n: int, base: int) -> np.ndarray:
        out = np.ones(n, np.uint64)
        done, step = 1, base
        while done < n:  # out[done:2 * done] = out[:done] * base^done
            k = min(done, n - done)
            out[done:done + k] = out[:k] * np.uint64(step)
            done, step = done + k, step * step % (1 << 64)
        return out

    def prefix(self, data: np.ndarray) -> np.ndarray:
        return np.concatenate((np.zeros(1, np.uint64), np.cumsum(self.table[data] * self.up[:len(data)])))

    def of(self, prefix: np.ndarray, start: np.ndarray, size) -> np.ndarray:
        return mix((prefix[start + size] - prefix[start]) * self.down[start])


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def leftmost_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """Place of the leftmost least value in each window of ``width`` values, by doubling."""
    value, place, span = values, np.arange(len(values), dtype=np.int32), 1
    while span < width:
        step = min(span, width - span)
        later = value[step:] < value[:-step]
        value, place = np.where(later, value[step:], value[:-step]), np.where(later, place[step:], place[:-step])
        span += step
    return place


def spans_of(fp: Fingerprints, data: np.ndarray, off: np.ndarray, length: int, head: int):
    """Spans of a buffer of texts: (head, span fingerprint, text, first string, strings)."""
    n = len(data) - length + 1
    if n <= 0:
        return [np.empty(0, t) for t in (np.uint64, np.uint64, np.int64, np.int64, np.int64)]
    prefix = fp.prefix(data)
    heads = fp.of(prefix, np.arange(len(data) - head + 1), head)
    anchor = leftmost_minimum(heads, length - head + 1)
    text = np.repeat(np.arange(len(off) - 1, dtype=np.int32), np.diff(off))
    inside = text[:n] == text[length - 1:]
    change = np.empty(n, bool)
    change[0] = True
    change[1:] = (anchor[1:] != anchor[:-1]) | (inside[1:] != inside[:-1]) | (text[1:n] != text[:n - 1])
    first = np.flatnonzero(change)
    strings = np.diff(np.append(first, n))
    first, strings = first[inside[first]], strings[inside[first]]
    at = anchor[first]
    whole = fp.of(prefix, first, strings + (length - 1))
    # The anchor's place and the number of strings belong to the identity of the span.
    shape = (at - first).astype(np.uint64) * np.uint64(0xBF58476D1CE4E5B9) + strings.astype(np.uint64) * np.uint64(0x94D049BB133111EB)
    return [heads[at], mix(whole ^ shape), text[first].astype(np.int64), first - off[text[first]], strings]


def all_spans(fp: Fingerprints, data: np.ndarray, off: np.ndarray, length: int, head: int):
    """:func:`spans_of`, a single text of any size in pieces that overlap by length - 1."""
    if len(data) <= PIECE + length:
        return spans_of(fp, data, off, length, head)
    parts = []
    if len(off) > 2:
        raise ValueError("only a single text may exceed the piece size")
    for s in range(0, len(data) - length + 1, PIECE):
        piece = data[s:s + PIECE + length - 1]
        part = spans_of(fp, piece, np.array([0, len(piece)]), length, head)
        part[3] = part[3] + s
        parts.append(part)
    return [np.concatenate(c) for c in zip(*parts)]


class SuffixFamily:
    """The levels of sorted suffix arrays; ``levels[i]`` lists the runs of level i."""

    def __init__(self, spark: SparkSession, fanout: int = 2):
        self.spark, self.fanout = spark, fanout
        self.root = scratch(spark, "suffix-runs")
        self.levels: list[list[str]] = []
        self.made = 0

    def _read(self, paths: list[str]) -> DataFrame:
        return self.spark.read.schema("head long, places long").parquet(*paths)

    def _write(self, run: DataFrame, level: int) -> str:
        path = f"{self.root}/level={level}/run-{self.made}"
        self.made += 1
        run.sortWithinPartitions("head").write.parquet(path)
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(path)
        return path

    def add(self, heads: DataFrame) -> DataFrame:
        """Add a batch of (head, places); returns the heads that are repeated in the batch or
        between it and the levels."""
        old = [p for level in self.levels for p in level]
        run = self._read([self._write(heads.groupBy("head").agg(F.sum("places").alias("places")), 0)])
        repeated = run.filter("places > 1").select("head")
        if old:  # both sides are sorted runs: a merge join
            repeated = repeated.union(run.filter("places = 1").select("head").join(self._read(old), "head", "left_semi"))
        repeated = written(repeated, "suffix-repeated")
        self.compact()
        return repeated

    def compact(self) -> None:
        level = 0
        while level < len(self.levels):
            if len(self.levels[level]) >= self.fanout:
                runs, self.levels[level] = self.levels[level], []
                self._write(self._read(runs).groupBy("head").agg(F.sum("places").alias("places")), level + 1)
                for path in runs:
                    drop_path(self.spark, path)
            level += 1

    def drop(self) -> None:
        """Delete the family when no further batch will come."""
        drop_path(self.spark, self.root)


def _fingerprints(length: int) -> Fingerprints:
    return Fingerprints(PIECE + 2 * length + 1)


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.astype(np.uint64).view(np.int64))


def batch_heads(docs: DataFrame, length: int = LENGTH, head: int = HEAD) -> DataFrame:
    """(head, places) of the sampled suffixes of ``docs``, added up within each block."""
    def run(batches):
        fp = _fingerprints(length)
        for _, data, off in blocks(batches, limit=PIECE):
            heads, places = np.unique(all_spans(fp, data, off, length, head)[0], return_counts=True)
            yield pa.RecordBatch.from_arrays([_signed(heads), pa.array(places)], ["head", "places"])

    return docs.select("doc_id", "text").mapInArrow(run, "head long, places long")


def all_places(docs: DataFrame, length: int = LENGTH, head: int = HEAD) -> DataFrame:
    """(head, span, doc_id, version, first, strings) of every span of ``docs``."""
    schema = StructType([*StructType.fromDDL("head long, span long").fields, docs.schema["doc_id"],
                         *StructType.fromDDL("version long, first long, strings int").fields])
    arrow = to_arrow_schema(schema)

    def run(batches):
        fp = _fingerprints(length)
        for rows, data, off in blocks(batches, limit=PIECE):
            heads, span, text, first, strings = all_spans(fp, data, off, length, head)
            text = pa.array(text)
            yield pa.RecordBatch.from_arrays(
                [_signed(heads), _signed(span), rows.column(0).take(text).cast(arrow.field(2).type),
                 rows.column(2).take(text), pa.array(first), pa.array(strings.astype(np.int32))], schema=arrow)

    return docs.select("doc_id", "text", "version").mapInArrow(run, schema)


def _same_row(a: DataFrame, b: DataFrame, prefix: str) -> Column:
    return a["doc_id"].eqNullSafe(b[f"{prefix}doc_id"]) & a["version"].eqNullSafe(b[f"{prefix}version"])


def _by_row(places: DataFrame, cols: list[str], name: str) -> DataFrame:
    """All different places of a row in one list, under column names that clash with no other: k equal rows bring
    each place k times and keep it once, before the shuffle where they can."""
    return places.groupBy("doc_id", "version").agg(F.collect_set(F.struct(*cols)).alias(name)).select(
        F.col("doc_id").alias("_doc_id"), F.col("version").alias("_version"), name)


def one_by_one(docs: DataFrame, spans: DataFrame, length: int = LENGTH) -> DataFrame:
    """(doc_id, version, head, string, single, first) of each string of the given spans."""
    schema = StructType([docs.schema["doc_id"], *StructType.fromDDL(
        "version long, head long, string long, single boolean, first long").fields])
    arrow = to_arrow_schema(schema)

    def run(batches):
        fp = _fingerprints(length)
        last = None
        for batch in batches:
            data, off = text_buffer(batch.column(1))
            for i, wanted in enumerate(batch.column(3).to_pylist()):
                # Equal rows come out of the merge join one after another; one of them speaks for all.
                row = batch.column(0)[i].as_py(), batch.column(2)[i].as_py()
                if row == last:
                    continue
                last = row
                text = data[off[i]:off[i + 1]]
                for s in range(0, len(text) - length + 1, PIECE):
                    prefix = fp.prefix(text[s:s + PIECE + length - 1])
                    starts, heads, single = [], [], []
                    for w in wanted:
                        a, b = max(w["first"], s), min(w["first"] + w["strings"], s + PIECE)
                        if a < b:
                            starts.append(np.arange(a - s, b - s))
                            heads += [w["head"]] * (b - a)
                            single += [w["single"]] * (b - a)
                    if starts:
                        at = np.concatenate(starts)
                        n = len(at)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([row[0]] * n, arrow.field(0).type), pa.array([row[1]] * n, pa.int64()),
                             pa.array(heads, pa.int64()), _signed(fp.of(prefix, at, length)), pa.array(single, pa.bool_()),
                             pa.array(at + s)], schema=arrow)

    wanted = _by_row(spans, ["head", "first", "strings", "single"], "_wanted")
    rows = docs.join(wanted, _same_row(docs, wanted, "_")).select("doc_id", "text", "version", "_wanted")
    return rows.mapInArrow(run, schema)


def repeated_ranges(docs: DataFrame, length: int = LENGTH, head: int = HEAD, batches: int = BATCHES,
                    paths: list[str] | None = None) -> DataFrame:
    """(doc_id, version, first, strings): runs of string starts that also start elsewhere.
    ``paths`` gets the scratch tables that the result reads."""
    paths = [] if paths is None else paths
    compared: list[str] = []
    family = SuffixFamily(docs.sparkSession)
    repeated = None
    for b in range(batches):
        batch = docs.filter(F.pmod(F.xxhash64("doc_id"), F.lit(batches)) == b)
        found = family.add(batch_heads(batch, length, head))
        repeated = found if repeated is None else repeated.union(found)
    family.drop()
    places = written(all_places(docs, length, head).join(repeated.distinct(), "head", "left_semi"), "suffix-places", paths)
    kinds = written(places.groupBy("head", "span").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("doc_id", "version", "first", "strings")).alias("one")), "suffix-kinds", paths)
    whole = places.join(kinds.filter("n > 1").select("head", "span"), ["head", "span"], "left_semi")
    mixed = kinds.groupBy("head").agg(F.min("n").alias("least"), F.count(F.lit(1)).alias("kinds")).filter("least = 1 AND kinds > 1")
    one_each = kinds.join(mixed, "head", "left_semi").select("head", "one.*", (F.col("n") == 1).alias("single"))
    strings = written(one_by_one(docs, one_each, length), "suffix-strings", compared)
    twice = strings.groupBy("head", "string").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("head", "string")
    # Strings of spans with several places are known already; only single spans ask.
    parts = written(strings.filter("single").join(twice, ["head", "string"], "left_semi").select(
        "doc_id", "version", "first"), "suffix-parts", paths)
    for path in compared:
        drop_path(docs.sparkSession, path)
    return whole.select("doc_id", "version", "first", "strings").union(
        parts.select("doc_id", "version", "first", F.lit(1).alias("strings")))


def versioned(docs: DataFrame) -> DataFrame:
    bounded_batches(docs.sparkSession)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select("doc_id", text.alias("text"), F.xxhash64(text).alias("version"))


def remove_repeats(docs: DataFrame, length: int = LENGTH, head: int = HEAD, batches: int = BATCHES) -> DataFrame:
    """doc_id, n_bytes, the removed byte ranges and the kept bytes of every row."""
    docs = versioned(docs)
    used: list[str] = []
    ranges = written(_by_row(repeated_ranges(docs, length, head, batches, used), ["first", "strings"], "_ranges"), "suffix-ranges")
    for path in used:
        drop_path(docs.sparkSession, path)
    schema = StructType([docs.schema["doc_id"], *StructType.fromDDL(
        "n_bytes long, removed array<struct<start:long,end:long>>, kept binary").fields])
    arrow = to_arrow_schema(schema)

    def run(batches_):
        for batch in batches_:
            data, off = text_buffer(batch.column(1))
            cols: list[list] = [[], [], []]
            for i, found in enumerate(batch.column(2).to_pylist()):
                text = data[off[i]:off[i + 1]]
                removed, keep = [], np.ones(len(text), bool)
                for r in sorted(found or [], key=lambda r: r["first"]):
                    a, b = r["first"], r["first"] + r["strings"] - 1 + length
                    if removed and a <= removed[-1]["end"]:
                        removed[-1]["end"] = max(removed[-1]["end"], b)
                    else:
                        removed.append({"start": a, "end": b})
                for r in removed:
                    keep[r["start"]:r["end"]] = False
                for c, v in zip(cols, (len(text), removed, text[keep].tobytes())):
                    c.append(v)
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(arrow.field(0).type)]
                                             + [pa.array(c, arrow.field(k + 1).type) for k, c in enumerate(cols)], schema=arrow)

    rows = docs.join(ranges, _same_row(docs, ranges, "_"), "left").select("doc_id", "text", "_ranges")
    return rows.mapInArrow(run, schema)


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = remove_repeats(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_bytes", (F.col("n_bytes") - F.length("kept")).cast("long").alias("n_removed"),
                       F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
