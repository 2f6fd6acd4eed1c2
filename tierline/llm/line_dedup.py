"""Line dedup over levelled sorted runs of line hashes.

A line's key is the line stripped of blanks (20 and 09-0D hex) at both ends, A-Z lower-cased;
it is held as a 128-bit hash.  The index is a family of runs: tables of (key, number of
documents), sorted by key.  A new batch merge-anti-joins the runs: keys that the runs prove frequent
already (``min_docs`` documents) need no more counting and leave the batch.  The rest is
written as the batch's own run at level 0.  Whenever ``fanout`` runs stand at one level they
are merged into one run of the next, so a batch meets a number of runs in the order of the
logarithm of the batches.  Frequent keys lose all their lines in every document.

Cases: NULL or empty text is one empty line.  Keys shorter than ``min_chars`` code points
stay always.  Rows that repeat a doc_id count as one document; rows with a NULL doc_id
together count as one.  Each row comes out once, its other columns as they were.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierline.llm.common import drop_path, scratch, table, written

MIN_DOCS = 10
MIN_CHARS = 1
BATCHES = 4
FANOUT = 2

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
KEY = ["h1", "h2"]


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text.cast("string"), F.lit("")), "\n")


def line_key(line: Column) -> Column:
    """128-bit key of a line as (h1, h2); NULL for lines that always stay."""
    return F.btrim(F.translate(line, _UPPER, _LOWER), F.lit(" \t\n\x0b\f\r"))


def hashed(key: Column) -> Column:
    return F.struct(F.xxhash64(key).alias("h1"), F.xxhash64(F.lit(1), key).alias("h2"))


class LineRuns:
    """The levelled runs.  ``levels[i]`` lists the paths of the runs at level i."""

    def __init__(self, spark: SparkSession, min_docs: int = MIN_DOCS, fanout: int = FANOUT):
        self.spark, self.min_docs, self.fanout = spark, min_docs, fanout
        self.root = scratch(spark, "line-runs")
        self.levels: list[list[str]] = []
        self.made = 0

    def _read(self, paths: list[str]) -> DataFrame:
        if not paths:
            return self.spark.createDataFrame([], "h1 long, h2 long, n_docs long")
        return self.spark.read.schema("h1 long, h2 long, n_docs long").parquet(*paths)

    def counts(self) -> DataFrame:
        """(key, number of documents) over all runs."""
        return self._read([p for level in self.levels for p in level]).groupBy(KEY).agg(F.sum("n_docs").alias("n_docs"))

    def frequent(self) -> DataFrame:
        return self.counts().filter(F.col("n_docs") >= self.min_docs).select(KEY)

    def _write(self, run: DataFrame, level: int) -> None:
        path = f"{self.root}/level={level}/run-{self.made}"
        self.made += 1
        run.sortWithinPartitions(KEY).write.parquet(path)
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(path)

    def add(self, keys: DataFrame) -> None:
        """Add a batch: rows (h1, h2, doc_id), a document's key at most once."""
        fresh = keys.groupBy(KEY).agg(F.count(F.lit(1)).alias("n_docs"))
        if self.levels:
            fresh = fresh.join(self.frequent(), KEY, "left_anti")
        self._write(fresh, 0)
        self.compact()

    def compact(self) -> None:
        level = 0
        while level < len(self.levels):
            if len(self.levels[level]) >= self.fanout:
                merged, self.levels[level] = self.levels[level], []
                self._write(self._read(merged).groupBy(KEY).agg(F.sum("n_docs").alias("n_docs")), level + 1)
                for path in merged:
                    drop_path(self.spark, path)
            level += 1


def document_keys(docs: DataFrame, min_chars: int = MIN_CHARS, batches: int = BATCHES) -> DataFrame:
    """(doc_id, h1, h2, batch), a document's key once a row of the document."""
    keys = F.transform(F.filter(F.transform(lines_of(F.col("text")), line_key), lambda k: F.length(k) >= min_chars), hashed)
    return docs.select("doc_id", F.explode(F.array_distinct(keys)).alias("k")).select(
        "doc_id", "k.h1", "k.h2", F.pmod(F.xxhash64("doc_id"), F.lit(batches)).cast("int").alias("batch"))


def frequent_keys(keys: DataFrame, min_docs: int = MIN_DOCS, batches: int = BATCHES) -> DataFrame:
    runs = LineRuns(keys.sparkSession, min_docs)
    for b in range(batches):
        runs.add(keys.filter(F.col("batch") == b).select("doc_id", *KEY).distinct())
    return runs.frequent()


def deduplicate(docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS, batches: int = BATCHES,
                measured: bool = False) -> DataFrame:
    """Rows of ``docs`` with ``text`` cut to the lines that stay; with ``measured`` doc_id, text,
    n_lines (before) and n_dropped instead of the columns of ``docs``."""
    path = scratch(docs.sparkSession, "line-keys")
    document_keys(docs, min_chars, batches).write.partitionBy("batch").parquet(path)
    keys = docs.sparkSession.read.schema(docs.select("doc_id").schema.add("h1", "long").add("h2", "long").add("batch", "integer")).parquet(path)
    frequent = written(frequent_keys(keys, min_docs, batches), "line-frequent")
    # A frequent key is one row on its side, so a hot line is a skewed join that AQE splits.
    gone = (keys.join(frequent, KEY).groupBy("doc_id").agg(F.collect_set(F.struct(*KEY)).alias("gone"))
            .withColumnRenamed("doc_id", "gone_id"))
    packed = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("doc"))  # no name can clash
    lines = lines_of(F.col("doc.text"))
    kept = F.when(F.col("gone").isNull(), lines).otherwise(F.filter(
        lines, lambda x: (F.length(line_key(x)) < min_chars) | ~F.array_contains(F.col("gone"), hashed(line_key(x)))))
    rows = packed.join(gone, F.col("doc.doc_id").eqNullSafe(F.col("gone_id")), "left").select(
        "doc", kept.alias("kept"), F.size(lines).cast("long").alias("n_lines"))
    text = F.array_join("kept", "\n").alias("text")
    if measured:
        return rows.select("doc.doc_id", text, "n_lines", (F.col("n_lines") - F.size("kept")).alias("n_dropped"))
    return rows.select(*[text if c == "text" else F.col("doc")[c].alias(c) for c in docs.columns])


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = deduplicate(table(spark, sf_dir, "documents").select("doc_id", "text"), measured=True)
    return rows.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT r, doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS pos FROM d),
k AS (SELECT *, translate(regexp_replace(regexp_replace(line, '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', ''),
                          'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
f AS (SELECT key FROM k WHERE len(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10)
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (WHERE key IN (SELECT key FROM f))::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE key NOT IN (SELECT key FROM f)), '')) AS kept_sha256
FROM k GROUP BY r, doc_id
"""
