"""A topic source without a broker: an append-only log of Parquet files with offsets per (topic,
partition), read by Structured Streaming in exact, replayable offset ranges.

Layout: ``<path>/topic=<t>/partition=<p>/*.parquet`` with ``offset, timestamp, value``.  Files are never
changed once written; the offsets a file holds are read from its footer, once.  Offsets need not be
dense and files may overlap.

The stream's offset is, for each topic partition, the first offset not read yet.  A micro-batch is the range between
two of these, so a batch that Spark runs again after a failure reads exactly the rows it read before, whatever was
appended since.  At most ``max_offsets`` offsets are admitted a batch, dealt to the topic partitions by what each
has left: a rate, not a cap.  As Spark does not tell a Python source where a restarted query stands, the source
reads it from the query's own checkpoint (``checkpoint``, its newest entry).  Each file that a range touches is one
task, which reads only the row groups in the range.

The files are opened with Arrow's file systems (local, HDFS, S3, GCS by the path's scheme).
"""

from __future__ import annotations

import json
import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

NAME = "topic_log"
SCHEMA = "topic string, partition int, offset long, timestamp timestamp, value string"


#: Offsets of a topic partition that are written together.
BLOCK = 1 << 18


def append(records: DataFrame, path: str) -> None:
    """Add topic records (topic, partition, offset, timestamp, value) to the log, in offset order
    within each file.

    A task takes some blocks of offsets, in files of a size that AQE picks: topics have few partitions,
    and a task for each would hold all that is appended to one."""
    block = F.floor(F.col("offset") / BLOCK).alias("block")
    (records.select("topic", "partition", "offset", "timestamp", "value", block).hint("rebalance", "topic", "partition", "block")
     .sortWithinPartitions("topic", "partition", "offset").drop("block")
     .write.mode("append").partitionBy("topic", "partition").parquet(path))


@dataclass(frozen=True)
class LogFile(InputPartition):
    """A file of the log and the offsets wanted of it: from ``start`` up to, not including, ``end``."""

    path: str
    topic: str
    partition: int
    start: int
    end: int


class Log:
    """The files of a log with their offset ranges; each footer is read once."""

    def __init__(self, path: str):
        from pyarrow import fs

        self.fs, self.root = fs.FileSystem.from_uri(path)
        self.known: dict[str, LogFile] = {}

    def files(self) -> list[LogFile]:
        import pyarrow.parquet as pq
        from pyarrow import fs

        found = self.fs.get_file_info(fs.FileSelector(self.root, recursive=True, allow_not_found=True))
        for info in found:
            place = re.search(r"/topic=([^/]+)/partition=(-?\d+)/[^/._][^/]*\.parquet$", info.path)
            # A writer's attempts stand in its _temporary folder until its job is committed.
            if not place or info.path in self.known or "/_temporary/" in info.path:
                continue
            footer = pq.ParquetFile(self.fs.open_input_file(info.path)).metadata
            ranges = [footer.row_group(g).column(0).statistics for g in range(footer.num_row_groups)]
            if ranges:
                self.known[info.path] = LogFile(info.path, place[1], int(place[2]), min(r.min for r in ranges), max(r.max for r in ranges) + 1)
        return list(self.known.values())

    def ends(self) -> dict[str, int]:
        out: dict[str, int] = {}
        for f in self.files():
            key = f"{f.topic}/{f.partition}"
            out[key] = max(out.get(key, 0), f.end)
        return out

    def between(self, start: dict, end: dict) -> list[LogFile]:
        """The parts of files that hold offsets of the range, one each."""
        out = []
        for f in self.files():
            key = f"{f.topic}/{f.partition}"
            a, b = max(f.start, start.get(key, 0)), min(f.end, end.get(key, 0))
            if a < b:
                out.append(LogFile(f.path, f.topic, f.partition, a, b))
        return out


def rows_of(path: str, part: LogFile):
    """Record batches of a file's wanted offsets."""
    import pyarrow as pa
    import pyarrow.compute as pc
    import pyarrow.parquet as pq
    from pyarrow import fs

    file = pq.ParquetFile(fs.FileSystem.from_uri(path)[0].open_input_file(part.path))
    groups = [g for g in range(file.num_row_groups)
              if file.metadata.row_group(g).column(0).statistics.max >= part.start
              and file.metadata.row_group(g).column(0).statistics.min < part.end]
    for batch in file.iter_batches(row_groups=groups, columns=["offset", "timestamp", "value"]):
        at = batch.column(0)
        batch = batch.filter(pc.and_(pc.greater_equal(at, part.start), pc.less(at, part.end)))
        n = batch.num_rows
        yield pa.RecordBatch.from_arrays(
            [pa.array([part.topic] * n, pa.string()), pa.array([part.partition] * n, pa.int32()), batch.column(0),
             batch.column(1).cast(pa.timestamp("us", "UTC")), batch.column(2).cast(pa.string())],
            ["topic", "partition", "offset", "timestamp", "value"])


def admitted(position: dict, ends: dict, most: int | None) -> dict:
    """The position after the next batch: everything, or ``most`` offsets dealt by what is left, at least
    one to each topic partition that has any."""
    left = {k: end - position.get(k, 0) for k, end in ends.items() if end > position.get(k, 0)}
    total = sum(left.values())
    if not most or total <= most:
        return {**position, **{k: ends[k] for k in left}}
    return {**position, **{k: position.get(k, 0) + min(n, max(1, most * n // total)) for k, n in left.items()}}


def checkpointed(checkpoint: str) -> dict | None:
    """The newest offset that a query's checkpoint holds; None when it holds none."""
    from pyarrow import fs

    store, root = fs.FileSystem.from_uri(checkpoint)
    found = store.get_file_info(fs.FileSelector(f"{root}/offsets", allow_not_found=True))
    batches = [int(f.base_name) for f in found if f.base_name.isdigit()]
    if not batches:
        return None
    with store.open_input_file(f"{root}/offsets/{max(batches)}") as f:
        lines = f.read().decode().splitlines()
    return json.loads(lines[2])  # after the version and the batch's settings


class TopicLogStream(DataSourceStreamReader):
    def __init__(self, options: dict):
        self.path, self.checkpoint = options["path"], options.get("checkpoint")
        self.most = int(options["max_offsets"]) if options.get("max_offsets") else None
        if self.most and not self.checkpoint:
            raise ValueError("max_offsets needs the query's checkpoint: a restarted query goes on from there")
        self.log = Log(self.path)
        self.position: dict | None = None

    def initialOffset(self) -> dict:
        return {k: 0 for k in self.log.ends()}  # the earliest

    def latestOffset(self) -> dict:
        if self.position is None:
            self.position = (checkpointed(self.checkpoint) if self.checkpoint else None) or {}
        return admitted(self.position, self.log.ends(), self.most)

    def partitions(self, start: dict, end: dict) -> list[LogFile]:
        self.position = end
        return self.log.between(start, end)

    def read(self, partition: LogFile):
        return rows_of(self.path, partition)


class TopicLogReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path = options["path"]

    def partitions(self) -> list[LogFile]:
        log = Log(self.path)
        return log.between({}, log.ends())

    def read(self, partition: LogFile | None):
        return rows_of(self.path, partition) if partition else iter(())  # an empty log has no file


class TopicLog(DataSource):
    """``spark.read`` and ``spark.readStream`` format ``topic_log``."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> TopicLogReader:
        return TopicLogReader(self.options)

    def streamReader(self, schema) -> TopicLogStream:
        return TopicLogStream(self.options)


def read(spark: SparkSession, path: str) -> DataFrame:
    spark.dataSource.register(TopicLog)
    return spark.read.format(NAME).option("path", path).load()


def read_stream(spark: SparkSession, path: str, checkpoint: str | None = None, max_offsets: int | None = None) -> DataFrame:
    """Topic records from the earliest offset on.  With ``max_offsets`` a batch admits no more, and ``checkpoint``
    has to be the checkpoint of the query that reads."""
    spark.dataSource.register(TopicLog)
    reader = spark.readStream.format(NAME).option("path", path)
    if checkpoint:
        reader = reader.option("checkpoint", checkpoint)
    if max_offsets:
        reader = reader.option("max_offsets", str(max_offsets))
    return reader.load()


def drain(start, checkpoint: str, path: str) -> int:
    """Run ``start()``, a query that takes one admitted batch and stops (``availableNow``), until the log is read
    to its end as of now; the number of runs."""
    ends, runs = Log(path).ends(), 0
    while (position := checkpointed(checkpoint) or {}) is not None and any(position.get(k, 0) < end for k, end in ends.items()):
        start().awaitTermination()
        runs += 1
    return runs


def summary(records: DataFrame) -> DataFrame:
    """Per topic partition: records, distinct offsets, first and last offset."""
    return records.groupBy("topic", "partition").agg(
        F.count(F.lit(1)).alias("records"), F.count_distinct("offset").alias("offsets"),
        F.min("offset").alias("first_offset"), F.max("offset").alias("last_offset"))
