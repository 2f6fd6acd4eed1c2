"""Tier tables: where they live, how they are created, read and (re)written.

Tables are directories under one root, ``<root>/<tier>/<table>``, in any file format Spark
writes (Parquet by default, ORC; ``delta`` or ``iceberg`` when their connectors are on the
classpath), on any file system Hadoop reads.

* Raw tables only grow: a micro-batch replaces its own ``(ingest_date, run, batch_id)``
  partitions and can touch no other batch's rows.
* A full rewrite of a refined or aggregate table goes to a new version folder; the job's
  ``_SUCCESS`` marker makes it the current one.  Until then, and for readers that are
  running, the version before stays; a failed rewrite changes nothing.
* An incremental rewrite replaces single partitions of the current version (Spark stages
  them and moves them in when the whole job has succeeded).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import Column, DataFrame, DataFrameWriter, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierline.schemas import OPTIONAL, TABLES

# Partition columns that are no column of the record (raw tables: which batch landed the row;
# refined tables: the day or month, so that an incremental refresh replaces only those touched).
LANDED = {"ingest_date": T.DateType(), "run": T.StringType(), "batch_id": T.LongType()}
PARTITIONING: dict[tuple[str, str], dict[str, T.DataType]] = {
    ("bronze", "events"): LANDED,
    ("bronze", "orders"): LANDED,
    ("bronze", "dead_letter"): LANDED,
    ("bronze", "replayed"): {"run": T.StringType(), "batch_id": T.LongType()},
    ("silver", "event_variants"): {"event_day": T.DateType()},
    ("bronze", "ingest_stats"): {"run": T.StringType(), "batch_id": T.LongType()},
    ("silver", "clean_events"): {"event_day": T.DateType()},
    ("silver", "validate_orders"): {"created_month": T.DateType()},
    ("silver", "event_winners"): {"seq": T.LongType(), "bucket": T.IntegerType()},
    ("silver", "order_winners"): {"seq": T.LongType(), "bucket": T.IntegerType()},
    ("silver", "user_changes"): {"seq": T.LongType()},
    ("silver", "user_numbers"): {"seq": T.LongType()},
    ("gold", "daily_kpis"): {"event_date": T.DateType()},
    ("gold", "user_bitmaps"): {"event_date": T.DateType()},
}
# Time column and period of the partitions of refined tables (events are many, orders few).
PERIODS = {("silver", "clean_events"): ("event_timestamp", "day"), ("silver", "event_variants"): ("event_timestamp", "day"),
            ("silver", "validate_orders"): ("created_at", "month")}
KEPT_VERSIONS = 2
_NULL_PART = "__HIVE_DEFAULT_PARTITION__"
#: Of the files of the formats named: a row is shuffled once or twice, but written by each layout it passes through.
COMPRESSION = {"parquet": "zstd", "orc": "zstd"}
# Formats that keep versions themselves and replace a table atomically.
TRANSACTIONAL = ("delta", "iceberg")


@dataclass(frozen=True)
class RawView:
    """Which rows of a raw table count: the parts of finished compactions (negative batch ids), and the batches
    that none of them holds."""

    generation: int = 0
    last_day: date | None = None
    marks: dict = field(default_factory=dict)

    def rows(self) -> list[tuple]:
        return [(self.generation, self.last_day, run, mark) for run, mark in self.marks.items()] or [
            (self.generation, self.last_day, None, None)]

    def counts(self) -> Column:
        """Literals on partition columns: hidden folders are not read."""
        part = (F.col("batch_id") < 0) & (F.col("batch_id") >= -self.generation)
        held = F.lit(False)
        for run, mark in self.marks.items():
            held = held | (F.col("run").eqNullSafe(F.lit(run)) & (F.col("batch_id") <= mark))
        held = held & (F.col("ingest_date") <= F.lit(self.last_day))
        return part | ((F.col("batch_id").isNull() | (F.col("batch_id") >= 0)) & ~F.coalesce(held, F.lit(False)))


_VIEWS: dict[str, RawView] = {}  # by the path of the version that says so, which never changes


@dataclass(frozen=True)
class TierStore:
    root: str
    fmt: str = "parquet"
    #: Hash buckets of the tables of current raw rows; fixed for the life of a store.  A bucket
    #: should come to a few hundred MB (4096 for 1 TB of current rows).
    buckets: int = 64
    #: Keep the events' metadata as a Variant column too.
    variants: bool = False

    def folder(self, tier: str, table: str) -> str:
        return f"{self.root.rstrip('/')}/{tier}/{table}"

    def writer(self, df: DataFrame) -> DataFrameWriter:
        """Of files of the store's format, compressed."""
        writer = df.write.format(self.fmt)
        return writer.option("compression", COMPRESSION[self.fmt]) if self.fmt in COMPRESSION else writer

    def _versioned(self, tier: str) -> bool:
        return tier != "bronze" and self.fmt not in TRANSACTIONAL

    def versions(self, spark: SparkSession, tier: str, table: str) -> list[tuple[int, str]]:
        """(number, path) of the complete versions, in order."""
        fs, path = _fs(spark, self.folder(tier, table))
        if not fs.exists(path):
            return []
        found = []
        for status in fs.listStatus(path):
            name = status.getPath().getName()
            if name.startswith("v-") and fs.exists(_path(spark, f"{self.folder(tier, table)}/{name}/_SUCCESS")):
                found.append((int(name[2:]), f"{self.folder(tier, table)}/{name}"))
        return sorted(found)

    def path(self, spark: SparkSession, tier: str, table: str) -> str:
        """Where the current rows are."""
        if not self._versioned(tier):
            return self.folder(tier, table)
        found = self.versions(spark, tier, table)
        if not found:
            raise FileNotFoundError(f"{tier}.{table} has no complete version under {self.root}")
        return found[-1][1]

    def exists(self, spark: SparkSession, tier: str, table: str) -> bool:
        """Whether the table is there.  Any failure to find out (a denied or throttled store)
        is raised: it must never be taken for a missing table."""
        if self._versioned(tier):
            return bool(self.versions(spark, tier, table))
        fs, path = _fs(spark, self.folder(tier, table))
        return bool(fs.exists(path))

    def bootstrap(self, spark: SparkSession) -> None:
        """Create every table that is definitely missing, empty, with its fixed schema.
        Nothing that exists is ever written to."""
        for (tier, table), schema in {**TABLES, **(OPTIONAL if self.variants else {})}.items():
            if self.exists(spark, tier, table):
                continue
            if self._versioned(tier):
                self.write(spark.createDataFrame([], schema), tier, table)
            elif self.fmt in TRANSACTIONAL:
                spark.createDataFrame([], schema).write.format(self.fmt).mode("ignore").save(self.folder(tier, table))
            else:  # an empty folder is an empty partitioned table
                fs, path = _fs(spark, self.folder(tier, table))
                fs.mkdirs(path)

    def read(self, spark: SparkSession, tier: str, table: str, partitions: bool = False) -> DataFrame:
        """A tier table with its declared columns (and its partition columns when asked).

        Read with the declared schema, so a table that has no files yet reads as empty instead of failing schema
        inference."""
        schema = TABLES.get((tier, table)) or OPTIONAL.get((tier, table))
        path = self.path(spark, tier, table)
        if schema is None:
            return spark.read.format(self.fmt).load(path)
        extra = {c: t for c, t in PARTITIONING.get((tier, table), {}).items() if c not in schema.names}
        reader = spark.read.format(self.fmt)
        if self.fmt not in TRANSACTIONAL:
            reader = reader.schema(T.StructType([*schema.fields, *(T.StructField(c, t) for c, t in extra.items())]))
        df = reader.load(path)
        if tier == "bronze" and list(extra) == list(LANDED):
            df = df.filter(self.raw_view(spark).counts())
        return df.select(*schema.names, *(extra if partitions else ()))

    def raw_view(self, spark: SparkSession) -> RawView:
        """What the compactions have finished."""
        found = self.versions(spark, "silver", "raw_view") if self._versioned("silver") else []
        if not found:
            return RawView()
        path = found[-1][1]
        if path not in _VIEWS:
            rows = self.read(spark, "silver", "raw_view").collect()  # a row a streaming query
            _VIEWS[path] = RawView(rows[0]["generation"], rows[0]["last_day"], {
                r["run"]: r["mark"] for r in rows if r["mark"] is not None}) if rows else RawView()
        return _VIEWS[path]

    def drop_hidden(self, spark: SparkSession, table: str, view: RawView) -> None:
        """Delete the folders of batches that a finished compaction holds."""
        fs, root = _fs(spark, self.folder("bronze", table))
        folders = lambda path: [s.getPath() for s in fs.listStatus(path) if s.isDirectory()]
        value = lambda path: path.getName().split("=", 1)[1]
        for day in [p for p in folders(root) if p.getName().startswith("ingest_date=")]:
            if value(day) == _NULL_PART or date.fromisoformat(value(day)) > view.last_day:
                continue
            for run in folders(day):
                for batch in folders(run):
                    if value(batch) != _NULL_PART and 0 <= int(value(batch)) <= view.marks.get(value(run), -1):
                        fs.delete(batch, True)

    def laid_out(self, df: DataFrame, tier: str, table: str) -> DataFrame:
        """With the partition column, rows of a partition together in files of a size that AQE
        picks, in time order within a file (row-group statistics then skip by time).  Rows that have their partition
        column already are laid out."""
        if (tier, table) not in PERIODS:
            return df
        column, time = next(iter(PARTITIONING[tier, table])), PERIODS[tier, table][0]
        if column in df.columns:
            return df
        return (df.withColumn(column, period_of(tier, table)).hint("rebalance", column)
                .sortWithinPartitions(column, time))

    def write(self, df: DataFrame, tier: str, table: str, measures: dict[str, Column] | None = None) -> dict:
        """Replace the whole table by a new version; returns the ``measures`` (aggregates by name)
        of its rows, taken while they are written.

        They are observed in the stage that writes, behind its shuffle: there a task that is run again counts
        once.  Columns that begin with ``_`` serve the measures and are not written."""
        spark = df.sparkSession
        df, found = observed(self.laid_out(df, tier, table), measures)
        writer = self.writer(df)
        parts = [c for c in PARTITIONING.get((tier, table), {}) if c in df.columns]
        if parts:
            writer = writer.partitionBy(*parts)
        if not self._versioned(tier):
            writer.mode("overwrite").option("partitionOverwriteMode", "static").save(self.folder(tier, table))
            return found()
        old = self.versions(spark, tier, table)
        number = old[-1][0] + 1 if old else 0
        # "overwrite" only clears what a failed attempt at this number left behind.
        (writer.mode("overwrite").option("partitionOverwriteMode", "static")
         .save(f"{self.folder(tier, table)}/v-{number:010d}"))
        for _, path in old[:-(KEPT_VERSIONS - 1)]:
            fs, p = _fs(spark, path)
            fs.delete(p, True)
        return found()

    def replace_days(self, df: DataFrame, tier: str, table: str, days: list) -> None:
        """Replace the given days (partitions) of the current version by the rows of ``df``,
        which has no row of another day; days without rows go: they are those whose files the write left as they were."""
        spark = df.sparkSession
        path = self.path(spark, tier, table)
        df = self.laid_out(df, tier, table)
        column = next(iter(PARTITIONING[tier, table]))
        folders = {day: f"{path}/{column}={_NULL_PART if day is None else day.isoformat()}" for day in days}
        before = {day: _files(spark, folder) for day, folder in folders.items()}
        (self.writer(df).mode("overwrite").partitionBy(column)
         .option("partitionOverwriteMode", "dynamic").save(path))
        for day, folder in folders.items():
            if before[day] and _files(spark, folder) == before[day]:
                fs, p = _fs(spark, folder)
                fs.delete(p, True)

    def add_part(self, df: DataFrame, tier: str, table: str, number: int) -> None:
        """Put the rows of ``df`` into the current version as the part (first partition column)
        ``number``, in place of what a failed attempt left there."""
        spark = df.sparkSession
        path = self.path(spark, tier, table)
        parts = list(PARTITIONING[tier, table])
        self.drop_parts(spark, tier, table, [number])
        (self.writer(df.withColumn(parts[0], F.lit(number).cast("long"))).mode("overwrite").partitionBy(*parts)
         .option("partitionOverwriteMode", "dynamic").save(path))

    def parts(self, spark: SparkSession, tier: str, table: str) -> list[int]:
        """Numbers of the parts of the current version."""
        fs, path = _fs(spark, self.path(spark, tier, table))
        names = [s.getPath().getName() for s in fs.listStatus(path) if s.isDirectory()]
        first = next(iter(PARTITIONING[tier, table]))
        return sorted(int(n.split("=")[1]) for n in names if n.startswith(f"{first}="))

    def drop_parts(self, spark: SparkSession, tier: str, table: str, numbers: list[int]) -> None:
        path = self.path(spark, tier, table)
        for n in numbers:
            fs, p = _fs(spark, f"{path}/{next(iter(PARTITIONING[tier, table]))}={n}")
            fs.delete(p, True)

    def line_folders(self, spark: SparkSession) -> list[str]:
        """Folders of the bucketed order lines."""
        fs, path = _fs(spark, self.folder("silver", "order_lines"))
        return [s.getPath().getName() for s in fs.listStatus(path)] if fs.exists(path) else []

    def drop_folder(self, spark: SparkSession, folder: str) -> None:
        """Delete a folder below the store's root."""
        fs, p = _fs(spark, f"{self.root.rstrip('/')}/{folder}")
        fs.delete(p, True)

    def land(self, df: DataFrame, table: str, run: str, batch_id: int) -> None:
        """Write one micro-batch of a raw table.  Its partitions are named by the streaming
        query's id and the batch's number, so a replay replaces its own rows and nothing
        else; a query with a new checkpoint has a new id."""
        df = df.withColumn("run", F.lit(run)).withColumn("batch_id", F.lit(int(batch_id)).cast("long"))
        parts = list(PARTITIONING["bronze", table])
        writer = self.writer(df).partitionBy(*parts)
        if self.fmt in TRANSACTIONAL:
            (writer.mode("append").option("txnAppId", f"{run}-{table}").option("txnVersion", int(batch_id))
             .save(self.folder("bronze", table)))
        else:
            (writer.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .save(self.folder("bronze", table)))


def observed(df: DataFrame, measures: dict[str, Column] | None) -> tuple[DataFrame, Callable[[], dict]]:
    """``df`` without its ``_`` columns, and what gives the measures of its rows once an action has run."""
    if not measures:
        return df, dict
    taken = Observation()
    df = df.observe(taken, *[m.alias(name) for name, m in measures.items()])
    return df.drop(*[c for c in df.columns if c.startswith("_")]), lambda: taken.get


def period_of(tier: str, table: str) -> Column:
    """First day of the period that a refined row belongs to."""
    time, unit = PERIODS[tier, table]
    return F.to_date(F.date_trunc(unit, F.col(time)))


def _files(spark: SparkSession, path: str) -> set[str]:
    """Names of the files of a folder, which no two writes give twice; none for a folder that is not there."""
    fs, p = _fs(spark, path)
    return {s.getPath().getName() for s in fs.listStatus(p)} if fs.exists(p) else set()


def _path(spark: SparkSession, path: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)


def _fs(spark: SparkSession, path: str):
    p = _path(spark, path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p
