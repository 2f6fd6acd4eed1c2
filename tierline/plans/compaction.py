"""Compaction of raw tables: finished micro-batches of past days become one sorted partition a day.

A micro-batch lands in a folder of its own, half a million a year at one a minute.  Once a batch is refined
(it lies below its query's high-water mark) only full rebuilds and raw reports read it again, so the batches
of a day and query are rewritten as one partition, ``batch_id = -generation``, sorted by record id, each row with
its batch in the column ``landed_batch``.

What a reader sees changes at once, by a small table that is replaced atomically (generation, last day, marks):
``TierStore.read`` shows parts of finished generations, and hides the batches they hold.  A compaction that failed before
that has changed nothing and is done again under the same generation; the hidden folders are
deleted afterwards.  Batches that land late for a compacted day are seen as ever, and go into the next generation.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tierline.plans.incremental import read_commit
from tierline.sources.tables import LANDED, RawView, TierStore

#: Raw tables and the columns that sort a day's rows.
TABLES = {"events": ("event_id", "timestamp"), "orders": ("order_id", "created_at"),
          "dead_letter": ("topic", "partition", "offset")}


def compact_raw(spark: SparkSession, store: TierStore, before: date | str) -> int:
    """Compact the finished batches of all days before ``before``; the number of the generation."""
    view, commit = store.raw_view(spark), read_commit(spark, store)
    last = (date.fromisoformat(before) if isinstance(before, str) else before) - timedelta(days=1)
    last = max(last, view.last_day) if view.last_day else last
    number = view.generation + 1
    done = F.lit(False)
    for run, mark in commit.marks.items():
        done = done | (F.col("run").eqNullSafe(F.lit(run)) & F.col("batch_id").between(0, mark))
    for table, order in TABLES.items():
        rows = store.read(spark, "bronze", table, partitions=True).filter((F.col("ingest_date") <= F.lit(last)) & done)
        rows = (rows.withColumn("landed_batch", F.col("batch_id")).withColumn("batch_id", F.lit(-number).cast("long"))
                .hint("rebalance", "ingest_date", "run").sortWithinPartitions("ingest_date", "run", *order))
        (store.writer(rows).mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*LANDED)
         .save(store.folder("bronze", table)))
    new = RawView(number, last, dict(commit.marks))
    store.write(spark.createDataFrame(new.rows(), "generation long, last_day date, run string, mark long"), "silver", "raw_view")
    for table in TABLES:
        store.drop_hidden(spark, table, new)
    return number
