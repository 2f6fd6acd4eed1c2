"""Dead-letter replay: messages that were turned away, run again through the present rules.

A dead letter is known by (topic, partition, offset), whatever number of streaming queries stored it.  A replay takes
those that no finished replay has landed, as they are (the rules may have changed) or with a corrected
value, and lands the ones that are valid now as a batch of the run ``replay``; the ledger says which.  Everything a replay writes is
keyed by its number, and its statistics come last: one that failed is done again under the same number, in place of
what it left.  So a message is landed once, however often a replay runs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierline.sources.tables import TierStore, observed
from tierline.streaming import ingest

RUN = "replay"
KEY = ("topic", "partition", "offset")


def finished(spark: SparkSession, store: TierStore) -> DataFrame:
    """Numbers of the finished replays."""
    stats = store.read(spark, "bronze", "ingest_stats", partitions=True)
    return stats.filter(F.col("run") == RUN).select("batch_id").distinct()


def replayed(spark: SparkSession, store: TierStore) -> DataFrame:
    """The ledger: dead letters that finished replays have landed, and in which."""
    return (store.read(spark, "bronze", "replayed", partitions=True).filter(F.col("run") == RUN)
            .join(finished(spark, store), "batch_id", "left_semi").select(*KEY, "batch_id"))


def status(spark: SparkSession, store: TierStore) -> DataFrame:
    """Every dead letter once, with its errors and the replay that landed it (NULL: none has)."""
    letters = store.read(spark, "bronze", "dead_letter").dropDuplicates(list(KEY))
    ledger = replayed(spark, store).select(*[F.col(c).alias(f"of_{c}") for c in KEY], F.col("batch_id").alias("replay"))
    return letters.join(ledger, _same(letters, ledger), "left").select(*letters.columns, "replay")


def _same(letters: DataFrame, other: DataFrame):
    out = F.lit(True)
    for c in KEY:
        out = out & letters[c].eqNullSafe(other[f"of_{c}"])
    return out


def replay(spark: SparkSession, store: TierStore, corrections: DataFrame | None = None) -> int:
    """Run the open dead letters through the present rules; the number of messages landed.

    ``corrections`` (topic, partition, offset, value; one row a message) replace the stored values."""
    number = (finished(spark, store).agg(F.max("batch_id")).first()[0] or 0) + 1
    letters = status(spark, store).filter(F.col("replay").isNull())
    if corrections is not None:
        fixed = corrections.select(*[F.col(c).alias(f"of_{c}") for c in KEY], F.col("value").alias("fixed")).dropDuplicates(
            [f"of_{c}" for c in KEY])
        letters = letters.join(fixed, _same(letters, fixed), "left").withColumn("value", F.coalesce("fixed", "value"))
    # Written apart first: what is landed below must not be read from the tables it is landed in.
    staged = f"{store.root.rstrip('/')}/_replay/{number}"
    messages = letters.select(*KEY, F.col("broker_timestamp").alias("timestamp"), "value")
    messages.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(staged)
    messages = spark.read.schema(messages.schema).parquet(staged)
    decoded = ingest.decode(messages)
    good = F.size("errors") == 0
    events = ingest.validate_events(decoded).filter(good).persist()
    orders = ingest.validate_orders_raw(decoded).filter(good).persist()
    day = F.to_date("broker_timestamp").alias("ingest_date")
    try:
        landed = events.count() + orders.count()
        if landed:
            counted_ev, ev_stats = observed(events, ingest.stats_measures("timestamp"))
            counted_od, od_stats = observed(orders, ingest.stats_measures("created_at"))
            store.land(counted_ev.select(*ingest.EVENT_COLUMNS, day), "events", RUN, number)
            store.land(counted_od.select(*ingest.ORDER_COLUMNS, day), "orders", RUN, number)
            store.land(events.select(*KEY).unionByName(orders.select(*KEY)), "replayed", RUN, number)
            store.land(ingest.batch_stats(spark, ev_stats(), od_stats()), "ingest_stats", RUN, number)  # last: the replay is finished
        return landed
    finally:
        events.unpersist()
        orders.unpersist()
        store.drop_folder(spark, f"_replay/{number}")
