"""The fixture's raw rows landed in batches and refreshed batch by batch, as a deployed store
would be: the input of the queries that show the maintained tables.

A redelivered copy lands in another batch than its first delivery, and the batches follow no time order, so
refreshes meet late rows, moved rows and rows that lose to one already there.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierline.plans.refresh import run_refresh
from tierline.session import ensure_checkpoint_dir
from tierline.sources import fixtures as fx
from tierline.sources import topic_log
from tierline.sources.tables import COMPRESSION, TierStore, observed
from tierline.streaming import ingest, replay

BATCHES = 3
BUCKET_ROWS = 1 << 20
_STORES: dict[tuple[str, str], TierStore] = {}


def scratch_store(spark: SparkSession, **kw) -> TierStore:
    """A fresh store under the cluster's shared checkpoint folder."""
    return TierStore(f"{ensure_checkpoint_dir(spark).rstrip('/')}/store-{uuid.uuid4().hex}", **kw)


def buckets_for(spark: SparkSession, sf_dir: str) -> int:
    """Buckets for a store of the fixture's rows: about ``BUCKET_ROWS`` events and order lines each."""
    rows = sum(fx.read_table(spark, sf_dir, name).count() for name in ("events", "lineitem"))
    return max(16, -(-rows // BUCKET_ROWS))


def raw_copies(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Raw events and orders with the batch each copy lands in."""
    batch = ((F.col("_k") + F.col("_copy")) % BATCHES).cast("long").alias("landed_in")
    events = fx.event_copies(spark, sf_dir).select(*ingest.EVENT_COLUMNS, batch)
    orders = fx.order_copies(spark, sf_dir).withColumn("items", F.to_json("_items")).select(*ingest.ORDER_COLUMNS, batch)
    return events, orders


def staged_copies(spark: SparkSession, sf_dir: str, store: TierStore) -> list[DataFrame]:
    """``raw_copies``, derived once and kept in the store, a folder a batch: landing a batch reads its own rows.

    Each task writes what it derived, so however few the batches are, no task holds one of them."""
    staged = []
    for name, df in zip(("events", "orders"), raw_copies(spark, sf_dir)):
        df.write.partitionBy("landed_in").parquet(f"{store.root}/_landing/{name}", compression=COMPRESSION["parquet"])
        staged.append(spark.read.schema(df.schema).parquet(f"{store.root}/_landing/{name}"))
    return staged


def land_batch(spark: SparkSession, store: TierStore, events: DataFrame, orders: DataFrame, batch: int) -> None:
    """Land the rows of one batch and its statistics, as the ingest query does."""
    day = F.lit(fx.FIXTURE_AS_OF).cast("date").alias("ingest_date")
    stats = []
    for rows, table, time in ((events, "events", "timestamp"), (orders, "orders", "created_at")):
        own, taken = observed(rows.filter(F.col("landed_in") == batch).drop("landed_in"), {
            "rows": F.count(F.lit(1)), "dead_letters": F.count_if(F.lit(False)), "latest_at": F.max(time)})
        store.land(own.select("*", day), table, "fixture", batch)
        stats.append(taken())
    store.land(ingest.batch_stats(spark, *stats), "ingest_stats", "fixture", batch)


def refreshed_store(spark: SparkSession, sf_dir: str) -> TierStore:
    """A store after ``BATCHES`` landed batches, each followed by an incremental refresh; made once
    for a session and a source folder."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _STORES:
        store = scratch_store(spark, buckets=buckets_for(spark, sf_dir), variants=True)
        store.bootstrap(spark)
        staged = staged_copies(spark, sf_dir, store)
        for batch in range(BATCHES):
            land_batch(spark, store, *staged, batch)
            run_refresh(spark, store, fx.FIXTURE_AS_OF, steps=("silver", "quality", "gold"), incremental=True)
        _STORES[key] = store
    return _STORES[key]


def observed_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality rules as a full refresh of the landed batches counts them while it writes."""
    store = scratch_store(spark, buckets=buckets_for(spark, sf_dir))
    store.bootstrap(spark)
    staged = staged_copies(spark, sf_dir, store)
    for batch in range(BATCHES):
        land_batch(spark, store, *staged, batch)
    return run_refresh(spark, store, fx.FIXTURE_AS_OF, steps=("silver", "quality"), gate=False).quality


def observed_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The statistics that the ingest of the fixture's topic records leaves, in ``BATCHES`` micro-batches."""
    store = scratch_store(spark)
    store.bootstrap(spark)
    messages = fx.topic_messages(spark, sf_dir).withColumn("read_in", F.col("offset") % BATCHES)
    messages.write.partitionBy("read_in").parquet(f"{store.root}/_topics")  # derived once, as a topic keeps them
    messages = spark.read.schema(messages.schema).parquet(f"{store.root}/_topics")
    for batch in range(BATCHES):
        ingest.write_batch(messages.filter(F.col("read_in") == batch).drop("read_in"), batch, store, "fixture")
    return store.read(spark, "bronze", "ingest_stats").groupBy("source_name").agg(
        F.sum("rows").alias("rows"), F.sum("dead_letters").alias("dead_letters"), F.max("latest_at").alias("latest_at"))


def compacted_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw events of a store whose first batches are refined and compacted, and whose last has
    just landed."""
    from tierline.plans.compaction import compact_raw

    store = scratch_store(spark, buckets=buckets_for(spark, sf_dir))
    store.bootstrap(spark)
    staged = staged_copies(spark, sf_dir, store)
    for batch in range(BATCHES):
        land_batch(spark, store, *staged, batch)
        if batch == BATCHES - 2:
            run_refresh(spark, store, fx.FIXTURE_AS_OF, steps=("silver",), incremental=True)
            compact_raw(spark, store, "2024-02-01")
    return store.read(spark, "bronze", "events")


def replayed_letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fixture's dead letters after a replay in which the events with broken metadata are corrected, run
    twice: what the second finds open stays open."""
    store = scratch_store(spark)
    store.bootstrap(spark)
    letters = ingest.dead_letters(ingest.decode(fx.topic_messages(spark, sf_dir)))
    letters.write.parquet(f"{store.root}/_letters")  # both queries store the same letters: found once
    letters = spark.read.schema(letters.schema).parquet(f"{store.root}/_letters")
    for batch in range(2):  # two queries have stored the same letters
        store.land(letters.withColumn("ingest_date", F.lit(fx.FIXTURE_AS_OF).cast("date")), "dead_letter", "fixture", batch)
    broken = store.read(spark, "bronze", "dead_letter").filter(F.col("value").endswith('"metadata":not json}'))
    fixed = broken.select(*replay.KEY, F.expr("""replace(value, '"metadata":not json}', '"metadata":{}}')""").alias("value"))
    for _ in range(2):
        replay.replay(spark, store, fixed)
    return replay.status(spark, store).select(*replay.KEY, F.array_join("errors", "; ").alias("errors"),
                                              F.col("replay").cast("int").alias("replay"))


_LOGS: dict[tuple[str, str], str] = {}


def replayed_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fixture's topic records after a stream has read them from a topic log that grew in
    ``BATCHES`` pieces, restarted after each; made once for a session and a source folder."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _LOGS:
        root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/topics-{uuid.uuid4().hex}"
        log, checkpoint, out = (f"{root}/{name}" for name in ("log", "checkpoint", "out"))
        records = fx.topic_messages(spark, sf_dir)
        records.write.parquet(f"{root}/records")
        records = spark.read.schema(records.schema).parquet(f"{root}/records")
        last = records.agg(F.max("offset")).first()[0] or 0
        for piece in range(BATCHES):  # a topic partition's log grows at its end
            bounds = [last * p // BATCHES for p in (piece, piece + 1)]
            own = (F.col("offset") >= bounds[0]) & ((F.col("offset") < bounds[1]) | F.lit(piece == BATCHES - 1))
            topic_log.append(records.filter(own), log)
            (topic_log.read_stream(spark, log, checkpoint).writeStream.format("parquet").option("path", out)
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination())
        _LOGS[key] = out
    return spark.read.schema(topic_log.SCHEMA).parquet(_LOGS[key])
