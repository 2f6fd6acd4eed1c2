"""Topic → raw tables ingest, as Structured Streaming with a dead-letter sink.

One streaming query subscribes to both topics.  Each micro-batch is decoded once (one
Variant parse per message), split by topic, validated by column rules, and written:

* good events / orders → the raw tables,
* everything else → the dead-letter table with its ``errors`` (nothing is silently lost).

Writes are keyed by the streaming query's id and the micro-batch's number (partitions
``run`` and ``batch_id`` below ``ingest_date``, dynamic overwrite), so a batch replayed after a
failure replaces its own output instead of appending twice, and a query with another
checkpoint, which counts its batches from 0 again, adds to what is there.  With the checkpoint
this makes the raw tables effectively exactly-once although delivery is at-least-once.  The batch functions (``decode``, ``validate_events``, ``dead_letters`` …) are
the same ones the stream uses, so they are tested and registered as ordinary batch queries too.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierline.functions import validation as V
from tierline.schemas import INGEST_STATS
from tierline.sources import topic_log
from tierline.sources.tables import TierStore, observed
from tierline.sources.topics import EVENTS_TOPIC, ORDERS_TOPIC

# The columns a topic source delivers (a Kafka source has them; a file source is given them).
TOPIC_SCHEMA = T.StructType([
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("value", T.StringType()),
])

EVENT_COLUMNS = ("event_id", "event_type", "user_id", "session_id", "page", "referrer", "metadata", "timestamp")
ORDER_COLUMNS = ("order_id", "user_id", "items", "total_amount", "currency", "status", "shipping_address",
                 "created_at")
DEAD_LETTER_COLUMNS = ("topic", "partition", "offset", "broker_timestamp", "value", "errors")


def message_id(topic: str = "topic", partition: str = "partition", offset: str = "offset") -> Column:
    """Deterministic UUID-shaped id for a record without one: a redelivery of the same
    message (same topic, partition, offset) gets the same id, so deduplication still works."""
    h = F.sha2(F.concat_ws(":", F.col(topic), F.col(partition).cast("string"), F.col(offset).cast("string")), 256)
    return F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.substring(h, 13, 4),
                       F.substring(h, 17, 4), F.substring(h, 21, 12))


def decode(messages: DataFrame) -> DataFrame:
    """Attach the parsed Variant ``_v`` (value bytes/text decoded as UTF-8 JSON); the
    record's own ``timestamp`` field must not clash with the broker's, which becomes
    ``broker_timestamp``."""
    value = F.col("value").cast("string")
    return messages.select("topic", "partition", "offset", F.col("timestamp").alias("broker_timestamp"),
                           value.alias("value"), V.parse_value(value).alias("_v"))


def _event_record() -> list[Column]:
    f, t = V.f, V.t
    return [
        F.coalesce(V.as_string(f("event_id"), t("event_id")), message_id()).alias("event_id"),
        V.as_string(f("event_type"), t("event_type")).alias("event_type"),
        V.as_string(f("user_id"), t("user_id")).alias("user_id"),
        V.as_string(f("session_id"), t("session_id")).alias("session_id"),
        V.as_string(f("page"), t("page")).alias("page"),
        V.as_string(f("referrer"), t("referrer")).alias("referrer"),
        F.when(f("metadata").isNull(), F.lit("{}")).otherwise(F.to_json(f("metadata"))).alias("metadata"),
        F.when(f("timestamp").isNull(), F.col("broker_timestamp").cast("timestamp_ntz"))
        .otherwise(F.col("_ts_timestamp")).alias("timestamp"),
    ]


def _order_record() -> list[Column]:
    f, t = V.f, V.t
    return [
        F.coalesce(V.as_string(f("order_id"), t("order_id")), message_id()).alias("order_id"),
        V.as_string(f("user_id"), t("user_id")).alias("user_id"),
        # items re-serialised with exactly the four typed item fields, in field order
        F.col("_items_json").alias("items"),
        V.as_double(f("total_amount"), t("total_amount")).alias("total_amount"),
        F.coalesce(V.as_string(f("currency"), t("currency")), F.lit(V.DEFAULT_CURRENCY)).alias("currency"),
        F.coalesce(V.as_string(f("status"), t("status")), F.lit(V.DEFAULT_STATUS)).alias("status"),
        V.as_string(f("shipping_address"), t("shipping_address")).alias("shipping_address"),
        F.when(f("created_at").isNull(), F.col("broker_timestamp").cast("timestamp_ntz"))
        .otherwise(F.col("_ts_created_at")).alias("created_at"),
    ]


def defaulted(names) -> Column:
    """Names of the defaultable fields that are absent from the message."""
    return V.label_list(*[F.when(V.f(n).isNull(), F.lit(n)) for n in names])


def validate_events(decoded: DataFrame) -> DataFrame:
    """Event messages with ``errors``, ``defaults`` (fields filled in) and the typed record."""
    staged = V.with_times(V.with_kinds(V.with_fields(
        decoded.filter(F.col("topic") == EVENTS_TOPIC), "_v", V.EVENT_FIELDS), V.EVENT_FIELDS), ["timestamp"])
    return V.computed_once(staged, DEAD_LETTER_COLUMNS[:5], [
        V.event_errors(F.col("value"), F.col("_v")).alias("errors"),
        defaulted(("event_id", "metadata", "timestamp")).alias("defaults"), *_event_record()])


def validate_orders_raw(decoded: DataFrame) -> DataFrame:
    """Order messages with ``errors``, ``defaults`` (fields filled in) and the typed record."""
    staged = V.with_items(V.with_times(V.with_kinds(
        V.with_fields(decoded.filter(F.col("topic") == ORDERS_TOPIC), "_v", V.ORDER_FIELDS), V.ORDER_FIELDS),
        ["created_at"]))
    return V.computed_once(staged, DEAD_LETTER_COLUMNS[:5], [
        V.order_errors(F.col("value"), F.col("_v")).alias("errors"),
        defaulted(("order_id", "currency", "status", "created_at")).alias("defaults"), *_order_record()])


def good_events(validated: DataFrame) -> DataFrame:
    return validated.filter(F.size("errors") == 0).select(*EVENT_COLUMNS)


def good_orders(validated: DataFrame) -> DataFrame:
    return validated.filter(F.size("errors") == 0).select(*ORDER_COLUMNS)


def unrouted(decoded: DataFrame) -> DataFrame:
    """Messages from a topic that is neither events nor orders."""
    return decoded.filter(~F.col("topic").isin(EVENTS_TOPIC, ORDERS_TOPIC) | F.col("topic").isNull()).select(
        *DEAD_LETTER_COLUMNS[:5], F.array(F.lit("topic: not subscribed")).alias("errors"))


def dead_letters(decoded: DataFrame) -> DataFrame:
    """Every message that did not become a raw row, with its reasons."""
    cols = list(DEAD_LETTER_COLUMNS)
    return (validate_events(decoded).filter(F.size("errors") > 0).select(*cols)
            .unionByName(validate_orders_raw(decoded).filter(F.size("errors") > 0).select(*cols))
            .unionByName(unrouted(decoded)))


def ingest_batch(messages: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(raw events, raw orders, dead letters) from a batch of topic records."""
    decoded = decode(messages)
    return (good_events(validate_events(decoded)), good_orders(validate_orders_raw(decoded)),
            dead_letters(decoded))


# ---------------------------------------------------------------- streaming

# Upper bound on messages per micro-batch: each batch is persisted once while it is split
# into good rows and dead letters, so its size must not grow with the backlog.
# A rate, not a cap: what is left waits for the next batch.
MAX_OFFSETS_PER_TRIGGER = 20_000_000
MAX_FILE_BYTES_PER_TRIGGER = 16 << 30


def read_topics(spark: SparkSession, source: str = "files", path: str | None = None,
                bootstrap_servers: str | None = None, topics=(EVENTS_TOPIC, ORDERS_TOPIC),
                max_bytes_per_trigger: int = MAX_FILE_BYTES_PER_TRIGGER,
                max_offsets_per_trigger: int = MAX_OFFSETS_PER_TRIGGER, checkpoint: str | None = None) -> DataFrame:
    """Streaming topic records.

    ``source="kafka"`` subscribes to the topics from the earliest offset (needs the Kafka
    connector on the classpath; not run here, there is no broker) with at most ``max_offsets_per_trigger`` messages
    per batch; ``source="log"`` reads a log of ``sources.topic_log`` the same way, given the
    ``checkpoint`` of the query that will read it;
    ``source="files"`` reads JSON-lines files with the same
    ``topic, partition, offset, timestamp, value`` columns, at most
    ``max_bytes_per_trigger`` of files per batch, for offline runs and tests.
    """
    if source == "kafka":
        return (spark.readStream.format("kafka")
                .option("kafka.bootstrap.servers", bootstrap_servers)
                .option("subscribe", ",".join(topics))
                .option("startingOffsets", "earliest")
                .option("maxOffsetsPerTrigger", str(max_offsets_per_trigger))
                .option("failOnDataLoss", "true")
                .load()
                .select("topic", "partition", "offset", "timestamp", F.col("value").cast("string").alias("value")))
    if source == "log":
        stream = topic_log.read_stream(spark, path, checkpoint, max_offsets_per_trigger if checkpoint else None)
        return stream.filter(F.col("topic").isin(*topics))
    return (spark.readStream.schema(TOPIC_SCHEMA)
            .option("maxBytesPerTrigger", str(max_bytes_per_trigger)).json(path))


def stats_measures(ts: str) -> dict[str, Column]:
    """Of one micro-batch's validated messages: rows landed, rows dead-lettered and the newest
    record time ``ts``."""
    good = F.size("errors") == 0
    return {"rows": F.count_if(good), "dead_letters": F.count_if(~good), "latest_at": F.max(F.when(good, F.col(ts)))}


def batch_stats(spark: SparkSession, events: dict, orders: dict) -> DataFrame:
    """The statistics of one micro-batch, a row per raw table, from the measures of its validated messages.
    Read by the freshness check instead of scanning the whole raw table."""
    return spark.createDataFrame([("bronze.events", *(events[c] for c in STATS)), ("bronze.orders", *(orders[c] for c in STATS))],
                                 INGEST_STATS)


STATS = INGEST_STATS.names[1:]


def write_batch(messages: DataFrame, batch_id: int, store: TierStore, run: str) -> None:
    """Write one micro-batch idempotently: each output replaces its own ``run`` / ``batch_id``
    partitions.

    The batch is read from the source once and validated once: the incoming records and the
    two validated frames are persisted (a micro-batch is bounded by the trigger), so the good
    rows, the dead letters and the statistics all read cached results instead of fetching the
    batch again or re-running the rules.  They are kept on the executors' disks: a partition of whole messages
    is as large as the source made it, and several of them at once need not fit into memory.  Of a good
    row the message is not kept.  The statistics are observed while the good rows are written.
    """
    messages = messages.persist(StorageLevel.DISK_ONLY)
    decoded = decode(messages)
    good, bad = F.size("errors") == 0, F.size("errors") > 0
    ev, od = (validated.withColumn("value", F.when(bad, F.col("value"))).drop("defaults").persist(StorageLevel.DISK_ONLY)
              for validated in (validate_events(decoded), validate_orders_raw(decoded)))
    # One date a batch, its newest: the same on a replay, and one folder a batch however old
    # the records of a backlog are.
    newest = messages.agg(F.max(F.to_date("timestamp"))).first()[0]
    day = F.lit(newest).cast("date").alias("ingest_date")
    try:
        cols = list(DEAD_LETTER_COLUMNS)
        dead = (ev.filter(bad).select(*cols).unionByName(od.filter(bad).select(*cols))
                .unionByName(unrouted(decoded)))
        counted_ev, ev_stats = observed(ev, stats_measures("timestamp"))
        counted_od, od_stats = observed(od, stats_measures("created_at"))
        store.land(counted_ev.filter(good).select(*EVENT_COLUMNS, day), "events", run, batch_id)
        store.land(counted_od.filter(good).select(*ORDER_COLUMNS, day), "orders", run, batch_id)
        store.land(dead.select(*cols, day), "dead_letter", run, batch_id)
        stats = batch_stats(messages.sparkSession, ev_stats(), od_stats())
        store.land(stats, "ingest_stats", run, batch_id)  # last: the batch is complete
    finally:
        ev.unpersist()
        od.unpersist()
        messages.unpersist()


def query_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that Spark keeps in a checkpoint for the life of its streaming query."""
    row = spark.read.text(f"{checkpoint.rstrip('/')}/metadata").select(
        F.get_json_object("value", "$.id").alias("id")).filter(F.col("id").isNotNull()).first()
    return row["id"]


def default_checkpoint(store: TierStore) -> str:
    """Beside the tables it belongs to: as durable and as shared as they are, and the same
    folder for every later run."""
    return f"{store.root.rstrip('/')}/_checkpoints/ingest"


def start_ingest(stream: DataFrame, store: TierStore, checkpoint: str | None = None,
                 available_now: bool = False, interval: str = "1 minute"):
    """Start the ingest query into the raw tables of ``store``."""
    checkpoint = checkpoint or default_checkpoint(store)

    def batch(df: DataFrame, batch_id: int) -> None:
        write_batch(df, batch_id, store, query_id(df.sparkSession, checkpoint))

    writer = stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval)
    return writer.start()
