"""Records → topic messages (the publishing half of the ingest path)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Topic names of the two record streams.
EVENTS_TOPIC = "raw.events"
ORDERS_TOPIC = "raw.orders"
_TIME = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"  # Spark's default format drops microseconds


def to_topic_records(df: DataFrame, topic: str, key: str | None = None,
                     json_columns: tuple[str, ...] = ()) -> DataFrame:
    """``topic, key, value`` rows: each record serialised as one JSON object.

    ``json_columns`` hold JSON text (a raw table's ``metadata`` or ``items``) and are embedded
    as JSON values, not as quoted strings.  Text that is not JSON stays in the message as a string, which
    the ingest's rules name and dead-letter; a NULL field is an explicit ``null``.  The frame is what a Kafka sink takes
    (``df.write.format("kafka")``, see ``write_topic``); the broker assigns partition and
    offset."""
    fields = [F.coalesce(F.try_parse_json(F.col(c)), F.col(c).cast("variant")).alias(c) if c in json_columns
              else F.col(c) for c in df.columns]
    value = F.to_json(F.struct(*fields), {
        "ignoreNullFields": "false", "timestampFormat": f"{_TIME}XXX", "timestampNTZFormat": _TIME})
    k = F.col(key).cast("string") if key else F.lit(None).cast("string")
    return df.select(F.lit(topic).alias("topic"), k.alias("key"), value.alias("value"))


def write_topic(records: DataFrame, bootstrap_servers: str | None = None, path: str | None = None) -> None:
    """Publish with all-replica acknowledgement to Kafka, or write JSON lines offline."""
    if bootstrap_servers:
        (records.selectExpr("topic", "key", "value").write.format("kafka")
         .option("kafka.bootstrap.servers", bootstrap_servers)
         .option("kafka.acks", "all")
         .save())
    elif path:
        records.write.mode("append").json(path)
    else:
        raise ValueError("give bootstrap_servers or path")
