"""Adapters: the driver's generic tables → raw (bronze) events and orders, and topic records.

The driver tables carry no session, page, JSON items or redeliveries, so these adapters
derive them with exact, engine-independent arithmetic (integer modulo, concatenation,
decimal sums).  Every source row is kept; the modulo rules only decide how a row is
dressed (a NULL id, an unknown type, a redelivered copy, a burst copy), never whether it
is dropped.  The oracle SQL in ``tierline.plans.oracle`` restates the same rules without any
JSON, so it is an independent check of the Spark path.

Copies (redeliveries, burst rows) come from a ``generate`` (explode of copy tags) in the
same pass as the scan: no self-union and no cross join.  The events adapter is one scan; the
orders adapter also joins each order to its line items (``lineitem ⋈ part``, grouped by
order), since a raw order carries its items.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierline.sources.topics import EVENTS_TOPIC, ORDERS_TOPIC

# Fixed values chosen for the fixtures: pages are the event id mod ``N_PAGES``; the referrer used
# on every third event, and the reference instant of a fixture run.
N_PAGES = 5
REFERRER = "https://search.example/"
FIXTURE_AS_OF = "2024-01-31"
BURST_DATE = "2024-01-15"
TOPIC_PARTITIONS = 4
LINES_A_TASK = 1 << 19
ZERO_TOTAL_REMAINDER = 17  # order messages with key % 101 == 17 carry total_amount 0

# Copy tags: 0 = the row itself, 1 = a redelivery one second later, 2..5 = burst copies.
BASE, RETRY = 0, 1
BURST_TAGS = (2, 3, 4, 5)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _user_id(key: Column) -> Column:
    return F.concat(F.lit("user_"), F.lpad(key.cast("string"), 8, "0"))


def _copies(tags: list[tuple[Column | None, int]]) -> Column:
    """Array of copy tags, NULL where the condition fails (``None`` = always); the exploded
    NULL tags are filtered out right after the explode (no lambda, so codegen stays on)."""
    return F.array(*[F.lit(t) if cond is None else F.when(cond, F.lit(t)) for cond, t in tags])


def event_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Driver ``events`` → one row per raw event copy with its copy tag ``_copy`` and ``_k``."""
    ev = read_table(spark, sf_dir, "events")
    k, u = F.col("event_id"), F.col("user_id")
    shifted = F.col("ts") - F.make_dt_interval(days=(u % 8) * 10)
    base = ev.select(
        k.alias("_k"),
        F.when(k % 200 == 11, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("evt_"), k.cast("string"))).alias("_id"),
        F.when(k % 50 == 7, F.lit("hover"))
        .when(F.col("event_type") == "view", F.lit("page_view"))
        .otherwise(F.col("event_type")).alias("event_type"),
        _user_id(u).alias("user_id"),
        F.concat(F.lit("sess_"), (k % 500).cast("string")).alias("session_id"),
        F.concat(F.lit("/p"), (k % N_PAGES).cast("string")).alias("_page"),
        F.when(k % 3 == 0, F.lit(REFERRER)).alias("referrer"),
        F.when(k % 97 == 0, F.lit("not json")).otherwise(F.col("props")).alias("metadata"),
        shifted.alias("_ts"),
        F.explode(_copies([(None, BASE), (k % 10 == 3, RETRY)]
                          + [(F.to_date(shifted) == F.lit(BURST_DATE).cast("date"), t) for t in BURST_TAGS])
                  ).alias("_copy"),
    )
    c = F.col("_copy")
    return base.filter(c.isNotNull()).select(
        "_k",
        "_copy",
        F.when(c >= BURST_TAGS[0], F.concat(F.col("_id"), F.lit("_b"), (c - 1).cast("string")))
        .otherwise(F.col("_id")).alias("event_id"),
        "event_type",
        "user_id",
        "session_id",
        F.when(c == RETRY, F.lit("/retry")).otherwise(F.col("_page")).alias("page"),
        "referrer",
        "metadata",
        F.when(c == RETRY, F.col("_ts") + F.make_dt_interval(secs=F.lit(1)))
        .otherwise(F.col("_ts")).alias("timestamp"),
    )


def bronze_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw events table (schema of ``tierline.schemas.BRONZE_EVENTS``)."""
    return event_copies(spark, sf_dir).drop("_k", "_copy")


def _order_parts(spark: SparkSession, lines: DataFrame) -> list[int]:
    """Partitions for grouping the lines by order, as first argument of ``repartition``: more than the session's where
    a task would get over ``LINES_A_TASK``, as the arrays of a task's orders are built in its memory; else
    none is named, and AQE joins small ones."""
    needed = -(-lines.count() // LINES_A_TASK)  # of the files' footers
    return [needed] if needed > int(spark.conf.get("spark.sql.shuffle.partitions")) else []


def order_item_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per order key: its items (ordered by line) and their exact decimal sum ``_sum``.

    Items of one order are few (bounded by the order, not by the data size), so collecting
    them per order is safe.  ``part`` joins by broadcast only when Spark measures it under
    the broadcast threshold, else by a sort-merge join.
    """
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice")
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size")
    price = ((F.col("p_size") % 10).cast("decimal(18,2)") + F.lit("0.99").cast("decimal(3,2)")).cast("decimal(18,2)")
    # By order before the arrays are built: a partial collect_list does not shrink the rows, so this is the shuffle
    # that the grouping needs anyway, and the lines are made on every core even when the table is one file.  Behind
    # the join with part, which shuffles the rows by part when that is large.
    joined = li.join(part, li.l_partkey == part.p_partkey, "left").drop("p_partkey")
    lines = joined.repartition(*_order_parts(spark, li), "l_orderkey").select(
        "l_orderkey",
        F.struct(
            F.col("l_linenumber").alias("o1"),
            F.col("l_partkey").alias("o2"),
            F.col("l_suppkey").alias("o3"),
            F.col("l_extendedprice").alias("o4"),
            F.concat(F.lit("prod_"), F.col("l_partkey").cast("string")).alias("product_id"),
            F.col("p_name").alias("product_name"),
            F.col("l_linenumber").alias("quantity"),
            price.alias("unit_price"),
        ).alias("line"),
        (F.col("l_linenumber") * price).alias("_amount"),
    )
    return lines.groupBy("l_orderkey").agg(
        F.transform(
            F.array_sort(F.collect_list("line")),
            lambda s: F.struct(s["product_id"].alias("product_id"), s["product_name"].alias("product_name"),
                               s["quantity"].alias("quantity"), s["unit_price"].alias("unit_price")),
        ).alias("_items"),
        F.sum("_amount").cast("decimal(38,2)").alias("_sum"),
    )


def order_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Driver ``orders`` (all of them) → raw order copies with ``_items`` as a struct array."""
    orders = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")
    items = order_item_arrays(spark, sf_dir)
    o = F.col("o_orderkey")
    joined = orders.join(items, orders.o_orderkey == items.l_orderkey, "left")
    has_items = F.col("_items").isNotNull()
    total = (F.when(o % 5 == 0, (F.coalesce(F.col("_sum"), F.lit(0)) + F.lit(1.5).cast("decimal(2,1)")).cast("double"))
             .when(~has_items, F.lit(25.0))
             .otherwise(F.col("_sum").cast("double")))
    base = joined.select(
        o.alias("_k"),
        F.concat(F.lit("ord_"), o.cast("string")).alias("order_id"),
        _user_id(F.col("o_custkey")).alias("user_id"),
        F.coalesce(F.col("_items"), F.array().cast(items.schema["_items"].dataType)).alias("_items"),
        total.alias("total_amount"),
        F.when(o % 4 == 0, F.lit("EUR")).otherwise(F.lit("USD")).alias("currency"),
        F.when(F.col("o_orderstatus") == "O", F.lit("pending"))
        .when(F.col("o_orderstatus") == "F", F.lit("confirmed"))
        .when(F.col("o_orderstatus") == "P", F.lit("shipped")).alias("status"),
        F.when(o % 7 == 0, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("addr_"), F.col("o_custkey").cast("string"))).alias("shipping_address"),
        F.col("o_orderdate").alias("_created"),
        F.explode(_copies([(None, BASE), (o % 30 == 6, RETRY)])).alias("_copy"),
    )
    return base.filter(F.col("_copy").isNotNull()).select(
        "_k", "_copy", "order_id", "user_id", "_items", "total_amount", "currency", "status", "shipping_address",
        F.when(F.col("_copy") == RETRY, F.col("_created") + F.make_dt_interval(secs=F.lit(1)))
        .otherwise(F.col("_created")).alias("created_at"),
    )


def bronze_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw orders table: ``items`` is JSON text of an array of item objects."""
    return order_copies(spark, sf_dir).select(
        "order_id", "user_id", F.to_json("_items").alias("items"), "total_amount", "currency", "status",
        "shipping_address", "created_at")


# ---------------------------------------------------------------- topic records

def _iso(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")


def _as_served(copies: DataFrame) -> DataFrame:
    """Lay records out the way a multi-partition topic is read: spread by source key and copy,
    not held in the one task that scanned a single-file table.  All shuffle partitions are kept:
    the validation that follows is CPU-bound, so coalescing by bytes would leave cores idle.
    Done before the message text is built, so that work is spread too."""
    return copies.repartition(int(copies.sparkSession.conf.get("spark.sql.shuffle.partitions")), "_k", "_copy")


def event_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw events as topic records (``topic, partition, offset, timestamp, value``).

    The message carries ``metadata`` verbatim, so an event whose metadata is not JSON
    becomes an undecodable message; a NULL id is simply absent from the message.
    """
    ev = _as_served(event_copies(spark, sf_dir))
    head = F.to_json(F.struct(
        "event_id", "event_type", "user_id", "session_id", "page", "referrer",
        _iso(F.col("timestamp")).alias("timestamp"),
    ))
    value = F.concat(F.expr("substring(_head, 1, length(_head) - 1)"), F.lit(',"metadata":'),
                     F.col("metadata"), F.lit("}"))
    return ev.withColumn("_head", head).select(
        F.lit(EVENTS_TOPIC).alias("topic"),
        (F.col("_k") % TOPIC_PARTITIONS).cast("int").alias("partition"),
        (F.col("_k") * 8 + F.col("_copy")).alias("offset"),
        F.col("timestamp").cast("timestamp").alias("timestamp"),
        value.alias("value"),
    )


def order_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw orders as topic records; ``items`` is a real JSON array in the message."""
    od = _as_served(order_copies(spark, sf_dir))
    # A producer bug on a few orders: a zero total, which ingest must dead-letter.
    total = F.when(F.col("_k") % 101 == ZERO_TOTAL_REMAINDER, F.lit(0.0)).otherwise(F.col("total_amount"))
    value = F.to_json(F.struct(
        "order_id", "user_id", F.col("_items").alias("items"), total.alias("total_amount"), "currency", "status",
        "shipping_address", _iso(F.col("created_at")).alias("created_at"),
    ))
    return od.select(
        F.lit(ORDERS_TOPIC).alias("topic"),
        (F.col("_k") % TOPIC_PARTITIONS).cast("int").alias("partition"),
        (F.col("_k") * 2 + F.col("_copy")).alias("offset"),
        F.col("created_at").cast("timestamp").alias("timestamp"),
        value.alias("value"),
    )


def topic_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both topics in one frame, as a subscription to both would deliver them."""
    return event_messages(spark, sf_dir).unionByName(order_messages(spark, sf_dir))
