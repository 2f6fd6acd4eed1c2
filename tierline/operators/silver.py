"""Refined tier: deduplicated events and orders whose totals are checked against their items."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierline.functions.columns import (
    EVENT_TYPES,
    FAILED_STATUS,
    TOTAL_TOLERANCE,
    as_of_ts,
    surrogate_key,
)
from tierline.functions.items import MONEY, item_total, raw_items, total_of_raw, typed_item_fields
from tierline.operators.dedup import latest_per_key

# Ties on the ordering time are broken by the remaining columns, ascending.
EVENT_TIEBREAK = ("event_type", "user_id", "session_id", "page", "referrer", "metadata")
ORDER_TIEBREAK = ("user_id", "total_amount", "currency", "status", "shipping_address", "items")

AsOf = datetime | date | str


# ---------------------------------------------------------------- events

def dedup_latest_events(bronze_events: DataFrame) -> DataFrame:
    """Raw events without NULL ids, one row per ``event_id`` (latest ``timestamp`` wins)."""
    return latest_per_key(bronze_events.filter(F.col("event_id").isNotNull()),
                          ["event_id"], "timestamp", EVENT_TIEBREAK)


def metadata_json(metadata: str = "metadata"):
    """Metadata text if it parses as JSON, else NULL.  The original text is kept as is."""
    return F.when(F.try_parse_json(F.col(metadata)).isNotNull(), F.col(metadata))


def events_metadata_valid(bronze_events: DataFrame) -> DataFrame:
    """Per deduplicated event: whether its metadata text is JSON, and the kept text."""
    return dedup_latest_events(bronze_events).select(
        "event_id",
        F.try_parse_json(F.col("metadata")).isNotNull().alias("metadata_is_json"),
        metadata_json().alias("metadata_json"),
    )


def clean_events(bronze_events: DataFrame, as_of: AsOf) -> DataFrame:
    """Deduplicate, then keep known event types (a latest row with an unknown type drops its
    id entirely), cast the time, safe-parse metadata, add an MD5 key and the load time."""
    return refine_events(dedup_latest_events(bronze_events), as_of)


def refine_events(deduped: DataFrame, as_of: AsOf) -> DataFrame:
    """``clean_events`` of raw events that are already the latest of their ids."""
    return deduped.filter(F.col("event_type").isin(*EVENT_TYPES)).select(
        surrogate_key("event_id").alias("event_key"),
        "event_id",
        "user_id",
        "session_id",
        "event_type",
        "page",
        "referrer",
        F.col("timestamp").cast("timestamp_ntz").alias("event_timestamp"),
        metadata_json().alias("metadata_json"),
        as_of_ts(as_of).alias("ingested_at"),
    )


# ---------------------------------------------------------------- orders

def dedup_latest_orders(bronze_orders: DataFrame) -> DataFrame:
    """Raw orders without NULL ids, one row per ``order_id`` (latest ``created_at`` wins)."""
    return latest_per_key(bronze_orders.filter(F.col("order_id").isNotNull()),
                          ["order_id"], "created_at", ORDER_TIEBREAK)


def explode_items(orders: DataFrame, *keep: str) -> DataFrame:
    """One row per order item (inner: orders without a JSON array of items give no rows).
    The items array is parsed once per order, then exploded."""
    return orders.select(
        *keep, F.posexplode(raw_items("items")).alias("item_pos", "raw")
    ).select(*keep, "item_pos", typed_item_fields(F.col("raw")).alias("it")).select(
        *keep,
        "item_pos",
        "it.product_id",
        "it.product_name",
        "it.quantity",
        "it.unit_price",
    )


def order_items_exploded(bronze_orders: DataFrame) -> DataFrame:
    """Items of the deduplicated orders with typed fields."""
    return explode_items(dedup_latest_orders(bronze_orders), "order_id")


def order_item_totals(bronze_orders: DataFrame) -> DataFrame:
    """Per deduplicated order that has at least one item: SUM(quantity * unit_price).

    Computed inside each row (no explode, no shuffle); see ``item_totals_grouped`` for the
    explode-and-group form it is tested against.
    """
    return (dedup_latest_orders(bronze_orders)
            .select("order_id", raw_items("items").alias("_raw"))
            .select("order_id", F.size("_raw").alias("_n"), total_of_raw(F.col("_raw")).alias("calculated_total"))
            .filter(F.col("_n") > 0)
            .drop("_n"))


def item_totals_grouped(bronze_orders: DataFrame) -> DataFrame:
    """Reference form of ``order_item_totals``: explode, then group by order id."""
    return (order_items_exploded(bronze_orders)
            .groupBy("order_id")
            .agg(F.sum(F.col("quantity") * F.col("unit_price")).cast("decimal(38,2)").alias("calculated_total")))


def validation_status(total_amount: str, calculated_total, status: str):
    """The order's own status if its totals agree; failed without items, or when a total does
    not fit the refined table's money type."""
    return (F.when(calculated_total.isNull(), F.lit(FAILED_STATUS))
            .when(calculated_total.try_cast(MONEY).isNull() | F.col(total_amount).try_cast(MONEY).isNull(),
                  F.lit(FAILED_STATUS))
            .when(F.abs(F.col(total_amount).cast("double") - calculated_total.cast("double")) < TOTAL_TOLERANCE,
                  F.col(status))
            .otherwise(F.lit(FAILED_STATUS)))


def validate_orders(bronze_orders: DataFrame, as_of: AsOf) -> DataFrame:
    """Deduplicate orders and check each declared total against the sum of its items.

    The item sum is an in-row higher-order aggregate over the parsed JSON array, so the
    model needs one shuffle (the dedup) and no join back to an item-total table.
    """
    return refine_orders(dedup_latest_orders(bronze_orders), as_of)


def refine_orders(deduped: DataFrame, as_of: AsOf) -> DataFrame:
    """``validate_orders`` of raw orders that are already the latest of their ids."""
    calc = F.col("_calc")
    return deduped.withColumn("_calc", item_total("items")).select(
        surrogate_key("order_id").alias("order_key"),
        "order_id",
        "user_id",
        F.col("total_amount").try_cast(MONEY).alias("total_amount"),
        F.coalesce(calc, F.lit(0)).try_cast(MONEY).alias("validated_total"),
        "currency",
        F.col("created_at").cast("timestamp_ntz").alias("created_at"),
        as_of_ts(as_of).alias("validated_at"),
        validation_status("total_amount", calc, "status").alias("status"),
        "shipping_address",
    )


def order_validation_status(bronze_orders: DataFrame, as_of: AsOf) -> DataFrame:
    return validate_orders(bronze_orders, as_of).select("order_id", "status")
