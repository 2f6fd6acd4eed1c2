"""Fixed schemas of the raw, refined and aggregate tables."""

from __future__ import annotations

from pyspark.sql import types as T

from tierline.functions.columns import EVENT_TYPES

S, TS, D = T.StringType(), T.TimestampNTZType(), T.DoubleType()


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


BRONZE_EVENTS = _struct(("event_id", S), ("event_type", S), ("user_id", S), ("session_id", S), ("page", S),
                        ("referrer", S), ("metadata", S), ("timestamp", TS))

BRONZE_ORDERS = _struct(("order_id", S), ("user_id", S), ("items", S), ("total_amount", D), ("currency", S),
                        ("status", S), ("shipping_address", S), ("created_at", TS))

DEAD_LETTER = _struct(("topic", S), ("partition", T.IntegerType()), ("offset", T.LongType()),
                      ("broker_timestamp", T.TimestampType()), ("value", S), ("errors", T.ArrayType(S)))

CLEAN_EVENTS = _struct(("event_key", S), ("event_id", S), ("user_id", S), ("session_id", S), ("event_type", S),
                       ("page", S), ("referrer", S), ("event_timestamp", TS), ("metadata_json", S),
                       ("ingested_at", TS))

VALIDATED_ORDERS = _struct(("order_key", S), ("order_id", S), ("user_id", S), ("total_amount", T.DecimalType(18, 2)),
                           ("validated_total", T.DecimalType(18, 2)), ("currency", S), ("created_at", TS),
                           ("validated_at", TS), ("status", S), ("shipping_address", S))

DAILY_KPIS = _struct(("event_date", T.DateType()), ("event_type", S), ("daily_active_users", T.LongType()),
                     ("total_events", T.LongType()), ("conversion_rate", D))

CUSTOMER_360 = _struct(("user_id", S), ("first_seen", TS), ("last_seen", TS),
                       ("days_since_last_activity", T.LongType()), ("total_orders", T.LongType()),
                       ("valid_orders", T.LongType()), ("total_spend", T.DecimalType(38, 2)),
                       ("avg_order_value", D), ("most_common_event_type", S), ("total_events", T.LongType()))

INGEST_STATS = _struct(("source_name", S), ("rows", T.LongType()), ("dead_letters", T.LongType()),
                      ("latest_at", TS))

# Dead letters that a replay has landed since.
REPLAYED = _struct(("topic", S), ("partition", T.IntegerType()), ("offset", T.LongType()))

# Metadata of refined events, parsed (optional, see ``TierStore.variants``).
EVENT_VARIANTS = _struct(("event_id", S), ("event_type", S), ("event_timestamp", TS), ("metadata_variant", T.VariantType()))

# What compactions of raw tables have finished; see ``plans.compaction``.
RAW_VIEW = _struct(("generation", T.LongType()), ("last_day", T.DateType()), ("run", S), ("mark", T.LongType()))

# What the refreshes have finished: rows (what, run, number); see ``plans.incremental``.
REFINE_COMMITS = _struct(("what", S), ("run", S), ("number", T.LongType()))
# Periods that a refinement is about to rewrite, and days whose KPIs wait for the aggregate tier.
REFINE_INTENT = _struct(("seq", T.LongType()), ("table_name", S), ("period", T.DateType()))
PENDING_DAYS = _struct(("event_date", T.DateType()))

# Refined rows that a refinement added (sign 1) or took back (sign -1), by customer.
USER_CHANGES = _struct(("sign", T.IntegerType()), ("user_id", S), ("seen_at", TS), ("event_type", S),
                       ("is_event", T.IntegerType()), ("order_id", S), ("status", S),
                       ("total_amount", T.DecimalType(18, 2)))
# What the customer profile needs to know of a user, and the last refinement it holds.
CUSTOMER_STATE = _struct(("user_id", S), ("first_seen", TS), ("last_seen", TS), ("n_events", T.LongType()),
                         ("n_orders", T.LongType()), ("n_valid", T.LongType()), ("spend", T.DecimalType(38, 2)),
                         *((f"n_{t}", T.LongType()) for t in EVENT_TYPES), ("through", T.LongType()))

# A number for each user, and the users of a day and event type as bitmaps over these numbers.
USER_NUMBERS = _struct(("user_id", S), ("number", T.LongType()))
USER_BITMAPS = _struct(("event_date", T.DateType()), ("event_type", S), ("piece", T.LongType()), ("users", T.BinaryType()))

TABLES = {
    ("bronze", "ingest_stats"): INGEST_STATS,
    ("bronze", "events"): BRONZE_EVENTS,
    ("bronze", "orders"): BRONZE_ORDERS,
    ("bronze", "dead_letter"): DEAD_LETTER,
    ("bronze", "replayed"): REPLAYED,
    ("silver", "clean_events"): CLEAN_EVENTS,
    ("silver", "validate_orders"): VALIDATED_ORDERS,
    ("silver", "event_winners"): BRONZE_EVENTS,
    ("silver", "order_winners"): BRONZE_ORDERS,
    ("silver", "raw_view"): RAW_VIEW,
    ("silver", "refine_commits"): REFINE_COMMITS,
    ("silver", "refine_intent"): REFINE_INTENT,
    ("silver", "user_changes"): USER_CHANGES,
    ("silver", "pending_days"): PENDING_DAYS,
    ("gold", "daily_kpis"): DAILY_KPIS,
    ("gold", "customer_360"): CUSTOMER_360,
    ("gold", "customer_state"): CUSTOMER_STATE,
    ("silver", "user_numbers"): USER_NUMBERS,
    ("gold", "user_bitmaps"): USER_BITMAPS,
}
#: Tables that a store has only when asked for (Parquet alone stores a Variant).
OPTIONAL = {("silver", "event_variants"): EVENT_VARIANTS}
