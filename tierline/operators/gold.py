"""Aggregate tier: daily KPIs per (date, event type) and a per-customer profile.

Design for scale:

* ``daily_kpis`` scans the events once: the per-date page-view / purchase counts are
  derived from the small (date × type) aggregate with a window over ``event_date`` instead
  of a second scan and a join.
* ``customer_360`` scans events and orders once each and shuffles them **once**: both
  sides are projected to a common row shape, unioned, and reduced by a single
  ``groupBy(user_id)`` whose partial (map-side) aggregate absorbs hot users.  The
  reference's three aggregates, distinct union and three left joins collapse into it.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierline.functions.columns import (
    EVENT_TYPES,
    FAILED_STATUS,
    as_of_ts,
    round_half_up,
    safe_ratio,
)

AsOf = datetime | date | str


# ---------------------------------------------------------------- daily KPIs

def daily_active_users_by_type(clean_events: DataFrame) -> DataFrame:
    """Per (date, type): exact distinct users and event count."""
    return (clean_events
            .groupBy(F.to_date("event_timestamp").alias("event_date"), "event_type")
            .agg(F.count_distinct("user_id").alias("daily_active_users"),
                 F.count(F.lit(1)).alias("total_events")))


def daily_conversion_from(by_type: DataFrame) -> DataFrame:
    """Per date: page-view and purchase event counts, from the (date × type) aggregate."""
    return (by_type.groupBy("event_date")
            .agg(F.sum(F.when(F.col("event_type") == "page_view", F.col("total_events")).otherwise(0))
                 .cast("long").alias("total_page_views"),
                 F.sum(F.when(F.col("event_type") == "purchase", F.col("total_events")).otherwise(0))
                 .cast("long").alias("total_purchases")))


def daily_conversion(clean_events: DataFrame) -> DataFrame:
    return daily_conversion_from(daily_active_users_by_type(clean_events))


def daily_kpis(clean_events: DataFrame) -> DataFrame:
    """Per (date, type): distinct users, events, and the date's purchase / page-view ratio
    rounded to 4 places (NULL on a date without page views, and for a NULL date, which an
    equi-join would not match)."""
    by_type = daily_active_users_by_type(clean_events)
    per_date = Window.partitionBy("event_date")
    views = F.sum(F.when(F.col("event_type") == "page_view", F.col("total_events")).otherwise(0)).over(per_date)
    buys = F.sum(F.when(F.col("event_type") == "purchase", F.col("total_events")).otherwise(0)).over(per_date)
    rate = F.when(F.col("event_date").isNotNull(), round_half_up(safe_ratio(buys, views), 4))
    return by_type.select(
        "event_date",
        "event_type",
        F.col("daily_active_users").cast("long").alias("daily_active_users"),
        F.col("total_events").cast("long").alias("total_events"),
        rate.alias("conversion_rate"),
    )


# ---------------------------------------------------------------- customer 360

def event_rows(clean_events: DataFrame) -> DataFrame:
    """Refined events in the row shape that events and orders share in the profile."""
    return clean_events.select(
        "user_id",
        F.col("event_timestamp").alias("seen_at"),
        "event_type",
        F.lit(1).alias("is_event"),
        F.lit(None).cast("string").alias("order_id"),
        F.lit(None).cast("string").alias("status"),
        F.lit(None).cast("decimal(18,2)").alias("total_amount"),
    )


def order_rows(validated_orders: DataFrame) -> DataFrame:
    """Refined orders in the same row shape."""
    return validated_orders.select(
        "user_id",
        F.lit(None).cast("timestamp_ntz").alias("seen_at"),
        F.lit(None).cast("string").alias("event_type"),
        F.lit(0).alias("is_event"),
        "order_id",
        "status",
        F.col("total_amount").cast("decimal(18,2)").alias("total_amount"),
    )


def count_columns(sign: Column | None = None) -> list[Column]:
    """The sums of a customer's state; with a ``sign`` column each row counts that often (a
    retracted row -1).

    Order counts use rows with an ``order_id``: refined order ids are unique and non-NULL, so this
    equals the distinct count without an extra expand/shuffle.
    """
    one = F.lit(1) if sign is None else sign
    ordered = F.col("order_id").isNotNull()
    valid = ordered & (F.col("status") != F.lit(FAILED_STATUS))
    number = lambda when: F.sum(F.when(when, one).otherwise(0)).cast("long")
    spent = F.col("total_amount") if sign is None else (F.col("total_amount") * sign)
    return [
        number(F.col("is_event") == 1).alias("n_events"),
        number(ordered).alias("n_orders"),
        number(valid).alias("n_valid"),
        F.sum(F.when(F.col("status") != F.lit(FAILED_STATUS), spent).otherwise(F.lit(0).cast("decimal(18,2)")))
        .cast("decimal(38,2)").alias("spend"),
    ] + [number(F.col("event_type") == t).alias(f"n_{t}") for t in EVENT_TYPES]


def customer_state(clean_events: DataFrame, validated_orders: DataFrame) -> DataFrame:
    """What the profile needs to know of a user, whatever the day it is read on: one aggregate
    over the union of events and orders, keyed by ``user_id``."""
    return event_rows(clean_events).unionByName(order_rows(validated_orders)).groupBy("user_id").agg(
        F.min("seen_at").alias("first_seen"), F.max("seen_at").alias("last_seen"), *count_columns())


def merge_changes(state: DataFrame, changes: DataFrame, clean_events: DataFrame) -> DataFrame:
    """Customers' states with refined rows added (``sign`` 1) and taken back (``sign`` -1).

    Counts and sums simply add up.  So do first and last times, unless a row that held one was
    taken back and no added row reaches as far: only for those users are they read again from the
    refined events, a first time from the earliest day on that one was lost, a last time up to the
    latest.  ``clean_events`` has its ``event_day`` partition column and holds the changes already."""
    names = [c for c in state.columns if c not in ("user_id", "first_seen", "last_seen")]
    # What a time gains or loses on the whole: a row added and taken back since is nothing.
    times = (changes.filter((F.col("is_event") == 1) & F.col("seen_at").isNotNull())
             .groupBy("user_id", "seen_at").agg(F.sum("sign").alias("n")).filter("n <> 0"))
    plus, minus = (F.when(when, F.col("seen_at")) for when in (F.col("n") > 0, F.col("n") < 0))
    moved = times.groupBy("user_id").agg(F.min(plus).alias("plus_first"), F.max(plus).alias("plus_last"),
                                         F.min(minus).alias("minus_first"), F.max(minus).alias("minus_last"))
    again = _seen_again(state, moved, clean_events)

    shape = state.select("user_id", "first_seen", "last_seen", *names)
    none = F.lit(None).cast("timestamp_ntz")
    zeros = [F.lit(0).cast(state.schema[c].dataType).alias(c) for c in names]
    sums = changes.groupBy("user_id").agg(*count_columns(F.col("sign")))
    parts = (shape.select("*", F.lit(0).alias("source"))
             .unionByName(sums.select("user_id", none.alias("first_seen"), none.alias("last_seen"), *names, F.lit(1).alias("source")))
             .unionByName(moved.select("user_id", F.col("plus_first").alias("first_seen"), F.col("plus_last").alias("last_seen"),
                                       *zeros, F.lit(1).alias("source"))))
    for source, found in enumerate(again, 2):  # users whose first (2) or last (3) time was read again
        parts = parts.unionByName(found.select("user_id", F.col("seen_at").alias("first_seen"), F.col("seen_at").alias("last_seen"),
                                               *zeros, F.lit(source).alias("source")))
    of = lambda c, *sources: F.when(F.col("source").isin(*sources), F.col(c))
    lost = lambda source: F.max(F.col("source") == source)
    return (parts.groupBy("user_id").agg(
        F.when(lost(2), F.min(of("first_seen", 2))).otherwise(F.min(of("first_seen", 0, 1))).alias("first_seen"),
        F.when(lost(3), F.max(of("last_seen", 3))).otherwise(F.max(of("last_seen", 0, 1))).alias("last_seen"),
        *[F.sum(c).cast(state.schema[c].dataType).alias(c) for c in names])
        .filter((F.col("n_events") != 0) | (F.col("n_orders") != 0)))


def _seen_again(state: DataFrame, moved: DataFrame, clean_events: DataFrame) -> list[DataFrame]:
    """(user_id, seen_at) of the users that lost their first time, and of those that lost their
    last: the time they have now, NULL without events.  Empty when no user lost one."""
    known = state.select("user_id", "first_seen", "last_seen").withColumnRenamed("user_id", "of_user")
    held = known.join(moved, known["of_user"].eqNullSafe(moved["user_id"]))
    none = F.lit(False)
    held = held.select(
        "user_id", "minus_first", "minus_last",
        F.coalesce((F.col("minus_first") <= F.col("first_seen"))
                   & F.coalesce(F.col("plus_first") > F.col("minus_first"), F.lit(True)), none).alias("lost_first"),
        F.coalesce((F.col("minus_last") >= F.col("last_seen"))
                   & F.coalesce(F.col("plus_last") < F.col("minus_last"), F.lit(True)), none).alias("lost_last"),
    ).filter("lost_first OR lost_last")
    since, until = held.agg(F.min(F.when(F.col("lost_first"), F.to_date("minus_first"))),
                            F.max(F.when(F.col("lost_last"), F.to_date("minus_last")))).first()
    if since is None and until is None:
        return []
    events = clean_events.select(F.col("user_id").alias("of_user"), "event_timestamp", "event_day")

    def seen(users, days, best):
        users = users.select("user_id")
        mine = events.filter(days).join(users, events["of_user"].eqNullSafe(users["user_id"]), "left_semi")
        return (mine.select(F.col("of_user").alias("user_id"), F.col("event_timestamp").alias("seen_at"))
                .unionByName(users.select("user_id", F.lit(None).cast("timestamp_ntz").alias("seen_at")))
                .groupBy("user_id").agg(best("seen_at").alias("seen_at")))

    day = F.col("event_day")
    return [seen(held.filter("lost_first"), day >= F.lit(since), F.min),
            seen(held.filter("lost_last"), day <= F.lit(until), F.max)]


def _most_common(types=EVENT_TYPES) -> Column:
    """Type with the highest count; ties go to the alphabetically first type.  ``greatest``
    over (count, reverse-alphabetical rank, type) structs: native and code-generated."""
    alpha = sorted(types)
    return F.greatest(*[F.struct(F.col(f"n_{t}").alias("n"), F.lit(len(alpha) - alpha.index(t)).alias("r"),
                                 F.lit(t).alias("t")) for t in types])["t"]


def customer_360(clean_events: DataFrame, validated_orders: DataFrame, as_of: AsOf) -> DataFrame:
    """Per user (events ∪ orders): first/last seen, recency in days, order counts, valid spend,
    average valid order value (2 places, 0 without valid orders), most common event type and
    event count.  Order-only users keep NULL event fields."""
    return profile(customer_state(clean_events, validated_orders), as_of)


def profile(state: DataFrame, as_of: AsOf) -> DataFrame:
    """``customer_360`` of the customers' states, as of a day."""
    has_events = F.col("n_events") > 0
    null_user = F.col("user_id").isNull()
    # A NULL user id never matches a join key: its row carries no metrics, as in a left join.
    ev_field = lambda c: F.when(has_events & ~null_user, c)
    n_orders = F.when(null_user, F.lit(0)).otherwise(F.col("n_orders")).cast("long")
    n_valid = F.when(null_user, F.lit(0)).otherwise(F.col("n_valid")).cast("long")
    spend = F.when(null_user, F.lit(0)).otherwise(F.coalesce(F.col("spend"), F.lit(0))).cast("decimal(38,2)")
    aov = F.when(n_valid > 0, round_half_up(spend.cast("double") / n_valid.cast("double"), 2)).otherwise(F.lit(0.0))
    return state.select(
        "user_id",
        ev_field(F.col("first_seen")).alias("first_seen"),
        ev_field(F.col("last_seen")).alias("last_seen"),
        ev_field(F.datediff(as_of_ts(as_of), F.col("last_seen"))).cast("long").alias("days_since_last_activity"),
        n_orders.alias("total_orders"),
        n_valid.alias("valid_orders"),
        spend.alias("total_spend"),
        aov.alias("avg_order_value"),
        ev_field(_most_common()).alias("most_common_event_type"),
        ev_field(F.col("n_events")).alias("total_events"),
    )


def customer_events(clean_events: DataFrame) -> DataFrame:
    """Per user: first/last event time and event count."""
    return (clean_events.groupBy("user_id")
            .agg(F.min("event_timestamp").alias("first_seen"),
                 F.max("event_timestamp").alias("last_seen"),
                 F.count(F.lit(1)).alias("total_events")))


def top_event_type(clean_events: DataFrame) -> DataFrame:
    """Per user: the most frequent event type, ties to the alphabetically first.

    Counts per (user, type) first — a small aggregate even for a user with a third of all
    rows — then picks the best type per user with ``min_by`` on (-count, type).
    """
    per_type = clean_events.groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("n"))
    return per_type.groupBy("user_id").agg(
        F.min_by("event_type", F.struct((-F.col("n")).alias("neg"), F.col("event_type").alias("t")))
        .alias("event_type"))


def customer_orders(validated_orders: DataFrame) -> DataFrame:
    """Per user: distinct orders, distinct valid orders, valid spend."""
    valid = F.col("status") != F.lit(FAILED_STATUS)
    return validated_orders.groupBy("user_id").agg(
        F.count_distinct("order_id").alias("total_orders"),
        F.count_distinct(F.when(valid, F.col("order_id"))).alias("valid_orders"),
        F.sum(F.when(valid, F.col("total_amount")).otherwise(F.lit(0).cast("decimal(18,2)")))
        .cast("decimal(38,2)").alias("total_spend"),
    )


def all_users(clean_events: DataFrame, validated_orders: DataFrame) -> DataFrame:
    """Distinct union of user ids seen in events or orders."""
    return clean_events.select("user_id").unionByName(validated_orders.select("user_id")).distinct()


def customer_recency(clean_events: DataFrame, as_of: AsOf) -> DataFrame:
    """Per user with events: calendar days from the last event to ``as_of``."""
    return (clean_events.groupBy("user_id")
            .agg(F.max("event_timestamp").alias("last_seen"))
            .select("user_id", "last_seen",
                    F.datediff(as_of_ts(as_of), F.col("last_seen")).cast("long")
                    .alias("days_since_last_activity")))
