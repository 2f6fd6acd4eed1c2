"""Exact distinct users that merge: one bitmap a day and event type over dense user numbers.

A user's number is given once and kept.  ``bitmap_construct_agg`` sets the bits of a day's users in
fixed 4 KB pieces of 32,768 numbers; any set of days is an OR of their pieces
(``bitmap_or_agg``), counted exactly, so a report over a range reads no event again.  A day costs at most one piece
for each 32,768 users, whatever the number of events.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tierline.operators.reports import FUNNEL_STEPS, _to_date

#: Users numbered together; parts of about this size are ranked in one task each.
PART_USERS = 1 << 16


def number_users(users: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """(user_id, number) of the distinct non-NULL users that ``known`` does not have, numbered on from its
    highest (from 1): a rank inside a hash part plus the sizes of the parts before it, so that no task
    sorts all users."""
    fresh = users.select("user_id").filter(F.col("user_id").isNotNull()).distinct()
    first = 0
    if known is not None:
        fresh = fresh.join(known, "user_id", "left_anti")
        first = known.agg(F.max("number")).first()[0] or 0
    parts = max(1, -(-fresh.count() // PART_USERS))
    placed = fresh.withColumn("part", F.pmod(F.xxhash64("user_id"), F.lit(parts)))
    before = F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    starts = placed.groupBy("part").agg(F.count(F.lit(1)).alias("n")).select("part", F.coalesce(before, F.lit(0)).alias("start"))
    rank = F.row_number().over(Window.partitionBy("part").orderBy("user_id"))
    return (placed.withColumn("rank", rank).join(starts, "part")
            .select("user_id", (F.lit(first) + F.col("start") + F.col("rank")).cast("long").alias("number")))


def user_bitmaps(clean_events: DataFrame, numbers: DataFrame) -> DataFrame:
    """(event_date, event_type, piece, users) of the days' users.  A hot user is one row a task
    before any shuffle."""
    seen = (clean_events.filter(F.col("user_id").isNotNull())
            .select(F.to_date("event_timestamp").alias("event_date"), "event_type", "user_id").distinct()
            .join(numbers, "user_id"))
    return (seen.groupBy("event_date", "event_type", F.bitmap_bucket_number("number").alias("piece"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("users")))


def _counted(bitmaps: DataFrame, *by: str) -> DataFrame:
    """Distinct users by the given columns: pieces of equal numbers ORed, their bits counted."""
    pieces = bitmaps.groupBy(*by, "piece").agg(F.bitmap_or_agg("users").alias("users"))
    return pieces.groupBy(*by).agg(F.sum(F.bitmap_count("users")).alias("users"))


def range_users(bitmaps: DataFrame, date_from, date_to) -> DataFrame:
    """Distinct users of each event type, and of any type (NULL), in the inclusive range of days."""
    days = bitmaps.filter(F.col("event_date").between(_to_date(date_from), _to_date(date_to)))
    any_type = _counted(days.withColumn("event_type", F.lit(None).cast("string")), "event_type")
    return _counted(days, "event_type").unionByName(any_type).select("event_type", F.col("users").cast("long").alias("users"))


def rolling_users(bitmaps: DataFrame, days: int = 7) -> DataFrame:
    """For every day with events: distinct users of it and the ``days`` - 1 days before it (of any type).
    Each day's pieces are merged over the types first, and then lent to the days that look back on it."""
    daily = (bitmaps.filter(F.col("event_date").isNotNull()).groupBy("event_date", "piece")
             .agg(F.bitmap_or_agg("users").alias("users")))
    dates = daily.select(F.col("event_date").alias("on_date")).distinct()
    lent = daily.select(F.explode(F.sequence("event_date", F.date_add("event_date", days - 1))).alias("on_date"), "piece", "users")
    return (_counted(lent, "on_date").join(dates, "on_date", "left_semi")
            .select(F.col("on_date").alias("event_date"), F.lit(days).alias("days"), F.col("users").cast("long").alias("users")))


def report_funnel(bitmaps: DataFrame, daily_kpis: DataFrame, date_from, date_to) -> DataFrame:
    """``reports.report_funnel`` from the bitmaps and the daily KPIs, without reading an event."""
    inside = lambda df: df.filter(F.col("event_date").between(_to_date(date_from), _to_date(date_to))
                                  & F.col("event_type").isin(*FUNNEL_STEPS))
    users = _counted(inside(bitmaps), "event_type")
    counts = inside(daily_kpis).groupBy("event_type").agg(F.sum("total_events").alias("count"))
    order = F.array_position(F.array(*[F.lit(s) for s in FUNNEL_STEPS]), F.col("step_name"))
    return (counts.join(users, "event_type", "left")
            .select(F.col("event_type").alias("step_name"), F.coalesce("users", F.lit(0)).cast("long").alias("users"),
                    F.col("count").cast("long").alias("count")).orderBy(order.asc_nulls_last()))
