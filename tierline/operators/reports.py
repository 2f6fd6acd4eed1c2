"""Parameterised reports over the refined and aggregate tiers.

Averages and revenues are accumulated in DECIMAL and divided once in DOUBLE, so a report
does not depend on the order in which partitions are summed: two runs on differently
partitioned data (or two engines) give the same bits.
"""

from __future__ import annotations

from datetime import date, datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierline.functions.columns import FAILED_STATUS, as_col, as_of_date, round_half_up
from tierline.functions.items import raw_items, to_int_lax
from tierline.functions.segments import MISSING_RECENCY_DAYS, segment_label
from tierline.operators.silver import dedup_latest_orders

# Fixed values that must equal the reference's: funnel steps in funnel order, and the
# z-score threshold for an anomaly.
FUNNEL_STEPS = ("page_view", "click", "purchase")
ANOMALY_Z = 2.0
# Fixed value: named metrics of the anomaly report; any other name must be a numeric column
# of the daily KPI table and is summed as DOUBLE.
NAMED_METRICS = ("dau", "conversion", "events")
KPI_NUMERIC_COLUMNS = ("daily_active_users", "total_events", "conversion_rate")

# Exact accumulators: rates (at most 4 places upstream), money and revenues.
RATE = "decimal(38,10)"
REVENUE = "decimal(38,10)"
MONEY_SUM = "decimal(38,2)"


def exact_sum(c: str | Column, dtype: str = RATE) -> Column:
    return F.sum(as_col(c).cast(dtype))


def exact_mean(c: str | Column, dtype: str = RATE) -> Column:
    """AVG that ignores NULLs, accumulated exactly; NULL when there is no value."""
    return exact_sum(c, dtype).cast("double") / F.nullif(F.count(as_col(c)), F.lit(0)).cast("double")


def _to_date(d: date | datetime | str) -> Column:
    text = d.isoformat()[:10] if isinstance(d, (date, datetime)) else str(d)
    return F.lit(text).cast("date")


# ---------------------------------------------------------------- R1

def report_dau(daily_kpis: DataFrame, date_from, date_to) -> DataFrame:
    """Per date in the inclusive range: summed per-type active users (a user active in three
    types counts three times, as documented upstream), summed events, mean conversion."""
    return (daily_kpis
            .filter(F.col("event_date").between(_to_date(date_from), _to_date(date_to)))
            .groupBy("event_date")
            .agg(F.sum("daily_active_users").cast("long").alias("active_users"),
                 F.sum("total_events").cast("long").alias("total_events"),
                 exact_mean("conversion_rate").alias("avg_conversion_rate"))
            .orderBy(F.col("event_date").asc_nulls_last()))


# ---------------------------------------------------------------- R2

def revenue_sum(revenue: Column) -> Column:
    """SUM of DOUBLE revenues: exact to ten places, so it does not depend on the order of the
    rows; in plain DOUBLE where that many digits do not fit."""
    return F.coalesce(
        F.when(F.count(revenue) == F.count(revenue.try_cast(REVENUE)), F.try_sum(revenue.try_cast(REVENUE))).cast("double"),
        F.sum(revenue))


def report_top_products(validated_orders: DataFrame, bronze_orders: DataFrame, n: int = 10,
                        dedupe_items: bool = False) -> DataFrame:
    """Top ``n`` products by revenue over orders whose status is not failed.

    Items come from the raw orders joined on ``order_id``; with ``dedupe_items=False`` every
    raw copy of a redelivered order counts (as the reference does), ``True`` keeps only the
    copy the refined table was built from.  Ties on revenue go to the smaller product id.
    """
    good = validated_orders.filter(F.col("status") != F.lit(FAILED_STATUS)).select("order_id")
    raw = dedup_latest_orders(bronze_orders) if dedupe_items else bronze_orders
    raw = raw.select("order_id", "items")
    # Refined order ids are unique, so keeping the raw rows of valid orders is a semi join.
    items = (raw.join(good, "order_id", "left_semi")
             .select("order_id", F.explode(raw_items("items")).alias("it")))
    revenue = to_int_lax(F.col("it.quantity")) * F.col("it.unit_price").try_cast("double")
    return (items
            .groupBy(F.col("it.product_id").alias("product_id"), F.col("it.product_name").alias("product_name"))
            .agg(revenue_sum(revenue).alias("total_revenue"),
                 F.count_distinct("order_id").alias("order_count"))
            .orderBy(F.col("total_revenue").desc_nulls_last(), F.col("product_id").asc_nulls_last(),
                     F.col("product_name").asc_nulls_last())
            .limit(n))


# ---------------------------------------------------------------- R3

def user_segments(customer_360: DataFrame) -> DataFrame:
    """Per user: the segment label (first matching rule)."""
    return customer_360.select("user_id", "days_since_last_activity", "total_spend", "valid_orders",
                               segment_label().alias("segment_name"))


def report_user_segments(customer_360: DataFrame) -> DataFrame:
    """Per segment: users, mean spend (2 places), mean recency (missing → 999, whole days)."""
    return (customer_360
            .select(segment_label().alias("segment_name"),
                    F.coalesce(F.col("total_spend"), F.lit(0)).alias("_spend"),
                    F.coalesce(F.col("days_since_last_activity"), F.lit(MISSING_RECENCY_DAYS)).alias("_days"))
            .groupBy("segment_name")
            .agg(F.count(F.lit(1)).alias("user_count"),
                 round_half_up(exact_mean("_spend", MONEY_SUM), 2).alias("avg_spend"),
                 round_half_up(exact_mean("_days", "long"), 0).cast("int").alias("avg_recency_days"))
            .orderBy(F.col("segment_name").asc_nulls_last()))


# ---------------------------------------------------------------- R4

def report_funnel(clean_events: DataFrame, date_from, date_to) -> DataFrame:
    """Per funnel step (page_view, click, purchase) in ``[date_from, date_to + 1 day)``:
    distinct users and events.  Steps are counted independently; an absent step has no row."""
    start = _to_date(date_from).cast("timestamp_ntz")
    end = F.date_add(_to_date(date_to), 1).cast("timestamp_ntz")
    step_order = F.array_position(F.array(*[F.lit(s) for s in FUNNEL_STEPS]), F.col("step_name"))
    return (clean_events
            .filter((F.col("event_timestamp") >= start) & (F.col("event_timestamp") < end)
                    & F.col("event_type").isin(*FUNNEL_STEPS))
            .groupBy(F.col("event_type").alias("step_name"))
            .agg(F.count_distinct("user_id").alias("users"), F.count(F.lit(1)).alias("count"))
            .orderBy(step_order.asc_nulls_last()))


# ---------------------------------------------------------------- R5

def metric_value(metric: str) -> Column:
    """Daily value of an anomaly metric over the KPI rows of one date."""
    if metric == "dau":
        return F.sum("daily_active_users").cast("double")
    if metric == "conversion":
        return exact_mean("conversion_rate")
    if metric == "events":
        return F.sum("total_events").cast("double")
    if metric in KPI_NUMERIC_COLUMNS:
        return exact_sum(F.col(metric).cast("double")).cast("double")
    raise ValueError(f"unknown metric {metric!r}; use one of {NAMED_METRICS + KPI_NUMERIC_COLUMNS}")


def daily_metric(daily_kpis: DataFrame, metric: str, lookback_days: int, as_of) -> DataFrame:
    since = F.date_sub(as_of_date(as_of), int(lookback_days))
    return (daily_kpis.filter(F.col("event_date") >= since)
            .groupBy(F.col("event_date").alias("date"))
            .agg(metric_value(metric).alias("value")))


def report_anomaly(daily_kpis: DataFrame, metric: str = "dau", lookback_days: int = 30,
                   as_of=None) -> DataFrame:
    """Per date since ``as_of - lookback_days``: the metric, its z-score against the mean and
    sample standard deviation of the whole window (3 places) and ``|z| > 2`` as anomaly.

    Both statistics come from one scalar subquery over the (one row per date) daily series,
    so no join is planned at all; the series' exchange is reused by the subquery.
    """
    as_of = as_of or datetime.now(timezone.utc).replace(tzinfo=None)
    daily = daily_metric(daily_kpis, metric, lookback_days, as_of)
    stats = daily.select(F.struct(F.avg("value").alias("mean"),
                                  F.coalesce(F.stddev_samp("value"), F.lit(0.0)).alias("std"))).scalar()
    mean, std = stats["mean"], stats["std"]
    z = (F.col("value") - mean) / std
    return daily.select(
        F.lit(metric).alias("metric"),
        "date",
        "value",
        F.when(std > 0, round_half_up(z, 3)).otherwise(F.lit(0.0)).alias("z_score"),
        F.when((std > 0) & (F.abs(z) > ANOMALY_Z), F.lit(True)).otherwise(F.lit(False)).alias("is_anomaly"),
    ).orderBy(F.col("date").asc_nulls_last())

