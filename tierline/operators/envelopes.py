"""Report envelopes (rows + totals + echoed parameters) and the report parameter rules.

An envelope is a one-row DataFrame whose ``rows`` column is an ordered ``array<struct>``.
Reports are small and bounded by their parameters (a date range, ``n <= 100``, six
segments, three funnel steps, ``lookback <= 365`` days), so gathering them into one row is
safe.  Order is carried by a sort key inside the array, not by a window.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierline.operators.reports import FUNNEL_STEPS, KPI_NUMERIC_COLUMNS, NAMED_METRICS

# Fixed values that must equal the reference's parameter rules.
TOP_N_DEFAULT, TOP_N_MIN, TOP_N_MAX = 10, 1, 100
LOOKBACK_DEFAULT, LOOKBACK_MIN, LOOKBACK_MAX = 30, 1, 365
METRIC_DEFAULT = "dau"


# ---------------------------------------------------------------- E6 parameter rules

def check_top_n(n: int | None) -> int:
    n = TOP_N_DEFAULT if n is None else n
    if isinstance(n, bool) or not isinstance(n, int) or not TOP_N_MIN <= n <= TOP_N_MAX:
        raise ValueError(f"n must be an integer in [{TOP_N_MIN}, {TOP_N_MAX}], got {n!r}")
    return n


def check_lookback(days: int | None) -> int:
    days = LOOKBACK_DEFAULT if days is None else days
    if isinstance(days, bool) or not isinstance(days, int) or not LOOKBACK_MIN <= days <= LOOKBACK_MAX:
        raise ValueError(f"lookback must be an integer in [{LOOKBACK_MIN}, {LOOKBACK_MAX}], got {days!r}")
    return days


def check_metric(metric: str | None) -> str:
    metric = METRIC_DEFAULT if metric is None else metric
    if metric not in NAMED_METRICS + KPI_NUMERIC_COLUMNS:
        raise ValueError(f"unknown metric {metric!r}")
    return metric


def check_date(value: date | str | None, name: str) -> date:
    if value is None:
        raise ValueError(f"{name} is required")
    if isinstance(value, datetime):
        return value.date()
    if isinstance(value, date):
        return value
    try:
        return date.fromisoformat(str(value))
    except ValueError as exc:
        raise ValueError(f"{name} must be an ISO date, got {value!r}") from exc


# ---------------------------------------------------------------- envelopes

def _ordered_rows(report: DataFrame, sort_key: Column, fields: list[str]) -> Column:
    packed = F.struct(sort_key.alias("_k"), *[F.col(c) for c in fields])
    return F.transform(F.sort_array(F.collect_list(packed)),
                       lambda s: F.struct(*[s[c].alias(c) for c in fields]))


def flat(envelope: DataFrame, rows: str) -> DataFrame:
    """An envelope as plain rows: each of its rows with its place, and the envelope's totals and
    parameters beside it (those named like a column of the rows get the prefix ``envelope_``)."""
    inner = envelope.schema[rows].dataType.elementType.names
    named = {c: f"envelope_{c}" if c in inner else c for c in envelope.columns if c != rows}
    return (envelope.select(F.posexplode_outer(rows).alias("place", "row"),
                            *[F.col(c).alias(n) for c, n in named.items()])
            .select("place", "row.*", *named.values()))


def envelope_dau(report: DataFrame, date_from, date_to) -> DataFrame:
    fields = ["event_date", "active_users", "total_events", "avg_conversion_rate"]
    return report.agg(
        _ordered_rows(report, F.col("event_date"), fields).alias("data"),
        F.coalesce(F.sum("active_users"), F.lit(0)).cast("long").alias("total_active_users"),
    ).select("data", "total_active_users",
             F.lit(str(check_date(date_from, "date_from"))).cast("date").alias("date_from"),
             F.lit(str(check_date(date_to, "date_to"))).cast("date").alias("date_to"))


def envelope_top_products(report: DataFrame) -> DataFrame:
    fields = ["product_id", "product_name", "total_revenue", "order_count"]
    missing = F.col("total_revenue").isNull()  # last, as in the report
    key = F.struct(missing.alias("n"), (-F.col("total_revenue")).alias("r"), F.col("product_id").isNull().alias("i"),
                   F.col("product_id"), F.col("product_name").isNull().alias("p"), F.col("product_name"))
    return report.agg(
        _ordered_rows(report, key, fields).alias("products"),
        F.count(F.lit(1)).alias("total"),
    )


def envelope_segments(report: DataFrame) -> DataFrame:
    fields = ["segment_name", "user_count", "avg_spend", "avg_recency_days"]
    return report.agg(
        _ordered_rows(report, F.col("segment_name"), fields).alias("segments"),
        F.coalesce(F.sum("user_count"), F.lit(0)).cast("long").alias("total_users"),
    )


def envelope_funnel(report: DataFrame, date_from, date_to) -> DataFrame:
    fields = ["step_name", "users", "count"]
    key = F.array_position(F.array(*[F.lit(s) for s in FUNNEL_STEPS]), F.col("step_name"))
    return report.agg(_ordered_rows(report, key, fields).alias("funnel")).select(
        "funnel",
        F.lit(str(check_date(date_from, "date_from"))).cast("date").alias("date_from"),
        F.lit(str(check_date(date_to, "date_to"))).cast("date").alias("date_to"))


def envelope_anomaly(report: DataFrame, metric: str, lookback_days: int) -> DataFrame:
    fields = ["metric", "date", "value", "z_score", "is_anomaly"]
    return report.agg(
        _ordered_rows(report, F.col("date"), fields).alias("anomalies"),
        F.count_if(F.col("is_anomaly")).cast("long").alias("total_anomalies"),
    ).select("anomalies", F.lit(metric).alias("metric"), F.lit(int(lookback_days)).alias("lookback_days"),
             "total_anomalies")
