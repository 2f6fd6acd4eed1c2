"""The reports as SQL text over the tier tables (the SQL-API form).

Tables are bound per query (``spark.sql(text, args, clean_events=df, ...)`` fills the
``{clean_events}`` placeholders), so nothing is registered in the session catalog.  Values
are bound with named markers (``:date_from``), never pasted into the text, and the anomaly
metric expression comes from a fixed allow-list.  Catalyst plans these like the DataFrame
versions in ``tierline.operators.reports``; the two forms are tested against each other.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession

from tierline.functions.segments import MISSING_RECENCY_DAYS, SEGMENT_RULES
from tierline.operators.reports import ANOMALY_Z, FUNNEL_STEPS

VIEWS = ("clean_events", "validate_orders", "bronze_orders", "daily_kpis", "customer_360")

_EXACT_MEAN = ("CAST(SUM(CAST({c} AS DECIMAL(38,10))) AS DOUBLE) / "
               "CAST(NULLIF(COUNT({c}), 0) AS DOUBLE)")


def _round(expr: str, n: int) -> str:
    return f"CAST(ROUND(CAST({expr} AS DECIMAL(38,10)), {n}) AS DOUBLE)"


def _segment_case() -> str:
    branches = []
    for name, days, spend, orders in SEGMENT_RULES:
        cond = [f"days_since_last_activity <= {days}"]
        if spend is not None:
            cond.append(f"total_spend > {spend}")
        if orders is not None:
            cond.append(f"valid_orders >= {orders}")
        branches.append(f"WHEN {' AND '.join(cond)} THEN '{name}'")
    return "CASE " + " ".join(branches) + " ELSE 'Dormant' END"


_METRICS = {
    "dau": "CAST(SUM(daily_active_users) AS DOUBLE)",
    "conversion": _EXACT_MEAN.format(c="conversion_rate"),
    "events": "CAST(SUM(total_events) AS DOUBLE)",
    "daily_active_users": "CAST(SUM(CAST(CAST(daily_active_users AS DOUBLE) AS DECIMAL(38,10))) AS DOUBLE)",
    "total_events": "CAST(SUM(CAST(CAST(total_events AS DOUBLE) AS DECIMAL(38,10))) AS DOUBLE)",
    "conversion_rate": "CAST(SUM(CAST(CAST(conversion_rate AS DOUBLE) AS DECIMAL(38,10))) AS DOUBLE)",
}

SQL = {
    "dau": f"""
        SELECT event_date,
               CAST(SUM(daily_active_users) AS BIGINT) AS active_users,
               CAST(SUM(total_events) AS BIGINT) AS total_events,
               {_EXACT_MEAN.format(c="conversion_rate")} AS avg_conversion_rate
        FROM {{daily_kpis}}
        WHERE event_date BETWEEN :date_from AND :date_to
        GROUP BY event_date
        ORDER BY event_date NULLS LAST""",
    "top_products": """
        SELECT product_id, product_name,
               COALESCE(
                   CAST(CASE WHEN COUNT(revenue) = COUNT(TRY_CAST(revenue AS DECIMAL(38,10)))
                             THEN TRY_SUM(TRY_CAST(revenue AS DECIMAL(38,10))) END AS DOUBLE),
                   SUM(revenue)) AS total_revenue,
               COUNT(DISTINCT order_id) AS order_count
        FROM (SELECT b.order_id, it.product_id, it.product_name,
                     TRY_CAST(ROUND(TRY_CAST(it.quantity AS DECIMAL(38,6)), 0) AS INT)
                         * TRY_CAST(it.unit_price AS DOUBLE) AS revenue
              FROM {bronze_orders} b
              LEFT SEMI JOIN (SELECT order_id FROM {validate_orders} WHERE status != 'validation_failed') o
                ON b.order_id = o.order_id
              LATERAL VIEW explode(from_json(b.items, 'array<string>')) e AS item
              LATERAL VIEW inline(array(from_json(e.item,
                  'struct<product_id:string,product_name:string,quantity:string,unit_price:string>'))) it)
        GROUP BY product_id, product_name
        ORDER BY total_revenue DESC NULLS LAST, product_id ASC NULLS LAST, product_name ASC NULLS LAST
        LIMIT :n""",
    "segments": f"""
        SELECT segment_name, COUNT(*) AS user_count,
               {_round("CAST(SUM(spend) AS DOUBLE) / CAST(COUNT(spend) AS DOUBLE)", 2)} AS avg_spend,
               CAST({_round("CAST(SUM(days) AS DOUBLE) / CAST(COUNT(days) AS DOUBLE)", 0)} AS INT)
                   AS avg_recency_days
        FROM (SELECT {_segment_case()} AS segment_name,
                     CAST(COALESCE(total_spend, 0) AS DECIMAL(38,2)) AS spend,
                     COALESCE(days_since_last_activity, {MISSING_RECENCY_DAYS}) AS days
              FROM {{customer_360}})
        GROUP BY segment_name
        ORDER BY segment_name NULLS LAST""",
    "funnel": f"""
        WITH steps AS (SELECT * FROM VALUES {", ".join(f"({i}, '{s}')" for i, s in enumerate(FUNNEL_STEPS))}
                           AS s(at, step_name)),
             span AS (SELECT event_type, user_id FROM {{clean_events}}
                      WHERE event_timestamp >= CAST(:date_from AS TIMESTAMP_NTZ)
                        AND event_timestamp < CAST(:date_to AS TIMESTAMP_NTZ) + INTERVAL 1 DAY)
        SELECT s.step_name, COUNT(DISTINCT e.user_id) AS users, COUNT(*) AS count
        FROM span e JOIN steps s ON e.event_type = s.step_name
        GROUP BY s.at, s.step_name
        ORDER BY s.at""",
}


def anomaly_sql(metric: str) -> str:
    if metric not in _METRICS:
        raise ValueError(f"unknown metric {metric!r}")
    # One row a day is left when the window runs, so its single partition is small.
    return f"""
        SELECT :metric AS metric, date, value,
               IF(spread > 0, {_round("(value - centre) / spread", 3)}, 0.0) AS z_score,
               COALESCE(spread > 0 AND ABS((value - centre) / spread) > {ANOMALY_Z}, FALSE) AS is_anomaly
        FROM (SELECT event_date AS date, {_METRICS[metric]} AS value,
                     AVG({_METRICS[metric]}) OVER () AS centre,
                     COALESCE(STDDEV_SAMP({_METRICS[metric]}) OVER (), 0.0) AS spread
              FROM {{daily_kpis}}
              WHERE event_date >= date_sub(:as_of, :lookback)
              GROUP BY event_date)
        ORDER BY date NULLS LAST"""


# Tables each report reads.
NEEDS = {
    "dau": ("daily_kpis",),
    "top_products": ("validate_orders", "bronze_orders"),
    "segments": ("customer_360",),
    "funnel": ("clean_events",),
    "anomaly": ("daily_kpis",),
}


def _d(value) -> date:
    if isinstance(value, datetime):
        return value.date()
    return value if isinstance(value, date) else date.fromisoformat(str(value))


def report(spark: SparkSession, name: str, tables: dict[str, DataFrame], **params) -> DataFrame:
    """Run one report over ``tables`` (tier name → DataFrame) with bound parameters."""
    if name not in NEEDS:
        raise ValueError(f"unknown report {name!r}")
    unknown = set(tables) - set(VIEWS)
    if unknown:
        raise ValueError(f"unknown tables {sorted(unknown)}")
    frames = {t: tables[t] for t in NEEDS[name]}
    if name == "dau":
        args = {"date_from": _d(params["date_from"]), "date_to": _d(params["date_to"])}
        return spark.sql(SQL["dau"], args, **frames)
    if name == "top_products":
        return spark.sql(SQL["top_products"], {"n": int(params.get("n", 10))}, **frames)
    if name == "segments":
        return spark.sql(SQL["segments"], None, **frames)
    if name == "funnel":
        args = {"date_from": _d(params["date_from"]), "date_to": _d(params["date_to"])}
        return spark.sql(SQL["funnel"], args, **frames)
    metric = params.get("metric", "dau")
    args = {"as_of": _d(params["as_of"]), "lookback": int(params.get("lookback_days", 30)), "metric": metric}
    return spark.sql(anomaly_sql(metric), args, **frames)
