"""The reports as SQL table functions: ``SELECT * FROM report_dau(DATE '2024-01-01', DATE '2024-01-31')``.

``register`` binds them, for the session, to views over the given tier tables.  Each is one SQL query with
parameters, which the optimizer inlines: a date range reaches the scan as it does in the other forms, and the top
products are a top-n.  The parameter rules are those of the envelopes and raise when the query runs over rows.
The rows have no order of their own; add ``ORDER BY``.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from tierline.operators.envelopes import LOOKBACK_DEFAULT, LOOKBACK_MAX, LOOKBACK_MIN, TOP_N_DEFAULT, TOP_N_MAX, TOP_N_MIN
from tierline.operators.sql_reports import _METRICS, NEEDS, SQL, anomaly_sql

#: Parameters and rows of the functions.
SHAPES = {
    "dau": ("date_from DATE, date_to DATE",
            "event_date DATE, active_users BIGINT, total_events BIGINT, avg_conversion_rate DOUBLE"),
    "top_products": (f"n INT DEFAULT {TOP_N_DEFAULT}",
                     "product_id STRING, product_name STRING, total_revenue DOUBLE, order_count BIGINT"),
    "segments": ("", "segment_name STRING, user_count BIGINT, avg_spend DOUBLE, avg_recency_days INT"),
    "funnel": ("date_from DATE, date_to DATE", "step_name STRING, users BIGINT, count BIGINT"),
    "anomaly": (f"metric STRING, as_of DATE, lookback INT DEFAULT {LOOKBACK_DEFAULT}",
                "metric STRING, date DATE, value DOUBLE, z_score DOUBLE, is_anomaly BOOLEAN"),
}


def _checked(function: str) -> dict[str, str]:
    """The parameters as expressions that raise where a rule is broken.  Of good literals the optimizer
    leaves the literal, so filters on them are pushed down as ever."""
    def keep(name: str, holds: str, kind: str, message: str) -> str:
        return f"IF({holds.format(p=f'{function}.{name}')}, {function}.{name}, CAST(raise_error('{message}') AS {kind}))"

    known = ", ".join(f"'{m}'" for m in _METRICS)
    return {
        "date_from": keep("date_from", "{p} IS NOT NULL", "DATE", "date_from is required"),
        "date_to": keep("date_to", "{p} IS NOT NULL", "DATE", "date_to is required"),
        "as_of": keep("as_of", "{p} IS NOT NULL", "DATE", "as_of is required"),
        "n": keep("n", f"{{p}} BETWEEN {TOP_N_MIN} AND {TOP_N_MAX}", "INT", f"n must be in [{TOP_N_MIN}, {TOP_N_MAX}]"),
        "lookback": keep("lookback", f"{{p}} BETWEEN {LOOKBACK_MIN} AND {LOOKBACK_MAX}", "INT",
                         f"lookback must be in [{LOOKBACK_MIN}, {LOOKBACK_MAX}]"),
        "metric": keep("metric", f"{{p}} IN ({known})", "STRING", "unknown metric"),
    }


def _body(name: str, function: str) -> str:
    """The report's query, without an order, with the function's parameters in the place of its markers."""
    if name == "anomaly":
        # Every metric is a query of its own; all but the asked one have a false filter and the optimizer drops them.
        one = lambda m: re.sub(r"ORDER BY date NULLS LAST", "", anomaly_sql(m)).replace("WHERE ", f"WHERE :metric = '{m}' AND ")
        text = " UNION ALL ".join(f"SELECT * FROM ({one(m)})" for m in _METRICS)
    elif name == "top_products":
        rows, order = re.split(r"ORDER BY", SQL[name].replace("LIMIT :n", ""))
        text = (f"SELECT product_id, product_name, total_revenue, order_count FROM (SELECT *, row_number() OVER (ORDER BY {order}) "
                f"AS place FROM ({rows})) WHERE place <= :n")
    else:
        text = re.sub(r"ORDER BY [\w. ]+$", "", SQL[name])
    values = _checked(function)
    return re.sub(r"(?<!\w):(\w+)", lambda marker: values[marker[1]], text)


def register(spark: SparkSession, tables: dict[str, DataFrame], prefix: str = "report_") -> list[str]:
    """Create the session's table functions over the tier tables that are given; their names."""
    made = []
    for name, (parameters, rows) in SHAPES.items():
        if not set(NEEDS[name]) <= set(tables):
            continue
        function = f"{prefix}{name}"
        views = {t: f"{function}_{t}" for t in NEEDS[name]}
        for table, view in views.items():
            tables[table].createOrReplaceTempView(view)
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {function}({parameters}) RETURNS TABLE ({rows}) "
                  f"RETURN {_body(name, function).format(**views)}")
        made.append(function)
    return made
