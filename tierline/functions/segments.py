"""Customer segment label from recency, spend and valid order count."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference's: segment names and their thresholds, in the
# order the rules are tried (first match wins; NULL recency falls through to the last).
CHAMPIONS, LOYAL, RECENT, GOOD, AT_RISK, DORMANT = (
    "Champions", "Loyal", "Recent", "Good", "At Risk", "Dormant")
# Champions: active within 7 days and spend above 500.  Loyal: within 7 days and at least 3
# valid orders.  Recent: within 14 days.  Good: within 30 days and spend above 200.
# At Risk: within 60 days.  Dormant: everything else.
SEGMENT_RULES = (
    (CHAMPIONS, 7, 500, None),
    (LOYAL, 7, None, 3),
    (RECENT, 14, None, None),
    (GOOD, 30, 200, None),
    (AT_RISK, 60, None, None),
)
# Fixed value: recency assumed for users without events when averaging recency.
MISSING_RECENCY_DAYS = 999


def segment_label(days: str = "days_since_last_activity", spend: str = "total_spend",
                  valid_orders: str = "valid_orders") -> Column:
    expr = None
    for name, max_days, min_spend, min_orders in SEGMENT_RULES:
        cond = F.col(days) <= max_days
        if min_spend is not None:
            cond = cond & (F.col(spend) > min_spend)
        if min_orders is not None:
            cond = cond & (F.col(valid_orders) >= min_orders)
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return expr.otherwise(F.lit(DORMANT))
