"""Small column expressions shared by the tiers."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference's: the closed set of event types, in the
# order the reference declares them.
EVENT_TYPES = ("page_view", "click", "purchase", "signup", "error")
# Fixed value: the status that marks an order whose total does not match its items.
FAILED_STATUS = "validation_failed"
# Fixed value: totals agree when they differ by less than one cent.
TOTAL_TOLERANCE = 0.01


def as_col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_of_ts(as_of: datetime | date | str) -> Column:
    """The run's reference instant as a naive-UTC timestamp literal."""
    if isinstance(as_of, datetime):
        text = as_of.strftime("%Y-%m-%d %H:%M:%S.%f")
    elif isinstance(as_of, date):
        text = as_of.isoformat() + " 00:00:00"
    else:
        text = str(as_of)
    return F.lit(text).cast("timestamp_ntz")


def as_of_date(as_of: datetime | date | str) -> Column:
    return F.to_date(as_of_ts(as_of))


def round_half_up(c: str | Column, scale: int) -> Column:
    """ROUND through a fixed decimal, then back to DOUBLE.

    Rounding a DOUBLE directly breaks ties differently across engines (1.005 is stored just
    below the tie); going through DECIMAL(38,10) rounds the decimal value half-up in every
    engine, so reports agree to the last digit.
    """
    return F.round(as_col(c).cast("decimal(38,10)"), scale).cast("double")


def safe_ratio(num: str | Column, den: str | Column) -> Column:
    """``num / NULLIF(den, 0)`` in DOUBLE; NULL (not an error) on a zero denominator."""
    return as_col(num).cast("double") / F.nullif(as_col(den), F.lit(0)).cast("double")


def surrogate_key(c: str | Column) -> Column:
    """MD5 hex of the business key (identical hex in Spark and SQL engines)."""
    return F.md5(as_col(c))
