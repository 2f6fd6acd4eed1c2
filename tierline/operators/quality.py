"""Data-quality checks between tiers: source freshness and the refined-tier gate."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierline.functions.columns import EVENT_TYPES, FAILED_STATUS, as_of_ts

# Fixed value that must equal the reference's: a raw table is stale (warn, never fail)
# when its newest row is more than one hour older than the run instant.
WARN_AFTER_SECONDS = 3600
# The status rule compares the declared total as it came with the item total (less than one
# cent apart); the refined table holds the declared total rounded to cents.  Rounding moves a
# valid total to one cent from the item total at most.
ROUNDED_TOLERANCE = Decimal("0.01")


def _freshness(df: DataFrame, source: str, ts_col: str, as_of) -> DataFrame:
    latest = F.max(F.col(ts_col))
    age = (F.unix_micros(as_of_ts(as_of).cast("timestamp")) - F.unix_micros(latest.cast("timestamp"))) / 1_000_000
    return df.agg(
        F.lit(source).alias("source_name"),
        latest.alias("latest_at"),
        age.cast("double").alias("age_seconds"),
        F.when(latest.isNull() | (age > WARN_AFTER_SECONDS), F.lit("warn")).otherwise(F.lit("pass")).alias("status"),
    )


def source_freshness(bronze_events: DataFrame, bronze_orders: DataFrame, as_of) -> DataFrame:
    """One row per raw table: newest row time, its age at ``as_of`` and ``pass``/``warn``.

    Each is a global max — a map-side partial max and one tiny final step."""
    return _freshness(bronze_events, "bronze.events", "timestamp", as_of).unionByName(
        _freshness(bronze_orders, "bronze.orders", "created_at", as_of))


def event_rules() -> dict[str, Column]:
    """Violations of the rules that look at one refined event at a time."""
    return {
        "event_id_not_null": F.count_if(F.col("event_id").isNull()),
        "event_type_accepted": F.count_if(~F.col("event_type").isin(*EVENT_TYPES) | F.col("event_type").isNull()),
    }


def order_rules() -> dict[str, Column]:
    """Violations of the rules that look at one refined order at a time."""
    return {
        "order_id_not_null": F.count_if(F.col("order_id").isNull()),
        "total_matches_items": F.count_if(
            (F.coalesce(F.col("status"), F.lit("")) != F.lit(FAILED_STATUS))
            & ~F.coalesce(F.abs(F.col("total_amount") - F.col("validated_total")) <= ROUNDED_TOLERANCE, F.lit(False))),
    }


#: The rules of each refined table that can be counted while it is written.
ROW_RULES = {"clean_events": event_rules, "validate_orders": order_rules}
UNIQUE_RULE = {"clean_events": "event_id_unique", "validate_orders": "order_id_unique"}


def counted_report(spark: SparkSession, counts: dict[str, dict[str, int]]) -> DataFrame:
    """The rows of :func:`silver_quality` from violations counted elsewhere, by refined table and rule."""
    rows = [(f"silver.{table}", rule, n) for table, own in counts.items() for rule, n in own.items()]
    return spark.createDataFrame(rows, "table_name string, rule string, violations long")


def _violations(df: DataFrame, table: str, rules: dict) -> DataFrame:
    counts = df.agg(*[expr.cast("long").alias(name) for name, expr in rules.items()])
    stack = ", ".join(f"'{name}', `{name}`" for name in rules)
    return counts.selectExpr(f"stack({len(rules)}, {stack}) as (rule, violations)").select(
        F.lit(table).alias("table_name"), "rule", "violations")


def silver_quality(clean_events: DataFrame, validated_orders: DataFrame) -> DataFrame:
    """Rows ``(table_name, rule, violations)`` for the invariants the refined models imply:
    ids unique and non-NULL, event types in the closed set, and every order not marked failed
    has a declared total that matches its item total."""
    ev = _violations(clean_events, "silver.clean_events", {
        "event_id_unique": F.count("event_id") - F.count_distinct("event_id"),
        **event_rules(),
    })
    od = _violations(validated_orders, "silver.validate_orders", {
        "order_id_unique": F.count("order_id") - F.count_distinct("order_id"),
        **order_rules(),
    })
    return ev.unionByName(od)


def assert_quality(report: DataFrame) -> None:
    """Gate: raise when any rule is violated (collects only the rule rows, a handful)."""
    bad = [r for r in report.filter(F.col("violations") > 0).collect()]
    if bad:
        raise ValueError("quality gate failed: " + ", ".join(f"{r.table_name}.{r.rule}={r.violations}" for r in bad))
