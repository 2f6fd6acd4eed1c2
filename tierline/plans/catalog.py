"""Registered queries: name → ``(spark, sf_dir) -> DataFrame``.

Each query starts from the driver tables under ``sf_dir`` (through the adapters in
``tierline.sources.fixtures``), so its work grows with the data; nothing reads a fixed
in-memory input.  Parameters are fixed per query and cover the whole data range.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierline.operators import bitmaps, envelopes, gold, quality, reports, silver, sql_functions, sql_reports, variants
from tierline.plans import order_lines
from tierline.plans.incremental import read_commit
from tierline.plans.landing import (compacted_events, observed_quality, observed_stats, refreshed_store, replayed_letters,
                                    replayed_records)
from tierline.schemas import BRONZE_EVENTS
from tierline.sources import fixtures as fx
from tierline.sources import topic_log
from tierline.sources.topics import to_topic_records
from tierline.streaming import ingest

AS_OF = fx.FIXTURE_AS_OF
# Report parameters: the full span of the fixture data (events are 2023-10-23 .. 2024-01-30).
RANGE_FROM, RANGE_TO = "2023-10-01", "2024-01-31"
TOP_N = 10
LOOKBACK_DAYS = 30
ROLLING_DAYS = 7
COLUMN_METRIC = "conversion_rate"

Query = Callable[[SparkSession, str], DataFrame]


# ---------------------------------------------------------------- tier builders

def _bronze_events(s, d):
    return fx.bronze_events(s, d)


def _bronze_orders(s, d):
    return fx.bronze_orders(s, d)


def _clean(s, d):
    return silver.clean_events(_bronze_events(s, d), AS_OF)


def _orders(s, d):
    return silver.validate_orders(_bronze_orders(s, d), AS_OF)


def _kpis(s, d):
    return gold.daily_kpis(_clean(s, d))


def _c360(s, d):
    return gold.customer_360(_clean(s, d), _orders(s, d), AS_OF)


def _decoded(s, d):
    return ingest.decode(fx.topic_messages(s, d))


def _errors_text(df: DataFrame) -> DataFrame:
    return df.select("topic", "partition", "offset", F.array_join("errors", "; ").alias("errors"))


def _tables(s, d):
    """The tier frames, derived from the driver tables, that the SQL-text reports read."""
    clean, orders = _clean(s, d), _orders(s, d)
    return {"clean_events": clean, "validate_orders": orders, "bronze_orders": _bronze_orders(s, d),
            "daily_kpis": gold.daily_kpis(clean), "customer_360": gold.customer_360(clean, orders, AS_OF)}


def _from_function(name: str, arguments: str):
    """All rows of a report's table function over the tier frames."""
    def run(s, d):
        prefix = f"report_{hashlib.md5(d.encode()).hexdigest()[:8]}_"
        needed = sql_reports.NEEDS[name]
        sql_functions.register(s, {t: df for t, df in _tables(s, d).items() if t in needed}, prefix)
        return s.sql(f"SELECT * FROM {prefix}{name}({arguments})")
    return run


def _read_back(records: DataFrame) -> DataFrame:
    """Topic records with the fields of their JSON value read back, and how many it has."""
    fields = [F.get_json_object("value", f"$.{c}").alias(c) for c in BRONZE_EVENTS.names if c != "timestamp"]
    time = F.get_json_object("value", "$.timestamp").cast("timestamp_ntz").alias("timestamp")
    return records.select("topic", "key", *fields, time, F.size(F.json_object_keys("value")).alias("n_fields"))


def _maintained(tier, table):
    """A table of a store that three landed batches and incremental refreshes have filled."""
    return lambda s, d: refreshed_store(s, d).read(s, tier, table)


def _bitmaps(s, d):
    return refreshed_store(s, d).read(s, "gold", "user_bitmaps")


def _products_bucketed(dedupe_items):
    def run(s, d):
        store = refreshed_store(s, d)
        lines, states = order_lines.read(s, store, read_commit(s, store))
        return order_lines.report_top_products(lines, states, TOP_N, dedupe_items)
    return run


def _anomaly(metric):
    return lambda s, d: reports.report_anomaly(_kpis(s, d), metric, LOOKBACK_DAYS, AS_OF)


# ---------------------------------------------------------------- registry

QUERIES: dict[str, Query] = {
    # ingest (batch form of the streaming micro-batch logic)
    "validate_events": lambda s, d: _errors_text(ingest.validate_events(_decoded(s, d))),
    "validate_orders_raw": lambda s, d: _errors_text(ingest.validate_orders_raw(_decoded(s, d))),
    "stream_ingest_events": lambda s, d: ingest.good_events(ingest.validate_events(_decoded(s, d))),
    "stream_ingest_orders": lambda s, d: ingest.good_orders(ingest.validate_orders_raw(_decoded(s, d))),
    "ingest_dead_letter": lambda s, d: _errors_text(ingest.dead_letters(_decoded(s, d))),
    "dead_letter_replay": replayed_letters,
    "ingest_defaults": lambda s, d: (ingest.validate_events(_decoded(s, d))
                                     .filter((F.size("errors") == 0) & (F.size("defaults") > 0))
                                     .select("topic", "partition", "offset", "event_id",
                                             F.array_join("defaults", ",").alias("defaults"))),
    "topic_log_records": lambda s, d: topic_log.summary(replayed_records(s, d)),
    "to_topic_records": lambda s, d: _read_back(to_topic_records(
        _bronze_events(s, d), fx.EVENTS_TOPIC, key="event_id", json_columns=("metadata",))),
    # refined events
    "dedup_latest_events": lambda s, d: silver.dedup_latest_events(_bronze_events(s, d)),
    "events_metadata_valid": lambda s, d: silver.events_metadata_valid(_bronze_events(s, d)),
    "clean_events": _clean,
    # refined orders
    "dedup_latest_orders": lambda s, d: silver.dedup_latest_orders(_bronze_orders(s, d)),
    "order_items_exploded": lambda s, d: silver.order_items_exploded(_bronze_orders(s, d)),
    "order_item_totals": lambda s, d: silver.order_item_totals(_bronze_orders(s, d)),
    "order_item_totals_grouped": lambda s, d: silver.item_totals_grouped(_bronze_orders(s, d)),
    "order_validation_status": lambda s, d: silver.order_validation_status(_bronze_orders(s, d), AS_OF),
    "validate_orders": _orders,
    # daily KPIs
    "daily_active_users_by_type": lambda s, d: gold.daily_active_users_by_type(_clean(s, d)),
    "daily_conversion": lambda s, d: gold.daily_conversion(_clean(s, d)),
    "daily_kpis": _kpis,
    # customer profile
    "customer_events": lambda s, d: gold.customer_events(_clean(s, d)),
    "top_event_type": lambda s, d: gold.top_event_type(_clean(s, d)),
    "customer_orders": lambda s, d: gold.customer_orders(_orders(s, d)),
    "all_users": lambda s, d: gold.all_users(_clean(s, d), _orders(s, d)),
    "customer_recency": lambda s, d: gold.customer_recency(_clean(s, d), AS_OF),
    "customer_360": _c360,
    # reports
    "report_dau": lambda s, d: reports.report_dau(_kpis(s, d), RANGE_FROM, RANGE_TO),
    "report_top_products": lambda s, d: reports.report_top_products(_orders(s, d), _bronze_orders(s, d), TOP_N),
    "report_top_products_deduped": lambda s, d: reports.report_top_products(
        _orders(s, d), _bronze_orders(s, d), TOP_N, dedupe_items=True),
    "user_segments": lambda s, d: reports.user_segments(_c360(s, d)),
    "report_user_segments": lambda s, d: reports.report_user_segments(_c360(s, d)),
    "report_funnel": lambda s, d: reports.report_funnel(_clean(s, d), RANGE_FROM, RANGE_TO),
    "report_anomaly_dau": _anomaly("dau"),
    "report_anomaly_conversion": _anomaly("conversion"),
    "report_anomaly_events": _anomaly("events"),
    "report_anomaly_column": _anomaly(COLUMN_METRIC),
    # the same reports as SQL text over registered views, parameters bound by markers
    "report_dau_sql": lambda s, d: sql_reports.report(s, "dau", _tables(s, d), date_from=RANGE_FROM,
                                                      date_to=RANGE_TO),
    "report_top_products_sql": lambda s, d: sql_reports.report(s, "top_products", _tables(s, d), n=TOP_N),
    "report_user_segments_sql": lambda s, d: sql_reports.report(s, "segments", _tables(s, d)),
    "report_funnel_sql": lambda s, d: sql_reports.report(s, "funnel", _tables(s, d), date_from=RANGE_FROM,
                                                         date_to=RANGE_TO),
    "report_anomaly_events_sql": lambda s, d: sql_reports.report(s, "anomaly", _tables(s, d), metric="events",
                                                                 lookback_days=LOOKBACK_DAYS, as_of=AS_OF),
    # and as SQL table functions
    "report_dau_function": _from_function("dau", f"DATE '{RANGE_FROM}', DATE '{RANGE_TO}'"),
    "report_top_products_function": _from_function("top_products", f"{TOP_N}"),
    "report_user_segments_function": _from_function("segments", ""),
    "report_funnel_function": _from_function("funnel", f"DATE '{RANGE_FROM}', DATE '{RANGE_TO}'"),
    "report_anomaly_events_function": _from_function("anomaly", f"'events', DATE '{AS_OF}', {LOOKBACK_DAYS}"),
    # envelopes, as flat rows (place in the envelope, row, totals and parameters)
    "envelope_dau": lambda s, d: envelopes.flat(envelopes.envelope_dau(
        reports.report_dau(_kpis(s, d), RANGE_FROM, RANGE_TO), RANGE_FROM, RANGE_TO), "data"),
    "envelope_top_products": lambda s, d: envelopes.flat(envelopes.envelope_top_products(
        reports.report_top_products(_orders(s, d), _bronze_orders(s, d), envelopes.check_top_n(TOP_N))), "products"),
    "envelope_segments": lambda s, d: envelopes.flat(
        envelopes.envelope_segments(reports.report_user_segments(_c360(s, d))), "segments"),
    "envelope_funnel": lambda s, d: envelopes.flat(envelopes.envelope_funnel(
        reports.report_funnel(_clean(s, d), RANGE_FROM, RANGE_TO), RANGE_FROM, RANGE_TO), "funnel"),
    "envelope_anomaly": lambda s, d: envelopes.flat(envelopes.envelope_anomaly(
        reports.report_anomaly(_kpis(s, d), envelopes.check_metric("events"),
                               envelopes.check_lookback(LOOKBACK_DAYS), AS_OF), "events", LOOKBACK_DAYS), "anomalies"),
    # the maintained tables, after incremental refreshes of three landed batches
    "clean_events_incremental": _maintained("silver", "clean_events"),
    "validate_orders_incremental": _maintained("silver", "validate_orders"),
    "daily_kpis_incremental": _maintained("gold", "daily_kpis"),
    "customer_360_incremental": _maintained("gold", "customer_360"),
    # exact distinct users from bitmaps, and the product report from bucketed lines
    "range_users": lambda s, d: bitmaps.range_users(_bitmaps(s, d), RANGE_FROM, RANGE_TO),
    "rolling_users": lambda s, d: bitmaps.rolling_users(_bitmaps(s, d), ROLLING_DAYS),
    "report_funnel_bitmaps": lambda s, d: bitmaps.report_funnel(
        _bitmaps(s, d), refreshed_store(s, d).read(s, "gold", "daily_kpis"), RANGE_FROM, RANGE_TO),
    "report_top_products_bucketed": _products_bucketed(False),
    "report_top_products_deduped_bucketed": _products_bucketed(True),
    # metadata paths of the stored Variant column
    "metadata_variant_paths": lambda s, d: variants.metadata_paths(
        refreshed_store(s, d).read(s, "silver", "event_variants"),
        {"k": ("$.k", "long"), "section": ("$.page.section", "string")}),
    # raw rows after a compaction of finished batches
    "raw_events_compacted": compacted_events,
    # data quality
    "source_freshness": lambda s, d: quality.source_freshness(_bronze_events(s, d), _bronze_orders(s, d), AS_OF),
    "silver_quality": lambda s, d: quality.silver_quality(_clean(s, d), _orders(s, d)),
    # counted while the tables are written
    "silver_quality_observed": observed_quality,
    "ingest_stats_observed": observed_stats,
}
