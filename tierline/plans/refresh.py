"""The scheduled refresh: ingest → freshness → refined tier → quality gate → aggregate tier.

Each step writes its tier and the next step reads the written table back, so every tier is
a lineage cut: a lost executor recomputes at most one tier's stages, and reruns with the same
``as_of`` over the same raw data give identical tables.  Steps can be selected on their own
(``steps=("silver",)``), as the reference's tier selection allows.

A full refresh rebuilds the refined tier from all raw rows.  An incremental one (see
``plans.incremental``) reads the raw rows of the batches that landed since the last, and of the current
raw rows only the hash buckets of the same ids; it rewrites only the periods these rows left or entered,
in the refined tables and the daily KPIs.  Rows it does not touch keep the load time they have.  The customer
profile depends on ``as_of`` in every row, so it is read anew each time, from the customers'
states, which an incremental refresh only adds to.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierline.operators import gold, quality, variants
from tierline.plans import incremental as inc
from tierline.plans import order_lines
from tierline.sources.tables import TierStore
from tierline.streaming import ingest

STEPS = ("ingest", "freshness", "silver", "quality", "gold")


@dataclass
class RefreshResult:
    freshness: DataFrame | None = None
    quality: DataFrame | None = None
    written: list[str] = field(default_factory=list)
    days: dict[str, list[date | None]] = field(default_factory=dict)


def run_refresh(spark: SparkSession, store: TierStore, as_of: datetime | str,
                topic_path: str | None = None, checkpoint: str | None = None,
                steps=STEPS, gate: bool = True, bootstrap_servers: str | None = None,
                incremental: bool = False) -> RefreshResult:
    """Run the selected steps in dependency order and return the check results.

    ``ingest`` drains the topic source once (``availableNow``) into the raw tables: Kafka when
    ``bootstrap_servers`` is given, else JSON-lines topic files under ``topic_path``;
    ``checkpoint`` is by default a folder of the store.
    """
    result = RefreshResult()
    store.bootstrap(spark)

    if "ingest" in steps and (topic_path or bootstrap_servers):
        source = ingest.read_topics(spark, "kafka", bootstrap_servers=bootstrap_servers) if bootstrap_servers \
            else ingest.read_topics(spark, "files", topic_path)
        ingest.start_ingest(source, store, checkpoint, available_now=True).awaitTermination()
        result.written += ["bronze.events", "bronze.orders", "bronze.dead_letter"]

    if "freshness" in steps:
        result.freshness = freshness(spark, store, as_of)

    found = None  # violations counted while the refined tables were written
    if "silver" in steps:
        # Statistics land last: a batch without them may still get rows, so it stays new.
        commit = inc.read_commit(spark, store)
        landed = inc.landed_batches(spark, store, commit)
        new = sorted(landed, key=str)
        counted = [b for b in new if "ingest_stats" in landed[b]]
        if incremental and commit.full:
            def note(refined, periods):
                if refined == "clean_events":  # before the rows move, so that a failed run loses no day
                    _set_pending(spark, store, sorted(set(periods) | set(_pending_days(spark, store)), key=str))

            result.days = inc.refine_new(spark, store, as_of, commit, new, counted, note)
        else:
            _note_all_days(spark, store)  # old days, which may be left without rows
            found = inc.refine_all(spark, store, as_of, commit, counted)
            _note_all_days(spark, store)
        result.written += ["silver.clean_events", "silver.validate_orders"]

    clean = store.read(spark, "silver", "clean_events", partitions=True)
    orders = store.read(spark, "silver", "validate_orders", partitions=True)

    if "quality" in steps:
        checked, tested = clean, orders
        if result.days:  # and the days of refinements before, whose aggregates still wait
            days = set(result.days["clean_events"]) | set(_pending_days(spark, store))
            checked = clean.filter(inc.on_periods("event_day", sorted(days, key=str)))
            tested = orders.filter(inc.on_periods("created_month", result.days["validate_orders"]))
        # An id found twice among the raw rows need not be twice in what is refined from them.
        exact = found and not any(found[table][rule] for table, rule in quality.UNIQUE_RULE.items())
        result.quality = quality.counted_report(spark, found) if exact else quality.silver_quality(checked, tested)
        if gate:
            quality.assert_quality(result.quality)

    if "silver" in steps:  # finished only now: what the gate turns away is refined again
        if len(commit.attempts) > order_lines.MAX_ATTEMPTS:
            inc.build_lines(spark, store, commit)
        inc.write_commit(spark, store, commit)
        for model in inc.MODELS:
            if len(store.parts(spark, "silver", model.winners)) > inc.MAX_PARTS:
                inc.compact_winners(spark, store, model, commit.seq)

    if "gold" in steps:
        if incremental:
            days = sorted(_pending_days(spark, store), key=str)
            store.replace_days(gold.daily_kpis(clean.filter(inc.on_periods("event_day", days))), "gold", "daily_kpis", days)
        else:
            store.write(gold.daily_kpis(clean), "gold", "daily_kpis")
        commit = inc.read_commit(spark, store)
        inc.refresh_bitmaps(spark, store, commit, days if incremental and commit.full and commit.seq > commit.full else None)
        if store.variants:
            if incremental:
                store.replace_days(variants.event_variants(clean.filter(inc.on_periods("event_day", days))), "silver", "event_variants", days)
            else:
                store.write(variants.event_variants(clean), "silver", "event_variants")
        state = inc.refresh_customers(spark, store, commit)
        store.write(gold.profile(state, as_of), "gold", "customer_360")
        result.written += ["gold.daily_kpis", "gold.customer_360"]
        _set_pending(spark, store, [])
    return result


# ---------------------------------------------------------------- freshness

def freshness(spark: SparkSession, store: TierStore, as_of) -> DataFrame:
    """Newest record time of the raw tables: from the per-batch statistics, and from a scan of
    those raw rows whose batch has none (rows loaded some other way)."""
    stats = store.read(spark, "bronze", "ingest_stats", partitions=True)
    counted = stats.select(F.col("run").alias("of_run"), F.col("batch_id").alias("of_batch")).distinct()
    tables = []
    for raw, time in (("events", "timestamp"), ("orders", "created_at")):
        rows = store.read(spark, "bronze", raw, partitions=True)
        # Partition columns only; compacted parts hold refined batches, which all have statistics.
        landed = rows.filter(F.col("batch_id").isNull() | (F.col("batch_id") >= 0)).select("run", "batch_id").distinct()
        same = landed["run"].eqNullSafe(counted["of_run"]) & landed["batch_id"].eqNullSafe(counted["of_batch"])
        uncounted = sorted(((r["run"], r["batch_id"]) for r in landed.join(counted, same, "left_anti").collect()), key=str)
        scan = rows.filter(inc.in_batches(uncounted)).select(F.col(time).alias("latest_at"))
        known = stats.filter(F.col("source_name") == f"bronze.{raw}").select("latest_at")
        tables.append(scan.unionByName(known))
    return quality.source_freshness(tables[0].withColumnRenamed("latest_at", "timestamp"),
                                    tables[1].withColumnRenamed("latest_at", "created_at"), as_of)


# ---------------------------------------------------------------- incremental refresh

def new_batches(spark: SparkSession, store: TierStore) -> list[tuple]:
    """(run, batch_id) of landed batches that no refresh has refined yet: of the statistics and of
    the raw tables' own partitions, as rows loaded some other way have no statistics."""
    return sorted(inc.landed_batches(spark, store, inc.read_commit(spark, store)), key=str)


def _pending_days(spark: SparkSession, store: TierStore) -> list:
    return [r["event_date"] for r in store.read(spark, "silver", "pending_days").collect()]


def _note_all_days(spark: SparkSession, store: TierStore) -> None:
    """All days of the refined events are pending until the daily KPIs are next built."""
    days = {r[0] for r in store.read(spark, "silver", "clean_events", partitions=True).select("event_day").distinct().collect()}
    _set_pending(spark, store, sorted(days | set(_pending_days(spark, store)), key=str))


def _set_pending(spark: SparkSession, store: TierStore, days: list) -> None:
    store.write(spark.createDataFrame([(d,) for d in days], "event_date date"), "silver", "pending_days")
