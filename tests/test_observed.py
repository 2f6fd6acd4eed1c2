"""Quality counts and batch statistics taken while the tables are written."""

import pytest
from pyspark.sql import functions as F

from tests.helpers import bronze_events, bronze_orders, ev, item, items, od
from tierline.operators import quality
from tierline.operators.dedup import latest_per_key, repeats
from tierline.plans import landing, refresh
from tierline.plans.refresh import run_refresh
from tierline.sources import fixtures as fx
from tierline.sources.tables import TierStore
from tierline.streaming import ingest

SF = "/root/testdata/sf0.001"


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def land(store, spark, events, orders):
    day = F.lit("2024-01-31").cast("date").alias("ingest_date")
    store.land(bronze_events(spark, events).select("*", day), "events", "r", 0)
    store.land(bronze_orders(spark, orders).select("*", day), "orders", "r", 0)


def test_full_refresh_counts_while_it_writes(spark, tmp_dir, monkeypatch):
    store = TierStore(tmp_dir, buckets=4)
    store.bootstrap(spark)
    land(store, spark, [ev("e1"), ev("e1", when="2024-01-30 11:00:00"), ev("e2", event_type="hover"), ev(None)],
         [od("o1", items(item()), 10.0), od("o2", items(item()), 99.0)])
    reread = quality.silver_quality
    monkeypatch.setattr(quality, "silver_quality", lambda *a: pytest.fail("the refined tables are read again"))
    result = run_refresh(spark, store, "2024-01-31", steps=("silver", "quality"))
    clean, orders = (store.read(spark, "silver", t) for t in ("clean_events", "validate_orders"))
    assert rows(result.quality) == rows(reread(clean, orders))
    assert result.quality.count() == 6 and clean.count() == 1


def test_empty_tables_count_nothing(spark, tmp_dir):
    store = TierStore(tmp_dir, buckets=4)
    store.bootstrap(spark)
    result = run_refresh(spark, store, "2024-01-31", steps=("silver", "quality"))
    assert [r.violations for r in result.quality.collect()] == [0] * 6


def test_violations_are_counted_and_gated(spark, tmp_dir, monkeypatch):
    """A model that breaks its rules is caught by what the write counts."""
    store = TierStore(tmp_dir, buckets=4)
    store.bootstrap(spark)
    land(store, spark, [ev("e1"), ev("e2")], [od("o1", items(item()), 10.0)])
    model = refresh.inc.MODELS[0]
    broken = type(model)(**{**model.__dict__, "refine": lambda raw, as_of: model.refine(raw, as_of).withColumn("event_type", F.lit("hover"))})
    monkeypatch.setattr(refresh.inc, "MODELS", (broken, refresh.inc.MODELS[1]))
    with pytest.raises(ValueError, match="event_type_accepted=2"):
        run_refresh(spark, store, "2024-01-31", steps=("silver", "quality"))


def test_check_for_repeated_ids_reuses_the_order_of_the_dedup(spark):
    raw = bronze_events(spark, [ev("e1"), ev("e1", when="2024-01-30 11:00:00"), ev("e2")])
    spec = (["event_id"], "timestamp", ("event_type", "user_id"))
    plain = latest_per_key(raw, *spec)
    checked = plain.withColumn("again", repeats(*spec))
    plans = [df._jdf.queryExecution().executedPlan().toString() for df in (plain, checked)]
    assert plans[0].count("Exchange") == plans[1].count("Exchange") == 1
    assert plans[0].count("Sort [") == plans[1].count("Sort [")
    assert [r.again for r in checked.collect()] == [False, False]
    assert sorted(r.again for r in raw.select(repeats(*spec).alias("again")).collect()) == [False, False, True]


def test_stats_of_a_batch_equal_its_rows(spark, tmp_dir):
    store = TierStore(tmp_dir)
    store.bootstrap(spark)
    messages = fx.topic_messages(spark, SF)
    ingest.write_batch(messages, 0, store, "run")
    decoded = ingest.decode(messages)
    want = []
    for df, source, ts in ((ingest.validate_events(decoded), "bronze.events", "timestamp"),
                           (ingest.validate_orders_raw(decoded), "bronze.orders", "created_at")):
        good = F.size("errors") == 0
        want.append((source, df.filter(good).count(), df.filter(~good).count(), df.filter(good).agg(F.max(ts)).first()[0]))
    assert rows(store.read(spark, "bronze", "ingest_stats")) == want
    ingest.write_batch(messages, 0, store, "run")  # a replay replaces them
    assert rows(store.read(spark, "bronze", "ingest_stats")) == want


def test_batch_without_messages_has_stats(spark, tmp_dir):
    store = TierStore(tmp_dir)
    store.bootstrap(spark)
    only_orders = fx.topic_messages(spark, SF).filter(F.col("topic") == fx.ORDERS_TOPIC)
    ingest.write_batch(only_orders, 0, store, "run")
    stats = {r.source_name: r for r in store.read(spark, "bronze", "ingest_stats").collect()}
    assert stats["bronze.events"][1:] == (0, 0, None) and stats["bronze.orders"].rows > 0


def test_registered_queries_agree_with_the_rereading_ones(spark):
    from tierline.plans.catalog import QUERIES

    assert rows(QUERIES["silver_quality_observed"](spark, SF)) == rows(QUERIES["silver_quality"](spark, SF))
    stats = {r.source_name: r for r in landing.observed_stats(spark, SF).collect()}
    fresh = {r.source_name: r for r in QUERIES["source_freshness"](spark, SF).collect()}
    assert stats.keys() == fresh.keys()
