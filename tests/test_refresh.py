import json
import os

import pytest

from helpers import ts

from tierline.plans.refresh import run_refresh
from tierline.sources import fixtures as fx
from tierline.sources.tables import TierStore

SF = "/root/testdata/sf0.001"


def _write_topic_files(spark, folder):
    msgs = fx.topic_messages(spark, SF).collect()
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, "part-0.json"), "w") as fh:
        for r in msgs:
            fh.write(json.dumps({"topic": r.topic, "partition": r.partition, "offset": r.offset,
                                 "timestamp": r.timestamp.isoformat() + "Z", "value": r.value}) + "\n")
    return len(msgs)


def _snapshot(spark, store):
    out = {}
    for tier, table in (("silver", "clean_events"), ("silver", "validate_orders"), ("gold", "daily_kpis"),
                        ("gold", "customer_360")):
        rows = store.read(spark, tier, table).collect()
        out[f"{tier}.{table}"] = sorted(map(tuple, rows), key=repr)
    return out


def test_refresh_end_to_end_is_repeatable(spark, tmp_dir, capsys):
    n = _write_topic_files(spark, os.path.join(tmp_dir, "topics"))
    store = TierStore(os.path.join(tmp_dir, "lake"))
    res = run_refresh(spark, store, fx.FIXTURE_AS_OF, topic_path=os.path.join(tmp_dir, "topics"),
                      checkpoint=os.path.join(tmp_dir, "ckpt"))
    raw = store.read(spark, "bronze", "events").count() + store.read(spark, "bronze", "orders").count()
    dead = store.read(spark, "bronze", "dead_letter").count()
    assert raw + dead == n and dead > 0
    assert {r.source_name: r.status for r in res.freshness.collect()} == {"bronze.events": "warn",
                                                                         "bronze.orders": "warn"}
    # freshness from the per-batch statistics equals a scan of the raw tables
    from tierline.operators import quality
    scanned = quality.source_freshness(store.read(spark, "bronze", "events"), store.read(spark, "bronze", "orders"),
                                       fx.FIXTURE_AS_OF)
    assert sorted(map(tuple, res.freshness.collect())) == sorted(map(tuple, scanned.collect()))
    stats = store.read(spark, "bronze", "ingest_stats").groupBy().sum("rows", "dead_letters").collect()[0]
    assert stats[0] == raw and stats[1] == dead
    assert all(r.violations == 0 for r in res.quality.collect())
    first = _snapshot(spark, store)
    assert first["gold.customer_360"] and first["gold.daily_kpis"]
    # second run: the ingest finds nothing new, the tiers are rebuilt to the same contents
    run_refresh(spark, store, fx.FIXTURE_AS_OF, topic_path=os.path.join(tmp_dir, "topics"),
                checkpoint=os.path.join(tmp_dir, "ckpt"))
    assert _snapshot(spark, store) == first
    # a single tier can be rebuilt on its own
    run_refresh(spark, store, fx.FIXTURE_AS_OF, steps=("gold",))
    assert _snapshot(spark, store) == first
    # a time-ranged report pushes its range into the scan of the refined table
    from tierline.operators import reports
    plan = reports.report_funnel(store.read(spark, "silver", "clean_events"), "2024-01-10", "2024-01-12") \
        ._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(event_timestamp), GreaterThanOrEqual(event_timestamp" in plan
    # a date-ranged report prunes the date partitions of the aggregate table
    plan = reports.report_dau(store.read(spark, "gold", "daily_kpis"), "2024-01-10", "2024-01-12") \
        ._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan and "2024-01-10" in plan.split("PartitionFilters")[1]
    # the command line prints the report envelopes the reference's API returned
    from tierline.__main__ import main
    lake = os.path.join(tmp_dir, "lake")
    capsys.readouterr()
    main(["report", "--store", lake, "dau", "--date-from", "2023-10-01", "--date-to", "2024-01-31"])
    dau = json.loads(capsys.readouterr().out)
    kpis = store.read(spark, "gold", "daily_kpis")
    assert dau["total_active_users"] == kpis.groupBy().sum("daily_active_users").collect()[0][0]
    assert dau["date_from"] == "2023-10-01" and len(dau["data"]) == kpis.select("event_date").distinct().count()
    main(["report", "--store", lake, "segments"])
    seg = json.loads(capsys.readouterr().out)
    assert seg["total_users"] == store.read(spark, "gold", "customer_360").count()
    main(["report", "--store", lake, "top-products", "--n", "3"])
    assert json.loads(capsys.readouterr().out)["total"] == 3
    main(["report", "--store", lake, "anomalies", "--metric", "events", "--as-of", fx.FIXTURE_AS_OF])
    an = json.loads(capsys.readouterr().out)
    assert an["metric"] == "events" and an["lookback_days"] == 30 and an["total_anomalies"] >= 1
    with pytest.raises(ValueError):
        main(["report", "--store", lake, "top-products", "--n", "500"])


def test_quality_gate_blocks_bad_silver(spark, tmp_dir):
    from tierline.operators import quality
    store = TierStore(os.path.join(tmp_dir, "lake"))
    store.bootstrap(spark)
    clean = store.read(spark, "silver", "clean_events")
    bad = spark.createDataFrame([("k", "e1", "u", "s", "hover", "/", None, None, None, None),
                                 ("k", "e1", "u", "s", "click", "/", None, None, None, None)], clean.schema)
    report = quality.silver_quality(bad, store.read(spark, "silver", "validate_orders"))
    got = {r.rule: r.violations for r in report.collect()}
    assert got["event_id_unique"] == 1 and got["event_type_accepted"] == 1
    with pytest.raises(ValueError):
        quality.assert_quality(report)


def test_refresh_of_a_fresh_store_without_ingest(spark, tmp_dir):
    store = TierStore(os.path.join(tmp_dir, "fresh"))
    res = run_refresh(spark, store, fx.FIXTURE_AS_OF, steps=("freshness", "silver", "quality", "gold"))
    assert {r.status for r in res.freshness.collect()} == {"warn"}  # no rows yet: stale, never failing
    assert store.read(spark, "gold", "daily_kpis").count() == 0
    assert store.read(spark, "gold", "customer_360").count() == 0


def test_stats_never_hide_raw_rows_without_them(spark, tmp_dir):
    """A row loaded some other way is newer than every batch that has statistics."""
    from helpers import bronze_events, ev
    store = TierStore(os.path.join(tmp_dir, "lake"))
    store.bootstrap(spark)
    from tierline.plans.refresh import freshness
    stats = spark.createDataFrame([("bronze.events", 1, 0, ts("2024-01-01 00:00:00"))],
                                  "source_name string, rows long, dead_letters long, latest_at timestamp_ntz")
    store.land(stats, "ingest_stats", "r", 0)
    from pyspark.sql import functions as F
    day = F.to_date("timestamp").alias("ingest_date")
    store.land(bronze_events(spark, [ev("e0", when="2024-01-01 00:00:00")]).select("*", day), "events", "r", 0)
    store.land(bronze_events(spark, [ev("e1", when="2024-01-09 00:00:00")]).select("*", day), "events", "other", 0)
    got = {r.source_name: r for r in freshness(spark, store, "2024-01-09 00:10:00").collect()}
    assert got["bronze.events"].latest_at == ts("2024-01-09 00:00:00") and got["bronze.events"].status == "pass"


def test_bootstrap_after_a_failed_lookup_keeps_every_row(spark, tmp_dir, monkeypatch):
    from helpers import bronze_events, ev
    from tierline.operators import silver
    from tierline.sources import tables
    store = TierStore(os.path.join(tmp_dir, "lake"))
    store.bootstrap(spark)
    store.write(silver.clean_events(bronze_events(spark, [ev("e1")]), fx.FIXTURE_AS_OF), "silver", "clean_events")

    def denied(spark_, path):
        raise PermissionError("denied")

    with monkeypatch.context() as m:
        m.setattr(tables, "_fs", denied)
        with pytest.raises(PermissionError):
            store.bootstrap(spark)
    store.bootstrap(spark)
    assert store.read(spark, "silver", "clean_events").count() == 1


def test_a_failed_rewrite_leaves_the_table(spark, tmp_dir):
    from pyspark.sql import functions as F
    store = TierStore(os.path.join(tmp_dir, "lake"))
    store.bootstrap(spark)
    good = spark.createDataFrame([(None, "click", 1, 1, 0.5)], store.read(spark, "gold", "daily_kpis").schema)
    store.write(good, "gold", "daily_kpis")
    bad = good.withColumn("total_events", F.raise_error(F.lit("lost")).cast("long"))
    with pytest.raises(Exception, match="lost"):
        store.write(bad, "gold", "daily_kpis")
    assert store.read(spark, "gold", "daily_kpis").count() == 1
    store.write(good.union(good), "gold", "daily_kpis")
    assert store.read(spark, "gold", "daily_kpis").count() == 2


def _land(spark, store, batch, events, orders):
    from helpers import bronze_events, bronze_orders
    from pyspark.sql import functions as F
    e, o = bronze_events(spark, events), bronze_orders(spark, orders)
    store.land(e.withColumn("ingest_date", F.lit("2024-02-01").cast("date")), "events", "run", batch)
    store.land(o.withColumn("ingest_date", F.lit("2024-02-01").cast("date")), "orders", "run", batch)
    stats = e.agg(F.lit("bronze.events").alias("source_name"), F.count("*").alias("rows"),
                  F.lit(0).cast("long").alias("dead_letters"), F.max("timestamp").alias("latest_at"))
    store.land(stats, "ingest_stats", "run", batch)


def test_incremental_refresh_equals_a_full_one(spark, tmp_dir):
    from helpers import ev, item, items, od
    batches = [
        ([ev("a", when="2024-01-01 10:00:00"), ev("b", "click", when="2024-01-02 10:00:00"),
          ev("c", "purchase", "u2", when="2024-01-03 10:00:00"), ev(None)],
         [od("o1", items(item()), 10.0), od("o2", items(item()), 11.0)]),
        # a moves to another day and leaves its old one empty; b's latest copy has an unknown type
        ([ev("a", when="2024-01-05 10:00:00"), ev("b", "hover", when="2024-01-02 11:00:00"), ev("d", when="2024-01-03 09:00:00")],
         [od("o2", items(item(qty=2)), 20.0, when="2024-02-02 00:00:00")]),
        # late: an older copy of b and of a change nothing; a new user on an old day
        ([ev("b", "click", when="2024-01-02 09:00:00"), ev("a", when="2023-12-31 10:00:00"), ev("e", user="u9", when="2024-01-05 11:00:00")],
         [od("o3", "broken", 5.0), od("o1", items(item()), 10.0, when="2024-01-01 00:00:00")]),
    ]
    inc, full = (TierStore(os.path.join(tmp_dir, n)) for n in ("inc", "full"))
    for i, (events, orders) in enumerate(batches):
        for store in (inc, full):
            store.bootstrap(spark)
            _land(spark, store, i, events, orders)
        res = run_refresh(spark, inc, fx.FIXTURE_AS_OF, steps=("silver", "quality", "gold"), incremental=True)
        run_refresh(spark, full, fx.FIXTURE_AS_OF, steps=("silver", "quality", "gold"))
        assert _snapshot(spark, inc) == _snapshot(spark, full), i
    assert {str(d) for d in res.days["clean_events"]} == {"2024-01-05"}
    again = run_refresh(spark, inc, fx.FIXTURE_AS_OF, steps=("silver", "gold"), incremental=True)
    assert again.days == {"clean_events": [], "validate_orders": []}
    assert _snapshot(spark, inc) == _snapshot(spark, full)
    # the raw rows of new batches come from their own folders only
    from tierline.plans.incremental import in_batches
    plan = inc.read(spark, "bronze", "events", partitions=True).filter(in_batches([("run", 2)])) \
        ._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "batch_id" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_gate_passes_valid_orders_and_poison_rows_fail_alone(spark, tmp_dir):
    from helpers import bronze_orders, item, items, od
    from tierline.operators import quality, silver
    raw = bronze_orders(spark, [
        od("cent", items(item(price=10.0)), 10.01, status="paid"), od("frac", items(item(price=59.98)), 59.9899, status="paid"),
        od("huge", items(item(price=10.0)), 1e17, status="paid"),
        od("items", items(item(qty=2_000_000_000, price=900_000_000.0)), 1.8e18, status="paid"),
        od("inf", items(item(price=10.0)), float("inf"), status="paid")])
    valid = silver.validate_orders(raw, fx.FIXTURE_AS_OF)
    status = {r.order_id: r.status for r in valid.collect()}
    assert status == {"cent": "paid", "frac": "paid", "huge": "validation_failed", "items": "validation_failed",
                      "inf": "validation_failed"}
    clean = TierStore(os.path.join(tmp_dir, "lake"))
    clean.bootstrap(spark)
    report = quality.silver_quality(clean.read(spark, "silver", "clean_events"), valid)
    quality.assert_quality(report)


def test_incremental_refresh_takes_batches_without_statistics(spark, tmp_dir):
    from helpers import bronze_events, ev
    from pyspark.sql import functions as F
    inc, full = (TierStore(os.path.join(tmp_dir, n)) for n in ("inc", "full"))
    steps = ("silver", "quality", "gold")
    for store in (inc, full):
        store.bootstrap(spark)
        _land(spark, store, 0, [ev("a", when="2024-01-01 10:00:00")], [])
    run_refresh(spark, inc, fx.FIXTURE_AS_OF, steps=steps, incremental=True)
    for batch, rows in ((0, [ev("b", when="2024-01-02 10:00:00")]), (1, [ev("a", when="2024-01-03 10:00:00")])):
        for store in (inc, full):
            store.land(bronze_events(spark, rows).withColumn("ingest_date", F.lit("2024-02-01").cast("date")), "events", "other", batch)
        run_refresh(spark, inc, fx.FIXTURE_AS_OF, steps=steps, incremental=True)
    run_refresh(spark, full, fx.FIXTURE_AS_OF, steps=steps)
    assert _snapshot(spark, inc) == _snapshot(spark, full)


def test_incremental_gold_after_a_full_refined_tier_alone(spark, tmp_dir):
    from helpers import ev
    inc, full = (TierStore(os.path.join(tmp_dir, n)) for n in ("inc", "full"))
    for store in (inc, full):
        store.bootstrap(spark)
        _land(spark, store, 0, [ev("a", when="2024-01-01 10:00:00"), ev("b", when="2024-01-02 10:00:00")], [])
    run_refresh(spark, inc, fx.FIXTURE_AS_OF, steps=("silver",))
    for store in (inc, full):
        _land(spark, store, 1, [ev("b", when="2024-01-04 10:00:00")], [])
    run_refresh(spark, inc, fx.FIXTURE_AS_OF, steps=("silver", "gold"), incremental=True)
    run_refresh(spark, full, fx.FIXTURE_AS_OF, steps=("silver", "gold"))
    assert _snapshot(spark, inc) == _snapshot(spark, full)
