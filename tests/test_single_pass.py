"""A refinement derives what it writes once, however many tables take it."""

import os
from datetime import date
from itertools import product

import pytest
from pyspark.sql import functions as F

from helpers import ev, item, items, od
from test_refresh import _land

from tierline.operators.dedup import comes_before, latest_per_key
from tierline.plans import incremental as inc
from tierline.plans import order_lines
from tierline.plans.refresh import new_batches, run_refresh
from tierline.sources import fixtures as fx
from tierline.sources.tables import TierStore


def test_the_order_of_two_rows_is_that_of_the_latest(spark):
    values = [(t, a, x) for t in (None, 1, 2) for a in (None, "a", "b") for x in (None, -0.0, 0.0, float("nan"))]
    pairs = list(enumerate(product(values, values)))
    schema = "id int, side int, t int, a string, x double"
    rows = spark.createDataFrame([(i, side, *row) for i, two in pairs for side, row in enumerate(two)], schema)
    # Of equal rows the second side counts, as known rows do.
    want = {r.id for r in latest_per_key(rows.withColumn("other", F.lit(1) - F.col("side")), ["id"], "t", ("a", "x", "other"))
            .filter("side = 0").collect()}
    both = rows.filter("side = 0").join(rows.filter("side = 1").select("id", F.struct("t", "a", "x").alias("known")), "id")
    assert {r.id for r in both.filter(comes_before("t", ("a", "x"), "known")).collect()} == want
    assert 0 < len(want) < len(pairs)


@pytest.mark.parametrize("few", [0, 1 << 16])
def test_changed_rows_with_what_they_replace(spark, tmp_dir, monkeypatch, few):
    monkeypatch.setattr(inc, "FEW_ROWS", few)
    store = TierStore(os.path.join(tmp_dir, "lake"), buckets=4)
    store.bootstrap(spark)
    _land(spark, store, 0, [ev("same"), ev("late", when="2024-01-05 00:00:00"), ev("moved"), ev("tied", "click"), ev("alone")], [])
    run_refresh(spark, store, fx.FIXTURE_AS_OF, steps=("silver",))
    _land(spark, store, 1, [ev("same"), ev("late", when="2024-01-04 00:00:00"), ev("moved", when="2024-01-31 00:00:00"), ev(None),
                            ev("tied", "add_to_cart"), ev("new"), ev("new", when="2024-01-29 00:00:00"), ev("new")], [])
    new, old = inc._changed(spark, store, inc.MODELS[0], inc.read_commit(spark, store), new_batches(spark, store))
    assert new.columns == old.columns
    if not few:  # the batch's rows and the known ones are shuffled once each
        assert new._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 2
    assert sorted((r.event_id, r.event_type, r.timestamp.day) for r in new.collect()) == [
        ("moved", "page_view", 31), ("new", "page_view", 30), ("tied", "add_to_cart", 30)]
    assert sorted((r.event_id, r.event_type, r.timestamp.day) for r in old.collect()) == [
        ("moved", "page_view", 30), ("tied", "click", 30)]


def test_rows_of_replaced_days_are_computed_once(spark, tmp_dir):
    store = TierStore(os.path.join(tmp_dir, "lake"))
    store.bootstrap(spark)
    schema = "event_date date, event_type string, daily_active_users long, total_events long, conversion_rate double"
    day = lambda d: None if d is None else date(2024, 1, d)
    rows = lambda *days: [(day(d), "click", 1, d, 0.5) for d in days]
    store.replace_days(spark.createDataFrame(rows(1, 2, 3, None), schema), "gold", "daily_kpis", [day(d) for d in (1, 2, 3, None)])
    seen = spark.sparkContext.accumulator(0)

    def counted(row):
        seen.add(1)
        return row

    again = spark.createDataFrame(spark.sparkContext.parallelize(rows(2, 4), 2).map(counted), schema)
    store.replace_days(again, "gold", "daily_kpis", [day(d) for d in (1, 2, 4, 5, None)])
    assert seen.value == 2
    assert sorted(r.event_date for r in store.read(spark, "gold", "daily_kpis").collect()) == [day(2), day(3), day(4)]


def test_a_text_is_stored_as_lines_once(spark, tmp_dir):
    """Its copy that landed, and the order's current one, are the same text."""
    store = TierStore(os.path.join(tmp_dir, "lake"), buckets=4)
    store.bootstrap(spark)
    two = items(item("p1"), item("p2"))
    _land(spark, store, 0, [], [od("o1", two, 20.0), od("o1", two, 20.0, when="2024-01-30 11:00:00"), od("o2", items(item("p1")), 10.0),
                                od(None, two, 20.0), od("o3", "broken", 1.0)])
    run_refresh(spark, store, fx.FIXTURE_AS_OF, steps=("silver",))
    _land(spark, store, 1, [], [od("o2", two, 20.0, when="2024-01-31 00:00:00")])
    run_refresh(spark, store, fx.FIXTURE_AS_OF, steps=("silver",), incremental=True)
    lines, _ = order_lines.read(spark, store, inc.read_commit(spark, store))
    assert sorted((r.order_id, r.product_id, r.raw, r.latest) for r in lines.collect()) == [
        ("o1", "p1", 2, 1), ("o1", "p2", 2, 1), ("o2", "p1", 0, -1), ("o2", "p1", 1, 1), ("o2", "p1", 1, 1), ("o2", "p2", 1, 1)]
