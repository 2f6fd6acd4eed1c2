"""Exact distinct users from merged bitmaps."""

import random

import pytest
from pyspark.sql import functions as F

from test_incremental import _events

from tierline.operators import bitmaps, gold, reports


def _random_events(spark, seed=1, n=400, users=60):
    from datetime import datetime
    rng = random.Random(seed)
    return _events(spark, [(rng.choice([None] + [f"u{i}" for i in range(users)]), rng.choice(["page_view", "click", "purchase", "error"]),
                            rng.choice([None] + [datetime(2024, 1, d, 5) for d in range(1, 20)])) for _ in range(n)])


def test_numbers_are_dense_and_kept(spark, monkeypatch):
    monkeypatch.setattr(bitmaps, "PART_USERS", 7)  # several parts
    users = spark.createDataFrame([(f"u{i % 40}",) for i in range(100)] + [(None,)], "user_id string")
    first = bitmaps.number_users(users)
    assert sorted(r.number for r in first.collect()) == list(range(1, 41))
    assert len({r.user_id for r in first.collect()}) == 40
    first = spark.createDataFrame(first.collect(), first.schema)
    more = bitmaps.number_users(users.union(spark.createDataFrame([(f"n{i}",) for i in range(9)], "user_id string")), first)
    assert {r.user_id for r in more.collect()} == {f"n{i}" for i in range(9)}
    assert sorted(r.number for r in more.collect()) == list(range(41, 50))
    assert bitmaps.number_users(users, first).count() == 0


@pytest.mark.parametrize("users", [60, 70000])
def test_any_range_equals_count_distinct(spark, users):
    """With so many numbers that the users span several pieces."""
    events = _random_events(spark, users=60)
    numbers = bitmaps.number_users(events).withColumn("number", F.col("number") * (users // 60)).cache()
    maps = bitmaps.user_bitmaps(events, numbers).cache()
    assert maps.agg(F.max(F.octet_length("users"))).first()[0] == 4096
    assert (maps.select("piece").distinct().count() > 1) == (users > 40000)
    for a, b in (("2024-01-01", "2024-01-19"), ("2024-01-03", "2024-01-03"), ("2024-01-05", "2024-01-11"), ("2025-01-01", "2025-01-02")):
        inside = events.filter(F.to_date("event_timestamp").between(F.lit(a).cast("date"), F.lit(b).cast("date")))
        want = {r[0]: r[1] for r in inside.groupBy("event_type").agg(F.count_distinct("user_id")).collect()}
        got = {r.event_type: r.users for r in bitmaps.range_users(maps, a, b).collect()}
        if want:
            want[None] = inside.select("user_id").filter("user_id IS NOT NULL").distinct().count()
        assert got == want
        funnel = bitmaps.report_funnel(maps, gold.daily_kpis(events), a, b)
        assert [tuple(r) for r in funnel.collect()] == [tuple(r) for r in reports.report_funnel(events, a, b).collect()]


def test_rolling_users(spark):
    events = _random_events(spark, seed=2, n=120)
    maps = bitmaps.user_bitmaps(events, bitmaps.number_users(events))
    rows = [(r.event_timestamp.date(), r.user_id) for r in events.collect() if r.event_timestamp]
    for days in (1, 3, 7):
        want = {d: len({u for e, u in rows if u and 0 <= (d - e).days < days}) for d in {d for d, u in rows if u}}
        assert {r.event_date: r.users for r in bitmaps.rolling_users(maps, days).collect()} == want


def test_no_event_is_read_by_a_report(spark):
    maps = bitmaps.user_bitmaps(_random_events(spark), bitmaps.number_users(_random_events(spark)))
    stored = spark.createDataFrame(maps.collect(), maps.schema)
    plan = bitmaps.range_users(stored, "2024-01-01", "2024-01-09")._jdf.queryExecution().executedPlan().toString()
    assert "bitmap_or_agg" in plan and "count(distinct" not in plan


def test_empty(spark):
    none = _events(spark, [])
    maps = bitmaps.user_bitmaps(none, bitmaps.number_users(none))
    assert maps.count() == 0 and bitmaps.rolling_users(maps).count() == 0
    assert bitmaps.range_users(maps, "2024-01-01", "2024-01-09").count() == 0
