"""Incremental refreshes: equal to full ones, pruned to buckets and periods, repeatable after a failure."""

import os
import random

import pytest

from helpers import ev, item, items, od
from test_refresh import _land, _snapshot

from tierline.operators import gold
from tierline.plans import incremental as inc
from tierline.plans.refresh import new_batches, run_refresh
from tierline.sources import fixtures as fx
from tierline.sources.tables import TierStore

STEPS = ("silver", "quality", "gold")


def stores(spark, tmp_dir, *names):
    out = [TierStore(os.path.join(tmp_dir, n), buckets=4) for n in names]
    for s in out:
        s.bootstrap(spark)
    return out


def random_batch(rng, n=40):
    """Few ids, users, days and types, so that ids come again, earlier and later, with other users and
    types; single-event users lose their first and last times."""
    events = [ev(f"e{rng.randint(0, 25)}", rng.choice(["page_view", "click", "purchase", "hover"]), rng.choice(["u1", "u2", "u3", None]),
                 f"2024-01-{rng.randint(1, 6):02d} {rng.randint(0, 2):02d}:00:00") for _ in range(n)]
    orders = [od(f"o{rng.randint(0, 15)}", rng.choice([items(item(qty=q)), "broken"]), 10.0 * rng.choice([1, q]), rng.choice(["u1", "u4"]),
                 when=f"2024-0{rng.randint(1, 3)}-01 0{rng.randint(0, 3)}:00:00") for q in rng.choices([1, 2, 3], k=n // 2)]
    return events, orders


@pytest.mark.parametrize("seed", [1])
def test_random_batches_equal_a_full_refresh(spark, tmp_dir, seed):
    rng = random.Random(seed)
    part, full = stores(spark, tmp_dir, "part", "full")
    for batch in range(3):
        events, orders = random_batch(rng)
        for store in (part, full):
            _land(spark, store, batch, events, orders)
        run_refresh(spark, part, fx.FIXTURE_AS_OF, steps=STEPS, incremental=True)
    run_refresh(spark, full, fx.FIXTURE_AS_OF, steps=STEPS)
    assert _snapshot(spark, part) == _snapshot(spark, full)
    assert inc.read_commit(spark, part).full == 1 and inc.read_commit(spark, part).seq == 3


class Lost(Exception):
    pass


@pytest.mark.parametrize("method, call", [("replace_days", 2), ("add_part", 1), ("add_part", 3)])
def test_a_failed_refresh_is_done_again(spark, tmp_dir, monkeypatch, method, call):
    """Fails after some tables have moved; another batch lands before the next attempt."""
    rng = random.Random(call)
    part, full = stores(spark, tmp_dir, "part", "full")
    batches = [random_batch(rng) for _ in range(3)]
    for store in (part, full):
        _land(spark, store, 0, *batches[0])
    run_refresh(spark, part, fx.FIXTURE_AS_OF, steps=STEPS, incremental=True)
    for store in (part, full):
        _land(spark, store, 1, *batches[1])
    done = []
    real = getattr(TierStore, method)

    def fails(self, *args, **kw):
        real(self, *args, **kw)
        done.append(1)
        if len(done) == call:
            raise Lost

    with monkeypatch.context() as m:
        m.setattr(TierStore, method, fails)
        with pytest.raises(Lost):
            run_refresh(spark, part, fx.FIXTURE_AS_OF, steps=STEPS, incremental=True)
    for store in (part, full):
        _land(spark, store, 2, *batches[2])
    run_refresh(spark, part, fx.FIXTURE_AS_OF, steps=STEPS, incremental=True)
    run_refresh(spark, full, fx.FIXTURE_AS_OF, steps=STEPS)
    assert _snapshot(spark, part) == _snapshot(spark, full)


def test_a_failed_full_refresh_is_followed_by_a_full_one(spark, tmp_dir, monkeypatch):
    part, full = stores(spark, tmp_dir, "part", "full")
    for store in (part, full):
        _land(spark, store, 0, *random_batch(random.Random(3)))
    with monkeypatch.context() as m:
        real = TierStore.write

        def fails(self, df, tier, table):
            if table == "order_winners":
                raise Lost
            real(self, df, tier, table)

        m.setattr(TierStore, "write", fails)
        with pytest.raises(Lost):
            run_refresh(spark, part, fx.FIXTURE_AS_OF, steps=STEPS)
    assert inc.read_commit(spark, part).full == 0
    for store in (part, full):
        _land(spark, store, 1, *random_batch(random.Random(4)))
    run_refresh(spark, part, fx.FIXTURE_AS_OF, steps=STEPS, incremental=True)
    run_refresh(spark, full, fx.FIXTURE_AS_OF, steps=STEPS)
    assert _snapshot(spark, part) == _snapshot(spark, full)


def test_a_batch_reads_only_the_buckets_it_touches(spark, tmp_dir):
    (store,) = stores(spark, tmp_dir, "lake")
    rows = [ev(f"e{i}", when="2024-01-01 10:00:00") for i in range(60)]
    _land(spark, store, 0, rows, [])
    run_refresh(spark, store, fx.FIXTURE_AS_OF, steps=("silver",))
    model = inc.MODELS[0]
    plan = inc.current_rows(spark, store, model, 1, [2])._jdf.queryExecution().executedPlan().toString()
    pruned = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "bucket" in pruned and "seq" in pruned
    seen = inc.current_rows(spark, store, model, 1, [2]).inputFiles()
    every = store.read(spark, "silver", model.winners).inputFiles()
    assert 0 < len(every) and len(inc.current_rows(spark, store, model, 1, [2]).select("bucket").distinct().collect()) == 1
    assert seen
    # and refining a batch reads neither all raw rows nor the refined days it leaves alone
    _land(spark, store, 1, [ev("e3", when="2024-01-09 10:00:00")], [])
    commit = inc.read_commit(spark, store)
    new, old = inc._changed(spark, store, model, commit, new_batches(spark, store))
    text = new._jdf.queryExecution().optimizedPlan().toString() + new._jdf.queryExecution().executedPlan().toString()
    scans = [s.split("PartitionFilters: [")[1].split("]")[0] for s in text.split("FileScan parquet")[1:] if "PartitionFilters: [" in s]
    assert scans and all("batch_id" in s or "bucket" in s for s in scans)
    assert [r.event_id for r in new.collect()] == ["e3"] and [r.timestamp.day for r in old.collect()] == [1]


def test_marks_replace_the_list_of_batches(spark, tmp_dir):
    (store,) = stores(spark, tmp_dir, "lake")
    for batch in (0, 1, 3):
        _land(spark, store, batch, [ev(f"e{batch}")], [])
    run_refresh(spark, store, fx.FIXTURE_AS_OF, steps=("silver",), incremental=True)
    commit = inc.read_commit(spark, store)
    assert commit.marks == {"run": 1} and commit.batches == {("run", 3)}
    assert new_batches(spark, store) == []
    _land(spark, store, 2, [ev("e2")], [])
    assert new_batches(spark, store) == [("run", 2)]
    run_refresh(spark, store, fx.FIXTURE_AS_OF, steps=("silver",), incremental=True)
    commit = inc.read_commit(spark, store)
    assert commit.marks == {"run": 3} and not commit.batches
    plan = store.read(spark, "bronze", "events", partitions=True).filter(inc.beyond(commit))._jdf.queryExecution().executedPlan().toString()
    assert "batch_id" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_the_log_of_current_rows_is_rewritten_as_one(spark, tmp_dir, monkeypatch):
    monkeypatch.setattr(inc, "MAX_PARTS", 2)
    part, full = stores(spark, tmp_dir, "part", "full")
    rng = random.Random(9)
    for batch in range(4):
        events, orders = random_batch(rng, 12)
        for store in (part, full):
            _land(spark, store, batch, events, orders)
        run_refresh(spark, part, fx.FIXTURE_AS_OF, steps=("silver", "gold"), incremental=True)
        assert len(part.parts(spark, "silver", "event_winners")) <= 2
    run_refresh(spark, full, fx.FIXTURE_AS_OF, steps=("silver", "gold"))
    assert _snapshot(spark, part) == _snapshot(spark, full)
    ids = [r.event_id for r in part.read(spark, "silver", "event_winners").collect()]
    assert len(ids) >= len(set(ids)) > 0


def test_the_gate_turns_a_batch_away_until_it_is_mended(spark, tmp_dir, monkeypatch):
    from tierline.operators import quality
    part, full = stores(spark, tmp_dir, "part", "full")
    for store in (part, full):
        _land(spark, store, 0, [ev("a")], [])
    run_refresh(spark, part, fx.FIXTURE_AS_OF, steps=STEPS, incremental=True)
    for store in (part, full):
        _land(spark, store, 1, [ev("a", "click", when="2024-01-31 00:00:00"), ev("b")], [])
    with monkeypatch.context() as m:
        def refuse(report):
            raise ValueError("refused")

        m.setattr(quality, "assert_quality", refuse)
        for _ in range(2):
            with pytest.raises(ValueError):
                run_refresh(spark, part, fx.FIXTURE_AS_OF, steps=STEPS, incremental=True)
            assert new_batches(spark, part) == [("run", 1)]
    run_refresh(spark, part, fx.FIXTURE_AS_OF, steps=STEPS, incremental=True)
    run_refresh(spark, full, fx.FIXTURE_AS_OF, steps=STEPS)
    assert _snapshot(spark, part) == _snapshot(spark, full)


# ---------------------------------------------------------------- the customers' states

def _events(spark, rows):
    from pyspark.sql import functions as F

    from tierline.schemas import CLEAN_EVENTS
    df = spark.createDataFrame([(None, f"k{i}", u, None, t, None, None, when, None, None) for i, (u, t, when) in enumerate(rows)], CLEAN_EVENTS)
    return df.withColumn("event_day", F.to_date("event_timestamp"))


def _orders(spark, rows):
    from tierline.schemas import VALIDATED_ORDERS
    return spark.createDataFrame([(None, o, u, amount, amount, None, None, None, status, None) for o, u, amount, status in rows], VALIDATED_ORDERS)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_merged_changes_equal_a_rebuilt_state(spark, seed):
    from collections import Counter
    from datetime import datetime
    from decimal import Decimal

    from pyspark.sql import functions as F
    rng = random.Random(seed)
    row = lambda: (rng.choice(["u1", "u2", "u3", "u4", None]), rng.choice(["click", "purchase", "page_view"]),
                   rng.choice([None] + [datetime(2024, 1, d, h) for d in (1, 2, 3) for h in (0, 5)]))
    order = lambda i: (f"o{i}", rng.choice(["u1", "u5", None]), Decimal(rng.randint(1, 900)) / 10, rng.choice(["paid", "validation_failed", None]))
    old, orders = [row() for _ in range(8)], [order(i) for i in range(6)]
    gone, gone_orders = rng.sample(old, 5), rng.sample(orders, 3)
    more, more_orders = [row() for _ in range(4)], [order(i) for i in range(10, 13)]
    now = list((Counter(old) - Counter(gone) + Counter(more)).elements())
    now_orders = [o for o in orders if o not in gone_orders] + more_orders
    signed = lambda df, sign: df.withColumn("sign", F.lit(sign))
    changes = signed(gold.event_rows(_events(spark, more)), 1)
    for df, sign in ((gold.event_rows(_events(spark, gone)), -1), (gold.order_rows(_orders(spark, more_orders)), 1),
                     (gold.order_rows(_orders(spark, gone_orders)), -1)):
        changes = changes.unionByName(signed(df, sign))
    # a row added and taken back between two reads of the changes
    twice = _events(spark, [("u2", "click", datetime(2023, 1, 1)), ("u6", "click", datetime(2025, 1, 1))])
    changes = changes.unionByName(signed(gold.event_rows(twice), 1)).unionByName(signed(gold.event_rows(twice), -1))
    state = gold.customer_state(_events(spark, old), _orders(spark, orders))
    got = gold.merge_changes(state, changes, _events(spark, now))
    want = gold.customer_state(_events(spark, now), _orders(spark, now_orders))
    assert got.columns == want.columns
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)


def test_events_are_read_again_only_for_users_that_lost_a_time(spark):
    from datetime import datetime
    day = lambda d: datetime(2024, 1, d)
    state = gold.customer_state(_events(spark, [("u", "click", day(2)), ("u", "click", day(4)), ("u", "click", day(6))]), _orders(spark, []))
    moved = lambda **kw: spark.createDataFrame(
        [("u", kw.get("plus_first"), kw.get("plus_last"), kw.get("minus_first"), kw.get("minus_last"))],
        "user_id string, plus_first timestamp_ntz, plus_last timestamp_ntz, minus_first timestamp_ntz, minus_last timestamp_ntz")
    clean = _events(spark, [("u", "click", day(4))])
    assert gold._seen_again(state, moved(minus_first=day(4), minus_last=day(4)), clean) == []
    assert gold._seen_again(state, moved(minus_first=day(6), minus_last=day(6), plus_first=day(7), plus_last=day(7)), clean) == []
    first, last = gold._seen_again(state, moved(minus_first=day(2), minus_last=day(2)), clean)
    assert [tuple(r) for r in first.collect()] == [("u", day(4))] and last.count() == 0
