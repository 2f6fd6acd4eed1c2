"""Compaction of raw tables: the same rows in fewer folders, repeatable, and nothing else notices."""

import os
import random

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from helpers import ev
from test_incremental import random_batch
from test_refresh import _land, _snapshot

from tierline.plans import incremental as inc
from tierline.plans import order_lines
from tierline.plans.compaction import compact_raw
from tierline.plans.refresh import freshness, new_batches, run_refresh
from tierline.sources import fixtures as fx
from tierline.sources.buckets import BucketedTable
from tierline.sources.tables import TierStore

STEPS = ("silver", "gold")


def folders(store, table):
    return sorted(d.split("batch_id=")[1] for d, _, _ in os.walk(store.folder("bronze", table)) if "batch_id=" in d)


def rows(spark, store, table="events"):
    return sorted(map(tuple, store.read(spark, "bronze", table).collect()), key=repr)


def landed(spark, tmp_dir, n, name="lake"):
    store = TierStore(os.path.join(tmp_dir, name), buckets=4)
    store.bootstrap(spark)
    rng = random.Random(3)
    for batch in range(n):
        _land(spark, store, batch, *random_batch(rng, 15))
    return store


def test_same_rows_in_one_folder_a_day(spark, tmp_dir):
    store = landed(spark, tmp_dir, 3)
    run_refresh(spark, store, fx.FIXTURE_AS_OF, steps=STEPS, incremental=True)
    _land(spark, store, 3, [ev("late", when="2024-01-02 00:00:00")], [])  # not refined: stays as it is
    before, stale = rows(spark, store), freshness(spark, store, fx.FIXTURE_AS_OF).collect()
    orders, open_batches = rows(spark, store, "orders"), new_batches(spark, store)
    assert compact_raw(spark, store, "2024-02-02") == 1
    assert folders(store, "events") == ["-1", "3"] and folders(store, "orders") == ["-1"]
    assert rows(spark, store) == before and rows(spark, store, "orders") == orders
    assert freshness(spark, store, fx.FIXTURE_AS_OF).collect() == stale and new_batches(spark, store) == open_batches == [("run", 3)]
    part = spark.read.parquet(os.path.join(store.folder("bronze", "events"), "ingest_date=2024-02-01", "run=run", "batch_id=-1"))
    assert {r.landed_batch for r in part.collect()} == {0, 1, 2}
    # days from the bound on stay; a second run goes on with what was finished since
    run_refresh(spark, store, fx.FIXTURE_AS_OF, steps=STEPS, incremental=True)
    assert compact_raw(spark, store, "2024-02-01") == 2  # never back: the day stays compacted
    assert rows(spark, store) == before and folders(store, "events") == ["-1", "-2"]
    again = _snapshot(spark, store)
    run_refresh(spark, store, fx.FIXTURE_AS_OF, steps=STEPS)  # a full rebuild reads the compacted rows
    assert _snapshot(spark, store) == again


def test_days_from_the_bound_on_stay(spark, tmp_dir):
    store = landed(spark, tmp_dir, 2)
    run_refresh(spark, store, fx.FIXTURE_AS_OF, steps=STEPS, incremental=True)
    before = rows(spark, store)
    compact_raw(spark, store, "2024-02-01")
    assert folders(store, "events") == ["0", "1"] and rows(spark, store) == before


@pytest.mark.parametrize("method", ["write", "drop_hidden"])
def test_a_failed_compaction_changes_nothing_and_is_done_again(spark, tmp_dir, monkeypatch, method):
    store = landed(spark, tmp_dir, 2, method)
    run_refresh(spark, store, fx.FIXTURE_AS_OF, steps=STEPS, incremental=True)
    before = rows(spark, store)

    def fails(self, *args):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(TierStore, method, fails)
        with pytest.raises(RuntimeError):
            compact_raw(spark, store, "2024-02-02")
    assert rows(spark, store) == before  # neither twice nor not at all
    compact_raw(spark, store, "2024-02-02")
    assert rows(spark, store) == before and not {"0", "1"} & set(folders(store, "events"))
    _land(spark, store, 2, [ev("new")], [])
    run_refresh(spark, store, fx.FIXTURE_AS_OF, steps=STEPS, incremental=True)
    assert "new" in {r.event_id for r in store.read(spark, "silver", "clean_events").collect()}


def test_hidden_folders_are_not_read(spark, tmp_dir):
    store = landed(spark, tmp_dir, 2)
    run_refresh(spark, store, fx.FIXTURE_AS_OF, steps=("silver",), incremental=True)
    compact_raw(spark, store, "2024-02-02")
    plan = store.read(spark, "bronze", "events")._jdf.queryExecution().executedPlan().toString()
    assert "batch_id" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_rows_are_stored_compressed(spark, tmp_dir):
    """A row is written by every layout it passes through: landed, current, refined, as lines, compacted."""
    store = landed(spark, tmp_dir, 2)
    run_refresh(spark, store, fx.FIXTURE_AS_OF, steps=("silver",), incremental=True)
    compact_raw(spark, store, "2024-02-02")
    _land(spark, store, 2, [ev("new")], [])
    run_refresh(spark, store, fx.FIXTURE_AS_OF, steps=("silver",), incremental=True)
    codecs = {}
    for d, _, names in os.walk(store.root):
        for n in (n for n in names if n.endswith(".parquet") and "_statistics" not in d):
            meta = pq.ParquetFile(os.path.join(d, n)).metadata
            if meta.num_rows:
                codecs.setdefault(os.path.relpath(d, store.root).split(os.sep)[1], set()).add(meta.row_group(0).column(0).compression)
    assert {"events", "orders", "event_winners", "order_winners", "clean_events", "validate_orders", "order_lines"} <= set(codecs)
    assert set.union(*codecs.values()) == {"ZSTD"}


def test_lines_of_a_single_part_need_no_search_for_the_latest(spark, tmp_dir, monkeypatch):
    """A full refresh has just written each id once, so the orders are not shuffled again; a log of parts is searched."""
    store, found, real = landed(spark, tmp_dir, 2), [], inc._latest

    def latest(rows, model, *more):
        found.append(model.raw)
        return real(rows, model, *more)

    monkeypatch.setattr(inc, "_latest", latest)
    run_refresh(spark, store, fx.FIXTURE_AS_OF, steps=("silver",))
    assert found == ["events", "orders"]
    _land(spark, store, 2, *random_batch(random.Random(8), 15))
    run_refresh(spark, store, fx.FIXTURE_AS_OF, steps=("silver",), incremental=True)
    commit = inc.read_commit(spark, store)
    assert len(store.parts(spark, "silver", "order_winners")) == 2

    def lines():
        own = order_lines.tables(store, commit.lines)[0].read(spark).filter(F.col("attempt").isin(commit.attempts))
        return sorted(map(tuple, own.groupBy("order_id", "product_id", "product_name", "revenue")
                          .agg(F.sum("raw").alias("raw"), F.sum("latest").alias("latest"))
                          .filter("raw <> 0 or latest <> 0").collect()), key=repr)

    before = lines()
    found.clear()
    inc.build_lines(spark, store, commit)
    assert found == ["orders"] and lines() == before


def test_what_all_rows_share_is_not_shuffled(spark, tmp_dir):
    table = BucketedTable(os.path.join(tmp_dir, "lines"), "k string, v long, attempt string", "k", 4)
    rows = spark.createDataFrame([(f"k{i % 7}", i) for i in range(50)], "k string, v long")
    table.append(rows, attempt="a")
    table.append(rows.withColumn("attempt", F.lit("b")))
    got = sorted(map(tuple, table.read(spark).collect()))
    assert got == sorted((k, v, a) for k, v in map(tuple, rows.collect()) for a in "ab")
    plan = table.read(spark).groupBy("k").count()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
