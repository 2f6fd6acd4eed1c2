"""Dead-letter replay: landed once, marked, repeatable after a failure; and the Variant column."""

import json
import os
from datetime import datetime

import pytest

from tierline.sources.tables import TierStore
from tierline.streaming import ingest, replay

GOOD = {"event_id": "e1", "event_type": "click", "user_id": "u", "session_id": "s", "page": "/", "timestamp": "2024-01-01T00:00:00"}
BAD = "no json"


def letters(spark, store, batch, rows):
    """rows: (offset, value) of raw.events."""
    df = spark.createDataFrame([("raw.events", 0, o, datetime(2024, 1, 1), v, ["value: not JSON"], datetime(2024, 1, 1).date())
                                for o, v in rows], "topic string, partition int, offset long, broker_timestamp timestamp, value string, "
                               "errors array<string>, ingest_date date")
    store.land(df, "dead_letter", "q", batch)


def fixes(spark, rows):
    return spark.createDataFrame([("raw.events", 0, o, v) for o, v in rows], "topic string, partition int, offset long, value string")


def store_of(spark, tmp_dir, name="lake"):
    store = TierStore(os.path.join(tmp_dir, name))
    store.bootstrap(spark)
    return store


def ids(spark, store):
    return sorted(r.event_id for r in store.read(spark, "bronze", "events").collect())


def test_each_message_is_landed_once_and_marked(spark, tmp_dir):
    store = store_of(spark, tmp_dir)
    letters(spark, store, 0, [(1, BAD), (2, json.dumps(GOOD)), (3, BAD)])
    letters(spark, store, 1, [(2, json.dumps(GOOD))])  # stored by two queries
    assert replay.replay(spark, store) == 1  # valid by the present rules
    assert replay.replay(spark, store) == 0
    assert ids(spark, store) == ["e1"]
    fix = fixes(spark, [(1, json.dumps({**GOOD, "event_id": "e2"})), (2, json.dumps({**GOOD, "event_id": "e9"}))])
    assert replay.replay(spark, store, fix) == 1  # offset 2 is landed already
    assert replay.replay(spark, store, fix) == 0
    assert ids(spark, store) == ["e1", "e2"]
    assert sorted((r.offset, r.replay) for r in replay.status(spark, store).collect()) == [(1, 2), (2, 1), (3, None)]


@pytest.mark.parametrize("table", ["orders", "replayed", "ingest_stats"])
def test_a_failed_replay_is_done_again(spark, tmp_dir, monkeypatch, table):
    store = store_of(spark, tmp_dir, table)
    letters(spark, store, 0, [(1, json.dumps(GOOD))])
    real = TierStore.land

    def fails(self, df, name, run, batch):
        if name == table:
            raise RuntimeError("lost")
        real(self, df, name, run, batch)

    with monkeypatch.context() as m:
        m.setattr(TierStore, "land", fails)
        with pytest.raises(RuntimeError):
            replay.replay(spark, store)
    assert replay.status(spark, store).filter("replay IS NOT NULL").count() == 0
    assert replay.replay(spark, store) == 1 and replay.replay(spark, store) == 0
    assert ids(spark, store) == ["e1"]


def test_a_replayed_batch_is_refreshed(spark, tmp_dir):
    from tierline.plans.refresh import new_batches, run_refresh
    store = store_of(spark, tmp_dir)
    letters(spark, store, 0, [(1, json.dumps(GOOD))])
    replay.replay(spark, store)
    assert new_batches(spark, store) == [("replay", 1)]
    run_refresh(spark, store, "2024-01-31", steps=("silver", "quality", "gold"), incremental=True)
    assert [r.event_id for r in store.read(spark, "silver", "clean_events").collect()] == ["e1"]
    assert new_batches(spark, store) == []


def test_orders_and_empty(spark, tmp_dir):
    store = store_of(spark, tmp_dir)
    assert replay.replay(spark, store) == 0 and replay.status(spark, store).count() == 0
    assert ingest.batch_stats is not None


def test_variant_paths_from_shredded_parquet(spark, tmp_dir):
    from helpers import bronze_events, ev
    from tierline.operators import silver, variants
    texts = ['{"k": 5, "page": {"section": "a"}}', '{"k": "x"}', "not json", None, '{"page": {"section": 7}}', "[1]", '{"k": 12345678901}']
    clean = silver.clean_events(bronze_events(spark, [ev(f"e{i}", metadata=t) for i, t in enumerate(texts)]), "2024-01-31")
    path = os.path.join(tmp_dir, "v")
    variants.event_variants(clean).repartition(1).write.parquet(path)
    got = variants.metadata_paths(spark.read.parquet(path), {"k": ("$.k", "long"), "section": ("$.page.section", "string")})
    assert {r.event_id: (r.k, r.section) for r in got.collect()} == {
        "e0": (5, "a"), "e1": (None, None), "e2": (None, None), "e3": (None, None), "e4": (None, "7"), "e5": (None, None),
        "e6": (12345678901, None)}
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "metadata_variant:struct<" in plan  # the paths' own columns, not the whole value
