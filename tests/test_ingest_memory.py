"""A micro-batch is kept on disk while it is split."""

import os
from datetime import datetime

from tierline.sources.tables import TierStore
from tierline.streaming import ingest


def test_a_batch_is_not_held_in_memory(spark, tmp_dir, monkeypatch):
    store, held, real = TierStore(os.path.join(tmp_dir, "lake")), [], TierStore.land
    store.bootstrap(spark)

    def land(self, df, table, run, batch):
        real(self, df, table, run, batch)
        held.extend((i.memSize(), i.diskSize()) for i in spark.sparkContext._jsc.sc().getRDDStorageInfo())

    monkeypatch.setattr(TierStore, "land", land)
    value = '{"event_id":"e%d","event_type":"click","user_id":"u1","session_id":"s","page":"/","timestamp":"2024-01-02T00:00:00"}'
    rows = [("raw.events", 0, i, datetime(2024, 1, 2), value % i if i else "no json") for i in range(20)]
    ingest.write_batch(spark.createDataFrame(rows, ingest.TOPIC_SCHEMA), 0, store, "run")
    assert sum(m for m, _ in held) == 0 < sum(d for _, d in held)
    assert [r.value for r in store.read(spark, "bronze", "dead_letter").collect()] == ["no json"]
    assert store.read(spark, "bronze", "events").count() == 19
