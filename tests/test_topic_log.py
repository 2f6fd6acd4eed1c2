"""The replayable topic source: each offset once, over restarts, limits and failures."""

import json
import os
from datetime import datetime

import pytest

from tierline.sources import topic_log as tl


def records(spark, rows):
    return spark.createDataFrame([(t, p, o, datetime(2024, 1, 1), f"{t}-{p}-{o}") for t, p, o in rows], tl.SCHEMA)


def run(spark, path, ckpt, out, most=None):
    stream = tl.read_stream(spark, path, ckpt, most)
    return stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", ckpt).trigger(availableNow=True).start()


def test_restarts_from_one_checkpoint_read_each_offset_once(spark, tmp_dir):
    path, ckpt, out = (os.path.join(tmp_dir, n) for n in ("log", "ckpt", "out"))
    want = []
    for piece in range(3):  # two restarts; a new topic partition appears, offsets have gaps
        rows = [(t, p, 10 * piece + o) for t in ("raw.events", "raw.orders") for p in range(piece + 1) for o in (0, 1, 5, 9)]
        tl.append(records(spark, rows), path)
        want += rows
        run(spark, path, ckpt, out).awaitTermination()
        got = sorted((r.topic, r.partition, r.offset) for r in spark.read.parquet(out).collect())
        assert got == sorted(want)
    run(spark, path, ckpt, out).awaitTermination()  # nothing new
    assert spark.read.parquet(out).count() == len(want)
    assert all(r.value == f"{r.topic}-{r.partition}-{r.offset}" for r in spark.read.parquet(out).collect())
    assert tl.read(spark, path).count() == len(want)


def test_a_limit_is_a_rate_and_survives_restarts(spark, tmp_dir):
    path, ckpt, out = (os.path.join(tmp_dir, n) for n in ("log", "ckpt", "out"))
    rows = [("t", p, o) for p, n in ((0, 90), (1, 10)) for o in range(n)]
    tl.append(records(spark, rows), path)
    run(spark, path, ckpt, out, 20).awaitTermination()
    assert spark.read.parquet(out).groupBy("partition").count().orderBy("partition").collect() == [(0, 18), (1, 2)]
    runs = tl.drain(lambda: run(spark, path, ckpt, out, 20), ckpt, path)
    assert runs == 4
    assert sorted((r.topic, r.partition, r.offset) for r in spark.read.parquet(out).collect()) == sorted(rows)


def test_a_failed_batch_is_read_again_as_it_was(spark, tmp_dir):
    """Fails once in the sink; more is appended before the restart."""
    path, ckpt = os.path.join(tmp_dir, "log"), os.path.join(tmp_dir, "ckpt")
    tl.append(records(spark, [("t", 0, o) for o in range(5)]), path)
    seen = []

    def sink(df, batch):
        seen.append((batch, sorted(r.offset for r in df.collect())))
        if len(seen) == 1:
            raise RuntimeError("lost")

    def start():
        return tl.read_stream(spark, path).writeStream.foreachBatch(sink).option("checkpointLocation", ckpt).trigger(availableNow=True).start()

    with pytest.raises(Exception):
        start().awaitTermination()
    tl.append(records(spark, [("t", 0, o) for o in range(5, 8)]), path)
    for _ in range(2):  # the failed batch, then what came since
        start().awaitTermination()
    assert seen == [(0, [0, 1, 2, 3, 4]), (0, [0, 1, 2, 3, 4]), (1, [5, 6, 7])]


def test_admitted_is_dealt_by_what_is_left():
    assert tl.admitted({}, {"a": 10, "b": 0}, None) == {"a": 10}
    assert tl.admitted({"a": 4}, {"a": 10, "b": 1000}, 100) == {"a": 5, "b": 99}
    assert tl.admitted({"a": 10}, {"a": 10}, 5) == {"a": 10}
    assert tl.admitted({"a": 12}, {"a": 10}, 5) == {"a": 12}  # never back


def test_an_ingest_from_the_log(spark, tmp_dir):
    """The log feeds the ingest query, which lands raw rows and dead letters."""
    from tierline.sources.tables import TierStore
    from tierline.streaming import ingest
    path, ckpt = os.path.join(tmp_dir, "log"), os.path.join(tmp_dir, "ckpt")
    good = {"event_id": "e1", "event_type": "click", "user_id": "u", "session_id": "s", "page": "/", "timestamp": "2024-01-01T00:00:00"}
    values = [json.dumps(good), "no json", json.dumps({**good, "event_id": "e2"})]
    rows = [("raw.events", 0, i, datetime(2024, 1, 1), v) for i, v in enumerate(values)]
    tl.append(spark.createDataFrame(rows, tl.SCHEMA), path)
    store = TierStore(os.path.join(tmp_dir, "lake"))
    store.bootstrap(spark)
    for _ in range(2):
        source = ingest.read_topics(spark, "log", path, checkpoint=ckpt, max_offsets_per_trigger=100)
        ingest.start_ingest(source, store, ckpt, available_now=True).awaitTermination()
    assert sorted(r.event_id for r in store.read(spark, "bronze", "events").collect()) == ["e1", "e2"]
    assert [r.offset for r in store.read(spark, "bronze", "dead_letter").collect()] == [1]


def test_an_empty_log(spark, tmp_dir):
    path = os.path.join(tmp_dir, "none")
    assert tl.read(spark, path).count() == 0 and tl.Log(path).ends() == {}
