import numpy as np
from pyspark.sql import functions as F

from tierline.llm import language_id as li
from tierline.llm.common import hash_mod

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    found = li.op5_language_id(spark, SF).join(docs.select("doc_id", "lang"), "doc_id")
    held = found.filter("held_out").select(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert held[0] > 0.97 and held[1] > 150
    assert found.filter("score < 0 OR score > 1").count() == 0
    assert found.count() == docs.count()


def test_predictions_never_see_label_or_id(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = li.fit(docs.filter(hash_mod(F.col("doc_id"), 5) != 0))
    a = {r.doc_id: r.lang_pred for r in li.predict(docs, model).collect()}
    other = docs.withColumn("lang", F.lit("xx")).withColumn("doc_id", F.col("doc_id") + 100000)
    b = {r.doc_id - 100000: r.lang_pred for r in li.predict(other, model).collect()}
    assert a == b


def test_rejects_foreign_text_and_keeps_known(spark, make):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    strange = make([(900001, "Привет мир, это русский текст о погоде"), (900002, "这是一个中文句子"), (900003, None),
                    (900004, "12 34 !!"), (900005, "")], lang=None)
    kept = li.keep_known(docs.unionByName(strange))
    assert kept.columns == docs.columns
    ids = {r.doc_id for r in kept.select("doc_id").collect()}
    assert not ids & {900001, 900002, 900003, 900004, 900005}
    assert len(ids) >= 0.995 * docs.count()


def test_no_letter_no_label_and_extra_columns(make):
    docs = make([(0, None), (1, ""), (2, "123 ..."), (3, "the words of a text"), (3, "the words of a text")],
                more="lang_pred string, score double, rejected string, at long")
    got = sorted((r.doc_id, r.lang_pred) for r in li.predict(docs, li.fit(docs)).collect())
    assert got == [(0, "und"), (1, "und"), (2, "und"), (3, "en"), (3, "en")]
    none = docs.withColumn("lang", F.lit(None).cast("string"))
    assert li.fit(none) is None
    assert {r.lang_pred for r in li.predict(docs, None).collect()} == {"und"}
    assert li.predict(docs.limit(0), None).count() == 0


def test_clusters_and_long_text(make):
    v = np.eye(4, dtype=np.float32)
    assert len(li.cluster(v, 3)) == 3 and len(li.cluster(v[:1], 3)) == 1
    docs = make([(i, "the words of a text " * n) for i, n in enumerate((1, 20000))])
    assert {r.lang_pred for r in li.predict(docs, li.fit(docs)).collect()} == {"en"}


def test_sample_vectors_hold_counts_of_one_text_at_a_time():
    import tracemalloc

    rng = np.random.default_rng(3)
    texts = [bytes(rng.choice(list(b"abcdefghij klmno"), rng.integers(0, 400)).tolist()) for _ in range(300)] + [b""]
    data, off = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0] + [len(t) for t in texts])
    idf = (rng.random(li.DIMS) * 8).astype(np.float32)
    counts = np.stack([li.term_counts(np.frombuffer(t, np.uint8)) for t in texts])
    tracemalloc.start()
    v, reach = li.sample_vectors(data, off, idf)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert np.array_equal(v, li.unit(counts, idf)) and np.array_equal(reach, li.length_share(counts))
    assert peak < 1.3 * v.nbytes
