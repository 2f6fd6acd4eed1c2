import collections
import random

import numpy as np
import pytest

from tierline.llm import suffix_dedup as sd


def brute(docs, length):
    count = collections.Counter()
    for _, t in docs:
        x = (t or "").encode()
        count.update(x[i:i + length] for i in range(len(x) - length + 1))
    out = []
    for d, t in docs:
        x = (t or "").encode()
        gone = set()
        for i in range(len(x) - length + 1):
            if count[x[i:i + length]] > 1:
                gone |= set(range(i, i + length))
        spans = sum(1 for i in gone if i - 1 not in gone)
        out.append((d, len(x), spans, bytes(b for i, b in enumerate(x) if i not in gone)))
    return sorted(out, key=repr)


def rows(df):
    return sorted(((r.doc_id, r.n_bytes, len(r.removed), bytes(r.kept)) for r in df.collect()), key=repr)


@pytest.mark.parametrize("length,head,batches", [(20, 12, 3), (20, 5, 1), (9, 9, 4)])
def test_equals_brute_force(make, length, head, batches):
    rng = random.Random(length)
    word = lambda: "".join(rng.choice("abcé") for _ in range(rng.randint(1, 5)))
    passages = [" ".join(word() for _ in range(12)) for _ in range(4)]
    docs = []
    for i in range(40):
        parts = [word() for _ in range(rng.randint(0, 12))]
        if rng.random() < 0.6:
            p = rng.choice(passages)
            a = rng.randint(0, 10)
            parts.insert(rng.randint(0, len(parts)), p[a:a + rng.randint(5, len(p))])
        docs.append((i, " ".join(parts)))
    docs += [(40, None), (41, ""), (42, "a" * 60), (43, "ab" * 30), (44, "x" * length), (45, docs[3][1]),
             (7, docs[7][1]), (7, "another text under the same id " + passages[0]), (None, passages[1]), (None, passages[1])]
    got = rows(sd.remove_repeats(make(docs, more="version int, _ranges string, n long"), length, head, batches))
    assert got == brute(docs, length)


def test_rows_without_ids_and_many_equal_rows(make):
    rng = random.Random(11)
    text = lambda n: "".join(rng.choice("abcdefgh") for _ in range(n))
    shared = text(40)
    docs = [(None, text(30) + shared[i:i + 25] + text(20)) for i in range(12)]
    docs += [(5, shared + text(9)), (5, text(9) + shared), (6, text(50))]
    docs += [(i % 3 or None, "one " + shared + " text in many rows") for i in range(1000)]
    got = rows(sd.remove_repeats(make(docs, more="version int"), 20, 12, 2))
    assert got == brute(docs, 20)


def test_texts_under_one_id_whose_short_hash_is_equal_stay_apart(spark, make):
    """Two texts with one 32-bit hash under NULL: a key of that size would exchange their ranges."""
    from pyspark.sql import functions as F

    n = 300_000
    near = spark.range(n).select(F.format_string("%030d", "id").alias("t")).withColumn("h", F.hash("t"))
    pair = near.groupBy("h").agg(F.collect_list("t").alias("ts")).filter(F.size("ts") > 1).first()["ts"][:2]
    docs = [(None, pair[0]), (None, pair[1]), (1, "zz" + pair[0])]
    assert rows(sd.remove_repeats(make(docs), 30, 12, 2)) == brute(docs, 30)


def test_long_text_in_pieces(make, monkeypatch):
    monkeypatch.setattr(sd, "PIECE", 64)
    rng = random.Random(5)
    base = "".join(rng.choice("abcd") for _ in range(700))
    docs = [(0, base), (1, "zz" + base[100:400] + "yy"), (2, base[350:365] * 3)]
    got = rows(sd.remove_repeats(make(docs), 20, 12, 2))
    assert got == brute(docs, 20)


def test_family_levels_and_repeats_across_batches(spark):
    family = sd.SuffixFamily(spark)
    found = []
    for batch in ([1, 2, 2], [3, 1], [4], [5, 3, 9]):
        heads = spark.createDataFrame([(h, 1) for h in batch], "head long, places long")
        found.append(sorted(r.head for r in family.add(heads).collect()))
    assert found == [[2], [1], [], [3]]
    assert [len(x) for x in family.levels] == [0, 0, 1]


def test_minimum_is_leftmost_and_fingerprints_compare_content():
    values = np.array([5, 3, 3, 9, 1, 1], np.uint64)
    assert sd.leftmost_minimum(values, 3).tolist() == [1, 1, 4, 4]
    fp = sd.Fingerprints(64)
    data = np.frombuffer(b"hello world hello", np.uint8)
    pre = fp.prefix(data)
    a, b = fp.of(pre, np.array([0]), 5), fp.of(pre, np.array([12]), 5)
    assert a == b != fp.of(pre, np.array([1]), 5)


def test_empty_table(make):
    assert sd.remove_repeats(make(["a"]).limit(0)).count() == 0
