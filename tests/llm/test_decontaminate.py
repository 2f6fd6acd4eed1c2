import random
import re

import pytest

from tierline.llm import decontaminate as dc

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, window=10):
    wins = set()
    for name, text in items:
        w = words(text)
        for i in range(max(len(w) - window, 0) + 1) if w else ():
            wins.add((str(name) if name is not None else "null", tuple(w[i:i + window])))
    out = []
    for doc_id, text in docs:
        w, hit, names = words(text), set(), set()
        for name, win in wins:
            for p in range(len(w) - len(win) + 1):
                if tuple(w[p:p + len(win)]) == win:
                    hit |= set(range(p, p + len(win)))
                    names.add(name)
        out.append((doc_id, len(w), len(hit), sorted(names), bool(hit)))
    return sorted(out, key=repr)


def rows(df):
    return sorted(((r.doc_id, r.n_words, r.n_hit, list(r["items"]), r.contaminated) for r in df.collect()), key=repr)


def test_equals_brute_force_on_random_texts(spark, make):
    rng = random.Random(1)
    vocab = ["a", "B", "c9", "é", "dd"]
    text = lambda n: rng.choice([" ", "-", "\n"]).join(rng.choice(vocab) for _ in range(n))
    items = [(i, text(rng.choice([1, 2, 4, 5, 9]))) for i in range(12)] + [(3, text(6)), (None, text(5)), (77, ""), (78, None)]
    docs = [(i, text(rng.randint(0, 60))) for i in range(40)] + [(40, None), (41, ""), (41, "a a a a a"), (None, "a B c9")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    for block in (1 << 20, 40):  # all in one block, and several
        got = rows(dc.locate(make(docs), bench, window=4, block_bytes=block))
        assert got == brute(docs, items, 4)


def test_longest_match_and_place(spark, make):
    passage = "one two three four five six seven eight nine ten eleven twelve"
    bench = spark.createDataFrame([(5, "x " + passage), (6, passage.upper() + " y")], "item_id long, text string")
    got = dc.locate(make(["zero, " + passage + " end"]), bench).collect()[0]
    assert [tuple(m) for m in got.matches] == [("5", 1, 1, 12), ("6", 1, 0, 12)]
    assert [tuple(s) for s in got.spans] == [(1, 13)]


def test_remove_keeps_other_columns_and_empty_inputs(spark, make):
    text = "this passage has more than ten words so it is one window long"
    docs = make([text, "clean words", None], more="n_words long, items string, spans long, _row long", value=None)
    bench = spark.createDataFrame([(1, text)], "item_id long, text string")
    kept = dc.remove(docs, bench)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 2]
    none = bench.limit(0)
    assert dc.remove(docs, none).count() == 3
    assert dc.locate(docs.limit(0), bench).count() == 0


def test_suffix_search_against_a_long_document(spark, make):
    rng = random.Random(3)
    long = " ".join(rng.choice("abcdefgh") + rng.choice("xyz") for _ in range(30000))
    w = long.split()
    items = [(i, " ".join(w[p:p + 14])) for i, p in enumerate(rng.sample(range(29000), 20))]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = rows(dc.locate(make([long]), bench))
    assert got[0][3] == sorted(str(i) for i, _ in items)


@pytest.mark.parametrize("after", [False, True])
def test_bisect(after):
    import numpy as np
    keys = np.array([[1, 1], [1, 2], [1, 2], [3, 0]])
    want = np.array([[0, 9], [1, 2], [2, 0], [3, 0], [4, 0]])
    assert dc.bisect(keys, want, after).tolist() == ([0, 3, 3, 4, 4] if after else [0, 1, 3, 3, 4])


def test_remove_decides_by_row_not_by_id(spark, make):
    text = "this passage has more than ten words so it is one window long"
    docs = make([(1, text), (1, "clean one"), (None, "also " + text), (None, "clean two"), (None, None), (2, "clean three")],
                more="_row_number int, _bad_id long")
    kept = dc.remove(docs, spark.createDataFrame([(1, text)], "item_id long, text string"))
    assert kept.columns == docs.columns
    got = sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr)
    assert got == sorted([(1, "clean one"), (None, "clean two"), (None, None), (2, "clean three")], key=repr)
