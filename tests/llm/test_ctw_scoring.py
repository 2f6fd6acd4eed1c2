import collections
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tierline.llm import ctw_scoring as ctw


def kt(a, b):
    return math.lgamma(a + .5) + math.lgamma(b + .5) - math.lgamma(a + b + 1) - math.log(math.pi)


def brute_model(texts, depth):
    """Counts of every node, by definition: (context, bit prefix) -> [zeros, ones]."""
    counts = collections.defaultdict(lambda: [0, 0])
    for t in texts:
        s = [255] * depth + list(b" ".join((t or "").encode().lower().split())) + [255]
        for i in range(depth, len(s)):
            bits = f"{s[i]:08b}"
            for d in range(depth + 1):
                for k in range(8):
                    counts[tuple(s[i - d:i]), bits[:k]][int(bits[k])] += 1
    return counts


def brute_score(counts, text, depth):
    below = collections.defaultdict(list)
    for ctx, prefix in counts:
        if ctx:
            below[ctx[1:], prefix].append(ctx)
    memo = {}

    def pw(ctx, prefix):
        if (ctx, prefix) not in memo:
            own = kt(*counts[ctx, prefix])
            memo[ctx, prefix] = own if len(ctx) == depth else np.logaddexp(
                own, sum(pw(c, prefix) for c in below[ctx, prefix])) - math.log(2)
        return memo[ctx, prefix]

    def p(s, i, d, prefix, bit):
        ctx = tuple(s[i - d:i])
        a, b = counts[ctx, prefix]
        own = ((b if bit else a) + .5) / (a + b + 1)
        deeper = tuple(s[i - d - 1:i])
        if d == depth or (deeper, prefix) not in counts:
            return own
        w = math.exp(kt(a, b) - math.log(2) - pw(ctx, prefix))
        return w * own + (1 - w) * p(s, i, d + 1, prefix, bit)

    s = [255] * depth + list(b" ".join((text or "").encode().lower().split())) + [255]
    total = 0.0
    for i in range(depth, len(s)):
        bits = f"{s[i]:08b}"
        for k in range(8):
            total += math.log10(p(s, i, 0, bits[:k], int(bits[k])) if ((), bits[:k]) in counts else .5)
    return total


@pytest.mark.parametrize("depth", [1, 2, 4])
def test_score_equals_the_definition(make, depth):
    texts = ["the cat sat", "The  hat\non the cat", "a cat, a hat; été", None, "", "zzz the qqq", "the cat sat"]
    docs = make(texts, more="held_out string, words long, block int, score string")
    got = {r.doc_id: r for r in ctw.score(docs, F.col("doc_id") == 5, depth=depth).collect()}
    train = [t for i, t in enumerate(texts) if i != 5]
    counts = brute_model(train, depth)
    words = collections.Counter(w for t in train for w in (t or "").encode().lower().split())
    total, kinds = sum(words.values()) + len(train), len(words) + 1
    for i, t in enumerate(texts):
        assert got[i].score == pytest.approx(brute_score(dict(counts), t, depth), rel=1e-9)
        own = (t or "").encode().lower().split()
        c = [words[w] for w in own] + [len(train)]
        assert (got[i].n_tokens, got[i].n_known, got[i].train_tokens) == (len(c), sum(x > 0 for x in c), total)
        assert got[i].base_score == pytest.approx(sum(math.log10((x + 1) / (total + kinds + 1)) for x in c))


def test_probabilities_sum_to_one(make):
    tree = ctw.train(make(["some text to learn", "and some more"]), depth=2)
    grams = (np.uint64(0x736F) << np.uint64(8)) | np.arange(256, dtype=np.uint64)
    assert (10 ** tree.log10(grams)).sum() == pytest.approx(1)


def test_held_out_text_of_the_language_scores_above_noise(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = ctw.op7_ctw_scoring(spark, sf).collect()
    assert len(rows) == docs.count()
    held = [r for r in rows if r.held_out]
    bits = sum(r.bits_per_byte for r in held) / len(held)
    assert len(held) > 100 and bits < 2.5


def test_no_training_and_empty(make):
    docs = make(["ab", None])
    got = sorted((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score)
                 for r in ctw.score(docs, F.lit(True), depth=2).collect())
    assert got == [(0, 2, 0, 0, 0.0, pytest.approx(24 * math.log10(.5))), (1, 1, 0, 0, 0.0, pytest.approx(8 * math.log10(.5)))]
    assert ctw.score(docs.limit(0), F.lit(False), depth=2).count() == 0


def test_groups_in_small_pieces_answer_alike(make, monkeypatch):
    """Groups weighed one by one, and asked grams that stream past in several rounds."""
    texts = ["the cat sat on the mat " * 3, "a mat the cat", None, "", "other words", "the end"] * 4
    docs = make(texts).repartition(5)
    want = {(r.doc_id, r.score) for r in ctw.score(docs, F.col("doc_id") == 5).collect()}
    monkeypatch.setattr(ctw, "GROUP_ROWS", 3)
    docs.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4")
    try:
        got = {(r.doc_id, r.score) for r in ctw.score(docs, F.col("doc_id") == 5).collect()}
    finally:
        docs.sparkSession.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert {i: round(s, 8) for i, s in got} == {i: round(s, 8) for i, s in want}


def test_every_node_counts_with_the_production_parameters(make):
    """A table of hashed slots lost a tenth of the nodes and more."""
    import random
    rng = random.Random(5)
    vocab = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(150)]
    texts = [" ".join(rng.choice(vocab) for _ in range(30)) for _ in range(20)]
    got = {r.doc_id: r.score for r in ctw.score(make(texts), F.col("doc_id") >= 16).collect()}
    counts = dict(brute_model(texts[:16], ctw.DEPTH))
    for i in (0, 7, 16, 17, 18, 19):
        assert got[i] == pytest.approx(brute_score(counts, texts[i], ctw.DEPTH), rel=1e-9)
