import hashlib
import random

import pytest

from tierline.llm import bpe_tree as bt

POOLS = ["ab", "a", "abc '", "theandin'sre !?12 ", "éèñ漢字ab 한", "aǍJ̌ İ\n\t'", "!?'sdt", "\U0001F600\U0001F468‍ a", "0123 abc"]


@pytest.fixture(scope="module")
def encoder():
    return bt.Encoder(bt.tokenizer_json())


def test_tree_equals_whole_encoding(encoder):
    rng = random.Random(5)
    for _ in range(4000):
        pool = rng.choice(POOLS)
        text = "".join(rng.choice(pool) for _ in range(rng.randint(0, 300)))
        if rng.random() < .1:
            text = text[:30] + "<|endoftext|>" + text[30:] + "<|startoftext|>"
        want = encoder.whole.encode(text, add_special_tokens=False).ids
        assert bt.encode_long(encoder, text, rng.choice([3, 8, 20, 64]), rng.choice([1, 2, 4, 16])) == want, repr(text)


def test_long_unsplit_words(encoder):
    rng = random.Random(6)
    for pool in ("ab", "abcdefgh", "a", "!?", "the"):
        text = "".join(rng.choice(pool) for _ in range(20000))
        want = encoder.whole.encode(text, add_special_tokens=False).ids
        assert bt.encode_long(encoder, text, 1000, 16) == want


def test_rows_long_and_short(make, encoder):
    rng = random.Random(7)
    texts = [None, "", " \n ", "Hello World", "Hello World", "<|endoftext|>"]
    texts += ["".join(rng.choice(p) for _ in range(n)) for p in POOLS for n in (50, 900)]
    docs = [(i, t) for i, t in enumerate(texts)] + [(3, "x" * 700), (None, "y " * 600), (3, "x" * 700)]
    frame = make(docs, more="row long, at int, ids string, section int, text2 string")
    got = sorted(((r.doc_id, list(r.ids), r.decoded) for r in bt.encode(frame, long_chars=400, leaf_chars=60).collect()), key=repr)
    want = []
    for d, t in docs:
        ids = encoder.whole.encode(t or "", add_special_tokens=False).ids
        want.append((d, ids, encoder.whole.decode(ids, skip_special_tokens=False)))
    assert got == sorted(want, key=repr)


def test_digests_are_those_of_ids_and_text(make):
    texts = [None, "", "Hello  World", "a\x1c b\x85 ́", "y " * 300, "<|endoftext|> x"]
    plain = {r.doc_id: r for r in bt.encode(make(texts), long_chars=200, leaf_chars=60).collect()}
    for r in bt.encode(make(texts), long_chars=200, leaf_chars=60, digests=True).collect():
        p = plain[r.doc_id]
        assert r.n_tokens == p.n_tokens == len(p.ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, p.ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(p.decoded.encode()).hexdigest()


def test_cache_is_bounded(encoder, monkeypatch):
    monkeypatch.setattr(bt, "CACHE_PIECES", 3)
    text = " ".join(f"word{i % 7}" for i in range(40))
    (ids, decoded), = encoder.encode_texts([text])
    want = encoder.whole.encode(text, add_special_tokens=False).ids
    assert [i for own in ids for i in own] == want
    assert " ".join(decoded) == encoder.whole.decode(want, skip_special_tokens=False)


def test_frequent_pieces_outlive_the_bound(monkeypatch):
    monkeypatch.setattr(bt, "CACHE_PIECES", 8)
    own, encoded = bt.Encoder(bt.tokenizer_json()), []

    class Counted:
        def __getattr__(self, name):
            return getattr(whole, name)

        def encode_batch_fast(self, pieces, **kw):
            encoded.extend(pieces)
            return whole.encode_batch_fast(pieces, **kw)

    whole, own.whole = own.whole, Counted()
    for i in range(40):  # each text has the same piece and two new ones
        (ids, _), = own.encode_texts([f"the n{i} m{i}"])
        assert [k for part in ids for k in part] == whole.encode(f"the n{i} m{i}", add_special_tokens=False).ids
        assert len(own.seen) <= 8 and len(own.older) <= 8
    assert encoded.count("the") == 1 and len(encoded) == 81


def test_characters_of_the_pieces_are_bounded(monkeypatch):
    monkeypatch.setattr(bt, "CACHE_PIECES", 8)
    own = bt.Encoder(bt.tokenizer_json())
    for i in range(20):  # 82 characters a piece and more, where 8 pieces may have 128 together
        text = "long" * 20 + f"w{i}"
        (ids, _), = own.encode_texts([text])
        assert [k for part in ids for k in part] == own.whole.encode(text, add_special_tokens=False).ids
        assert len(own.seen) <= 1 and len(own.older) <= 1


def test_a_caller_can_have_fewer_pieces_remembered(make):
    own = bt.Encoder(bt.tokenizer_json(), pieces=4)
    for i in range(20):
        text = f"the n{i} m{i} the"
        (ids, decoded), = own.encode_texts([text])
        want = own.whole.encode(text, add_special_tokens=False).ids
        assert [k for part in ids for k in part] == want and " ".join(decoded) == own.whole.decode(want)
        assert len(own.seen) <= 4 and len(own.older) <= 4
    texts = [None, "", "one two three four five six", "one 12345 one", "ab " * 300]
    rows = lambda **kw: sorted((r.doc_id, list(r.ids), r.decoded)
                               for r in bt.encode(make(texts), long_chars=200, leaf_chars=60, **kw).collect())
    assert rows(pieces=2) == rows()


def test_leaves_and_joins_keep_their_tasks(make):
    """Adaptive execution must not coalesce the few bytes of the leaves into one task."""
    frame = bt.encode(make(["ab " * 300, "cd" * 400, "e"]), long_chars=200, leaf_chars=60)
    assert len(frame.collect()) == 3
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert plan.count("REPARTITION_BY_NUM") >= 2 and "ENSURE_REQUIREMENTS" not in plan


def test_a_worker_loads_the_tokenizer_once(monkeypatch):
    """Not twice a task: the second tokenizer is only for parts of long texts, and later tasks find the first."""
    import tokenizers

    loads = []

    class Counted:
        @staticmethod
        def from_str(content):
            loads.append(content)
            return real.from_str(content)

    real = tokenizers.Tokenizer
    monkeypatch.setattr(tokenizers, "Tokenizer", Counted)
    bt.worker_encoder.cache_clear()
    content = bt.tokenizer_json()
    for _ in range(3):  # three tasks
        bt.worker_encoder("".join([content]), True).encode_texts(["ab cd"])
    assert len(loads) == 1
    for _ in range(2):
        assert bt.worker_encoder(content, True).tokens("ab cd")
    assert len(loads) == 2


def test_empty_table(make):
    assert bt.encode(make(["a"]).limit(0)).count() == 0
