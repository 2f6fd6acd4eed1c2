import random

from tierline.llm import token_counts as tc


def tokenizer(vocabulary):
    from tokenizers import Tokenizer, models

    full = [("<unk>", 0.0), *vocabulary, *((f"<0x{i:02X}>", 0.0) for i in range(256))]
    return Tokenizer(models.Unigram(full, unk_id=0, byte_fallback=True))


def marked(text):
    return "▁" + text.replace(" ", "▁")


def test_counts_equal_the_unigram_tokenizer():
    vocabulary = tc.load_vocabulary()
    exact, viterbi = tokenizer(vocabulary), tc.CountViterbi(vocabulary)
    rng = random.Random(7)
    pools = ["abc the in", "a  b", "éñ漢\U0001F9FF x", "the\nof\tand ▁", "internationalization 0123"]
    for _ in range(4000):
        text = "".join(rng.choice(rng.choice(pools)) for _ in range(rng.randint(1, 60)))
        assert viterbi.text(text)[1] == len(exact.encode(marked(text)).ids), repr(text)


def test_ties_go_to_the_piece_that_starts_first():
    # ab + c and a + bc cost the same, abc as three too
    vocabulary = [("a", -1.0), ("b", -1.0), ("c", -1.0), ("ab", -2.0), ("bc", -2.0), ("▁", -1.0)]
    exact, viterbi = tokenizer(vocabulary), tc.CountViterbi(vocabulary)
    rng = random.Random(8)
    for _ in range(500):
        text = "".join(rng.choice("abc ") for _ in range(rng.randint(1, 12)))
        assert viterbi.text(text)[1] == len(exact.encode(marked(text)).ids), text


def test_whole_text_search_where_pieces_cross_blanks():
    vocabulary = [("a", -1.0), ("b", -1.0), ("▁", -1.0), ("a▁b", -1.5)]
    viterbi = tc.CountViterbi(vocabulary)
    assert not viterbi.splits
    assert viterbi.text("a b") == (-2.5, 2)


def test_rows(make):
    docs = make([(0, None), (1, ""), (2, "the house"), (2, "the house"), (3, "x" * 200_000)], more="n_tokens long, score string")
    got = sorted((r.doc_id, r.n_tokens) for r in tc.count_tokens(docs).collect())
    assert got[0] == (0, 0) and got[1] == (1, 0) and got[2] == got[3] and got[2][1] > 0
    assert tc.count_tokens(docs.limit(0)).count() == 0


def test_cache_is_bounded(monkeypatch):
    vocabulary = tc.load_vocabulary()
    monkeypatch.setattr(tc, "CACHE_WORDS", 4)
    small, large = tc.CountViterbi(vocabulary), tc.CountViterbi(vocabulary)
    text = " ".join(f"w{i % 9}" for i in range(50))
    a = small.text(text)
    assert len(small.seen) <= 4
    monkeypatch.setattr(tc, "CACHE_WORDS", 1 << 18)
    assert a == large.text(text)
