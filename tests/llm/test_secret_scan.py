import random
import re

import numpy as np

from tierline.llm import secret_scan as ss

ASSIGN = re.compile(r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]"
                    r"|[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")


def brute(text):
    text = text or ""
    spans = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    spans += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    spans += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    return ",".join(f"{ss.KINDS[k]}:{s}:{e}" for s, k, e in sorted(spans))


def test_base_spans_equal_the_definition(make):
    rng = random.Random(9)
    parts = ["password", "Token", "api_key", "APIKEY", ":", "=", " ", '"', "AKIA", "AKIAABCDEFGHIJKLMN", "0123456789abcdef",
             "deadbeefdeadbeefdeadbeef", "secret", "é", "x", "Zx9+/=", "abcdefghijkl", "\n", "漢"]
    texts = [None, "", "token: secret: abcdefghijklmnop", "AKIAAKIA" + "B" * 14]
    texts += ["".join(rng.choice(parts) for _ in range(rng.randint(0, 20))) for _ in range(300)]
    rows = {r.doc_id: r for r in ss.scan(make(texts, more="spans long, base int, kind string")).collect()}
    for i, t in enumerate(texts):
        assert rows[i].base == brute(t)
        base = brute(t).split(",") if brute(t) else []
        assert set(base) <= set(rows[i].spans.split(",")) if base else True
        assert [rows[i].n_assign, rows[i].n_access, rows[i].n_hex] == [sum(b.startswith(k) for b in base) for k in ss.KINDS[:3]]


B62 = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
ALPHABETS = {"base62": B62, "lower36": B62[26:], "upper": B62[:26], "HEX": "0123456789ABCDEF"}
NAMES = ["internationalization", "get_user_account_by_id", "CustomerAddressRepository", "maximum_connection_timeout",
         "authorization_handler_factory", "configuration_parameter"]


def key(rng, n=32, alphabet=B62):
    return "".join(rng.choice(alphabet) for _ in range(n))


def brute_spans(text, model):
    """All spans, one run and one segment after the other."""
    covered = set()
    for part in filter(None, brute(text).split(",")):
        _, s, e = part.split(":")
        covered |= set(range(int(s), int(e)))
    plain = "".join("\0" if i in covered else c for i, c in enumerate(text))
    found = []
    for run in re.finditer(r"[A-Za-z0-9+/_=-]+", plain):
        held = []
        for seg in [*re.finditer(r"[A-Za-z0-9]+", run[0]), None]:
            if seg is not None and len(seg[0]) < 8:
                continue
            if seg is not None and model.score(seg[0].encode()) >= model.least:
                held.append(seg)
                continue
            if held:
                s, e = held[0].start(), held[-1].end()
                if sum(c.isalnum() for c in run[0][s:e]) >= 16:
                    found.append((run.start() + s, 3, run.start() + e))
            held = []
    base = [(int(s), ss.KINDS.index(k), int(e)) for k, s, e in (x.split(":") for x in filter(None, brute(text).split(",")))]
    return ",".join(f"{ss.KINDS[k]}:{s}:{e}" for s, k, e in sorted(base + found))


def learning_texts(rng):
    return [f"token = {key(rng)} {rng.choice(NAMES)} and {rng.choice(NAMES)}" for _ in range(200)]


def test_models_find_random_keys_and_leave_identifiers(make):
    rng = random.Random(10)
    model = ss.fit(make(learning_texts(rng)))
    fresh = [key(rng) for _ in range(200)]
    assert sum(model.score(k.encode()) >= model.least for k in fresh) > 190
    got = ss.scan(make([f"see {fresh[0]} here é {fresh[1]}"]), model).collect()[0]
    assert got.base == "" and got.spans == "random:4:36,random:44:76"
    for name in NAMES + ["international_conference_calls", "UserAccountConfiguration", "handler_for_customer_addresses"]:
        assert ss.scan(make([name]), model).collect()[0].spans == ""


def test_added_spans_equal_a_plain_scan(make):
    rng = random.Random(12)
    model = ss.fit(make(learning_texts(rng)))
    seps = [" ", "=", "/", "_", "-", "+", "==", "\n", "é", ".", "漢", ""]
    pieces = lambda: rng.choice([key(rng, rng.choice([3, 8, 20, 40]), rng.choice(list(ALPHABETS.values()))), rng.choice(NAMES),
                                 "password=" + key(rng, 14), "0123456789abcdef", "id", "client_name", ""])
    texts = [None, ""] + ["".join(pieces() + rng.choice(seps) for _ in range(rng.randint(1, 9))) for _ in range(300)]
    rows = {r.doc_id: r for r in ss.scan(make(texts), model).collect()}
    assert sum("random" in r.spans for r in rows.values()) > 50
    for i, t in enumerate(texts):
        assert rows[i].spans == brute_spans(t or "", model), t


def test_recall_on_the_corpus_models(spark):
    """Trained on real rows: fresh keys of alphabets that no labelled sample has, alone, behind a name and in
    a path; and ordinary runs of all the documents."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = ss.fit(docs)
    rng = random.Random(13)
    for name, alphabet in ALPHABETS.items():
        for n in (20, 32, 40):
            keys = [key(rng, n, alphabet) for _ in range(500)]
            texts = [f"{k} client_name={k} /path/of/{k}/file" for k in keys]
            data = np.frombuffer("\n".join(texts).encode(), np.uint8)
            codes = ss._CODE[data]
            spans = {(s, e) for s, e in ss.added_spans(model, codes, np.ones(len(data), bool), np.array([0, len(data)]))}
            whole = data.tobytes()
            hits = sum(whole[s:e].decode() in set(keys) for s, e in spans)
            assert hits >= 0.9 * 3 * len(keys), (name, n, hits)
    added = [x for r in ss.scan(docs, model).collect() for x in r.spans.split(",") if x.startswith("random")]
    assert len(added) <= 2  # of some 160 ordinary runs of this length


def test_without_labelled_secrets_and_empty(make):
    docs = make(["only ordinary_words_of_some_length here", None])
    assert ss.fit(docs) is None
    assert {r.spans for r in ss.scan(docs).collect()} == {""}
    assert ss.scan(docs.limit(0)).count() == 0


def test_runs_end_at_documents_and_long_text(make):
    docs = make(["A1b2" * 3, "C3d4" * 3, "x" * 300_000 + " 0123456789abcdef"])
    got = {r.doc_id: r.base for r in ss.scan(docs).collect()}
    assert got == {0: "", 1: "", 2: "hex:300001:300017"}
