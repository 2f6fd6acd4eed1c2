import random
import re

from pyspark.sql import functions as F

from tierline.llm import quality_ledger as q


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    seen = {}
    for i in range(len(words) - 4):
        seen.setdefault(tuple(words[i:i + 5]), []).append(i)
    covered = {p + k for v in seen.values() if len(v) > 1 for p in v for k in range(5)}
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered))


def test_measures_equal_brute_force(make):
    rng = random.Random(2)
    texts = [None, "", " \t\n", "a", "a a a a a a", "a b c d e", "x\n x\nx\r\nx", "é b  c", "!!! AB #|"]
    texts += ["".join(rng.choice("ab# \n") for _ in range(rng.randint(0, 80))) for _ in range(60)]
    docs = make(list(enumerate(texts)) + [(3, "a")], more="words string, h long, n_words long, lines string")
    got = sorted((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)
                 for r in q.measure(docs).collect())
    assert got == sorted((i, *brute(t)) for i, t in list(enumerate(texts)) + [(3, "a")])


def test_long_text(make):
    text = " ".join(str(i % 4000) for i in range(20000))
    r = q.measure(make([text])).collect()[0]
    assert (r.n_words, r.n_repeat_words) == (20000, 20000)


def test_ledger_policies_and_ablation(make):
    clean = " ".join(f"word{i}" for i in range(30))
    docs = make([clean, "few", "### " * 20, clean.upper()])
    rows = q.ledger(docs)
    fails = {r.doc_id: r.failures for r in rows.collect()}
    names = [n for n, _ in q.RULES]
    assert fails[0] == 0 and fails[1] == 1 << names.index("few_words")
    assert fails[3] == 1 << names.index("capitals") and fails[2] >> names.index("symbols") & 1
    kept = {r.doc_id: r.k for r in rows.select("doc_id", q.passes("v1").alias("k")).collect()}
    assert kept == {0: True, 1: False, 2: False, 3: True}
    table = {r.rule: (r.failed, r.only_this, r.kept_without) for r in q.ablation(rows, "v2").collect()}
    assert table["capitals"] == (1, 1, 2) and table["few_words"] == (1, 1, 2)
    assert table["digits"] == (0, 0, 1)


def test_plan_has_no_python(make):
    plan = q.ledger(make(["a"])).filter(F.col("failures") == 0)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_empty_table(make):
    docs = make(["a"]).limit(0)
    assert q.ledger(docs).count() == 0
    assert q.ablation(q.ledger(docs), "v2").count() == 0
