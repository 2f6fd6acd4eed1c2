"""Quality rules as a bitmask ledger, in DataFrame functions only.

Each text is measured once and every rule is evaluated once; the ledger keeps the
measurements and one ``failures`` mask (bit i: rule i fails).  A policy is a versioned mask of
the rules that count: a row passes it when none of the policy's bits is set.  Ablations (what
each rule removes, alone and together with others) are sums over the masks, so trying
another policy never touches a text again.

Words are runs of characters other than 20 and 09-0D (hex).  Cases: NULL and blank texts
have no word and fail the least-words rule.  Repeated rows each get a row.  Only doc_id and
text are read.  Windows of words are compared by 64-bit hash within one text, and by their
words where the hashes agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierline.llm.common import table

BLANKS = r"[\x20\x09-\x0D]+"
WINDOW_WORDS = 5

#: Rules in bit order: name and the condition that fails a text.
RULES: tuple[tuple[str, Column | str], ...] = (
    ("few_words", "n_words < 10"),
    ("repeated_words", "100 * n_repeat_words > 20 * n_words"),
    ("symbols", "10 * n_symbols > n_words"),
    ("duplicate_lines", "100 * n_dup_lines > 40 * n_lines"),
    ("capitals", "2 * n_capitals > n_letters"),
    ("exclamations", "5 * n_exclamations > n_words"),
    ("digits", "100 * n_digits > 50 * word_chars"),
    ("word_length", "word_chars < 2 * n_words OR word_chars > 15 * n_words"),
)
BASE = ("few_words", "repeated_words")


def mask(rules) -> int:
    names = [name for name, _ in RULES]
    return sum(1 << names.index(r) for r in rules)


#: Versioned policies: masks over the ledger's bits.
POLICIES = {
    "v1": mask(BASE),
    "v2": mask(name for name, _ in RULES),
}


def measure(docs: DataFrame) -> DataFrame:
    """doc_id and the measurements, each computed once.

    The one-row ``inline`` steps keep the optimiser from copying a word list into the
    functions that run over its elements."""
    split = docs.select("doc_id", F.inline(F.array(F.struct(
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        F.filter(F.split(F.coalesce(F.col("text").cast("string"), F.lit("")), BLANKS), lambda w: w != "").alias("words"),
        F.filter(F.split(F.coalesce(F.col("text").cast("string"), F.lit("")), "\n"), lambda x: F.btrim(x, F.lit(" \t\n\x0b\f\r")) != "").alias("lines"),
    ))))
    n = F.size("words")
    windows = F.when(n > WINDOW_WORDS, F.sort_array(F.transform(
        F.sequence(F.lit(1), n - (WINDOW_WORDS - 1)),
        lambda i: F.struct(F.xxhash64(F.slice("words", i, WINDOW_WORDS)).alias("h"), i.alias("i"))))).otherwise(
        F.array().cast("array<struct<h:bigint,i:int>>"))
    sorted_ = split.select("doc_id", F.inline(F.array(F.struct("text", "words", "lines", windows.alias("windows")))))
    m = F.size("windows")
    # Neighbours in hash order with the same words: both starts belong to repeated windows.
    twins = F.when(m > 1, F.flatten(F.zip_with(
        F.slice("windows", F.lit(1), m - 1), F.slice("windows", F.lit(2), m - 1),
        lambda a, b: F.when((a["h"] == b["h"])
                            & (F.slice("words", a["i"], WINDOW_WORDS) == F.slice("words", b["i"], WINDOW_WORDS)),
                            F.array(a["i"], b["i"])).otherwise(F.array().cast("array<int>"))))).otherwise(
        F.array().cast("array<int>"))
    starts = sorted_.select("doc_id", F.inline(F.array(F.struct(
        "text", "words", "lines", F.sort_array(F.array_distinct(twins)).alias("starts")))))
    k = F.size("starts")
    gaps = F.zip_with(F.slice("starts", F.lit(1), F.greatest(k - 1, F.lit(0))), F.slice("starts", F.lit(2), F.greatest(k - 1, F.lit(0))),
                      lambda a, b: F.least(b - a, F.lit(WINDOW_WORDS)))
    covered = F.when(k == 0, F.lit(0)).otherwise(F.aggregate(gaps, F.lit(WINDOW_WORDS), lambda t, g: t + g))

    def chars(pattern: str) -> Column:
        return (F.length("text") - F.length(F.regexp_replace("text", pattern, ""))).cast("long")

    return starts.select(
        "doc_id",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        chars(r"[#*$%&|<>]").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        covered.cast("long").alias("n_repeat_words"),
        F.size("lines").cast("long").alias("n_lines"),
        chars("[A-Z]").alias("n_capitals"),
        chars("[A-Za-z]").alias("n_letters"),
        chars("!").alias("n_exclamations"),
        chars("[0-9]").alias("n_digits"))


def ledger(docs: DataFrame) -> DataFrame:
    """The measurements and the ``failures`` mask."""
    bits = [F.when(F.expr(rule), F.lit(1 << i)).otherwise(F.lit(0)) for i, (_, rule) in enumerate(RULES)]
    failures = bits[0]
    for bit in bits[1:]:
        failures = failures.bitwiseOR(bit)
    return measure(docs).withColumn("failures", failures)


def passes(policy: str, failures: str = "failures") -> Column:
    return F.col(failures).bitwiseAND(POLICIES[policy]) == 0


def ablation(rows: DataFrame, policy: str) -> DataFrame:
    """For each rule of a policy: documents that fail it, that only it removes, and that the
    policy would keep without it.  One pass over the masks."""
    own = F.col("failures").bitwiseAND(POLICIES[policy])
    counts = rows.groupBy(own.alias("own")).agg(F.count(F.lit(1)).alias("n"))  # 2^rules rows at most
    rules = F.array(*[F.struct(F.lit(name).alias("rule"), F.lit(1 << i).alias("bit"))
                      for i, (name, _) in enumerate(RULES) if POLICIES[policy] >> i & 1])
    return counts.select("own", "n", F.inline(rules)).groupBy("rule").agg(
        F.sum(F.when(F.col("own").bitwiseAND(F.col("bit")) != 0, F.col("n")).otherwise(0)).alias("failed"),
        F.sum(F.when(F.col("own") == F.col("bit"), F.col("n")).otherwise(0)).alias("only_this"),
        F.sum(F.when(F.col("own").bitwiseAND(F.bitwise_not("bit")) == 0, F.col("n")).otherwise(0)).alias("kept_without"))


def op2_quality_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = ledger(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                       (~passes("v1")).alias("base_failed"), passes("v2").alias("kept"),
                       F.col("failures").cast("long").alias("failures"))


ORACLE = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text,
         list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words,
         list_filter(string_split(coalesce(text, ''), chr(10)),
                     lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents),
w AS (SELECT r, unnest(range(1, len(words) - 3)) AS i, words FROM d WHERE len(words) >= 5),
g AS (SELECT r, i, count(*) OVER (PARTITION BY r, array_to_string(words[i:i+4], ' ')) AS n FROM w),
c AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(i, i + 5)) AS p FROM g WHERE n > 1) GROUP BY r),
m AS (
  SELECT doc_id, len(words) AS n_words, len(array_to_string(words, '')) AS word_chars,
         len(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
         len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(c.n, 0) AS n_repeat_words,
         len(lines) AS n_lines,
         len(regexp_replace(text, '[^A-Z]', '', 'g')) AS caps,
         len(regexp_replace(text, '[^A-Za-z]', '', 'g')) AS letters,
         len(regexp_replace(text, '[^!]', '', 'g')) AS excl,
         len(regexp_replace(text, '[^0-9]', '', 'g')) AS digits
  FROM d LEFT JOIN c USING (r)),
f AS (
  SELECT *, (n_words < 10)::INT + 2 * (100 * n_repeat_words > 20 * n_words)::INT + 4 * (10 * n_symbols > n_words)::INT
         + 8 * (100 * n_dup_lines > 40 * n_lines)::INT + 16 * (2 * caps > letters)::INT + 32 * (5 * excl > n_words)::INT
         + 64 * (100 * digits > 50 * word_chars)::INT
         + 128 * (word_chars < 2 * n_words OR word_chars > 15 * n_words)::INT AS failures
  FROM m)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
       n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words,
       (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AS base_failed,
       failures = 0 AS kept, failures::BIGINT AS failures
FROM f
"""
