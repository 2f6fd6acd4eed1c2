"""Corpus pipeline: five stages, each written as Parquet and read again as the next one's
documents.

1. ``language_id``: documents whose language is rejected go; the model learns from all that
   have a label.
2. ``line_dedup``: lines found in many documents go from every text.
3. ``near_duplicates``: one row of each SimHash group stays.
4. ``decontaminate``: documents with a benchmark passage go.
5. ``bpe``: token ids of every document, and the text decoded from them.

Stages 1 to 4 return the columns of ``documents`` as they came; other columns of the input pass
through.  Cases: a document without a letter, blank or NULL is rejected by stage 1.  Texts that stage 2
empties stay, as the empty text, and meet in one group in stage 3.  Rows that repeat a
text collapse in stage 3; NULL or repeated ids do not make two texts one document.  An empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tierline.llm import bpe_tree, decontaminate, language_id, line_dedup, simhash_bktree
from tierline.llm.common import table, written

#: Workers keep their pieces while the stages of the next corpus fill the executor's heap: an eighth of what the
#: operator remembers by itself.
BPE_PIECES = 1 << 16


def _language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language_id.keep_known(docs)


def _line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_dedup.deduplicate(docs)


def _near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash_bktree.keep_first(docs)


def _decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.remove(docs, table(spark, sf_dir, "benchmark"))


def _bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe_tree.encode(docs, pieces=BPE_PIECES)


STAGES = [
    ("language_id", _language_id),
    ("line_dedup", _line_dedup),
    ("near_duplicates", _near_duplicates),
    ("decontaminate", _decontaminate),
    ("bpe", _bpe),
]

#: SQL cannot express the language model nor the tokenizer; tests hold the rows against a
#: brute-force version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
