"""Language identification by nearest centroid.

A text's vector holds the TF-IDF weights of its byte trigrams (letters only, A-Z
lower-cased, anything else in ASCII one blank), hashed to a fixed number of dimensions, at
unit length.  Document frequencies are counted over all labelled texts.  Each language gets several
centroids by spherical k-means over a bounded sample of its labelled texts
(``sample_per_lang``, the rows with the least hash of doc_id and text).  A text takes the language of
the centroid with the greatest cosine, and is rejected when its distance to that centroid is
greater than the centroid's own limit, which is learned from the sample's distances and
allows for the text's length.

Cases: NULL text and text without a letter give ``und``, score 0, rejected.  Labels that are
NULL teach nothing.  With no labelled text at all every text is ``und``.  Equal cosines take
the first language in alphabetical order.  Repeated rows are predicted each by itself.
Predictions read only text; lang, source and doc_id never enter them.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tierline.llm.common import blocks, bounded_batches, hash_mod, table, text_buffer, texts_of, with_columns

DIMS = 1 << 13
CENTROIDS = 3
SAMPLE_PER_LANG = 1000
ROUNDS = 6
#: A text is rejected when its cosine, set against what its length allows, falls below this
#: share of the value that all but 1 % of the centroid's own sample reach.
REJECT_SHARE = 0.25
#: A text with few different trigrams can only reach a small cosine with a centroid that has
#: many: about sqrt(d / (d + this)) of what a long text reaches.
HALF_LENGTH = 200
UNKNOWN = "und"

_LETTER = re.compile(r"[^\W\d_]")
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[:128] = 32
_FOLD[97:123] = np.arange(97, 123)
_FOLD[65:91] = np.arange(97, 123)


def trigram_dims(data: np.ndarray, dims: int = DIMS) -> np.ndarray:
    """Dimension of the trigram that starts at each byte; the last two have none."""
    x = _FOLD[data].astype(np.uint32)
    key = (x[:-2] << np.uint32(16)) | (x[1:-1] << np.uint32(8)) | x[2:]
    return ((key * np.uint32(0x9E3779B1)) >> np.uint32(32 - (dims.bit_length() - 1))).astype(np.int64)


def term_counts(text: np.ndarray, dims: int = DIMS) -> np.ndarray:
    """Counts of a text's trigram dimensions, with one blank at either end."""
    padded = np.empty(len(text) + 2, np.uint8)
    padded[0] = padded[-1] = 32
    padded[1:-1] = text
    return np.bincount(trigram_dims(padded, dims), minlength=dims) if len(text) else np.zeros(dims, np.int64)


def unit(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """TF-IDF rows at unit length; term frequency counts by its logarithm."""
    v = np.log1p(counts).astype(np.float32) * idf
    size = np.linalg.norm(v, axis=-1, keepdims=True)
    return v / np.where(size > 0, size, 1)


def length_share(counts: np.ndarray) -> np.ndarray:
    d = np.count_nonzero(counts, axis=-1)
    return np.sqrt(d / (d + HALF_LENGTH))


def sample_vectors(data: np.ndarray, off: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unit vectors and length shares of texts.  Counts are held for one text at a time: those of a whole sample
    take several times the memory of its vectors."""
    v, reach = np.empty((len(off) - 1, len(idf)), np.float32), np.empty(len(off) - 1)
    for i in range(len(v)):
        counts = term_counts(data[off[i]:off[i + 1]], len(idf))
        v[i], reach[i] = unit(counts, idf), length_share(counts)
    return v, reach


def cluster(vectors: np.ndarray, k: int, rounds: int = ROUNDS) -> np.ndarray:
    """Spherical k-means from a farthest-first start: no random numbers, equal on any run."""
    pick = [0]
    best = vectors @ vectors[0]
    while len(pick) < min(k, len(vectors)):
        pick.append(int(np.argmin(best)))
        best = np.maximum(best, vectors @ vectors[pick[-1]])
    centre = vectors[pick]
    for _ in range(rounds):
        owner = np.argmax(vectors @ centre.T, axis=1)
        rows = [vectors[owner == i].mean(axis=0) if (owner == i).any() else centre[i] for i in range(len(centre))]
        centre = np.array(rows, np.float32)
        centre /= np.maximum(np.linalg.norm(centre, axis=1, keepdims=True), 1e-12)
    return centre


def inverse_frequency(docs: DataFrame, dims: int = DIMS) -> np.ndarray:
    """IDF over all texts of ``docs``: one row of counts a task, summed by dimension."""
    def count(batches):
        df, n = np.zeros(dims, np.int64), 0
        for _, data, off in blocks(batches):
            for i in range(len(off) - 1):
                if off[i + 1] > off[i]:
                    df += term_counts(data[off[i]:off[i + 1]], dims) > 0
                    n += 1
        yield pa.RecordBatch.from_arrays(
            [pa.array([df.tolist() + [n]], pa.list_(pa.int64()))], ["df"])

    rows = (texts_of(docs).mapInArrow(count, "df array<long>").select(F.posexplode("df").alias("dim", "n"))
            .groupBy("dim").agg(F.sum("n").alias("n")).collect())  # dims + 1 rows
    df = np.zeros(dims + 1)
    for r in rows:
        df[r["dim"]] = r["n"]
    return np.log((1 + df[-1]) / (1 + df[:-1])).astype(np.float32) + np.float32(1e-3)


def fit(labelled: DataFrame, dims: int = DIMS, centroids: int = CENTROIDS,
        sample_per_lang: int = SAMPLE_PER_LANG) -> dict | None:
    """The model: idf, languages, unit centroids and each centroid's least accepted cosine."""
    labelled = labelled.filter(F.col("lang").isNotNull() & F.col("text").isNotNull())
    idf = inverse_frequency(labelled, dims)
    # About twice the sample passes a threshold on the hash, so that what meets in one task is
    # as small at any size of the table; the least hashes of it are the sample.
    share = F.lit(0.0)
    for r in labelled.groupBy("lang").count().collect():  # one row a language
        share = F.when(F.col("lang") == r["lang"], F.lit(2.0 * sample_per_lang / r["count"])).otherwise(share)
    hashed = F.xxhash64("doc_id", "text")
    by_hash = Window.partitionBy("lang").orderBy(hashed, "doc_id", "text")
    sample = (labelled.select("doc_id", "text", F.col("lang").cast("string").alias("lang"))
              .filter(hashed / F.lit(2.0 ** 64) + 0.5 < share)
              .withColumn("at", F.row_number().over(by_hash)).filter(F.col("at") <= sample_per_lang))

    def learn(group):
        lang = group.column("lang")[0].as_py()
        texts = [t for t in group.sort_by("at").column("text").to_pylist() if _LETTER.search(t)]
        out = {"lang": [], "centre": [], "least": []}
        if texts:
            data, off = text_buffer(pa.array(texts, pa.string()))
            v, reach = sample_vectors(data, off, idf)
            centre = cluster(v, centroids)
            near = v @ centre.T
            owner = np.argmax(near, axis=1)
            for i, c in enumerate(centre):
                own = near[owner == i, i] / reach[owner == i]
                if len(own):
                    out["lang"].append(lang)
                    out["centre"].append(c.astype(np.float32).tobytes())
                    out["least"].append(float(np.quantile(own, 0.01)))
        return pa.table(out, pa.schema([("lang", pa.string()), ("centre", pa.binary()), ("least", pa.float64())]))

    rows = sample.groupBy("lang").applyInArrow(learn, "lang string, centre binary, least double").collect()
    if not rows:  # centroids x languages rows
        return None
    rows.sort(key=lambda r: (r["lang"], r["centre"]))
    return {"idf": idf, "langs": [r["lang"] for r in rows], "least": np.array([r["least"] for r in rows]),
            "centres": np.stack([np.frombuffer(r["centre"], np.float32) for r in rows])}


def nearest(model: dict | None, text: np.ndarray) -> tuple[int, float, bool] | None:
    """Index of the nearest centroid, the cosine, and whether the text is rejected; None for a
    text without a letter."""
    if model is None or not len(text) or not _LETTER.search(text.tobytes().decode("utf-8", "replace")):
        return None
    counts = term_counts(text, len(model["idf"]))
    near = model["centres"] @ unit(counts, model["idf"])
    best = int(np.argmax(near))
    return best, float(near[best]), bool(near[best] < REJECT_SHARE * model["least"][best] * length_share(counts))


def predict(docs: DataFrame, model: dict | None) -> DataFrame:
    """doc_id, lang_pred, score (cosine) and rejected."""
    def start():
        def handle(data, off):
            out = []
            for i in range(len(off) - 1):
                found = nearest(model, data[off[i]:off[i + 1]])
                out.append((UNKNOWN, 0.0, True) if found is None else
                           (model["langs"][found[0]], min(max(found[1], 0.0), 1.0), found[2]))
            return list(zip(*out))
        return handle

    return with_columns(docs, start, "lang_pred string, score double, rejected boolean")


def keep_known(docs: DataFrame, learn_from=None) -> DataFrame:
    """Rows of ``docs`` whose language the model accepts; all columns as they were.  The model
    learns from the rows of ``learn_from`` (a condition), by default all."""
    model = fit(docs if learn_from is None else docs.filter(learn_from))
    bounded_batches(docs.sparkSession)
    at = docs.columns.index("text")

    def run(batches):
        for batch in batches:
            keep = []
            for _, data, off in blocks([batch], at):
                for i in range(len(off) - 1):
                    found = nearest(model, data[off[i]:off[i + 1]])
                    keep.append(found is not None and not found[2])
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = hash_mod(F.col("doc_id"), 5) == 0
    found = predict(docs, fit(docs.filter(~held_out)))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "rejected")
