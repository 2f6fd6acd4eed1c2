"""Helpers shared by the operators: table access, lineage cuts, bounded Arrow text blocks."""

from __future__ import annotations

import gc
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Most text bytes a Python worker holds in one block; a longer single text is a block alone.
BLOCK_BYTES = 4 << 20
ARROW_BYTES = 16 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bounded_batches(spark: SparkSession) -> None:
    """Limit Arrow batches by bytes, so that many very long texts never meet in one batch."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder under the cluster's shared checkpoint folder."""
    from tierline.session import ensure_checkpoint_dir  # not needed by the workers

    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str, paths: list[str] | None = None, compression: str | None = None) -> DataFrame:
    """Cut lineage: write to the shared folder and read back, so that losing an executor
    never repeats the work above.

    The collection first lets Spark's cleaner drop the shuffle files of steps that nothing
    refers to any more, which otherwise waits for the driver's heap to fill."""
    gc.collect()
    df.sparkSession.sparkContext._jvm.System.gc()
    path = scratch(df.sparkSession, name)
    df.write.parquet(path, compression=compression)
    if paths is not None:  # for a caller who deletes the table when later ones replace it
        paths.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have (Spark's names ignore case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a scratch table that a later one has replaced."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)


def text_buffer(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string array, end to end, and the n+1 offsets; NULL has no bytes."""
    arr = arr.combine_chunks() if isinstance(arr, pa.ChunkedArray) else arr
    if not len(arr):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    wide = np.int64 if pa.types.is_large_string(arr.type) else np.int32
    if arr.null_count:
        arr = arr.fill_null("")
    _, offs, data = arr.buffers()
    off = np.frombuffer(offs, wide)[arr.offset:arr.offset + len(arr) + 1].astype(np.int64)
    whole = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return whole[off[0]:off[-1]], off - off[0]


def blocks(batches, text_col: int = 1, limit: int = BLOCK_BYTES):
    """Yield ``(rows, bytes, offsets)`` with at most ``limit`` text bytes, one row at least."""
    for batch in batches:
        data, off = text_buffer(batch.column(text_col))
        i, n = 0, batch.num_rows
        while i < n:
            j = max(i + 1, int(np.searchsorted(off, off[i] + limit, "right")) - 1)
            yield batch.slice(i, j - i), data[off[i]:off[j]], off[i:j + 1] - off[i]
            i = j


def texts_of(docs: DataFrame) -> DataFrame:
    """Only the two columns that operators read, so that no other column can clash."""
    bounded_batches(docs.sparkSession)
    return docs.select(F.col("doc_id"), F.col("text").cast("string").alias("text"))


def with_columns(docs: DataFrame, fn, fields: str, limit: int = BLOCK_BYTES) -> DataFrame:
    """Rows of ``docs`` (doc_id, text) as doc_id and the columns that ``fn`` returns.

    ``fn()`` runs once a task and returns a function from a block ``(data, offsets)`` to a
    list of column values, in the order of ``fields``.
    """
    from pyspark.sql.types import StructType
    from pyspark.sql.pandas.types import to_arrow_schema

    own = StructType.fromDDL(fields)
    schema = StructType([docs.schema["doc_id"], *own.fields])
    arrow = to_arrow_schema(schema)

    def run(batches):
        handle = None
        for rows, data, off in blocks(batches, limit=limit):
            handle = handle or fn()
            cols = handle(data, off)
            yield pa.RecordBatch.from_arrays(
                [rows.column(0).cast(arrow.field(0).type)]
                + [pa.array(c, type=arrow.field(i + 1).type) for i, c in enumerate(cols)], schema=arrow)

    return texts_of(docs).mapInArrow(run, schema)


def hash_mod(column, modulus: int):
    """crc32 of the value as text, modulo ``modulus`` (NULL counts as the empty text)."""
    return F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary")) % F.lit(modulus)
