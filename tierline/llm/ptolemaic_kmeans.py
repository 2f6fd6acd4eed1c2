"""Centroid clustering with Ptolemaic pivots.

*Vectors and centroids* are whole numbers: floor(64 * entry).  The first centroids are the
``K`` vectors with the smallest SHA-256 of ``<seed>:<id>``; each round assigns every vector to
its nearest centroid (squared Euclidean distance, ties to the smaller number) and moves each
non-empty centroid to the exact floor of its vectors' means.  All arithmetic that decides is
exact.

*Ptolemaic bounds.*  For points x, c and pivots p, q, Ptolemy's inequality gives

    d(x, c) >= |d(x, p) d(c, q) - d(x, q) d(c, p)| / d(p, q).

The pivots are the first centroids, in a ring of fixed pairs.  A vector's distances to them
are computed once and written with it; a round needs only the centroids' distances to
the pivots.  A centroid whose bound lies above the best exact distance so far is left out; all
others are checked exactly.  Bounds are doubles rounded down by more than all rounding errors
can add up to (``SAFE``), so a centroid is never wrongly left out.

*Spark.*  The vectors with their pivot distances are one written table, which cuts the
lineage; a round is one pass over it with the centroids broadcast (K x dim numbers, whatever the
data) and exact sums a task (K x dim rows), added up by Spark.

Cases: vectors that are NULL, of another length, with NULL or non-finite entries, or with an
entry whose scaled value does not fit 62 bits are dropped.  NULL ids hash as the empty text;
repeated ids are vectors of their own, ties of the hash go to the smaller components.  With fewer
than ``K`` vectors each is a centroid; equal first centroids leave the later one empty, and empty
ones stay.  A squared distance or a sum beyond 63 bits is NULL (the cluster is still exact).
An empty table gives no rows.  Other columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from tierline.llm.common import bounded_batches, drop_path, table, written
from tierline.llm.vectors import column_sums, decimals, lists, matrix, whole_numbers

K = 16
DIM = 64
SCALE = 64
ROUNDS = 3
SEED = 1
#: Entries below this have squared distances that 64-bit integers hold (up to 64 dimensions).
SMALL = 1 << 27
#: Relative safety of the bounds; a bound is a dozen double operations of 2**-53 each.
SAFE = 2.0 ** -48
MOST = (1 << 63) - 1


def squares(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances of the rows of ``x`` to ``c``: 64-bit, or Python integers where
    they may not fit."""
    if len(x) and (max(abs(int(x.max())), abs(int(x.min())), *(abs(int(v)) for v in c)) >= SMALL or len(c) > DIM):
        x, c = x.astype(object), c.astype(object)
    diff = x - c
    return (diff * diff).sum(axis=1) if len(x) else np.zeros(0, np.int64)


def pivot_distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Distance of each row to each pivot, as doubles."""
    return np.array([np.sqrt(squares(x, p).astype(float)) for p in pivots]).T.reshape(len(x), len(pivots))


def pairs_of(pivots: np.ndarray) -> list[tuple[int, int, float]]:
    """The fixed pairs: each pivot and the next one that differs from it, with their distance."""
    out = []
    for i in range(len(pivots)):
        for j in [(i + s) % len(pivots) for s in range(1, len(pivots))]:
            d = float(squares(pivots[i:i + 1], pivots[j])[0]) ** 0.5
            if d > 0:
                out.append((i, j, d))
                break
    return out


def lower_bounds(near: np.ndarray, of: np.ndarray, pairs) -> np.ndarray:
    """Squared Ptolemaic bound, rounded down, of each vector (pivot distances ``near``) to each
    centroid (pivot distances ``of``)."""
    best = np.zeros((len(near), len(of)))
    for p, q, between in pairs:
        a, b = np.outer(near[:, p], of[:, q]), np.outer(near[:, q], of[:, p])
        np.maximum(best, (np.abs(a - b) - (a + b) * SAFE) / between, out=best)
    return best * best * (1 - SAFE)


def nearest(x: np.ndarray, near: np.ndarray, centroids: np.ndarray, of: np.ndarray, pairs):
    """(cluster, exact squared distance, number of exact checks) of each row."""
    bound = lower_bounds(near, of, pairs)
    cluster = bound.argmin(axis=1)
    distance = np.zeros(len(x), np.int64)
    checks = len(x)
    for j in range(len(centroids)):
        own = np.flatnonzero(cluster == j)
        exact = squares(x[own], centroids[j])
        distance = distance.astype(object) if exact.dtype == object else distance
        distance[own] = exact
    start = cluster.copy()
    for j in range(len(centroids)):
        left = np.flatnonzero((start != j) & (bound[:, j] <= distance.astype(float) * (1 + SAFE)))
        checks += len(left)
        exact = squares(x[left], centroids[j])
        distance = distance.astype(object) if exact.dtype == object else distance
        nearer = (exact < distance[left]) | ((exact == distance[left]) & (j < cluster[left]))
        cluster[left[nearer]] = j
        distance[left[nearer]] = exact[nearer]
    return cluster, distance, checks


def integer_vectors(rows: DataFrame, scale: int = SCALE, dim: int = DIM) -> DataFrame:
    """(vec_id, x) of the vectors that are kept; ``rows`` has vec_id and embedding."""
    schema = StructType([rows.schema["vec_id"], *StructType.fromDDL("x array<long>").fields])
    arrow = to_arrow_schema(schema)

    def run(batches):
        for batch in batches:
            place, x = whole_numbers(batch.column(1), scale, dim)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(place)), lists(x).cast(arrow.field(1).type)], schema=arrow)

    bounded_batches(rows.sparkSession)
    return rows.select("vec_id", "embedding").mapInArrow(run, schema)


def first_centroids(vectors: DataFrame, k: int = K, seed: int = SEED) -> np.ndarray:
    """The ``k`` vectors with the smallest hash of seed and id."""
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    rows = vectors.select(key.alias("key"), "x").orderBy("key", "x").limit(k).collect()
    return np.array([r["x"] for r in rows], np.int64)


class Clusters:
    """The written vectors with their pivot distances, and the centroids so far."""

    def __init__(self, vectors: DataFrame, centroids: np.ndarray, paths: list[str]):
        self.spark, self.centroids, self.pivots = vectors.sparkSession, centroids, centroids
        self.paths = paths
        self.id = vectors.schema["vec_id"]
        schema = StructType([*vectors.schema.fields, *StructType.fromDDL("near array<double>").fields])
        arrow = to_arrow_schema(schema)
        pivots, dim = self.pivots, centroids.shape[1]

        def measure(batches):
            for batch in batches:
                near = pivot_distances(matrix(batch.column(1), dim), pivots)
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), lists(near).cast(arrow.field(2).type)], schema=arrow)

        self.rows = written(vectors.mapInArrow(measure, schema), "kmeans-vectors", paths)

    def _assign(self, handle, schema: StructType, columns: list[str]) -> DataFrame:
        centroids, pivots = self.centroids, self.pivots
        of, pairs = pivot_distances(centroids, pivots), pairs_of(pivots)
        dim, k = centroids.shape[1], len(centroids)

        def run(batches):
            for batch in batches:
                if batch.num_rows:
                    x, near = matrix(batch.column("x"), dim), matrix(batch.column("near"), k)
                    cluster, distance, _ = nearest(x, near, centroids, of, pairs)
                    yield handle(batch, x, cluster, distance)

        return self.rows.select(*columns).mapInArrow(run, schema)

    def move(self) -> None:
        """One round: assign every vector, then move the centroids."""
        schema = StructType.fromDDL("cluster int, place int, total decimal(38,0)")
        arrow = to_arrow_schema(schema)
        dim = self.centroids.shape[1]

        def sums(batch, x, cluster, distance):
            held = np.unique(cluster)
            totals = [np.append(column_sums(x[cluster == j]), int((cluster == j).sum())) for j in held]
            return pa.RecordBatch.from_arrays([pa.array(np.repeat(held, dim + 1), pa.int32()),
                                               pa.array(np.tile(np.arange(dim + 1), len(held)), pa.int32()),
                                               decimals(np.concatenate(totals))], schema=arrow)

        found: dict = {}
        for r in (self._assign(sums, schema, ["x", "near"]).groupBy("cluster", "place")
                  .agg(F.sum("total").alias("total")).collect()):  # K x (dim + 1) rows
            found[r["cluster"], r["place"]] = int(r["total"])
        moved = self.centroids.copy()
        for j in range(len(moved)):
            if (j, dim) in found:
                moved[j] = [found[j, i] // found[j, dim] for i in range(dim)]
        self.centroids = moved

    def assigned(self) -> DataFrame:
        """vec_id, cluster and squared distance to the present centroids."""
        schema = StructType([self.id, *StructType.fromDDL("cluster int, distance long").fields])
        arrow = to_arrow_schema(schema)

        def show(batch, x, cluster, distance):
            kept = [int(d) if d <= MOST else None for d in distance] if distance.dtype == object else distance
            return pa.RecordBatch.from_arrays([batch.column(0), pa.array(cluster, pa.int32()), pa.array(kept, pa.int64())], schema=arrow)

        return self._assign(show, schema, ["vec_id", "x", "near"])


def centroid_hash(c: np.ndarray) -> str:
    return hashlib.sha256(",".join(str(int(v)) for v in c).encode()).hexdigest()


def cluster(rows: DataFrame, k: int = K, dim: int = DIM, rounds: int = ROUNDS, scale: int = SCALE,
            seed: int = SEED) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia and centroid_sha256 of every vector."""
    vectors = integer_vectors(rows, scale, dim)
    first = first_centroids(vectors, k, seed)
    spark, paths = rows.sparkSession, []
    if not len(first):
        return vectors.selectExpr("vec_id", "0 AS cluster", "0L AS distance", "0L AS cluster_inertia", "0L AS inertia",
                                  "'' AS centroid_sha256").limit(0)
    state = Clusters(vectors, first, paths)
    for _ in range(rounds):
        state.move()
    final = written(state.assigned(), "kmeans-assigned")
    for path in paths:
        drop_path(spark, path)
    whole = F.sum(F.col("distance").cast("decimal(38,0)"))
    missing = F.count_if(F.col("distance").isNull()) > 0
    held = {r["cluster"]: r["total"] for r in final.groupBy("cluster").agg(
        F.when(~missing, whole).alias("total")).collect()}  # K rows
    of_all = None if None in held.values() else sum(held.values())
    fit = lambda v: int(v) if v is not None and v <= MOST else None
    known = spark.createDataFrame(
        [(j, fit(total), fit(of_all), centroid_hash(state.centroids[j])) for j, total in held.items()],
        "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return final.join(F.broadcast(known), "cluster").select(  # K rows at most
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def op13_ptolemaic_kmeans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster(table(spark, sf_dir, "embeddings"))


def _oracle(k: int = K, dim: int = DIM, rounds: int = ROUNDS, scale: int = SCALE, seed: int = SEED) -> str:
    """The same clustering with every distance computed, for DuckDB."""
    parts = [f"""
WITH vectors AS (
    SELECT row_number() OVER () AS r, vec_id,
           list_transform(embedding, lambda v: CAST(floor({scale} * CAST(v AS DOUBLE)) AS BIGINT)) AS x
    FROM embeddings
    WHERE len(embedding) = {dim}
      AND list_count(list_filter(embedding, lambda v: v IS NOT NULL AND isfinite(v))) = {dim}
),
entries AS (
    SELECT r, i AS place, x[i] AS v FROM vectors, range(1, {dim + 1}) AS t(i)
),
c0 AS (
    SELECT j, i AS place, x[i] AS v
    FROM (SELECT x, row_number() OVER (ORDER BY sha256('{seed}:' || COALESCE(CAST(vec_id AS VARCHAR), '')), x) - 1 AS j
          FROM vectors) AS f, range(1, {dim + 1}) AS t(i)
    WHERE j < {k}
)"""]
    for i in range(rounds + 1):
        parts.append(f"""
a{i} AS (
    SELECT r, j, d FROM (
        SELECT r, j, d, row_number() OVER (PARTITION BY r ORDER BY d, j) AS n
        FROM (SELECT e.r, c.j, SUM((e.v - c.v) * (e.v - c.v)) AS d
              FROM entries e JOIN c{i} c ON e.place = c.place GROUP BY e.r, c.j))
    WHERE n = 1
)""")
        if i < rounds:
            parts.append(f"""
m{i} AS (
    SELECT a.j, e.place, SUM(e.v) AS s, COUNT(*) AS n FROM a{i} a JOIN entries e ON e.r = a.r GROUP BY a.j, e.place
),
c{i + 1} AS (
    SELECT c.j, c.place, CAST(COALESCE((m.s - (((m.s % m.n) + m.n) % m.n)) // m.n, c.v) AS BIGINT) AS v
    FROM c{i} c LEFT JOIN m{i} m ON m.j = c.j AND m.place = c.place
)""")
    return ",".join(parts) + f"""
SELECT v.vec_id, CAST(a.j AS INTEGER) AS cluster, CAST(a.d AS BIGINT) AS distance,
       CAST(SUM(a.d) OVER (PARTITION BY a.j) AS BIGINT) AS cluster_inertia,
       CAST(SUM(a.d) OVER () AS BIGINT) AS inertia, h.centroid_sha256
FROM a{rounds} a JOIN vectors v ON v.r = a.r
JOIN (SELECT j, sha256(string_agg(CAST(v AS VARCHAR), ',' ORDER BY place)) AS centroid_sha256
      FROM c{rounds} GROUP BY j) h ON h.j = a.j
"""


ORACLE = _oracle()
