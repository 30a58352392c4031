"""Centroid clustering with a LAESA pivot table, in exact integers.

Vectors become integers floor(1024 * x). Their distances to ``PIVOTS`` fixed
pivots are computed once and stored beside them. In each round the distances
of the centroids to the pivots give, by the triangle inequality, a lower bound
|d(v, p) - d(c, p)| for every vector and centroid without reading the vector's
components; centroids are taken in ascending order of their bound, and only those whose
bound does not exceed the best exact distance so far get an exact integer
distance. Square roots are stored rounded down (``isqrt``) and the bound gives
way by what rounding can take, so no nearest centroid and no tie is ever pruned.

A round is one pass over the stored table: a task returns one row per cluster
(count, component sums), Spark adds them up, and K rows reach the driver.
Centroids and pivots (K + PIVOTS vectors) are the only things sent to tasks.

Pivots are taken greedily, each farthest from those before, from the ``SAMPLE``
vectors that are first in the order of the initial centroids. They decide how much is
pruned, never the result.

Defined cases: vectors that are null, have another number of components, or hold null
or non-finite components are left out; rows that repeat an id are vectors of their own; rows
without an id hash as ``3:`` alone and come last among equal hashes; of equal
hashes the smaller vector comes first. With fewer vectors than K, there are as
many centroids as vectors; an empty table gives no rows. A component beyond
+-2^27 fails with a message, as its distances need not fit a long. Extra columns are never read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martforge.llm.common import small_batches, written

K = 8
ROUNDS = 10
DIM = 64
SCALE = 1024
#: Prefix of the text whose hash orders the initial centroids.
SALT = "3:"
PIVOTS = 12
#: Vectors that pivots are chosen from.
SAMPLE = 256
#: Components are at most this in absolute value: a squared distance is below 2^6 * 2^56 for 64 components.
LIMIT = 1 << 27


def integral(vectors: DataFrame, id_col: str, vector_col: str, dim: int) -> DataFrame:
    """(vec_id, v): the vectors that are kept, as integers."""
    v = F.col(vector_col)
    finite = F.forall(v, lambda x: F.coalesce(~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) != F.lit(float("inf"))), F.lit(False)))
    kept = vectors.filter(F.coalesce((F.size(v) == dim) & finite, F.lit(False)))
    scaled = F.transform(v, lambda x: x.cast("double") * F.lit(float(SCALE)))
    said = F.concat(F.lit("component too large for exact distances in vector "), F.coalesce(F.col(id_col).cast("string"), F.lit("without id")))
    fits = F.forall(scaled, lambda x: F.abs(x) <= F.lit(float(LIMIT)))
    whole = F.when(fits, F.transform(scaled, lambda x: F.floor(x).cast("bigint"))).otherwise(F.raise_error(said))
    return kept.select(F.col(id_col).cast("bigint").alias("vec_id"), whole.alias("v"))


def first_in_order(rows: DataFrame, count: int) -> np.ndarray:
    """The first ``count`` vectors in the order of the initial centroids (a top-k: ``count`` rows reach the driver)."""
    name = F.concat(F.lit(SALT), F.coalesce(F.col("vec_id").cast("string"), F.lit("")))
    top = rows.withColumn("h", F.sha2(name, 256)).orderBy("h", F.col("vec_id").asc_nulls_last(), "v").limit(count).select("v").collect()
    return np.array([r["v"] for r in top], dtype=np.int64)


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact squared distances of all rows of ``a`` to each row of ``b``."""
    out = np.empty((len(a), len(b)), dtype=np.int64)
    for j, row in enumerate(b):
        d = a - row
        out[:, j] = np.einsum("ij,ij->i", d, d)
    return out


def roots(x: np.ndarray) -> np.ndarray:
    """floor(sqrt(x)) of integers below 2^63."""
    r = np.sqrt(x.astype(np.float64)).astype(np.int64)
    r -= r * r > x
    r += (r + 1) * (r + 1) <= x
    return r


def farthest_first(sample: np.ndarray, count: int) -> np.ndarray:
    if not len(sample):
        return sample
    chosen, gap = [0], squared(sample, sample[:1])[:, 0]
    while len(chosen) < min(count, len(sample)):
        chosen.append(int(gap.argmax()))
        gap = np.minimum(gap, squared(sample, sample[chosen[-1:]])[:, 0])
    return sample[chosen]


def nearest(v: np.ndarray, table: np.ndarray, centroids: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """(number, squared distance) of the nearest centroid of each vector, the smaller number on ties, and exact distances taken.

    ``table``: roots of the vectors' distances to the pivots.
    """
    n, k = len(v), len(centroids)
    to_pivots = roots(squared(centroids, pivots))
    # Roots are rounded down, so a difference of two of them is above the true one by less than 1.
    bound = np.zeros((n, k), dtype=np.int64)
    for p in range(len(pivots)):
        np.maximum(bound, np.abs(table[:, p, None] - to_pivots[None, :, p]) - 1, out=bound)
    bound *= bound
    order = np.argsort(bound, axis=1, kind="stable")
    best = np.full(n, np.iinfo(np.int64).max)
    number = np.full(n, k)
    taken = 0
    for step in range(k):
        c = order[:, step]
        rows = np.flatnonzero(bound[np.arange(n), c] <= best)  # bounds ascend: a row once out stays out
        if not rows.size:
            break
        d = v[rows] - centroids[c[rows]]
        exact = np.einsum("ij,ij->i", d, d)
        taken += rows.size
        better = (exact < best[rows]) | ((exact == best[rows]) & (c[rows] < number[rows]))
        best[rows[better]], number[rows[better]] = exact[better], c[rows[better]]
    return number, best, taken


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def pivot_table(rows: DataFrame, pivots: np.ndarray) -> DataFrame:
    """(vec_id, v, to_pivots), written once."""
    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, 4096):
            far = roots(squared(_matrix(batch.column(1)), pivots))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(list(far), pa.list_(pa.int64()))], names=["vec_id", "v", "to_pivots"])

    return written(rows.mapInArrow(measure, "vec_id bigint, v array<bigint>, to_pivots array<bigint>"), "pivot_table")


def moved(table: DataFrame, centroids: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """The centroids after one round."""
    schema = pa.schema([("cluster", pa.int32()), ("n", pa.int64()), ("sums", pa.list_(pa.int64()))])

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, 4096):  # 4096 * 2^27 is far below 2^63
            v = _matrix(batch.column(1))
            number, _, _ = nearest(v, _matrix(batch.column(2)), centroids, pivots)
            held = np.unique(number)
            sums = [v[number == c].sum(axis=0) for c in held]
            yield pa.RecordBatch.from_arrays([pa.array(held, pa.int32()), pa.array([int((number == c).sum()) for c in held], pa.int64()),
                                              pa.array(sums, pa.list_(pa.int64()))], schema=schema)

    partial = table.mapInArrow(add_up, "cluster int, n bigint, sums array<bigint>")
    each = partial.select("cluster", "n", F.posexplode("sums").alias("i", "s"))
    total = each.groupBy("cluster", "i").agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s"))
    out = centroids.copy()
    for row in total.collect():  # a row for each component of each centroid
        out[row["cluster"], row["i"]] = int(row["s"]) // row["n"]  # // rounds down
    return out


def cluster(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = K, rounds: int = ROUNDS,
            dim: int = DIM) -> tuple[DataFrame, np.ndarray]:
    """((vec_id, cluster, distance), centroids): nearest centroid and squared distance after ``rounds`` rounds."""
    rows = integral(vectors, id_col, vector_col, dim)
    first = first_in_order(rows, max(k, SAMPLE))
    if not len(first):
        empty = rows.select("vec_id", F.lit(0).alias("cluster"), F.lit(0).cast("bigint").alias("distance"))
        return empty, np.zeros((0, dim), dtype=np.int64)
    centroids, pivots = first[:k], farthest_first(first, PIVOTS)
    table = pivot_table(rows, pivots)
    for _ in range(rounds):
        after = moved(table, centroids, pivots)
        if (after == centroids).all():  # no later round can differ
            break
        centroids = after

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, 4096):
            number, best, _ = nearest(_matrix(batch.column(1)), _matrix(batch.column(2)), centroids, pivots)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(number, pa.int32()), pa.array(best)], names=["vec_id", "cluster", "distance"])

    return written(table.mapInArrow(assign, "vec_id bigint, cluster int, distance bigint"), "clusters"), centroids


def digest(centroid: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, centroid.tolist())).encode()).hexdigest()


def report(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = K, rounds: int = ROUNDS,
           dim: int = DIM) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256), one row per kept vector."""
    found, centroids = cluster(vectors, id_col, vector_col, k, rounds, dim)
    per = {r["cluster"]: r["d"] for r in found.groupBy("cluster").agg(F.sum("distance").alias("d")).collect()}  # K rows
    if not per:
        return found.selectExpr("*", "0L AS cluster_inertia", "0L AS inertia", "'' AS centroid_sha256")
    of = lambda values: F.element_at(F.array(*[F.lit(x) for x in values]), F.col("cluster") + 1)
    return found.select("*", of([per.get(c, 0) for c in range(len(centroids))]).cast("bigint").alias("cluster_inertia"),
                        F.lit(sum(per.values())).cast("bigint").alias("inertia"), of([digest(c) for c in centroids]).alias("centroid_sha256"))
