"""Centroid clustering by Walsh-Hadamard progressive search.

Vectors become integers (``floor(SCALE * x)``). The exact integer Walsh-Hadamard
transform multiplies every squared distance by the number of components, and
moves what neighbouring components share into the first coefficients (rows are
in order of their sign changes, coarse to fine). The search of a vector's nearest centroid adds up
squared coefficient differences stage by stage; a partial sum is a lower bound
of the whole. The centroid that leads after the first stage is finished over
all 64 coefficients, and its distance removes every centroid whose partial sum
is strictly greater; the others go on to the next stage and, if never removed,
finish all 64. So ties stay whole and the nearest centroid is exact.

Each round is one scan of the table: tasks assign their vectors and add up
componentwise integer sums per centroid, of which each task passes on
``k * 64`` rows; the driver gets ``k * 64`` sums and forms the exact floors.
No vector is shuffled and no key can be hot. Centroids are the only broadcast
data (``k`` times 64 integers, in the task's closure).

Defined results: a vector that is NULL, has another length than 64, or a NULL,
NaN or infinite component is not kept. Repeated rows are vectors of their own.
A NULL id cannot be hashed, so it never starts a centroid, but is assigned.
Among equal ids the start order follows the components. Fewer kept vectors than
``k`` give fewer centroids, none gives an empty result. Ties go to the smaller
centroid number; a centroid without vectors stays as it is. Components beyond
2**24 are computed with unbounded integers; one of 2**51 or more, or a squared
distance beyond a long, raises. Other columns are ignored, so their names
cannot clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

SIZE = 64
SCALE = 64
CENTROIDS = 16
ROUNDS = 3
SEED = 1
#: Coefficients after which centroids are eliminated, coarse to fine.
STAGES = (4, 8, 16, 32, 64)
#: Components up to this magnitude keep all sums of a search within 63 bits.
EXACT = 2**24
#: Vectors that are searched at once.
STEP = 2048
#: Greatest component; the sum of STEP of them fits 64 bits.
LIMIT = 2**51


def _walsh_order(n: int) -> np.ndarray:
    """Places of the Walsh rows, by sign changes, among the butterflies' rows."""
    rows = np.ones((1, 1), np.int64)
    while len(rows) < n:
        rows = np.block([[rows, rows], [rows, -rows]])
    return np.argsort((np.diff(rows, axis=1) != 0).sum(axis=1), kind="stable")


def transform(vectors: np.ndarray) -> np.ndarray:
    """Walsh-Hadamard coefficients of each row by butterflies, coarse to fine."""
    n = vectors.shape[1]
    out = vectors.copy()
    half = 1
    while half < n:
        pairs = out.reshape(len(out), n // (2 * half), 2, half)
        a, b = pairs[:, :, 0, :].copy(), pairs[:, :, 1, :].copy()
        pairs[:, :, 0, :], pairs[:, :, 1, :] = a + b, a - b
        half *= 2
    return out[:, _walsh_order(n)]


def search(vectors: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(number of the nearest centroid, squared distance, coefficient
    differences computed) of each row of transformed ``vectors`` against
    transformed ``centroids``."""
    n, k = len(vectors), len(centroids)
    rows = np.arange(n)
    diff = vectors[:, None, : STAGES[0]] - centroids[None, :, : STAGES[0]]
    partial = (diff * diff).sum(axis=2)
    lead = partial.argmin(axis=1)
    rest = vectors[:, STAGES[0] :] - centroids[lead][:, STAGES[0] :]
    bound = partial[rows, lead] + (rest * rest).sum(axis=1)
    work = np.full(n, k * STAGES[0] + SIZE - STAGES[0], np.int64)
    alive = partial <= bound[:, None]
    alive[rows, lead] = False
    v, c = np.nonzero(alive)
    sums = partial[v, c]
    for low, high in zip(STAGES, STAGES[1:], strict=False):
        if not len(v):
            break
        d = vectors[v, low:high] - centroids[c, low:high]
        sums = sums + (d * d).sum(axis=1)
        np.add.at(work, v, high - low)
        keep = sums <= bound[v]
        v, c, sums = v[keep], c[keep], sums[keep]
    # what is left has all its coefficients; of equal ones argmin takes the smaller number
    whole = np.repeat(bound[:, None] + 1, k, axis=1)
    whole[rows, lead] = bound
    whole[v, c] = sums
    best = whole.argmin(axis=1)
    return best, whole[rows, best] // SIZE, work


def kept(vector: Column) -> Column:
    """Whether a vector has 64 components, none NULL or non-finite."""
    bad = F.exists(
        vector,
        lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))),
    )
    return vector.isNotNull() & (F.size(vector) == SIZE) & ~bad


def _integers(column: pa.Array) -> np.ndarray:
    """floor(SCALE * x) of every row, checked against LIMIT."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    whole = np.floor(flat * SCALE)
    if len(whole) and np.abs(whole).max() >= LIMIT:
        raise ValueError(f"a component of {LIMIT // SCALE} or more cannot be clustered exactly")
    return whole.astype(np.int64).reshape(-1, SIZE)


def _fitting(vectors: np.ndarray, centroids: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """Both as 64-bit integers, or as unbounded ones if sums might not fit."""
    far = max((abs(x) for c in centroids for x in c), default=0)
    if far > EXACT or (len(vectors) and np.abs(vectors).max() > EXACT):
        return vectors.astype(object), np.array(centroids, dtype=object)
    return vectors, np.array(centroids, np.int64)


def _assigned(batches: Iterator[pa.RecordBatch], centroids: list[list[int]]):
    """(batch slice, integer vectors, cluster, distance, work) of each step."""
    transformed: dict[str, np.ndarray] = {}
    for batch in batches:
        for a in range(0, batch.num_rows, STEP):
            part = batch.slice(a, STEP)
            vectors = _integers(part.column("vector"))
            x, c = _fitting(vectors, centroids)
            if x.dtype.char not in transformed:
                transformed[x.dtype.char] = transform(c)
            yield part, vectors, *search(transform(x), transformed[x.dtype.char])


def _sums(centroids: list[list[int]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(centroids)
        total, count = np.zeros((k, SIZE), object), np.zeros(k, np.int64)
        for _, vectors, cluster, _, _ in _assigned(batches, centroids):
            order = np.argsort(cluster, kind="stable")
            numbers, first = np.unique(cluster[order], return_index=True)
            total[numbers] += np.add.reduceat(vectors[order], first, axis=0).astype(object)
            count += np.bincount(cluster, minlength=k)
        used = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat(used, SIZE), pa.int32()),
                pa.array(np.tile(np.arange(SIZE), len(used)), pa.int32()),
                pa.array([Decimal(int(x)) for x in total[used].ravel()], pa.decimal128(38, 0)),
                pa.array(np.repeat(count[used], SIZE), pa.int64()),
            ],
            ["cluster", "place", "total", "n"],
        )

    return run


def _rows(centroids: list[list[int]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, _, cluster, distance, work in _assigned(batches, centroids):
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("id"),
                    pa.array(cluster, pa.int32()),
                    pa.array(distance.tolist(), pa.int64()),
                    pa.array(work, pa.int64()),
                ],
                ["id", "cluster", "distance", "coefficients"],
            )

    return run


@dataclass(frozen=True)
class Clusters:
    """``rows``: id, cluster, distance, coefficients (differences computed for
    the row); ``centroids``: integer components by cluster number."""

    rows: DataFrame
    centroids: list[list[int]]


def vectors_of(df: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """(id, vector) of the kept rows."""
    return df.where(kept(F.col(vector))).select(F.col(vec_id).alias("id"), F.col(vector).alias("vector"))


def first_centroids(vectors: DataFrame, k: int = CENTROIDS, seed: int = SEED) -> list[list[int]]:
    """The ``k`` vectors with the least hash of seed and id; every task passes
    on ``k`` rows only."""
    name = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")).cast("binary"), 256)
    least = vectors.where(F.col("id").isNotNull()).select(name.alias("name"), "vector").orderBy("name", "vector").limit(k)
    return [
        _integers(pa.array([r["vector"]], pa.list_(pa.float64())))[0].tolist()
        for r in sorted(least.collect(), key=lambda r: (r["name"], r["vector"]))
    ]


def moved(vectors: DataFrame, centroids: list[list[int]]) -> list[list[int]]:
    """Centroids after one round: exact floors of their vectors' means."""
    parts = vectors.mapInArrow(_sums(centroids), "cluster int, place int, total decimal(38,0), n long")
    sums = parts.groupBy("cluster", "place").agg(F.sum("total").alias("total"), F.sum("n").alias("n"))
    out = [list(c) for c in centroids]
    for r in sums.collect():
        out[r["cluster"]][r["place"]] = int(r["total"]) // r["n"]
    return out


def cluster(
    df: DataFrame,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    k: int = CENTROIDS,
    rounds: int = ROUNDS,
    seed: int = SEED,
) -> Clusters:
    """``rounds`` of moving centroids, then the assignment to them."""
    vectors = vectors_of(df, vec_id, vector)
    kind = df.schema[vec_id].dataType.simpleString()
    centroids = first_centroids(vectors, k, seed)
    if not centroids:
        schema = f"id {kind}, cluster int, distance long, coefficients long"
        return Clusters(df.sparkSession.createDataFrame([], schema), [])
    for _ in range(rounds):
        centroids = moved(vectors, centroids)
    rows = vectors.mapInArrow(_rows(centroids), f"id {kind}, cluster int, distance long, coefficients long")
    return Clusters(rows, centroids)


def centroid_hash(components: list[int]) -> str:
    return hashlib.sha256(",".join(map(str, components)).encode()).hexdigest()


def with_inertia(clusters: Clusters) -> DataFrame:
    """Rows with their cluster's and the whole inertia and their centroid's
    hash. The rows are written once and read twice; what is joined to them has
    one row per centroid."""
    rows = stored(clusters.rows, "clusters")
    per = rows.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()
    every = sum(int(r["s"]) for r in per)
    facts = [(r["cluster"], int(r["s"]), every, centroid_hash(clusters.centroids[r["cluster"]])) for r in per]
    schema = "cluster int, cluster_inertia long, inertia long, centroid_sha256 string"
    table = rows.sparkSession.createDataFrame(facts, schema)
    return rows.join(F.broadcast(table), "cluster")
