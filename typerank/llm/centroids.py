"""Exact centroid clustering of integer vectors with Ptolemaic lower bounds.

A few pivots stay fixed, and every vector keeps its distances to them. For a pair of
pivots p, q, Ptolemy's inequality bounds the distance of a vector x to a centroid c from
below by |d(x,p) d(c,q) - d(x,q) d(c,p)| / d(p,q), so a round needs only the distances of
the few centroids to the pivots. The bounds are rounded down by more than the error of
their arithmetic; a centroid whose bound does not exceed the best distance so far is
checked exactly, in integers.

A round reads the stored vectors once and sends one sum a cluster and task; the driver
holds the centroids only.
"""

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from typerank.llm.common import dropped, staged

#: More than the relative rounding error of a bound, which takes about ten operations.
SLACK = 1e-13


@dataclass(frozen=True)
class Clustering:
    """``k`` centroids after ``rounds`` rounds over vectors of ``dim`` components, each
    floor(``scale`` * x); ``seed`` chooses the start."""

    dim: int = 64
    scale: int = 1024
    k: int = 8
    rounds: int = 10
    seed: int = 3

    @property
    def limit(self) -> int:
        """Greatest size of a component: squared distances fit into 63 bits."""
        return math.isqrt((1 << 60) // self.dim)


def integer_vectors(rows: DataFrame, id_col: str, vec_col: str, p: Clustering) -> DataFrame:
    """(vec_id, v) of the vectors with ``dim`` components, none null, NaN or infinite.
    Components beyond +-``limit`` are set to it."""
    x = F.col(vec_col).cast("array<double>")
    whole = (F.size(x) == p.dim) & F.forall(x, lambda e: e.isNotNull() & (F.abs(e) < F.lit(math.inf)))
    low, high = F.lit(float(-p.limit)), F.lit(float(p.limit))
    scaled = F.transform(x, lambda e: F.floor(F.greatest(F.least(e * p.scale, high), low)).cast("int"))
    return rows.where(whole).select(F.col(id_col).cast("long").alias("vec_id"), scaled.alias("v"))


def start(vectors: DataFrame, p: Clustering) -> np.ndarray:
    """The ``k`` vectors whose ids have the smallest hashes, in that order; rows that
    share an id by their components. Rows without an id are not chosen."""
    key = F.sha2(F.concat(F.lit(f"{p.seed}:"), F.col("vec_id").cast("string")), 256)
    rows = vectors.where("vec_id IS NOT NULL").select("v", key.alias("h")).orderBy("h", "v").limit(p.k)
    return np.array([r.v for r in rows.collect()], dtype=np.int64).reshape(-1, p.dim)


def squared(v: np.ndarray, c: np.ndarray) -> np.ndarray:
    d = v - c
    return np.einsum("ij,ij->i", d, d)


def pivot_pairs(pivots: np.ndarray) -> list[tuple[int, int, float]]:
    """(p, q, distance) of neighbours in the list of pivots that are not equal."""
    gaps = np.sqrt(squared(pivots[:-1], pivots[1:])) if len(pivots) > 1 else []
    return [(i, i + 1, float(g)) for i, g in enumerate(gaps) if g]


def lower_bounds(own: np.ndarray, theirs: np.ndarray, pairs: list[tuple[int, int, float]]) -> np.ndarray:
    """Bounds (vectors x centroids) that no distance is below; ``own`` and ``theirs`` hold
    the distances of vectors and centroids to the pivots."""
    found = np.zeros((len(own), len(theirs)))
    for p, q, gap in pairs:
        one, two = np.outer(own[:, p], theirs[:, q]), np.outer(own[:, q], theirs[:, p])
        bound = (np.abs(one - two) - SLACK * (one + two)) / gap
        np.maximum(found, bound * (1 - SLACK), out=found)
    return found


def nearest(
    v: np.ndarray, own: np.ndarray, centroids: np.ndarray, theirs: np.ndarray, pairs: list
) -> tuple[np.ndarray, np.ndarray, int]:
    """(cluster, squared distance, number of exact distances); ties to the smaller number."""
    bounds = lower_bounds(own, theirs, pairs)
    # The distance of a bound squared, rounded down.
    least = np.floor(bounds * bounds * (1 - 4 * SLACK))
    first = bounds.argmin(axis=1)
    cluster, best = first.copy(), squared(v, centroids[first])
    checked = len(v)
    for c in range(len(centroids)):
        at = np.flatnonzero((first != c) & (least[:, c] <= best))
        d = squared(v[at], centroids[c])
        better = (d < best[at]) | ((d == best[at]) & (c < cluster[at]))
        cluster[at[better]], best[at[better]] = c, d[better]
        checked += len(at)
    return cluster, best, checked


def _columns(batch: pa.RecordBatch, dim: int) -> tuple[np.ndarray, np.ndarray]:
    v, own = batch.column("v"), batch.column("own")
    v = v.flatten().to_numpy().astype(np.int64).reshape(-1, dim)
    return v, own.flatten().to_numpy().reshape(len(v), -1)


def _with_pivots(vectors: DataFrame, pivots: np.ndarray, p: Clustering) -> DataFrame:
    """(vec_id, v, own): the distances of each vector to the pivots."""

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            v = batch.column("v").flatten().to_numpy().astype(np.int64).reshape(-1, p.dim)
            own = np.sqrt(np.stack([squared(v, c) for c in pivots], axis=1).astype(np.float64))
            at = pa.array(np.arange(len(v) + 1, dtype=np.int32) * len(pivots))
            lists = pa.ListArray.from_arrays(at, pa.array(own.ravel()))
            yield pa.RecordBatch.from_arrays([*batch.columns, lists], ["vec_id", "v", "own"])

    return vectors.mapInArrow(run, "vec_id long, v array<int>, own array<double>")


def _sums(table: DataFrame, centroids: np.ndarray, theirs: np.ndarray, pairs: list, p: Clustering) -> DataFrame:
    """(cluster, n, sums): one row a task and cluster."""
    k = len(centroids)

    def run(batches: Iterator[pa.RecordBatch]):
        n, sums = np.zeros(k, dtype=np.int64), np.zeros((k, p.dim), dtype=np.int64)
        for batch in batches:
            v, own = _columns(batch, p.dim)
            cluster, _, _ = nearest(v, own, centroids, theirs, pairs)
            for c in np.unique(cluster):
                n[c] += np.count_nonzero(cluster == c)
                sums[c] += v[cluster == c].sum(axis=0)
        some = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays(
            [pa.array(some.astype(np.int32)), pa.array(n[some]), pa.array(sums[some].tolist(), pa.list_(pa.int64()))],
            ["cluster", "n", "sums"],
        )

    return table.select("v", "own").mapInArrow(run, "cluster int, n long, sums array<long>")


def _moved(table: DataFrame, centroids: np.ndarray, theirs: np.ndarray, pairs: list, p: Clustering) -> np.ndarray:
    """Centroids after a round; k * dim totals come to the driver."""
    parts = _sums(table, centroids, theirs, pairs, p)
    totals = parts.select("cluster", "n", F.posexplode("sums").alias("i", "x")).groupBy("cluster", "i").agg(
        F.sum(F.col("n").cast("decimal(20,0)")).alias("n"), F.sum(F.col("x").cast("decimal(20,0)")).alias("x")
    )
    new = centroids.copy()
    for r in totals.collect():
        new[r.cluster, r.i] = int(r.x) // int(r.n)
    return new


def clusters(
    rows: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", p: Clustering = Clustering()
) -> tuple[DataFrame, np.ndarray]:
    """((vec_id, cluster, distance) of every kept vector, the final centroids).

    Vectors that are null, of another length, or hold null or non-finite components are
    left out; components beyond +-``p.limit`` (1.3e5 before scaling at 64 components)
    count as that limit. Rows that repeat an id are vectors of their own; a row without an
    id is assigned but is no start. Fewer vectors than ``k`` give fewer centroids; without
    any vector that has an id there is none, and the result is empty. Other columns are
    not read.
    """
    vectors = integer_vectors(rows, id_col, vec_col, p)
    centroids = start(vectors, p)
    if not len(centroids):
        return rows.sparkSession.createDataFrame([], "vec_id long, cluster int, distance long"), centroids
    pivots = centroids
    pairs = pivot_pairs(pivots)
    table = staged(_with_pivots(vectors, pivots, p), "vectors")

    def distances(c: np.ndarray) -> np.ndarray:
        return np.sqrt(np.stack([squared(c, x) for x in pivots], axis=1).astype(np.float64))

    for _ in range(p.rounds):
        centroids = _moved(table, centroids, distances(centroids), pairs, p)
    final, theirs = centroids, distances(centroids)

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            cluster, distance, _ = nearest(*_columns(batch, p.dim), final, theirs, pairs)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array(cluster.astype(np.int32)), pa.array(distance)],
                ["vec_id", "cluster", "distance"],
            )

    found = staged(table.mapInArrow(run, "vec_id long, cluster int, distance long"), "clusters")
    dropped(table)
    return found, final


def described(found: DataFrame, centroids: np.ndarray) -> DataFrame:
    """The rows with the inertia of their cluster and of all, and the hash of the centroid.

    An inertia beyond 63 bits is null.
    """
    names = [(c, hashlib.sha256(",".join(map(str, x)).encode()).hexdigest()) for c, x in enumerate(centroids.tolist())]
    hashes = found.sparkSession.createDataFrame(names, "cluster int, centroid_sha256 string")
    total = F.sum(F.col("distance").cast("decimal(20,0)")).try_cast("bigint")
    each = found.groupBy("cluster").agg(total.alias("cluster_inertia"))
    # One row a cluster.
    return found.join(F.broadcast(hashes.join(each, "cluster")), "cluster").select(
        "vec_id",
        "cluster",
        "distance",
        "cluster_inertia",
        found.agg(total.alias("inertia")).scalar().alias("inertia"),
        "centroid_sha256",
    )
