"""Integer centroid clustering, with centroids ruled out by an n-simplex projection.

A few of the first centroids serve as pivots. The distances of a vector to them fix
the apex of a simplex over the pivots: coordinates within the pivots' span, and the
height above it. Two apexes bound the distance of their vectors from below (heights on
one side) and from above (on opposite sides). Apexes are computed once and stored with
the vectors; in each round only centroids that the bounds leave open are compared, in
whole numbers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from punchcard.llm.common import batch_of, in_batches, written

# Components go no further than this, so that every squared distance fits a long.
LIMIT = 1 << 27
LONG_MAX = (1 << 63) - 1
# A pivot must stand above the span of the others by this share of the widest distance.
_HEIGHT = 1e-2
# What rounding may add to a squared bound, as a share of the squares that it is made of.
_SLACK = 1e-7


def whole(values: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x) of finite doubles, within ``LIMIT``."""
    return np.clip(np.floor(values * scale), -LIMIT, LIMIT).astype(np.int64)


def _squares(vectors: np.ndarray, point: np.ndarray) -> np.ndarray:
    """Exact squared distances of whole vectors to a point."""
    apart = vectors - point
    return np.einsum("ij,ij->i", apart, apart)


class Simplex(NamedTuple):
    """Pivots, and the base simplex they span with the first of them at the origin."""

    pivots: np.ndarray  # (k, dims), whole numbers
    corners: np.ndarray  # (k - 1, k - 1), lower triangular: the other pivots' coordinates

    def apexes(self, vectors: np.ndarray) -> np.ndarray:
        """(n, k): k - 1 coordinates within the span, then the height."""
        squares = np.stack([_squares(vectors, p) for p in self.pivots], axis=1).astype(float)
        first = squares[:, :1]
        lengths = np.einsum("ij,ij->i", self.corners, self.corners)
        inside = np.linalg.solve(self.corners, (first + lengths - squares[:, 1:]).T / 2).T
        height = np.sqrt(np.maximum(first[:, 0] - np.einsum("ij,ij->i", inside, inside), 0))
        return np.column_stack([inside, height])


def simplex_of(points: np.ndarray, pivots: int) -> Simplex:
    """At most ``pivots`` of the points, each chosen for its height above those before it.

    The first is the one with the largest sum of distances. Points too close to the
    span are no pivots, so that the coordinates are well conditioned.
    """
    squares = np.stack([_squares(points, p) for p in points]).astype(float)
    chosen = [int(np.sqrt(squares).sum(axis=0).argmax())]
    first = squares[chosen[0]]
    gram = (first[:, None] + first[None, :] - squares) / 2
    rows = np.zeros((len(points), 0))
    left = np.diag(gram).copy()
    least = _HEIGHT**2 * squares.max()
    while len(chosen) < pivots and left.max() > least:
        at = int(left.argmax())
        column = (gram[:, at] - rows @ rows[at]) / np.sqrt(left[at])
        rows = np.column_stack([rows, column])
        left -= column**2
        left[at] = 0
        chosen.append(at)
    return Simplex(points[chosen], np.tril(rows[chosen[1:]]))


def nearest(
    vectors: np.ndarray, apexes: np.ndarray, centroids: np.ndarray, tips: np.ndarray
) -> tuple[np.ndarray, np.ndarray, int]:
    """The nearest centroid of each vector, its exact squared distance, and the number
    of exact comparisons. Of equally near centroids the first counts."""
    n = len(vectors)
    lengths = np.einsum("ij,ij->i", apexes, apexes)[:, None]
    ends = np.einsum("ij,ij->i", tips, tips)
    flat = lengths + ends - 2 * (apexes @ tips.T)
    heights = 4 * np.outer(apexes[:, -1], tips[:, -1])
    slack = _SLACK * (lengths + ends) + 1e-6
    lower, upper = flat - slack, flat + heights + slack
    open_ = lower <= upper.min(axis=1)[:, None]
    # The likeliest centroid first: its exact distance closes most of the others.
    cluster = (lower + upper).argmin(axis=1)
    distance = np.einsum("ij,ij->i", vectors - centroids[cluster], vectors - centroids[cluster])
    open_ &= lower <= distance[:, None]
    open_[np.arange(n), cluster] = False
    compared = n
    for number in np.flatnonzero(open_.any(axis=0)).tolist():
        rows = np.flatnonzero(open_[:, number])
        compared += len(rows)
        found = _squares(vectors[rows], centroids[number])
        better = (found < distance[rows]) | (
            (found == distance[rows]) & (number < cluster[rows])
        )
        distance[rows[better]] = found[better]
        cluster[rows[better]] = number
    return cluster, distance, compared


def _lists(values: np.ndarray) -> pa.Array:
    offsets = np.arange(0, values.size + 1, values.shape[1], dtype=np.int32)
    return pa.ListArray.from_arrays(offsets, pa.array(values.ravel()))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _projected(dims: int, scale: int, simplex: Simplex):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            right = pa.compute.fill_null(
                pa.compute.equal(pa.compute.list_value_length(batch.column("v")), dims), False
            )
            batch = batch.filter(right)
            values = _matrix(batch.column("v"), dims).astype(float)  # a null becomes NaN
            finite = np.isfinite(values).all(axis=1)
            if finite.any():
                vectors = whole(values[finite], scale)
                yield batch_of(
                    id=(batch.column("id").filter(pa.array(finite)), None),
                    x=(_lists(vectors), None),
                    apex=(_lists(simplex.apexes(vectors)), None),
                )

    return run


def _assigned(batch: pa.RecordBatch, centroids: np.ndarray, tips: np.ndarray):
    vectors = _matrix(batch.column("x"), centroids.shape[1])
    apexes = _matrix(batch.column("apex"), tips.shape[1])
    return vectors, *nearest(vectors, apexes, centroids, tips)[:2]


def _sums(centroids: np.ndarray, tips: np.ndarray):
    """For each task and cluster the number of vectors and the sum of each component."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(len(centroids), np.int64)
        sums = np.zeros(centroids.shape, np.int64)
        for batch in batches:
            if batch.num_rows:
                vectors, cluster, _ = _assigned(batch, centroids, tips)
                n += np.bincount(cluster, minlength=len(n))
                np.add.at(sums, cluster, vectors)
        some = np.flatnonzero(n)
        if len(some):
            yield batch_of(
                cluster=(some.tolist(), pa.int32()),
                n=(n[some].tolist(), pa.int64()),
                s=(_lists(sums[some]), None),
            )

    return run


def _final(centroids: np.ndarray, tips: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                _, cluster, distance = _assigned(batch, centroids, tips)
                yield batch_of(
                    id=(batch.column("id"), None),
                    cluster=(pa.array(cluster.astype(np.int32)), None),
                    distance=(pa.array(distance), None),
                )

    return run


def _seeds(rows: DataFrame, k: int, dims: int, scale: int, seed: int) -> np.ndarray:
    """The k kept vectors with the least digests, in their order."""
    sound = F.forall("v", lambda x: x.isNotNull() & (F.abs(x) < float("inf")) & ~F.isnan(x))
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256)
    # Digests are equal only where ids repeat; then the components decide.
    first = rows.filter((F.size("v") == dims) & sound).orderBy(digest, "v").limit(k)
    found = [row.v for row in first.select("v").collect()]
    return whole(np.array(found, float).reshape(-1, dims), scale)


def centroid_clusters(
    vectors: DataFrame,
    k: int = 40,
    rounds: int = 5,
    dims: int = 64,
    scale: int = 256,
    seed: int = 2,
    pivots: int = 40,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """One row per kept vector: ``id_col``, cluster, distance (squared), cluster_inertia,
    inertia, centroid_sha256.

    Kept are vectors of exactly ``dims`` components, none of them null, infinite or NaN;
    a component x counts as floor(scale * x), cut to ±2^27 so that distances fit a long.
    The first centroids are the k kept vectors with the least sha256 of "seed:id" (a null
    id counts as empty; rows with one id by their components). With fewer vectors there
    are as many centroids; an empty table gives no rows. Repeated rows count each, and of
    equal centroids the first gets the vectors. An empty cluster keeps its centroid. Sums of
    distances beyond a long stay at its largest value. Other columns are ignored.

    Vectors are stored once with their apexes; a round is one pass over them that shuffles
    a row of sums for each task and cluster. What reaches the driver is k rows a round.
    """
    rows = vectors.select(
        F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("v")
    )
    kind = vectors.schema[id_col].dataType.simpleString()
    spark = vectors.sparkSession
    centroids = _seeds(rows, k, dims, scale, seed)
    if not len(centroids):
        return spark.createDataFrame(
            [],
            f"`{id_col}` {kind}, cluster int, distance long, cluster_inertia long, "
            "inertia long, centroid_sha256 string",
        )
    simplex = simplex_of(centroids, pivots)
    stored = written(
        in_batches(
            rows, _projected(dims, scale, simplex), f"id {kind}, x array<long>, apex array<double>"
        ),
        "apexes",
    )
    for _ in range(rounds):
        partial = in_batches(
            stored.select("x", "apex"),
            _sums(centroids, simplex.apexes(centroids)),
            "cluster int, n long, s array<long>",
        )
        # Decimals, as the sums of a very large table pass a long.
        totals = [F.sum(F.col("s")[j].cast("decimal(38,0)")) for j in range(dims)]
        summed = partial.groupBy("cluster").agg(F.sum("n").alias("n"), F.array(*totals).alias("s"))
        for row in summed.collect():
            centroids[row.cluster] = [int(s) // row.n for s in row.s]
    last = written(
        in_batches(
            stored, _final(centroids, simplex.apexes(centroids)), f"id {kind}, cluster int, distance long"
        ),
        "assigned",
    )
    inertia = last.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("i"))
    sums = {row.cluster: int(row.i) for row in inertia.collect()}
    total = min(sum(sums.values()), LONG_MAX)
    named = [
        (c, min(s, LONG_MAX), total, hashlib.sha256(",".join(map(str, centroids[c])).encode()).hexdigest())
        for c, s in sums.items()
    ]
    about = spark.createDataFrame(
        named, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string"
    )
    return last.join(F.broadcast(about), "cluster").select(
        F.col("id").alias(id_col), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
