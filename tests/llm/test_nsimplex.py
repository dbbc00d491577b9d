import hashlib
import math
import random

import numpy as np
import pytest

from punchcard.llm.nsimplex import centroid_clusters, nearest, simplex_of

SF_DIR = "/root/testdata/sf0.01"
SCHEMA = "vec_id long, embedding array<float>, cluster string, distance string, x int, apex int"


def plain_clusters(rows, k=40, rounds=5, dims=64):
    """Rows of the result by comparing everything with everything, in Python's integers."""
    kept = []
    for vec_id, vector in rows:
        if vector is not None and len(vector) == dims:
            if all(x is not None and math.isfinite(x) for x in vector):
                kept.append((vec_id, [math.floor(256 * x) for x in vector]))
    def digest(text):
        return hashlib.sha256(text.encode()).hexdigest()

    seeds = sorted(kept, key=lambda r: (digest(f"2:{'' if r[0] is None else r[0]}"), r[1]))
    centroids = [list(vector) for _, vector in seeds[:k]]

    def assign():
        return [
            min((sum((a - b) ** 2 for a, b in zip(x, c)), i) for i, c in enumerate(centroids))
            for _, x in kept
        ]

    for _ in range(rounds):
        found = assign()
        for i in range(len(centroids)):
            own = [x for (_, x), (_, at) in zip(kept, found) if at == i]
            if own:
                centroids[i] = [sum(column) // len(own) for column in zip(*own)]
    found = assign()
    sums = [sum(d for d, at in found if at == i) for i in range(len(centroids))]
    return [
        (vec_id, at, d, sums[at], sum(sums), digest(",".join(map(str, centroids[at]))))
        for (vec_id, _), (d, at) in zip(kept, found)
    ]


def check(spark, rows, **options):
    frame = spark.createDataFrame([(*r, "c", "d", 1, 2) for r in rows], SCHEMA)
    found = centroid_clusters(frame, **options)
    assert found.columns == [
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256",
    ]
    key = lambda r: (r[0] is not None, r)
    as_floats = [(i, v and [x if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    assert sorted(map(tuple, found.collect()), key=key) == sorted(
        plain_clusters(as_floats, **options), key=key
    )
    return found


def test_all_vectors_against_brute_force(spark):
    rows = spark.read.parquet(f"{SF_DIR}/embeddings.parquet").select("vec_id", "embedding").collect()
    check(spark, [tuple(r) for r in rows])


def test_odd_vectors(spark):
    rng = random.Random(1)
    sound = [[rng.gauss(0, 1) for _ in range(4)] for _ in range(60)]
    nan, inf = float("nan"), float("inf")
    odd = [None, [], [1.0] * 3, [1.0] * 5, [None, 1.0, 1.0, 1.0], [nan, 1.0, 1.0, 1.0], [inf, 0.0, 0.0, 0.0]]
    same = [[0.5, 0.25, -0.5, 0.0]] * 90
    rows = list(enumerate([*sound, *odd, *same]))
    check(spark, [*rows, (5, sound[7]), (5, sound[5]), (None, sound[9])], k=9, rounds=3, dims=4)


def test_equal_vectors_and_few(spark):
    check(spark, [(i, [1.0, 2.0]) for i in range(30)], k=8, rounds=2, dims=2)
    check(spark, [(1, [1.0, 2.0]), (2, [3.0, -4.0])], k=8, rounds=2, dims=2)
    check(spark, [(i, [float(i % 4)]) for i in range(40)], k=3, rounds=4, dims=1)


def test_ties_go_to_the_smaller_number(spark):
    rows = [(i, [float(x), float(y)]) for i, (x, y) in enumerate((a % 5, a // 5) for a in range(25))]
    check(spark, rows, k=7, rounds=4, dims=2)


def test_empty_tables(spark):
    assert check(spark, [], k=4, dims=3).count() == 0
    assert check(spark, [(1, None), (2, [1.0])], k=4, dims=3).count() == 0


def test_very_large_components_are_cut(spark):
    rows = [(i, [1e30 * (-1) ** i, float(i)]) for i in range(6)]
    frame = spark.createDataFrame([(*r, "c", "d", 1, 2) for r in rows], SCHEMA)
    found = centroid_clusters(frame, k=2, rounds=2, dims=2).collect()
    assert len(found) == 6 and all(r.distance >= 0 for r in found)


@pytest.mark.parametrize("spread", [0, 1, 40])
def test_bounds_rule_out_only_what_is_farther(spread):
    """Groups of vectors far from the origin, many of them equal: bounds are tight there."""
    rng = np.random.default_rng(spread)
    middles = rng.integers(-2000, 2000, (30, 24)) + 50_000
    vectors = np.repeat(middles, 40, axis=0)
    vectors = vectors + rng.integers(-spread, spread + 1, vectors.shape)
    centroids = vectors[rng.permutation(len(vectors))[:25]]
    simplex = simplex_of(centroids, 8)
    assert len(simplex.pivots) == 8
    tips, apexes = simplex.apexes(centroids), simplex.apexes(vectors)
    squares = ((vectors[:, None] - centroids[None]) ** 2).sum(axis=2)
    flat = ((apexes[:, None] - tips[None]) ** 2).sum(axis=2)
    assert (flat <= squares * (1 + 1e-6) + 1e-3).all()
    assert (flat + 4 * np.outer(apexes[:, -1], tips[:, -1]) >= squares * (1 - 1e-6) - 1e-3).all()
    cluster, distance, compared = nearest(vectors, apexes, centroids, tips)
    assert (distance == squares.min(axis=1)).all()
    assert (cluster == squares.argmin(axis=1)).all()
    assert compared < squares.size / 2
