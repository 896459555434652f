import hashlib
import math

import numpy as np

from aeroskein.llm.centroids import cluster, cluster_sums, clustered_vectors, first_centroids, integer_vectors, with_distances


def vectors_of(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", 0) for r in rows], "vec_id long, embedding array<double>, label int, cluster string, distance int")


def brute(rows, k=16, rounds=3):
    """Lloyd rounds with Python integers and all differences."""
    kept = [(i, [math.floor(64 * v) for v in e]) for i, e in rows if e is not None and len(e) == 64 and all(v is not None and math.isfinite(v) for v in e)]
    order = sorted((hashlib.sha256(f"1:{'' if i is None else i}".encode()).hexdigest(), x) for i, x in kept)
    centroids = [x for _, x in order[:k]]
    nearest = lambda x: min((sum((a - b) ** 2 for a, b in zip(x, c)), n) for n, c in enumerate(centroids))
    for _ in range(rounds):
        groups = {}
        for _, x in kept:
            groups.setdefault(nearest(x)[1], []).append(x)
        for c, xs in groups.items():
            centroids[c] = [sum(v) // len(xs) for v in zip(*xs)]
    found = [(i, *nearest(x)[::-1]) for i, x in kept]
    inertia = {c: sum(d for _, k, d in found if k == c) for c in range(len(centroids))}
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted((repr(i), c, d, inertia[c], sum(inertia.values()), sha[c]) for i, c, d in found)


def rows_of(df):
    return sorted((repr(r.vec_id), r.cluster, r.distance, r.cluster_inertia, r.inertia, r.centroid_sha256) for r in df.collect())


def test_rounds_equal_brute_force(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=64).tolist()) for i in range(150)]
    rows += [(1000 + i, rows[0][1]) for i in range(80)]  # a third of all vectors are one
    rows += [(7, rows[7][1]), (7, rows[8][1]), (None, rows[9][1]), (None, rows[9][1])]  # repeated rows, repeated and null ids
    rows += [(501, None), (502, []), (503, rows[0][1][:63]), (504, [None] + rows[0][1][1:]), (505, [math.nan] + rows[0][1][1:]), (506, [math.inf] + rows[0][1][1:]), (507, [0.0] * 64)]
    assert rows_of(clustered_vectors(vectors_of(spark, rows))) == brute(rows)


def test_fewer_vectors_than_centroids_and_none(spark):
    rows = [(i, [float(i % 2)] * 64) for i in range(5)]  # equal centroids: ties go to the smaller number, the others stay empty
    found = rows_of(clustered_vectors(vectors_of(spark, rows)))
    assert found == brute(rows) and len({c for _, c, *_ in found}) == 2
    assert clustered_vectors(vectors_of(spark, [(1, None)])).collect() == []
    assert clustered_vectors(vectors_of(spark, [])).columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


def test_products_follow_the_changed_components_alone(spark):
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(size=8).tolist()) for i in range(40)]
    kept = integer_vectors(vectors_of(spark, rows), dim=8)
    found = cluster(kept, k=4, rounds=2, dim=8)
    for row in found.vectors.collect():
        assert row.dots == (found.centroids @ np.array(row.x)).tolist() and row.norm == sum(v * v for v in row.x)
    moved = found.centroids.copy()
    moved[2, 5] += 3
    spoilt = found.vectors.selectExpr("vec_id", "transform(x, (v, i) -> if(i = 5, v, 0)) as x", "norm", "dots")  # the others aren't read
    for row in with_distances(spoilt, found.centroids, moved).join(kept.withColumnRenamed("x", "full"), "vec_id").collect():
        assert row.dots == (moved @ np.array(row.full)).tolist()


def test_ranges_and_sums(spark):
    big = vectors_of(spark, [(1, [3e4] * 64), (2, [-(2.0**21)] + [0.0] * 63), (3, [1e300] + [0.0] * 63)])
    assert [r.vec_id for r in integer_vectors(big).collect()] == [1]  # integers of 2^27 and more have no exact long distances
    assert first_centroids(integer_vectors(big), 16).shape == (1, 64)
    sums = cluster_sums(spark.createDataFrame([(0, [1, -2]), (0, [4, 5]), (1, [7, 7])], "cluster int, x array<int>"), 2).collect()
    assert {r.cluster: (r.n, r.sums) for r in sums} == {0: (2, [5, 3]), 1: (1, [7, 7])}
