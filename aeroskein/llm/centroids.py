"""Lloyd rounds over integer vectors that keep their dot products with all centroids.

The dot products of every vector are exact integers and stay in a table between the rounds.
When a centroid moves, only its components that changed are multiplied again: the product
grows by their changes times the vector's components. Centroids start at the origin, so the
first products come about the same way. Squared distances follow from the products and the
norms, and the nearest centroid is found anew each round.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aeroskein.llm.common import batches, staged

#: A component may be this large: 64 squared differences of twice that still fit a long.
LARGEST = 1 << 27
#: Rows that are multiplied at once.
BLOCK = 8_192


@dataclass(frozen=True)
class Clusters:
    """vectors: (vec_id, x, norm, dots, cluster, distance), one row a vector; centroids: one row each."""

    vectors: DataFrame
    centroids: np.ndarray


def integer_vectors(vectors: DataFrame, dim: int = 64, scale: float = 64.0, embedding: str = "embedding") -> DataFrame:
    """(vec_id, x): the vectors with exactly `dim` finite components, each as floor(scale * component).

    Null vectors, vectors of another length and those that hold null, NaN or an infinity are left
    out. So are those with an integer beyond 2^27, whose squared distances a long can't hold.
    """
    e = F.col(embedding)
    fine = F.forall(e, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v.cast("double") * scale) < LARGEST))
    whole = F.transform(e, lambda v: F.floor(v.cast("double") * F.lit(float(scale))).cast("int"))
    return vectors.where(e.isNotNull() & (F.size(e) == dim) & fine).select("vec_id", whole.alias("x"))


def hash_order(salt: str = "1") -> Column:
    """Lowercase hex SHA-256 of salt:vec_id; a null id counts as an empty one."""
    return F.sha2(F.concat(F.lit(f"{salt}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))).cast("binary"), 256)


def first_centroids(vectors: DataFrame, k: int, salt: str = "1") -> np.ndarray:
    """The k vectors with the smallest hashes of their ids (of one id, the smaller components first): k rows come to the driver."""
    rows = vectors.select(hash_order(salt).alias("h"), "x").orderBy("h", "x").limit(k).collect()
    return np.array([r.x for r in rows], dtype=np.int64)


def _moved(old: np.ndarray, new: np.ndarray) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """(centroid, components that changed, by how much) of every centroid that moved."""
    changes = new - old
    return [(c, at, changes[c, at]) for c in range(len(new)) if len(at := np.flatnonzero(changes[c]))]


def with_distances(vectors: DataFrame, old: np.ndarray, new: np.ndarray) -> DataFrame:
    """`vectors` with dot products, nearest centroid and squared distance after centroids went from `old` to `new`.

    Of equally near centroids the one with the smaller number is the nearest. What goes to every
    task is the changes and norms of the centroids, at most k times dim numbers.
    """
    changes, squares, k = _moved(old, new), (new * new).sum(axis=1), len(new)

    def step(frames):
        for frame in batches(frames, BLOCK):
            x = np.array(frame["x"].tolist(), dtype=np.int64)
            dots = np.array(frame["dots"].tolist(), dtype=np.int64).reshape(len(frame), k)
            for c, at, by in changes:
                dots[:, c] += x[:, at] @ by
            far = frame["norm"].to_numpy()[:, None] - 2 * dots + squares
            nearest = far.argmin(axis=1)
            yield frame.assign(dots=list(dots), cluster=nearest.astype(np.int32), distance=far[np.arange(len(far)), nearest])

    return vectors.select("vec_id", "x", "norm", "dots").mapInPandas(step, "vec_id long, x array<int>, norm long, dots array<long>, cluster int, distance long")


def cluster_sums(vectors: DataFrame, dim: int) -> DataFrame:
    """(cluster, n, sums): one row of sums a task and cluster is shuffled, whatever the clusters' sizes."""
    sums = F.array(*[F.sum(F.col("x")[i].cast("long")) for i in range(dim)])
    return vectors.groupBy("cluster").agg(F.count("*").alias("n"), sums.alias("sums"))


def cluster(vectors: DataFrame, k: int = 16, rounds: int = 3, salt: str = "1", dim: int = 64) -> Clusters:
    """Assign, move every centroid to the floored mean of its vectors, `rounds` times; then assign once more.

    `vectors` is (vec_id, x). A centroid without vectors stays. With fewer than k vectors each
    is a centroid; without any, the result is empty. Equal vectors and ids each count. Every
    round's table is written to the shared folder, so a lost executor costs a reread.
    """
    norm = F.aggregate("x", F.lit(0).cast("long"), lambda a, v: a + v.cast("long") * v.cast("long"))
    vectors = staged(vectors.select("vec_id", "x", norm.alias("norm")), "integers")
    new = first_centroids(vectors, k, salt)
    new = new.reshape(len(new), dim)
    old = np.zeros_like(new)
    table = vectors.withColumn("dots", F.array(*[F.lit(0).cast("long")] * len(new)).cast("array<long>"))
    if not len(new):
        return Clusters(table.withColumns({"cluster": F.lit(None).cast("int"), "distance": F.lit(None).cast("long")}), new)
    for left in range(rounds, -1, -1):
        table = staged(with_distances(table, old, new), "products")
        if not left:
            return Clusters(table, new)
        old, new = new, new.copy()
        for row in cluster_sums(table, dim).collect():
            new[row.cluster] = [s // row.n for s in row.sums]


def clustered_vectors(vectors: DataFrame, k: int = 16, rounds: int = 3) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256: one row per kept vector.

    The sums of distances are null where a long can't hold them. What is joined to the vectors is
    one row a cluster, at most k.
    """
    found = cluster(integer_vectors(vectors), k, rounds)
    digests = [(c, hashlib.sha256(",".join(map(str, row.tolist())).encode()).hexdigest()) for c, row in enumerate(found.centroids)]
    spark = vectors.sparkSession
    names = spark.createDataFrame(pd.DataFrame(digests, columns=["cluster", "centroid_sha256"]), "cluster int, centroid_sha256 string")
    within = found.vectors.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("_sum"))
    whole = within.agg(F.sum("_sum").alias("_all"))
    sums = within.join(whole).join(names, "cluster").selectExpr("cluster", "try_cast(_sum as long) as cluster_inertia", "try_cast(_all as long) as inertia", "centroid_sha256")
    return found.vectors.join(F.broadcast(sums), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
