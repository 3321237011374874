"""Clusters of integer vectors: rounds of nearest centroids found by a vantage-point tree."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlight.llm.common import stored

#: Centroids of a leaf, of which all distances are taken.
LEAF = 2
#: Components lie between the negative of this and this, so that distances fit 64 bits.
MOST = 1 << 26
#: Vectors that a task searches for at once.
AT_ONCE = 8192
#: Distances are compared with bounds from square roots; their error is far smaller than this share.
SLACK = 1e-9


class VantageTree:
    """Centroids in nested balls.

    A node has a vantage point, which is a centroid, and two children: the centroids no
    farther from it than the median, and the others.  Each child knows between which
    distances from the vantage point its centroids lie.  A leaf lists a few centroids.
    """

    def __init__(self, centroids: np.ndarray) -> None:
        self.centroids = centroids
        self.vantage: list[int] = []
        self.leaf: list[list[int]] = []
        #: (node, nearest, farthest) of each child of a node
        self.children: list[list[tuple[int, float, float]]] = []
        if len(centroids):
            self._grow(np.arange(len(centroids)))

    def _grow(self, members: np.ndarray) -> int:
        node = len(self.vantage)
        self.vantage.append(-1)
        self.leaf.append([])
        self.children.append([])
        if len(members) <= LEAF:
            self.leaf[node] = members.tolist()
            return node
        # the farthest from the others' mean sees them at the most different distances
        middle = self.centroids[members].mean(axis=0)
        far = int(np.argmax(((self.centroids[members] - middle) ** 2).sum(axis=1)))
        point, rest = int(members[far]), np.delete(members, far)
        gaps = np.sqrt(squares(self.centroids[rest], self.centroids[point]).astype(float))
        order = np.argsort(gaps, kind="stable")
        half = (len(rest) + 1) // 2
        self.vantage[node] = point
        for part in (order[:half], order[half:]):
            if len(part):
                child = self._grow(rest[part])
                self.children[node].append((child, float(gaps[part].min()), float(gaps[part].max())))
        return node

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of, and squared distance to, the nearest centroid of each vector; the smaller number on ties.

        Every vector goes through the tree by itself, at each step to the node whose
        bound is least of those that it has met, and ends when that bound is greater
        than the best distance.  A node at the very distance is still looked at, for it
        may hold a tie.  The vectors at one node are taken together.
        """
        size, nodes = len(vectors), len(self.vantage)
        best = np.full(size, np.iinfo(np.int64).max)
        number = np.full(size, len(self.centroids))
        bound = np.full((size, nodes), np.inf)
        bound[:, 0] = 0.0
        active = np.arange(size)
        while len(active):
            node = np.argmin(bound[active], axis=1)
            least = bound[active, node]
            open_ = least <= np.sqrt(best[active].astype(float)) * (1 + SLACK)
            active, node = active[open_ & np.isfinite(least)], node[open_ & np.isfinite(least)]
            bound_here = bound[active, node]
            bound[active, node] = np.inf
            for k in np.unique(node).tolist():
                rows, floor = active[node == k], bound_here[node == k]
                for c in self.leaf[k]:
                    self._meet(c, squares(vectors[rows], self.centroids[c]), rows, best, number)
                if self.vantage[k] >= 0:
                    exact = squares(vectors[rows], self.centroids[self.vantage[k]])
                    self._meet(self.vantage[k], exact, rows, best, number)
                    gap = np.sqrt(exact.astype(float))
                    for child, low, high in self.children[k]:
                        away = np.maximum(gap - high, low - gap) - SLACK * (gap + high)
                        bound[rows, child] = np.maximum(floor, np.maximum(away, 0.0))
        return number, best

    @staticmethod
    def _meet(c: int, exact: np.ndarray, rows: np.ndarray, best: np.ndarray, number: np.ndarray) -> None:
        nearer = (exact < best[rows]) | ((exact == best[rows]) & (c < number[rows]))
        best[rows[nearer]] = exact[nearer]
        number[rows[nearer]] = c


def squares(vectors: np.ndarray, point: np.ndarray) -> np.ndarray:
    """Squared distances of rows to a point, in whole numbers."""
    away = vectors - point
    return np.einsum("ij,ij->i", away, away)


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return np.asarray(column.flatten()).astype(np.int64).reshape(-1, width)


def _sums(tree, width: int):
    """(cluster, n, sums) of what a task has."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = len(tree.value.centroids)
        counts, sums = np.zeros(size, np.int64), np.zeros((size, width), np.int64)
        for batch in batches:
            for start in range(0, batch.num_rows, AT_ONCE):
                vectors = _matrix(batch.column("_units").slice(start, AT_ONCE), width)
                of = tree.value.nearest(vectors)[0]
                counts += np.bincount(of, minlength=size)
                np.add.at(sums, of, vectors)
        held = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(held.astype(np.int32)), pa.array(counts[held]), pa.array(sums[held].tolist(), pa.list_(pa.int64()))],
            names=["cluster", "n", "sums"],
        )

    return emit


def _assigned(tree, width: int):
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, AT_ONCE):
                part = batch.slice(start, AT_ONCE)
                of, gap = tree.value.nearest(_matrix(part.column("_units"), width))
                yield pa.RecordBatch.from_arrays(
                    [part.column("vec_id"), pa.array(of.astype(np.int32)), pa.array(gap)], names=["vec_id", "cluster", "distance"]
                )

    return emit


def integer_vectors(rows: DataFrame, width: int, scale: int) -> DataFrame:
    """(vec_id, _units) of the vectors of ``width`` components, all of them numbers: floors of ``scale`` times each."""
    whole = F.forall("_v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    vectors = rows.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").cast("array<double>").alias("_v"))
    usable = vectors.where((F.size("_v") == width) & whole)
    limit = float(MOST)
    # the floor of a double is taken between the limits, so no cast can overflow
    scaled = F.transform("_v", lambda x: F.floor(F.greatest(F.least(x * F.lit(float(scale)), F.lit(limit)), F.lit(-limit))).cast("int"))
    return usable.select("vec_id", scaled.alias("_units"))


def first_centroids(vectors: DataFrame, k: int, seed: str) -> np.ndarray:
    """The k vectors whose ids have the smallest sha256 after ``seed:``, in that order."""
    drawn = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    rows = vectors.orderBy(drawn.asc_nulls_last(), "_units").limit(k).select("_units").collect()
    return np.array([r[0] for r in rows], np.int64)


def digest(centroid: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, centroid.tolist())).encode()).hexdigest()


def vantage_clusters(
    rows: DataFrame, k: int = 8, rounds: int = 10, width: int = 64, scale: int = 1024, seed: str = "3"
) -> tuple[DataFrame, np.ndarray]:
    """(vec_id, cluster, distance) of each kept vector, and the final centroids.

    Vectors of exactly ``width`` components, none null or non-finite, are kept, their
    components as floor(``scale`` * x); beyond MOST in either direction a component
    counts as MOST, so that every distance fits 64 bits.  The first centroids are drawn
    by the hash of the ids; a null id is drawn last.  Each round assigns all vectors to
    their nearest centroid, the smaller number on ties, and moves each centroid that has
    vectors to the floor of their mean.  Rows of one id, and equal vectors, count one by
    one; with fewer than ``k`` vectors there are as many centroids.  Columns but vec_id
    and embedding are ignored; an empty table gives an empty result and no centroids.

    Whole vectors are stored once, in the shared folder.  A round broadcasts the tree of
    the k centroids and brings back k sums of each task, added up by cluster in Spark, so
    neither a large cluster nor equal vectors gather anywhere; the driver sees k rows.
    """
    spark = rows.sparkSession
    vectors = stored(integer_vectors(rows, width, scale))
    centroids = first_centroids(vectors, k, seed)
    if not len(centroids):
        return spark.createDataFrame([], "vec_id bigint, cluster int, distance bigint"), np.empty((0, width), np.int64)
    total = [F.sum(F.get("sums", F.lit(i))).alias(f"s{i}") for i in range(width)]
    for _ in range(rounds):
        tree = spark.sparkContext.broadcast(VantageTree(centroids))
        sums = vectors.mapInArrow(_sums(tree, width), "cluster int, n bigint, sums array<bigint>")
        moved = centroids.copy()
        for cluster, n, *parts in sums.groupBy("cluster").agg(F.sum("n"), *total).collect():
            moved[cluster] = np.array(parts, np.int64) // n
        tree.unpersist()
        if np.array_equal(moved, centroids):
            break  # a further round would give the same
        centroids = moved
    tree = spark.sparkContext.broadcast(VantageTree(centroids))
    return vectors.mapInArrow(_assigned(tree, width), "vec_id bigint, cluster int, distance bigint"), centroids


def clustered(rows: DataFrame, **choices: int | str) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia and centroid_sha256 of each kept vector."""
    assigned, centroids = vantage_clusters(rows, **choices)
    spark = rows.sparkSession
    assigned = stored(assigned)
    by_cluster = assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("_own")).collect()
    everything = sum(r._own for r in by_cluster)
    facts = [(r.cluster, r._own, everything, digest(centroids[r.cluster])) for r in by_cluster]
    kind = "_c int, _own decimal(38,0), _all decimal(38,0), centroid_sha256 string"
    known = spark.createDataFrame(facts, kind)
    # as many rows as there are centroids
    joined = assigned.join(F.broadcast(known), F.col("cluster") == F.col("_c"))
    return joined.select(
        "vec_id",
        "cluster",
        "distance",
        F.expr("try_cast(_own AS bigint)").alias("cluster_inertia"),
        F.expr("try_cast(_all AS bigint)").alias("inertia"),
        "centroid_sha256",
    )
