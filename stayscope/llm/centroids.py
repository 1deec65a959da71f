"""K-means in integers with equal-average equal-variance search, in Arrow batches.

Vectors become integers, ``floor(256 * x)`` per component, so that sums, distances and centroids are
exact and do not depend on how rows are dealt out. The first centroids are the vectors with the smallest
hash of their id. A round assigns every vector to its nearest centroid (squared Euclidean distance, ties to
the smaller number) and replaces each centroid by the floor of its vectors' mean; one without vectors stays.

Method. Centroids lie sorted by component sum. A vector starts at its own place in that order and scans
outward, the nearer side first. With S the sum of k components and D the length of the deviation from the
mean, d^2 >= (S_x - S_c)^2 / k + (D_x - D_c)^2. The first term alone ends the scan, as it only grows; both
together reject a single centroid. What remains is compared by exact integer distance, so that the
bounds save work and never change a result. Sums are compared as integers, deviations with a
margin above their rounding. All vectors of a batch take each step together.

The integer vectors are written once and read in every round. A task keeps k sums and counts, whatever
its number of rows; the driver receives k rows a round. No vector is shuffled, so a vector that a
third of all rows repeat costs nothing extra.

Edge cases: vectors that are null, of another length, or with a null or non-finite component are left
out. Components beyond +-65,536 count as that bound, so that every squared distance fits a long. With fewer
vectors than k there are as many centroids as vectors; an empty table gives no rows. Null ids come last
in the order of the first centroids; vectors of one id are separate rows, of equal hash, in the order of their components.
Sums of distances beyond a long are null. Extra columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayscope.llm.common import ship
from stayscope.storage import materialise

DIMENSIONS = 64
CENTROIDS = 40
ROUNDS = 5
SEED = 2
SCALE = 256
LIMIT = 1 << 24
#: Above the relative error of a difference of two square roots in double precision.
MARGIN = 1e-13


def quantise(vectors: DataFrame, id_col: str, vector_col: str, dimensions: int = DIMENSIONS) -> DataFrame:
    """``id, v``: the usable vectors as integers."""
    finite = F.forall("x", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    held = vectors.select(
        F.col(f"`{id_col}`").alias("id"), F.col(f"`{vector_col}`").cast("array<double>").alias("x")
    ).where((F.size("x") == dimensions) & finite)

    def whole(x):
        scaled = F.least(F.greatest(x * SCALE, F.lit(float(-LIMIT))), F.lit(float(LIMIT)))
        return F.floor(scaled).cast("int")

    return held.select("id", F.transform("x", whole).alias("v"))


class Search:
    """The nearest of some centroids, by equal-average equal-variance search."""

    def __init__(self, centroids: np.ndarray):
        sums = centroids.sum(axis=1)
        self.order = np.argsort(sums, kind="stable")
        self.sums = sums[self.order]
        self.centroids = centroids[self.order]
        self.deviations = self._deviations(self.centroids, self.sums)

    @staticmethod
    def _deviations(rows: np.ndarray, sums: np.ndarray) -> np.ndarray:
        k = rows.shape[1]
        return np.sqrt((k * (rows * rows).sum(axis=1) - sums * sums) / k)

    def nearest(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of the nearest centroid and squared distance of each row of int64 components."""
        n, k = rows.shape
        m = len(self.sums)
        best = np.full(n, np.iinfo(np.int64).max)
        number = np.full(n, m)
        sums = rows.sum(axis=1)
        deviations = self._deviations(rows, sums)
        right = np.searchsorted(self.sums, sums)
        left = right - 1
        active = np.arange(n)
        while len(active):
            a, b, own = left[active], right[active], sums[active]
            to_left = np.where(a >= 0, own - self.sums[np.maximum(a, 0)], np.iinfo(np.int64).max)
            to_right = np.where(b < m, self.sums[np.minimum(b, m - 1)] - own, np.iinfo(np.int64).max)
            leftward = to_left <= to_right
            gap = np.where(leftward, to_left, to_right)
            at = np.where(leftward, a, b)
            # The nearer side ends the scan: all centroids left lie further away in their sums.
            found = best[active]
            known = number[active] < m
            going = (a >= 0) | (b < m)
            going[going] = ~known[going] | (gap[going] ** 2 <= k * np.where(known, found, 0)[going])
            active, at, gap, leftward, known = (x[going] for x in (active, at, gap, leftward, known))
            left[active[leftward]] -= 1
            right[active[~leftward]] += 1
            ours, theirs = deviations[active], self.deviations[at]
            bound = gap.astype(np.float64) ** 2 / k + (ours - theirs) ** 2 - MARGIN * (ours + theirs) ** 2
            open_ = ~known | (bound * (1 - MARGIN) <= best[active])
            i, at = active[open_], at[open_]
            d = ((rows[i] - self.centroids[at]) ** 2).sum(axis=1)
            c = self.order[at]
            closer = (d < best[i]) | ((d == best[i]) & (c < number[i]))
            best[i[closer]] = d[closer]
            number[i[closer]] = c[closer]
        return number, best


def _rows(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, width)


def _assign(integers: DataFrame, centroids: np.ndarray) -> DataFrame:
    """``id, cluster, distance`` of every vector."""
    width = centroids.shape[1]

    def run(batches):
        search = Search(centroids)
        for batch in batches:
            number, distance = search.nearest(_rows(batch.column(1), width))
            made = [batch.column(0), pa.array(number, pa.int32()), pa.array(distance, pa.int64())]
            yield pa.RecordBatch.from_arrays(made, names=["id", "cluster", "distance"])

    kind = integers.schema["id"].dataType.simpleString()
    return integers.mapInArrow(run, f"id {kind}, cluster int, distance long")


def _means(integers: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The centroids after one round."""
    count, width = centroids.shape

    def run(batches):
        search = Search(centroids)
        sums, sizes = np.zeros((count, width), dtype=np.int64), np.zeros(count, dtype=np.int64)
        for batch in batches:
            rows = _rows(batch.column(1), width)
            number, _ = search.nearest(rows)
            by_cluster = np.argsort(number, kind="stable")
            present, first = np.unique(number[by_cluster], return_index=True)
            if len(present):
                sums[present] += np.add.reduceat(rows[by_cluster], first, axis=0)
                sizes += np.bincount(number, minlength=count)
        held = np.flatnonzero(sizes)
        columns = [pa.array(held, pa.int32()), pa.array(sizes[held])]
        columns += [pa.array(sums[held, i]) for i in range(width)]
        yield pa.RecordBatch.from_arrays(columns, names=["cluster", "n", *(f"s{i}" for i in range(width))])

    names = ["n", *(f"s{i}" for i in range(width))]
    partial = integers.mapInArrow(run, "cluster int, " + ", ".join(f"{x} long" for x in names))
    totals = partial.groupBy("cluster").agg(*[F.sum(x).alias(x) for x in names]).collect()
    moved = centroids.copy()
    for row in totals:
        moved[row["cluster"]] = np.array([row[f"s{i}"] for i in range(width)]) // row["n"]
    return moved


def first_centroids(integers: DataFrame, k: int, seed: int) -> np.ndarray:
    """The k vectors whose ids have the smallest hash, in its order."""
    hashed = integers.withColumn("h", F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256))
    rows = hashed.orderBy(F.asc_nulls_last("h"), "v").limit(k).collect()
    return np.array([r["v"] for r in rows], dtype=np.int64)


def cluster(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    k: int = CENTROIDS,
    rounds: int = ROUNDS,
    seed: int = SEED,
    dimensions: int = DIMENSIONS,
) -> tuple[DataFrame, np.ndarray]:
    """``id, cluster, distance`` of every usable vector, written to the shared folder, and the centroids."""
    integers = materialise(quantise(vectors, id_col, vector_col, dimensions), "centroid-vectors")
    centroids = first_centroids(integers, k, seed)
    if not len(centroids):
        kind = integers.schema["id"].dataType.simpleString()
        return vectors.sparkSession.createDataFrame([], f"id {kind}, cluster int, distance long"), centroids
    for _ in range(rounds):
        centroids = _means(integers, centroids)
    return materialise(_assign(integers, centroids), "centroid-assigned"), centroids


def with_inertia(assigned: DataFrame, centroids: np.ndarray) -> DataFrame:
    """``assigned`` plus ``cluster_inertia, inertia, centroid_sha256``."""
    wide = F.col("distance").cast("decimal(19,0)")
    per = {r["cluster"]: int(r["d"]) for r in assigned.groupBy("cluster").agg(F.sum(wide).alias("d")).collect()}
    total = sum(per.values())

    def long(x: int) -> int | None:
        return x if x < 1 << 63 else None

    shas = [hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in centroids]
    rows = [(c, long(d), long(total), shas[c]) for c, d in sorted(per.items())]
    kept = assigned.sparkSession.createDataFrame(
        rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string"
    )
    # One row per centroid: k is a parameter.
    return assigned.join(F.broadcast(kept), "cluster")


ship(__name__)
