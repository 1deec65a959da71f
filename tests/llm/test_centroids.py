import hashlib
import math

import numpy as np
import pytest

from stayscope.llm import centroids, queries


def brute(rows, k=40, rounds=5, dimensions=64):
    """Every distance, in Python integers."""
    kept = []
    for vec_id, x in rows:
        if x is not None and len(x) == dimensions and all(c is not None and math.isfinite(c) for c in x):
            kept.append((vec_id, [min(max(math.floor(256 * float(c)), -(2**24)), 2**24) for c in x]))
    if not kept:
        return []

    def key(row):
        return row[0] is None, hashlib.sha256(f"2:{row[0]}".encode()).hexdigest() if row[0] is not None else "", row[1]

    centres = [v for _, v in sorted(kept, key=key)[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), i) for i, c in enumerate(centres))

    for _ in range(rounds):
        found = [nearest(v)[1] for _, v in kept]
        for i in set(found):
            own = [v for (_, v), f in zip(kept, found) if f == i]
            centres[i] = [sum(col) // len(own) for col in zip(*own)]
    last = [nearest(v) for _, v in kept]
    total = sum(d for d, _ in last)
    shas = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    return [
        (vec_id, c, d, sum(e for e, f in last if f == c), total, shas[c]) for (vec_id, _), (d, c) in zip(kept, last)
    ]


def run(spark, tmp_path, rows):
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").write.parquet(
        f"{tmp_path}/embeddings.parquet"
    )
    return sorted(map(tuple, queries.op12_centroid_clustering(spark, str(tmp_path)).collect()), key=str)


def vectors(n, seed=0):
    x = np.random.default_rng(seed).normal(size=(n, 64)).astype(np.float32)
    return x.tolist()


def test_awkward_rows(spark, tmp_path):
    x = vectors(150)
    rows = [(i, v) for i, v in enumerate(x)]
    rows += [(200 + i, x[3]) for i in range(60)] + [(5, x[5]), (5, x[9]), (None, x[1]), (None, x[2])]
    rows += [(300, None), (301, []), (302, x[0][:63]), (303, x[0] + [0.0]), (304, [None, *x[0][1:]])]
    rows += [(305, [float("nan"), *x[0][1:]]), (306, [float("-inf"), *x[0][1:]]), (307, [0.0] * 64)]
    assert run(spark, tmp_path, [(*r, 1) for r in rows]) == sorted(brute(rows), key=str)


def test_huge_components(spark, tmp_path):
    rows = [(i, [s * 3e38] + [float(i)] * 63) for i, s in enumerate((1, -1, 1, -1, 1))]
    assert run(spark, tmp_path, [(*r, 1) for r in rows]) == sorted(brute(rows), key=str)


@pytest.mark.parametrize("n", [0, 1, 39])
def test_fewer_vectors_than_centroids(spark, tmp_path, n):
    rows = [(i, v) for i, v in enumerate(vectors(n))]
    assert run(spark, tmp_path, [(*r, None) for r in rows]) == sorted(brute(rows), key=str)


def test_general_interface_with_clashing_columns(spark):
    rows = [(f"v{i}", v[:8], 1, 2.0) for i, v in enumerate(vectors(50, 3))]
    docs = spark.createDataFrame(rows, "id string, v array<double>, cluster int, distance double")
    found, centres = centroids.cluster(docs, "id", "v", k=4, rounds=2, dimensions=8)
    want = brute([(r[0], r[1]) for r in rows], 4, 2, 8)
    assert sorted((r["id"], r["cluster"], r["distance"]) for r in found.collect()) == sorted(w[:3] for w in want)
    assert centres.shape == (4, 8)


@pytest.mark.parametrize("scale", [2, 40, 1 << 24])
def test_search_equals_all_distances(scale):
    draw = np.random.default_rng(scale)
    c = draw.integers(-scale, scale, (40, 64))
    c[7], c[11] = c[3], c[3][::-1]
    x = np.concatenate([draw.integers(-scale, scale, (500, 64)), c, np.full((2, 64), scale)])
    number, distance = centroids.Search(c).nearest(x)
    every = ((x[:, None, :] - c[None]) ** 2).sum(axis=2)
    assert (number == every.argmin(axis=1)).all() and (distance == every.min(axis=1)).all()


def test_far_centroids_are_not_compared():
    c = np.arange(40)[:, None] * np.full(64, 100)
    search, seen = centroids.Search(c), []

    class Counted(np.ndarray):
        def __getitem__(self, at):
            seen.append(np.size(at))
            return np.ndarray.__getitem__(self, at)

    search.centroids = search.centroids.view(Counted)
    search.nearest(np.full((10, 64), 1510))
    assert sum(seen) <= 20
