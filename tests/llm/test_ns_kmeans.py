from __future__ import annotations

import hashlib
import math

import numpy as np
import pytest

from kinscore.llm.ns_kmeans import ns_kmeans, sq_distances

KIND = "vec_id long, embedding array<double>"


def brute(rows, k, rounds, dim, scale=256, seed=2):
    """Lloyd's rounds in Python integers."""
    kept = [
        (i, [math.floor(scale * v) for v in x])
        for i, x in rows
        if x is not None and len(x) == dim and all(v is not None and math.isfinite(v) for v in x)
    ]
    name = lambda i: hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()
    centroids = [x for _, x in sorted((name(i), x) for i, x in kept)[:k]]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(x, c, strict=True)), j) for j, c in enumerate(centroids)) for _, x in kept]

    for _ in range(rounds):
        own = assign()
        for j in range(len(centroids)):
            members = [x for (_, x), (_, c) in zip(kept, own, strict=True) if c == j]
            if members:
                centroids[j] = [sum(col) // len(members) for col in zip(*members, strict=True)]
    own = assign()
    part = [sum(d for d, c in own if c == j) for j in range(len(centroids))]
    return sorted(
        (-1 if i is None else i, c, d, part[c], sum(part), ",".join(map(str, centroids[c]))) for (i, _), (d, c) in zip(kept, own, strict=True)
    )


def ours(df, rows, k, rounds, dim, **more):
    found = ns_kmeans(df, k=k, rounds=rounds, dim=dim, **more).collect()
    return sorted((-1 if r.vec_id is None else r.vec_id, r.cluster, r.distance, r.cluster_inertia, r.inertia, r.centroid) for r in found)


@pytest.mark.parametrize(("k", "dim", "spread", "group"), [(7, 3, 0.02, 3), (12, 5, 1.0, 10), (25, 2, 40.0, 4), (3, 4, 3000.0, 1)])
def test_brute_force(spark, k, dim, spread, group):
    r = np.random.default_rng(k)
    centers = r.normal(size=(6, dim)) * spread * 3
    x = centers[r.integers(6, size=400)] + r.normal(size=(400, dim)) * spread
    x[40:60] = x[40]  # copies, and a coarse grid for ties
    x[100:300] = np.round(x[100:300] / spread) * spread
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, KIND).repartition(3)
    assert ours(df, rows, k, 6, dim, block=64, group=group) == brute(rows, k, 6, dim)


def test_odd_rows(spark):
    good = [(i, [float(i % 4), i / 7]) for i in range(12)]
    odd = [(20, None), (21, [1.0]), (22, [1.0, None]), (23, [1.0, float("nan")]), (24, [float("inf"), 0.0]), (25, []), (None, [0.5, 0.5])]
    rows = good + odd + [(3, [9.0, -9.0]), (3, [3.0, 3 / 7])]
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], KIND + ", cluster int, `meta.k` string")
    assert ours(df, rows, 4, 3, 2) == brute(rows, 4, 3, 2)
    assert ours(df, rows, 99, 2, 2) == brute(rows, 99, 2, 2)  # fewer vectors than centroids
    assert ns_kmeans(df.limit(0), k=4, dim=2).count() == 0
    assert ours(df.where("vec_id = 5"), good[5:6], 4, 2, 2) == brute(good[5:6], 4, 2, 2)
    floats = df.selectExpr("cast(vec_id as string) as v", "cast(embedding as array<float>) as e")
    assert ns_kmeans(floats, "v", "e", k=4, dim=2).schema["v"].dataType.simpleString() == "string"


def test_too_large_components_fail(spark):
    df = spark.createDataFrame([(1, [1e9, 0.0]), (2, [0.0, 0.0])], KIND)
    with pytest.raises(Exception, match="distances would not fit"):
        ns_kmeans(df, k=1, dim=2)


def test_wide_integers_are_exact():
    x = np.array([[1 << 26, -(1 << 26)], [3, 5]], np.int64)
    assert sq_distances(x, -x).tolist() == [[4 * 2 * (1 << 52), (3 + (1 << 26)) ** 2 + ((1 << 26) - 5) ** 2], [(3 + (1 << 26)) ** 2 + ((1 << 26) - 5) ** 2, 4 * 34]]


def test_bounds_skip_most_distances_of_settled_rounds(spark):
    r = np.random.default_rng(0)
    centers = r.normal(size=(30, 8)) * 4
    x = centers[r.integers(30, size=3000)] + r.normal(size=(3000, 8)) * 0.05
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], KIND).repartition(2)
    report: list[int] = []
    ns_kmeans(df, k=30, rounds=8, dim=8, report=report)
    assert report[0] == 3000 * 30
    assert report[-1] < 0.35 * 3000 * 30 and sum(report[1:]) < 0.6 * 8 * 3000 * 30
