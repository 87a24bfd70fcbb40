"""Clusters against plain rounds over all pairs, and the bounds against exact distances."""

import hashlib
import math

import numpy as np
import pytest

from docketeer.llm import centroids


def rounds(vectors, k, n):
    """(cluster, distance) of the vectors, and the centroids, by all distances in whole numbers."""
    first = sorted(vectors, key=lambda r: (hashlib.sha256(f"1:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    held = [list(v) for _, v in first[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), i) for i, c in enumerate(held))

    for _ in range(n):
        groups = {}
        for _, v in vectors:
            groups.setdefault(nearest(v)[1], []).append(v)
        held = [
            [sum(x) // len(groups[i]) for x in zip(*groups[i], strict=True)] if i in groups else c
            for i, c in enumerate(held)
        ]
    return sorted((key if key is not None else -1, *nearest(v)[::-1]) for key, v in vectors), held


@pytest.mark.parametrize("pivots", [1, 2, 8])
@pytest.mark.parametrize("kind", ["noise", "groups", "few"])
def test_clusters(spark, pivots, kind):
    chance = np.random.default_rng(7)
    size, n = 5, {"noise": 300, "groups": 300, "few": 9}[kind]
    data = chance.normal(size=(n, size)) * 0.3
    if kind == "groups":
        data = np.repeat(chance.normal(size=(6, size)) * 9, n // 6, axis=0) + data
    data[n // 2 :] = data[: n - n // 2]
    rows = [(None if i == 3 else i // 2, [float(x) for x in v], "z") for i, v in enumerate(data)]
    bad = [None, [], [1.0] * 4, [1.0, None, 1.0, 1.0, 1.0], [math.nan] * 5, [1.0, 1.0, math.inf, 1.0, 1.0], [1.0] * 6]
    table = spark.createDataFrame(
        rows + [(900 + i, v, "z") for i, v in enumerate(bad)], "vec_id long, embedding array<double>, v string"
    )
    found, final = centroids.cluster(table, size=size, pivots=pivots)
    whole = [(key, [math.floor(64 * x) for x in v]) for key, v, _ in rows]
    want, held = rounds(whole, 16, 3)
    got = sorted((-1 if r.id is None else r.id, r.cluster, r.distance) for r in found.collect())
    assert got == want
    assert final.tolist() == held
    sums = {r.cluster: (r.cluster_inertia, r.inertia) for r in centroids.inertias(found).collect()}
    total = sum(d for _, _, d in got)
    assert sums == {c: (sum(d for _, k, d in got if k == c), total) for c in {k for _, k, _ in got}}


def test_bounds():
    """No nearest centroid is filtered, and most of the others are, where there are groups."""
    chance = np.random.default_rng(8)
    middles = chance.integers(-900, 900, (16, 64))
    vectors = np.repeat(middles, 50, axis=0) + chance.integers(-20, 20, (800, 64))
    held = middles + chance.integers(-5, 5, (16, 64))
    base = centroids.simplex(held[:10], 8)
    distances = centroids.squared(vectors, base.pivots)
    kept = centroids.candidates(distances, held, base)
    exact = centroids.squared(vectors, held)
    assert kept[np.arange(800), exact.argmin(axis=1)].all()
    assert kept.mean() < 0.4
    found, away = centroids.nearest(vectors, distances, held, base)
    assert (found == exact.argmin(axis=1)).all() and (away == exact.min(axis=1)).all()
    place, height = centroids.apexes(distances, base)
    # Two apexes lie no further apart than their vectors.
    lower = np.linalg.norm(place[:400] - place[400:], axis=1) ** 2 + (height[:400] - height[400:]) ** 2
    assert (lower <= ((vectors[:400] - vectors[400:]) ** 2).sum(axis=1) * (1 + 1e-9) + 1e-3).all()


def test_alike_and_none(spark):
    ddl = "vec_id long, embedding array<float>"
    same = spark.createDataFrame([(i, [0.5] * 64) for i in range(40)], ddl)
    found, final = centroids.cluster(same)
    assert {(r.cluster, r.distance) for r in found.collect()} == {(0, 0)} and len(final) == 16
    none, final = centroids.cluster(same.limit(0))
    assert none.count() == 0 and len(final) == 0
    assert none.withColumn("x", centroids.digests(final)).count() == 0
    far = spark.createDataFrame([(1, [3e38] * 64), (2, [-3e38] * 64)], ddl)
    assert {r.distance for r in centroids.cluster(far)[0].collect()} == {0}
