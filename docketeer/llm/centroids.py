"""Clustering integer vectors around centroids, with bounds from n-simplex projection.

The distances of a vector to a few pivots are measured once and kept with it. Together with the
distances among the pivots they fix the apex of a simplex over the pivots (Connor, Vadicamo,
Cardillo, Rabitti, 2016): the vector's place in the pivots' plane, and its height above that
plane. Two vectors are at least as far apart as their apexes, and at most as far as with one of
the heights turned over. A centroid whose lower bound exceeds the upper bound of another one is
not looked at; the others are compared in whole numbers.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docketeer.session import settled

# Components are multiplied by SCALE; a seed is the text before an id whose hash is taken.
COMPONENTS, SCALE, CENTROIDS, ROUNDS, SEED = 64, 64, 16, 3, "1"
PIVOTS = 8
# Larger components would not leave a squared distance within 64 bits.
LARGEST = 1 << 26
# Rows compared at once, and the share of a squared distance that rounding may cost a bound.
ROWS, SLACK = 2048, 1e-6


class Simplex(NamedTuple):
    """Pivots, the triangular places of all but the first, and the inverse of these."""

    pivots: np.ndarray
    corners: np.ndarray
    inverse: np.ndarray


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact squared distances of every row of ``a`` to every row of ``b``."""
    out = np.empty((len(a), len(b)), np.int64)
    for j, other in enumerate(b):
        difference = a - other
        out[:, j] = np.einsum("ij,ij->i", difference, difference)
    return out


def simplex(candidates: np.ndarray, most: int = PIVOTS) -> Simplex:
    """The simplex of the first ``most`` candidates that do not lie in the plane of those before."""
    chosen, corners = [0], np.zeros((0, 0))
    between = squared(candidates, candidates).astype(float)
    for i in range(1, len(candidates)):
        if len(chosen) == most:
            break
        first = between[0, i]
        with_others = (between[0, chosen[1:]] + first - between[i, chosen[1:]]) / 2
        place = np.linalg.solve(corners, with_others) if len(corners) else with_others
        height = first - place @ place
        if height <= 1e-3 * first:
            continue
        size = len(corners)
        grown = np.zeros((size + 1, size + 1))
        grown[:size, :size] = corners
        grown[size, :size], grown[size, size] = place, np.sqrt(height)
        corners = grown
        chosen.append(i)
    return Simplex(candidates[chosen], corners, np.linalg.inv(corners) if len(corners) else corners)


def apexes(distances: np.ndarray, base: Simplex) -> tuple[np.ndarray, np.ndarray]:
    """Place in the pivots' plane and height above it, from squared distances to the pivots."""
    own = np.einsum("ij,ij->i", base.corners, base.corners)
    away = distances.astype(float)
    place = ((away[:, :1] - away[:, 1:] + own) / 2) @ base.inverse.T
    return place, np.sqrt(np.maximum(away[:, 0] - np.einsum("ij,ij->i", place, place), 0))


def candidates(distances: np.ndarray, centroids: np.ndarray, base: Simplex) -> np.ndarray:
    """Which centroids may be the nearest of a row, from the bounds alone."""
    to_pivots = squared(centroids, base.pivots)
    place, height = apexes(distances, base)
    place_c, height_c = apexes(to_pivots, base)
    flat = np.zeros((len(distances), len(centroids)))
    for j, other in enumerate(place_c):
        difference = place - other
        flat[:, j] = np.einsum("ij,ij->i", difference, difference)
    lower = flat + (height[:, None] - height_c) ** 2
    upper = flat + (height[:, None] + height_c) ** 2
    room = SLACK * (distances[:, :1] + to_pivots[:, 0]) + 1
    return lower - room <= (upper + room).min(axis=1, keepdims=True)


def nearest(
    vectors: np.ndarray, distances: np.ndarray, centroids: np.ndarray, base: Simplex
) -> tuple[np.ndarray, np.ndarray]:
    """Number of the nearest centroid, the smaller one of ties, and the exact squared distance."""
    rows, columns = np.nonzero(candidates(distances, centroids, base))
    exact = np.full((len(vectors), len(centroids)), np.iinfo(np.int64).max)
    difference = vectors[rows] - centroids[columns]
    exact[rows, columns] = np.einsum("ij,ij->i", difference, difference)
    cluster = exact.argmin(axis=1)
    return cluster, exact[np.arange(len(vectors)), cluster]


def whole_vectors(df: DataFrame, key: str, vector: str, size: int, scale: int) -> DataFrame:
    """(id, v): the vectors of ``size`` finite components as whole numbers."""
    said = F.col(f"`{vector}`")
    limit = float(LARGEST)
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    whole = lambda x: F.floor(F.greatest(F.least(x * scale, F.lit(limit)), F.lit(-limit)))
    rows = df.select(F.col(f"`{key}`").alias("id"), said.cast("array<double>").alias("v"))
    kept = rows.where((F.size("v") == size) & ~F.exists("v", bad))
    return kept.select("id", F.transform("v", whole).alias("v"))


def first_centroids(vectors: DataFrame, k: int, seed: str) -> np.ndarray:
    """The ``k`` vectors with the smallest hashes of seed and id, a bounded list."""
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit("")))
    rows = vectors.select(F.sha2(named, 256).alias("h"), "v").orderBy("h", "v").limit(k).collect()
    return np.array([r["v"] for r in rows], np.int64)


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy().reshape(len(column), -1)


def _measured(vectors: DataFrame, base: Simplex) -> DataFrame:
    """Add ``d``, the squared distances to the pivots."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = squared(_matrix(batch.column(1)), base.pivots)
            lists = pa.array(list(found), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([*batch.columns, lists], ["id", "v", "d"])

    kind = vectors.schema["id"].dataType.simpleString()
    return vectors.mapInArrow(run, f"id {kind}, v array<bigint>, d array<bigint>")


def _parts(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    for at in range(0, batch.num_rows, ROWS):
        part = batch.slice(at, ROWS)
        yield part, _matrix(part.column(1)), _matrix(part.column(2))


def _sums(rows: DataFrame, centroids: np.ndarray, base: Simplex) -> DataFrame:
    """(cluster, n, s): members and componentwise sums, one row of a cluster for each task."""
    k, size = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, s = np.zeros(k, np.int64), np.zeros((k, size), np.int64)
        for batch in batches:
            for _, vectors, distances in _parts(batch):
                cluster, _ = nearest(vectors, distances, centroids, base)
                np.add.at(s, cluster, vectors)
                n += np.bincount(cluster, minlength=k)
        seen = np.flatnonzero(n)
        lists = pa.array(list(s[seen]), pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int32()), pa.array(n[seen]), lists], ["cluster", "n", "s"])

    return rows.mapInArrow(run, "cluster int, n long, s array<bigint>")


def _moved(rows: DataFrame, centroids: np.ndarray, base: Simplex) -> np.ndarray:
    """The floor of the mean of every cluster; empty ones stay. One row a cluster is collected."""
    size = centroids.shape[1]
    total = [F.sum(F.col("s")[i].cast("decimal(38,0)")).alias(f"s{i}") for i in range(size)]
    out = centroids.copy()
    for r in _sums(rows, centroids, base).groupBy("cluster").agg(F.sum("n").alias("n"), *total).collect():
        out[r["cluster"]] = [int(r[f"s{i}"]) // r["n"] for i in range(size)]
    return out


def cluster(
    df: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    size: int = COMPONENTS,
    scale: int = SCALE,
    k: int = CENTROIDS,
    rounds: int = ROUNDS,
    seed: str = SEED,
    pivots: int = PIVOTS,
) -> tuple[DataFrame, np.ndarray]:
    """(id, cluster, distance) of every vector, and the final centroids, in their order.

    Vectors with another number of components, or with a null or non-finite one, are left out, null
    vectors too. Components count as ``floor(scale * x)``, those beyond LARGEST as LARGEST, so that
    squared distances fit a long. A null key is a key like any other, hashed as the empty text;
    rows that repeat are each kept and each may be a centroid, by their components where the
    hashes are equal. With fewer vectors than ``k`` there are as many centroids; an empty table
    gives no rows and no centroids. Other columns are not looked at. The whole vectors are written
    with their distances to the pivots; each round reads them once and sends a row for each task
    and cluster. Only centroids pass the driver.
    """
    vectors = whole_vectors(df, key, vector, size, scale)
    centroids = first_centroids(vectors, k, seed)
    kind = vectors.schema["id"].dataType.simpleString()
    ddl = f"id {kind}, cluster int, distance long"
    if not len(centroids):
        return df.sparkSession.createDataFrame([], ddl), centroids.reshape(0, size)
    base = simplex(centroids, pivots)
    rows = settled(_measured(vectors, base), "vectors")
    for _ in range(rounds):
        centroids = _moved(rows, centroids, base)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, held, distances in _parts(batch):
                found, away = nearest(held, distances, centroids, base)
                columns = [part.column(0), pa.array(found, pa.int32()), pa.array(away, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["id", "cluster", "distance"])

    return settled(rows.mapInArrow(run, ddl), "clusters"), centroids


def inertias(found: DataFrame) -> DataFrame:
    """(cluster, cluster_inertia, inertia): distances summed by cluster and over all of them."""
    own = found.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia"))
    total = found.agg(F.sum("distance")).scalar()
    return own.withColumn("inertia", total)


def digests(centroids: np.ndarray) -> Column:
    """The hash of each centroid's components, as a column over ``cluster``."""
    texts = [",".join(map(str, c)) for c in centroids.tolist()] or [""]
    return F.sha2(F.element_at(F.array(*map(F.lit, texts)), F.col("cluster") + 1), 256)
