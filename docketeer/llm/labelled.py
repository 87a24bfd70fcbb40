"""A bounded sample of labelled texts, and small helpers for fitting on it."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The most labelled rows a model is fitted on.
TRAIN_ROWS = 4000

# For a slice of texts (rows, bytes, offsets), a row of features each.
Features = Callable[[pa.RecordBatch, np.ndarray, np.ndarray], np.ndarray]


def labelled_sample(
    documents: DataFrame,
    labels: DataFrame,
    label: str,
    features: Features,
    columns: list[str],
    rows: int = TRAIN_ROWS,
    where: Column | None = None,
) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of at most ``rows`` documents, those with the smallest hash of doc_id.

    The bound is on rows of features, which are sent as the positions and values that are not
    zero; the texts stay with the executors. A document with several labels has the highest, one
    with several rows counts once. Null labels and ids are left out.
    """
    from docketeer.llm.arrays import pieces

    known = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull())
    known = known.where(where) if where is not None else known
    known = known.groupBy("doc_id").agg(F.max(label).cast("int").alias("_label"))
    known = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    texts = documents.select("doc_id", *columns).join(F.broadcast(known), "doc_id")
    texts = texts.dropDuplicates(["doc_id"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offsets in pieces(batch):
                dense = features(part, data, offsets).astype(np.float32)
                at = [np.flatnonzero(r).astype(np.int32) for r in dense]
                out = [
                    part.column(part.schema.get_field_index("doc_id")),
                    part.column(part.schema.get_field_index("_label")),
                    pa.array([a.tobytes() for a in at], pa.binary()),
                    pa.array([r[a].tobytes() for r, a in zip(dense, at, strict=True)], pa.binary()),
                    pa.array([dense.shape[1]] * len(at), pa.int32()),
                ]
                yield pa.RecordBatch.from_arrays(out, ["doc_id", "label", "at", "value", "width"])

    kind = texts.schema["doc_id"].dataType.simpleString()
    found = texts.mapInArrow(run, f"doc_id {kind}, label int, at binary, value binary, width int")
    held = sorted(found.collect(), key=lambda r: r.doc_id)
    if not held:
        return np.zeros((0, 0), np.float32), np.zeros(0, np.int64)
    dense = np.zeros((len(held), held[0].width), np.float32)
    for row, r in zip(dense, held, strict=True):
        row[np.frombuffer(r.at, np.int32)] = np.frombuffer(r.value, np.float32)
    return dense, np.array([r.label for r in held], np.int64)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def adam(
    params: list[np.ndarray],
    gradients: Callable[[np.ndarray], list[np.ndarray]],
    rows: int,
    passes: int = 20,
    batch: int = 256,
    rate: float = 0.02,
) -> None:
    """Minimize in place by Adam (Kingma, Ba 2015) over reproducible mini-batches."""
    draw = np.random.default_rng(1)
    first = [np.zeros_like(p) for p in params]
    second = [np.zeros_like(p) for p in params]
    t = 0
    for _ in range(passes):
        order = draw.permutation(rows)
        for k in range(0, rows, batch):
            t += 1
            for p, m, v, g in zip(params, first, second, gradients(order[k : k + batch]), strict=True):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)


def calibration(scores: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """(a, b) so that sigmoid(a * score + b) is a probability, by Platt's method with his targets."""
    n1, n0 = int(labels.sum()), int((1 - labels).sum())
    target = np.where(labels == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    x = np.stack([scores, np.ones_like(scores)], axis=1)
    beta = np.array([1.0, 0.0])
    for _ in range(50):
        p = sigmoid(x @ beta)
        hessian = (x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        step = np.linalg.solve(hessian, x.T @ (target - p) - 1e-3 * (beta - [1, 0]))
        beta = beta + np.clip(step, -5, 5)
    return max(float(beta[0]), 1e-3), float(beta[1])
