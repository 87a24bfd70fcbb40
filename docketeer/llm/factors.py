"""A factorization machine that scores the quality of texts."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docketeer.llm import arrays as A
from docketeer.llm import labelled as L
from docketeer.llm.profile import Profile, profile

WORD_CELLS = 4096
RANK = 8


@dataclass
class Machine:
    """Linear weights and factors of the cells; the dense features are centred and scaled."""

    bias: float
    linear: np.ndarray
    factors: np.ndarray
    centre: np.ndarray
    scale: np.ndarray
    slope: float
    shift: float


def _dense(rows: pa.RecordBatch, found: Profile) -> np.ndarray:
    """Statistics of the structure, and the table's own length column, of each text."""
    n, size = np.maximum(found.n_words, 1), np.maximum(found.n_bytes, 1)
    declared = rows.column(rows.schema.get_field_index("n_chars"))
    unknown = np.array(declared.is_null())
    chars = np.nan_to_num(declared.cast(pa.float64()).fill_null(0).to_numpy(zero_copy_only=False))
    return np.stack(
        [
            np.log1p(found.n_words),
            np.log1p(found.n_bytes),
            found.word_chars / n,
            found.n_symbols / size,
            found.n_upper / size,
            found.n_digits / size,
            found.n_marks / n,
            found.n_lines / n,
            found.n_dup_lines / np.maximum(found.n_lines, 1),
            found.n_repeat_words / n,
            found.n_long / n,
            np.log1p(np.maximum(chars, 0)),
            unknown,
            found.n_words == 0,
        ],
        axis=1,
    )


DENSE = 14


def _cells(found: Profile) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, cell and value of every word cell that a text has; a text's squares add up to one."""
    n = len(found.n_words)
    doc = np.repeat(np.arange(n), found.n_words)
    both = doc * WORD_CELLS + (found.hashes >> np.uint64(32)).astype(np.int64) % WORD_CELLS
    keys, times = np.unique(both, return_counts=True)
    doc = keys // WORD_CELLS
    return doc, keys % WORD_CELLS, np.sqrt(times / found.n_words[doc])


def _features(rows: pa.RecordBatch, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    found = profile(data, offsets)
    out = np.zeros((len(offsets) - 1, WORD_CELLS + DENSE), np.float32)
    doc, cell, value = _cells(found)
    out[doc, cell] = value
    out[:, WORD_CELLS:] = _dense(rows, found)
    return out


def fit(
    documents: DataFrame,
    labels: DataFrame,
    rows: int = L.TRAIN_ROWS,
    where: Column | None = None,
) -> Machine | None:
    """Fit on at most ``rows`` documents (doc_id, text, n_chars) whose labels meet ``where``.

    Null without labels of both kinds. The label, and all columns but text and n_chars, are
    never among the features.
    """
    x, y = L.labelled_sample(
        documents, labels, "quality", _features, ["text", "n_chars"], rows, where
    )
    if len(set(y.tolist())) < 2:
        return None
    dense = x[:, WORD_CELLS:]
    centre, scale = dense.mean(axis=0), dense.std(axis=0) * 4 + 1e-3
    x[:, WORD_CELLS:] = np.clip((dense - centre) / scale, -3, 3)
    target = y.astype(np.float32)
    weight = np.where(y == 1, 0.5 / target.mean(), 0.5 / (1 - target.mean())).astype(np.float32)
    draw = np.random.default_rng(7)
    w, b = np.zeros(x.shape[1], np.float32), np.zeros(1, np.float32)
    v = draw.normal(0, 0.05, (x.shape[1], RANK)).astype(np.float32)

    def gradients(rows: np.ndarray) -> list[np.ndarray]:
        part = x[rows]
        mass, squares = part @ v, part * part
        raw = b + part @ w + ((mass * mass).sum(1) - (squares @ (v * v)).sum(1)) / 2
        error = weight[rows] * (L.sigmoid(raw) - target[rows]) / len(rows)
        dv = part.T @ (error[:, None] * mass) - (squares.T @ error)[:, None] * v
        return [part.T @ error + 1e-3 * w, dv + 1e-3 * v, error.sum(keepdims=True)]

    L.adam([w, v, b], gradients, len(y), rate=0.01)
    raw = b + x @ w + ((x @ v) ** 2).sum(1) / 2 - ((x * x) @ (v * v)).sum(1) / 2
    slope, shift = L.calibration(raw, y)
    return Machine(float(b[0]), w, v, centre, scale, slope, shift)


def scores(machine: Machine | None, rows: pa.RecordBatch, found: Profile) -> np.ndarray:
    """Probability of good quality of each text; a half without a model.

    The pairwise part is half of (sum of x * v)^2 less the sum of (x * v)^2, for each factor, so
    it costs one visit to each cell that a text has.
    """
    n = len(found.n_words)
    if machine is None:
        return np.full(n, 0.5)
    doc, cell, value = _cells(found)
    terms = machine.factors[cell] * value[:, None]
    flat = np.concatenate(
        [terms, (terms * terms).sum(1, keepdims=True), (machine.linear[cell] * value)[:, None]], axis=1
    )
    total = A.sums(flat, np.searchsorted(doc, np.arange(n + 1)))
    dense = np.clip((_dense(rows, found) - machine.centre) / machine.scale, -3, 3)
    mass = total[:, :RANK] + dense @ machine.factors[WORD_CELLS:]
    squares = total[:, RANK] + (dense * dense) @ (machine.factors[WORD_CELLS:] ** 2).sum(1)
    linear = total[:, RANK + 1] + dense @ machine.linear[WORD_CELLS:]
    raw = machine.bias + linear + ((mass * mass).sum(1) - squares) / 2
    return L.sigmoid(machine.slope * raw + machine.shift)


def score(
    df: DataFrame, machine: Machine | None, text: str = "text", n_chars: str = "n_chars"
) -> DataFrame:
    """(row, score): the input row as a struct and its probability of good quality.

    One pass without a shuffle over whole texts. A null text counts as an empty one, which has a
    score like any other; a null length is a feature of its own; repeated rows are each kept; an
    empty table gives an empty one; columns of any name may be there.
    """
    whole = F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias("row")
    rows = df.select(whole, F.col(f"`{text}`").alias("text"), F.col(f"`{n_chars}`").alias("n_chars"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offsets in A.pieces(batch):
                found = pa.array(scores(machine, part, profile(data, offsets)))
                yield pa.RecordBatch.from_arrays([part.column(0), found], ["row", "score"])

    return rows.mapInArrow(run, A.with_row(rows, "score double"))
