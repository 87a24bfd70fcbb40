"""Quality rules: fixed base rules and a calibrated n-gram logistic regression."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketeer.llm import arrays as A
from docketeer.llm import labelled as L
from docketeer.llm.profile import Profile, profile

# Cells for hashed words, and for hashed runs of CHARS bytes.
WORD_CELLS = CHAR_CELLS = 2048
CHARS = 3
# A text is kept from this probability of good quality on.
KEEP_FROM = 0.5
# Parts of the sample; each is scored by a model of the others for the calibration.
FOLDS = 5
LEAST_WORDS, MOST_REPEATED = 50, 50


@dataclass
class Model:
    """Weight of each cell, and the calibration."""

    words: np.ndarray
    chars: np.ndarray
    bias: float
    slope: float
    shift: float


def _word_cells(found: Profile) -> np.ndarray:
    return (found.hashes % np.uint64(WORD_CELLS)).astype(np.int64)


def _char_cells(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The cell of every run of CHARS bytes, the first cell of each text; runs stay in a text."""
    if len(data) < CHARS:
        return np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    h = np.zeros(len(data) - CHARS + 1, np.uint32)
    for j in range(CHARS):
        h = h * np.uint32(0x01000193) ^ data[j : j + len(h)]
    h = (h * np.uint32(0x9E3779B1)) >> np.uint32(32 - CHAR_CELLS.bit_length() + 1)
    whole = np.ones(len(h), bool)
    for j in range(1, CHARS):
        last = offsets[1:] - j
        whole[last[(last >= 0) & (last < len(h))]] = False
    before = np.concatenate([[0], np.cumsum(whole)])
    return h[whole], before[np.minimum(offsets, len(h))]


def _features(rows: pa.RecordBatch, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Shares of the word cells, then of the character cells."""
    found = profile(data, offsets)
    out = np.zeros((len(offsets) - 1, WORD_CELLS + CHAR_CELLS), np.float32)
    runs, firsts = _char_cells(data, offsets)
    for cells, bounds, at in ((_word_cells(found), found.bounds, 0), (runs, firsts, WORD_CELLS)):
        for i, (lo, hi) in enumerate(zip(bounds[:-1], bounds[1:], strict=True)):
            if hi > lo:
                out[i, at : at + WORD_CELLS] = np.bincount(cells[lo:hi], minlength=WORD_CELLS) / (hi - lo)
    return out


def _learn(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Weights and bias, both kinds of labels weighing the same."""
    known = y.astype(np.float32)
    weight = np.where(known == 1, 0.5 / known.mean(), 0.5 / (1 - known.mean())).astype(np.float32)
    w, b = np.zeros(x.shape[1], np.float32), np.zeros(1, np.float32)

    def gradients(rows: np.ndarray) -> list[np.ndarray]:
        error = weight[rows] * (L.sigmoid(x[rows] @ w + b) - known[rows])
        return [x[rows].T @ error / len(rows) + 1e-3 * w, error.mean(keepdims=True)]

    L.adam([w, b], gradients, len(known), rate=0.005)
    return w, b


def fit(
    documents: DataFrame, labels: DataFrame, text: str = "text", rows: int = L.TRAIN_ROWS
) -> Model | None:
    """Fit on at most ``rows`` labelled documents, calibrated on all of them out of fold.

    None where there are no labels of both kinds: nothing can be learned then. With a single row
    of a kind no fold can do without it, and the calibration uses the model of all rows.
    """
    if text != "text":
        documents = documents.select("doc_id", documents[text].alias("text"))
    x, y = L.labelled_sample(documents, labels, "quality", _features, ["text"], rows)
    if len(set(y.tolist())) < 2:
        return None
    scale = x.std(axis=0) + 1e-4
    x /= scale
    if min(np.bincount(y, minlength=2)[:2]) > 1:
        fold = np.empty(len(y), np.int64)
        for kind in (0, 1):
            fold[y == kind] = np.arange((y == kind).sum()) % FOLDS
        folds = np.unique(fold).tolist()
        learned = [_learn(x[fold != k], y[fold != k]) for k in folds]
        scores = np.empty(len(y), np.float32)
        for k, (w, b) in zip(folds, learned, strict=True):
            scores[fold == k] = x[fold == k] @ w + b
        # The mean of the folds' models scores on the scale that is calibrated.
        w, b = (np.mean(each, axis=0) for each in zip(*learned, strict=True))
    else:
        w, b = _learn(x, y)
        scores = x @ w + b
    slope, shift = L.calibration(scores, y)
    w = w / scale
    return Model(w[:WORD_CELLS], w[WORD_CELLS:], float(b[0]), slope, shift)


def probabilities(model: Model | None, found: Profile, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Calibrated probability of good quality; 1 without a model."""
    if model is None:
        return np.ones(len(offsets) - 1)
    runs, firsts = _char_cells(data, offsets)
    words = A.sums(model.words[_word_cells(found)], found.bounds) / np.maximum(found.n_words, 1)
    chars = A.sums(model.chars[runs], firsts) / np.maximum(np.diff(firsts), 1)
    return L.sigmoid(model.slope * (words + chars + model.bias) + model.shift)


def base_failed(found: Profile) -> np.ndarray:
    repeated = 100 * found.n_repeat_words > MOST_REPEATED * found.n_words
    return (found.n_words < LEAST_WORDS) | repeated


COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def assess(df: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """(row, counts, base_failed, probability, kept): the input row as a struct and its verdict.

    One pass without a shuffle. Null and empty texts have no words and fail the base rules; a
    text of any length is scored whole; repeated rows are each kept; an empty table gives an
    empty one; columns of any name may be there.
    """
    rows = df.select(
        F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias("row"), F.col(f"`{text}`").alias("text")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offsets in A.pieces(batch):
                found = profile(data, offsets)
                failed = base_failed(found)
                p = probabilities(model, found, data, offsets)
                out = [part.column(0), *(pa.array(getattr(found, c)) for c in COUNTS)]
                out += [pa.array(failed), pa.array(p), pa.array(~failed & (p >= KEEP_FROM))]
                yield pa.RecordBatch.from_arrays(out, [*NAMES])

    counted = ", ".join(f"{c} long" for c in COUNTS)
    ddl = f"{counted}, base_failed boolean, probability double, kept boolean"
    return rows.mapInArrow(run, A.with_row(rows, ddl))


NAMES = ["row", *COUNTS, "base_failed", "probability", "kept"]
