"""The machine's scores against the plain sum over pairs, on held-out labels, and at the edges."""

import zlib

import numpy as np
import pyarrow as pa
import pytest

from docketeer.llm import arrays as A
from docketeer.llm import factors
from docketeer.llm import labelled as L
from docketeer.llm.profile import profile
from docketeer.llm.queries import QUERIES


def test_held_out_labels(spark):
    folder = "/root/testdata/sf0.1"
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    rows = QUERIES["op7_factors"](spark, folder).collect()
    assert len(rows) == spark.read.parquet(f"{folder}/documents.parquet").count()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5)
    held = [(r.score, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    good = np.array([s for s, q in held if q == 1])
    poor = np.array([s for s, q in held if q == 0])
    area = (good[:, None] > poor).mean() + (good[:, None] == poor).mean() / 2
    print("area", area, "accuracy", np.mean([(s >= 0.5) == q for s, q in held]))
    assert area >= 0.97
    assert np.mean([(s >= 0.5) == q for s, q in held]) >= 0.95


def test_pairs_one_by_one():
    draw = np.random.default_rng(0)
    width = factors.WORD_CELLS + factors.DENSE
    machine = factors.Machine(
        0.3, draw.normal(0, 0.2, width), draw.normal(0, 0.2, (width, factors.RANK)),
        np.zeros(factors.DENSE), np.full(factors.DENSE, 5.0), 1.0, 0.0,
    )
    texts = ["a b c a", "", None, "One two two THREE 4!"]
    rows = pa.RecordBatch.from_pydict({"text": pa.array(texts), "n_chars": pa.array([7, None, 0, 20])})
    data, offsets = A.flat(rows.column(0))
    got = factors.scores(machine, rows, profile(data, offsets))
    x = factors._features(rows, data, offsets).astype(float)
    x[:, factors.WORD_CELLS :] = np.clip(x[:, factors.WORD_CELLS :] / 5, -3, 3)
    for i in range(len(texts)):
        raw = 0.3 + x[i] @ machine.linear
        at = np.flatnonzero(x[i])
        for j, p in enumerate(at):
            for q in at[j + 1 :]:
                raw += x[i, p] * x[i, q] * (machine.factors[p] @ machine.factors[q])
        assert got[i] == pytest.approx(L.sigmoid(raw), abs=1e-5)


def test_edges(spark):
    texts = [None, "", "é", "a a a", "x" * 200_000, "A good text of some words."]
    frame = spark.createDataFrame(
        [(i, t, None if i == 3 else 5, "r", 1.0) for i, t in enumerate(texts)] + [(3, "a a a", 5, "r", 1.0)],
        "doc_id long, text string, n_chars long, row string, score double",
    )
    labels = spark.createDataFrame([(0, 1), (3, 0), (4, 0), (5, 1), (9, 1), (None, 0)], "doc_id long, quality long")
    for known in (labels, labels.limit(0)):
        machine = factors.fit(frame, known)
        rows = factors.score(frame, machine).collect()
        assert len(rows) == len(texts) + 1 and all(0 <= r.score <= 1 for r in rows)
        assert factors.score(frame.limit(0), machine).count() == 0
