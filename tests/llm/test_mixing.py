"""Targets against a loop, and what the rounding promises."""

import random
import re
from collections import defaultdict

import numpy as np
import pytest

from docketeer.llm import mixing
from docketeer.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def wanted(sizes):
    """Targets of {source: words}: share, cap, share what is over among the rest, and so on."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: mixing.WEIGHTS[i % 3] for i, s in enumerate(names)}
    target, free, rest = {}, set(names), float(sum(sizes.values()))
    while free:
        share = {s: rest * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s for s in free if share[s] > 3 * sizes[s]}
        if not over:
            return {**target, **share}
        for s in over:
            target[s] = 3.0 * sizes[s]
            rest -= target[s]
        free -= over
    return target


def check(rows, texts):
    """Rows of the query against (doc_id, source, text) rows."""
    assert len(rows) == len(texts)
    sizes, largest = defaultdict(int), defaultdict(int)
    for _, source, text in texts:
        n = len(WORD.findall(text or ""))
        sizes[source] += n
        largest[source] = max(n, largest[source])
    target, taken = wanted(sizes), defaultdict(int)
    for r in rows:
        assert r.source_size == sizes[r.source]
        assert r.target == pytest.approx(target[r.source], rel=1e-9, abs=1e-6)
        assert r.taken % max(r.size, 1) == 0 and 0 <= r.taken <= 3 * r.size
        taken[r.source] += r.taken
    for s in sizes:
        assert abs(taken[s] - target[s]) <= largest[s] + 1e-6, s
    assert sum(target.values()) == pytest.approx(sum(sizes.values()))


def test_query(spark):
    folder = "/root/testdata/sf0.01"
    documents = spark.read.parquet(f"{folder}/documents.parquet")
    texts = [(r.doc_id, r.source, r.text) for r in documents.collect()]
    rows = QUERIES["op1_mixing"](spark, folder).collect()
    check(rows, texts)
    assert sorted(rows) == sorted(QUERIES["op1_mixing"](spark, folder).collect())


def _table(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, source string, text string, size long, copies string")


@pytest.mark.parametrize(("group", "fan"), [(4096, 1024), (8, 2)])
def test_edges_and_levels(spark, monkeypatch, group, fan):
    monkeypatch.setattr(mixing, "GROUP", group)
    monkeypatch.setattr(mixing, "FAN", fan)
    draw = random.Random(1)
    names = ["b", "a", None, "é", "", "z"]
    texts = [(i, draw.choice(names[: 1 + i % 6]), "w " * draw.randrange(40)) for i in range(400)]
    texts += [(500, "empty", ""), (501, "empty", None), (502, "tiny", "one"), (None, "a", "x y"), (None, "a", "x y")]
    texts += [(3, *texts[3][1:]), (3, *texts[3][1:]), (600, "b", "long " * 20_000)]
    frame = _table(spark, [(*t, 1, "c") for t in texts])
    rows = mixing.plan_mix(frame).collect()
    check(rows, texts)
    again = mixing.plan_mix(frame.repartition(7)).collect()
    key = lambda r: [(x is None, x) for x in r]
    assert sorted(rows, key=key) == sorted(again, key=key)
    made = mixing.mix(frame).collect()
    assert len(made) == sum(r.copies for r in rows if r.copies)
    words = sum(len((r.text or "").split()) for r in made)
    assert words == sum(r.taken for r in rows) and {r.copies for r in made} == {"c"}
    assert mixing.plan_mix(frame.limit(0)).count() == 0 and mixing.mix(frame.limit(0)).count() == 0


def test_expectation_is_kept():
    size = np.array([5.0, 1, 9, 4, 2, 7])
    start = size * np.array([0.3, 0.5, 0.9, 0.1, 0.5, 0.25])
    total = np.zeros(6)
    for seed in range(4000):
        mass = start.copy()
        whole, left = mixing._settle(mass, size, np.random.default_rng(seed))
        assert mass.sum() == pytest.approx(start.sum())
        assert all(m in (0, s) for i, (m, s) in enumerate(zip(mass, size, strict=True)) if i != left)
        total += mass
    assert np.allclose(total / 4000, start, atol=0.03 * size)
