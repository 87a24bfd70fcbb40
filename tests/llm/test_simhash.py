"""Fingerprints, links and components against brute force."""

import random
import re

import numpy as np
import pytest
import xxhash

from docketeer.llm import components as C
from docketeer.llm import simhash
from docketeer.llm.queries import QUERIES


def fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [words[i : i + 3] for i in range(len(words) - 2)] or [words]
    hashes = [xxhash.xxh64(" ".join(s).encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots(nodes, links):
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    return {n: find(n) for n in nodes}


def brute(texts):
    """{doc: (fingerprint, component)} of (doc, text) rows."""
    prints = {d: fingerprint(t) for d, t in texts}
    distinct = sorted(set(prints.values()))
    links = [(a, b) for i, a in enumerate(distinct) for b in distinct[i:] if (a ^ b).bit_count() <= 2]
    classes = roots(distinct, links)
    least = {}
    for d, f in prints.items():
        least[classes[f]] = min(d, least.get(classes[f], d))
    return {d: (f"{f:016x}", least[classes[f]]) for d, f in prints.items()}


def test_query_against_brute_force(spark):
    folder = "/root/testdata/sf0.001"
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    rows = QUERIES["op9_simhash"](spark, folder).collect()
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in rows} == brute(texts)
    assert len(rows) == len(texts)


def test_edges(spark):
    long = " ".join(f"w{i % 700}é" for i in range(5000))
    texts = [(1, None), (2, ""), (3, " \n\t"), (4, "Ab"), (5, "aB c"), (6, "a b"), (7, "A  b"), (8, long), (9, long + " w"), (8, long)]
    frame = spark.createDataFrame(
        [(d, t, 0, "k") for d, t in texts] + [(None, "a b", 0, "k")],
        "doc_id long, text string, f long, key string",
    )
    rows = simhash.near_duplicates(frame).collect()
    assert len(rows) == len(texts) + 1
    want = brute(texts)
    for r in rows:
        if r.key is not None:
            assert (f"{r.fingerprint % 2**64:016x}", r.component) == want[r.key]
        else:
            assert r.component == 6
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.near_duplicates(empty).count() == 0


@pytest.mark.parametrize("most", [0, 4, 32])
def test_links_are_the_same_by_pairs_and_by_lists(spark, monkeypatch, most):
    """Whatever the size from which lists take over, the components are those of all pairs."""
    monkeypatch.setattr(simhash, "PAIRS_UP_TO", most)
    draw = random.Random(3)
    prints = {0, 2**64 - 1}
    for _ in range(12):
        f = draw.getrandbits(64)
        prints.add(f)
        for _ in range(12):
            f ^= 1 << draw.randrange(64)
            f ^= 1 << draw.randrange(30)
            prints.add(f)
    signed = [int(np.uint64(f).view(np.int64)) for f in prints]
    frame = spark.createDataFrame([(f,) for f in signed], "f long")
    links = simhash.close_pairs(frame)
    pairs = [(r.a, r.b) for r in links.collect()]
    assert all(((a ^ b) % 2**64).bit_count() <= 2 for a, b in pairs)
    every = [(a, b) for a in signed for b in signed if a < b and ((a ^ b) % 2**64).bit_count() <= 2]
    assert roots(signed, pairs) == roots(signed, every)


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(7, 7), (None, 3)]
    got = {r.node: r.root for r in C.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 140)}}
    assert C.components(spark.createDataFrame([], "a long, b long")).count() == 0
