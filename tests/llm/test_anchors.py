"""Words left without repeated windows against a dictionary of all windows."""

import hashlib
import random
import re
from collections import Counter

import pytest

from docketeer.llm import anchors
from docketeer.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, size=20):
    """[(id, n_words, n_removed, sha256)] of (id, text) rows."""
    rows = [(d, WORD.findall(t or "")) for d, t in rows]
    number = lambda d: (d is None, d or 0)
    first = {}
    for d, words in rows:
        for i in range(len(words) - size + 1):
            key, place = tuple(words[i : i + size]), (number(d), i)
            first[key] = min(place, first.get(key, place))
    out = []
    for d, words in rows:
        gone = set()
        for i in range(len(words) - size + 1):
            if first[tuple(words[i : i + size])] < (number(d), i):
                gone.update(range(i, i + size))
        kept = " ".join(w for i, w in enumerate(words) if i not in gone)
        out.append((d, len(words), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def test_cover():
    for a in range(anchors.PERIOD):
        for b in range(anchors.PERIOD):
            assert any((a + k) % anchors.PERIOD in anchors.COVER and (b + k) % anchors.PERIOD in anchors.COVER for k in range(anchors.PERIOD))


def test_query_against_brute_force(spark):
    folder = "/root/testdata/sf0.01"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    got = Counter(tuple(r) for r in QUERIES["op3_anchors"](spark, folder).collect())
    assert got == Counter(brute(rows)) and any(n for _, _, n, _ in got)


@pytest.mark.parametrize(("shards", "slice_bytes"), [(None, 8 << 20), (1, 1), (3, 600)])
def test_edges(spark, monkeypatch, shards, slice_bytes):
    monkeypatch.setattr(anchors, "SLICE_BYTES", slice_bytes)
    draw = random.Random(9)
    words = lambda n: [draw.choice("ab") + draw.choice(["", "é", "c" * 9]) for _ in range(n)]
    passage = words(70)
    texts = [None, "", "\n", "x " * 90, " ".join(passage), "\t".join(passage + passage), "y " * 19]
    for _ in range(40):
        cut = draw.randrange(50)
        texts.append(" ".join(words(draw.randrange(14)) + passage[cut : cut + draw.randrange(70)] + words(5)))
    texts += [" ".join(words(2000)), "x " * 30]
    rows = [(3 * i % 101, t) for i, t in enumerate(texts)]
    rows += [(None, " ".join(passage[3:40])), (None, " ".join(passage[3:41])), (12, " ".join(passage)), rows[9], rows[9]]
    frame = spark.createDataFrame([(d, t, "u", 1) for d, t in rows], "doc_id long, text string, uid string, id long")
    found = anchors.remove_repeated_runs(frame, shards=shards).collect()
    assert Counter((r.id, r.n_words, r.n_removed, r.kept_sha256) for r in found) == Counter(brute(rows))
    assert all(hashlib.sha256(r.kept.encode()).hexdigest() == r.kept_sha256 for r in found)
    assert anchors.remove_repeated_runs(frame.limit(0)).count() == 0
