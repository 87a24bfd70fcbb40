"""Bytes left by the suffix arrays against sets of all windows."""

import hashlib
import random
from collections import Counter

import pytest

from docketeer.llm import suffixdedup
from docketeer.llm.queries import QUERIES


def brute(texts, length):
    """(n_bytes, n_removed, n_spans, sha256) of each text."""
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[i : i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        gone = bytearray(len(d))
        for i in range(len(d) - length + 1):
            if seen[d[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        kept = bytes(b for b, g in zip(d, gone, strict=True) if not g)
        spans = sum(g and (not i or not gone[i - 1]) for i, g in enumerate(gone))
        out.append((len(d), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def test_query_against_brute_force(spark):
    folder = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{folder}/documents.parquet").collect()
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in QUERIES["op10_suffixes"](spark, folder).collect()}
    want = brute([r.text for r in rows], 400)
    assert got == {r.doc_id: w for r, w in zip(rows, want, strict=True)}
    assert any(n for _, n, _, _ in got.values())


@pytest.mark.parametrize(("most", "shard"), [(2000, 2 << 20), (0, 1), (3, 300)])
def test_edges(spark, monkeypatch, most, shard):
    """Whether by suffix arrays, in shards of any size, or by counted windows."""
    monkeypatch.setattr(suffixdedup, "MOST_REGIONS", most)
    monkeypatch.setattr(suffixdedup, "SHARD_BYTES", shard)
    draw = random.Random(4)
    word = lambda: "".join(draw.choices("abcdé ", k=draw.randrange(1, 9)))
    passage = "".join(word() for _ in range(30))
    texts = [None, "", "é", passage, "x" + passage + "y", "a" * 130, "b" * 39, "ab" * 60]
    for _ in range(40):
        cut = draw.randrange(60)
        texts.append(word() * draw.randrange(3) + passage[cut : cut + draw.randrange(90)] + word())
    texts += [texts[9], texts[9] + "!", "\n".join([passage[:50]] * 4), "".join(word() for _ in range(3000))]
    keys = [*range(len(texts)), None, 5, 5]
    texts += [passage[:70], "a" * 130, "zz" + passage[20:]]
    frame = spark.createDataFrame(
        list(zip(keys, texts, [1] * len(keys), strict=True)), "doc_id long, text string, th long"
    )
    rows = suffixdedup.remove_repeats(frame, length=40, probe=12).collect()
    got = Counter((r.id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows)
    assert got == Counter((k, *w) for k, w in zip(keys, brute(texts, 40), strict=True))
    assert all(hashlib.sha256(r.kept).hexdigest() == r.kept_sha256 for r in rows)
    assert suffixdedup.remove_repeats(frame.limit(0)).count() == 0
