"""Packing against a plain best-fit packing, and token ids against the tokenizer."""

import bisect
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from docketeer.llm import arrays, packing

PATH = str(public_tokenizers.path("word_bpe_49k.json"))
TEXTS = [
    None, "", " \n\t", "One two, three. ONE TWO, THREE.", "don't we'll 's 't s' it's.'s", "x" * 5000, "&&&### a&&& b%%%,",
    "é é É. ́a ÉTÉ, ΟΔΟΣ ΟΔΟΣ. İI K", "日本語 ٣٤٥ 12345 🙂🙂 a b c​d", "a" * 40 + "." * 40, "word " * 9000,
    "<|endoftext|> <|startoftext|>. x<|endoftext|>.", "<|EndOfText|>", "<|end oftext|>", "a<|endoftext|>b", "a.b.c. a-b- (c) \"d\" f(x)", "﻿bom \x00 nul \x7f",
]


def whole_ids(texts):
    """The ids as the tokenizer gives them for the whole texts."""
    tokenizer = Tokenizer.from_file(PATH)
    return [e.ids + [1] for e in tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]


@pytest.mark.parametrize("kept", [0, 1 << 19])
def test_token_ids(spark, monkeypatch, kept):
    monkeypatch.setattr(packing, "KEPT_CHUNKS", kept)
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()
    texts = TEXTS + [r.text for r in rows] + TEXTS
    want = [np.array(i, "<u4").tobytes() for i in whole_ids(texts)]
    for some, ids in ((texts, want), (texts[::-1], want[::-1])):
        assert packing.token_ids(*arrays.flat(pa.array(some, pa.string())), PATH) == ids


def best_fit(lengths, capacity):
    """The number of sequences of best-fit decreasing, piece by piece."""
    rooms, begun = [], 0
    for length in sorted(lengths, reverse=True):
        at = bisect.bisect_left(rooms, length)
        room = rooms.pop(at) if at < len(rooms) else capacity
        begun += at == len(rooms) and room == capacity
        if room > length:
            bisect.insort(rooms, room - length)
    return begun


def test_pack_counts():
    chance = random.Random(5)
    for _ in range(400):
        capacity = chance.choice([1, 2, 7, 12, 60, 100])
        counts = {chance.randint(1, capacity): chance.randint(0, 12) for _ in range(chance.randint(0, capacity))}
        bins, seen = defaultdict(list), defaultdict(list)
        for o in packing.pack_counts(counts, capacity):
            seen[o.length].append((o.first, o.n))
            for k in range(o.n):
                bins[o.sequence + k // o.each].append((o.offset + k % o.each * o.length, o.length))
        for length, n in counts.items():
            at = 0
            for first, many in sorted(seen[length]):
                assert first == at
                at += many
            assert at == n
        for held in bins.values():
            at = 0
            for offset, length in sorted(held):
                assert offset == at
                at += length
            assert at <= capacity
        assert sum(3 * length > capacity for b in bins.values() for _, length in b) <= 2 * len(bins)
        lengths = [length for length, n in counts.items() for _ in range(n)]
        assert len(bins) <= best_fit(lengths, capacity)


def test_orders_stay_few():
    counts = {length: 10**9 + 7 * length for length in range(1, 4097)}
    assert len(packing.pack_counts(counts)) < 3 * 4096 * 12


@pytest.mark.parametrize("most", [3, 100_000])
def test_rows(spark, monkeypatch, most):
    monkeypatch.setattr(packing, "NUMBERED", most)
    texts = TEXTS + ["short"] * 50 + [None] * 20 + ["some more words here"] * 40
    rows = [(None if i % 9 == 0 else i % 30, t, i, "y") for i, t in enumerate(texts)]
    table = spark.createDataFrame(rows, "doc_id long, text string, piece long, length string").repartition(5)
    monkeypatch.setattr(packing, "numbered", lambda r, b, n, f=packing.numbered: f(r, b, n, most))
    packed = packing.pack(table, PATH, capacity=64, with_ids=True)
    found = packed.collect()
    want = Counter()
    for (key, *_), ids in zip(rows, whole_ids(texts), strict=True):
        for number, at in enumerate(range(0, len(ids), 64)):
            held = np.array(ids[at : at + 64], "<u4").tobytes()
            want[key, number, at, len(held) // 4, zlib.crc32(held), held] += 1
    assert Counter((r.id, r.piece, r.start, r.length, r.ids_crc32, bytes(r.ids)) for r in found) == want
    bins = defaultdict(list)
    for r in found:
        bins[r.sequence_id].append((r.offset, r.length))
    for held in bins.values():
        assert [o for o, _ in sorted(held)] == [sum(n for _, n in sorted(held)[:i]) for i in range(len(held))]
        assert sum(n for _, n in held) <= 64
    assert len(bins) <= best_fit([r.length for r in found], 64)
    assert sum(r.length for r in packing.sequences(packed).collect()) == sum(r.length for r in found)
    assert packing.pack(table.limit(0), PATH).count() == 0


def test_query(spark):
    from docketeer.llm.queries import op12_packing

    found = op12_packing(spark, "/root/testdata/sf0.001")
    texts = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()
    lengths = [len(i) for i in whole_ids([r.text for r in texts])]
    filled = found.groupBy("sequence_id").agg(F.sum("length").alias("n"), F.max(F.col("offset") + F.col("length")).alias("end"))
    assert filled.where("n != end or n > 4096").count() == 0
    assert found.agg(F.sum("length")).first()[0] == sum(lengths)
    parts = [min(4096, n - at) for n in lengths for at in range(0, n, 4096)]
    assert filled.count() <= best_fit(parts, 4096)
