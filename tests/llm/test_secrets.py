"""Secret spans against Python's regular expressions, and the tests of randomness."""

import hashlib
import random
import re
import time

from pyspark.sql import functions as F

from docketeer.llm import secrets
from docketeer.llm.queries import QUERIES

ASSIGN = re.compile(
    r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
    re.IGNORECASE | re.ASCII,
)
RANDOM = random.Random(5)
SIGNS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"


def base(text):
    text = text or ""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(found)


def digest(spans):
    said = ",".join(f"{secrets.KINDS[k]}:{s}:{e}" for s, k, e in spans)
    return hashlib.sha256(said.encode()).hexdigest()


def test_query_against_python(spark):
    folder = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = QUERIES["op6_secrets"](spark, folder).collect()
    assert len(rows) == len(texts)
    for row in rows:
        want = base(texts[row.doc_id])
        assert row.base_sha256 == digest(want)
        assert [row.n_assign, row.n_access, row.n_hex] == [
            sum(k == n for _, k, _ in want) for n in range(3)
        ]
        assert digest(want) == digest(want) and all(
            f"{secrets.KINDS[k]}:{s}:{e}" in row.spans.split(",") for s, k, e in want
        )


def test_edges_and_random_tokens(spark):
    key = "".join(RANDOM.choices(SIGNS, k=60))
    texts = [
        None,
        "",
        "é token = 'abc.def' and PassWord:x12345 token=ab token: token=abcdef",
        "AKIA" + "B2" * 8 + " xAKIA" + "C" * 15 + "\nAPI_KEY = \"zzzzzz\"",
        f"see {key} there",
        "unconstitutionalitiesandmore thethethethethethethethethethethe " + "a" * 300,
        "0123456789" * 5,
        "deadbeef" * 3,
    ]
    frame = spark.createDataFrame(
        [(i, t, "x", i) for i, t in enumerate(texts)] + [(2, texts[2], "x", 2)],
        "doc_id long, text string, base string, candidates long",
    )
    found = secrets.find_secrets(frame)
    rows = {r.row.doc_id: r for r in found.collect()}
    assert found.count() == len(texts) + 1
    for i, text in enumerate(texts):
        assert [tuple(s) for s in rows[i].base] == [(s, k, e) for s, k, e in base(text)]
        extra = [tuple(s) for s in rows[i].spans if s.kind == 3]
        assert extra == ([(4, 3, 64)] if i == 4 else [])
        assert rows[i].row.base == "x"
    done = found.select("row.doc_id", secrets.redact(F.col("row.text"), F.col("spans")).alias("t"))
    done = {r.doc_id: r.t for r in done.collect()}
    assert done[0] is None and done[1] == "" and done[4] == "see [SECRET] there"
    assert done[2].startswith("é [SECRET]' and [SECRET] token=ab ")


def test_empty_table(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert secrets.find_secrets(none).count() == 0


def test_very_many_matches(spark):
    """100,000 matches in a text are put together in time in proportion."""
    keys = ["".join(RANDOM.choices(SIGNS, k=24)) for _ in range(20_000)]
    said = [f"token={i:06x}" if i % 5 else f"{keys[i // 5]} password: {i:030x}" for i in range(100_000)]
    text = " ".join(said)
    table = spark.createDataFrame([(1, text)], "doc_id long, text string")
    secrets.find_secrets(table.limit(0)).collect()
    begin = time.perf_counter()
    row = secrets.find_secrets(table, carry=["doc_id"]).first()
    assert time.perf_counter() - begin < 30
    assert [tuple(b) for b in row.base] == base(text)
    assert len(row.base) > 100_000


def test_random_spans_beside_base_spans(spark):
    """A random span goes where a base span touches it, as comparing all of them tells."""
    rng = random.Random(9)
    rows = []
    for i in range(200):
        hits = sorted((a, 0, a + rng.randint(1, 9)) for a in rng.sample(range(100), rng.randint(0, 30)))
        extra = [(a, 3, a + rng.randint(1, 6)) for a in sorted(rng.sample(range(100), rng.randint(0, 10)))]
        rows.append((i, hits, extra))
    kind = "array<struct<start:int,kind:int,end:int>>"
    table = spark.createDataFrame(rows, f"i int, hits {kind}, extra {kind}")
    got = table.select("i", secrets._spans_of(F.col("hits"), F.col("extra")).alias("s")).collect()
    for r in got:
        _, hits, extra = rows[r.i]
        free = [x for x in extra if not any(h[0] < x[2] and x[0] < h[2] for h in hits)]
        assert [tuple(x) for x in r.s] == sorted(hits + free)
