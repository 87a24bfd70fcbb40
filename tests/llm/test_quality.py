"""Base counts against Python, the model on labels that it has not seen, and edges."""

import re
from collections import Counter

import pytest

from docketeer.llm import quality
from docketeer.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def counts(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(3)}
    lines = text.split("\n")
    dup = sum(bool(WORD.search(x)) and x in lines[:i] for i, x in enumerate(lines))
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    n = len(words)
    failed = n < 50 or 100 * len(covered) > 50 * n
    return [n, sum(map(len, words)), symbols, dup, len(covered), failed]


def test_query_against_python(spark):
    folder = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = QUERIES["op4_quality"](spark, folder).collect()
    assert len(rows) == len(texts)
    for r in rows:
        got = [r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed]
        assert got == counts(texts[r.doc_id]), r.doc_id
        assert r.kept == (not r.base_failed and r.probability >= quality.KEEP_FROM)


def test_labels_not_seen(spark):
    folder = "/root/testdata/sf0.1"
    documents = spark.read.parquet(f"{folder}/documents.parquet").repartition(8)
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    model = quality.fit(documents, labels.where("doc_id % 3 != 1"), rows=2000)
    found = quality.assess(documents, model).where("not base_failed")
    rows = found.selectExpr("row.doc_id", "kept").join(labels.where("doc_id % 3 = 1"), "doc_id").collect()
    good = [r.kept for r in rows if r.quality == 1]
    poor = [r.kept for r in rows if r.quality == 0]
    assert sum(good) >= 0.99 * len(good) and sum(poor) <= 0.1 * len(poor) and len(poor) > 50


@pytest.mark.parametrize("labelled", [True, False])
def test_edges(spark, labelled):
    plain = " ".join(f"word{i} näher" for i in range(90))
    texts = [None, "", " \t\n\x0b", "é", "a a a a\n\na a a a\na a a a\n", "x" * 300_000, plain, plain + "\r\n \n \n", "\n".join(["same line"] * 40), "y " * 60]
    frame = spark.createDataFrame(
        [(i, t, 3, "r") for i, t in enumerate(texts)] + [(6, plain, 3, "r"), (None, "a b", None, None)],
        "doc_id long, text string, n_words long, row string",
    )
    marks = [(i, i % 2) for i in range(9)] + [(3, 1), (None, 1), (4, None)] if labelled else []
    labels = spark.createDataFrame(marks, "doc_id long, quality long")
    model = quality.fit(frame.select("doc_id", "text"), labels)
    assert (model is not None) == labelled
    rows = quality.assess(frame, model).collect()
    assert len(rows) == len(texts) + 2
    for r in rows:
        got = [getattr(r, c) for c in quality.COUNTS] + [r.base_failed]
        assert got == counts(r.row.text)
    assert quality.assess(frame.limit(0), model).count() == 0


@pytest.mark.parametrize(("poor", "good", "least"), [(5, 400, 0.2), (10_000, 10_000, 0.95)])
def test_poor_rows_go(spark, poor, good, least):
    """Poor rows that were not seen go, with few poor labels too, and clean ones stay."""
    folder = "/root/testdata/sf0.1"
    documents = spark.read.parquet(f"{folder}/documents.parquet").repartition(8)
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    seen = labels.where("doc_id % 3 != 1").orderBy("doc_id")
    seen = seen.where("quality = 0").limit(poor).union(seen.where("quality = 1").limit(good))
    found = quality.assess(documents, quality.fit(documents, seen)).where("not base_failed")
    rows = found.selectExpr("row.doc_id", "kept").join(labels.where("doc_id % 3 = 1"), "doc_id").collect()
    kept = {k: [r.kept for r in rows if r.quality == k] for k in (0, 1)}
    assert sum(kept[1]) >= 0.99 * len(kept[1])
    assert len(kept[0]) - sum(kept[0]) >= least * len(kept[0]) and len(kept[0]) > 50
