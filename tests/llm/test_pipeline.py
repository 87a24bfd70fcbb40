"""Every stage's decisions against brute force over what the stage before left."""

import re
from collections import Counter, defaultdict

from test_decontaminate import brute as hits
from test_mixing import WORD, wanted
from test_quality import counts
from test_secrets import base
from test_simhash import brute as components

import corpus_pipeline
from docketeer.llm import quality
from docketeer.session import settled

FOLDER = "/root/testdata/sf0.001"


def _by_id(df):
    rows = df.collect()
    assert len({r.doc_id for r in rows}) == len(rows)
    return {r.doc_id: r for r in rows}


def test_stages(spark):
    documents = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    outs = [documents]
    for name, stage in corpus_pipeline.STAGES:
        outs.append(settled(stage(spark, outs[-1], FOLDER), "test"))
        assert outs[-1].columns == documents.columns, name
    raw, good, single, clean, safe = map(_by_id, outs[:-1])

    model = quality.fit(documents.select("doc_id", "text"), labels)
    scored = {r.doc_id: r.p for r in quality.assess(documents, model).selectExpr("row.doc_id", "probability p").collect()}
    assert set(good) == {d for d, r in raw.items() if not counts(r.text)[5] and scored[d] >= quality.KEEP_FROM}
    assert 0 < len(good) < len(raw) and all(good[d] == raw[d] for d in good)
    marked = {r.doc_id: r.quality for r in labels.collect()}
    fine = [d for d, r in raw.items() if marked.get(d) == 1 and not counts(r.text)[5]]
    assert all(d in good for d in fine)

    groups = components([(d, r.text) for d, r in good.items()])
    assert set(single) == {c for _, c in groups.values()}
    assert len(single) < len(good)

    assert set(clean) == {d for d, r in single.items() if not hits(r.text, items)[1]}
    assert all(clean[d] == raw[d] for d in clean)

    assert set(safe) == set(clean)
    for d, r in safe.items():
        found = base(clean[d].text)
        assert not base(r.text)
        if found:
            assert "[SECRET]" in r.text and r.n_chars == len(r.text)
        elif "[SECRET]" not in r.text:
            assert r == clean[d]

    sizes, taken = defaultdict(int), Counter(r for r in outs[-1].collect())
    largest = defaultdict(int)
    for r in safe.values():
        sizes[r.source] += len(WORD.findall(r.text))
        largest[r.source] = max(largest[r.source], len(WORD.findall(r.text)))
    assert set(taken) <= set(safe.values()) and max(taken.values()) <= 3
    words = defaultdict(int)
    for r, n in taken.items():
        words[r.source] += n * len(WORD.findall(r.text))
    for source, target in wanted(sizes).items():
        assert abs(words[source] - target) <= largest[source] + 1e-6
    assert not any(re.search("AKIA[A-Z0-9]{16}", r.text) for r in taken)


def test_stages_at_the_edges(spark, tmp_path):
    """Nulls, empty texts, repeated rows, other columns and no rows at all."""
    text = " ".join(f"word{i} and{i % 7}" for i in range(60))
    rows = [(1, text, "en", "a", 5, "x"), (1, text, "en", "a", 5, "x"), (None, text + " z", None, None, None, None)]
    rows += [(2, None, "en", "a", 0, "x"), (3, "", "en", None, 0, "x"), (4, text.upper(), "en", "b", 5, "x")]
    rows += [(None, " ".join(f"other{i}" for i in range(70)), None, "b", 5, "x")]
    ddl = "doc_id long, text string, lang string, source string, n_chars long, size string"
    spark.createDataFrame([(4, 0), (1, 1), (None, 1)], "doc_id long, quality long").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([("i", None), ("j", "no such words here")], "item_id string, text string").write.parquet(
        f"{tmp_path}/benchmark.parquet"
    )
    table = spark.createDataFrame(rows, ddl)
    assert corpus_pipeline.near_duplicates(spark, table, str(tmp_path)).count() == 4
    for docs in (table, table.limit(0)):
        for _, stage in corpus_pipeline.STAGES:
            docs = settled(stage(spark, docs, str(tmp_path)), "test")
            assert docs.columns == table.columns
    assert docs.count() == 0
