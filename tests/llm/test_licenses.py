"""Phrases against regular expressions, templates with and without their optional parts."""

import re

import pytest

from docketeer.llm import licenses
from docketeer.llm.queries import QUERIES

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def places(text):
    said = words(text)
    return sorted(
        (i, i + len(p.split()), label)
        for p, label in licenses.PHRASES.items()
        for i in range(len(said))
        if said[i : i + len(p.split())] == p.split()
    )


def test_query_against_python(spark):
    folder = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = QUERIES["op5_licenses"](spark, folder).collect()
    assert len(rows) == len(texts) and any(r.n_base for r in rows)
    for r in rows:
        want = places(texts[r.doc_id])
        assert (r.n_words, r.n_base) == (len(words(texts[r.doc_id])), len(want))
        assert r.first_word == min((s for s, _, _ in want), default=None)
        assert r.last_word == max((s for s, _, _ in want), default=None)
        assert r.base_labels == ",".join(sorted({x for _, _, x in want}))
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(","))
        assert 0 <= r.score <= 1


def _plain(markup, optional=True, names="acme and partners"):
    text = re.sub(r"<<any \d+>>", names, markup)
    while "<<optional>>" in text:
        inner = r"<<optional>>((?:(?!<<optional>>|<<end>>).)*)<<end>>"
        text = re.sub(inner, r"\1" if optional else "", text, flags=re.S)
    return " ".join(text.split())


@pytest.mark.parametrize("label", licenses.TEMPLATES)
@pytest.mark.parametrize("optional", [True, False])
def test_templates(label, optional):
    scan = licenses.scanner().scan
    text = _plain(licenses.TEMPLATES[label], optional)
    n = len(text.split())
    found = scan(f"intro, {text.replace(' ', ', ')} outro".encode())[1]
    assert (1, n + 1, label) in found
    # Another word for a mandatory one, here the last of the bare form, is no match of the whole.
    bare = _plain(licenses.TEMPLATES[label], False, "x").split()
    changed = " ".join(bare[:-1] + ["zebra"])
    assert all(x != label for _, _, x in scan(changed.encode())[1])


def test_gap_bounds():
    automaton = licenses.compile_template("t", "a <<any 2>> b <<optional>> c <<optional>> d <<end>> <<end>>")
    ends = {t: automaton.match(t.split(), 0) for t in ("a b", "a x b", "a x x b", "a x x x b", "a b c", "a b c d", "a b d", "b")}
    assert ends == {"a b": 2, "a x b": 3, "a x x b": 4, "a x x x b": None, "a b c": 3, "a b c d": 4, "a b d": 2, "b": None}
    for wrong in ("<<optional>> a", "<<any 3>> a", "<<optional>> a <<end>>"):
        with pytest.raises(ValueError):
            licenses.compile_template("t", wrong)


def test_edges(spark):
    full = _plain(licenses.TEMPLATES["mit-text"])
    texts = [None, "", " ,", "MIT-License", "mit licenses", "éCC BY cc_by: CC  BY-NC 4.0", full.upper(), "the " * 40_000 + "apache license", "Released under the MIT License."]
    frame = spark.createDataFrame(
        [(i, t, 1, "b") for i, t in enumerate(texts)] + [(3, texts[3], 1, "b")],
        "doc_id long, text string, n_words long, base string",
    )
    rows = licenses.license_scan(frame).collect()
    assert len(rows) == len(texts) + 1
    for r in rows:
        text = texts[r.row.doc_id]
        assert [tuple(s) for s in r.base] == places(text) and r.n_words == len(words(text))
    by_id = {r.row.doc_id: r for r in rows}
    assert by_id[6].score == 1 and [m.label for m in by_id[6].matches] == ["mit-text"]
    assert [m.label for m in by_id[8].matches] == ["mit"] and by_id[0].score == 0
    assert licenses.license_scan(frame.limit(0)).count() == 0
