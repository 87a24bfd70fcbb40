"""Windows of items in texts: edges, and several automata instead of one."""

import re

import pytest

from docketeer.llm import decontaminate

ITEM = "One two, three four five six-seven eight nine ten eleven twelve"
WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute(text, items, size=10):
    lower = lambda t: re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
    words = WORDS.findall(lower(text))
    hit, ids = set(), set()
    for key, said in items:
        said = WORDS.findall(lower(said))
        n = min(size, len(said))
        for i in range(len(said) - n + 1 if n else 0):
            for j in range(len(words) - n + 1):
                if words[j : j + n] == said[i : i + n]:
                    hit.update(range(j, j + n))
                    ids.add("" if key is None else str(key))
    return len(words), len(hit), sorted(ids)


@pytest.mark.parametrize("letters", [40, 8_000_000])
def test_edges(spark, monkeypatch, letters):
    monkeypatch.setattr(decontaminate, "BLOCK_LETTERS", letters)
    items = [(2, ITEM), (10, "Öre été"), (3, None), (4, "!?"), (None, "nine ten eleven"), (2, ITEM), (7, "été")]
    texts = [
        None, "", "...", ITEM, ITEM.upper() + " öre", "x ÖRE été y", "x öre, ÉTÉ öre-été été",
        "nine ten eleven nine ten eleven twelve", "tone " + ITEM + "s", " ".join([ITEM] * 300), ITEM,
        "a_nine  ten\neleven\tétés",
    ]
    frame = spark.createDataFrame(
        [(i, t, 1, "h") for i, t in enumerate(texts)] + [(5, texts[5], 1, "h")],
        "doc_id long, text string, n_words long, hits string",
    )
    table = spark.createDataFrame(items, "item_id long, text string")
    rows = decontaminate.contamination(frame, table).collect()
    assert len(rows) == len(texts) + 1
    for r in rows:
        text = texts[r.row.doc_id]
        assert (r.n_words, r.n_hit, r.item_ids) == brute(text, items)
        assert len(r.spans) == r.n_hit and r.row.hits == "h"
        data = (text or "").encode()
        assert all(WORDS.fullmatch(data[s.start : s.end].decode().lower()) for s in r.spans)
    none = spark.createDataFrame([], "item_id long, text string")
    assert all(r.n_hit == 0 for r in decontaminate.contamination(frame, none).collect())
    assert decontaminate.contamination(frame.limit(0), table).count() == 0
