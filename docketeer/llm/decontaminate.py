"""Benchmark passages in texts, found by one Aho-Corasick automaton."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docketeer.llm import arrays as A

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Letters of windows that one automaton is built from; more windows make more automata, which
# the texts pass one after the other in the same task.
BLOCK_LETTERS = 8_000_000

_WORD = re.compile(rb"[^ ]+")


def item_windows(items: DataFrame, key: str, text: str, size: int) -> DataFrame:
    """(window, items): every distinct run of ``size`` words, or whole shorter item, and its items.

    A null id is written as the empty string. Items without a word have no window.
    """
    lower = F.translate(F.col(f"`{text}`"), UPPER, LOWER)
    words = F.regexp_extract_all(lower, F.lit(WORD), F.lit(0))
    firsts = F.sequence(F.lit(1), F.greatest(F.size("words") - size + 1, F.lit(1)))
    rows = items.select(F.coalesce(F.col(f"`{key}`").cast("string"), F.lit("")).alias("item"), words.alias("words"))
    windows = rows.where(F.size("words") > 0).select(
        "item", F.explode(F.transform(firsts, lambda i: F.array_join(F.slice("words", i, F.lit(size)), " "))).alias("window")
    )
    return windows.groupBy("window").agg(F.collect_set("item").alias("items"))


def _automaton(name: str, block: Broadcast) -> ahocorasick.Automaton:
    """The automaton of a broadcast block, built once in each Python worker."""
    automata = A.held("automata")
    if name not in automata:
        made = ahocorasick.Automaton()
        for window, items in block.value:
            made.add_word(f" {window} ", (window.count(" ") + 1, items))
        made.make_automaton()
        automata[name] = made
    return automata[name]


def _hits(automaton: ahocorasick.Automaton, data: bytes) -> tuple[list[tuple[int, int]], set[str]]:
    """Ranges of words that windows cover, and the items they come from."""
    words = data.translate(A.CLEAN).split()
    if not words:
        return [], set()
    said = f" {b' '.join(words).decode()} "
    found, items = [], set()
    for end, (size, owners) in automaton.iter(said):
        found.append((end, size))
        items.update(owners)
    if not found:
        return [], items
    # The blank behind word w stands at the sum of the lengths up to it.
    blanks = np.cumsum([len(w.decode()) + 1 for w in words])
    last = np.searchsorted(blanks, [e for e, _ in found])
    return [(int(w) - size + 1, int(w) + 1) for w, (_, size) in zip(last, found, strict=True)], items


def contamination(
    df: DataFrame,
    items: DataFrame,
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
    size: int = 10,
) -> DataFrame:
    """(row, n_words, spans, n_hit, item_ids): the input row as a struct and what was found in it.

    ``spans`` are the byte ranges of the original text whose words lie in a window, ``item_ids``
    the items with an occurring window, sorted as strings, each once. Null and empty texts have
    no words; repeated rows are each kept; without items nothing is hit; an empty table gives an
    empty one. The windows come to the driver in blocks of BLOCK_LETTERS at most, a size that is
    measured before anything is collected or broadcast; each block is an automaton of its own.
    """
    spark = df.sparkSession
    windows = item_windows(items, item_key, item_text, size)
    total = windows.agg(F.sum(F.length("window") + F.length(F.array_join("items", " ")))).first()[0] or 0
    n_blocks = -(-total // BLOCK_LETTERS)
    whole = F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias("row")
    empty = "cast(array() as array<int>)", "cast(array() as array<string>)"
    rows = df.select(whole, *(F.expr(e) for e in empty), F.lit(0).cast("long"))
    rows = rows.toDF("row", "hits", "items", "n_words")
    for b in range(max(1, n_blocks)):
        of_block = windows.where(F.pmod(F.xxhash64("window"), F.lit(max(1, n_blocks))) == b)
        held = [(r["window"], r["items"]) for r in of_block.collect()]
        rows = _scan(rows, text, spark.sparkContext.broadcast(held))
    spans = F.expr("transform(sequence(1, size(hits), 2), i -> struct(element_at(hits, i) as start, element_at(hits, i + 1) as end))")
    return rows.select(
        "row",
        "n_words",
        F.when(F.size("hits") > 0, spans)
        .otherwise(F.expr("cast(array() as array<struct<start:int,end:int>>)"))
        .alias("spans"),
        (F.size("hits") / 2).cast("long").alias("n_hit"),
        F.array_sort(F.array_distinct("items")).alias("item_ids"),
    )


def _scan(rows: DataFrame, text: str, block: Broadcast) -> DataFrame:
    """Add a block's hits, as start and end byte of every hit word, to those found before."""

    name = uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(0).field(text)
            all_hits, all_items, n_words = [], [], []
            automaton = _automaton(name, block)
            before = zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)
            for value, (hits, items) in zip(texts, before, strict=True):
                data = (value.as_py() or "").encode()
                ranges, found = _hits(automaton, data) if len(automaton) else ([], set())
                clean = data.translate(A.CLEAN)
                n_words.append(len(clean.split()))
                if ranges:
                    marks = A.covered(*np.array(ranges).T, n_words[-1])
                    where = [m.span() for m, hit in zip(_WORD.finditer(clean), marks, strict=True) if hit]
                    both = set(zip(hits[::2], hits[1::2], strict=True)) | set(where)
                    hits = [x for span in sorted(both) for x in span]
                all_hits.append(hits)
                all_items.append(items + sorted(found))
            new = [
                batch.column(0),
                pa.array(all_hits, pa.list_(pa.int32())),
                pa.array(all_items, pa.list_(pa.string())),
                pa.array(n_words, pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(new, ["row", "hits", "items", "n_words"])

    return rows.mapInArrow(run, rows.schema)


def item_digest(ids: Column) -> Column:
    return F.sha2(F.array_join(ids, ","), 256)
