"""Names in texts, found by an index of hashes, whatever the number of names.

A name of L bytes is covered by the first and the last w of them, w the largest power of two up to
L. The hashes of all windows of w bytes of a text come from those of half the length, so a text is
gone through once for each power of two. Places whose window is likely to begin a name are tried
with the lengths that names of that class have; the hash of the whole name, made of its first and
last window, then meets the table of names in one equi-join.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docketeer.operators.grams import FILTER_BITS, term_filter
from docketeer.session import settled

# Tasks get these functions by value, as executors need not have the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

FACTORS = np.array([0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, 0xBF58476D1CE4E5B9], np.uint64)
# Bytes of text that are hashed at once; a longer text by itself.
PIECE = 1 << 20
# The blanks that end a search when nothing else is left.
BLANK = r"(?U)\A[\s\x1c-\x1f]*\z"


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * FACTORS[1]
    return h ^ (h >> np.uint64(29))


def windows(data: np.ndarray, longest: int) -> Iterator[tuple[int, np.ndarray]]:
    """(w, hashes of the w bytes from each place on) for the powers of two up to ``longest``."""
    h, w = _mixed(data.astype(np.uint64) + np.uint64(1)), 1
    while w <= longest and len(h):
        yield w, h
        h = _mixed(h[: max(0, len(h) - w)] * FACTORS[0] + h[w:])
        w *= 2


def whole(first: np.ndarray, last: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The hash of a name from those of its first and last window and its length."""
    return _mixed(first * FACTORS[2] + last + length.astype(np.uint64) * FACTORS[0])


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8)
    held = column.buffers()[2]
    data = np.frombuffer(held, np.uint8) if held is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def _hashed(entries: DataFrame) -> DataFrame:
    """(kind, pos, name, w, head, length, t1): the hashes under which texts look for a name."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(over="ignore"):
            for batch in batches:
                data, offsets = _flat(batch.column(2))
                length = np.diff(offsets)
                size, head, t1 = (np.zeros(len(length), k) for k in (np.int32, np.uint64, np.uint64))
                for w, h in windows(data, int(length.max(initial=0))):
                    own = np.flatnonzero((length >= w) & (length < 2 * w))
                    first, last = h[offsets[own]], h[offsets[own] + length[own] - w]
                    size[own], head[own] = w, first
                    t1[own] = whole(first, last, length[own])
                new = [pa.array(size), pa.array(head.view(np.int64)), pa.array(length.astype(np.int32)), pa.array(t1.view(np.int64))]
                yield pa.RecordBatch.from_arrays([*batch.columns, *new], ["kind", "pos", "name", "w", "head", "length", "t1"])

    kind = entries.schema["pos"].dataType.simpleString()
    return entries.mapInArrow(run, f"kind string, pos {kind}, name string, w int, head long, length int, t1 long")


class Index:
    """Filters of fixed size over heads and whole names, and the lengths of each class."""

    def __init__(self, names: DataFrame) -> None:
        heads = names.select("w", F.col("head").alias("t1"))
        self.heads: Broadcast = term_filter(heads, "w", FILTER_BITS)
        self.wholes: Broadcast = term_filter(names, "w", FILTER_BITS)
        # As many rows as names of a column have lengths.
        rows = names.select("kind", "w", "length").distinct().collect()
        self.lengths = {w: sorted({r["length"] for r in rows if r["w"] == w}) for w in {r["w"] for r in rows}}
        self.longest = {k: max(r["length"] for r in rows if r["kind"] == k) for k in {r["kind"] for r in rows}}


def _passes(bits: np.ndarray, t1: np.ndarray, slot: int) -> np.ndarray:
    at = (t1.view(np.int64) ^ (slot << 13)) & (FILTER_BITS - 1)
    return (bits[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) > 0


def likely(
    data: np.ndarray, offsets: np.ndarray, lengths: dict[int, list[int]], heads: np.ndarray, wholes: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """(text, t1): the distinct hashes of names that each text is likely to have."""
    texts, found = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
    ends = np.repeat(offsets[1:], np.diff(offsets))
    for w, h in windows(data, max(lengths, default=0)):
        if w not in lengths:
            continue
        places = np.flatnonzero(_passes(heads, h, w))
        for length in lengths[w]:
            own = places[places + length <= ends[places]]
            t1 = whole(h[own], h[own + length - w], np.full(len(own), length))
            held = _passes(wholes, t1, w)
            texts.append(np.searchsorted(offsets, own[held], side="right") - 1)
            found.append(t1[held])
    text, t1 = np.concatenate(texts), np.concatenate(found)
    order = np.lexsort((t1, text))
    text, t1 = text[order], t1[order]
    new = np.ones(len(text), bool)
    new[1:] = (text[1:] != text[:-1]) | (t1[1:] != t1[:-1])
    return text[new], t1[new].view(np.int64)


def _pieces(batch: pa.RecordBatch, column: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    data, offsets = _flat(batch.column(column))
    first = 0
    while first < batch.num_rows:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + PIECE, side="right")) - 1)
        yield batch.slice(first, last - first), data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


def _probes(texts: DataFrame, index: Index) -> DataFrame:
    """(digest, t1) of every text."""
    heads, wholes, lengths = index.heads, index.wholes, index.lengths

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(over="ignore"):
            for batch in batches:
                for part, data, offsets in _pieces(batch, 1):
                    text, t1 = likely(data, offsets, lengths, heads.value, wholes.value)
                    yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(text)), pa.array(t1)], ["digest", "t1"])

    return texts.select("digest", "text").mapInArrow(run, "digest string, t1 long")


def erased(text: str, names: list[str], longest: int, blank: str) -> tuple[list[int], int, list[str]]:
    """Which names the text meets in their order, which of them emptied it, and the new joints.

    A name that is met is erased everywhere. A joint is a place where that put two parts together,
    with as many letters around it as a name may have.
    """
    hits, joints = [], set()
    for i, name in enumerate(names):
        if name not in text:
            continue
        hits.append(i)
        parts = text.split(name)
        text = "".join(parts)
        at = 0
        for part in parts[:-1]:
            at += len(part)
            joints.add(text[max(0, at - longest + 1) : at + longest - 1])
        if not text.strip(blank):
            return hits, i, []
    return hits, -1, sorted(joints)


def _folded(listed: DataFrame, index: Index) -> DataFrame:
    """(digest, kind, n, hits, done, joints): the entries met, the one that emptied the text, likely new ones."""
    heads, wholes, lengths, longest = index.heads, index.wholes, index.lengths, index.longest
    # What the pattern of a blank text has: all white space, and the four separators.
    blank = "".join(c for c in map(chr, range(0x3001)) if c.isspace())
    ddl = listed.schema
    kind = ddl["names"].dataType.elementType["pos"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(over="ignore"):
            for batch in batches:
                texts, kinds, lists = batch.column(1).to_pylist(), batch.column(3).to_pylist(), batch.column(4)
                parent = lists.value_parent_indices()
                names = lists.flatten()
                said = names.field("name").to_pylist()
                begins = np.searchsorted(parent.to_numpy(), np.arange(batch.num_rows + 1)).tolist()
                hits, done, joints, owner = [], [], [], []
                for i, text in enumerate(texts):
                    met, last, new = erased(text, said[begins[i] : begins[i + 1]], longest[kinds[i]], blank)
                    hits.append([begins[i] + k for k in met])
                    done.append(begins[i] + last if last >= 0 else None)
                    joints += new
                    owner += [i] * len(new)
                more: list[set] = [set() for _ in texts]
                if joints:
                    data, offsets = _flat(pa.array(joints, pa.large_string()))
                    for j, t1 in zip(*(x.tolist() for x in likely(data, offsets, lengths, heads.value, wholes.value)), strict=True):
                        more[owner[j]].add(t1)
                flat = pa.array([k for h in hits for k in h], pa.int64())
                bounds = pa.array(np.cumsum([0, *map(len, hits)]), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0), batch.column(3), batch.column(2),
                        pa.ListArray.from_arrays(bounds, names.take(flat)),
                        names.take(pa.array(done, pa.int64())),
                        pa.array([sorted(m) for m in more], pa.list_(pa.int64())),
                    ],
                    ["digest", "kind", "n", "hits", "done", "joints"],
                )

    entry = f"struct<pos:{kind},name:string>"
    return listed.mapInArrow(run, f"digest string, kind string, n long, hits array<{entry}>, done {entry}, joints array<long>")


def _listed(texts: DataFrame, met: DataFrame) -> DataFrame:
    """(digest, text, n, kind, names): the names that each text may meet, in order."""
    lists = met.groupBy("digest", "kind").agg(F.array_sort(F.collect_list(F.struct("pos", "name"))).alias("names"))
    return texts.join(lists, "digest").select("digest", "text", "n", "kind", "names")


def met_in_order(texts: DataFrame, entries: DataFrame) -> DataFrame:
    """(digest, kind, n, hits, done): for each text, not blank, and kind the entries it meets.

    ``texts`` has digest, text and n, ``entries`` kind, pos and a name that is not empty. In order of
    pos and name a name found in what is left of a text is a hit and is erased everywhere; ``done``
    is the entry behind which nothing but blanks was left. Texts that meet nothing have no row. An
    erasure may put letters together that form another name; the joints it made are looked up in
    the same index, and texts with such a name are done again, until none has a new one.
    """
    names = settled(_hashed(entries), "index")
    index = Index(names)
    # One row for each text and name with the same hash.
    met = settled(_probes(texts, index).join(names.select("t1", "kind", "pos", "name"), "t1").drop("t1"), "met")
    folded = settled(_folded(_listed(texts, met), index), "folded")
    out = None
    while True:
        joints = folded.select("digest", "kind", F.explode("joints").alias("t1"))
        more = joints.join(names.select("t1", "kind", "pos", "name"), ["t1", "kind"]).drop("t1").distinct()
        more = settled(more.join(met, ["digest", "kind", "pos", "name"], "left_anti"), "more")
        again = more.select("digest", "kind").distinct()
        final = folded.join(again, ["digest", "kind"], "left_anti").drop("joints")
        out = final if out is None else out.unionByName(final)
        if more.isEmpty():
            return out
        # Only texts with a new name are done again.
        met = settled(met.join(again, ["digest", "kind"], "left_semi").unionByName(more), "met")
        folded = settled(_folded(_listed(texts, met), index), "folded")


def is_blank(text: Column) -> Column:
    return text.rlike(BLANK)
