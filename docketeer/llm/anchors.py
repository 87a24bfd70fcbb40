"""Removing the words of long runs that also stand earlier, by difference-cover anchors.

Every word position whose number modulo PERIOD is in COVER is an anchor: the hash of the PROBE
words from there on. COVER is a difference cover, that is, any two positions modulo PERIOD can be
moved on by the same number of words, less than PERIOD, to be both in it. So two equal windows of
SIZE = PROBE + PERIOD - 1 words, wherever they stand, hold an equal anchor at the same place.

Anchors meet in shards of their hashes. Where one occurs twice, the windows around it are hashed
as a whole, which is the extension, and meet in shards again; all but the first are removed. Both
times a slice of texts settles its own repeats before anything is sent, so that a shard gets a
hash once from a slice however often it occurs, and what is already known to repeat goes to a
shard of its document instead.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketeer.llm import arrays as A
from docketeer.llm import spans as P

PERIOD, COVER = 13, (0, 1, 3, 9)
SIZE = 20
PROBE = SIZE - PERIOD + 1
SLICE_BYTES = 8 << 20
NO_ID = np.iinfo(np.int64).max

_ENTRY = (
    "shard int, uids binary, ids binary, hashes binary, texts binary, places binary,"
    " known_texts binary, known_places binary"
)
_ENTRY_NAMES = [part.split()[0] for part in _ENTRY.split(", ")]


def _with_uid(df: DataFrame, key: str, text: str) -> DataFrame:
    """(uid, id, text); a uid names a key and a text, and null texts are empty.

    Two rows with one uid would share what is found for either. For the anchors that only means
    more windows to look at; window positions go by ``ids`` as well, so 64 bits do.
    """
    said = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    number = F.col(f"`{key}`").cast("long")
    return df.select(F.xxhash64(number, said).alias("uid"), number.alias("id"), said.alias("text"))


class _Slice:
    """The words of a slice of texts."""

    def __init__(self, part: pa.RecordBatch, data: np.ndarray, offsets: np.ndarray) -> None:
        names = part.schema.names
        self.uids = part.column(names.index("uid")).to_numpy()
        self.ids = part.column(names.index("id")).fill_null(NO_ID).to_numpy()
        starts, ends, self.bounds = A.words(data, offsets, A.SPACED)
        self.hashes = A.word_hashes(data, starts, ends)
        n = np.diff(self.bounds)
        self.text = np.repeat(np.arange(len(n), dtype=np.int32), n)
        self.place = (np.arange(len(starts)) - self.bounds[self.text]).astype(np.int32)
        self.room = n[self.text] - self.place

    def entries(self, shards: int, hashes: np.ndarray, route: np.ndarray, at: np.ndarray, alone: np.ndarray, known: np.ndarray) -> Iterator[pa.RecordBatch]:
        """A row for each shard: hashes of the words ``at`` where ``alone``, places of ``known``."""
        sent, told = np.flatnonzero(alone), np.flatnonzero(known)
        to = (route[sent] % np.uint64(shards)).astype(np.int32)
        told_to = (self.uids.view(np.uint64)[self.text[at[told]]] % np.uint64(shards)).astype(np.int32)
        sent, told = sent[np.argsort(to, kind="stable")], told[np.argsort(told_to, kind="stable")]
        edges = np.searchsorted(np.sort(to), np.arange(shards + 1))
        told_edges = np.searchsorted(np.sort(told_to), np.arange(shards + 1))
        rows = []
        for s in range(shards):
            mine = sent[edges[s] : edges[s + 1]]
            more = told[told_edges[s] : told_edges[s + 1]]
            if not len(mine) + len(more):
                continue
            texts = self.text[at[np.concatenate([mine, more])]]
            used, index = np.unique(texts, return_inverse=True)
            index = index.astype(np.int32)
            row = [self.uids[used], self.ids[used], hashes[mine], index[: len(mine)], self.place[at[mine]]]
            row += [index[len(mine) :], self.place[at[more]]]
            rows.append([s, *(np.ascontiguousarray(x).tobytes() for x in row)])
        columns = list(zip(*rows, strict=True)) or [()] * 8
        kinds = [pa.int32()] + [pa.binary()] * 7
        arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
        yield pa.RecordBatch.from_arrays(arrays, _ENTRY_NAMES)


def _groups(order: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """For hashes in order, the number of the group of equal ones that each belongs to."""
    ranked = hashes[order]
    new = np.ones(len(ranked), bool)
    new[1:] = ranked[1:] != ranked[:-1]
    return np.cumsum(new) - 1


def _anchor_entries(docs: DataFrame, shards: int) -> DataFrame:
    """Every anchor, to the shard of its hash."""
    cover = np.zeros(PERIOD, bool)
    cover[list(COVER)] = True

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offsets in A.pieces(batch, most=SLICE_BYTES):
                own = _Slice(part, data, offsets)
                long = own.place + own.room >= SIZE
                at = np.flatnonzero(cover[own.place % PERIOD] & (own.room >= PROBE) & long)
                hashes = A.window_hashes(own.hashes, PROBE)[at]
                order = np.argsort(hashes, kind="stable")
                group = _groups(order, hashes)
                first, known = np.zeros(len(at), bool), np.zeros(len(at), bool)
                first[order] = np.diff(group, prepend=-1) > 0
                known[order] = np.bincount(group, minlength=1)[group] > 1
                # Within a shard 32 bits do, as windows are compared later.
                short = (hashes >> np.uint64(32)).astype(np.uint32)
                yield from own.entries(shards, short, hashes & np.uint64(0xFFFFFFFF), at, first, known)

    return docs.mapInArrow(run, _ENTRY)


def _window_entries(docs: DataFrame, shards: int) -> DataFrame:
    """Every window that holds a repeated anchor, to the shard of its hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists, row = batch.column(batch.schema.names.index("places")), 0
            for part, data, offsets in A.pieces(batch, most=SLICE_BYTES):
                own = _Slice(part, data, offsets)
                mine = lists.slice(row, part.num_rows)
                row += part.num_rows
                joined = [np.frombuffer(x, np.int32) for x in mine.to_pylist()]
                sizes = [len(x) for x in joined]
                anchor = np.concatenate(joined) + np.repeat(own.bounds[:-1], sizes)
                low = np.maximum(anchor - PERIOD + 1, np.repeat(own.bounds[:-1], sizes))
                near = A.covered(low, anchor + 1, len(own.text)) & (own.room >= SIZE)
                at = np.flatnonzero(near)
                hashes = A.window_hashes(own.hashes, SIZE)[at]
                route = A.window_hashes(own.hashes, SIZE, 0xD6E8FEB86659FD93)[at]
                ids, place = own.ids[own.text[at]], own.place[at]
                order = np.lexsort((place, ids, hashes))
                group = _groups(order, hashes)
                firsts = np.flatnonzero(np.diff(group, prepend=-1))
                lead = order[firsts][group] if len(order) else order
                first = np.zeros(len(at), bool)
                first[order] = (ids[order] == ids[lead]) & (place[order] == place[lead])
                yield from own.entries(shards, hashes, route, at, first, ~first)

    return docs.mapInArrow(run, _ENTRY)


def _marked(
    entries: DataFrame,
    shards: int,
    kind: type,
    find: Callable[[np.ndarray, np.ndarray, np.ndarray], np.ndarray],
) -> DataFrame:
    """(uid, places): for each document the places that ``find`` marks in a shard, and the known.

    ``find`` gets hashes, ids and places of all entries of a shard. What it marks goes back in
    as many parcels as there are shards, by document, and leaves these as one row for each
    document, its places packed as integers.
    """

    def run(group: pd.DataFrame) -> pd.DataFrame:
        uids, ids, hashes, places, told_uids, told = [], [], [], [], [], []
        for r in group.itertuples():
            uid, one = np.frombuffer(r.uids, np.int64), np.frombuffer(r.ids, np.int64)
            text, known = np.frombuffer(r.texts, np.int32), np.frombuffer(r.known_texts, np.int32)
            hashes.append(np.frombuffer(r.hashes, kind))
            uids.append(uid[text])
            ids.append(one[text])
            places.append(np.frombuffer(r.places, np.int32))
            told_uids.append(uid[known])
            told.append(np.frombuffer(r.known_places, np.int32))
        join = np.concatenate
        marks = find(join(hashes), join(ids), join(places))
        uid = join([join(uids)[marks], *told_uids])
        place = join([join(places)[marks], *told])
        to = (uid.view(np.uint64) % np.uint64(shards)).astype(np.int64)
        order = np.lexsort((uid, to))
        to, uid, place = to[order], uid[order], place[order]
        rows = []
        for s in np.unique(to):
            part = slice(*np.searchsorted(to, [s, s + 1]))
            own, sizes = np.unique(uid[part], return_counts=True)
            rows.append((int(s), own.tobytes(), sizes.astype(np.int32).tobytes(), place[part].tobytes()))
        return pd.DataFrame(rows, columns=["parcel", "uids", "sizes", "places"])

    def gather(group: pd.DataFrame) -> pd.DataFrame:
        uids = [np.frombuffer(x, np.int64) for x in group["uids"]]
        sizes = [np.frombuffer(x, np.int32) for x in group["sizes"]]
        uid = np.concatenate([np.repeat(u, n) for u, n in zip(uids, sizes, strict=True)])
        place = np.concatenate([np.frombuffer(x, np.int32) for x in group["places"]])
        order = np.argsort(uid, kind="stable")
        uid, place = uid[order], place[order]
        own, first = np.unique(uid, return_index=True)
        ends = np.append(first[1:], len(uid))
        packed = [place[s:e].tobytes() for s, e in zip(first, ends, strict=True)]
        return pd.DataFrame({"uid": own, "places": packed})

    parcels = entries.groupBy("shard").applyInPandas(
        run, "parcel int, uids binary, sizes binary, places binary"
    )
    return parcels.groupBy("parcel").applyInPandas(gather, "uid long, places binary")


def _shared(hashes: np.ndarray, ids: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Entries whose hash occurs twice or more."""
    order = np.argsort(hashes, kind="stable")
    group = _groups(order, hashes)
    out = np.zeros(len(hashes), bool)
    out[order] = np.bincount(group, minlength=1)[group] > 1
    return out


def _later(hashes: np.ndarray, ids: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Entries that stand behind another one of their hash."""
    order = np.lexsort((places, ids, hashes))
    group = _groups(order, hashes)
    out = np.zeros(len(hashes), bool)
    if len(order):
        lead = order[np.flatnonzero(np.diff(group, prepend=-1))][group]
        out[order] = (ids[order] != ids[lead]) | (places[order] != places[lead])
    return out


def _cut(docs: DataFrame) -> DataFrame:
    """(id, n_words, n_removed, kept_sha256, kept) from (id, text, places of removed windows)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.schema.names
            places = batch.column(names.index("places")).to_pylist()
            out = []
            texts = batch.column(names.index("text")).cast(pa.large_binary())
            for text, some in zip(texts, places, strict=True):
                words = (text.as_py() or b"").split()
                kept = words
                if some:
                    at = np.frombuffer(some, np.int32).astype(np.int64)
                    gone = A.covered(at, at + SIZE, len(words))
                    kept = [words[i] for i in np.flatnonzero(~gone)]
                said = b" ".join(kept)
                out.append((len(words), len(words) - len(kept), hashlib.sha256(said).hexdigest(), said.decode()))
            columns = list(zip(*out, strict=True)) or [()] * 4
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.string()]
            made = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(names.index("id")), *made], ["id", "n_words", "n_removed", "kept_sha256", "kept"]
            )

    return docs.select("id", "text", "places").mapInArrow(
        run, "id long, n_words long, n_removed long, kept_sha256 string, kept string"
    )


def remove_repeated_runs(
    df: DataFrame, key: str = "doc_id", text: str = "text", shards: int | None = None
) -> DataFrame:
    """(id, n_words, n_removed, kept_sha256, kept) for every row of ``df``.

    A word goes if a window of SIZE words that covers it also starts earlier: in a document with
    a smaller integer key, or in the same one before. Null keys come last. Rows that share a key
    are one document as far as the order goes, so equal windows at one place of them all stay.
    Null and empty texts have no words; shorter texts than a window stay; an empty table gives an
    empty one; other columns are not looked at. ``shards``, by default the session's shuffle
    partitions, should grow with the table.
    """
    shards = shards or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    docs = _with_uid(df, key, text)
    anchors = _marked(_anchor_entries(docs, shards), shards, np.uint32, _shared)
    near = docs.join(anchors, "uid")
    removed = _marked(_window_entries(near, shards), shards, np.uint64, _later)
    return _cut(docs.join(removed, "uid", "left"))
