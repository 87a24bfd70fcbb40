"""Removing every byte that lies in a long string found elsewhere too, by suffix arrays.

Equal strings meet because each window of LENGTH bytes is put down to an anchor inside it, the
smallest hash of PROBE bytes, which is the same wherever the window stands. An anchor owns a run
of window starts; its region is the bytes of those windows. Anchors of one hash are compared:

* regions that are equal as a whole are repeated as a whole, and go on as one of them;
* a window that two of them share reaches some way to the left of the anchor and the rest of its
  length to the right, so regions that have no such reach in common with another one are done;
* other different regions of one hash go to the shard of that hash, where a suffix array by induced
  sorting and its permuted common prefixes tell which windows start twice or more;
* a hash with more different regions than a shard should hold has its windows counted by hash.

Every window start is owned by one anchor, so the answer does not depend on how the shards fall.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketeer.llm import arrays as A
from docketeer.llm import spans as P
from docketeer.llm import suffixes
from docketeer.session import settled

LENGTH, PROBE = 400, 128
# Steps in which the reach of windows to the left of an anchor is compared.
REACHES = 4
# Bytes of a shard, and the different regions of one hash from which windows are counted instead.
SHARD_BYTES, MOST_REGIONS = 2 << 20, 2000


def _smallest(values: np.ndarray, width: int) -> np.ndarray:
    """Smallest of each ``width`` neighbours, from running minima of blocks (van Herk, 1992)."""
    n = len(values)
    padded = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = values
    blocks = padded.reshape(-1, width)
    before = np.minimum.accumulate(blocks, axis=1).ravel()
    after = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    count = n - width + 1
    return np.minimum(after[:count], before[width - 1 : width - 1 + count])


def _reaches(length: int, probe: int) -> list[tuple[int, int]]:
    """Bytes to the left and right of an anchor, of which every window around it has one pair at least."""
    width = length - probe
    step = max(1, width // REACHES)
    return [(left, max(0, width - left - step + 1)) for left in range(0, width + 1, step)]


def anchors(data: np.ndarray, offsets: np.ndarray, length: int, probe: int) -> dict[str, np.ndarray]:
    """For each anchor: its text, hash, the hash of its region, and first and last window start.

    ``reach`` has a short hash of the bytes around the anchor for each of the reaches, 0 where the
    region has no window that goes so far.
    """
    width = length - probe + 1
    starts = np.arange(max(0, len(data) - length + 1))
    text = np.searchsorted(offsets, starts, side="right") - 1
    whole = starts + length <= offsets[text + 1]
    none = {k: np.zeros(0, np.int64) for k in ("text", "first", "last")}
    if not whole.any():
        reach = np.zeros((0, len(_reaches(length, probe))), np.int32)
        return none | {k: np.zeros(0, np.uint64) for k in ("hash", "region")} | {"reach": reach}
    rolling = P.Rolling(data)
    hashes = rolling.windows(probe)
    low = np.uint64(0xFFFFFFFF)
    # The position breaks ties, the last one first.
    ranked = (hashes & ~low) | (low - np.arange(len(hashes), dtype=np.uint64))
    at = (low - (_smallest(ranked, width) & low)).astype(np.int64)
    new = whole.copy()
    new[1:] &= (at[1:] != at[:-1]) | ~whole[:-1] | (text[1:] != text[:-1])
    last = whole.copy()
    last[:-1] &= new[1:] | ~whole[1:]
    first, last = np.flatnonzero(new), np.flatnonzero(last)
    at, text = at[first], text[first]
    shape = ((at - first) * length + (last - first)).astype(np.uint64)
    region = P.Rolling(data, P.FACTORS[1]).ranges(first, last + length)
    reach = np.zeros((len(at), len(_reaches(length, probe))), np.int32)
    for i, (left, right) in enumerate(_reaches(length, probe)):
        far = np.flatnonzero((at - left >= first) & (at + probe + right <= last + length))
        around = rolling.ranges(at[far] - left, at[far] + probe + right)
        reach[far, i] = (around >> np.uint64(33)).astype(np.int32) + 1
    return {
        "text": text,
        "hash": hashes[at],
        "region": A.mixed(region ^ A.mixed(shape)),
        "first": first - offsets[text],
        "last": last - offsets[text],
        "reach": reach,
    }


def _anchor_rows(docs: DataFrame, length: int, probe: int) -> DataFrame:
    """(id, th, hash, region, first, last, reach) of every anchor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offsets in A.pieces(batch):
                found = anchors(data, offsets, length, probe)
                rows = pa.array(found["text"])
                out = [part.column(0).take(rows), part.column(1).take(rows)]
                out += [pa.array(found[k].view(np.int64)) for k in ("hash", "region")]
                out += [pa.array(found[k], pa.int32()) for k in ("first", "last")]
                bounds = np.arange(len(rows) + 1, dtype=np.int32) * found["reach"].shape[1]
                out.append(pa.ListArray.from_arrays(bounds, found["reach"].ravel()))
                yield pa.RecordBatch.from_arrays(out, ["id", "th", "hash", "region", "first", "last", "reach"])

    kind = docs.schema["id"].dataType.simpleString()
    return docs.mapInArrow(run, f"id {kind}, th long, hash long, region long, first int, last int, reach array<int>")


def _regions(docs: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """(shard, id, th, first, last, bytes) of the wanted regions."""
    listed = settled(
        wanted.groupBy("id", "th").agg(F.collect_list(F.struct("shard", "first", "last")).alias("regions")),
        "wanted",
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.schema.names
            regions = batch.column(names.index("regions"))
            data, offsets = A.flat(batch.column(names.index("text")))
            parent = regions.value_parent_indices()
            flat = regions.flatten()
            begin = offsets[parent.to_numpy()] + flat.field("first").to_numpy()
            end = offsets[parent.to_numpy()] + flat.field("last").to_numpy() + length
            held = data.tobytes()
            for k in range(0, len(flat), 20_000):
                cut = [held[s:e] for s, e in zip(begin[k : k + 20_000].tolist(), end[k : k + 20_000].tolist(), strict=True)]
                at = parent.slice(k, 20_000)
                part = flat.slice(k, 20_000)
                out = [part.field("shard"), *(batch.column(names.index(c)).take(at) for c in ("id", "th"))]
                out += [part.field("first"), part.field("last"), pa.array(cut, pa.binary())]
                yield pa.RecordBatch.from_arrays(out, ["shard", "id", "th", "first", "last", "bytes"])

    kind = docs.schema["id"].dataType.simpleString()
    near = P.likely(docs, listed).where("likely").drop("likely")
    return P.beside(near, listed).mapInArrow(
        run, f"shard long, id {kind}, th long, first int, last int, bytes binary"
    )


def _repeated_windows(regions: list[bytes], owned: np.ndarray, length: int) -> list[np.ndarray]:
    """For each region, which of its first ``owned`` windows start at two owned places or more."""
    sizes = np.array([len(r) for r in regions])
    joined = np.frombuffer(b"".join(r + b"\0" for r in regions), np.uint8).astype(np.int64) + 1
    begins = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]])
    joined[begins + sizes] = 0
    mine = A.covered(begins, begins + owned, len(joined))
    array = suffixes.suffix_array(joined)
    plcp, _ = suffixes.permuted_lcp(joined, array)
    group = np.cumsum(plcp[array] < length)
    owners = np.bincount(group, weights=mine[array])
    flags = np.zeros(len(joined), bool)
    flags[array] = (owners[group] > 1) & mine[array]
    return [flags[b : b + n] for b, n in zip(begins.tolist(), owned.tolist(), strict=True)]


def _shard_spans(regions: DataFrame, length: int, shards: int) -> DataFrame:
    """(id, th, start, end) of the repeated windows, from each shard's suffix array.

    A partition for each shard, or so: small ones are not put together, as sorting them takes long.
    """

    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.reset_index(drop=True)
        owned = (group["last"] - group["first"] + 1).to_numpy()
        found = _repeated_windows(group["bytes"].tolist(), owned, length)
        rows, starts, ends = [], [], []
        for i, flags in enumerate(found):
            s, e = P.runs(flags)
            rows += [i] * len(s)
            starts += (s + group["first"][i]).tolist()
            ends += (e + group["first"][i] + length - 1).tolist()
        out = group.loc[rows, ["id", "th"]].reset_index(drop=True)
        return out.assign(start=np.array(starts, np.int32), end=np.array(ends, np.int32))

    kind = regions.schema["id"].dataType.simpleString()
    return regions.repartition(shards, "shard").groupBy("shard").applyInPandas(run, f"id {kind}, th long, start int, end int")


def _window_spans(docs: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """The same for regions of very frequent hashes: windows of equal 128-bit hashes are counted."""
    listed = settled(
        wanted.groupBy("id", "th").agg(F.collect_list(F.struct("first", "last")).alias("regions")), "wanted"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.schema.names
            lists = batch.column(names.index("regions"))
            at = 0
            for part, data, offsets in A.pieces(batch):
                both = [P.Rolling(data, f).windows(length) for f in P.FACTORS]
                regions = lists.slice(at, part.num_rows)
                at += part.num_rows
                flat, parent = regions.flatten(), regions.value_parent_indices().to_numpy()
                first, last = (flat.field(c).to_numpy().astype(np.int64) for c in ("first", "last"))
                n = last - first + 1
                row = np.repeat(parent, n)
                start = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first, n)
                where = offsets[row] + start
                out = [part.column(names.index(c)).take(pa.array(row)) for c in ("id", "th")]
                out += [pa.array(start, pa.int32()), *(pa.array(h[where].view(np.int64)) for h in both)]
                yield pa.RecordBatch.from_arrays(out, ["id", "th", "start", "w1", "w2"])

    kind = docs.schema["id"].dataType.simpleString()
    near = P.likely(docs, listed).where("likely").drop("likely")
    windows = P.beside(near, listed).mapInArrow(run, f"id {kind}, th long, start int, w1 long, w2 long")
    windows = settled(windows, "windows")
    often = windows.groupBy("w1", "w2").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    found = windows.join(often, ["w1", "w2"])
    return found.select("id", "th", "start", (F.col("start") + length).alias("end"))


def _sharing(kinds: DataFrame) -> DataFrame:
    """The regions of which another region of the same anchor hash has one of the reaches."""
    several = kinds.groupBy("hash").agg(F.count(F.lit(1)).alias("d")).where("d > 1").select("hash")
    rows = settled(kinds.join(several, "hash", "left_semi"), "several")
    around = rows.select("hash", "region", F.posexplode("one.reach").alias("i", "around")).where("around != 0")
    met = around.groupBy("hash", "i", "around").agg(F.count(F.lit(1)).alias("d")).where("d > 1").drop("d")
    some = around.join(met, ["hash", "i", "around"], "left_semi").select("hash", "region").distinct()
    return rows.join(some, ["hash", "region"], "left_semi")


def repeated_spans(docs: DataFrame, length: int = LENGTH, probe: int = PROBE) -> DataFrame:
    """(id, th, start, end): byte ranges of (id, th, text) that windows found elsewhere cover."""
    rows = settled(_anchor_rows(docs, length, probe), "anchors")
    one = F.struct("id", "th", "first", "last", "reach")
    kinds = rows.groupBy("hash", "region").agg(F.count(F.lit(1)).alias("n"), F.min(one).alias("one"))
    kinds = settled(kinds, "regions")
    copies = rows.join(kinds.where("n > 1").select("hash", "region"), ["hash", "region"])
    out = copies.select("id", "th", F.col("first").alias("start"), (F.col("last") + length).alias("end"))

    size = F.col("one.last") - F.col("one.first") + length + 1
    contested = _sharing(kinds).select("hash", size.alias("size"), "one.id", "one.th", "one.first", "one.last")
    contested = settled(contested, "contested")
    several = contested.groupBy("hash").agg(F.count(F.lit(1)).alias("d"), F.sum("size").alias("bytes"))
    several = settled(several, "several")
    few = F.col("d") <= MOST_REGIONS
    total = several.agg(F.sum(F.when(few, F.col("bytes"))), F.sum(F.when(~few, F.lit(1)))).first()
    shards = max(1, -(-(total[0] or 0) // SHARD_BYTES))
    shard = F.pmod(F.xxhash64("hash"), F.lit(shards)).alias("shard")
    met = contested.join(several.select("hash", "d"), "hash").select(shard, "d", "id", "th", "first", "last")
    if total[0]:
        out = out.unionByName(_shard_spans(_regions(docs, met.where(few), length), length, shards))
    if total[1]:
        out = out.unionByName(_window_spans(docs, met.where(~few), length))
    return out


def remove_repeats(
    df: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH, probe: int = PROBE
) -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept_sha256, kept) for every row of ``df``.

    ``kept`` are the bytes of the text in UTF-8 that no ``length``-byte string found at another
    place covers. Null texts are empty; texts under ``length`` bytes stay whole; rows that repeat
    cover each other as any copies do; a null key is a key like any other; an empty table gives
    an empty one; other columns are not looked at. The anchors, their counts and the ranges are
    written to the shared folder. Texts are shuffled by key twice, those without any region to
    compare, or any range to remove, mostly not at all.
    """
    docs = P.with_identity(df, key, text)
    found = repeated_spans(docs, length, probe)
    found = found.groupBy("id", "th").agg(
        F.collect_list("start").alias("starts"), F.collect_list("end").alias("ends")
    )
    found = settled(found, "spans")
    marked = P.likely(docs, found)
    near = P.beside(marked.where("likely"), found, "left")
    none = F.lit(None).cast("array<int>")
    far = marked.where("not likely").withColumns({"starts": none, "ends": none})
    return P.cut_bytes(near.unionByName(far))
