"""Near duplicates by 64-bit SimHash over word shingles and pigeonhole blocks."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docketeer.llm import arrays as A
from docketeer.llm.components import components
from docketeer.session import settled

SEED = 42
# A block key that more fingerprints share is worked through by flipped bits, not by pairs.
PAIRS_UP_TO = 32

_LANES = np.array(
    [sum(((byte >> bit) & 1) << (8 * bit) for bit in range(8)) for byte in range(256)], np.uint64
)


def _majorities(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The bits set in over half the hashes of each text; no hashes give zero."""
    octets = hashes.astype("<u8").view(np.uint8).reshape(-1, 8)
    n = np.diff(bounds)
    out = np.zeros((len(n), 64), bool)
    # Eight counters of a byte each fit a number, so runs of 255 hashes are added at once.
    per_text = -(-n // 255)
    run_text = np.repeat(np.arange(len(n)), per_text)
    first_run = np.concatenate([[0], np.cumsum(per_text)])
    starts = bounds[run_text] + 255 * (np.arange(len(run_text)) - first_run[run_text])
    if not len(starts):
        return np.zeros(len(n), np.uint64)
    full = np.flatnonzero(n)
    for k in range(8):
        runs = np.add.reduceat(_LANES[octets[:, k]], starts)
        counters = runs.astype("<u8").view(np.uint8).reshape(-1, 8).astype(np.int64)
        out[full, 8 * k : 8 * k + 8] = np.add.reduceat(counters, first_run[full]) * 2 > n[full, None]
    return np.packbits(out, axis=1, bitorder="little").view("<u8").ravel()


def _shingle_hashes(text: str | None, size: int) -> list[int]:
    data = (text or "").encode().translate(_LOWER)
    words = data.split()
    if not words:
        return []
    data, ends = b" ".join(words), []
    at = -1
    for w in words:
        at += len(w) + 1
        ends.append(at)
    digest, seed = xxhash.xxh64_intdigest, SEED
    if len(words) <= size:
        return [digest(data, seed)]
    starts = [0] + [e + 1 for e in ends[:-size]]
    return [digest(data[s:e], seed) for s, e in zip(starts, ends[size - 1 :], strict=True)]


_LOWER = bytes(A.lowered(np.arange(256, dtype=np.uint8)))


def fingerprints(df: DataFrame, key: str = "doc_id", text: str = "text", size: int = 3) -> DataFrame:
    """(key, fingerprint): a signed long with the SimHash bits of each text.

    Words are lower-cased in A-Z and parted by ASCII white space. Each of the shingles of
    ``size`` words, repeats included, counts by its XXH64; a shorter text is one shingle, and a
    null or wordless one has fingerprint zero.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, texts = batch.columns
            parts = []
            for first in range(0, len(texts), 256):
                each = [_shingle_hashes(t, size) for t in texts.slice(first, 256).to_pylist()]
                bounds = np.cumsum([0] + [len(e) for e in each])
                joined = np.fromiter((h for e in each for h in e), np.uint64, bounds[-1])
                parts.append(_majorities(joined, bounds).view(np.int64))
            found = np.concatenate(parts) if parts else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([keys, pa.array(found)], ["key", "fingerprint"])

    rows = df.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))
    kind = rows.schema["key"].dataType.simpleString()
    return rows.mapInArrow(run, f"key {kind}, fingerprint long")


def _masks(distance: int, blocks: int) -> list[int]:
    """Masks over all but ``distance`` of the blocks: a close pair agrees under one of them."""
    edges = [64 * i // blocks for i in range(blocks + 1)]
    block = [((1 << (hi - lo)) - 1) << lo for lo, hi in zip(edges, edges[1:], strict=False)]
    return [sum(kept) for kept in combinations(block, blocks - distance)]


def _signed(number: int) -> int:
    return number - (1 << 64) if number >= 1 << 63 else number


def close_pairs(prints: DataFrame, distance: int = 2, blocks: int = 5) -> DataFrame:
    """(a, b): links between distinct fingerprints of a column ``f`` at ``distance`` bits or fewer.

    Every such pair agrees in all but ``distance`` of the blocks, so it shares one of the keys
    that leave out ``distance`` blocks. Fingerprints that share a key are paired and verified.
    Where more than PAIRS_UP_TO do, each is instead listed under itself and under every change
    of up to distance / 2 of the bits left out, and all of one list are linked to its smallest:
    two fingerprints meet on a list if and only if they are close, so no link between components
    is lost, and a key with n fingerprints costs n rows a change. ``distance`` must be even.
    """
    if distance % 2:
        raise ValueError("an odd distance has no list whose members are all close")
    masks = _masks(distance, blocks)
    keys = F.array(*(F.struct(F.lit(i).alias("t"), F.col("f").bitwiseAND(F.lit(_signed(m))).alias("k")) for i, m in enumerate(masks)))
    keyed = prints.select("f", F.explode(keys).alias("x")).select("f", "x.t", "x.k")
    shared = keyed.groupBy("t", "k").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    keyed = settled(keyed.join(shared, ["t", "k"]), "blocks")

    few = keyed.where(F.col("n") <= PAIRS_UP_TO)
    lists = few.groupBy("t", "k").agg(F.array_sort(F.collect_list("f")).alias("fs"))
    lists = lists.select(F.explode("fs").alias("a"), "fs")
    pairs = lists.select("a", F.explode(F.filter("fs", lambda b: (b > F.col("a")) & _close(F.col("a"), b, distance))).alias("b"))

    many = keyed.where(F.col("n") > PAIRS_UP_TO)
    listed = many.select("f", "t", F.explode(_changed(masks, distance // 2)).alias("v"))
    least = listed.groupBy("t", "v").agg(F.min("f").alias("a"))
    met = listed.join(least, ["t", "v"]).where("a != f").select("a", F.col("f").alias("b"))
    return pairs.unionByName(met.where(_close(F.col("a"), F.col("b"), distance))).distinct()


def _close(a: Column, b: Column, distance: int) -> Column:
    return F.bit_count(a.bitwiseXOR(b)) <= distance


def _changed(masks: list[int], flips: int) -> Column:
    """All values that differ from ``f`` in up to ``flips`` of the bits that table ``t`` leaves out."""
    out = F.lit(None)
    for i, mask in reversed(list(enumerate(masks))):
        free = [1 << b for b in range(64) if not mask >> b & 1]
        flipped = [sum(c) for r in range(flips + 1) for c in combinations(free, r)]
        each = F.transform(F.array(*(F.lit(_signed(x)) for x in flipped)), lambda x: F.col("f").bitwiseXOR(x))
        out = F.when(F.col("t") == i, each).otherwise(out)
    return out


def near_duplicates(
    df: DataFrame, key: str = "doc_id", text: str = "text", size: int = 3, distance: int = 2
) -> DataFrame:
    """(key, fingerprint, component): ``component`` is the smallest key that close links lead to.

    Texts of one fingerprint are one class from the start, so copies are never paired: classes
    carry their smallest key. A row whose key is null joins its class and gets the class's
    smallest other key, null where there is none. Repeated rows are each kept; an empty table
    gives an empty one; other columns are not looked at.
    """
    docs = settled(fingerprints(df, key, text, size), "fingerprints")
    classes = docs.groupBy(F.col("fingerprint").alias("f")).agg(F.min("key").alias("least"))
    classes = settled(classes, "classes")
    links = close_pairs(classes.select("f"), distance)
    roots = components(links)
    classes = classes.join(roots.withColumnRenamed("node", "f"), "f", "left")
    classes = classes.withColumn("root", F.coalesce("root", "f"))
    least = classes.groupBy("root").agg(F.min("least").alias("component"))
    named = classes.join(least, "root").select(F.col("f").alias("fingerprint"), "component")
    return docs.join(named, "fingerprint").select("key", "fingerprint", "component")


def keep_one(
    df: DataFrame, key: str = "doc_id", text: str = "text", size: int = 3, distance: int = 2
) -> DataFrame:
    """The rows of ``df`` without near duplicates: one row of each component stays.

    It is the row with the smallest key that is not null; of rows with that key, one of the text
    with the smallest hash, and of repeated rows any one, as they are alike in key and text.
    Columns of any name may be there; an empty table gives an empty one.
    """
    said = F.xxhash64(F.coalesce(F.col(f"`{text}`"), F.lit("")))
    named = F.struct(F.col(f"`{key}`").isNull().alias("n"), F.col(f"`{key}`").alias("k"), said.alias("t"))
    found = near_duplicates(df.select(named.alias("key"), F.col(f"`{text}`").alias("text")), "key", "text", size, distance)
    kept = found.where(F.col("key") == F.col("component")).select("key.*").distinct()
    kept = kept.select("n", F.coalesce(F.col("k").cast("string"), F.lit("")).alias("k"), "t")
    whole = F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias("row")
    rows = df.select(
        whole,
        F.col(f"`{key}`").isNull().alias("n"),
        F.coalesce(F.col(f"`{key}`").cast("string"), F.lit("")).alias("k"),
        said.alias("t"),
    ).join(kept, ["n", "k", "t"], "left_semi")
    content = F.xxhash64(*(F.col(f"row.`{c}`") for c in df.columns))
    numbered = rows.withColumn("i", F.row_number().over(Window.partitionBy("n", "k", "t").orderBy(content)))
    return numbered.where("i = 1").select("row.*")
