"""Rolling hashes over bytes, and removing covered ranges from texts."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketeer.llm import arrays as A
# Odd multipliers, which have inverses modulo 2^64.
FACTORS = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)


def _power_tables(factor: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    powers = A.held("powers")
    held = powers.get(factor)
    if held is None or len(held[0]) < size:
        size = max(size, 1 << 21)
        tables = []
        for base in (factor, pow(factor, -1, 1 << 64)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            tables.append(np.cumprod(steps, dtype=np.uint64))
        held = powers[factor] = (tables[0], tables[1])
    return held


class Rolling:
    """Hashes of any ranges of a byte array, by sums of byte times power."""

    def __init__(self, data: np.ndarray, factor: int = FACTORS[0]) -> None:
        up, self.down = _power_tables(factor, len(data) + 1)
        self.total = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=self.total[1:])

    def windows(self, size: int) -> np.ndarray:
        """Hashes of all windows of ``size`` bytes."""
        count = max(0, len(self.total) - size)
        return A.mixed((self.total[size:] - self.total[:count]) * self.down[:count])

    def ranges(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return A.mixed((self.total[ends] - self.total[starts]) * self.down[starts])


def with_identity(df: DataFrame, key: str, text: str) -> DataFrame:
    """(id, th, text): the key, and a hash that tells rows of one key apart if their texts differ.

    Rows alike in both are the same text under the same key, so what is found for one of them
    holds for all. A null text becomes empty.
    """
    said = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    return df.select(F.col(f"`{key}`").alias("id"), F.xxhash64(said).alias("th"), said.alias("text"))


def beside(rows: DataFrame, marks: DataFrame, how: str = "inner") -> DataFrame:
    """Join a table on (id, th), null ids included; the columns of ``marks`` without its key."""
    marks = marks.withColumnRenamed("id", "_id").withColumnRenamed("th", "_th")
    on = rows["id"].eqNullSafe(marks["_id"]) & (rows["th"] == marks["_th"])
    return rows.join(marks, on, how).drop("_id", "_th")


def likely(rows: DataFrame, marks: DataFrame) -> DataFrame:
    """Add ``likely``: whether ``marks`` may have the row's (id, th), from a filter of fixed size.

    Rows that it rules out need not be shuffled to meet the marks. However many marks there are,
    the filter that is broadcast has at most FILTER_BITS / 64 rows; it then rules out less.
    """
    # Tasks get this module by value, and need not have the rest of the library.
    from docketeer.operators.joins import filter_bit, filter_word, key_filter

    key = F.xxhash64("id", "th")
    bits = key_filter(marks.select(key.alias("_key")), "_key").toDF("_word", "_bits")
    keyed = rows.withColumn("_key", key).withColumn("_word", filter_word("_key"))
    met = keyed.join(F.broadcast(bits), "_word", "left")
    hit = F.coalesce(F.col("_bits").bitwiseAND(filter_bit("_key")) != 0, F.lit(False))
    return met.withColumn("likely", hit).drop("_key", "_word", "_bits")


def runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every run of set flags."""
    edge = np.diff(np.concatenate([[0], flags.astype(np.int8), [0]]))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def cut_bytes(rows: DataFrame) -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept_sha256, kept) from (id, text, starts, ends).

    The ranges of bytes may overlap; null lists remove nothing. ``kept`` are the other bytes.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.schema.names
            data, offsets = A.flat(batch.column(names.index("text")))
            held = data.tobytes()
            starts, ends = (batch.column(names.index(c)).to_pylist() for c in ("starts", "ends"))
            out: list[tuple] = []
            for i, (s, e) in enumerate(zip(starts, ends, strict=True)):
                text = held[offsets[i] : offsets[i + 1]]
                kept, removed, spans = text, 0, 0
                if s:
                    flags = A.covered(np.array(s), np.array(e), len(text))
                    spans, removed = len(runs(flags)[0]), int(flags.sum())
                    kept = data[offsets[i] : offsets[i + 1]][~flags].tobytes()
                out.append((len(text), removed, spans, hashlib.sha256(kept).hexdigest(), kept))
            columns = list(zip(*out, strict=True)) or [()] * 5
            kinds = [pa.int64()] * 3 + [pa.string(), pa.binary()]
            made = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(names.index("id")), *made], NAMES)

    kind = rows.schema["id"].dataType.simpleString()
    ddl = f"id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"
    return rows.select("id", "text", "starts", "ends").mapInArrow(run, ddl)


NAMES = ["id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
