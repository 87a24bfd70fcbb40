"""Texts as flat byte arrays, and words as numbers, for work inside Arrow batches."""

from __future__ import annotations

import sys
from collections.abc import Iterator
from types import ModuleType

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

# The ASCII white space of the contracts: tab, line feed, vertical tab, form feed, return, blank.
WHITE = tuple(range(9, 14)) + (32,)
PIECE_BYTES = 1 << 20


def held(name: str) -> dict:
    """A dict that lives as long as the Python process, whatever functions come and go by value."""
    module = sys.modules.setdefault("docketeer_held", ModuleType("docketeer_held"))
    return vars(module).setdefault(name, {})


def spaced() -> np.ndarray:
    """Which bytes belong to a word ``[^\\x20\\x09-\\x0D]+``."""
    table = np.ones(256, bool)
    table[list(WHITE)] = False
    return table


def alphanumeric() -> np.ndarray:
    """Which bytes of a lower-cased text belong to ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``."""
    table = np.zeros(256, bool)
    table[0x30:0x3A] = table[0x61:0x7B] = table[0x80:] = True
    return table


SPACED, ALPHANUMERIC = spaced(), alphanumeric()
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def lowered(data: np.ndarray) -> np.ndarray:
    """A-Z in lower case, all other bytes as they are."""
    return _LOWER[data]


# Everything that is no word byte of a lower-cased text, as a blank, for bytes.translate.
CLEAN = bytes(b if ALPHANUMERIC[b] else 32 for b in _LOWER.tolist())


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the start of each text, with the end last; null is empty."""
    column = pa.concat_arrays([column.cast(pa.large_string()).fill_null("")])
    offsets = np.frombuffer(column.buffers()[1], np.int64)[: len(column) + 1]
    held = column.buffers()[2]
    data = np.frombuffer(held, np.uint8) if held is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def pieces(
    batch: pa.RecordBatch, text: str = "text", most: int = PIECE_BYTES
) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of a batch of about ``most`` bytes of whole texts, so that arrays stay in the cache.

    A longer text is a slice by itself; none is cut.
    """
    data, offsets = flat(batch.column(batch.schema.get_field_index(text)))
    first = 0
    while first < batch.num_rows:
        last = int(np.searchsorted(offsets, offsets[first] + most, side="right")) - 1
        last = min(max(last, first + 1), batch.num_rows)
        lo, hi = offsets[first], offsets[last]
        yield batch.slice(first, last - first), data[lo:hi], offsets[first : last + 1] - lo
        first = last


def words(
    data: np.ndarray, offsets: np.ndarray, table: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every word, and for each text the number of its first word, end last."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(offsets), np.int64)
    inside = table[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    # Words do not run on from one text into the next.
    at = offsets[:-1][offsets[:-1] < len(data)]
    begins[at] = inside[at]
    at = at[at > 0] - 1
    ends[at] = inside[at]
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(ends) + 1, np.searchsorted(starts, offsets)


def with_row(df: DataFrame, ddl: str) -> StructType:
    """The column ``row`` of a table, whatever names it holds, and the columns of ``ddl``."""
    return StructType([df.schema["row"], *StructType.fromDDL(ddl).fields])


def mixed(h: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer that spreads every bit (Steele, Lea, Flood 2014)."""
    h = h ^ (h >> np.uint64(30))
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def word_hashes(
    data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0
) -> np.ndarray:
    """64-bit hashes of the words, eight bytes at a time."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.ndarray((len(data) + 1,), "<u8", padded, 0, (1,))
    left = ends - starts
    h = mixed(left.astype(np.uint64) + np.uint64(seed * 0x9E3779B97F4A7C15 & (2**64 - 1)))
    masks = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
    rows, at = slice(None), starts
    while len(at):
        h[rows] = mixed(h[rows] ^ (eight[at] & masks[np.minimum(left, 8)]))
        more = np.flatnonzero(left > 8)
        rows = more if isinstance(rows, slice) else rows[more]
        at, left = at[more] + 8, left[more] - 8
    return h


def window_hashes(h: np.ndarray, size: int, factor: int = 0x9FB21C651E98DF25) -> np.ndarray:
    """Hashes of all runs of ``size`` numbers, also of those that go beyond a text."""
    count = max(0, len(h) - size + 1)
    out = np.zeros(count, np.uint64)
    for j in range(size):
        out *= np.uint64(factor)
        out += h[j : j + count]
    return mixed(out)


def covered(starts: np.ndarray, ends: np.ndarray, size: int) -> np.ndarray:
    """Which of ``size`` positions lie in one of the half-open ranges."""
    steps = np.zeros(size + 1, np.int64)
    np.add.at(steps, starts, 1)
    np.add.at(steps, ends, -1)
    return np.cumsum(steps[:-1]) > 0


def sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sum of the values of each text, ``bounds`` as given by :func:`words`."""
    total = np.zeros((len(values) + 1, *values.shape[1:]), np.float64)
    np.cumsum(values, axis=0, dtype=np.float64, out=total[1:])
    return total[bounds[1:]] - total[bounds[:-1]]


def counts(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Number of set flags of each text."""
    total = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=total[1:])
    return total[bounds[1:]] - total[bounds[:-1]]
