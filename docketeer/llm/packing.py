"""Packing tokenized documents into sequences, large ones matched in pairs, small ones best-fit.

Pieces of one length are interchangeable, so the packing is decided on the number of pieces of
each length: a table with as many rows as a sequence has places, whatever the corpus. Its result
is a list of orders such as "the pieces 500 to 899 of length 700 go two by two to the sequences
from 40 on, behind place 2,600". Every piece then finds its order by its number among those of
its length.

* Pieces above a third of a sequence: two at most share one. From the longest on, each is matched
  with the longest other that fits beside it, which is as good as any matching can be.
* Smaller pieces, from the longest on, go where the least room is left that holds them; a new
  sequence is begun where none has.
"""

from __future__ import annotations

import bisect
import json
import re
import zlib
from collections import defaultdict
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer, normalizers, pre_tokenizers

from docketeer.llm import arrays as A
from docketeer.session import settled

CAPACITY, END_ID = 4096, 1
# Chunks of text between white space whose ids a worker keeps, and the longest of them in bytes.
KEPT_CHUNKS, LONGEST_CHUNK = 1 << 19, 64
# What a tokenizer must say of itself for its texts to be taken in chunks: fixed values of its file.
NORMALIZER = {
    "type": "Sequence",
    "normalizers": [
        {"type": "NFC"},
        {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "},
        {"type": "Lowercase"},
    ],
}
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
PRE_TOKENIZER = {
    "type": "Sequence",
    "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": WORDS}, "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
    ],
}
# A word of letters that have no other form than a small and a large one, and the signs behind it.
PLAIN = re.compile(r"([a-zß-öø-ÿÀ-ÖØ-Þ]+)([.,;:!?#$%&*|<>()]*)")


def _bytes_of(chosen: str) -> np.ndarray:
    table = np.zeros(256, bool)
    table[[b for b in range(33, 127) if re.match(chosen, chr(b))]] = True
    return table


LETTERS, SIGNS = _bytes_of("[a-z]"), _bytes_of("[^a-zA-Z0-9']")
# Pieces of one length that are numbered in one task.
NUMBERED = 100_000


class Order(NamedTuple):
    """Pieces ``first`` to ``first + n - 1`` of ``length`` go ``each`` to a sequence, from ``offset`` on."""

    length: int
    first: int
    n: int
    sequence: int
    each: int
    offset: int


class Chunks:
    """The ids of chunks between white space, as little-endian numbers of 32 bits.

    For a tokenizer that lowers all letters, drops white space and never looks across it, and that
    parts letters from the signs behind them: a chunk's ids are then those of its word and of its
    tail of signs, wherever it stands. Words of plain letters are taken as they are, without the
    steps that would leave them so. Chunks seen lately are kept.
    """

    def __init__(self, path: str) -> None:
        self.known: dict[bytes, bytes] = {}
        self.tokenizer = Tokenizer.from_file(path)
        spec = json.loads(self.tokenizer.to_str())
        self.chunked = (spec["normalizer"], spec["pre_tokenizer"]) == (NORMALIZER, PRE_TOKENIZER)
        self.marks = [t.content.lower().encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        # The ids that end a word.
        suffix = spec["model"].get("end_of_word_suffix") or ""
        self.last = np.array([t.endswith(suffix) for t, _ in sorted(self.tokenizer.get_vocab().items(), key=lambda x: x[1])])
        self.plain = Tokenizer.from_file(path)
        self.plain.normalizer = normalizers.Sequence([])
        self.plain.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
        )

    def marked(self, text: bytes) -> bool:
        """Whether a token may stand in the text that the tokenizer takes by its letters as they are."""
        low = text.lower().replace(b" ", b"")
        return any(m in low for m in self.marks)

    def learn(self, chunks: set[bytes]) -> None:
        """Make sure that all these chunks are here."""
        known = self.known
        if len(known) > KEPT_CHUNKS:
            known.clear()
        missing = chunks.difference(known)
        # Added tokens are of signs and letters, so no word of plain letters has one.
        words = {c for c in missing if c.isalpha()}
        split, others = [], set()
        for chunk in missing - words:
            found = PLAIN.fullmatch(chunk.decode())
            if found is None:
                others.add(chunk)
                continue
            word, tail = found[1].lower().encode(), found[2].encode()
            if word != chunk:
                split.append((chunk, word, tail))
            if word not in known:
                words.add(word)
            if tail not in known:
                others.add(tail)
        self._encode(self.plain, list(words))
        self._encode(self.tokenizer, list(others))
        known.update((chunk, known[word] + known[tail]) for chunk, word, tail in split)

    def _encode(self, tokenizer: Tokenizer, chunks: list[bytes]) -> None:
        for at in range(0, len(chunks), 1024):
            some = chunks[at : at + 1024]
            if tokenizer is self.plain:
                (found,) = tokenizer.encode_batch_fast([b" ".join(some).decode()], add_special_tokens=False)
                ids = np.array(found.ids, "<u4")
                ends = np.flatnonzero(self.last[ids]) + 1
            else:
                found = tokenizer.encode([c.decode() for c in some], is_pretokenized=True, add_special_tokens=False)
                ids = np.array(found.ids, "<u4")
                # A sign that the tokenizer drops leaves a chunk without ids.
                ends = np.cumsum(np.bincount(np.array(found.word_ids, int), minlength=len(some)))
            ends, held = (4 * ends).tolist(), ids.tobytes()
            self.known.update((c, held[b:e]) for c, b, e in zip(some, [0, *ends[:-1]], ends, strict=True))

    def forget_long(self, chunks: set[bytes]) -> None:
        for chunk in chunks:
            if len(chunk) > LONGEST_CHUNK:
                self.known.pop(chunk, None)
                found = PLAIN.fullmatch(chunk.decode())
                if found is not None:
                    self.known.pop(found[1].lower().encode(), None)
                    self.known.pop(found[2].encode(), None)


def parted(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of texts with A-Z lowered and a blank between an ASCII letter and a sign, and their starts."""
    low = A.lowered(data)
    cuts = np.flatnonzero(LETTERS[low[:-1]] & SIGNS[low[1:]]) + 1
    return np.insert(low, cuts, 32), offsets + np.searchsorted(cuts, offsets)


def token_ids(data: np.ndarray, offsets: np.ndarray, path: str, end: int = END_ID) -> list[bytes]:
    """The ids of each text and the end id, as little-endian numbers of 32 bits."""
    held = A.held("tokenizers")
    if path not in held:
        held[path] = Chunks(path)
    ids = held[path]
    last = np.array([end], "<u4").tobytes()
    low, starts = parted(data, offsets)
    said = low.tobytes()
    chunks: list[list[bytes]] = [said[a:b].split() for a, b in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True)]
    whole = {}
    if not ids.chunked or ids.marked(said):
        for i in range(len(chunks)):
            text = data[offsets[i] : offsets[i + 1]].tobytes()
            if not ids.chunked or ids.marked(text):
                whole[i] = text.decode()
                chunks[i] = []
    seen = set().union(*chunks)
    ids.learn(seen)
    out = [b"".join([*map(ids.known.__getitem__, text), last]) for text in chunks]
    for i, found in zip(whole, ids.tokenizer.encode_batch(list(whole.values()), add_special_tokens=False), strict=True):
        out[i] = np.array(found.ids, "<u4").tobytes() + last
    ids.forget_long(seen)
    return out


def pieces(df: DataFrame, key: str, text: str, path: str, capacity: int, end: int) -> DataFrame:
    """(id, piece, start, length, ids_crc32, ids) of every row; only what exceeds ``capacity`` is cut."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offsets in A.pieces(batch, most=4 << 20):
                out: list[tuple] = []
                for row, ids in enumerate(token_ids(data, offsets, path, end)):
                    for number, at in enumerate(range(0, len(ids), 4 * capacity)):
                        held = ids[at : at + 4 * capacity]
                        out.append((row, number, at // 4, len(held) // 4, zlib.crc32(held), held))
                columns = list(zip(*out, strict=True)) or [()] * 6
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
                made = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
                yield pa.RecordBatch.from_arrays([part.column(0).take(made[0]), *made[1:]], NAMES)

    rows = df.select(F.col(f"`{key}`").alias("id"), F.col(f"`{text}`").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, piece int, start long, length long, ids_crc32 long, ids binary")


NAMES = ["id", "piece", "start", "length", "ids_crc32", "ids"]


def pack_counts(counts: dict[int, int], capacity: int = CAPACITY) -> list[Order]:
    """The orders for so many pieces of each length.

    Every order empties a length or fills a whole run of alike sequences. There are at most three
    runs for each length, and filling one leaves less than half of its room, so the orders are at
    most 3 x capacity x log2(capacity).
    """
    left = {length: n for length, n in counts.items() if n}
    taken: dict[int, int] = defaultdict(int)
    orders: list[Order] = []
    rooms: dict[int, list[tuple[int, int]]] = defaultdict(list)
    begun = 0

    def put(length: int, n: int, sequence: int, each: int, offset: int) -> None:
        orders.append(Order(length, taken[length], n, sequence, each, offset))
        taken[length] += n
        left[length] -= n

    def leave(room: int, sequence: int, n: int) -> None:
        if room and n:
            rooms[room].append((sequence, n))

    large = sorted(k for k in left if 3 * k > capacity)
    for length in reversed(large):
        while left[length]:
            at = bisect.bisect_right(large, min(length, capacity - length)) - 1
            while at >= 0 and not left[large[at]]:
                large.pop(at)
                at -= 1
            n, other = left[length], large[at] if at >= 0 else 0
            if other == length:
                if n > 1:
                    put(length, n // 2 * 2, begun, 2, 0)
                    leave(capacity - 2 * length, begun, n // 2)
                    begun += n // 2
                    continue
                # The single one left over may still have a shorter partner.
                shorter = [k for k in large[:at] if left[k]]
                other = shorter[-1] if shorter else 0
            if other:
                n = min(n, left[other])
                put(other, n, begun, 1, length)
            put(length, n, begun, 1, 0)
            leave(capacity - length - other, begun, n)
            begun += n
    sizes = sorted(k for k in rooms if rooms[k])
    for length in sorted((k for k in left if 3 * k <= capacity), reverse=True):
        while left[length]:
            at = bisect.bisect_left(sizes, length)
            if at < len(sizes):
                room = sizes[at]
                sequence, n = rooms[room].pop()
                if not rooms[room]:
                    sizes.pop(at)
            else:
                room, sequence, n = capacity, begun, -(-left[length] // (capacity // length))
                begun += n
            each = room // length
            whole = min(n, left[length] // each)
            rest = min(each, left[length] - whole * each) if whole < n else 0
            new = []
            if whole:
                put(length, whole * each, sequence, each, capacity - room)
                new.append((room - each * length, sequence, whole))
            if rest:
                put(length, rest, sequence + whole, rest, capacity - room)
                new.append((room - rest * length, sequence + whole, 1))
            new.append((room, sequence + whole + bool(rest), n - whole - bool(rest)))
            for held, first, many in new:
                if held and many:
                    if not rooms[held]:
                        bisect.insort(sizes, held)
                    rooms[held].append((first, many))
    return orders


def numbered(rows: DataFrame, by: str, name: str, most: int = NUMBERED) -> DataFrame:
    """Number the rows of each value of ``by`` from 0 on; ``row`` tells all rows apart.

    A value with over ``most`` rows goes to several tasks, by a hash of ``row``, whose rows are
    numbered behind those of the tasks before.
    """
    parts = rows.groupBy(by).agg(F.ceil(F.count(F.lit(1)) / most).alias("_parts"))
    salted = rows.join(parts, by).withColumn("_salt", F.pmod(F.xxhash64("row"), F.col("_parts")))
    sizes = salted.groupBy(by, "_salt").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(by).orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select(by, "_salt", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    within = F.row_number().over(Window.partitionBy(by, "_salt").orderBy("row")) - 1
    ranked = salted.withColumn("_rank", within).join(sizes, [by, "_salt"])
    return ranked.withColumn(name, F.col("_rank") + F.col("_before")).drop("_parts", "_salt", "_rank", "_before")


def placed(rows: DataFrame, orders: list[Order]) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to (length, number, ...)."""
    table = np.array(orders or np.zeros((0, 6)), np.int64).reshape(-1, 6)
    table = table[np.lexsort((table[:, 1], table[:, 0]))]
    held = rows.sparkSession.sparkContext.broadcast(table)
    names = rows.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, first, _, sequence, each, offset = held.value.T
        begins = np.searchsorted(own, np.arange(own.max(initial=0) + 2))
        # Numbers of one length follow those of the length before, so one search finds the order.
        shift = np.zeros(len(begins), np.int64)
        np.add.at(shift, own + 1, held.value[:, 2])
        shift = np.cumsum(shift)
        for batch in batches:
            length, number = (batch.column(names.index(c)).to_numpy() for c in ("length", "number"))
            at = np.searchsorted(shift[own] + first, shift[length] + number, side="right") - 1
            k = number - first[at]
            new = [pa.array(sequence[at] + k // each[at]), pa.array(offset[at] + k % each[at] * length)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *new], [*names, "sequence_id", "offset"])

    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    return rows.mapInArrow(run, f"{ddl}, sequence_id long, offset long")


def pack(
    df: DataFrame,
    path: str,
    key: str = "doc_id",
    text: str = "text",
    capacity: int = CAPACITY,
    end: int = END_ID,
    with_ids: bool = False,
) -> DataFrame:
    """(id, piece, start, length, ids_crc32, sequence_id, offset[, ids]) of every piece of every row.

    A null or empty text is the end id alone; a key may be null or repeat, every row is packed by
    itself; an empty table gives an empty one; other columns are not looked at. ``path`` names the
    tokenizer's file, which every executor must have. The pieces are written, with their ids only
    where these are wanted; the texts are tokenized where they are read. One count for each length
    passes the driver, and orders of a size bounded by ``capacity`` are broadcast.
    """
    cut = pieces(df, key, text, path, capacity, end)
    wanted = cut if with_ids else cut.drop("ids")
    rows = settled(wanted.withColumn("row", F.monotonically_increasing_id()), "pieces")
    counts = {r["length"]: r["n"] for r in rows.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    found = placed(numbered(rows.drop("ids"), "length", "number"), pack_counts(counts, capacity)).drop("number")
    if with_ids:
        found = found.join(rows.select("row", "ids"), "row")
    return found.drop("row")


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids, length): the tokens of every sequence, from a packing with its ids."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(parts, F.lit(b""), lambda s, p: F.concat(s, p["ids"]))
    rows = packed.groupBy("sequence_id").agg(joined.alias("ids"))
    return rows.withColumn("length", (F.length("ids") / 4).cast("long"))
