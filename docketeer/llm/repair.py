"""Repairing the order of turns in conversations, by weighted interval parsing.

A repaired conversation is empty, or an opening system turn that may be missing and then pairs of a
user and an assistant turn: ``(s?(ua)+)?`` over the initials of the roles. Rows are kept, given
another role, or deleted, and empty turns are inserted, at a cost each.

The grammar is in Chomsky normal form. A nonterminal ``pq`` stands for rows that lead from state
``p`` of the pattern to state ``q``; a span is derived by ``pr -> pq qr`` from its two parts, a
single row by the edits it may have, and the empty span by insertions alone, under which every
cell is closed. A cell holds the least (cost, audit). As every derivation of a span is in one state
at each place where the span may be split, any one split gives the whole cell (CYK tries them all
for grammars where that is not so), and spans are combined bottom-up by doubled length.

What a conversation is repaired to depends on one sign for each row, so conversations alike in
these are parsed once in a worker.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docketeer.llm import arrays as A
from docketeer.session import settled

RENAME, DELETE, INSERT, CUT_SHORT = 3, 4, 3, 3
# States: nothing yet, behind the system turn, behind a user turn, behind an assistant turn.
STATES, FINAL = 4, (0, 3)
STEPS = {"s": ((0, 1),), "u": ((0, 2), (1, 2), (3, 2)), "a": ((2, 3),)}
ROLES = {"u": "user", "a": "assistant"}
LEGAL = ("su", "ua", "au")
WHITE = " \t\n\v\f\r"
# Rows of one piece of a conversation that goes to several tasks, and pieces that are combined at once.
PIECE, FAN = 4096, 64
# Signs of conversations whose parse a worker keeps.
KEPT_PARSES = 1 << 16

Cells = dict[tuple[int, int], tuple[int, str]]


def combine(left: Cells, right: Cells) -> Cells:
    """The cells of a span from those of its two parts."""
    out: Cells = {}
    for (p, q), (cost, audit) in left.items():
        for r in range(STATES):
            other = right.get((q, r))
            if other is not None:
                found = (cost + other[0], audit + other[1])
                if (p, r) not in out or found < out[p, r]:
                    out[p, r] = found
    return out


def inserted() -> Cells:
    """The cells of the empty span: what insertions alone lead to."""
    step: Cells = {(p, p): (0, "") for p in range(STATES)}
    for role in ROLES:
        step.update({pq: (INSERT, "I") for pq in STEPS[role]})
    # Two insertions lead from any state to all that insertions lead to.
    return combine(step, step)


def row_cells(sign: str) -> Cells:
    """The cells of one row: ``d`` must go; else its initial, ``x`` for another, in capitals if cut short."""
    out: Cells = {(p, p): (DELETE, "D") for p in range(STATES)}
    if sign != "d":
        extra = CUT_SHORT * sign.isupper()
        for role in ROLES:
            out.update({pq: (RENAME + extra, "R") for pq in STEPS[role]})
        out.update({pq: (extra, "K") for pq in STEPS.get(sign.lower(), ())})
    return combine(combine(inserted(), out), inserted())


CELLS = {sign: row_cells(sign) for sign in "dsuaxSUAX"}


def parse(spans: list[Cells]) -> Cells:
    """The cells of a whole span, from its parts in order, combined two by two."""
    while len(spans) > 1:
        pairs = [combine(*spans[i : i + 2]) for i in range(0, len(spans) - 1, 2)]
        spans = pairs + spans[len(pairs) * 2 :]
    return spans[0]


def cheapest(cells: Cells) -> tuple[int, str]:
    return min(cells[0, q] for q in FINAL if (0, q) in cells)


def cheapest_edits(signs: str) -> tuple[int, str]:
    """Least cost and, of the audits that have it, the least; from the signs of the rows."""
    if not signs:
        return 0, ""
    kept = A.held("parses")
    found = kept.get(signs)
    if found is None:
        found = cheapest(parse([CELLS[s] for s in signs]))
        if len(kept) > KEPT_PARSES:
            kept.clear()
        if len(signs) <= 64:
            kept[signs] = found
    return found


def repaired(audit: str, rows: Iterator[tuple[str, str]]) -> Iterator[tuple[str, str]]:
    """(role, text) of the turns that the edits make of the rows."""
    at = -((len(audit) - audit.count("D")) % 2)
    for edit in audit:
        role, text = ("", "") if edit == "I" else next(rows)
        if edit == "D":
            continue
        if edit != "K":
            role = ROLES["ua"[at % 2]]
        yield role, text
        at += 1


def damage(df: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(id, turn, role, text, copies): rows with faults by a hash of id and turn, as the contract has them.

    Null roles and texts, and null ids and turns in the hash, are one space. ``copies`` is 0 for a
    row that is dropped, 2 for one that is repeated.
    """
    said = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(" "))
    fault = F.crc32(F.concat(said(key), F.lit(":"), said(turn))) % 20
    texts = F.when(fault == 1, "").when(fault == 2, F.translate(said(text), ".!?", "")).otherwise(said(text))
    return df.select(
        F.col(f"`{key}`").alias("id"),
        F.col(f"`{turn}`").alias("turn"),
        F.when(fault == 4, "user").otherwise(said(role)).alias("role"),
        texts.alias("text"),
        F.when(fault == 0, 0).when(fault == 3, 2).otherwise(1).alias("copies"),
    )


def _sign(role: str, text: str, seen: bool) -> tuple[str, str]:
    """The row's sign for the parse, and its first fault: b, d, t or none."""
    held = text.rstrip(WHITE)
    if not held:
        return "d", "b"
    if seen:
        return "d", "d"
    initial = role[:1] if role[:1] in STEPS else "x"
    return (initial, "") if held[-1] in ".!?" else (initial.upper(), "t")


RESULT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def _report(rows: list[tuple[int | None, str, str]]) -> tuple:
    """What RESULT names, from (turn, role, text) in order."""
    signs, faults, seen = [], [], set()
    for _, role, text in rows:
        sign, fault = _sign(role, text, (role, text) in seen)
        seen.add((role, text))
        signs.append(sign)
        faults.append(fault)
    initials = [r[1][:1] for r in rows]
    illegal = sum(a + b not in LEGAL for a, b in zip(initials, initials[1:], strict=False))
    turns = {r[0] for r in rows if r[0] is not None}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    cost, audit = cheapest_edits("".join(signs))
    said = "\n".join(f"{r}:{t}" for r, t in repaired(audit, ((r[1], r[2]) for r in rows)))
    digest = hashlib.sha256(said.encode()).hexdigest()
    return gaps, *(faults.count(f) for f in "bdt"), illegal, cost, audit, digest


def _in_order(rows: DataFrame, *first: str) -> list[Column]:
    return [*map(F.col, first), F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]


def _batches(out: Iterator[tuple], ddl: pa.Schema) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in out:
        held.append(row)
        if len(held) == 4096:
            yield pa.RecordBatch.from_pylist([dict(zip(ddl.names, r, strict=True)) for r in held], ddl)
            held = []
    if held:
        yield pa.RecordBatch.from_pylist([dict(zip(ddl.names, r, strict=True)) for r in held], ddl)


def _streamed(rows: DataFrame, make: Callable[[Iterator[tuple]], Iterator[tuple]], ddl: str) -> DataFrame:
    """One pass over rows that are in order, as tuples."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    kinds = to_arrow_schema(StructType.fromDDL(ddl))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def each() -> Iterator[tuple]:
            for batch in batches:
                yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)

        yield from _batches(make(each()), kinds)

    return rows.mapInArrow(run, ddl)


def _gathered(rows: DataFrame) -> DataFrame:
    """The report of conversations that one task can hold, in one pass over sorted rows."""

    def make(each: Iterator[tuple]) -> Iterator[tuple]:
        held: list[tuple] = []
        last: Any = None
        some = False
        for key, turn, role, text, copies in each:
            if some and key != last:
                yield last, *_report(held)
                held = []
            some, last = True, key
            held += [(turn, role, text)] * copies
        if some:
            yield last, *_report(held)

    kind = rows.schema["id"].dataType.simpleString()
    # The text of a dropped row is not moved.
    moved = rows.withColumn("text", F.when(F.col("copies") > 0, F.col("text")))
    sorted_rows = moved.repartition("id").sortWithinPartitions(*_in_order(moved, "id"))
    return _streamed(sorted_rows, make, f"id {kind}, {RESULT}")


def _pieced(rows: DataFrame) -> DataFrame:
    """The same for conversations with more rows than a task should get.

    Their rows are range partitioned in order and numbered; every piece of PIECE rows gives its
    cells, counts and outer roles, and the pieces are combined FAN at a time. Only the hash, which
    cannot be made of parts, takes a conversation's rows through one task, row by row.
    """
    kind = rows.schema["id"].dataType.simpleString()
    ids = rows.select("id").distinct()
    copied = rows.where("copies > 0").withColumn("copies", F.explode(F.sequence(F.lit(1), "copies")))
    ranged = copied.repartitionByRange(*_in_order(copied, "id")).sortWithinPartitions(*_in_order(copied, "id"))
    ranged = settled(ranged.withColumn("at", F.monotonically_increasing_id()), "turns")
    firsts = ranged.groupBy("id", "role", "text").agg(F.min("at").alias("at")).select("at", F.lit(True).alias("first"))
    held = F.rtrim(F.translate("text", "\t\n\x0b\x0c\r", "     "))
    initial = F.substring("role", 1, 1)
    known = F.when(initial.isin(*STEPS), initial).otherwise("x")
    fault = F.when(held == "", "b").when(F.col("first").isNull(), "d").when(~F.right(held, F.lit(1)).isin(".", "!", "?"), "t").otherwise("")
    sign = F.when(F.col("fault").isin("b", "d"), "d").when(F.col("fault") == "t", F.upper(known)).otherwise(known)
    signed = ranged.join(firsts, "at", "left").withColumn("fault", fault)
    signed = signed.select("id", "turn", "at", "fault", sign.alias("sign"), initial.alias("initial"))
    signed = settled(signed, "signs")
    counted = signed.groupBy("id").agg(*(F.count_if(F.col("fault") == f).alias(n) for f, n in zip("bdt", ("blank", "duplicate", "truncated"), strict=True)))
    turns = signed.where("turn is not null").select("id", "turn").distinct().groupBy("id")
    gaps = turns.agg((F.max("turn") - F.min("turn") + 1 - F.count("turn")).alias("gaps"))
    pieces = signed.groupBy("id", F.expr(f"at div {PIECE}").alias("piece")).agg(
        F.array_sort(F.collect_list(F.struct("at", "sign", "initial"))).alias("rows")
    )
    pieces = pieces.select(
        "id", "piece", F.array_join("rows.sign", "").alias("signs"), F.col("rows.initial").alias("initials")
    )

    def leaves(each: Iterator[tuple]) -> Iterator[tuple]:
        for key, piece, signs, initials in each:
            illegal = sum(a + b not in LEGAL for a, b in zip(initials, initials[1:], strict=False))
            cells = parse([CELLS[s] for s in signs])
            yield key, piece, initials[0], initials[-1], illegal, *_flat(cells)

    def joined(each: Iterator[tuple]) -> Iterator[tuple]:
        for key, group, parts in each:
            parts = [tuple(p.values()) for p in parts]
            illegal = sum(p[3] for p in parts)
            illegal += sum(a[2] + b[1] not in LEGAL for a, b in zip(parts, parts[1:], strict=False))
            cells = parse([_cells(p[4], p[5], p[6]) for p in parts])
            yield key, group, parts[0][1], parts[-1][2], illegal, *_flat(cells)

    ddl = f"id {kind}, piece long, head string, tail string, illegal long, states array<int>, costs array<long>, audits array<string>"
    spans = _streamed(pieces, leaves, ddl)
    in_order = Window.partitionBy("id").orderBy("piece")
    spans = settled(spans.withColumn("piece", (F.row_number().over(in_order) - 1).cast("long")), "spans")
    # Once for each power of FAN in the largest number of pieces.
    most = spans.agg(F.max("piece")).first()[0] or 0
    while most:
        grouped = spans.groupBy("id", F.expr(f"piece div {FAN}").alias("group")).agg(
            F.array_sort(F.collect_list(F.struct(*spans.columns[1:]))).alias("parts")
        )
        spans = settled(_streamed(grouped, joined, ddl), "spans")
        most //= FAN

    def chosen(each: Iterator[tuple]) -> Iterator[tuple]:
        for key, illegal, *cells in each:
            yield key, illegal, *cheapest(_cells(*cells))

    parsed = _streamed(spans.select("id", "illegal", "states", "costs", "audits"), chosen, f"id {kind}, illegal long, cost long, audit string")
    parsed = settled(parsed, "parsed")
    digests = _digests(copied, parsed)
    out = ids
    for other in (gaps, counted, parsed, digests):
        out = _beside(out, other)
    zero = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return out.select(
        "id", *zero, F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )


def _flat(cells: Cells) -> tuple[list[int], list[int], list[str]]:
    return [p * STATES + q for p, q in cells], [c[0] for c in cells.values()], [c[1] for c in cells.values()]


def _cells(states: list[int], costs: list[int], audits: list[str]) -> Cells:
    return {divmod(s, STATES): (c, a) for s, c, a in zip(states, costs, audits, strict=True)}


def _beside(rows: DataFrame, other: DataFrame) -> DataFrame:
    other = other.withColumnRenamed("id", "_id")
    return rows.join(other, rows["id"].eqNullSafe(other["_id"]), "left").drop("_id")


def _replayed(rows: DataFrame, parsed: DataFrame, make: Callable, ddl: str) -> DataFrame:
    """``make`` of (id, audit, its rows in order) for each conversation, its rows read one by one."""
    kind = rows.schema["id"].dataType.simpleString()

    def run(each: Iterator[tuple]) -> Iterator[tuple]:
        ahead = next(each, None)
        while ahead is not None:
            key, _, _, _, audit = ahead

            def own(key: Any = key) -> Iterator[tuple[str, str]]:
                nonlocal ahead
                while ahead is not None and ahead[0] == key:
                    yield ahead[2], ahead[3]
                    ahead = next(each, None)

            ahead = next(each, None)
            left = own()
            yield from make(key, audit or "", left)
            for _ in left:
                pass

    audits = parsed.select("id", F.lit(None).cast(rows.schema["turn"].dataType).alias("turn"), F.lit(None).cast("string").alias("role"), F.lit(None).cast("string").alias("text"), "audit")
    both = audits.withColumn("_k", F.lit(0)).unionByName(
        rows.select("id", "turn", "role", "text", F.lit(None).cast("string").alias("audit"), F.lit(1).alias("_k"))
    )
    ordered = both.repartition("id").sortWithinPartitions(*_in_order(both, "id", "_k")).drop("_k")
    return _streamed(ordered, run, f"id {kind}, {ddl}")


def _digests(rows: DataFrame, parsed: DataFrame) -> DataFrame:
    def make(key: Any, audit: str, own: Iterator[tuple[str, str]]) -> Iterator[tuple]:
        digest, some = hashlib.sha256(), False
        for role, text in repaired(audit, own):
            digest.update((("\n" if some else "") + f"{role}:{text}").encode())
            some = True
        yield key, digest.hexdigest()

    return _replayed(rows, parsed, make, "repaired_sha256 string")


def repaired_turns(rows: DataFrame, found: DataFrame) -> DataFrame:
    """(id, position, role, text): the turns of the repaired conversations, from 0 on."""

    def make(key: Any, audit: str, own: Iterator[tuple[str, str]]) -> Iterator[tuple]:
        for i, (role, text) in enumerate(repaired(audit, own)):
            yield key, i, role, text

    copied = rows.where("copies > 0").withColumn("copies", F.explode(F.sequence(F.lit(1), "copies")))
    return _replayed(copied, found, make, "position long, role string, text string")


def repairs(rows: DataFrame, most: int | None = None) -> DataFrame:
    """(id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256) of each conversation.

    ``rows`` are (id, turn, role, text, copies) as :func:`damage` gives them, without null roles and
    texts. Rows of a conversation go by turn, nulls first, then role and text; a row stands
    ``copies`` times in a row. A null id is a conversation like any other; one whose rows have all
    no copies has zeros, no audit and the hash of the empty text; an empty table gives an empty
    one. Each row goes over the network once; conversations with over ``most`` rows, by default as
    many as :mod:`docketeer.operators.joins` leaves in one task, are pieced instead.
    """
    from docketeer.operators.joins import hot_keys

    counts = rows.groupBy("id").agg(F.sum(F.greatest("copies", F.lit(1))).alias("n"))
    if most is None:
        hot = hot_keys(counts, ["id"], "n")
    else:
        hot = counts.where(F.col("n") > most)
    hot = settled(hot.select("id"), "hot")
    if hot.isEmpty():
        return _gathered(rows)
    mark = F.broadcast(hot.select(F.col("id").alias("_id")))
    same = rows["id"].eqNullSafe(mark["_id"])
    cold = _gathered(rows.join(mark, same, "left_anti"))
    return cold.unionByName(_pieced(rows.join(mark, same, "left_semi")))
