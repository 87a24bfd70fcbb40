"""Conversation repair against a search over all edits, and whole conversations against pieces."""

import hashlib
import heapq
import random
import re

import pytest
from pyspark.sql import functions as F

from docketeer.llm import repair

SIGNS = "dsuaxSUAX"


def search(signs):
    """Least (cost, audit), by trying edits in the order of their cost."""
    heap, done = [(0, "", 0, "")], set()
    while heap:
        cost, audit, i, said = heapq.heappop(heap)
        # Behind a whole pattern only its last letter matters.
        state = said if len(said) < 3 else "_" * (said[-1] == "u") + "=" * (said[-1] == "a")
        if (i, state) in done:
            continue
        done.add((i, state))
        if i == len(signs) and re.fullmatch("(s?(ua)+)?", said):
            return cost, audit
        ways = [(3, "I", 0, "u"), (3, "I", 0, "a")]
        if i < len(signs):
            ways.append((4, "D", 1, ""))
            if signs[i] != "d":
                extra = 3 * signs[i].isupper()
                ways += [(extra, "K", 1, signs[i].lower()), (3 + extra, "R", 1, "u"), (3 + extra, "R", 1, "a")]
        for more, edit, step, role in ways:
            if re.fullmatch("s?(ua)*u?", said + role):
                heapq.heappush(heap, (cost + more, audit + edit, i + step, said + role))
    raise AssertionError(signs)


def test_cheapest_edits():
    chance = random.Random(3)
    signs = ["".join(chance.choices(SIGNS, k=n)) for n in range(8) for _ in range(60)]
    for s in [*signs, *SIGNS, "".join(chance.choices(SIGNS, k=40))]:
        assert repair.cheapest_edits(s) == search(s), s


def test_any_split_gives_the_cells():
    chance = random.Random(4)
    for n in range(2, 9):
        cells = [repair.CELLS[s] for s in chance.choices(SIGNS, k=n)]
        whole = repair.parse(cells)
        for k in range(1, n):
            assert repair.combine(repair.parse(cells[:k]), repair.parse(cells[k:])) == whole


def test_long_conversation():
    cost, audit = repair.cheapest_edits("ua" * 50_000 + "d")
    assert cost == 4 and audit == "K" * 100_000 + "D"


ROWS = [
    (1, 0, "system", "Be kind."), (1, 1, "user", "Hi?"), (1, 2, "assistant", "Yes"), (1, 3, "assistant", "Yes"),
    (2, None, "user", "a b ."), (2, 5, "user", None), (2, 9, None, "x."), (2, 9, None, "x."), (2, 9, "", "y!"),
    (None, 1, "assistant", " \t\n"), (None, None, "tool", "z."), (3, None, "user", ""), (8, 7, "user", "q."), (13, 7, "user", "q."),
    *((5, i % 9, "user" if i % 3 else "assistant", f"t{i % 7}.") for i in range(40)),
    *((6, 2, "assistant", "same.") for _ in range(30)),
]


def plain(rows):
    """The report of one conversation, row by row."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    signs, faults, seen = [], [], set()
    for _, role, text in rows:
        last = re.findall(r"[^\x20\x09-\x0D]", text)[-1:]
        fault = "b" if not last else "d" if (role, text) in seen else "" if last[0] in ".!?" else "t"
        seen.add((role, text))
        faults.append(fault)
        one = role[:1] if role[:1] in ("s", "u", "a") else "x"
        signs.append("d" if fault in ("b", "d") else one.upper() if fault else one)
    cost, audit = search("".join(signs)) if signs else (0, "")
    out, at = [], iter(rows)
    n = len(audit.replace("D", ""))
    for edit in audit:
        row = (None, "", "") if edit == "I" else next(at)
        if edit != "D":
            other = "assistant" if (n - len(out)) % 2 else "user"
            out.append(f"{row[1] if edit == 'K' else other}:{row[2]}")
    turns = {r[0] for r in rows} - {None}
    pairs = [a[1][:1] + b[1][:1] for a, b in zip(rows, rows[1:], strict=False)]
    return (
        max(turns) - min(turns) + 1 - len(turns) if turns else 0,
        *(faults.count(f) for f in "bdt"), sum(p not in ("su", "ua", "au") for p in pairs), cost, audit,
        hashlib.sha256("\n".join(out).encode()).hexdigest(),
    )


@pytest.mark.parametrize("most", [None, 4])
def test_rows(spark, monkeypatch, most):
    monkeypatch.setattr(repair, "PIECE", 3)
    monkeypatch.setattr(repair, "FAN", 2)
    table = spark.createDataFrame(
        [(*r, "x") for r in ROWS], "conv_id long, turn long, role string, text string, at string"
    )
    rows = repair.damage(table)
    held = {}
    for r in rows.collect():
        held.setdefault(r.id, []).extend([(r.turn, r.role, r.text)] * r.copies)
    assert not held[8] and len(held[13]) == 2
    found = repair.repairs(rows, most)
    got = {r.id: tuple(r)[1:] for r in found.collect()}
    assert got == {k: plain(v) for k, v in held.items()}
    turns = repair.repaired_turns(rows, found).orderBy("id", "position").collect()
    for key, report in got.items():
        said = "\n".join(f"{r.role}:{r.text}" for r in turns if r.id == key)
        assert hashlib.sha256(said.encode()).hexdigest() == report[-1]
    assert repair.repairs(rows.where("id = 99"), most).count() == 0


def test_long_text(spark):
    rows = spark.createDataFrame([(6, 1, "user", "word " * 400_000)], "conv_id long, turn long, role string, text string")
    found = repair.repairs(repair.damage(rows).withColumn("copies", F.lit(1))).first()
    assert (found.truncated, found.cost, found.audit) == (1, 4, "D")
