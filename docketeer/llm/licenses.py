"""License wording in texts: fixed phrases, and templates compiled to token automata.

A template is the wording of a license or notice in words, with two marks:
``<<optional>> ... <<end>>`` around words that may be missing, and ``<<any N>>`` for up to N words
of any kind, as for a holder's name. All other words are mandatory and must match one by one.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketeer.llm import arrays as A

# Phrase and label.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

_AS_IS = """the software is provided as is without warranty of any kind express or implied
    including but not limited to the warranties of merchantability fitness for a particular
    purpose and noninfringement"""
_BSD = """redistribution and use in source and binary forms with or without modification are
    permitted provided that the following conditions are met
    <<optional>> 1 <<end>> redistributions of source code must retain the above copyright notice
    this list of conditions and the following disclaimer
    <<optional>> 2 <<end>> redistributions in binary form must reproduce the above copyright notice
    this list of conditions and the following disclaimer in the documentation and or other
    materials provided with the distribution"""
TEMPLATES = {
    "mit-text": f"""permission is hereby granted free of charge to any person obtaining a copy of
        this software and associated documentation files the software to deal in the software
        without restriction including without limitation the rights to use copy modify merge
        publish distribute sublicense and or sell copies of the software and to permit persons to
        whom the software is furnished to do so subject to the following conditions the above
        copyright notice and this permission notice <<optional>> including the next paragraph
        <<end>> shall be included in all copies or substantial portions of the software {_AS_IS}""",
    "bsd-2-clause": _BSD,
    "bsd-3-clause": f"""{_BSD} <<optional>> 3 <<end>> neither the name of <<any 20>> nor the names
        of its contributors may be used to endorse or promote products derived from this software
        without specific prior written permission""",
    "isc": """permission to use copy modify and or distribute this software for any purpose with or
        without fee is hereby granted provided that the above copyright notice and this permission
        notice appear in all copies""",
    "zlib": """permission is granted to anyone to use this software for any purpose including
        commercial applications and to alter it and redistribute it freely subject to the following
        restrictions""",
    "unlicense": """this is free and unencumbered software released into the public domain
        <<optional>> anyone is free to copy modify publish use compile sell or distribute this
        software <<end>>""",
    "apache-2.0": """licensed under the apache license version 2 0 <<optional>> the license
        <<end>> <<optional>> you may not use <<optional>> this file <<end>> <<any 3>> except in
        compliance with the license <<end>>""",
    "gpl-3.0": """licensed under the <<optional>> terms of the <<end>> gnu general public license
        <<optional>> as published by the free software foundation <<end>> <<optional>> either
        <<end>> version 3 <<optional>> of the license <<end>> <<optional>> or <<any 5>> any later
        version <<end>>""",
    "cc-by-nc-4.0": """licensed under <<optional>> a <<end>> <<optional>> creative commons <<end>>
        cc by nc 4 0 <<optional>> international <<end>> <<optional>> license <<end>>""",
    "cc-by-4.0": """licensed under <<optional>> a <<end>> <<optional>> creative commons <<end>>
        cc by 4 0 <<optional>> international <<end>> <<optional>> license <<end>>""",
    "mit": "released under the <<optional>> terms of the <<end>> mit license",
}

_TOKEN = re.compile(r"<<(?:optional|end|any \d+)>>|[0-9a-z]+")


@dataclass
class Automaton:
    """Steps in a row: a word, ("any", n), or ("skip", to) where an optional region begins."""

    label: str
    steps: list[str | tuple[str, int]] = field(default_factory=list)
    starts: set[str] = field(default_factory=set)

    def closure(self, states: set[tuple[int, int]]) -> set[tuple[int, int]]:
        """All (step, words of a gap used) that are reached without reading a word."""
        todo, seen = list(states), set(states)
        while todo:
            at, used = todo.pop()
            step = self.steps[at] if at < len(self.steps) else None
            if not isinstance(step, tuple):
                continue
            nexts = [(at + 1, 0)] + ([(step[1], 0)] if step[0] == "skip" else [])
            for state in nexts:
                if state not in seen:
                    seen.add(state)
                    todo.append(state)
        return seen

    def match(self, words: list[str], first: int) -> int | None:
        """End of the longest match that begins at a word, None without one."""
        states, end = self.closure({(0, 0)}), None
        for i in range(first, len(words) + 1):
            if (len(self.steps), 0) in states:
                end = i
            if i == len(words):
                break
            moved = set()
            for at, used in states:
                step = self.steps[at] if at < len(self.steps) else None
                if step == words[i]:
                    moved.add((at + 1, 0))
                elif isinstance(step, tuple) and step[0] == "any" and used < step[1]:
                    moved.add((at, used + 1))
            if not moved:
                break
            states = self.closure(moved)
        return end


def compile_template(label: str, markup: str) -> Automaton:
    """The automaton of a template; a region must be closed and some word mandatory."""
    made, open_at = Automaton(label), []
    for token in _TOKEN.findall(markup.lower()):
        if token == "<<optional>>":
            open_at.append(len(made.steps))
            made.steps.append(("skip", -1))
        elif token == "<<end>>":
            made.steps[open_at.pop()] = ("skip", len(made.steps))
        elif token.startswith("<<any"):
            made.steps.append(("any", int(token[6:-2])))
        else:
            made.steps.append(token)
    if open_at:
        raise ValueError(f"{label}: an optional region is not closed")
    first = made.closure({(0, 0)})
    if (len(made.steps), 0) in first or any(made.steps[at][0] == "any" for at, _ in first if isinstance(made.steps[at], tuple)):
        raise ValueError(f"{label}: a template must begin with a word")
    made.starts = {made.steps[at] for at, _ in first if isinstance(made.steps[at], str)}
    return made


@dataclass
class Scanner:
    """Automata of phrases and templates, by the words they can begin with."""

    phrases: list[tuple[list[str], str]]
    automata: list[Automaton]

    def __post_init__(self) -> None:
        starts = {p[0].encode() for p, _ in self.phrases}
        starts |= {w.encode() for a in self.automata for w in a.starts}
        # A text without any of these whole words needs no second look.
        word = rb"[0-9a-z\x80-\xff]"
        either = b"|".join(map(re.escape, sorted(starts)))
        self.glance = re.compile(rb"(?<!%b)(?:%b)(?!%b)" % (word, either, word))
        self.literals = sorted(starts)

    def scan(self, data: bytes) -> tuple[list[tuple[int, int, str]], list[tuple[int, int, str]]]:
        """(start, end, label) of all phrases and of all template matches of a lower-cased text."""
        if not any(x in data for x in self.literals) or not self.glance.search(data):
            return [], []
        words = data.translate(A.CLEAN).decode().split(" ")
        words = [w for w in words if w]
        places: dict[str, list[int]] = {}
        wanted = {p[0] for p, _ in self.phrases}.union(*(a.starts for a in self.automata))
        for i, w in enumerate(words):
            if w in wanted:
                places.setdefault(w, []).append(i)
        base = [
            (i, i + len(said), label)
            for said, label in self.phrases
            for i in places.get(said[0], [])
            if words[i : i + len(said)] == said
        ]
        more = []
        for automaton in self.automata:
            for i in sorted(i for w in automaton.starts for i in places.get(w, [])):
                end = automaton.match(words, i)
                if end is not None:
                    more.append((i, end, automaton.label))
        return sorted(base), more


def scanner(phrases: dict[str, str] = PHRASES, templates: dict[str, str] = TEMPLATES) -> Scanner:
    return Scanner(
        [(p.split(), label) for p, label in phrases.items()],
        [compile_template(label, markup) for label, markup in templates.items()],
    )


def license_scan(
    df: DataFrame,
    text: str = "text",
    phrases: dict[str, str] = PHRASES,
    templates: dict[str, str] = TEMPLATES,
) -> DataFrame:
    """(row, n_words, base, matches, score): the input row as a struct and what was found.

    ``base`` and ``matches`` are lists of (start, end, label) in words of the lower-cased text,
    ``score`` the share of its words that they cover, so that a bare license scores near 1 and a
    notice in an article near 0. One pass without a shuffle over whole texts. Null and empty
    texts have no words and score 0; repeated rows are each kept; an empty table gives an empty
    one; columns of any name may be there.
    """
    whole = F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias("row")
    rows = df.select(whole, F.col(f"`{text}`").alias("text"))
    spans = pa.list_(
        pa.struct([("start", pa.int64()), ("end", pa.int64()), ("label", pa.string())])
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan = scanner(phrases, templates).scan
        for batch in batches:
            for part, data, offsets in A.pieces(batch):
                data = A.lowered(data)
                held = data.tobytes()
                n_words = np.diff(A.words(data, offsets, A.ALPHANUMERIC)[2])
                found = [scan(held[lo:hi]) for lo, hi in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
                scores = []
                for n, both in zip(n_words.tolist(), found, strict=True):
                    ranges = np.array([(s, e) for some in both for s, e, _ in some], np.int64).reshape(-1, 2)
                    scores.append(A.covered(*ranges.T, n).sum() / n if len(ranges) else 0.0)
                lists = [
                    pa.array([[dict(zip(("start", "end", "label"), s, strict=True)) for s in some] for some in each], spans)
                    for each in zip(*found, strict=True)
                ] or [pa.array([], spans)] * 2
                out = [part.column(0), pa.array(n_words), *lists, pa.array(scores, pa.float64())]
                yield pa.RecordBatch.from_arrays(out, ["row", "n_words", "base", "matches", "score"])

    span = "array<struct<start:long,end:long,label:string>>"
    ddl = f"n_words long, base {span}, matches {span}, score double"
    return rows.mapInArrow(run, A.with_row(rows, ddl))
