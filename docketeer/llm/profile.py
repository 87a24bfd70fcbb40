"""Counts over whole texts, for slices of a batch at a time."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from docketeer.llm import arrays as A

SYMBOLS = b"#*$%&|<>"


def _bytes(chars: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(chars)] = True
    return table


_SYMBOL = _bytes(SYMBOLS)
_UPPER, _DIGIT = _bytes(bytes(range(65, 91))), _bytes(b"0123456789")
_MARK = _bytes(b".,;:!?")


@dataclass
class Profile:
    """Arrays with a number for each text; ``hashes`` and ``bounds`` are those of its words."""

    hashes: np.ndarray
    bounds: np.ndarray
    n_bytes: np.ndarray
    n_words: np.ndarray
    word_chars: np.ndarray
    n_symbols: np.ndarray
    n_dup_lines: np.ndarray
    n_repeat_words: np.ndarray
    n_lines: np.ndarray
    n_upper: np.ndarray
    n_digits: np.ndarray
    n_marks: np.ndarray
    n_long: np.ndarray


def repeated_words(hashes: np.ndarray, bounds: np.ndarray, size: int = 3) -> np.ndarray:
    """For each text, its words in windows of ``size`` words that it has twice or more."""
    n = np.diff(bounds)
    doc = np.repeat(np.arange(len(n), dtype=np.uint64), n)
    keys = A.window_hashes(hashes, size)
    if not len(keys):
        return np.zeros(len(n), np.int64)
    whole = doc[: len(keys)] == doc[size - 1 :]
    at = np.flatnonzero(whole)
    keys = A.mixed(keys[at] ^ A.mixed(doc[at] + np.uint64(1)))
    order = np.argsort(keys)
    ranked = keys[order]
    same = ranked[1:] == ranked[:-1]
    again = np.zeros(len(keys), bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    firsts = at[again]
    return A.counts(A.covered(firsts, firsts + size, len(hashes)), bounds)


def _lines(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lines, and lines with a word that equal an earlier line, of each text."""
    held = data.tobytes()
    total, dup = [], []
    for lo, hi in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
        lines = held[lo:hi].split(b"\n")
        total.append(len(lines))
        n = 0
        if len(set(lines)) < len(lines):
            seen = set()
            for line in lines:
                if line in seen:
                    n += bool(line.split())
                seen.add(line)
        dup.append(n)
    return np.array(total, np.int64), np.array(dup, np.int64)


def profile(data: np.ndarray, offsets: np.ndarray) -> Profile:
    """All counts of the texts of one slice."""
    starts, ends, bounds = A.words(data, offsets, A.SPACED)
    hashes = A.word_hashes(data, starts, ends)
    by_text = lambda table: A.counts(table[data], offsets)
    points = A.counts((data & 0xC0) != 0x80, offsets)
    n_lines, n_dup = _lines(data, offsets)
    return Profile(
        hashes=hashes,
        bounds=bounds,
        n_bytes=np.diff(offsets),
        n_words=np.diff(bounds),
        word_chars=points - by_text(~A.SPACED),
        n_symbols=by_text(_SYMBOL),
        n_dup_lines=n_dup,
        n_repeat_words=repeated_words(hashes, bounds),
        n_lines=n_lines,
        n_upper=by_text(_UPPER),
        n_digits=by_text(_DIGIT),
        n_marks=by_text(_MARK),
        n_long=A.counts(ends - starts > 12, bounds),
    )
