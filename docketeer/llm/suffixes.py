"""Suffix arrays of number sequences by induced sorting, and permuted common prefixes.

The method is SA-IS (Nong, Zhang, Chan, 2009): suffixes are classified as smaller (S) or larger
(L) than the one after them; the leftmost S suffixes (LMS) are sorted by their substrings, which
are named and sorted recursively where names repeat; from their order that of the L suffixes is
induced by one sweep up, and that of all S suffixes by one sweep down. A sweep reads the array in
order and writes only ahead of itself, so all entries up to the first place written to by one of
them can be moved at once, which is what makes it work on whole arrays here.
"""

from __future__ import annotations

import numpy as np

# Entries that a step of a sweep should move at least.
FEW = 16


def _places(n: int) -> type:
    """The narrow numbers that positions of a text fit in, as memory traffic is what costs."""
    return np.int32 if n < 1 << 31 else np.int64


def _smaller(text: np.ndarray) -> np.ndarray:
    """Which suffixes are of type S; the last one, the end mark, is."""
    n = len(text)
    rises = np.ones(n, bool)
    rises[:-1] = text[:-1] < text[1:]
    decided = np.ones(n, bool)
    decided[:-1] = text[:-1] != text[1:]
    # Equal neighbours have the type of the next place that differs.
    at = np.where(decided, np.arange(n, dtype=_places(n)), n - 1)
    return rises[np.minimum.accumulate(at[::-1])[::-1]]


def _sweep(
    text: np.ndarray,
    out: np.ndarray,
    wanted: np.ndarray,
    free: np.ndarray,
    begins: np.ndarray,
    up: bool,
) -> None:
    """Induce from ``out`` into ``out``: for each entry, in order, its predecessor if wanted.

    ``free`` holds the next free place of every symbol; ``up`` tells the direction of both the
    sweep and the filling. Where entries follow right behind those that induce them, as in a run of
    one symbol, the whole range of that symbol is filled at once: all its entries, then those one
    place before each in its run, then those two before, and so on.
    """
    n, sign = len(out), 1 if up else -1
    at, chunk = 0, 1024
    view = out if up else out[::-1]
    # The range filled last, and its symbol.
    filled, own = 0, -1
    while at < n:
        held = view[at : at + chunk]
        places = np.flatnonzero(held > 0)
        entries = held[places] - 1
        keep = wanted[entries]
        if at < filled:
            keep &= (places >= filled - at) | (text[entries] != own)
        places, entries = places[keep] + at, entries[keep]
        end = min(at + chunk, n)
        if len(entries):
            symbols = text[entries]
            order = np.argsort(symbols, kind="stable")
            ranked = symbols[order]
            new = np.ones(len(ranked), bool)
            new[1:] = ranked[1:] != ranked[:-1]
            firsts = np.flatnonzero(new)
            group = np.cumsum(new) - 1
            rank = np.arange(len(ranked)) - firsts[group]
            targets = np.empty(len(ranked), np.int64)
            targets[order] = free[ranked] + sign * rank
            seen = targets if up else n - 1 - targets
            least = np.minimum.accumulate(seen)
            # An entry behind a place that is only now written to must wait.
            ready = int(np.searchsorted(places[1:] >= least[:-1], True)) + 1
            first = int(entries[0])
            stalls = ready < min(FEW, len(places)) or first - begins[first] > FEW > ready
            if stalls and symbols[0] == text[first + 1]:
                at, own = int(places[0]), int(symbols[0])
                queue = view[at : int(free[own]) if up else n - 1 - int(free[own])].copy()
                depth = queue - begins[queue] + 1
                before = np.cumsum(depth) - depth
                step = np.arange(int(depth.sum())) - np.repeat(before, depth)
                order = np.argsort(step, kind="stable")
                filled = at + len(step)
                view[at:filled] = (np.repeat(queue, depth) - step)[order]
                free[own] += sign * (len(step) - len(queue))
                continue
            if ready < len(places):
                targets, entries, symbols = targets[:ready], entries[:ready], symbols[:ready]
            end = min(end, int(least[ready - 1]))
            out[targets] = entries
            if ready < len(places):
                order = np.sort(symbols, kind="stable")
                new = np.ones(ready, bool)
                new[1:] = order[1:] != order[:-1]
                firsts, ranked = np.flatnonzero(new), order
            sizes = np.diff(np.append(firsts, len(ranked)))
            free[ranked[firsts]] += sign * sizes
        chunk = min(chunk * 2, 1 << 20) if end == at + chunk else max(256, 2 * (end - at))
        at = max(end, at + 1)


def _induce(
    text: np.ndarray, small: np.ndarray, lms: np.ndarray, ends: np.ndarray
) -> np.ndarray:
    """All suffixes in order, from the LMS suffixes in order (or, of their substrings, in any)."""
    out = np.full(len(text), -1, _places(len(text)))
    starts = np.concatenate([[0], ends[:-1]])
    # The LMS suffixes go to the ends of their symbols' ranges, in their order.
    symbols = text[lms]
    order = np.argsort(symbols, kind="stable")
    ranked = symbols[order]
    counts = np.bincount(ranked, minlength=len(ends))
    last = np.cumsum(counts)[ranked]
    out[ends[ranked] - (last - np.arange(len(ranked)))] = lms[order]
    # Where the run of equal symbols begins that a place lies in.
    begins = np.arange(len(text), dtype=out.dtype)
    begins[1:][text[1:] == text[:-1]] = 0
    begins = np.maximum.accumulate(begins)
    _sweep(text, out, ~small, starts.copy(), begins, True)
    # The S suffixes are found anew, so their places are cleared.
    out[(out >= 0) & small[out]] = -1
    out[0] = len(text) - 1
    small = small.copy()
    small[-1] = False
    _sweep(text, out, small, ends - 1, begins, False)
    return out


def _names(text: np.ndarray, ordered: np.ndarray, lms: np.ndarray) -> np.ndarray:
    """Rank of each LMS substring of ``ordered``, equal ones alike."""
    length = np.zeros(len(text), lms.dtype)
    length[lms[:-1]] = np.diff(lms)
    a, b = ordered[:-1], ordered[1:]
    same = length[a] == length[b]
    at = np.flatnonzero(same)
    step = 0
    while len(at):
        equal = text[a[at] + step] == text[b[at] + step]
        same[at[~equal]] = False
        at = at[equal & (step < length[a[at]])]
        step += 1
    return np.concatenate([[0], np.cumsum(~same)])


def _sorted(text: np.ndarray) -> np.ndarray:
    """Suffix array of a text whose last symbol is its smallest and occurs once."""
    if len(text) == 1:
        return np.zeros(1, np.int64)
    small = _smaller(text)
    lms = (np.flatnonzero(small[1:] & ~small[:-1]) + 1).astype(_places(len(text)))
    ends = np.cumsum(np.bincount(text, minlength=int(text.max()) + 1))
    if len(lms) > 1:
        rough = _induce(text, small, lms, ends)
        first = np.zeros(len(text), bool)
        first[lms] = True
        ordered = rough[first[rough]]
        names = _names(text, ordered, lms)
        if names[-1] + 1 < len(lms):
            named = np.zeros(len(text), np.uint16 if names[-1] < 65_000 else np.int32)
            named[ordered] = names
            ordered = lms[_sorted(named[lms])]
        lms = ordered
    return _induce(text, small, lms, ends)


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Starts of the suffixes of ``text``, numbers from 0 on, in order; ends sort first."""
    if not len(text):
        return np.zeros(0, np.int64)
    kind = np.uint16 if int(text.max()) < 65_000 else np.int64
    marked = np.zeros(len(text) + 1, kind)
    marked[:-1] = text
    marked[:-1] += 1
    return _sorted(marked)[1:]


def _common(text: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the common prefix of the suffixes at ``a`` and ``b``, pair by pair."""
    out = np.zeros(len(a), np.int64)
    at, block = np.arange(len(a)), 8
    # A mark that equals nothing, one for each side, ends both.
    n = len(text)
    left = np.concatenate([text.astype(np.int64), np.full(4096, -1)])
    right = np.concatenate([text.astype(np.int64), np.full(4096, -2)])
    while len(at):
        more = np.zeros(len(at), bool)
        width = np.arange(block)
        size = max(1, 4_000_000 // block)
        for k in range(0, len(at), size):
            part = at[k : k + size]
            x = np.minimum(a[part] + out[part], n)
            y = np.minimum(b[part] + out[part], n)
            equal = left[x[:, None] + width] == right[y[:, None] + width]
            whole = equal.all(axis=1)
            out[part] += np.where(whole, block, np.argmin(equal, axis=1))
            more[k : k + size] = whole
        at, block = at[more], min(4 * block, 4096)
    return out


def permuted_lcp(text: np.ndarray, array: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(plcp, phi): for each position, the suffix before it in order and their common prefix.

    ``phi`` is -1 for the first suffix. Where the symbols before both are the same, the prefix is
    that of the position before less one (Karkkainen, Manzini, Puglisi, 2009), so only the other
    positions are compared.
    """
    n = len(text)
    phi = np.full(n, -1, np.int64)
    phi[array[1:]] = array[:-1]
    plcp = np.zeros(n, np.int64)
    inner = np.flatnonzero((phi > 0) & (np.arange(n) > 0))
    derived = np.zeros(n, bool)
    derived[inner] = (text[inner - 1] == text[phi[inner] - 1]) & (phi[inner - 1] >= 0)
    own = np.flatnonzero(~derived)
    compared = own[phi[own] >= 0]
    plcp[compared] = _common(text, compared, phi[compared])
    source = np.maximum.accumulate(np.where(derived, 0, np.arange(n))) if n else phi
    return plcp[source] - (np.arange(n) - source), phi


def repeated(text: np.ndarray, length: int, room: np.ndarray) -> np.ndarray:
    """Positions whose ``length`` symbols also start at another position.

    ``room`` is the number of symbols from each position to the end of its part of the text;
    those with less room than ``length`` neither count nor are counted.
    """
    array = suffix_array(text)
    plcp, phi = permuted_lcp(text, array)
    far = plcp >= length
    out = far.copy()
    out[phi[far]] = True
    return np.flatnonzero(out & (room >= length))
