"""Suffix arrays and common prefixes against plain sorting."""

import time

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from docketeer.llm import suffixes as S


def plain(text):
    return sorted(range(len(text)), key=lambda i: text[i:])


def common(a, b):
    n = 0
    while n < min(len(a), len(b)) and a[n] == b[n]:
        n += 1
    return n


def check(text):
    array = S.suffix_array(np.array(text, np.int64))
    assert array.tolist() == plain(text)
    plcp, phi = S.permuted_lcp(np.array(text, np.int64), array)
    for before, at in zip(array[:-1], array[1:], strict=True):
        assert phi[at] == before and plcp[at] == common(text[before:], text[at:])


@given(st.lists(st.integers(0, 3), max_size=80))
@settings(max_examples=400, deadline=None)
def test_few_symbols(text):
    check(text)


@given(st.lists(st.integers(0, 10**5), max_size=60))
@settings(max_examples=100, deadline=None)
def test_many_symbols(text):
    check(text)


@pytest.mark.parametrize("text", [[], [0], [5] * 300, [1, 2] * 200, [2, 1] * 200 + [2], [1, 2, 3] * 50 + [9, 9, 9] * 50])
def test_runs(text):
    check(text)


def test_larger():
    draw = np.random.default_rng(2)
    part = draw.integers(0, 4, 900).tolist()
    check(part + draw.integers(0, 200, 700).tolist() + part[100:] + [7] * 500 + part)


@given(st.lists(st.integers(0, 2), max_size=60), st.integers(1, 6), st.integers(1, 20))
@settings(max_examples=200, deadline=None)
def test_repeated(text, length, part):
    n = len(text)
    room = np.array([min(part - i % part, n - i) for i in range(n)], np.int64)
    marked = [x + 1 for x in text]
    joined, at, left = [], [], []
    for i, x in enumerate(marked):
        at.append(len(joined))
        joined.append(x)
        left.append(room[i])
        if (i + 1) % part == 0:
            joined.append(0)
            left.append(0)
    got = S.repeated(np.array(joined, np.int64), length, np.array(left, np.int64))
    windows = [tuple(marked[i : i + length]) if room[i] >= length else None for i in range(n)]
    want = [at[i] for i in range(n) if windows[i] and windows.count(windows[i]) > 1]
    assert got.tolist() == want


@pytest.mark.parametrize("period", [1, 2, 3, 7, 100])
def test_short_periods_take_no_longer(period):
    """Runs of one symbol and short periods are sorted about as fast as a random text."""
    chance = np.random.default_rng(period)
    text = np.tile(chance.integers(0, 200, period), 400_000 // period)
    begin = time.perf_counter()
    array = S.suffix_array(text)
    assert time.perf_counter() - begin < 5
    # Suffixes are in order if their first symbols are, or else what follows them.
    rank = np.append(np.argsort(array), -1)
    first, rest = text[array], rank[array + 1]
    assert ((first[:-1] < first[1:]) | ((first[:-1] == first[1:]) & (rest[:-1] < rest[1:]))).all()
