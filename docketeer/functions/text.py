"""Column expressions over verdict texts."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from docketeer.functions.names import PUNCTUATION, bind, squeeze, tokens

# One-letter Hebrew prefixes, each optional before a listed word.
PREFIXES = ["ו?", "ל?", "כ?ש?", "ה?", "ב?", "מ?", "ש?", "כ?"]
# Fixed value: everything but the Hebrew letters, finals included.
NOT_HEBREW = "[^א-ת]"
# Fixed value: ASCII digits.
DIGITS = "0123456789"


def has_any(text: Column, keywords: Sequence[str]) -> Column:
    """Whether any keyword occurs as a substring."""
    return reduce(lambda a, b: a | b, (F.contains(text, F.lit(k)) for k in keywords), F.lit(False))


def replace_patterns(text: Column, patterns: Sequence[str], put: str = "") -> Column:
    """Apply each pattern in turn to the result of the one before."""
    return reduce(lambda t, p: F.regexp_replace(t, F.lit(p), F.lit(put)), patterns, text)


def _any_of(forms: Sequence[str]) -> str:
    """A pattern for any of the literal forms, the longest that fits: a tree of their letters."""
    tree: dict = {}
    for form in forms:
        node = tree
        for letter in form:
            node = node.setdefault(letter, {})
        node[""] = {}

    def written(node: dict) -> str:
        branches = [
            re.sub(r"([\\.^$|?*+()\[\]{}])", r"\\\1", letter) + written(below)
            for letter, below in sorted(node.items())
            if letter
        ]
        if not branches:
            return ""
        if "" in node:
            return f"(?:{'|'.join(branches)})?"
        return branches[0] if len(branches) == 1 else f"(?:{'|'.join(branches)})"

    return f"(?:{written(tree)})"


def prefixed_words_pattern(words: Sequence[str], prefixes: Sequence[str] = PREFIXES) -> str:
    """The words with their prefixes, and their bare variants, as one pattern.

    Two words are also met as 'a-b', and a hyphenated word as 'a b'. Words are put together by
    their common beginnings, so a text is led down one branch of a tree and its cost hardly
    depends on the length of the list.
    """
    variants: list[str] = []
    for word in words:
        by_space, by_hyphen = word.split(), word.split("-")
        if len(by_space) > 1:
            variants.append(f"{by_space[0]}-{by_space[1]}")
        if len(by_hyphen) > 1:
            variants.append(f"{by_hyphen[0]} {by_hyphen[1]}")

    branches = [f"(?:{'|'.join(prefixes)}){_any_of(words)}"]
    if variants:
        branches.append(_any_of(variants))
    return rf"(?U)(?<!\w)(?:{'|'.join(branches)})(?!\w)"


def remove_prefixed_words(
    text: Column, words: Sequence[str], prefixes: Sequence[str] = PREFIXES, put: str = ""
) -> Column:
    """Remove the words, bare or after a prefix, as whole words; then squeeze blanks."""
    pattern = prefixed_words_pattern(words, prefixes)
    return squeeze(F.regexp_replace(text, F.lit(pattern), F.lit(put)))


def clean_text(
    text: Column,
    stop_words: Sequence[str],
    names: Sequence[str],
    prefixes: Sequence[str] = PREFIXES,
) -> Column:
    """Drop ASCII punctuation and digits, then the prefixed stop words, then the names."""
    bare = F.translate(text, PUNCTUATION + DIGITS, "")
    return remove_prefixed_words(
        remove_prefixed_words(bare, stop_words, prefixes), names, prefixes
    )


def bare_tokens(text: Column) -> Column:
    """Tokens after dropping ASCII punctuation."""
    return tokens(F.translate(text, PUNCTUATION, ""))


def letter_words(text: Column, not_letters: str = NOT_HEBREW) -> Column:
    """Words of two letters or more, everything outside the letter class being blank."""
    words = tokens(F.regexp_replace(text, not_letters, " "))
    return F.filter(words, lambda w: F.length(w) > 1)


def model_tokens(text: Column) -> Column:
    """Lower-case runs of two or more letters, digits or underscores."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"([\p{L}\p{N}_]{2,})"), F.lit(1))


def ngrams(words: Column, n: int | Column) -> Column:
    """All runs of ``n`` neighbouring tokens, joined by a space; none if there are fewer."""
    if isinstance(n, int) and n == 1:
        return words
    size = F.lit(n) if isinstance(n, int) else n

    def runs(held: Column) -> Column:
        starts = F.sequence(F.lit(1), F.size(held) - size + 1)
        grams = F.transform(starts, lambda i: F.array_join(F.slice(held, i, size), " "))
        return (
            F.when(size == 1, held)
            .when(F.size(held) >= size, grams)
            .otherwise(F.array().cast("array<string>"))
        )

    return bind(words, runs)


def counted(values: Column) -> Column:
    """Structs (term, tf): each distinct value of a list and how often it has it.

    Counting happens inside the row, by sorting the list and taking the lengths of its runs.
    """

    def runs(held: Column) -> Column:
        starts = F.filter(
            F.sequence(F.lit(0), F.size(held) - 1),
            lambda i: (i == 0) | (F.get(held, i) != F.get(held, i - 1)),
        )
        return bind(starts, lambda at: F.zip_with(at, _next_starts(at, F.size(held)), _run(held)))

    none = F.array().cast("array<struct<term:string,tf:int>>")
    return F.when(F.size(values) > 0, bind(F.array_sort(values), runs)).otherwise(none)


def _next_starts(at: Column, end: Column) -> Column:
    return F.concat(F.slice(at, F.lit(2), F.size(at)), F.array(end))


def _run(held: Column) -> Callable[[Column, Column], Column]:
    return lambda a, b: F.struct(F.get(held, a).alias("term"), (b - a).alias("tf"))
