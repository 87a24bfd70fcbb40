"""Column expressions over one name or a list of names.

The results follow the rules observed in the verdict data job, odd ones included:
a list split keeps two parts, a single hyphen blanks a name, and a name that cannot
be paired resets the list. Each docstring gives the rule.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: ASCII punctuation.
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
# Fixed value: the two apostrophes seen in Hebrew names.
APOSTROPHES = "'’"

_BLANKS = r"(?U)[\s\x1c-\x1f]+"
_UNWANTED = r"[()]|\.[^ ]*[0-9]|[0-9][^ ]*\."
_HYPHEN_FIRST = r"(?s)^([^ ]*-[^ ]*) ([^ ]+).*$"
_FIRST_TWO = r"(?s)^([^ ]+) ([^ ]+).*$"


def squeeze(text: Column) -> Column:
    """Runs of any blanks become one space, ends trimmed."""
    return F.trim(F.regexp_replace(text, _BLANKS, " "))


def tokens(text: Column) -> Column:
    """Tokens between blanks; an empty text has none."""
    return F.array_remove(F.split(squeeze(text), " "), "")


def remove_unwanted(name: Column) -> Column:
    """Drop pieces with a bracket, or with both a dot and a digit.

    A piece is cut out wherever its characters occur in the text as it stands by then,
    so the cut is a fold over the bad pieces. Texts without any skip the fold.
    """
    bad = F.filter(F.split(name, " "), lambda piece: piece.rlike(_UNWANTED))
    cut = F.aggregate(bad, name, lambda left, piece: F.replace(left, piece, F.lit("")))
    kept = F.when(name.rlike(_UNWANTED), cut).otherwise(name)
    return squeeze(F.replace(kept, F.lit(" - "), F.lit("-")))


def remove_unwanted_each(names: Column) -> Column:
    return F.transform(names, remove_unwanted)


def split_at(names: Column, mark: str) -> Column:
    """Split each name that holds ``mark`` and keep its first two parts, squeezed."""

    def parts(name: Column) -> Column:
        halves = F.array(*(squeeze(F.split_part(name, F.lit(mark), F.lit(i))) for i in (1, 2)))
        return F.when(F.contains(name, F.lit(mark)), halves).otherwise(F.array(name))

    return F.flatten(F.transform(names, parts))


def without_words(text: Column, words: Sequence[str]) -> Column:
    """Remove whole tokens that are in ``words``; Catalyst turns the test into a hash set."""
    return F.array_join(F.filter(tokens(text), lambda token: ~token.isin(*words)), " ")


def without_words_each(names: Column, words: Sequence[str]) -> Column:
    """The list form, which also drops the names that end up empty."""
    return F.array_remove(F.transform(names, lambda name: without_words(name, words)), "")


def first_last_order(name: Column) -> Column:
    """Two tokens at most, swapped when the first carries a hyphen; null gives 'unknown'."""
    tidy = squeeze(name)
    two = F.regexp_replace(
        F.regexp_replace(tidy, _HYPHEN_FIRST, "$2 $1"), _FIRST_TWO, "$1 $2"
    )
    return F.when(name.isNull(), "unknown").when(F.contains(tidy, F.lit(" ")), two).otherwise(name)


def _pairable(parts: Column) -> Column:
    size = F.size(parts)
    return (size == 3) | ((size > 2) & (size % 2 == 0))


def _pairs(parts: Column) -> Column:
    three = F.array(
        F.concat(F.get(parts, 0), F.lit(" "), F.get(parts, 1), F.lit("-"), F.get(parts, 2))
    )
    couples = F.transform(
        F.sequence(F.lit(0), F.floor(F.size(parts) / 2).cast("int") - 1),
        lambda i: F.concat(F.get(parts, i * 2), F.lit(" "), F.get(parts, i * 2 + 1)),
    )
    return F.when(F.size(parts) == 3, three).otherwise(couples)


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often it is used.

    Outside of generated code an expression is evaluated at every place it stands in; a
    lambda variable holds a value.
    """
    return F.get(F.transform(F.array(value), use), 0)


def pair_up(names: Column) -> Column:
    """Turn three tokens into 'first last-last' and an even row of tokens into couples.

    A name that is neither resets the list to all the names as they came, and the order
    rule runs over the whole list after every name. Applied k times that rule depends
    on the parity of k only, so the loop has a closed form: everything up to the last
    unpairable name comes from the reset, everything after it from its own pairs.
    """
    nothing = F.array().cast("array<string>")

    def settle(name: Column, rounds: Column) -> Column:
        return bind(
            first_last_order(name),
            lambda once: F.when(rounds % 2 == 1, once).otherwise(first_last_order(once)),
        )

    def last_reset(rows: Column) -> Column:
        flags = F.reverse(F.transform(rows, lambda row: _pairable(row["parts"])))
        return bind(
            F.array_position(flags, F.lit(False)).cast("int"),
            lambda from_end: F.when(from_end > 0, F.size(rows) - from_end).otherwise(-1),
        )

    def both(rows: Column, last: Column) -> Column:
        total = F.size(rows)
        reset = F.when(
            last >= 0, F.transform(rows, lambda row: settle(row["name"], total - last))
        ).otherwise(nothing)
        paired = F.transform(
            rows,
            lambda row, i: F.when(
                i > last,
                F.transform(_pairs(row["parts"]), lambda name: settle(name, total - i)),
            ).otherwise(nothing),
        )
        return F.concat(reset, F.flatten(paired))

    rows = F.transform(
        names, lambda name: F.struct(name.alias("name"), tokens(name).alias("parts"))
    )
    return bind(rows, lambda r: bind(last_reset(r), lambda last: both(r, last)))


def strip_punctuation(name: Column) -> Column:
    """No hyphen: drop ASCII punctuation. One hyphen: ''. More: the first two parts."""

    def bare(text: Column) -> Column:
        return F.translate(text, PUNCTUATION, "")

    hyphens = F.length(name) - F.length(F.replace(name, F.lit("-"), F.lit("")))
    left, right = (bare(F.split_part(name, F.lit("-"), F.lit(i))) for i in (1, 2))
    two = F.concat(left, F.lit("-"), right)
    return F.when(hyphens == 0, bare(name)).when(hyphens == 1, "").otherwise(two)


def strip_punctuation_each(names: Column) -> Column:
    return F.transform(names, strip_punctuation)


def strip_apostrophes(name: Column) -> Column:
    return F.translate(name, APOSTROPHES, "")


def split_legal(names: Column) -> Column:
    """Judges and attorneys before the word lists: unwanted pieces, splits at ';' and ','."""
    return split_at(split_at(remove_unwanted_each(names), ";"), ",")


def finish_legal(names: Column) -> Column:
    """Judges and attorneys after the word lists: pairing, punctuation."""
    return strip_punctuation_each(pair_up(names))


def legal_names(names: Column, titles: Sequence[str], stop_words: Sequence[str]) -> Column:
    """Judges and attorneys: unwanted pieces, splits at ';' and ',', titles, stop words,
    pairing, punctuation."""
    bare = without_words_each(without_words_each(split_legal(names), titles), stop_words)
    return finish_legal(bare)


def split_all(names: Column, mark: str) -> Column:
    """Split each name at ``mark``; all parts are kept, squeezed."""
    return F.flatten(
        F.transform(names, lambda n: F.transform(F.split(n, _quoted(mark)), squeeze))
    )


def _quoted(mark: str) -> str:
    return "\\Q" + mark + "\\E"


def pair_clean(names: Column) -> Column:
    """Three tokens become 'first last-last', an even row of over two couples; others stay.

    Each name is looked at by itself. Of two tokens the one with a hyphen goes last.
    """

    def parts_of(name: Column) -> Column:
        return bind(
            tokens(name),
            lambda parts: F.when(_pairable(parts), _pairs(parts)).otherwise(
                F.array(F.array_join(parts, " "))
            ),
        )

    swap = lambda name: F.regexp_replace(name, r"^([^ ]*-[^ ]*) ([^ -]+)$", "$2 $1")
    return F.transform(F.flatten(F.transform(names, parts_of)), swap)


def split_legal_clean(names: Column) -> Column:
    return split_all(split_all(remove_unwanted_each(names), ";"), ",")


def finish_legal_clean(names: Column) -> Column:
    marks = PUNCTUATION.replace("-", "")
    stripped = F.transform(pair_clean(names), lambda n: squeeze(F.translate(n, marks, "")))
    return F.array_remove(stripped, "")


def legal_names_clean(names: Column, titles: Sequence[str], stop_words: Sequence[str]) -> Column:
    """Judges and attorneys without the losses of :func:`legal_names`.

    All parts of a split are kept, a name that cannot be paired stays as it is and changes no
    other, no name is cut to two tokens, and hyphens survive the punctuation.
    """
    split = split_legal_clean(names)
    bare = without_words_each(without_words_each(split, titles), stop_words)
    return finish_legal_clean(bare)


def party_names(names: Column) -> Column:
    """Petitioners and defendants: unwanted pieces only."""
    return remove_unwanted_each(names)


def first_name(name: Column) -> Column:
    """Of a two-token name, the token without the leading hyphen; else null."""
    return _half(name, 0)


def last_name(name: Column) -> Column:
    return _half(name, 1)


def _half(name: Column, i: int) -> Column:
    parts = tokens(name)
    swapped = F.contains(F.get(parts, 0), F.lit("-"))
    value = F.when(swapped, F.get(parts, 1 - i)).otherwise(F.get(parts, i))
    return F.when(F.size(parts) == 2, value)
