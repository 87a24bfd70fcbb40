"""A lookup join that spreads hot keys, a broadcast filter for keys, and fuzzy word joins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docketeer.functions.names import bind

# A key is split so that no task gets more than this share of all rows from it, or more than
# TASK_ROWS where that is more. So at most 1 / TASK_SHARE keys are split.
TASK_SHARE = 1 / 20_000
TASK_ROWS = 100_000

# Bits of a key filter: at most FILTER_BITS / 64 rows of two numbers, 4 MB.
FILTER_BITS = 1 << 24


def exploded(df: DataFrame, keys: Sequence[str], array: Column | str, name: str) -> DataFrame:
    """The keys and one row per non-null element, for arrays that are costly to make.

    For a plain explode the optimizer first filters on the size of the array, which
    computes the array once more; it leaves the outer form alone.
    """
    return df.select(*keys, F.explode_outer(array).alias(name)).where(F.col(name).isNotNull())


def hot_keys(counts: DataFrame, keys: Sequence[str], n: str, total: Column | None = None) -> DataFrame:
    """The keys with more rows than a task should get, and into how many parts each goes.

    At most 1 / TASK_SHARE rows, so the table may be broadcast. ``total`` is the number of all rows
    where that is not the sum of ``n``.
    """
    total = counts.agg(F.sum(n)).scalar() if total is None else total
    most = F.greatest(F.lit(float(TASK_ROWS)), total * TASK_SHARE)
    return counts.where(F.col(n) > most).select(*keys, F.ceil(F.col(n) / most).alias("_parts"))


def lookup(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    spread: Sequence[str],
    how: str = "left",
    counts: DataFrame | None = None,
    count_column: str = "n_rows",
) -> DataFrame:
    """Join ``left`` to the lookup table ``right``; a hot key never lands in one task.

    Where the rows per key are known, as ``counts``, rows of a hot key go to as many
    partitions as its rows need, by a hash of the ``spread`` columns, which should tell them
    apart, and the lookup rows of that key are repeated for each. The salt is a plain hash, so
    a recomputed partition gives the same rows again. Without counts the left side is not read
    for them: the adaptive planner splits what it finds too large.
    """
    keys = list(keys)
    if counts is None:
        return left.join(right, keys, how)
    hot = F.broadcast(hot_keys(counts, keys, count_column))
    salt = F.coalesce(F.pmod(F.xxhash64(*spread), F.col("_parts")), F.lit(0))
    salted = left.join(hot, keys, "left").withColumn("_salt", salt)
    copies = F.sequence(F.lit(0).cast("long"), F.coalesce("_parts", F.lit(1)) - 1)
    repeated = right.join(hot, keys, "left").withColumn("_salt", F.explode(copies))
    return salted.drop("_parts").join(repeated.drop("_parts"), [*keys, "_salt"], how).drop("_salt")


def key_filter(keys: DataFrame, key: str) -> DataFrame:
    """(_word, _bits): the bits that the 64-bit hashes in ``key`` set, 64 to a row.

    However many keys there are, it has FILTER_BITS / 64 rows at most; with very many of them
    it lets everything pass.
    """
    return keys.groupBy(filter_word(key)).agg(F.bit_or(filter_bit(key)).alias("_bits"))


def passing(df: DataFrame, key: str, bits: DataFrame) -> DataFrame:
    """The rows whose key may be among those of a :func:`key_filter`, found without a shuffle."""
    met = df.withColumn("_word", filter_word(key)).join(F.broadcast(bits), "_word")
    return met.where(F.col("_bits").bitwiseAND(filter_bit(key)) != 0).drop("_word", "_bits")


def filter_word(key: str) -> Column:
    """The row of a key filter that has the key's bit."""
    return F.pmod(F.shiftright(F.col(key), 6), F.lit(FILTER_BITS // 64)).alias("_word")


def filter_bit(key: str) -> Column:
    """The key's bit in its row."""
    return F.expr(f"shiftleft(1L, cast(`{key}` & 63L as int))")


def _segments(length: Column, edits: int) -> list[tuple[Column, Column]]:
    """Start (from 1) and length of the edits + 1 even pieces of a word, the longer ones last."""
    base = F.floor(length / (edits + 1)).cast("int")
    over = F.pmod(length, F.lit(edits + 1)).cast("int")
    out = []
    for i in range(edits + 1):
        longer = F.greatest(over - (edits + 1 - i), F.lit(0))
        size = base + F.when(over >= edits + 1 - i, 1).otherwise(0)
        out.append((base * i + longer + 1, size))
    return out


def _piece(length: Column, i: int, word: Column, start: Column, size: Column) -> Column:
    return F.xxhash64(length, F.lit(i), F.substr(word, start, size))


def item_keys(word: Column, edits: int) -> Column:
    """Hashes of the word's edits + 1 pieces, each with its number and the word's length."""
    length = F.length(word)
    return F.array(*(_piece(length, i, word, *s) for i, s in enumerate(_segments(length, edits))))


def probe_keys(word: Column, edits: int) -> Column:
    """Hashes under which every word within ``edits`` edits is listed by :func:`item_keys`.

    So many edits leave one of the other word's pieces whole, and move it by no more than their
    number. A word of any length has (2k + 1)^2 (k + 1) keys at most.
    """
    own = F.length(word)
    keys = []
    for change in range(-edits, edits + 1):
        length = own + change
        for i, (start, size) in enumerate(_segments(length, edits)):
            for shift in range(-edits, edits + 1):
                at = start + shift
                fits = (length >= 0) & (at >= 1) & (at + size - 1 <= own)
                keys.append(F.when(fits, _piece(length, i, word, at, size)))
    return F.array_distinct(F.array_compact(F.array(*keys)))


# Letters up to which the edit distance itself is quicker than looking for the edits.
SHORT_WORD = 64


def within_edits(a: Column | str, b: Column | str, edits: int) -> Column:
    """Whether ``edits`` edits make one word of the other, in time linear in long words."""
    a, b = (F.col(x) if isinstance(x, str) else x for x in (a, b))
    short = F.greatest(F.length(a), F.length(b)) <= SHORT_WORD
    return F.when(short, F.levenshtein(a, b, edits) >= 0).otherwise(_edited(a, b, edits))


def _edited(a: Column, b: Column, edits: int) -> Column:
    """The first edit may be taken to stand where the words first differ; what follows has one less."""
    if edits == 0:
        return a == b

    def behind(pair: Column) -> Column:
        x, y = pair["x"], pair["y"]
        rest = lambda c: F.substr(c, F.lit(2))
        others = ((rest(x), rest(y)), (rest(x), y), (x, rest(y)))
        found = x == y
        for left, right in others:
            found = found | _edited(left, right, edits - 1)
        return found

    return bind(_without_prefix(a, b), behind)


def _without_prefix(a: Column, b: Column) -> Column:
    """Both words without their common prefix, which is found by halved steps, a comparison each."""
    least = F.least(F.length(a), F.length(b))
    steps = F.reverse(F.sequence(F.lit(0), F.floor(F.log2(F.greatest(least, F.lit(1)))).cast("int")))

    def longer(at: Column, k: Column) -> Column:
        step = F.pow(F.lit(2), k).cast("int")
        same = F.substr(a, at + 1, step) == F.substr(b, at + 1, step)
        return F.when((at + step <= least) & same, at + step).otherwise(at)

    prefix = F.aggregate(steps, F.lit(0), longer)
    return bind(prefix, lambda p: F.struct(F.substr(a, p + 1).alias("x"), F.substr(b, p + 1).alias("y")))


def fuzzy_members(
    words: DataFrame, word: str, collection: DataFrame, item: str, edits: int
) -> DataFrame:
    """Add ``is_member``: whether any item of the collection is within ``edits`` edits."""
    distinct = words.select(F.col(word).alias("_word")).where("_word IS NOT NULL").distinct()
    probes = exploded(distinct, ["_word"], probe_keys(F.col("_word"), edits), "_key")
    listed = collection.select(F.col(item).alias("_item")).where("_item IS NOT NULL").distinct()
    items = exploded(listed, ["_item"], item_keys(F.col("_item"), edits), "_key")
    members = (
        probes.join(items, "_key")
        .where(within_edits("_word", "_item", edits))
        .select(F.col("_word").alias(word))
        .distinct()
        .withColumn("is_member", F.lit(True))
    )
    joined = words.join(members, word, "left")
    return joined.withColumn("is_member", F.coalesce("is_member", F.lit(False)))
