import random
import re
import time

from pyspark.sql import functions as F

from docketeer.functions import text as X
from docketeer.functions.names import bind


def one(spark, value, use):
    df = spark.createDataFrame([(value,)], "v string")
    return df.select(use(F.col("v")).alias("o")).first().o


def test_keywords_are_substrings(spark):
    assert one(spark, "הבניין הגדול", lambda c: X.has_any(c, ["קרקע", "בניין"]))
    assert not one(spark, "abc", lambda c: X.has_any(c, ["AB"]))
    assert not one(spark, "abc", lambda c: X.has_any(c, []))


def test_patterns_accumulate(spark):
    assert one(spark, "aabb", lambda c: X.replace_patterns(c, ["ab", "ab"])) == ""


def test_prefixed_words(spark):
    got = one(spark, "בית ובית הבית ביתן שבית", lambda c: X.remove_prefixed_words(c, ["בית"]))
    assert got == "ביתן"


def test_prefixed_words_meet_their_variants_and_are_literal(spark):
    words = ["בית משפט", "בן-דוד", "(x.)"]
    text = "בית-משפט בן דוד (x.) (xy) ללא"
    assert one(spark, text, lambda c: X.remove_prefixed_words(c, words)) == "(xy) ללא"


def listed(words):
    """The pattern as a plain list of alternatives, the longest first."""
    forms = [w.split() for w in words if len(w.split()) > 1], [w.split("-") for w in words if "-" in w]
    variants = [f"{a[0]}-{a[1]}" for a in forms[0]] + [f"{a[0]} {a[1]}" for a in forms[1]]
    any_of = lambda xs: "|".join(map(re.escape, sorted(set(xs), key=lambda x: (-len(x), x))))
    branches = [f"(?:x?|yz?)(?:{any_of(words)})"] + ([f"(?:{any_of(variants)})"] if variants else [])
    return rf"(?<!\w)(?:{'|'.join(branches)})(?!\w)"


def test_prefixed_words_by_their_letters():
    chance = random.Random(6)
    letters = "abxyz -(."
    for _ in range(300):
        words = ["".join(chance.choices(letters, k=chance.randint(1, 4))) for _ in range(chance.randint(1, 8))]
        words = [w for w in words if w.strip() and not w.startswith("-") and not w.endswith("-") and "--" not in w]
        if not words:
            continue
        text = "".join(chance.choices(letters, k=60))
        pattern = X.prefixed_words_pattern(words, ["x?", "yz?"]).removeprefix("(?U)")
        assert re.sub(pattern, "#", text) == re.sub(listed(words), "#", text), (words, text)


def test_a_long_word_list_costs_what_a_short_one_does(spark):
    chance = random.Random(7)
    words = ["".join(chance.choices("abcdefghij", k=chance.randint(3, 9))) for _ in range(10_000)]
    texts = [" ".join(chance.choices(words, k=300)) for _ in range(400)]
    df = spark.createDataFrame([(t,) for t in texts], "t string").repartition(8).cache()

    def seconds(some):
        out = df.select(X.remove_prefixed_words(F.col("t"), some).alias("t"))
        out.count(), out.agg(F.sum(F.length("t"))).collect()
        begin = time.perf_counter()
        for _ in range(5):
            left = out.agg(F.sum(F.length("t"))).first()[0]
        return time.perf_counter() - begin, left

    short, kept = seconds(words[:10])
    long, none = seconds(words)
    assert none == 0 < kept
    assert long < 2 * short + 0.5


def test_clean_text(spark):
    got = one(spark, 'ש"ל דנה, 12 ושל בית!', lambda c: X.clean_text(c, ["של"], ["דנה"]))
    assert got == "בית"


def test_bare_tokens_and_letter_words(spark):
    assert one(spark, "a, b-c  'd'", X.bare_tokens) == ["a", "bc", "d"]
    assert one(spark, "שלום, a1 ב 12 עולם.", X.letter_words) == ["שלום", "עולם"]


def test_model_tokens_and_ngrams(spark):
    assert one(spark, "An a_b x 12 שלום!", X.model_tokens) == ["an", "a_b", "12", "שלום"]
    assert one(spark, "ab cd ef", lambda c: X.ngrams(X.model_tokens(c), 2)) == ["ab cd", "cd ef"]
    assert one(spark, "ab cd ef", lambda c: X.ngrams(X.model_tokens(c), F.lit(4))) == []
    assert one(spark, "ab cd", lambda c: X.ngrams(X.model_tokens(c), F.lit(1))) == ["ab", "cd"]


def test_counted_terms(spark):
    got = one(spark, "b a b c a b", lambda c: X.counted(F.split(c, " ")))
    assert [(r.term, r.tf) for r in got] == [("a", 2), ("b", 3), ("c", 1)]
    assert one(spark, "", lambda c: X.counted(F.array().cast("array<string>"))) == []


def test_bind_holds_a_value(spark):
    assert one(spark, "ab", lambda c: bind(F.length(c), lambda n: n * n)) == 4
