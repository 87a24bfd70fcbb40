import random

from pyspark.sql import functions as F

from docketeer import schema
from docketeer.functions import names as N


def each(spark, values, use, kind="string"):
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, f"i int, v {kind}")
    return [r.o for r in df.select("i", use(F.col("v")).alias("o")).orderBy("i").collect()]


def lists(spark, values, use):
    return each(spark, values, use, "array<string>")


def test_remove_unwanted(spark):
    got = each(
        spark,
        [
            "איתי אופיר - אבולעפיה",
            "איתי (אופיר) אופיר",
            "תז.235 משה אופיר",
            "(a b c) d",
            "12 bare digits",
            "x. 5",
            "a  b\tc",
            "1.2 1.23 k",
            "",
        ],
        N.remove_unwanted,
    )
    assert got == [
        "איתי אופיר-אבולעפיה",
        "איתי אופיר",
        "משה אופיר",
        "b d",
        "12 bare digits",
        "x. 5",
        "a b c",
        "3 k",
        "",
    ]


def test_split_keeps_two_parts(spark):
    got = lists(
        spark,
        [["איתי  אופיר,אורן   חזן"], ["a,b,c"], ["x  y", ",z"], []],
        lambda c: N.split_at(c, ","),
    )
    assert got == [["איתי אופיר", "אורן חזן"], ["a", "b"], ["x  y", "", "z"], []]


def test_stop_words(spark):
    words = ["of", "the"]
    assert each(spark, ["the king of x", "of the", "often"], lambda c: N.without_words(c, words)) == [
        "king x",
        "",
        "often",
    ]
    assert lists(spark, [["the king", "of"]], lambda c: N.without_words_each(c, words)) == [["king"]]


def test_order(spark):
    got = each(spark, ["a-b c d", "a b c", "one", " one ", None, "a-b c-d"], N.first_last_order)
    assert got == ["c a-b", "a b", "one", " one ", "unknown", "c-d a-b"]


def test_pair_up_cases(spark):
    got = lists(
        spark,
        [["a b c d e f"], ["a b c", "d e"], ["d e", "a b c"], ["c-d a"], []],
        N.pair_up,
    )
    assert got == [
        ["a b", "c d", "e f"],
        ["a b", "d e"],
        ["d e", "a b", "a b-c"],
        ["a c-d"],
        [],
    ]


def loop(names):
    def order(name):
        t = name.split()
        if len(t) < 2:
            return name
        return f"{t[1]} {t[0]}" if "-" in t[0] else f"{t[0]} {t[1]}"

    out = []
    for name in names:
        t = name.split()
        if len(t) == 3:
            out = [*out, f"{t[0]} {t[1]}-{t[2]}"]
        elif len(t) > 2 and len(t) % 2 == 0:
            out = [*out, *(f"{t[i]} {t[i + 1]}" for i in range(0, len(t), 2))]
        else:
            out = list(names)
        out = [order(n) for n in out]
    return out


def test_pair_up_against_the_loop(spark):
    rng = random.Random(5)
    pool = ["a", "b-c", "d", "e-f", "g"]
    cases = [
        [" ".join(rng.choices(pool, k=rng.randint(0, 7))) for _ in range(rng.randint(0, 6))]
        for _ in range(3000)
    ]
    assert lists(spark, cases, N.pair_up) == [loop(c) for c in cases]


def test_strip_punctuation(spark):
    got = each(
        spark, ["it.\\]['']ai", "a b-c", "a-b-c", "x.-y!-z", "-", "--", None], N.strip_punctuation
    )
    assert got == ["itai", "", "a-b", "x-y", "", "-", None]


def test_first_and_last(spark):
    values = ["dana levi", "levi-cohen dana", "one", "a b c"]
    assert each(spark, values, N.first_name) == ["dana", "dana", None, None]
    assert each(spark, values, N.last_name) == ["levi", "levi-cohen", None, None]


def test_legal_and_party_names_of_the_sample_document(spark):
    legal = lists(
        spark,
        [['עו"ד יצחק גולדשטיין ועו"ד ערן הלר'], ['עו"ד מיכל דלומי'], []],
        lambda c: N.legal_names(c, schema.TITLES, ["של"]),
    )
    assert legal == [["יצחק גולדשטיין", "ערן הלר"], ["מיכל דלומי"], []]
    party = lists(
        spark,
        [['אי.סי.אם יצרני מיזוג אויר בע"מ (בפירוק)', "כונס הנכסים הרשמי"]],
        N.party_names,
    )
    assert party == [['אי.סי.אם יצרני מיזוג אויר בע"מ', "כונס הנכסים הרשמי"]]


def test_three_token_legal_names_are_blanked(spark):
    assert lists(spark, [["dana levi cohen"]], lambda c: N.legal_names(c, ["x"], ["y"])) == [[""]]
