import random

import pytest
from pyspark.sql import functions as F

from docketeer.functions import names as N
from docketeer.operators import joins, lookup, roster, tokens


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, last = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(row[-1] + 1, last[j] + 1, last[j - 1] + (x != y)))
    return row[-1]


def words(rng, n):
    return ["".join(rng.choices("אבג", k=rng.randint(0, 5))) for _ in range(n)]


@pytest.mark.parametrize("edits", [0, 1, 2])
def test_fuzzy_members_against_every_pair(spark, edits):
    rng = random.Random(edits)
    left, right = words(rng, 60), words(rng, 12)
    df = spark.createDataFrame(list(enumerate(left)), "i int, w string")
    items = spark.createDataFrame([(w,) for w in right], "w string")
    got = joins.fuzzy_members(df, "w", items, "w", edits)
    assert {(r.i, r.is_member) for r in got.collect()} == {
        (i, any(distance(w, x) <= edits for x in right)) for i, w in enumerate(left)
    }


@pytest.mark.parametrize("edits", [1, 2])
def test_long_words_go_by_their_edits(spark, monkeypatch, edits):
    """Looking for the edits gives what the distance does."""
    monkeypatch.setattr(joins, "SHORT_WORD", -1)
    rng = random.Random(edits)
    pairs = [(a, b) for a in words(rng, 25) for b in words(rng, 12)]
    df = spark.createDataFrame(pairs, "a string, b string")
    rows = df.select("a", "b", joins.within_edits("a", "b", edits).alias("x")).collect()
    assert [r.x for r in rows] == [distance(a, b) <= edits for a, b in pairs]


def test_long_words_have_few_keys(spark):
    long = "x" * 100_000
    df = spark.createDataFrame([(long,), (long[:-2] + "yx",), (long + "zz",)], "w string")
    items = spark.createDataFrame([(long[1:],)], "w string")
    got = joins.fuzzy_members(df, "w", items, "w", 1).collect()
    assert [r.is_member for r in sorted(got, key=lambda r: r.w)] == [True, False, True]
    keys = df.select(F.size(joins.probe_keys(F.col("w"), 1)).alias("n")).collect()
    assert max(r.n for r in keys) <= 18


def test_lookup_spreads_a_hot_key(spark, monkeypatch):
    monkeypatch.setattr(joins, "TASK_ROWS", 100)
    # One key holds half of the rows.
    left = spark.range(4000).select(
        "id", F.when(F.col("id") % 2 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k")
    )
    right = spark.createDataFrame([("hot", 1), ("3", 2), ("none", 3)], "k string, v int")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        known = left.groupBy("k").agg(F.count(F.lit(1)).alias("n_rows"))
        assert [tuple(r) for r in joins.hot_keys(known, ["k"], "n_rows").collect()] == [("hot", 20)]
        out = joins.lookup(left, right, ["k"], ["id"], counts=known)
        rows = out.collect()
        inner = joins.lookup(left, right, ["k"], ["id"], "inner", known).collect()
        plain = joins.lookup(left, right, ["k"], ["id"]).collect()
        assert sorted(map(str, plain)) == sorted(map(str, rows))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert out.columns == ["k", "id", "v"]
    assert sorted((r.id, r.v) for r in rows) == [
        (i, 1 if i % 2 == 0 else 2 if i == 3 else None) for i in range(4000)
    ]
    assert len(inner) == 2001


def fits(name, line):
    parts = name.replace("'", "").replace("’", "").split()
    entry = line.split()
    if len(entry) == 2:
        halves = entry[1].split("-")
        surnames = [entry[1], *(halves if len(halves) == 2 else [])]
    elif len(entry) == 3:
        surnames = entry[1:]
    else:
        return False
    return entry[0][0] == parts[0][0] and any(distance(s, parts[1]) <= 1 for s in surnames)


def fixed(names, lines):
    if not names:
        return None
    return [
        next((line for line in lines if fits(n, line)), n)
        for n in names
        if len(n.replace("'", "").split()) >= 2
    ]


LINES = [
    "אהרן ברק",
    "עידית איצקוביץ-שחר",
    "בן ציון שרשבסקי",
    "אליקים רובינשטיין",
    "עודד שחם",
    "נעם סולברג",
    "",
    "אחת",
    "יצחק עמית",
]


def test_roster_both_ways(spark):
    lines = spark.createDataFrame(list(enumerate(LINES)), "pos int, line string")
    lists = [
        ["א' רובינשטיין", "י' עמית", "נ' סולברג"],
        ["עודד שחם"],
        ["א"],
        [],
        ["ב' ציון", "ב שרשבסקיי", "ג'ורג' קרא", "א ברקק", "א בר"],
        ["עודד שחם"] * 3,
    ]
    want = [fixed(n, LINES) for n in lists]
    assert want[0] == ["אליקים רובינשטיין", "יצחק עמית", "נעם סולברג"]
    assert want[1] == ["עידית איצקוביץ-שחר"]
    assert want[2:4] == [[], None]
    df = spark.createDataFrame(list(enumerate(lists)), "id int, names array<string>")
    joined = roster.match_roster_lists(df, "names", "out", lines)
    literal = roster.fix_judges(df, "names", "out", lines)
    for out in (joined, literal):
        assert [r.out for r in out.orderBy("id").collect()] == want


@pytest.mark.parametrize("clean", [False, True])
def test_rows_that_share_an_id_keep_their_own_lists(spark, monkeypatch, clean):
    lines = spark.createDataFrame(list(enumerate(LINES)), "pos int, line string")
    rows = [(1, ["י' עמית"]), (1, ["עודד שחם", "א"]), (None, ["עודד שחם"]), (None, None)]
    df = spark.createDataFrame(rows, "id int, names array<string>")
    literal = roster.fix_judges(df, "names", "out", lines, clean).collect()
    monkeypatch.setattr(roster, "LITERAL_LINES", 1)
    joined = roster.fix_judges(df, "names", "out", lines, clean).collect()
    assert sorted(map(str, literal)) == sorted(map(str, joined)) and len(joined) == 4
    by_names = {tuple(r.names or ()): r.out for r in joined}
    # The very surname comes first in the clean form, and a lone token stays.
    want = ["עודד שחם", "א"] if clean else ["עידית איצקוביץ-שחר"]
    assert by_names["עודד שחם", "א"] == want


def test_long_rosters_are_joined(spark, monkeypatch):
    monkeypatch.setattr(roster, "LITERAL_LINES", 3)
    lines = spark.createDataFrame(list(enumerate(LINES)), "pos int, line string")
    assert roster.small_roster(lines) is None
    df = spark.createDataFrame([(1, ["י' עמית"])], "id int, names array<string>")
    assert roster.fix_judges(df, "names", "o", lines).first().o == ["יצחק עמית"]


def test_older_rule_and_preparation(spark):
    lines = spark.createDataFrame(list(enumerate(LINES)), "pos int, line string")
    df = spark.createDataFrame([("י עמית",), ("י עמיתי",), ("יצחק",), ("א ב ג",)], "name string")
    got = {r.name: r.matched for r in roster.match_surname(df, "name", lines).collect()}
    assert got == {"י עמית": "יצחק עמית", "י עמיתי": "י עמיתי", "יצחק": "יצחק", "א ב ג": "א ב ג"}
    ready = {r.pos: r.line for r in roster.prepare_roster(lines).collect()}
    assert ready[2] == "שרשבסקי בן-ציון" and 6 not in ready and 7 not in ready


def test_remove_listed_tokens(spark):
    df = spark.createDataFrame([(1, "a b  a c"), (2, "a"), (3, ""), (4, None)], "k int, t string")
    listed = spark.createDataFrame([("a",), ("a",), ("x",)], "w string")
    got = tokens.remove_listed_tokens(df, ["k"], "t", listed, "w")
    assert sorted((r.k, r.t) for r in got.collect()) == [(1, "b c"), (2, ""), (3, ""), (4, "")]


def test_dictionary(spark):
    start = spark.createDataFrame([("a", "A")], "before string, after string")
    rows = [
        (2, ["b", "c"], ["B2", "C2"]),
        (1, ["b", "a"], ["B1", "A1"]),
        (3, ["d"], ["D", "D"]),
        (4, None, ["E"]),
    ]
    df = spark.createDataFrame(rows, "id int, judges array<string>, fixed array<string>")
    pairs = lookup.dictionary_pairs(df, "judges", "fixed", F.col("id"))
    got = {r.before: r.after for r in lookup.upsert_first(start, pairs).collect()}
    assert got == {"a": "A", "b": "B1", "c": "C2"}
    docs = spark.createDataFrame(
        [(1, ["a", "z", None, "a"], None), (2, [], ["a"])],
        "id int, judges array<string>, defense array<string>",
    )
    found = lookup.lookup_names(docs, "id", ["judges", "defense"], start).orderBy("id").collect()
    assert found[0].judges_normalized == ["A", None, None, "A"]
    assert found[0].defense_normalized is None
    assert found[1].judges_normalized == [] and found[1].defense_normalized == ["A"]


def test_category_assignment(spark):
    listed = spark.createDataFrame(
        [("12/20", "Civil", "Family"), ("012/20", "Criminal", ""), ("7/19", "Labor", None)],
        "case_no string, category1 string, category2 string",
    )
    ids = spark.createDataFrame([("12-20-1",), ("12-20-2",), ("012-20-1",), ("8-19-1",)], "id string")
    got = lookup.assign_categories(listed, ids)
    assert sorted((r.id, r.category) for r in got.collect()) == [
        ("012-20-1", "Criminal"),
        ("12-20-1", "Civil"),
        ("12-20-1", "Family"),
        ("12-20-2", "Civil"),
        ("12-20-2", "Family"),
    ]


def test_lists_are_cleaned_by_the_tokens_that_may_be_listed(spark):
    """As the literal form has it; of the tokens only those a filter lets pass are shuffled."""
    rng = random.Random(3)
    blanks = [" ", "  ", "\t", "\n"]
    name = lambda: rng.choice(["", " "]) + "".join(w + rng.choice(blanks) for w in words(rng, rng.randint(0, 6)))
    names = lambda: rng.choice([None, [], [rng.choice([None, name()]) for _ in range(rng.randint(1, 5))]])
    rows = [(names(), names()) for _ in range(60)] + [(["א ב", "ב"], ["א ב", "ב"])] * 3
    df = spark.createDataFrame(rows, "u array<string>, v array<string>")
    listed = words(rng, 25) + ["ב", "ב", None, "\n", ""]
    table = spark.createDataFrame([(w,) for w in listed], "word string")
    got = tokens.remove_from_lists(df, ["u", "v"], table)
    short = [w for w in listed if w]
    # Null names go as well, as they have no token left.
    want = df.select(*(F.array_compact(N.without_words_each(F.col(c), short)).alias(c) for c in ("u", "v")))
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "_bits" in plan
    assert tokens.remove_from_lists(df, ["u"], table.where("false")).count() == len(rows)
