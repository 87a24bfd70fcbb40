import datetime
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from docketeer.operators import counts, nametext, tables
from docketeer.operators import order as order_by


def consumed(texts, names):
    out = [0] * len(names)
    for text in texts:
        for i, name in enumerate(names):
            if name in text:
                out[i] += 1
                text = text.replace(name, "")
            if not text.strip():
                break
    return out


@pytest.mark.parametrize("seed", [1, 8])
def test_consuming_counts_against_the_loop(spark, seed):
    rng = random.Random(seed)
    names = ["ab", "b", "", "a a", "aab", "ab", " ", "c", "ba"]
    texts = ["", " ", "aabb c", *("".join(rng.choices("abc ", k=rng.randint(1, 12))) for _ in range(80))]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    table = spark.createDataFrame(list(enumerate(names)), "pos int, name string")
    got = counts.consuming_counts(df, "t", table, "name").orderBy("pos").collect()
    assert [r.n for r in got] == consumed(texts, names)


def test_names_that_share_a_position_count_apart(spark):
    df = spark.createDataFrame([("a b",), ("c.*\\E a",)], "t string")
    table = spark.createDataFrame([(0, "a"), (0, "b"), (1, "c"), (2, ".*\\E"), (2, None)], "pos int, name string")
    got = counts.consuming_counts(df, "t", table, "name").collect()
    assert {(r.pos, r.name): r.n for r in got} == {(0, "a"): 2, (0, "b"): 1, (1, "c"): 1, (2, ".*\\E"): 1, (2, None): 0}
    assert counts.consuming_counts(df.limit(0), "t", table, "name").count() == 5
    assert counts.consuming_counts(df, "t", table.limit(0), "name").count() == 0


def test_an_erasure_forms_a_later_name(spark):
    df = spark.createDataFrame([("xabyz" + "q" * 30,), ("abab",)], "t string")
    table = spark.createDataFrame([(0, "ab"), (1, "xyz"), (2, "yq"), (3, "zqq")], "pos int, name string")
    got = counts.consuming_counts(df, "t", table, "name").collect()
    assert {r.name: r.n for r in got} == {"ab": 2, "xyz": 1, "yq": 0, "zqq": 0}


def test_many_names_and_many_empty_ones(spark):
    """100,000 empty names among as many others: each is met by the texts not emptied before it."""
    texts = ["n7", "n7 n9", "n50000x", "zz", "זהn3", "n99999 n5"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    names = spark.range(200_000).select(
        F.col("id").alias("pos"), F.when(F.col("id") % 2 == 0, "").otherwise(F.concat(F.lit("n"), (F.col("id") / 2).cast("int"))).alias("name")
    )
    got = counts.consuming_counts(df, "t", names, "name")
    held = [("" if i % 2 == 0 else f"n{i // 2}") for i in range(200_000)]
    want = {}
    for text in texts:
        for pos, name in enumerate(held):
            if name in text:
                want[pos] = want.get(pos, 0) + 1
                text = text.replace(name, "")
            if not text.strip():
                break
    assert {r.pos: r.n for r in got.where("n > 0").collect()} == want


def test_hashes_find_whole_names():
    """Every name that a text has is likely, and hashes tell names of one head apart."""
    names = ["a", "ab", "abc", "abcd", "abce", "abcdefghi", "x" * 33, "é", "xé", "שלום לך"]
    texts = ["xabcdéx", "", "abcdefghij", "x" * 32, "x" * 40, "שלום לך xé", "ab", "שלום"]
    with np.errstate(over="ignore"):
        hashes, lengths = {}, {}
        for name in names:
            data = np.frombuffer(name.encode(), np.uint8)
            w, h = list(nametext.windows(data, len(data)))[-1]
            hashes[name] = int(nametext.whole(h[:1], h[len(data) - w :][:1], np.array([len(data)])).view(np.int64)[0])
            lengths.setdefault(w, set()).add(len(data))
        assert len(set(hashes.values())) == len(names)
        every = np.full(1 << 19, (1 << 64) - 1, np.uint64)
        data = np.frombuffer("".join(texts).encode(), np.uint8)
        offsets = np.cumsum([0, *(len(t.encode()) for t in texts)])
        lists = {w: sorted(v) for w, v in lengths.items()}
        text, t1 = nametext.likely(data, offsets, lists, every, every)
    found = set(zip(text.tolist(), t1.tolist(), strict=True))
    for i, t in enumerate(texts):
        for name, h in hashes.items():
            assert ((i, h) in found) == (name in t)


def test_ranks_and_running_sums(spark):
    rng = random.Random(3)
    rows = [(i, rng.choice([None, "a", "b", "ab"]), rng.randint(0, 5)) for i in range(500)]
    df = spark.createDataFrame(rows, "id long, name string, n long").repartition(7)
    order = [F.col("name").asc_nulls_first(), F.col("n").desc(), F.col("id")]
    want = sorted(rows, key=lambda r: (r[1] is not None, r[1] or "", -r[2], r[0]))
    got = {r.id: r["rank"] for r in order_by.ranked(df, order).collect()}
    assert got == {r[0]: i + 1 for i, r in enumerate(want)}
    sums = {r.id: r.before for r in order_by.running_sums(df, order, "n", "before").collect()}
    assert sums == {r[0]: sum(x[2] for x in want[:i]) for i, r in enumerate(want)}
    assert order_by.ranked(df.limit(0), order).count() == 0


def test_normalized_name_counts(spark):
    docs = spark.createDataFrame(
        [(1, ["dana levi", "omer levi"], ["dana levi"]), (2, ["omer"], None)],
        "id int, judges array<string>, defense array<string>",
    )
    names = spark.createDataFrame(
        [(0, "dana levi", "dana", "levi"), (1, "omer levi", "omer", None)],
        "pos int, full_name string, first_name string, last_name string",
    )
    got = counts.normalized_name_counts(docs, "id", ["judges", "defense"], names)
    rows = [tuple(r)[-3:] for r in got.orderBy("pos").collect()]
    assert rows == [(2, 2, 2), (1, 2, 0)]


def test_names_and_tops(spark):
    df = spark.createDataFrame(
        [(1, ["a", "b", "a", ""]), (2, None), (3, ["c", "b"])], "id int, judges array<string>"
    )
    assert [tuple(r) for r in counts.top_names(df, "judges", 2).collect()] == [("a", 2), ("b", 2)]
    distinct = counts.distinct_names(df, "id", ["judges"])
    assert sorted(r.name for r in distinct.collect()) == ["", "a", "b", "c"]
    assert counts.names_per_role(distinct).first().n == 4


def test_categories(spark):
    labels = ["Civil - A", "Civil - A - B", "Civil - A", "Family", "Civil - A - B - C", "Tax - Q", "Tax"]
    df = spark.createDataFrame([(x,) for x in labels], "label string")
    main = {r.category: r.n for r in counts.category_counts(df, "label").collect()}
    assert main == {"Civil": 4, "Family": 1, "Tax": 2}
    subs = {(r.category, r.sub_category): r.n for r in counts.subcategory_counts(df, "label").collect()}
    assert subs == {
        ("Civil", "A"): 3,
        ("Civil", "A - B"): 1,
        ("Civil", "Civil Total"): 4,
        ("Tax", "Q"): 1,
        ("Tax", None): 1,
        ("Tax", "Tax Total"): 2,
        ("Family", None): 1,
        ("Family", "Family Total"): 1,
    }
    shares = {r.category: r.share for r in counts.category_shares(df, "label").collect()}
    assert shares["Civil"] == pytest.approx(4 / 7)


def test_dates(spark):
    rows = [(1, "1/2/2003"), (2, None), (3, "19/03/2012"), (4, "not a date")]
    df = spark.createDataFrame(rows, "id int, d string")
    span = counts.date_span(df, "d").first()
    assert (span.earliest, span.latest, span.dated) == (
        datetime.date(2003, 2, 1),
        datetime.date(2012, 3, 19),
        2,
    )
    assert [r.id for r in counts.undated(df, "id", "d").collect()] == [2, 4]
    empty = counts.date_span(df.where("id = 2"), "d").first()
    assert empty.latest == datetime.date(1, 1, 1) and empty.earliest.year >= 2024


def test_summary_steps_and_status(spark):
    df = spark.createDataFrame([("x", 1), ("x", None), ("y", 1)], "a string, b int")
    got = {r.column: (r["count"], r.unique, r.top, r.freq) for r in counts.column_summary(df, ["a", "b"]).collect()}
    assert got == {"a": (3, 2, "x", 2), "b": (2, 1, "1", 2)}
    made = {"all": lambda d: d, "some": lambda d: d.where("a = 'x'"), "kinds": lambda d: d.select("a").distinct()}
    result, steps = counts.step_counts(df, made)
    assert {r.step: r.n for r in steps.collect()} == {"all": 3, "some": 2, "kinds": 1}
    assert [r.a for r in result.collect()] == ["x"]
    _, steps = counts.step_counts(df.where("b > 5"), made)
    assert {r.step: r.n for r in steps.collect()} == {"all": 0, "some": 0, "kinds": 0}
    passed, seen = counts.watched(df.where("a = 'x'"), "some")
    passed.collect()
    assert seen.get == {"n": 2}
    status = counts.status_counts(df.withColumnRenamed("b", "error_reason"))
    assert {r.status: r.n for r in status.collect()} == {"failed": 2, "success": 1}


def test_unrepeated(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "a"), (4, None), (5, None)], "i int, v string")
    assert [tuple(r) for r in tables.only_unrepeated(df, ["v"]).collect()] == [(2, "b")]
    twice = df.select("v").unionByName(df.select("v"))
    assert tables.only_unrepeated(twice).count() == 0


def test_reshapes(spark):
    df = spark.createDataFrame([(1, "a|b"), (2, "c"), (3, None), (4, "")], "i int, v string")
    got = tables.explode_delimited(df, "v", "|", keep_whole=True)
    assert [tuple(r) for r in got.orderBy("i").collect()] == [(1, "a|b"), (1, "a"), (1, "b"), (2, "c"), (4, "")]
    few, many = tables.split_by_token_count(
        spark.createDataFrame([("a b c",), ("a  b c",), (None,)], "v string"), "v"
    )
    assert [r.v for r in few.collect()] == ["a b c"] and [r.v for r in many.collect()] == ["a  b c"]


def test_organize_rows(spark):
    rows = [(1, "a b c"), (2, "a-x b c"), (3, "a b c d"), (4, "a-x b c d"), (5, "a  b"), (6, "a b c d e")]
    df = spark.createDataFrame(rows, "i int, v string")
    got = sorted((r.i, r.pair, r.v) for r in tables.organize_rows(df, "v").collect())
    assert got == [
        (1, 0, "a b-c"),
        (2, 0, "b-c a-x"),
        (3, 0, "a b"),
        (3, 1, "c d"),
        (4, 0, "b a-x"),
        (4, 1, "d c"),
        (5, 0, "a  b"),
        (6, 0, "a b c d e"),
    ]


def test_sorting_puts_nulls_last(spark):
    df = spark.createDataFrame([(None,), ("b",), ("a",)], "v string")
    assert [r.v for r in tables.sorted_by(df, "v").collect()] == ["a", "b", None]
    assert [r.v for r in tables.first_rows(df, [F.col("v").desc()], 1).collect()] == ["b"]
