import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from docketeer import schema
from docketeer.operators import bayes, cooccur, joins, sampling, terms
from docketeer.operators import grams as G
from docketeer.plans import enrich, reports
from docketeer.session import new_folder
from docketeer.sources import sinks


@pytest.fixture(scope="module")
def labelled(spark):
    rows = [(i, "abc"[min(i % 5, 2)]) for i in range(203)]
    return spark.createDataFrame(rows, "id long, category string")


def test_train_test_split_sizes(labelled):
    rows = sampling.train_test_split(labelled, "id", ["category"], 0.3, 1)
    got = {(r.category, r.part): r["count"] for r in rows.groupBy("category", "part").count().collect()}
    sizes = {r.category: r["count"] for r in labelled.groupBy("category").count().collect()}
    for c, n in sizes.items():
        assert got[c, "test"] == math.ceil(n * 0.3)
        assert got[c, "train"] == n - math.ceil(n * 0.3)


def test_a_split_keeps_rows_without_a_group(spark):
    rows = [(i, None if i % 3 else "a") for i in range(30)] + [(None, None), (None, "a")]
    df = spark.createDataFrame(rows, "id long, g string")
    got = sampling.train_test_split(df, "id", ["g"], 0.3, 1).collect()
    assert len(got) == len(rows)
    assert sum(r.g is None and r.part == "test" for r in got) == math.ceil(21 * 0.3)


def test_ranks_do_not_depend_on_buckets(labelled, monkeypatch):
    many = sampling.hash_ranks(labelled, "id", ["category"], 3).collect()
    monkeypatch.setattr(sampling, "BUCKET_DIGITS", 1)
    few = sampling.hash_ranks(labelled, "id", ["category"], 3).collect()
    assert sorted(map(tuple, many)) == sorted(map(tuple, few))
    assert sorted(r.rank for r in many if r.category == "a") == list(
        range(1, 1 + sum(r.category == "a" for r in many))
    )


def test_one_vs_rest_is_split_and_balanced(spark, labelled):
    # One text in two categories counts for both sides.
    rows = labelled.unionByName(spark.createDataFrame([(0, "b")], "id long, category string"))
    split = sampling.one_vs_rest_split(rows, "id", "category", ["a", "b", "c"], 0.3, 1)
    sides = defaultdict(list)
    for r in split.collect():
        sides[r.model, r.label, r.part].append(r.id)
    total = Counter(r.category for r in rows.collect())
    for model in "abc":
        own, rest = total[model], sum(total.values()) - total[model]
        tests = [math.ceil(n * 0.3) for n in (own, rest)]
        for label in (0, 1):
            assert len(sides[model, label, "test"]) == min(tests)
            assert len(sides[model, label, "train"]) == min(own - tests[0], rest - tests[1])
        mine = {r.id for r in rows.collect() if r.category == model}
        assert set(sides[model, 1, "train"] + sides[model, 1, "test"]) <= mine
        assert not set(sides[model, 1, "train"]) & set(sides[model, 1, "test"])


TEXTS = [
    (1, "the court of the tax appeal", 1),
    (2, "tax appeal court", 1),
    (3, "family law of the child", 0),
    (4, "the child law family", 0),
]


def grams(text, n):
    w = re.findall(r"\w\w+", text.lower())
    return Counter(" ".join(w[i : i + n]) for i in range(len(w) - n + 1))


class Plain:
    """The formulas, one text at a time."""

    def __init__(self, rows, n):
        self.n, docs = n, [(grams(t, n), y) for _, t, y in rows]
        df = Counter(t for d, _ in docs for t in d)
        self.idf = {t: math.log((1 + len(docs)) / (1 + f)) + 1 for t, f in df.items()}
        sums = [Counter(), Counter()]
        for d, y in docs:
            for t, w in self.weights(d).items():
                sums[y][t] += w
        self.log_p = [
            {t: math.log((s[t] + 1) / (sum(s.values()) + len(df))) for t in df} for s in sums
        ]
        self.prior = [math.log(sum(y == c for _, y in docs) / len(docs)) for c in (0, 1)]

    def weights(self, d):
        x = {t: f * self.idf[t] for t, f in d.items() if t in self.idf}
        norm = math.sqrt(sum(v * v for v in x.values()))
        return {t: v / norm for t, v in x.items()}  # an empty text has none

    def p(self, text):
        w = self.weights(grams(text, self.n))
        # Without a known term the priors decide.
        j = [self.prior[c] + sum(v * self.log_p[c][t] for t, v in w.items()) for c in (0, 1)]
        return 1 / (1 + math.exp(j[0] - j[1]))


@pytest.fixture(scope="module")
def fitted(spark):
    docs = spark.createDataFrame([t[:2] for t in TEXTS], "id long, text string")
    rows = [(m, n, y, i) for m, n in (("tax", 1), ("all", 2)) for i, _, y in TEXTS]
    members = spark.createDataFrame(rows, "model string, n int, label int, id long")
    return docs, bayes.fit(members, docs, "id", "text", named=True)


def test_fit_follows_the_formulas(fitted):
    _, model = fitted
    for name, n in (("tax", 1), ("all", 2)):
        plain = Plain(TEXTS, n)
        rows = model.terms.where(F.col("model") == name).collect()
        assert len(rows) == len(plain.idf)
        assert {r.gram for r in rows} == set(plain.idf)
        for r in rows:
            t = r.gram
            assert r.idf == pytest.approx(plain.idf[t])
            assert (r.log_p0, r.log_p1) == pytest.approx((plain.log_p[0][t], plain.log_p[1][t]))
    assert {(r.model, r.n_docs) for r in model.classes.collect()} == {("tax", 4), ("all", 4)}


def test_a_text_may_be_in_a_data_set_more_than_once(spark):
    rows = [*TEXTS, (1, TEXTS[0][1], 0), (3, TEXTS[2][1], 0), (2, TEXTS[1][1], 1), (4, TEXTS[3][1], 1)]
    docs = spark.createDataFrame([t[:2] for t in TEXTS], "id long, text string")
    members = spark.createDataFrame(
        [("m", 1, y, i) for i, _, y in rows], "model string, n int, label int, id long"
    )
    plain, model = Plain(rows, 1), bayes.fit(members, docs, "id", "text", named=True)
    assert model.classes.first().n_docs == 8
    for r in model.terms.collect():
        t = r.gram
        assert r.idf == pytest.approx(plain.idf[t])
        assert (r.log_p0, r.log_p1) == pytest.approx((plain.log_p[0][t], plain.log_p[1][t]))
    scored = {r.id: r.p for r in bayes.score(docs, model, "id", "text", [1]).collect()}
    assert scored == pytest.approx({i: plain.p(t) for i, t, _ in TEXTS})
    predicted = bayes.predict(members, docs, model, "id", "text")
    assert predicted.count() == 8
    assert all(r.p == pytest.approx(scored[r.id]) for r in predicted.collect())


def test_scores_and_choice(spark, fitted):
    _, model = fitted
    texts = [(1, "an appeal to the tax court"), (2, "Child law"), (3, ""), (4, "unseen words")]
    docs = spark.createDataFrame(texts, "id long, text string")
    scores = bayes.score(docs, model, "id", "text", [1, 2])
    got = {(r.id, r.model): r.p for r in scores.collect()}
    want = {
        (i, m): Plain(TEXTS, n).p(t)
        for i, t in texts
        for m, n in (("tax", 1), ("all", 2))
    }
    assert got == pytest.approx(want)
    chosen = {r.id: r.category for r in bayes.choose_category(docs, scores, "id", ["tax", "all"]).collect()}
    best = "tax" if got[1, "tax"] > got[1, "all"] else "all"
    assert chosen == {1: best, 2: "Inconclusive", 3: "Inconclusive", 4: "Inconclusive"}


def test_a_tie_goes_to_the_later_category(spark):
    docs = spark.createDataFrame([(1,), (2,)], "id int")
    scores = spark.createDataFrame(
        [(1, "a", 0.7), (1, "b", 0.7), (2, "a", 0.5), (2, "b", 0.4)], "id int, model string, p double"
    )
    for order, winner in ((["a", "b"], "b"), (["b", "a"], "a")):
        got = bayes.choose_category(docs, scores, "id", order).collect()
        assert {r.id: r.category for r in got} == {1: winner, 2: schema.INCONCLUSIVE}


def test_model_tables_round_trip(spark, fitted):
    docs, model = fitted
    path = new_folder(spark, "model")
    sinks.save_model(model, path)
    loaded = sinks.load_model(spark, path)
    assert sorted(loaded.terms.columns) == sorted(model.terms.columns)
    before = {(r.id, r.model): r.p for r in bayes.score(docs, model, "id", "text", [1, 2]).collect()}
    after = {(r.id, r.model): r.p for r in bayes.score(docs, loaded, "id", "text", [1, 2]).collect()}
    assert before == pytest.approx(after)


def test_scoring_leaves_a_stored_model_where_it_is(spark, fitted):
    docs, model = fitted
    path = new_folder(spark, "model")
    sinks.save_model(model, path, buckets=8)
    loaded = sinks.load_model(spark, path)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plans = []
        for m in (loaded, model):
            known = bayes._known(docs.select("id", F.array(G.cell(F.lit(1), F.lit(1))).alias("cells"), G.token_hashes(F.col("text")).alias("words")), m, "id")
            joined = bayes._leads(known, m, "id")
            plans.append(joined._jdf.queryExecution().executedPlan().toString())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
    # The texts' terms alone are moved to the join, by its three keys; the plain table is moved too.
    moves = [len(re.findall(r"Exchange hashpartitioning\(n#\d+, _t1#\d+L, _t2#\d+L", p)) for p in plans]
    assert moves == [1, 2]
    assert "Bucketed: true" in plans[0]


def test_terms_are_moved_once_to_where_they_are_stored(spark):
    """The same model, which the sums of its terms alone are shuffled for."""
    docs = spark.createDataFrame([t[:2] for t in TEXTS], "id long, text string")
    rows = [(m, n, y, i) for m, n in (("tax", 1), ("all", 2), ("more", 2)) for i, _, y in TEXTS]
    members = spark.createDataFrame(rows, "model string, n int, label int, id long")
    whole, left = (bayes.fit(members, docs, "id", "text", stored=s) for s in (True, False))
    columns = ["cell", "model", "n", "t1", "t2", "df", *(F.round(c, 9) for c in ("idf", "log_p0", "log_p1"))]
    got, want = (Counter(map(tuple, m.terms.select(columns).collect())) for m in (left, whole))
    assert got == want and got
    assert sorted(map(str, left.classes.collect())) == sorted(map(str, whole.classes.collect()))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    plan = left.terms.repartition(parts, *sinks.TERM_KEY)._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"Exchange hashpartitioning\(n#\d+, t1#\d+L, t2#\d+L", plan)) == 1
    assert not re.findall(r"Exchange hashpartitioning\([^)]*cell#", plan)


@pytest.mark.parametrize("rows", [0.5, 2, 100_000])
def test_hot_terms_count_like_others(spark, fitted, monkeypatch, rows):
    docs, model = fitted
    want = {(r.id, r.model): r.p for r in bayes.score(docs, model, "id", "text", [1, 2]).collect()}
    monkeypatch.setattr(joins, "TASK_ROWS", rows)
    monkeypatch.setattr(joins, "TASK_SHARE", 0)
    got = {(r.id, r.model): r.p for r in bayes.score(docs, model, "id", "text", [1, 2]).collect()}
    assert got == pytest.approx(want)


def test_report(spark):
    rows = [(1, 1)] * 6 + [(1, 0)] * 2 + [(0, 1)] + [(0, 0)] * 3
    df = spark.createDataFrame([("m", 1, *r) for r in rows], "model string, n int, label int, predicted int")
    got = {r["class"]: r for r in bayes.classification_report(df).collect()}
    assert (got["1"].precision, got["1"].recall, got["1"].support) == pytest.approx((6 / 7, 6 / 8, 8))
    assert got["0"].f1 == pytest.approx(2 * 3 / (5 + 4))
    assert got["accuracy"].f1 == pytest.approx(0.75) and got["accuracy"].precision is None
    assert got["macro avg"].recall == pytest.approx((6 / 8 + 3 / 4) / 2)
    assert got["weighted avg"].precision == pytest.approx((6 / 7 * 8 + 3 / 5 * 4) / 12)
    one = spark.createDataFrame([("m", 1, 1, 0)], "model string, n int, label int, predicted int")
    got = {r["class"]: r for r in bayes.classification_report(one).collect()}
    assert (got["0"].precision, got["0"].recall, got["1"].precision) == (0, 0, 0)


def test_train_and_classify(spark):
    rows = [(i, "tax appeal court levy" if i % 2 else "child law family home", i % 2) for i in range(20)]
    df = spark.createDataFrame(
        [(str(i), t, "Civil" if y else "Family") for i, t, y in rows], "id string, summary string, category string"
    )
    sizes = {"Civil": 2, "Family": 1}
    model, test = enrich.train(df, "id", "summary", "category", sizes)
    assert test.groupBy("model", "label").count().where("count = 3").count() == 4
    flat = spark.createDataFrame(
        [("x", "tax appeal court", None, None), ("y", "family home", None, None), ("z", "nothing known", None, None), ("w", None, None, None)],
        "id string, summary string, category string, error_reason string",
    )
    got = {r.id: (r.category, r.error_reason) for r in enrich.classify(flat, model, sizes).collect()}
    assert got == {
        "x": ("Civil", None),
        "y": ("Family", None),
        "z": ("Inconclusive", None),
        "w": (None, "missing summary"),
    }


def test_search_has_every_cell(spark):
    rows = [(i, f"tax court w{i % 3}" if i % 2 else f"child law w{i % 3}", "ab"[i % 2]) for i in range(20)]
    df = spark.createDataFrame(rows, "id long, text string, category string")
    split = sampling.one_vs_rest_split(df, "id", "category", ["a", "b"], 0.3)
    got = bayes.ngram_search(split, df, "id", "text", [1, 2, 5]).where("class = 'accuracy'").collect()
    cells = {(r.model, r.n): r.f1 for r in got}
    assert len(cells) == 6 and cells["a", 1] == cells["b", 2] == 1.0
    # No text has five tokens: every prior is even, so class 0 is said throughout.
    assert cells["a", 5] == 0.5


def test_search_says_what_whole_models_say(spark):
    """A search fits with the terms of its test texts alone; whole models give the same report."""
    chance = random.Random(2)
    words = [f"w{i}" for i in range(30)]
    rows = [(i, " ".join(chance.choices(words[i % 3 * 8 :], k=chance.randint(0, 40))), "abc"[i % 3]) for i in range(60)]
    # A text in two categories, a repeated row, and a key with two texts.
    rows += [(0, rows[0][1], "b"), (5, rows[5][1], "c"), (7, "w1 w2 other", "b")]
    df = spark.createDataFrame(rows, "id long, text string, category string")
    split = sampling.one_vs_rest_split(df, "id", "category", ["a", "b", "c"], 0.3)
    sizes = [1, 2, 3, 7]
    found = bayes.ngram_search(split, df, "id", "text", sizes)
    members = bayes.with_every_size(split, sizes)
    train, test = (members.where(F.col("part") == p).drop("part") for p in ("train", "test"))
    model = bayes.fit(train, df, "id", "text")
    want = bayes.classification_report(bayes.predict(test, df, model, "id", "text"))
    plain = lambda d: {tuple(r)[:3]: [x and round(x, 9) for x in tuple(r)[3:]] for r in d.collect()}
    assert plain(found) == plain(want)
    assert len({r.n for r in found.collect()}) == 4


def test_ngram_counts_of_all_sizes():
    chance = random.Random(1)
    for _ in range(200):
        texts = [[chance.randint(0, 3) for _ in range(chance.choice([0, 1, 2, 5, 30]))] for _ in range(chance.randint(1, 6))]
        a = np.array([x for t in texts for x in t], np.int64) * 7919
        if not len(a):
            continue
        offsets = np.cumsum([0, *map(len, texts)])
        sizes = sorted(chance.sample(range(1, 11), chance.randint(1, 6)))
        got, hashes = {}, {}
        with np.errstate(over="ignore"):
            for n, place, count, t1, t2 in G.counted(a, a * 31 + 5, offsets, sizes):
                text = np.searchsorted(offsets, place, side="right") - 1
                assert (np.diff(text) >= 0).all()
                for i, k in enumerate(text.tolist()):
                    at = int(place[i] - offsets[k])
                    gram = tuple(texts[k][at : at + n])
                    assert (k, gram) not in got and len(gram) == n
                    got[k, gram] = int(count[i])
                    assert hashes.setdefault(gram, (int(t1[i]), int(t2[i]))) == (int(t1[i]), int(t2[i]))
        want = Counter((k, tuple(t[i : i + n])) for k, t in enumerate(texts) for n in sizes for i in range(len(t) - n + 1))
        assert got == want
        assert len(set(hashes.values())) == len(hashes)


def test_a_filter_passes_what_it_holds(spark):
    """The rows that pass have all wanted terms, and the others come as sums."""
    texts = spark.createDataFrame([(i, f"aa bb cc w{i} w{i} aa") for i in range(9)], "id long, text string")
    cells = F.array(G.cell(F.lit(1), F.lit(4)), G.cell(F.lit(2), F.lit(5)))
    held = texts.select("id", cells.alias("cells"), G.token_hashes(F.col("text")).alias("words"))
    rows = G.gram_rows(held, "id")
    wanted = rows.groupBy("cell", "t1", "t2").agg(F.count("*").alias("df")).where("df > 1")
    some = G.gram_rows(held, "id", G.term_filter(wanted, "cell"), rest=True)
    assert some.where("not rest").join(wanted, ["cell", "t1", "t2"], "left_semi").count() == 9 * (3 + 2)
    total = lambda d: {tuple(r) for r in d.groupBy("id", "cell").agg(F.sum(F.coalesce("n_terms", F.lit(1))), F.sum(F.coalesce("sum_tf", "tf")), F.sum(F.coalesce("squares", F.expr("tf * tf")))).collect()}
    assert total(some) == total(rows)


def test_a_filter_grows_with_its_terms(spark, monkeypatch):
    monkeypatch.setattr(G, "FILTER_BITS", 1 << 10)
    monkeypatch.setattr(G, "MOST_BITS", 1 << 14)
    texts = spark.createDataFrame([(i, f"w{i} v{i}") for i in range(600)], "id long, text string")
    held = texts.select("id", F.array(G.cell(F.lit(1), F.lit(4))).alias("cells"), G.token_hashes(F.col("text")).alias("words"))
    rows = G.gram_rows(held, "id")
    wanted = rows.where("id < 300").select("cell", "t1", "t2")
    likely = G.term_filter(wanted, "cell")
    assert 64 * len(likely.value) == 1 << 13
    some = G.gram_rows(held, "id", likely, columns=["id", "t1"])
    assert some.columns == ["id", "t1"]
    assert some.where("id < 300").count() == 600 and some.where("id >= 300").count() < 120
    assert [64 * len(G.term_filter(wanted.limit(n), "cell").value) for n in (1, 128, 129)] == [1 << 10, 1 << 10, 1 << 11]


def test_a_search_counts_only_terms_of_several_texts_by_name(spark, monkeypatch):
    """The same terms as of a plain fit, also where members come twice; no full name is moved unfiltered."""
    docs = spark.createDataFrame([t[:2] for t in TEXTS], "id long, text string")
    rows = [(m, n, y, i) for m, n in (("tax", 1), ("all", 2), ("more", 2)) for i, _, y in TEXTS]
    kinds = "model string, n int, label int, id long"
    # Some train twice in a cell, some are of both parts, and some test in one model and train in others.
    train = spark.createDataFrame([r for k, r in enumerate(rows) if k % 3] + rows[1::5], kinds)
    test = spark.createDataFrame([r for k, r in enumerate(rows) if k % 3 == 0] + rows[2::7], kinds)
    moved = []
    whole = G.gram_rows

    def gram_rows(texts, key, likely=None, rest=False, by="cell", columns=None):
        if likely is None:
            moved.append(columns)
        return whole(texts, key, likely, rest, by, columns)

    plain = bayes.fit(train, docs, "id", "text")
    monkeypatch.setattr(G, "gram_rows", gram_rows)
    search = bayes.fit(train, docs, "id", "text", test)
    assert moved == [["cell", "copies", "t1"]]
    columns = ["model", "n", "t1", "t2", "df", *(F.round(c, 9) for c in ("idf", "log_p0", "log_p1"))]
    got, want = (Counter(map(tuple, m.terms.select(columns).collect())) for m in (search, plain))
    assert not got - want
    # Of what is left out, nothing is of several members or in a test text.
    texts = {i: {n: grams(t, n) for n in (1, 2)} for i, t, _ in TEXTS}
    assert len(got) == sum(
        sum(c > 1 or g in asked for g, c in counts.items())
        for m, n in (("tax", 1), ("all", 2), ("more", 2))
        for counts, asked in [(
            Counter(g for r in train.collect() if r.model == m for g in texts[r.id][n]),
            {g for r in test.collect() if r.model == m for g in texts[r.id][n]},
        )]
    )
    assert sorted(map(str, search.classes.collect())) == sorted(map(str, plain.classes.collect()))


def test_tfidf_with_a_hot_term(spark):
    docs = spark.createDataFrame([(i, f"the w{i} w{i % 3}") for i in range(50)], "id long, text string")
    got = {(r.id, r.term): r.weight for r in terms.tfidf(docs, "id", "text").collect()}
    counts = [grams(f"the w{i} w{i % 3}", 1) for i in range(50)]
    df = Counter(t for c in counts for t in c)
    for i, c in enumerate(counts):
        x = {t: f * (math.log(51 / (1 + df[t])) + 1) for t, f in c.items()}
        norm = math.sqrt(sum(v * v for v in x.values()))
        assert {t: got[i, t] for t in x} == pytest.approx({t: v / norm for t, v in x.items()})


def test_term_ranks(spark):
    text = " ".join(f"t{i:02} " * (70 - i) for i in range(70))
    docs = spark.createDataFrame([(1, text)], "id long, text string")
    weights = terms.document_term_weights(docs, "id", "text")
    got = [r.term for r in terms.ranked_terms(weights, "id").orderBy("rank").collect()]
    assert got == [f"t{i:02}" for i in range(30, 60)]


def test_indicators_and_correlations(spark):
    rows = [
        (1, ["a", "x"], "Civil"),
        (2, ["a", "b"], "Civil"),
        (3, ["b"], "Family"),
        (4, ["c"], "Family"),
        (5, None, "Family"),
        (6, ["b", ""], "Tax"),
    ]
    df = spark.createDataFrame(rows, "id int, judges array<string>, category string")
    table = cooccur.indicator_table(df, "id", "judges", "category", ["b", "a"], ["Civil", "Family", "Tax"])
    cells = {r.id: tuple(r)[1:] for r in table.collect()}
    assert cells == {
        1: (False, True, True, False, False),
        2: (True, True, True, False, False),
        3: (True, False, False, True, False),
        6: (True, False, False, False, True),
    }
    columns = [("name", "b"), ("name", "a"), *(("category", c) for c in ("Civil", "Family", "Tax", "Never"))]
    rows = cooccur.correlations(df, {"judges": ["b", "a"]}, "category", ["Civil", "Family", "Tax", "Never"]).collect()
    corr = {((r.kind_a, r.feature_a), (r.kind_b, r.feature_b)): r["corr"] for r in rows}
    matrix = np.corrcoef(np.array(list(cells.values()), dtype=float).T)
    for i, a in enumerate(columns[:5]):
        for j in range(i + 1, 5):
            assert corr[a, columns[j]] == pytest.approx(matrix[i, j])
    assert len(corr) == 15 and all(corr[a, columns[5]] is None for a in columns[:5])
    top = reports.name_category_correlations(df, "judges", 2, 3)
    assert top.count() == 6
    assert top.where("sign = 'positive' AND rank = 1").first()["corr"] == pytest.approx(1.0)


def test_columns_are_correlated_apart(spark):
    """Several columns in one pass; a name that reads like a category is a feature of its own."""
    rows = [(["x", "Tax"], ["y"], "Tax"), (["x"], ["y", "y"], "Civil"), (["Tax"], [], "Civil"), (None, ["z", ""], None)]
    df = spark.createDataFrame(rows, "a array<string>, b array<string>, category string")
    top = cooccur.top_names_by_column(df, ["a", "b"], 2)
    assert top == {"a": ["Tax", "x"], "b": ["y", "z"]}
    got = cooccur.correlations(df, top, "category", ["Tax", "Civil"]).collect()
    assert len(got) == 2 * 6
    corr = {(r.column, r.kind_a, r.feature_a, r.kind_b, r.feature_b): r["corr"] for r in got}
    cells = {"a": [[1, 1, 1, 0], [0, 1, 0, 1], [1, 0, 0, 1]], "b": [[1, 0, 1, 0], [1, 0, 0, 1], [0, 1, 0, 0]]}
    for column, table in cells.items():
        features = [("name", n) for n in top[column]] + [("category", "Tax"), ("category", "Civil")]
        matrix = np.corrcoef(np.array(table, float).T)
        for i, one in enumerate(features):
            for j in range(i + 1, 4):
                assert corr[column, *one, *features[j]] == pytest.approx(matrix[i, j])
    assert cooccur.correlations(df.limit(0), {"a": [], "b": []}, "category", ["Tax"]).count() == 0


def test_tfidf_makes_its_texts_once(spark):
    """A text costs one reading, however often its terms are needed."""
    read = spark.sparkContext.accumulator(0)
    texts = [(i, " ".join(f"w{j}" for j in range(i % 7 + 2))) for i in range(50)]

    def said(text):
        read.add(1)
        return text

    docs = spark.createDataFrame(texts, "id long, text string").withColumn("text", F.udf(said, "string")("text"))
    got = terms.tfidf(docs, "id", "text", 1).collect()
    assert len(got) == sum(len(t.split()) for _, t in texts)
    assert read.value == len(texts)


def test_texts_of_a_small_table_are_worked_on_by_all_cores(spark):
    """N-grams of many sizes are many times the texts, whose size alone would make one task of them."""
    docs = spark.createDataFrame([(i, f"some words of text {i}") for i in range(200)], "id long, text string").coalesce(1)
    cells = docs.select("id", G.cell(F.lit(1), F.lit(1)).alias("_cell"))
    texts = bayes._hashed_members(docs, cells, "id", "text")
    held = [r["n"] for r in texts.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    assert len(held) >= spark.sparkContext.defaultParallelism / 2 and sum(held) == 200
