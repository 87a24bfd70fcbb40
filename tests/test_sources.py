import json

import pytest
from pyspark.sql import functions as F

from docketeer import schema
from docketeer.operators import roster
from docketeer.plans import enrich, files, reports
from docketeer.session import grouped_listings, new_folder, spread
from docketeer.sources import lists, sinks, verdicts
from docketeer.streaming import enrich as stream


def details(**changes):
    values = {
        "judges": ["א' רובינשטיין", "י' עמית"],
        "petitioner": ['בנק בע"מ (בפירוק)'],
        "defense": ["מדינת ישראל"],
        "petitioner_attorneys": ['עו"ד יצחק גולדשטיין ועו"ד ערן הלר'],
        "defense_attorneys": [],
        **changes,
    }
    out = {schema.ROLE_KEYS[r]: v for r, v in values.items() if r in schema.ROLE_KEYS}
    out[schema.SUMMARY_KEY] = values.get("summary", "tax appeal")
    out[schema.DATE_KEY] = "19/03/2012"
    out[schema.PAGES_KEY] = 3
    return out


def dump(i, category="Civil", **changes):
    doc = {"Doc Details": details(**changes), "Case Details": {"Category": category}}
    return {"_id": i, "_index": "x", "_type": "t", "_score": 1, "_source": {"doc": doc, "doc_as_upsert": True}}


def put(path, value):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(value if isinstance(value, str) else json.dumps(value, ensure_ascii=False), "utf-8")


ROSTER = ["אליקים רובינשטיין", "יצחק עמית"]


@pytest.fixture
def folder(tmp_path):
    put(tmp_path / "in" / "p.json", {"Doc Details": {**details(), "Category": "Tax"}})
    put(tmp_path / "in" / "d.json", dump("12-20-1"))
    put(tmp_path / "in" / "null.json", "null")
    put(tmp_path / "in" / "broken.json", "{not json")
    put(tmp_path / "in" / "list.json", {"Doc Details": details(judges=None)})
    put(tmp_path / "in" / "bare.json", {"other": 1})
    put(tmp_path / "in" / "skip.txt", "{}")
    return tmp_path


def roster_of(spark):
    return spark.createDataFrame(list(enumerate(ROSTER)), "pos int, line string")


def test_both_document_forms_and_failures(spark, folder):
    flat = verdicts.flatten_verdicts(verdicts.read_verdicts(spark, str(folder / "in")))
    out = enrich.normalize(flat, ["של"], roster_of(spark))
    rows = {r.file_name: r for r in out.collect()}
    assert len(rows) == 6
    assert {n: r.error_reason for n, r in rows.items()} == {
        "p.json": None,
        "d.json": None,
        "null.json": "not a JSON object",
        "broken.json": "not a JSON object",
        "list.json": "missing judges",
        "bare.json": "no document details",
    }
    good = rows["d.json"]
    assert (good.id, good.category, good.pages) == ("12-20-1", "Civil", 3)
    assert (rows["p.json"].id, rows["p.json"].category) == ("p", "Tax")
    for r in (good, rows["p.json"]):
        assert r.judges_normalized == ROSTER
        assert r.petitioner_normalized == ['בנק בע"מ']
        assert r.petitioner_attorneys_normalized == ["יצחק גולדשטיין", "ערן הלר"]
        assert r.defense_attorneys_normalized == []
    assert rows["list.json"].petitioner_normalized is None


@pytest.mark.parametrize("clean", [False, True])
def test_word_tables_do_what_lists_do(spark, folder, monkeypatch, clean):
    flat = verdicts.flatten_verdicts(verdicts.read_verdicts(spark, str(folder / "in")))
    words, titles = ["של", "ערן", "x"], ["עו\"ד", "ב\"כ"]
    table = lambda xs: spark.createDataFrame([(x,) for x in xs], "word string")
    plain = enrich.normalize(flat, words, roster_of(spark), titles, clean)
    monkeypatch.setattr(lists, "LITERAL_WORDS", 1)
    monkeypatch.setattr(lists.short_list, "__defaults__", (1,))
    joined = enrich.normalize(flat, table(words), roster_of(spark), table(titles), clean)
    columns = ["file_name", "error_reason", *(f"{r}_normalized" for r in schema.ROLES)]
    assert sorted(map(str, joined.select(columns).collect())) == sorted(map(str, plain.select(columns).collect()))


def test_a_dump_keeps_lines_without_an_id(spark, tmp_path):
    good = json.dumps(dump("a"), ensure_ascii=False)
    bare = json.dumps({k: v for k, v in dump("b").items() if k != "_id"}, ensure_ascii=False)
    put(tmp_path / "x" / "0.json", "\n".join([good, "{broken", bare, "null x", "{broken", bare]))
    flat = verdicts.flatten_verdicts(verdicts.read_index_dump(spark, str(tmp_path / "x")))
    rows = flat.collect()
    assert len(rows) == 6
    assert sum(r.error_reason == "not a JSON object" for r in rows) == 3


def test_repeated_ids_are_told(spark):
    rows = [("x", "tax court", 1), ("x", "child law", 1), (None, "tax court", 1)]
    flat = spark.createDataFrame([r[:2] for r in rows], "id string, summary string")
    flat = flat.selectExpr("*", "cast(null as string) category", "cast(null as string) error_reason")
    texts = [(str(i), "tax appeal court" if i % 2 else "child law", "Civil" if i % 2 else "Family") for i in range(12)]
    labelled = spark.createDataFrame(texts, "id string, summary string, category string")
    sizes = {"Civil": 1, "Family": 1}
    model, _ = enrich.train(labelled, "id", "summary", "category", sizes)
    got = enrich.classify(flat, model, sizes).collect()
    assert sorted(r.error_reason for r in got) == ["missing id", "repeated id", "repeated id"]
    assert all(r.category is None for r in got)


def test_written_verdicts_are_read_again(spark, folder):
    flat = verdicts.flatten_verdicts(verdicts.read_verdicts(spark, str(folder / "in")))
    out = enrich.normalize(flat, ["של"], roster_of(spark)).where("error_reason IS NULL")
    path = new_folder(spark, "verdicts")
    sinks.write_verdicts(out, path)
    again = verdicts.flatten_verdicts(verdicts.read_index_dump(spark, path))
    columns = ["id", "category", "judges", "judges_normalized", "defense_attorneys_normalized", "date_text"]
    assert sorted(map(tuple, again.select(columns).collect())) == sorted(
        map(tuple, out.select(columns).collect())
    )


def test_routed_tables(spark, folder):
    flat = verdicts.flatten_verdicts(verdicts.read_verdicts(spark, str(folder / "in")))
    path = new_folder(spark, "routed")
    sinks.write_routed(flat, path)
    rows = spark.read.parquet(path).groupBy("status").count().collect()
    assert {r.status: r["count"] for r in rows} == {"success": 3, "failed": 3}


def test_index_dump_keeps_the_last_line_of_an_id(spark, tmp_path):
    lines = [dump("a", "One"), dump("b", "Two"), dump("a", "Three")]
    put(tmp_path / "x" / "0.json", "\n".join(json.dumps(x, ensure_ascii=False) for x in lines))
    put(tmp_path / "x" / "1.json", json.dumps(dump("b", "Four"), ensure_ascii=False))
    flat = verdicts.flatten_verdicts(verdicts.read_index_dump(spark, str(tmp_path / "x")))
    assert {r.id: r.category for r in flat.collect()} == {"a": "Three", "b": "Four"}


def test_a_dump_is_grouped_by_its_ids_alone(spark, tmp_path):
    put(tmp_path / "x" / "0.json", json.dumps(dump("a"), ensure_ascii=False))
    plan = verdicts.read_index_dump(spark, str(tmp_path / "x"))._jdf.queryExecution().optimizedPlan().toString()
    groups = [line for line in plan.splitlines() if "Aggregate" in line]
    assert groups and not any("Doc Details" in line or "_source" in line for line in groups)


def test_single_files_are_written_by_all_cores(spark, tmp_path):
    path = str(tmp_path / "documents.parquet")
    spark.range(40).selectExpr("id as doc_id", "'a b' as text").coalesce(1).write.parquet(path)
    rows = files.verdict_folder(spark, str(tmp_path)).collect()
    assert len(rows) == 40
    assert files._items(spark, str(tmp_path)).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism


def test_single_files_are_those_of_sparks_writer(spark, tmp_path):
    # Without a checksum file and a process that sets the permissions of each.
    names = ["א\u2028 b", 'c"\n', None]
    rows = [(f"{i}.json", f"v{i}", None if i == 3 else f"s {i}", names, None) for i in range(25)]
    kinds = "file_name string, id string, summary string, judges array<string>, extra array<string>"
    flat = spark.createDataFrame(rows, kinds).repartition(4)
    others = {c: F.lit(None).cast("string") for c in ("date_text", "doc_type", "case_no", "category")}
    lists_ = [r for r in schema.ROLES if r != "judges"] + [f"{r}_normalized" for r in schema.ROLES]
    empty = {c: F.lit(None).cast("array<string>") for c in lists_}
    flat = flat.withColumns({**others, **empty, "pages": F.lit(7)})
    whole, path = str(tmp_path / "whole"), tmp_path / "each folder+"
    sinks.write_verdicts(flat, whole)
    sinks.write_verdicts(flat, str(path), one_per_file=True)
    files_ = [p for p in path.iterdir() if "_SUCCESS" not in p.name]
    assert len(files_) == 25 and all(p.suffix == ".json" for p in files_)
    lines = [r.value for r in spark.read.text(whole, lineSep="\n").collect()]
    assert sorted(p.read_text("utf-8") for p in files_) == sorted(f"{x}\n" for x in lines)
    read = verdicts.flatten_verdicts(verdicts.read_verdicts(spark, str(path)))
    assert sorted((r.id, r.judges) for r in read.collect()) == sorted((r[1], names) for r in rows)
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        sinks.write_verdicts(flat, str(path), one_per_file=True)


def test_labelled_tree(spark, tmp_path):
    root = tmp_path / "tree + x"
    put(root / "Civil - A" / "1.json", dump("1"))
    put(root / "משפחה - ב" / "2.json", dump("2"))
    put(root / "Civil - A" / "deep" / "3.json", dump("3"))
    put(root / "Family" / "1.json", dump("1"))
    put(root / "Civil - A" / "deep" / "er" / "4.json", dump("4"))
    put(root / "5.json", dump("5"))
    rows = verdicts.read_labelled_tree(spark, str(root)).select("label", "id").collect()
    assert sorted(map(tuple, rows)) == [
        ("Civil - A", "1"),
        ("Civil - A", "3"),
        ("Family", "1"),
        ("משפחה - ב", "2"),
    ]


def test_lists(spark, tmp_path):
    put(tmp_path / "w.csv", '﻿לכבוד\n"עו""ד"\nעורך דין\nלכבוד\n')
    words = lists.read_words(spark, str(tmp_path / "w.csv"))
    assert lists.short_list(words) == sorted(["לכבוד", 'עו"ד', "עורך דין"])
    assert lists.short_list(words, 2) is None
    put(tmp_path / "r.txt", "ב א\r\nא ב\n\nג ד\n")
    assert [tuple(r) for r in lists.read_roster(spark, str(tmp_path / "r.txt")).collect()] == [
        (0, "ב א"),
        (1, "א ב"),
        (2, ""),
        (3, "ג ד"),
    ]
    put(tmp_path / "d.csv", "ד' ביניש,קודם\nד' ביניש,דורית ביניש\n כבוד א,ב\n")
    assert {tuple(r) for r in lists.read_dictionary(spark, str(tmp_path / "d.csv")).collect()} == {
        ("ד' ביניש", "דורית ביניש"),
        (" כבוד א", "ב"),
    }
    put(tmp_path / "n.json", {"Categories": {"Civil": 9, "Tax": 2}})
    got = lists.read_ngram_sizes(spark, str(tmp_path / "n.json"))
    assert {tuple(r) for r in got.collect()} == {("Civil", 9), ("Tax", 2)}
    put(tmp_path / "c.csv", '12/20,"Civil, all",\n')
    assert tuple(lists.read_category_list(spark, str(tmp_path / "c.csv")).first()) == ("12/20", "Civil, all", None)


def test_name_files(spark, tmp_path):
    put(tmp_path / "n" / "judges.txt", "א ב*ג\nד*")
    put(tmp_path / "n" / "defense.txt", "*")
    got = lists.read_name_files(spark, str(tmp_path / "n"))
    assert sorted((r.role, r.name) for r in got.collect()) == [
        ("defense", ""),
        ("defense", ""),
        ("judges", ""),
        ("judges", "א ב"),
        ("judges", "ג\nד"),
    ]
    path = new_folder(spark, "names")
    lists.write_names(got.where("name <> ''"), path)
    assert sorted((r.role, r.name) for r in lists.read_names(spark, path).collect()) == [
        ("judges", "א ב"),
        ("judges", "ג\nד"),
    ]


def test_csv_sinks(spark):
    df = spark.createDataFrame(
        [("b", "y", ["p", "q"]), ("a", "z", [])], "first_name string, last_name string, l array<string>"
    )
    first, last = new_folder(spark, "first"), new_folder(spark, "last")
    sinks.write_sorted_csv(df, first, last)
    rows = spark.read.option("header", True).option("escape", '"').csv(first)
    assert {(r.first_name, r.l) for r in rows.collect()} == {("b", '["p","q"]'), ("a", "[]")}


def test_category_folders_and_report(spark):
    df = spark.createDataFrame([("1", "Civil"), ("1", ""), ("2", None), ("3", "A, b/c")], "id string, category string")
    path = new_folder(spark, "assigned")
    sinks.write_by_category(df, path)
    assert {tuple(r) for r in spark.read.parquet(path).collect()} == {("1", "Civil"), ("3", "A, b/c")}
    report = spark.createDataFrame([("Civil", 2, "0", 0.5)], "model string, n int, class string, f1 double")
    path = new_folder(spark, "report")
    sinks.write_report(report, path)
    assert spark.read.parquet(path).where("category = 'Civil'").first().n == 2


def test_reports(spark, folder):
    flat = verdicts.flatten_verdicts(verdicts.read_verdicts(spark, str(folder / "in")))
    table = verdicts.analysis_table(enrich.normalize(flat, ["של"], roster_of(spark)))
    assert len(table.columns) == 13
    assert len(verdicts.analysis_table(flat, with_category=False).columns) == 12
    tops = reports.top_attendees(table, 1)
    assert tuple(tops["judges_normalized"].first()) == (ROSTER[0], 2)
    assert len(tops) == 10


def test_dictionary_of_judges(spark, folder):
    flat = verdicts.flatten_verdicts(verdicts.read_verdicts(spark, str(folder / "in")))
    start = spark.createDataFrame([("י' עמית", "אחר")], "before string, after string")
    out = enrich.judge_dictionary(enrich.normalize(flat, ["של"], roster_of(spark)), start)
    assert {r.before: r.after for r in out.collect()} == {"י' עמית": "אחר", "א' רובינשטיין": ROSTER[0]}


def test_stream_takes_new_files_only(spark, folder):
    out, checkpoint = new_folder(spark, "enriched"), new_folder(spark, "stream")
    lines = roster_of(spark)

    def once():
        stream.run_enrichment(
            stream.verdict_stream(spark, str(folder / "in")),
            lambda raw: enrich.normalize(verdicts.flatten_verdicts(raw), ["של"], lines),
            out,
            checkpoint,
        ).awaitTermination()
        rows = spark.read.parquet(out)
        return {(r.file_name, r.status, r.batch) for r in rows.select("file_name", "status", "batch").collect()}

    first = once()
    assert {x[:2] for x in first} == {
        ("p.json", "success"),
        ("d.json", "success"),
        ("null.json", "failed"),
        ("broken.json", "failed"),
        ("list.json", "failed"),
        ("bare.json", "failed"),
    }
    put(folder / "in" / "new.json", dump("9-9-9"))
    assert once() - first == {("new.json", "success", 1)}


def test_dead_letters_are_read_again(spark, folder):
    """A file broken in one run and mended before the next comes out once."""
    out, checkpoint = new_folder(spark, "enriched"), new_folder(spark, "stream")
    lines = roster_of(spark)
    normalized = lambda flat: enrich.normalize(flat, ["של"], lines)
    source = stream.verdict_stream(spark, str(folder / "in"), 2)
    stream.run_enrichment(
        source, lambda raw: normalized(verdicts.flatten_verdicts(raw)), out, checkpoint
    ).awaitTermination()
    failed = {r.file_name for r in stream.dead_letters(spark, out).collect()}
    assert failed == {"null.json", "broken.json", "list.json", "bare.json"}
    assert spark.read.parquet(out).select("batch").distinct().count() == 3
    put(folder / "in" / "broken.json", dump("7-7-7"))
    assert stream.replay(spark, out, normalized, lambda x: stream.mended_files(x, 2)) == 4
    rows = {r.file_name: (r.status, r.attempt, r.id) for r in stream.outcomes(spark, out).collect()}
    assert rows["broken.json"] == ("success", 1, "7-7-7") and rows["p.json"][:2] == ("success", 0)
    assert rows["null.json"][:2] == ("failed", 1)
    # What has come out is not taken up again, whatever its file says now.
    put(folder / "in" / "broken.json", "{")
    put(folder / "in" / "bare.json", dump("8-8-8"))
    assert stream.replay(spark, out, normalized) == 3
    rows = spark.read.parquet(out).where("status = 'success'").collect()
    assert sorted((r.file_name, r.attempt) for r in rows) == [("bare.json", 2), ("broken.json", 1), ("d.json", 0), ("p.json", 0)]
    assert {r.file_name: r.error_reason for r in rows} == dict.fromkeys((r.file_name for r in rows))
    nothing = spark.createDataFrame([], "before string, after string")
    path = new_folder(spark, "dictionary")
    stream.run_judge_dictionary(spark, out, nothing, path, new_folder(spark, "stream")).awaitTermination()
    good = enrich.normalize(verdicts.flatten_verdicts(verdicts.read_verdicts(spark, str(folder / "in"))), ["של"], lines)
    want = enrich.judge_dictionary(good, nothing)
    assert {r.before for r in stream.read_dictionary_table(spark, path).collect()} >= {r.before for r in want.collect()}


def test_batches_share_columns_and_roster(spark, folder, monkeypatch):
    """What a batch is normalized with is made once, and as one table is normalized."""
    looked, lines = [], roster_of(spark)
    own = roster.small_roster
    monkeypatch.setattr(roster, "small_roster", lambda r: looked.append(r) or own(r))
    flat = verdicts.flatten_verdicts(verdicts.read_verdicts(spark, str(folder / "in")))
    normalized = enrich.normalizer(["של"], roster.ready_roster(lines))
    parts = [normalized(flat.where(F.pmod(F.xxhash64("file_name"), F.lit(2)) == i)).collect() for i in range(2)]
    assert len(looked) == 1
    assert sorted(map(str, parts[0] + parts[1])) == sorted(map(str, enrich.normalize(flat, ["של"], lines).collect()))
    # A roster too long for a literal is written once, with the same result.
    monkeypatch.setattr(roster, "LITERAL_LINES", 1)
    long = enrich.normalizer(["של"], roster.ready_roster(lines))
    assert sorted(map(str, long(flat).collect())) == sorted(map(str, normalized(flat).collect()))


def test_paths_are_listed_by_a_task_for_each_core(spark, tmp_path):
    for i in range(40):
        put(tmp_path / f"{i}.json", dump(str(i)))
    paths = [str(tmp_path / f"{i}.json") for i in range(40)]
    name = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before = spark.conf.get(name)
    tracker = spark.sparkContext.statusTracker()

    def tasks(group):
        spark.sparkContext.setJobGroup(group, group)
        assert verdicts.read_verdicts(spark, paths).schema
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        jobs = [tracker.getJobInfo(j) for j in tracker.getJobIdsForGroup(group)]
        return [tracker.getStageInfo(s).numTasks for j in jobs for s in j.stageIds]

    assert max(tasks("alone")) == 40
    with grouped_listings(spark):
        assert max(tasks("grouped")) == spark.sparkContext.defaultParallelism
    assert spark.conf.get(name) == before


def test_a_dictionary_batch_reads_no_older_folder(spark, tmp_path):
    """Every run has a folder of its own here: what is known is in the state alone."""
    checkpoint = new_folder(spark, "stream")
    nothing = spark.createDataFrame([], "before string, after string")
    seen = []
    for i, pairs in enumerate([[("a", "1"), ("b", "2")], [("a", "3"), ("c", "4")], [("c", "5"), ("b", "6"), ("d", "7")]]):
        put(tmp_path / "in" / f"{i}.json", "\n".join(f'{{"before":"{x}","after":"{y}","seen_at":{9 - i}}}' for x, y in pairs))
        rows = spark.readStream.schema("before string, after string, seen_at long").json(str(tmp_path / "in"))
        path = new_folder(spark, f"dictionary-{i}")
        stream.run_dictionary(rows, nothing, path, checkpoint).awaitTermination()
        seen.append({(r.before, r.after) for r in spark.read.parquet(f"{path}/batch={i}").collect()})
    assert seen == [{("a", "1"), ("b", "2")}, {("c", "4")}, {("d", "7")}]


def test_stream_with_a_model(spark, folder):
    rows = [("Civil", "tax appeal court levy"), ("Family", "child law family home")] * 6
    labelled = spark.createDataFrame(
        [(str(i), t, c) for i, (c, t) in enumerate(rows)], "id string, summary string, category string"
    )
    sizes = {"Civil": 2, "Family": 1}
    model, _ = enrich.train(labelled, "id", "summary", "category", sizes)
    lines = roster_of(spark)
    out = new_folder(spark, "enriched")
    stream.run_enrichment(
        stream.verdict_stream(spark, str(folder / "in")),
        lambda raw: enrich.enrich(verdicts.flatten_verdicts(raw), ["של"], lines, model, sizes),
        out,
        new_folder(spark, "stream"),
    ).awaitTermination()
    got = {r.id: (r.status, r.category, r.judges_normalized) for r in spark.read.parquet(out).collect()}
    assert got["12-20-1"] == ("success", "Civil", ROSTER)
    assert got["list"] == ("failed", None, None)


def test_stream_dictionary_is_first_wins_across_batches(spark, tmp_path):
    path, checkpoint = new_folder(spark, "dictionary"), new_folder(spark, "stream")
    start = spark.createDataFrame([("z", "Z")], "before string, after string")

    def once():
        rows = spark.readStream.schema("before string, after string, seen_at long").json(str(tmp_path / "in"))
        stream.run_dictionary(rows, start, path, checkpoint).awaitTermination()
        return {r.before: r.after for r in stream.read_dictionary_table(spark, path).collect()}

    put(tmp_path / "in" / "0.json", '{"before":"a","after":"2","seen_at":2}\n{"before":"a","after":"1","seen_at":1}\n{"before":"z","after":"no","seen_at":0}')
    assert once() == {"a": "1"}
    put(tmp_path / "in" / "1.json", '{"before":"a","after":"0","seen_at":0}\n{"before":"b","after":"B","seen_at":5}')
    assert once() == {"a": "1", "b": "B"}


def test_spread_leaves_tables_of_many_splits(spark):
    many = spark.range(0, 100, 1, 64)
    assert spread(many, "id") is many
    few = spark.range(0, 100, 1, 1).select(F.col("id"))
    assert spread(few, "id").rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
