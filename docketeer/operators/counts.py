"""Counts, date spans, word counts and column summaries."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from docketeer.functions import text as X
from docketeer.operators.joins import exploded
from docketeer.operators.nametext import is_blank, met_in_order
from docketeer.operators.order import running_sums
from docketeer.operators.tables import unpivot_names
from docketeer.session import settled


def distinct_names(df: DataFrame, key: str, roles: Sequence[str]) -> DataFrame:
    return unpivot_names(df, key, roles).select("role", "name").distinct()


def names_per_role(names: DataFrame) -> DataFrame:
    return names.groupBy("role").agg(F.count(F.lit(1)).alias("n"))


def name_counts(df: DataFrame, names: str, by: Sequence[str] = ()) -> DataFrame:
    """Occurrences of each non-empty name over a list column; repeats in a row count."""
    rows = exploded(df, by, names, "name").where("name <> ''")
    return rows.groupBy(*by, "name").agg(F.count(F.lit(1)).alias("n"))


def top_names(df: DataFrame, names: str, k: int = 10) -> DataFrame:
    """The k most frequent names, ties by name."""
    return name_counts(df, names).orderBy(F.desc("n"), "name").limit(k)


def main_category(label: Column) -> Column:
    return F.get(F.split(label, " - "), 0)


def category_counts(df: DataFrame, label: str) -> DataFrame:
    """Rows per main category, the part of the label before the first ' - '."""
    main = main_category(F.col(label)).alias("category")
    return df.groupBy(main).agg(F.count(F.lit(1)).alias("n"))


def sorted_category_counts(df: DataFrame, category: str) -> DataFrame:
    counts = df.groupBy(F.col(category).alias("category")).agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.desc("n"), "category")


def category_shares(df: DataFrame, label: str) -> DataFrame:
    """Each main category with its share of all rows; one total row is read back."""
    counts = category_counts(df, label)
    total = counts.agg(F.sum("n")).scalar()
    return counts.withColumn("share", F.col("n") / total)


def subcategory_counts(df: DataFrame, label: str) -> DataFrame:
    """Rows per (category, sub_category) and a '<category> Total' row for each category.

    The sub-category is part two, or 'two - three' for labels of exactly three parts. A label
    of one part has none: it counts in a row whose sub-category is null, and in the total.
    """
    parts = F.split(label, " - ")
    two = F.get(parts, 1)
    sub = F.when(F.size(parts) == 3, F.concat_ws(" - ", two, F.get(parts, 2))).otherwise(two)
    rolled = (
        df.select(F.get(parts, 0).alias("category"), sub.alias("sub_category"))
        .rollup("category", "sub_category")
        .agg(F.count(F.lit(1)).alias("n"), F.grouping_id().alias("_level"))
        .where("_level < 3")
    )
    total = F.concat("category", F.lit(" Total"))
    return rolled.select(
        "category",
        F.when(F.col("_level") == 1, total).otherwise(F.col("sub_category")).alias("sub_category"),
        "n",
    )


def status_counts(df: DataFrame, reason: str = "error_reason") -> DataFrame:
    status = F.when(F.col(reason).isNull(), "success").otherwise("failed").alias("status")
    return df.groupBy(status).agg(F.count(F.lit(1)).alias("n"))


def date_span(df: DataFrame, date_text: str, pattern: str = "d/M/yyyy") -> DataFrame:
    """Earliest and latest date and the number of dated rows.

    Without any dated row the ends are today and 0001-01-01.
    """
    date = F.try_to_date(F.col(date_text), pattern)
    return df.agg(
        F.coalesce(F.min(date), F.current_date()).alias("earliest"),
        F.coalesce(F.max(date), F.make_date(F.lit(1), F.lit(1), F.lit(1))).alias("latest"),
        F.count(date).alias("dated"),
    )


def undated(
    df: DataFrame, key: str, date_text: str, pattern: str = "d/M/yyyy"
) -> DataFrame:
    """Keys of the rows without a date, or with a text that is none."""
    return df.where(F.try_to_date(F.col(date_text), pattern).isNull()).select(key)


def word_counts(
    df: DataFrame, text: str, by: Sequence[str] = (), not_letters: str = X.NOT_HEBREW
) -> DataFrame:
    words = X.letter_words(F.col(text), not_letters)
    return exploded(df, by, words, "word").groupBy(*by, "word").agg(F.count(F.lit(1)).alias("n"))


def keyword_matches(df: DataFrame, text: str, keywords: Sequence[str]) -> DataFrame:
    return df.where(X.has_any(F.col(text), keywords))


def keyword_match_count(df: DataFrame, text: str, keywords: Sequence[str]) -> DataFrame:
    return keyword_matches(df, text, keywords).agg(F.count(F.lit(1)).alias("n"))


def column_summary(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per column: non-null count, distinct count, most frequent value and its frequency."""
    cells = F.array(
        *(F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("v")) for c in columns)
    )
    counts = (
        df.select(F.explode(cells).alias("_c"))
        .select("_c.column", "_c.v")
        .where("v IS NOT NULL")
        .groupBy("column", "v")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    summed = counts.groupBy("column").agg(
        F.sum("n").alias("count"),
        F.count(F.lit(1)).alias("unique"),
        F.max("n").alias("freq"),
        # The smallest value among the most frequent ones.
        F.min_by("v", F.struct(-F.col("n"), "v")).alias("top"),
    )
    return summed.select("column", "count", "unique", "top", "freq")


def step_counts(
    source: DataFrame, steps: dict[str, Callable[[DataFrame], DataFrame]]
) -> tuple[DataFrame, DataFrame]:
    """(result, counts): the result of all steps, each on that of the one before, and (step, n) of each.

    The rows are counted as they pass while the result is written, so there is one job, and no
    step is done twice. A stage that is run again after a lost executor may count its rows again.
    """
    df, seen = source, {}
    for step, make in steps.items():
        df, seen[step] = watched(make(df), step)
    result = settled(df, "steps")
    rows = [(step, _observed(observation)) for step, observation in seen.items()]
    return result, source.sparkSession.createDataFrame(rows, "step string, n long")


def _observed(seen: Observation) -> int:
    """The rows counted; a part of the plan that has none may be left out, and then has no row to give."""
    try:
        return seen.get["n"]
    except Py4JJavaError as error:
        if "AssertionError" not in str(error.java_exception):
            raise
        return 0


def watched(df: DataFrame, step: str) -> tuple[DataFrame, Observation]:
    """The table, counting its rows as they pass: ``n`` of the observation, without a scan."""
    seen = Observation(step)
    return df.observe(seen, F.count(F.lit(1)).alias("n")), seen


def _entries(names: DataFrame, columns: Sequence[str], pos: str) -> DataFrame:
    """(kind, pos, name): every name that is not null, once under each position and column."""
    lists = F.array(*(F.struct(F.lit(c).alias("kind"), F.col(c).alias("name")) for c in columns))
    rows = names.select(F.col(pos).alias("pos"), F.explode(lists).alias("_e"))
    return rows.select("_e.kind", "pos", "_e.name").where("name IS NOT NULL").distinct()


def _met_by_all(texts: DataFrame, found: DataFrame, entries: DataFrame) -> DataFrame:
    """(kind, pos, name, n) of the empty names: all texts but those that were emptied before."""
    total = texts.agg(F.coalesce(F.sum("n"), F.lit(0))).scalar()
    emptied = found.where("done IS NOT NULL").groupBy("kind", "done").agg(F.sum("n").alias("n"))
    events = emptied.select("kind", "done.pos", "done.name", "n").unionByName(
        entries.where("name = ''").withColumn("n", F.lit(0).cast("long"))
    )
    order = [F.col("kind"), F.col("pos"), F.col("name")]
    before = running_sums(events, order, "n", "_earlier")
    # The sums run over all kinds, so what stands before a kind's first event is taken off.
    own = before.groupBy("kind").agg(F.min("_earlier").alias("_start"))
    empty = before.where("name = ''").join(F.broadcast(own), "kind")
    return empty.select("kind", "pos", "name", (total - (F.col("_earlier") - F.col("_start"))).alias("n"))


def normalized_name_counts(
    df: DataFrame,
    key: str,
    roles: Sequence[str],
    names: DataFrame,
    pos: str = "pos",
    columns: Sequence[str] = ("full_name", "first_name", "last_name"),
) -> DataFrame:
    """The name table with ``count_<column>``: the texts in which each name is met.

    The text of a (verdict, role) is its names joined by a space. In the order of the table, by
    position and then name, a name that is found in what is left of a text counts once and is
    erased from it, so that later names do not meet it; a text that is blank after that is done,
    and one that is blank from the start meets the very first name at most. Each column is
    counted over the full texts; an empty name meets whatever is left.

    Names are looked up by their hashes (:mod:`docketeer.operators.nametext`), however many there
    are, so a text tries only names that it has. An empty name is not tried on texts: it is met by
    those that no earlier name has emptied, which the texts emptied before it tell.
    """
    per_role = F.array(*(F.array_join(r, " ") for r in roles))
    texts = df.select(F.explode(per_role).alias("text")).where("text IS NOT NULL")
    texts = texts.groupBy(F.md5("text").alias("digest")).agg(
        F.any_value("text").alias("text"), F.count(F.lit(1)).alias("n")
    )
    texts = settled(texts, "texts")
    entries = settled(_entries(names, columns, pos), "entries")
    # One row for each column.
    first = entries.groupBy("kind").agg(F.min(F.struct("pos", "name")).alias("f")).select("kind", "f.*")
    full = texts.where(~is_blank(F.col("text")))
    found = settled(met_in_order(full, entries.where("name <> ''")), "hits")
    hits = found.select("kind", "n", F.explode("hits").alias("_h")).select("kind", "_h.pos", "_h.name", "n")
    hits = hits.unionByName(_met_by_all(full, found, entries))
    firsts = [F.struct(*(F.lit(r[c]).alias(c) for c in ("kind", "pos", "name"))) for r in first.collect()]
    if firsts:
        blank = texts.where(is_blank(F.col("text"))).select("text", "n", F.explode(F.array(*firsts)).alias("_h"))
        blank = blank.where(F.contains("text", "_h.name"))
        hits = hits.unionByName(blank.select("_h.kind", "_h.pos", "_h.name", "n"))
    counted = hits.groupBy("kind", "pos", "name").agg(F.sum("n").alias("n"))
    out = names
    for column in columns:
        of_kind = counted.where(F.col("kind") == column).select(
            F.col("pos").alias("_pos"), F.col("name").alias("_name"), F.col("n").alias("_n")
        )
        same = F.col(pos).eqNullSafe(F.col("_pos")) & (F.col(column) == F.col("_name"))
        out = out.join(of_kind, same, "left").withColumn(
            f"count_{column}", F.coalesce("_n", F.lit(0)).cast("long")
        ).drop("_pos", "_name", "_n")
    return out


def consuming_counts(
    texts: DataFrame, text: str, names: DataFrame, name: str, pos: str = "pos"
) -> DataFrame:
    """(pos, name, n) for one name column and texts that are at hand as such."""
    ordered = names.select(F.col(pos).alias("pos"), F.col(name).alias("name"))
    rows = texts.where(F.col(text).isNotNull()).select(F.array(text).alias("_text"))
    counted = normalized_name_counts(rows, "", ["_text"], ordered, "pos", ["name"])
    return counted.select("pos", "name", F.col("count_name").alias("n"))
