"""Indicators of frequent names and categories, and their correlation, for any number of columns.

A feature is a name among the top of its column, or a category; which of the two it is goes with
it, so a name that reads like a category is still another feature.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docketeer.functions.names import bind
from docketeer.operators.joins import exploded
from docketeer.session import settled

NAME, CATEGORY = "name", "category"


def top_names_by_column(df: DataFrame, columns: Sequence[str], k: int) -> dict[str, list[str]]:
    """The ``k`` most frequent names that are not empty of each list column, ties by name, in one pass.

    Repeats in a row count. Every task hands on ``k`` names of a column; the result is a report.
    """
    lists = F.array(*(F.struct(F.lit(c).alias("column"), F.col(c).alias("names")) for c in columns))
    rows = df.select(F.explode(lists).alias("_l")).select("_l.column", "_l.names")
    named = exploded(rows, ["column"], "names", "name").where("name <> ''")
    counted = named.groupBy("column", "name").agg(F.count(F.lit(1)).alias("n"))
    order = Window.partitionBy("column").orderBy(F.desc("n"), "name")
    top = counted.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    held = sorted(top.collect(), key=lambda r: r["rank"])
    return {c: [r["name"] for r in held if r["column"] == c] for c in columns}


def _places(names: Column, category: Column, top: Sequence[str], categories: Sequence[str]) -> Column:
    """Places, from 1 on, of the listed names a row holds and behind them of its category.

    Null for a row that holds no listed name.
    """
    listed = F.array(*(F.lit(n) for n in top)).cast("array<string>")
    of_category = F.array(*(F.lit(c) for c in categories)).cast("array<string>")
    every = F.sequence(F.lit(1), F.lit(len(top))) if top else F.array().cast("array<int>")

    def of_row(own: Column) -> Column:
        held = F.filter(every, lambda i: F.array_contains(own, F.element_at(listed, i)))
        at = F.array_position(of_category, category).cast("int")
        behind = F.when(at > 0, F.array(at + len(top))).otherwise(F.array().cast("array<int>"))
        return bind(held, lambda h: F.when(F.size(h) > 0, F.concat(h, behind)))

    return bind(names, of_row)


def indicator_table(
    df: DataFrame, key: str, names: str, category: str, top: Sequence[str], categories: Sequence[str]
) -> DataFrame:
    """One boolean column per listed name and per category, for rows with a listed name.

    The columns are called "name: ..." and "category: ...", in that order.
    """
    places = _places(F.col(names), F.col(category), top, categories)
    # An outer explode of one list keeps the filter from computing the list again.
    held = df.withColumn("_at", F.explode_outer(F.array(places))).where(F.col("_at").isNotNull())
    titles = [f"{NAME}: {n}" for n in top] + [f"{CATEGORY}: {c}" for c in categories]
    return held.select(key, *(F.array_contains("_at", i).alias(t) for i, t in enumerate(titles, 1)))


def correlations(
    df: DataFrame, top: dict[str, Sequence[str]], category: str, categories: Sequence[str]
) -> DataFrame:
    """(column, kind_a, feature_a, kind_b, feature_b, corr) for each pair of a column's features.

    ``top`` has the listed names of every column. A column's features are these and the
    categories, in this order; its rows are those that hold a listed name. All columns are
    counted in one pass: a row gives the pairs of features it holds, which are few, as it can hold
    listed ones only, and counts of pairs meet by column and pair. A feature that is never or
    always there has no correlation.
    """
    lists = F.array(
        *(
            F.struct(F.lit(c).alias("column"), _places(F.col(c), F.col(category), names, categories).alias("at"))
            for c, names in top.items()
        )
    )
    rows = df.select(F.explode(lists).alias("_l")).select("_l.column", "_l.at")

    def all_pairs(held: Column) -> Column:
        return F.flatten(
            F.transform(
                held,
                lambda a: F.transform(
                    F.filter(held, lambda b: b >= a),
                    lambda b: F.struct(a.alias("a"), b.alias("b")),
                ),
            )
        )

    # Every row holds place 0: its pairs count the rows, and each feature alone.
    held = F.when(F.col("at").isNotNull(), F.concat(F.array(F.lit(0)), "at"))
    pairs = exploded(rows, ["column"], bind(held, all_pairs), "_p")
    counted = settled(
        pairs.groupBy("column", "_p.a", "_p.b").agg(F.count(F.lit(1)).cast("double").alias("n")), "pairs"
    )
    # From here on all tables are as small as the listed features squared.
    features = {
        c: [(NAME, n) for n in names] + [(CATEGORY, c) for c in categories] for c, names in top.items()
    }
    grid = df.sparkSession.createDataFrame(
        [
            (c, i + 1, j + 1, *own[i], *own[j])
            for c, own in features.items()
            for i in range(len(own))
            for j in range(i + 1, len(own))
        ],
        "column string, a int, b int, kind_a string, feature_a string, kind_b string, feature_b string",
    )
    total = counted.where("a = 0 AND b = 0").select("column", F.col("n").alias("_n"))
    single = counted.where("a = 0 AND b > 0")
    covered = (
        grid.join(total, "column", "left")
        .join(single.select("column", F.col("b").alias("a"), F.col("n").alias("_n1")), ["column", "a"], "left")
        .join(single.select("column", "b", F.col("n").alias("_n2")), ["column", "b"], "left")
        .join(
            counted.where("0 < a AND a < b").select("column", "a", "b", F.col("n").alias("_n11")),
            ["column", "a", "b"],
            "left",
        )
        .na.fill(0.0, ["_n", "_n1", "_n2", "_n11"])
    )
    n, n1, n2, n11 = F.col("_n"), F.col("_n1"), F.col("_n2"), F.col("_n11")
    deviations = F.sqrt(n1 * (n - n1)) * F.sqrt(n2 * (n - n2))
    return covered.select(
        "column", "kind_a", "feature_a", "kind_b", "feature_b",
        F.try_divide(n * n11 - n1 * n2, deviations).alias("corr"),
    )


def top_correlated(corr: DataFrame, k: int = 40) -> DataFrame:
    """(column, sign, rank, ...): the k highest and the k lowest pairs of each column.

    The windows run over the pairs of one column's features.
    """
    ties = ["kind_a", "feature_a", "kind_b", "feature_b"]
    known = corr.where("corr IS NOT NULL")

    def ranked(sign: str, order: Column) -> DataFrame:
        rank = F.row_number().over(Window.partitionBy("column").orderBy(order, *ties))
        rows = known.withColumn("rank", rank).where(F.col("rank") <= k)
        return rows.select("column", F.lit(sign).alias("sign"), "rank", *ties, "corr")

    return ranked("positive", F.desc("corr")).unionByName(ranked("negative", F.asc("corr")))
