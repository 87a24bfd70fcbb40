"""Normalize, train, classify: the batch jobs over flat verdict tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docketeer import schema
from docketeer.functions import names as N
from docketeer.operators import bayes, lookup, sampling
from docketeer.operators.roster import judge_fixer
from docketeer.operators.tokens import remove_from_lists
from docketeer.session import settled
from docketeer.sources import lists


def with_name_errors(flat: DataFrame) -> DataFrame:
    """Give rows a reason for failure where a role list, or a name in one, is null."""
    reason = F.col("error_reason")
    for role in schema.ROLES:
        missing = F.col(role).isNull() | F.exists(role, lambda n: n.isNull())
        reason = F.coalesce(reason, F.when(missing, F.lit(f"missing {role}")))
    return flat.withColumn("error_reason", reason)


def normalize(
    flat: DataFrame,
    stop_words: Sequence[str] | DataFrame,
    roster: DataFrame | Column,
    titles: Sequence[str] | DataFrame = tuple(schema.TITLES),
    clean: bool = False,
) -> DataFrame:
    """Fill the five normalized lists; failed rows keep their reason and have none.

    Word lists are Python lists or tables with a column ``word``. With lists and a roster short
    enough for literals this is one pass over the table without a shuffle; longer ones are
    joined, with the same result. No key is needed. ``clean`` takes the rules that lose nothing
    (``names.legal_names_clean``, and the clean form of the roster match).
    """
    return normalizer(stop_words, roster, titles, clean)(flat)


def normalizer(
    stop_words: Sequence[str] | DataFrame,
    roster: DataFrame | Column,
    titles: Sequence[str] | DataFrame = tuple(schema.TITLES),
    clean: bool = False,
) -> Callable[[DataFrame], DataFrame]:
    """:func:`normalize` for many tables, as the batches of a stream: its columns, and what is made
    of the word lists and the roster, are made once."""
    good = F.col("error_reason").isNull()
    legal_names = N.legal_names_clean if clean else N.legal_names
    split, finish = (N.split_legal_clean, N.finish_legal_clean) if clean else (N.split_legal, N.finish_legal)
    short = [_short(words) for words in (titles, stop_words)]
    literal = None not in short
    legal = [f"{role}_normalized" for role in schema.LEGAL_ROLES]
    first = {f"{role}_normalized": F.when(good, N.party_names(F.col(role))) for role in schema.PARTY_ROLES}
    for role, column in zip(schema.LEGAL_ROLES, legal, strict=True):
        names = legal_names(F.col(role), *short) if literal else split(F.col(role))
        first[column] = F.when(good, names)
    finished = {} if literal else {column: finish(F.col(column)) for column in legal}
    fix = judge_fixer("judges_normalized", "judges_normalized", roster, clean)

    def run(flat: DataFrame) -> DataFrame:
        # All columns in one step, as each step analyzes the whole plan again.
        out = with_name_errors(flat).withColumns(first)
        if not literal:
            spark = flat.sparkSession
            tables = [_as_table(spark, words) for words in (titles, stop_words)]
            out = remove_from_lists(out, legal, tables[0].unionByName(tables[1])).withColumns(finished)
        return fix(out)

    return run


def _short(words: Sequence[str] | DataFrame) -> list[str] | None:
    return lists.short_list(words) if isinstance(words, DataFrame) else list(words)


def _as_table(spark: SparkSession, words: Sequence[str] | DataFrame) -> DataFrame:
    if isinstance(words, DataFrame):
        return words.select("word")
    return spark.createDataFrame([(w,) for w in words], "word string")


def judge_dictionary(normalized: DataFrame, dictionary: DataFrame, order: str = "id") -> DataFrame:
    """The dictionary with the judges of these verdicts; the first value of a name stays."""
    good = normalized.where("error_reason IS NULL")
    pairs = lookup.dictionary_pairs(good, "judges", "judges_normalized", F.col(order))
    return lookup.upsert_first(dictionary, pairs)


def train(
    labelled: DataFrame,
    key: str,
    text: str,
    category: str,
    sizes: dict[str, int],
    test_share: float = 0.3,
    seed: int = 0,
    named: bool = False,
    stored: bool = True,
) -> tuple[bayes.Model, DataFrame]:
    """(model, test members): one model per category with an n-gram size.

    ``labelled`` has a row per (text, category); a text may be in several. ``named`` keeps the
    n-grams of the model as text; without ``stored`` its terms are left to ``sinks.save_model`` to write.
    """
    split = sampling.one_vs_rest_split(
        labelled, key, category, list(sizes), test_share, seed
    )
    members = settled(bayes.with_ngram_sizes(split, sizes), "split")
    train_set = members.where("part = 'train'").drop("part")
    model = bayes.fit(train_set, labelled.select(key, text), key, text, named=named, stored=stored)
    return model, members.where("part = 'test'").drop("part")


def classify(
    flat: DataFrame,
    model: bayes.Model,
    sizes: dict[str, int],
    key: str = "id",
    text: str = "summary",
) -> DataFrame:
    """The table with ``category`` set; rows without a text get a reason for failure.

    ``key`` must tell the rows apart. Rows that share one, or have none, cannot be told apart
    when the scores come back, so they get a reason for failure as well, and no category.
    """
    missing = F.when(F.col(text).isNull(), F.lit("missing summary"))
    checked = flat.withColumn("error_reason", F.coalesce("error_reason", missing))
    good = checked.where(F.col("error_reason").isNull() & F.col(key).isNotNull())
    docs = good.select(key, text)
    scores = bayes.score(docs, model, key, text, list(sizes.values()))
    chosen = bayes.choose_category(docs, scores, key, list(sizes))
    chosen = chosen.groupBy(key).agg(
        F.any_value("category").alias("_category"), F.count(F.lit(1)).alias("_rows")
    )
    joined = checked.drop("category").join(chosen, key, "left")
    reason = F.when(F.col(key).isNull(), f"missing {key}").when(F.col("_rows") > 1, f"repeated {key}")
    joined = joined.withColumn("error_reason", F.coalesce("error_reason", reason))
    category = F.when(F.col("error_reason").isNull(), F.col("_category"))
    return joined.withColumn("category", category).drop("_category", "_rows")


def enrich(
    flat: DataFrame,
    stop_words: Sequence[str] | DataFrame,
    roster: DataFrame | Column,
    model: bayes.Model,
    sizes: dict[str, int],
    key: str = "id",
    titles: Sequence[str] | DataFrame = tuple(schema.TITLES),
) -> DataFrame:
    """Normalize, then classify; what a scheduled run does to its new verdicts."""
    return classify(normalize(flat, stop_words, roster, titles), model, sizes, key)


def enrich_with_dictionary(
    flat: DataFrame,
    stop_words: Sequence[str] | DataFrame,
    roster: DataFrame | Column,
    model: bayes.Model,
    sizes: dict[str, int],
    dictionary: DataFrame,
    key: str = "id",
    titles: Sequence[str] | DataFrame = tuple(schema.TITLES),
) -> tuple[DataFrame, DataFrame]:
    """(enriched verdicts, dictionary with their judges); the verdicts are written once."""
    done = settled(enrich(flat, stop_words, roster, model, sizes, key, titles), "enriched")
    return done, judge_dictionary(done, dictionary, key)
