"""Row filters and reshapes over the name table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docketeer import schema
from docketeer.functions import names as N
from docketeer.operators.order import ranked


def unpivot_names(df: DataFrame, key: str, roles: Sequence[str]) -> DataFrame:
    """(key, role, pos, name): one row per name; null lists give none."""
    per_role = F.array(*(F.struct(F.lit(r).alias("role"), F.col(r).alias("names")) for r in roles))
    return df.select(key, F.explode(per_role).alias("_r")).select(
        key, F.col("_r.role").alias("role"), F.posexplode("_r.names").alias("pos", "name")
    )


def split_by_role(
    df: DataFrame, party_roles: Sequence[str] = tuple(schema.PARTY_ROLES), role: str = "role"
) -> tuple[DataFrame, DataFrame]:
    """(legal, party) rows."""
    is_party = F.col(role).isin(*party_roles)
    return df.where(~is_party), df.where(is_party)


def split_by_token_count(df: DataFrame, column: str, most: int = 3) -> tuple[DataFrame, DataFrame]:
    """(up to ``most`` pieces, more) without the nulls; every single space splits."""
    size = F.size(F.split(column, " "))
    kept = df.where(F.col(column).isNotNull())
    return kept.where(size <= most), kept.where(size > most)


def only_unrepeated(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Drop every copy of a value that occurs more than once; by default of whole rows.

    An aggregate with a partial step rather than a window: a value that fills a third of
    the table is down to one row per task before the shuffle.
    """
    columns = list(columns or df.columns)
    others = [F.any_value(c).alias(c) for c in df.columns if c not in columns]
    once = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("_n"), *others).where("_n = 1")
    return once.select(*df.columns)


def drop_missing(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.na.drop(subset=list(columns))


def explode_delimited(
    df: DataFrame, column: str, mark: str = "|", keep_whole: bool = False
) -> DataFrame:
    """One row per part of the column, all parts; with the whole first where asked and split."""
    parts = F.split(F.col(column), F.lit(_literal(mark)))
    if keep_whole:
        parts = F.when(F.size(parts) > 1, F.concat(F.array(column), parts)).otherwise(parts)
    return df.where(F.col(column).isNotNull()).withColumn(column, F.explode(parts))


def _literal(mark: str) -> str:
    return "\\Q" + mark + "\\E"


def organize_rows(df: DataFrame, column: str) -> DataFrame:
    """One row per paired name, with its place in ``pair``.

    Three tokens become 'first last-last', an even number above two becomes couples;
    both swap when the first token has a hyphen. Other rows stay as they are.
    """

    def values(parts: Column) -> Column:
        size = F.size(parts)
        swap = F.contains(F.get(parts, 0), F.lit("-"))

        def join(a: Column, b: Column) -> Column:
            return F.when(swap, F.concat_ws(" ", b, a)).otherwise(F.concat_ws(" ", a, b))

        three = join(F.get(parts, 0), F.concat_ws("-", F.get(parts, 1), F.get(parts, 2)))
        couples = F.transform(
            F.sequence(F.lit(0), F.floor(size / 2).cast("int") - 1),
            lambda i: join(F.get(parts, i * 2), F.get(parts, i * 2 + 1)),
        )
        return (
            F.when(size == 3, F.array(three))
            .when((size > 2) & (size % 2 == 0), couples)
            .otherwise(F.array(column))
        )

    rest = [c for c in df.columns if c != column]
    return df.select(*rest, F.posexplode(N.bind(N.tokens(F.col(column)), values)).alias("pair", column))


def with_first_and_last(df: DataFrame, column: str, strip: bool = True) -> DataFrame:
    """Add first_name and last_name of two-token names, stripped of punctuation if asked."""
    first, last = N.first_name(F.col(column)), N.last_name(F.col(column))
    if strip:
        first, last = N.strip_punctuation(first), N.strip_punctuation(last)
    return df.withColumn("first_name", first).withColumn("last_name", last)


def raw_columns(df: DataFrame) -> DataFrame:
    """The analysis table with the raw name lists and the category."""
    return df.select("category", *schema.ROLES)


def normalized_columns(df: DataFrame) -> DataFrame:
    return df.select("category", *(f"{r}_normalized" for r in schema.ROLES))


def sorted_by(df: DataFrame, column: str) -> DataFrame:
    """Ascending with nulls last."""
    return df.orderBy(F.col(column).asc_nulls_last())


def ranked_by(df: DataFrame, column: str, key: str, name: str = "rank") -> DataFrame:
    """Add each row's place by a column, nulls last, ties by key, without one window over all rows."""
    return ranked(df, [F.col(column).asc_nulls_last(), F.col(key)], name)


def first_rows(df: DataFrame, keys: Sequence[str], n: int) -> DataFrame:
    return df.orderBy(*keys).limit(n)


def category_role_pairs(df: DataFrame, roles: Sequence[str], key: str = "id") -> DataFrame:
    """(key, category, role, names, normalized): the two columns of each role beside the category."""
    pairs = F.array(
        *(
            F.struct(
                F.lit(r).alias("role"), F.col(r).alias("names"), F.col(f"{r}_normalized").alias("normalized")
            )
            for r in roles
        )
    )
    return df.select(key, "category", F.explode(pairs).alias("_p")).select(key, "category", "_p.*")
