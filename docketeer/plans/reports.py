"""The analysis of enriched verdicts: top names, category counts, correlations."""

from __future__ import annotations

from pyspark.sql import DataFrame

from docketeer import schema
from docketeer.operators import cooccur, counts


def top_attendees(table: DataFrame, k: int = 10) -> dict[str, DataFrame]:
    """The top-k names of each role, raw and normalized."""
    columns = [c for r in schema.ROLES for c in (r, f"{r}_normalized")]
    return {c: counts.top_names(table, c, k) for c in columns}


def role_correlations(
    table: DataFrame, columns: list[str] | None = None, k_names: int = 10, k_pairs: int = 40
) -> DataFrame:
    """The most and least correlated pairs among each role's top names and the categories.

    All name columns, raw and normalized, go through one pass for the names and one for the pairs.
    """
    columns = columns or [c for r in schema.ROLES for c in (r, f"{r}_normalized")]
    top = cooccur.top_names_by_column(table, columns, k_names)
    corr = cooccur.correlations(table, top, "category", schema.INDICATOR_CATEGORIES)
    return cooccur.top_correlated(corr, k_pairs)


def name_category_correlations(
    table: DataFrame, names: str, k_names: int = 10, k_pairs: int = 40
) -> DataFrame:
    """The same for one name column."""
    return role_correlations(table, [names], k_names, k_pairs).drop("column")
