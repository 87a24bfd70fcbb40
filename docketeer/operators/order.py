"""Ranks and running sums over a whole table in order, without a window that holds all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docketeer.session import settled


def _placed(df: DataFrame, order: Sequence[Column], name: str) -> DataFrame:
    """The table in ranges of the order, written, with each row's range and place in it.

    The written number of a row has its partition above 33 bits and its place below.
    """
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    return settled(ranged.withColumn("_at", F.monotonically_increasing_id()), name).withColumn(
        "_range", F.shiftright("_at", 33)
    )


def _before(rows: DataFrame, value: Column) -> DataFrame:
    """(_range, _before): the sum of ``value`` over the ranges before; one row for each range."""
    sums = rows.groupBy("_range").agg(F.sum(value).alias("_sum"))
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    return sums.select("_range", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_before"))


def ranked(df: DataFrame, order: Sequence[Column], name: str = "rank") -> DataFrame:
    """Add each row's place in the order, from 1 on, as ``row_number()`` over all rows would.

    The table is sorted in ranges; a row's rank is its place in its range behind the rows of the
    ranges before, which are counted. Columns that tell rows apart should end the order; rows equal
    in all of them are ranked as they come. An empty table gives an empty one.
    """
    rows = _placed(df, order, "ranked")
    # One row for each range, which are at most as many as shuffle partitions.
    before = F.broadcast(_before(rows, F.lit(1)))
    place = F.col("_at").bitwiseAND((1 << 33) - 1) + F.col("_before") + 1
    return rows.join(before, "_range").withColumn(name, place).drop("_range", "_at", "_before")


def running_sums(df: DataFrame, order: Sequence[Column], value: str, name: str) -> DataFrame:
    """Add the sum of ``value`` over all rows before in the order, the own one left out."""
    rows = _placed(df, order, "running")
    before = F.broadcast(_before(rows, F.col(value)))
    within = Window.partitionBy("_range").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    own = F.coalesce(F.sum(value).over(within), F.lit(0))
    summed = rows.join(before, "_range").withColumn(name, own + F.col("_before"))
    return summed.drop("_range", "_at", "_before")
