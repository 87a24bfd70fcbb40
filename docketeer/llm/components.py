"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketeer.session import settled


def components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, root): the smallest node that links lead to, for each node of a table (a, b).

    Large stars and small stars by turns (Kiveris et al., 2014): every node hands its larger
    neighbours, then its smaller ones, to the smallest node it knows, until nothing moves. The
    number of links never grows and the rounds grow with the logarithm of the nodes. A node's
    smallest neighbour comes from an aggregate with a partial step and goes back by a join, so
    the neighbours of one node are never gathered. Each round is written to the shared folder.
    Links with a null end are left out; no links give no rows.
    """
    links = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    links = settled(links.where("a is not null and a != b").distinct(), "links")
    seen = _state(links)
    for _ in range(rounds):
        if not seen[0]:
            break
        links = settled(_small_star(_large_star(links)), "links")
        now = _state(links)
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    roots = links.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def _state(links: DataFrame) -> tuple:
    row = links.agg(
        F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.xxhash64("a", "b") % 1000003)
    ).first()
    return tuple(row)


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    moved = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.distinct()


def _small_star(links: DataFrame) -> DataFrame:
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    moved = links.join(least, "a")
    pairs = moved.select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b")
    return pairs.unionByName(least.select("a", F.col("m").alias("b"))).distinct()
