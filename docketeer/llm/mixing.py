"""Mixing sources to target weights, by pivotal dependent rounding.

Every document of a source is to be taken the same number of times in expectation, its source's
target over its source's size. The whole part is certain; the fraction is rounded so that the
words of the source stay what they are: two documents with a fraction are paired, words move from
one to the other in a random direction until one of them is wholly in or out, and the other goes
on to the next pair. What a group of documents leaves open, one document, meets what other
groups leave in the next level of a tree, until a single document of each source is drawn alone.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docketeer.session import settled

WEIGHTS = (5.0, 2.0, 1.0)
MOST = 3
WORD = r"[^\x20\x09-\x0D]+"
# Documents of one group on the lowest level, and groups that meet on each further level.
GROUP, FAN = 4096, 1024
SEED = 20


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(
    sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: float = MOST
) -> DataFrame:
    """(source, rank, n_docs, source_size, target) from (source, size), null last.

    All words are shared by weight, the weights repeating in the order of the sources, but no
    source gets more than ``most`` times its size. That is the level L at which
    ``least(L * weight, most * size)`` adds up to all words: with the sources in the order in
    which a rising level fills them, the first one that its own level leaves unfilled gives it.
    The windows without a partition run over one row for each source.
    """
    cycle = F.array(*map(F.lit, weights))
    ordered = Window.orderBy(F.col("source").asc_nulls_last())
    sources = sizes.groupBy("source").agg(
        F.count(F.lit(1)).alias("n_docs"), F.sum("size").alias("source_size")
    )
    ranked = sources.withColumn("rank", F.row_number().over(ordered) - 1)
    weighed = ranked.withColumn(
        "weight", F.element_at(cycle, (F.col("rank") % len(weights) + 1).cast("int"))
    ).withColumn("full_at", most * F.col("source_size") / F.col("weight"))
    rising = Window.orderBy("full_at", "rank")
    before = F.coalesce(F.sum(most * F.col("source_size")).over(rising.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rest = F.sum("weight").over(rising.rowsBetween(0, Window.unboundedFollowing))
    every = Window.partitionBy()
    level = (F.sum("source_size").over(every) - before) / rest
    leveled = weighed.withColumn("own_level", level)
    fits = F.when(F.col("own_level") <= F.col("full_at"), F.struct("full_at", "rank", "own_level"))
    leveled = leveled.withColumn("level", F.min(fits).over(every)["own_level"])
    target = F.least(F.col("level") * F.col("weight"), most * F.col("source_size").cast("double"))
    return leveled.select(
        "source", "rank", "n_docs", "source_size", F.coalesce(target, most * F.col("source_size").cast("double")).alias("target")
    )


def _settle(mass: np.ndarray, size: np.ndarray, draw: np.random.Generator) -> tuple[np.ndarray, int]:
    """Round masses to nothing or the whole size, in place; the number of the one left, or -1.

    Returns which are whole. The sum of the masses does not change and each keeps its expectation.
    """
    whole = np.zeros(len(mass), bool)
    tiny = 1e-9 * np.maximum(size, 1)
    chance = draw.random(len(mass))
    left = -1
    for i in range(len(mass)):
        if mass[i] <= tiny[i]:
            mass[i] = 0
        elif mass[i] >= size[i] - tiny[i]:
            mass[i], whole[i] = size[i], True
        elif left < 0:
            left = i
        else:
            up = min(size[left] - mass[left], mass[i])
            down = min(mass[left], size[i] - mass[i])
            move = up if chance[i] * (up + down) < down else -down
            mass[left] += move
            mass[i] -= move
            pair, left = (left, i), -1
            for k in pair:
                if mass[k] <= tiny[k]:
                    mass[k] = 0
                elif mass[k] >= size[k] - tiny[k]:
                    mass[k], whole[k] = size[k], True
                else:
                    left = k
    return whole, left


def _level(rows: DataFrame, number: int) -> DataFrame:
    """Settle each group (rank, group) of a level; adds ``whole`` and ``left`` to its rows."""

    def run(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["doc_id", "size", "node"], kind="stable", na_position="last")
        mass, size = group["mass"].to_numpy(float).copy(), group["size"].to_numpy(float)
        draw = np.random.default_rng([SEED, number, int(key[0]), int(key[1])])
        whole, left = _settle(mass, size, draw)
        return group.assign(mass=mass, whole=whole, left=np.arange(len(group)) == left)

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    return rows.groupBy("rank", "group").applyInPandas(run, f"{kinds}, whole boolean, left boolean")


def plan_mix(
    df: DataFrame,
    key: str = "doc_id",
    source: str = "source",
    text: str = "text",
    weights: tuple[float, ...] = WEIGHTS,
    most: float = MOST,
) -> DataFrame:
    """(doc_id, source, size, source_size, target, copies, taken) for every row of ``df``.

    Sizes are words, so null and empty texts have none and are taken 0 words; a null source is a
    source, the last; rows with a null key, and repeated rows, are each rounded by themselves; an
    empty table gives an empty one; other columns are not looked at. The same rows give the same
    plan whatever their order and partitions. Texts are read once; what is written between the
    steps is the size table and, for each level, one row for each group of documents.
    """
    sizes = df.select(
        F.col(f"`{key}`").alias("doc_id"), F.col(f"`{source}`").alias("source"), word_count(F.col(f"`{text}`")).alias("size")
    )
    sizes = settled(sizes, "sizes")
    targets = settled(source_targets(sizes, weights, most), "targets")
    known = targets.withColumnRenamed("source", "its")
    rows = sizes.join(known, F.col("source").eqNullSafe(F.col("its"))).drop("its")
    times = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    sure = F.floor(times + 1e-12)
    # Nodes are spread by a hash, so a source of any size has groups of one size.
    groups = F.ceil(F.col("n_docs") / GROUP)
    rows = rows.select(
        "doc_id", "source", "size", "rank", "source_size", "target",
        sure.alias("sure"),
        (F.greatest(times - sure, F.lit(0.0)) * F.col("size")).alias("mass"),
        F.pmod(F.xxhash64("doc_id", "size"), groups).alias("group"),
    ).withColumn("node", F.col("group"))
    low = settled(_level(rows, 0), "level")

    decided = None
    nodes = low.where("left").select("doc_id", "size", "rank", "mass", "group", "node")
    widest = targets.agg(F.max(F.ceil(F.col("n_docs") / GROUP))).first()[0] or 0
    number = 0
    while widest > 1:
        number, widest = number + 1, -(-widest // FAN)
        met = settled(_level(nodes.withColumn("group", F.floor(F.col("group") / FAN)), number), "level")
        done = met.where("not left").select("rank", "node", "whole")
        decided = done if decided is None else decided.unionByName(done)
        nodes = met.where("left").select("doc_id", "size", "rank", "mass", "group", "node")
    # At most one document of each source is left, and drawn alone.
    unit = F.pmod(F.xxhash64(F.lit(SEED), "rank", "doc_id"), F.lit(1 << 30)) / F.lit(1 << 30)
    last = nodes.select("rank", "node", (unit * F.col("size") < F.col("mass")).alias("whole"))
    decided = last if decided is None else decided.unionByName(last)
    decided = decided.withColumnRenamed("whole", "chosen").withColumn("left", F.lit(True))
    extra = F.coalesce("chosen", "whole").cast("long")
    copies = (F.col("sure") + extra).cast("long")
    return low.join(decided, ["rank", "node", "left"], "left").select(
        "doc_id", "source", "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken")
    )


def mix(df: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text") -> DataFrame:
    """The mix itself: every row of ``df`` as often as :func:`plan_mix` takes it.

    Rows are put beside their plan by key, source and size, and by number where rows repeat.
    """
    numbered = ["doc_id", "source", "size"]
    plan = plan_mix(df, key, source, text).select(*numbered, "copies")
    by = Window.partitionBy(*numbered)
    plan = plan.withColumn("n", F.row_number().over(by.orderBy("copies")))
    whole = F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias("row")
    rows = df.select(
        whole,
        F.col(f"`{key}`").alias("doc_id"),
        F.col(f"`{source}`").alias("source"),
        word_count(F.col(f"`{text}`")).alias("size"),
    )
    content = F.xxhash64(*(F.col(f"row.`{c}`") for c in df.columns))
    rows = rows.withColumn("n", F.row_number().over(by.orderBy(content)))
    same = [rows[c].eqNullSafe(plan[c]) for c in (*numbered, "n")]
    on = same[0] & same[1] & same[2] & same[3]
    taken = rows.join(plan.where("copies > 0"), on).select("row", F.expr("sequence(1L, copies)").alias("each"))
    return taken.select("row", F.explode("each").alias("_copy")).select("row.*")
