"""Word lists, rosters, dictionaries and name files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docketeer.operators.order import ranked

# Up to this many words a list is put into expressions as literals.
LITERAL_WORDS = 10_000


def _without_bom(column: str):
    return F.regexp_replace(column, "^\\uFEFF", "")


def read_words(spark: SparkSession, path: str) -> DataFrame:
    """(word): the first column of a CSV list."""
    raw = spark.read.schema("word string").option("escape", '"').csv(path)
    return raw.select(_without_bom("word").alias("word")).where("word IS NOT NULL")


def short_list(words: DataFrame, most: int = LITERAL_WORDS) -> list[str] | None:
    """The distinct words as a Python list, or None if there are more than ``most``.

    Longer lists are joined instead, by ``tokens.remove_listed_tokens``.
    """
    rows = words.select("word").distinct().orderBy("word").limit(most + 1).collect()
    return None if len(rows) > most else [r.word for r in rows]


def read_roster(spark: SparkSession, path: str) -> DataFrame:
    """(pos, line): the lines of a roster in their order, of one file or of parts by their names.

    Files are read in splits; the lines are numbered from 0 on, those of all parts together.
    """
    raw = spark.read.text(path).select(
        _without_bom("value").alias("line"),
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_row"),
    )
    # Within a block the rows of a task are in file order.
    numbered = ranked(raw, [F.col("_file"), F.col("_block"), F.col("_row")], "pos")
    return numbered.select((F.col("pos") - 1).cast("int").alias("pos"), "line")


def read_dictionary(spark: SparkSession, path: str) -> DataFrame:
    """(before, after) from a two-column CSV; the last row of a key wins.

    Leading blanks belong to a key.
    """
    raw = spark.read.schema("before string, after string").option("escape", '"').csv(path)
    place = F.struct(
        "_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id()
    )
    rows = raw.select(_without_bom("before").alias("before"), "after", place.alias("_place"))
    named = rows.where("before IS NOT NULL")
    return named.groupBy("before").agg(F.max_by("after", "_place").alias("after"))


def read_category_list(spark: SparkSession, path: str) -> DataFrame:
    """(case_no, category1, category2) from the assignment CSV."""
    columns = "case_no string, category1 string, category2 string"
    return spark.read.schema(columns).option("escape", '"').csv(path)


def read_ngram_sizes(spark: SparkSession, path: str) -> DataFrame:
    """(model, n) from the JSON map of categories."""
    raw = spark.read.schema("Categories map<string,int>").option("multiLine", True).json(path)
    return raw.select(F.explode("Categories").alias("model", "n"))


def read_name_files(spark: SparkSession, path: str) -> DataFrame:
    """(name, role) from ``*``-separated files, the role being the file name's stem.

    The mark is the reader's line separator, so a large file is read in splits. Files
    end with the mark, after which one empty name follows.
    """
    raw = spark.read.option("lineSep", "*").text(path)
    role = F.split_part("_metadata.file_name", F.lit("."), F.lit(1)).alias("role")
    names = raw.select(F.col("value").alias("name"), role)
    ends = names.select("role").distinct().select(F.lit("").alias("name"), "role")
    return names.unionByName(ends)


def write_names(names: DataFrame, path: str) -> None:
    """The (role, name) table, one folder of ``*``-separated parts per role."""
    names.select("role", "name").write.partitionBy("role").option("lineSep", "*").text(path)


def name_role_files(spark: SparkSession, path: str, out: str) -> None:
    """Give the parts that :func:`write_names` wrote the names of their roles, as role.0.txt and so on.

    Files are renamed, not read: as many as roles times the tasks that wrote them.
    """
    hadoop = spark._jvm.org.apache.hadoop.fs
    at = lambda p: hadoop.Path(p)
    files = at(path).getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(at(out))
    for folder in files.listStatus(at(path)):
        name = folder.getPath().getName()
        if folder.isDirectory() and name.startswith("role="):
            parts = [f.getPath() for f in files.listStatus(folder.getPath()) if f.getPath().getName().startswith("part-")]
            for i, part in enumerate(parts):
                files.rename(part, at(f"{out}/{name.removeprefix('role=')}.{i}.txt"))


def read_names(spark: SparkSession, path: str) -> DataFrame:
    raw = spark.read.option("lineSep", "*").text(path)
    return raw.select("role", F.col("value").alias("name"))
