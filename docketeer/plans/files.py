"""Sources and sinks as queries: tables are written in every file form and read back.

Verdicts are made of documents; a file holds one of them where the reader takes a file for a
verdict, and many elsewhere. The others hold turns, parts or orders.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docketeer import schema
from docketeer.operators import bayes, lookup, tables
from docketeer.session import new_folder, spread
from docketeer.sources import lists, sinks, verdicts

# Letters from which a document is a long one here.
LONG = 2000


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _flat(rows: DataFrame, key: str) -> DataFrame:
    """Rows (key, text, category) as flat verdicts: words, and words in reverse, are the lists."""
    words = F.split("text", "\\s+")
    reverse = {f"{r}_normalized": F.reverse(words) for r in schema.ROLES}
    return rows.select(
        F.concat(F.col(key).cast("string"), F.lit(".json")).alias("file_name"),
        F.concat(F.lit("v"), F.col(key).cast("string")).alias("id"),
        F.col("text").alias("summary"),
        "category",
        *(words.alias(r) for r in schema.ROLES),
        *(v.alias(c) for c, v in reverse.items()),
        F.lit("1/2/2003").alias("date_text"),
        F.length("text").alias("pages"),
        F.lit("").alias("doc_type"),
        F.lit("").alias("case_no"),
        F.array("category").alias("extra"),
    )


def _items(spark: SparkSession, folder: str) -> DataFrame:
    """The documents as verdicts; the longer half of them is a category of its own."""
    kind = F.when(F.length("text") > LONG, "long").otherwise("short").alias("category")
    docs = spread(_table(spark, folder, "documents").select("doc_id", "text", kind), "doc_id")
    return _flat(docs, "doc_id")


def _shown(flat: DataFrame) -> DataFrame:
    """Ids and categories, and digests of the texts and lists."""
    table = verdicts.analysis_table(flat)
    lists_ = [c for c in table.columns if c not in ("id", "summary", "category")]
    digest = lambda c: F.md5(F.array_join(c, " ")).alias(c)
    return table.select("id", F.md5("summary").alias("summary"), "category", *map(digest, lists_))


def verdict_folder(spark: SparkSession, folder: str) -> DataFrame:
    """One JSON file a verdict, written and scanned, as the analysis table."""
    path = new_folder(spark, "verdicts")
    sinks.write_verdicts(_items(spark, folder), path, one_per_file=True)
    return _shown(verdicts.flatten_verdicts(verdicts.read_verdicts(spark, path)))


def two_folders(spark: SparkSession, folder: str) -> DataFrame:
    """Two input folders read as one."""
    items = _items(spark, folder)
    paths = {kind: new_folder(spark, kind) for kind in ("long", "short")}
    for kind, path in paths.items():
        sinks.write_verdicts(items.where(F.col("category") == kind), path, one_per_file=True)
    flat = verdicts.flatten_verdicts(verdicts.read_verdicts(spark, list(paths.values())))
    return flat.select("id", "category", F.size("judges").alias("n_judges"))


def index_dump(spark: SparkSession, folder: str) -> DataFrame:
    """A dump of the documents, sorted: of an id that repeats the last line stays, and every
    line without one."""
    docs = _table(spark, folder, "documents").select("doc_id", "text", F.col("lang").alias("category"))
    # Texts are put in order before the lists are made of them, which are ten times as large.
    flat = _flat(docs.repartitionByRange("doc_id").sortWithinPartitions("doc_id"), "doc_id")
    flat = flat.withColumn("id", F.when(F.col("category") != "es", F.concat_ws("-", "category", F.col("pages") % 50)))
    path = new_folder(spark, "dump")
    sinks.write_verdicts(flat, path, compression="gzip")
    read = verdicts.read_index_dump(spark, path)
    return verdicts.flatten_verdicts(read, keep=["_id"]).select("_id", "category", F.md5("summary").alias("digest"))


def verdict_csv(spark: SparkSession, folder: str) -> DataFrame:
    path = new_folder(spark, "csv")
    sinks.write_csv(_items(spark, folder).select("id", "summary", "extra"), path)
    return spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)


def labelled_tree(spark: SparkSession, folder: str) -> DataFrame:
    """A folder for each category; the label is the folder's name."""
    items = _items(spark, folder)
    path = new_folder(spark, "tree")
    for kind in ("long", "short"):
        sinks.write_verdicts(items.where(F.col("category") == kind), f"{path}/{kind}", one_per_file=True)
    return verdicts.read_labelled_tree(spark, path).select("label", "id", "category")


def word_list(spark: SparkSession, folder: str) -> DataFrame:
    path = new_folder(spark, "words")
    names = _table(spark, folder, "part").select("p_name")
    names.write.option("escape", '"').csv(path)
    return lists.read_words(spark, path)


def roster_file(spark: SparkSession, folder: str) -> DataFrame:
    """A text file in many parts that are in order: the parts' names by their first part."""
    path = new_folder(spark, "roster")
    names = _table(spark, folder, "part").groupBy("p_name").agg(F.min("p_partkey").alias("first"))
    names.repartitionByRange("first").sortWithinPartitions("first").select("p_name").write.text(path)
    return lists.read_roster(spark, path)


def category_list(spark: SparkSession, folder: str) -> DataFrame:
    """The assignment list as a file, with its quoted values and empty second categories."""
    path = new_folder(spark, "assignments")
    status = F.when(F.col("o_orderstatus") != "F", F.concat(F.lit('a "b", '), "o_orderstatus"))
    orders = _table(spark, folder, "orders").select(
        F.concat_ws("/", "o_orderkey", F.col("o_orderkey") % 100).alias("case_no"), "o_orderpriority", status.alias("s")
    )
    orders.write.option("escape", '"').csv(path)
    return lists.read_category_list(spark, path)


def ngram_sizes(spark: SparkSession, folder: str) -> DataFrame:
    """The sizes chosen for categories, a JSON map; here the most words of a part's name by brand."""
    path = new_folder(spark, "sizes")
    sizes = _table(spark, folder, "part").groupBy("p_brand").agg(F.max(F.size(F.split("p_name", " "))).alias("n"))
    # One map in one file, as many entries as there are categories.
    whole = sizes.agg(F.map_from_entries(F.collect_list(F.struct("p_brand", "n"))).alias("Categories"))
    whole.write.json(path)
    return lists.read_ngram_sizes(spark, path)


def role_files(spark: SparkSession, folder: str) -> DataFrame:
    """Files of names by role, the role being the file's stem, with the empty name at the end of each."""
    turns = _table(spark, folder, "conversations")
    path, files = new_folder(spark, "names"), new_folder(spark, "role-files")
    lists.write_names(turns.select("role", F.replace("text", F.lit("*"), F.lit(" ")).alias("name")), path)
    lists.name_role_files(spark, path, files)
    return lists.read_name_files(spark, files).groupBy("role", "name").agg(F.count(F.lit(1)).alias("n"))


def report_folders(spark: SparkSession, folder: str) -> DataFrame:
    """A report of each category, written to its folder and read back."""
    docs = _table(spark, folder, "documents")
    long = (F.length("text") > LONG).cast("int").alias("label")
    said = (F.col("source") > "m").cast("int").alias("predicted")
    predicted = docs.select(F.col("lang").alias("model"), F.lit(1).alias("n"), long, said)
    path = new_folder(spark, "report")
    sinks.write_report(bayes.classification_report(predicted), path)
    measures = [F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")]
    return spark.read.parquet(path).select("category", "class", *measures, "support")


def dictionary_file(spark: SparkSession, folder: str) -> DataFrame:
    path = new_folder(spark, "pairs")
    part = _table(spark, folder, "part").groupBy("p_name").agg(F.max("p_brand").alias("after"))
    part.write.option("escape", '"').csv(path)
    return lists.read_dictionary(spark, path)


def name_files(spark: SparkSession, folder: str) -> DataFrame:
    path = new_folder(spark, "names")
    turns = _table(spark, folder, "conversations")
    lists.write_names(turns.select("role", F.replace("text", F.lit("*"), F.lit(" ")).alias("name")), path)
    return lists.read_names(spark, path)


def category_folders(spark: SparkSession, folder: str) -> DataFrame:
    """Line items copied to folders of their order's priority, and read from there."""
    orders = _table(spark, folder, "orders")
    status = F.when(F.col("o_orderstatus") == "F", "").otherwise(F.col("o_orderstatus"))
    case = F.concat_ws("/", "o_orderkey", F.col("o_orderkey") % 100)
    listed = orders.select(case.alias("case_no"), F.col("o_orderpriority").alias("category1"), status.alias("category2"))
    ids = _table(spark, folder, "lineitem").select(
        F.concat_ws("-", "l_orderkey", F.col("l_orderkey") % 100, "l_linenumber").alias("id")
    )
    path = new_folder(spark, "categories")
    sinks.write_by_category(lookup.assign_categories(listed, ids), path)
    return spark.read.parquet(path).groupBy("category").agg(F.count(F.lit(1)).alias("n"))


def matching_files(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").where(F.contains("text", F.lit("tion")))
    path = new_folder(spark, "matches")
    sinks.write_matches(docs, path)
    return spark.read.parquet(path).select("doc_id", F.md5("text").alias("digest"))


def sorted_csv(spark: SparkSession, folder: str) -> DataFrame:
    """The name table in two orders, with each row's place in them, ties by part."""
    names = tables.with_first_and_last(
        _table(spark, folder, "part").select("p_partkey", F.col("p_name").alias("full_name")), "full_name"
    )
    paths = [new_folder(spark, "first"), new_folder(spark, "last")]
    sinks.write_sorted_csv(names, *paths, key="p_partkey")
    kinds = "p_partkey long, full_name string, first_name string, last_name string, rank long"
    each = [
        spark.read.schema(kinds).option("header", True).option("escape", '"').csv(path).withColumn("sorted_by", F.lit(by))
        for path, by in zip(paths, ("first", "last"), strict=True)
    ]
    return each[0].unionByName(each[1])


def column_subsets(spark: SparkSession, folder: str) -> DataFrame:
    """The (category, role) pairs of the analysis table, raw and normalized."""
    docs = _table(spark, folder, "documents").select("doc_id", "text", F.col("lang").alias("category"))
    pairs = tables.category_role_pairs(_flat(docs, "doc_id"), schema.ROLES)
    return pairs.select("id", "category", "role", F.md5(F.array_join("names", " ")).alias("names"), F.md5(F.array_join("normalized", " ")).alias("normalized"))


def drop_missing(spark: SparkSession, folder: str) -> DataFrame:
    """Orders without the ones whose priority is taken as unknown here."""
    known = F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority"))
    orders = _table(spark, folder, "orders").select("o_orderkey", known.alias("priority"))
    return tables.drop_missing(orders, ["priority"])


QUERIES = {
    f.__name__: f
    for f in (
        verdict_folder,
        two_folders,
        index_dump,
        verdict_csv,
        labelled_tree,
        word_list,
        roster_file,
        category_list,
        ngram_sizes,
        role_files,
        report_folders,
        dictionary_file,
        name_files,
        category_folders,
        matching_files,
        sorted_csv,
        column_subsets,
        drop_missing,
    )
}

_ID = "'v' || doc_id"
_KIND = f"CASE WHEN length(text) > {LONG} THEN 'long' ELSE 'short' END"
_WORDS = r"string_split_regex(text, '[\s\x0b]+')"
_ROLE_COLUMNS = ", ".join(
    f"md5(array_to_string({_WORDS}, ' ')) AS {r}, md5(array_to_string(list_reverse({_WORDS}), ' ')) AS {r}_normalized"
    for r in schema.ROLES
)
_ROLE_LIST = "[" + ", ".join(f"'{r}'" for r in schema.ROLES) + "]"
_STATUS = "CASE WHEN o_orderstatus = 'F' THEN '' ELSE o_orderstatus END"

ORACLES = {
    "verdict_folder": f"SELECT {_ID} AS id, md5(text) AS summary, {_KIND} AS category, {_ROLE_COLUMNS} FROM documents",
    "two_folders": f"""SELECT {_ID} AS id, {_KIND} AS category, CAST(len({_WORDS}) AS INTEGER) AS n_judges
      FROM documents""",
    "index_dump": """
      WITH rows AS (SELECT doc_id, lang AS category, md5(text) AS digest,
        CASE WHEN lang <> 'es' THEN lang || '-' || (length(text) % 50) END AS _id FROM documents)
      SELECT _id, category, digest FROM rows
      QUALIFY _id IS NULL OR row_number() OVER (PARTITION BY _id ORDER BY doc_id DESC) = 1""",
    "verdict_csv": f"""SELECT {_ID} AS id, text AS summary, '["' || {_KIND} || '"]' AS extra FROM documents""",
    "labelled_tree": f"SELECT {_KIND} AS label, {_ID} AS id, {_KIND} AS category FROM documents",
    "word_list": "SELECT p_name AS word FROM part",
    "roster_file": """SELECT CAST(row_number() OVER (ORDER BY first) - 1 AS INTEGER) AS pos, p_name AS line
      FROM (SELECT p_name, min(p_partkey) AS first FROM part GROUP BY p_name)""",
    "category_list": """SELECT o_orderkey || '/' || (o_orderkey % 100) AS case_no, o_orderpriority AS category1,
      CASE WHEN o_orderstatus <> 'F' THEN 'a "b", ' || o_orderstatus END AS category2 FROM orders""",
    "ngram_sizes": """SELECT p_brand AS model, CAST(max(len(string_split(p_name, ' '))) AS INTEGER) AS n
      FROM part GROUP BY p_brand""",
    "role_files": """SELECT role, name, count(*) AS n FROM (
        SELECT role, replace(text, '*', ' ') AS name FROM conversations
        UNION ALL SELECT DISTINCT role, '' FROM conversations) GROUP BY ALL""",
    "report_folders": f"""
      WITH said AS (SELECT lang AS category, CAST(length(text) > {LONG} AS INTEGER) AS label,
                           CAST(source > 'm' AS INTEGER) AS predicted FROM documents),
      each AS (SELECT category, c AS class, sum((label = c AND predicted = c)::INT) AS tp,
                      sum((label = c)::INT) AS support, sum((predicted = c)::INT) AS said
               FROM said, (SELECT unnest([0, 1]) AS c) GROUP BY ALL HAVING support + said > 0),
      rates AS (SELECT *, CASE WHEN said = 0 THEN 0 ELSE tp / said END AS precision,
                       CASE WHEN support = 0 THEN 0 ELSE tp / support END AS recall, 2 * tp / (said + support) AS f1 FROM each)
      SELECT category, class::VARCHAR AS class, round(precision, 6) AS precision, round(recall, 6) AS recall,
             round(f1, 6) AS f1, support::BIGINT AS support FROM rates
      UNION ALL SELECT category, 'accuracy', NULL, NULL, round(sum(tp) / sum(support), 6), sum(support)::BIGINT
        FROM rates GROUP BY category
      UNION ALL SELECT category, 'macro avg', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6),
        sum(support)::BIGINT FROM rates GROUP BY category
      UNION ALL SELECT category, 'weighted avg', round(sum(precision * support) / sum(support), 6),
        round(sum(recall * support) / sum(support), 6), round(sum(f1 * support) / sum(support), 6),
        sum(support)::BIGINT FROM rates GROUP BY category""",
    "dictionary_file": "SELECT p_name AS before, max(p_brand) AS after FROM part GROUP BY p_name",
    "name_files": "SELECT role, replace(text, '*', ' ') AS name FROM conversations",
    "category_folders": f"""
      SELECT category, count(*) AS n FROM (
        SELECT unnest(list_distinct([o_orderpriority, {_STATUS}])) AS category
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey) WHERE category <> '' GROUP BY category""",
    "matching_files": "SELECT doc_id, md5(text) AS digest FROM documents WHERE contains(text, 'tion')",
    "sorted_csv": """
      SELECT *, unnest(['first', 'last']) AS sorted_by, unnest([
          row_number() OVER (ORDER BY first_name COLLATE "C" NULLS LAST, p_partkey),
          row_number() OVER (ORDER BY last_name COLLATE "C" NULLS LAST, p_partkey)]) AS rank FROM (
        SELECT p_partkey, p_name AS full_name,
               CASE WHEN len(t) = 2 THEN t[1] END AS first_name, CASE WHEN len(t) = 2 THEN t[2] END AS last_name
        FROM (SELECT *, string_split(p_name, ' ') AS t FROM part))""",
    "column_subsets": f"""SELECT 'v' || doc_id AS id, lang AS category, unnest({_ROLE_LIST}) AS role,
        md5(array_to_string({_WORDS}, ' ')) AS names,
        md5(array_to_string(list_reverse({_WORDS}), ' ')) AS normalized FROM documents""",
    "drop_missing": "SELECT o_orderkey, o_orderpriority AS priority FROM orders WHERE o_orderpriority <> '5-LOW'",
}
