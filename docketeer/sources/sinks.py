"""Written tables. Tables are written in place of one file per verdict."""

from __future__ import annotations

import hashlib
import os
import uuid
from collections.abc import Iterable

from pyspark import TaskContext
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docketeer import schema
from docketeer.operators.bayes import Model
from docketeer.operators.tables import ranked_by, sorted_by


def csv_ready(df: DataFrame) -> DataFrame:
    """Nested columns as JSON text, as CSV has no lists."""
    nested = (T.ArrayType, T.StructType, T.MapType)
    return df.select(
        *(
            F.to_json(f.name).alias(f.name) if isinstance(f.dataType, nested) else F.col(f.name)
            for f in df.schema.fields
        )
    )


def write_csv(df: DataFrame, path: str) -> None:
    csv_ready(df).write.option("header", True).option("escape", '"').csv(path)


def write_sorted_csv(names: DataFrame, by_first: str, by_last: str, key: str | None = None) -> None:
    """The name table twice, sorted by first and by last name, nulls last.

    The files of a folder follow each other in that order. With a ``key``, by which ties go, every
    row has its ``rank``, which says the order whatever becomes of the files.
    """
    for column, path in (("first_name", by_first), ("last_name", by_last)):
        if key is None:
            write_csv(sorted_by(names, column), path)
        else:
            write_csv(ranked_by(names, column, key).orderBy("rank"), path)


def verdict_documents(flat: DataFrame) -> DataFrame:
    """The flat table in the package form: file_name and ``Doc Details`` with Hebrew keys."""
    details = [F.col(r).alias(k) for r, k in schema.ROLE_KEYS.items()]
    details += [
        F.col(f"{r}_normalized").alias(k + schema.NORMALIZED_SUFFIX)
        for r, k in schema.ROLE_KEYS.items()
    ]
    others = {
        "summary": schema.SUMMARY_KEY,
        "date_text": schema.DATE_KEY,
        "pages": schema.PAGES_KEY,
        "doc_type": schema.DOC_TYPE_KEY,
        "case_no": schema.CASE_NO_KEY,
        "extra": schema.EXTRA_KEY,
        "category": "Category",
    }
    details += [F.col(c).alias(k) for c, k in others.items()]
    return flat.select("file_name", F.col("id").alias("_id"), F.struct(*details).alias("Doc Details"))


def write_verdicts(flat: DataFrame, path: str, one_per_file: bool = False, compression: str = "none") -> None:
    """The package form, as JSON lines or, where a reader wants it so, a file for each verdict.

    Single files are moved into place by the tasks that wrote them, not by the driver one by one;
    a task that is run again replaces the files of its first run.
    """
    documents = verdict_documents(flat)
    if one_per_file and compression == "none" and (folder := _local_folder(flat.sparkSession, path)):
        _write_each(documents, path, folder)
        return
    writer = documents.write.options(ignoreNullFields=False, compression=compression)
    if one_per_file:
        writer = writer.option("maxRecordsPerFile", 1)
        writer = writer.option("mapreduce.fileoutputcommitter.algorithm.version", 2)
    writer.json(path)


def _hadoop_path(spark: SparkSession, path: str) -> tuple:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def _local_folder(spark: SparkSession, path: str) -> str | None:
    """The folder as tasks can open it by themselves, or None where only Spark's writers reach it."""
    where, store = _hadoop_path(spark, path)
    return store.makeQualified(where).toUri().getPath() if store.getUri().getScheme() == "file" else None


def _write_each(documents: DataFrame, path: str, folder: str) -> None:
    """A file for each row, as Spark's writer of JSON lines has them.

    That writer starts a process to set the permissions of every file in a local or mounted folder,
    and of its checksum, which takes many times as long as writing it.
    """
    where, store = _hadoop_path(documents.sparkSession, path)
    if store.exists(where):
        raise AnalysisException(f"[PATH_ALREADY_EXISTS] Path {path} already exists.")
    store.mkdirs(where)
    run = uuid.uuid4()

    def write(rows: Iterable[Row]) -> None:
        task = TaskContext.get()
        os.makedirs(folder, exist_ok=True)
        # Readers and streams pass over a hidden file; another attempt of the task has its own.
        hidden = f"{folder}/.part-{run}-{task.taskAttemptId()}"
        for i, row in enumerate(rows):
            with open(hidden, "w", encoding="utf-8", newline="") as file:
                file.write(row[0] + "\n")
            os.replace(hidden, f"{folder}/part-{task.partitionId():05}-{run}-c{i:06}.json")

    line = F.to_json(F.struct(*documents.columns), {"ignoreNullFields": "false"})
    documents.select(line).rdd.foreachPartition(write)
    store.create(store.makeQualified(where.suffix("/_SUCCESS"))).close()


def write_routed(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Good and failed rows side by side, as status=success and status=failed, in one pass."""
    status = F.when(F.col("error_reason").isNull(), "success").otherwise("failed")
    df.withColumn("status", status).write.mode(mode).partitionBy("status").parquet(path)


def write_by_category(assigned: DataFrame, path: str) -> None:
    named = assigned.where("category IS NOT NULL AND category <> ''")
    named.write.partitionBy("category").parquet(path)


def write_matches(matches: DataFrame, path: str) -> None:
    matches.write.parquet(path)


def write_report(report: DataFrame, path: str) -> None:
    """The evaluation report, a folder per category."""
    report.withColumnRenamed("model", "category").write.partitionBy("category").parquet(path)


# What scoring joins the terms on, and a model is stored by.
TERM_KEY = ("n", "t1", "t2")
CELL = "cell int, model string, n int, "
TERMS = CELL + "t1 long, t2 long, gram string, df long, idf double, log_p0 double, log_p1 double"
CLASSES = CELL + "n_docs long, n_terms long, log_prior0 double, log_prior1 double"


def _stored(spark: SparkSession, path: str, buckets: int) -> str:
    """The name under which the terms at ``path`` are a table in so many buckets; the files stay."""
    name = f"model_terms_{hashlib.md5(path.encode()).hexdigest()}"
    by = ", ".join(TERM_KEY)
    place = path.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(
        f"CREATE TABLE {name} ({TERMS}) USING parquet CLUSTERED BY ({by}) SORTED BY ({by})"
        f" INTO {buckets} BUCKETS LOCATION '{place}/terms'"
    )
    return name


def save_model(model: Model, path: str, buckets: int | None = None) -> None:
    """Store a model, its terms in buckets of n-gram size and term.

    Texts that are scored are then moved to the buckets of their terms, and the model stays where
    it is. There are as many buckets as a shuffle has partitions, unless told otherwise; a session
    with more partitions than that moves the model again.
    """
    spark = model.terms.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    columns = [c.split()[0] for c in TERMS.split(", ")]
    # One file for each bucket.
    spread = model.terms.select(*columns).repartition(buckets, *TERM_KEY)
    name = _stored(spark, path, buckets)
    spread.write.bucketBy(buckets, *TERM_KEY).sortBy(*TERM_KEY).format("parquet").mode("append").saveAsTable(name)
    model.classes.withColumn("buckets", F.lit(buckets)).write.parquet(f"{path}/classes")


def load_model(spark: SparkSession, path: str) -> Model:
    classes = spark.read.schema(f"{CLASSES}, buckets int").parquet(f"{path}/classes")
    # The same in all rows, one for each category and size; a model without any has no terms.
    found = classes.select("buckets").first()
    terms = spark.table(_stored(spark, path, found["buckets"] if found else 1))
    return Model(terms, classes.drop("buckets"))
