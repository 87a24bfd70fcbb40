"""From raw documents to a training mix, in stages that each call one operator."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docketeer.llm import decontaminate, mixing, quality, secrets, simhash
from docketeer.session import settled

SHINGLE_WORDS, MOST_BITS = 3, 2


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that meet the base rules and that the model finds good."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    model = quality.fit(docs.select("doc_id", "text"), labels)
    return quality.assess(docs, model).where("kept").select("row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return simhash.keep_one(docs, size=SHINGLE_WORDS, distance=MOST_BITS)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text")
    return decontaminate.contamination(docs, items).where("n_hit = 0").select("row.*")


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with a mark in place of every secret, and the length of the new text."""
    found = secrets.find_secrets(docs).withColumn("clean", secrets.redact(F.col("row.text"), F.col("spans")))
    new = {
        "text": F.col("clean"),
        "n_chars": F.when(F.size("spans") > 0, F.length("clean").cast("long")).otherwise(F.col("row.n_chars")),
    }
    return found.select(*(new.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: every document as often as its source's target takes it."""
    return mixing.mix(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("SimHash near-dedup", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("secret scans", secret_scan),
    ("mixing sources to target weights", source_mix),
]

# The model, the randomness tests and the rounding are not for SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written before the next one reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = settled(stage(spark, docs, sf_dir), f"stage-{i}")
    return docs
