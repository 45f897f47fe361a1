"""A corpus made ready for training: five stages, each a written table that the next one reads.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame. All but the last
return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontaminate, mixing, neardup, quality, secrets
from tidemark.llm.tables import stored

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: Not for SQL: the classifier, the forest and the sketches have no SQL form.
ORACLE_SQL = None


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str, threshold: float = 0.7) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = quality.fit(docs, labels.filter(~quality.held_out()))
    return quality.score(docs.select(*COLUMNS), model).filter(F.col("score") >= threshold).select(*COLUMNS)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates: that of the smallest doc_id."""
    return neardup.without_copies(docs.select(*COLUMNS))


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated; the check is repeated on no other row."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.clean(docs.select(*COLUMNS), items)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets replaced and n_chars counted anew where one was."""
    redacted = secrets.redact(docs.select(*COLUMNS, F.col("text").alias("_text")))
    changed = ~F.col("text").eqNullSafe(F.col("_text"))
    return redacted.withColumn("n_chars", F.when(changed, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(*COLUMNS)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each reading of a document in the mix of its sources."""
    return mixing.mix(docs.select(*COLUMNS)).select(*COLUMNS, "n_tokens", F.col("epoch").cast("long").alias("epoch"), "block", F.col("place").cast("long").alias("place"))


STAGES = [
    ("quality classifier", good_documents),
    ("near duplicates", without_near_copies),
    ("benchmark decontamination", without_benchmark),
    ("secret scan", without_secrets),
    ("mixing", mixed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
