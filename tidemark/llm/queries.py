"""One query for each operator, over its whole tables and with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.chat import perspectives
from tidemark.llm.collocations import collocations
from tidemark.llm.decontaminate import contamination
from tidemark.llm.html import main_texts
from tidemark.llm.katz import scores
from tidemark.llm.mixing import mix
from tidemark.llm.neardup import classes
from tidemark.llm.quality import held_out, quality_scores
from tidemark.llm.rules import judged
from tidemark.llm.secrets import scan
from tidemark.llm.simhash import near_duplicates
from tidemark.llm.substrings import spans
from tidemark.llm.whiten import whitened


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_chat_perspectives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every dialogue as each participant sees it; the mask as `characters`x`0 or 1`, joined by commas."""
    made = perspectives(_table(spark, sf_dir, "conversations"))
    runs = F.transform("mask", lambda m: F.concat_ws("x", m["n"].cast("string"), m["learn"].cast("int").cast("string")))
    return made.withColumn("mask", F.array_join(runs, ","))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The base counts and the log-likelihood ratio of every document; documents labelled good are trusted."""
    trusted = _table(spark, sf_dir, "labels").filter("quality = 1").select("doc_id")
    return judged(_table(spark, sf_dir, "documents"), trusted)


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its words inside windows of the benchmark."""
    return contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op4_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its class of near-duplicates."""
    return classes(_table(spark, sf_dir, "documents"))


def op5_katz_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The Katz and the base score of every document, learned from four fifths of them."""
    documents, fold = _table(spark, sf_dir, "documents"), held_out(5, 1)
    return scores(documents, ~fold).withColumn("held_out", fold)


def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return main_texts(_table(spark, sf_dir, "pages"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every reading of a document in the mix: its epoch, and its block's place in that epoch's permutation."""
    mixed = mix(_table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "source", "n_tokens", F.col("epoch").cast("long").alias("epoch"), "block", F.col("place").cast("long").alias("place"))


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality score of every document."""
    return quality_scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every span of words that repeats, and whether it goes."""
    return spans(_table(spark, sf_dir, "documents"))


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every candidate with the forest's verdict; the value itself only as its digest."""
    found = scan(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.col("start").cast("long").alias("start"), F.col("length").cast("long").alias("length"), F.sha2("found", 256).alias("found_sha256"), "probability", "is_secret")


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 2000 phrases of each lang by the score of their weakest cut."""
    return collocations(_table(spark, sf_dir, "documents"))


def op12_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its SimHash fingerprint and its component of links."""
    return near_duplicates(_table(spark, sf_dir, "documents"))


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every usable vector on the first four components, whitened."""
    return whitened(_table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_chat_perspectives": op1_chat_perspectives,
    "op2_quality_rules": op2_quality_rules,
    "op3_decontamination": op3_decontamination,
    "op4_minhash_dedup": op4_minhash_dedup,
    "op5_katz_scores": op5_katz_scores,
    "op6_html_extraction": op6_html_extraction,
    "op7_mixing": op7_mixing,
    "op8_quality_classifier": op8_quality_classifier,
    "op9_substring_dedup": op9_substring_dedup,
    "op10_secret_scan": op10_secret_scan,
    "op11_collocations": op11_collocations,
    "op12_simhash_dedup": op12_simhash_dedup,
    "op13_embedding_whitening": op13_embedding_whitening,
}
