"""The operators' queries against SQL, and their shape on empty and odd tables."""

import math

import duckdb
import pytest
from pyspark.sql import functions as F

from tidemark.llm.oracle import ORACLE
from tidemark.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, node string, label int, bucket int"
ODD = [
    (1, None, "en", "a", 0, "x", 1, 1),
    (2, "", None, None, 0, None, None, None),
    (None, "one two three", "en", "a", 13, "x", 1, 1),
    (3, "same words here " * 30, "en", "b", None, "y", 2, 2),
    (3, "same words here " * 30, "en", "b", None, "y", 2, 2),
    (4, "\u0001 \u0002\n\n\té ß 漢字 password=abcdef0123456789ab " + "w " * 20000, "xx", "b", 5, "z", 0, 0),
]


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_equals_sql(spark, name):
    link = duckdb.connect()
    for table in ("documents", "benchmark", "conversations"):
        link.execute(f"create view {table} as select * from '{SF}/{table}.parquet'")
    want = link.execute(ORACLE[name]).df()
    got = QUERIES[name](spark, SF).toPandas()
    columns = sorted(want.columns)
    assert sorted(got.columns) == columns
    rows = [sorted(map(repr, frame[columns].itertuples(index=False, name=None))) for frame in (got, want)]
    assert rows[0] == rows[1]


def write_tables(spark, path, documents):
    spark.createDataFrame(documents, DOCS).write.parquet(f"{path}/documents.parquet")
    labels = [(1, 1, 0), (3, 0, 0), (None, 1, 1), (4, None, 0), (3, 1, 0)] if documents else []
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    items = [(1, "one two three"), (2, None), (3, ""), (1, "one two three")] if documents else []
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    pages = [(1, "u", None), (2, None, ""), (None, "v", "<p>a<p>b</div><!")] if documents else []
    spark.createDataFrame(pages, "page_id long, url string, html string").write.parquet(f"{path}/pages.parquet")
    vectors = [(1, [0.5, None]), (2, None), (None, [0.5, 1.0]), (3, [float("nan"), 0.0]), (4, [-2.0, 3.0]), (4, [-2.0, 3.0])] if documents else []
    spark.createDataFrame(vectors, "vec_id long, embedding array<float>").write.parquet(f"{path}/embeddings.parquet")
    turns = [(1, 0, "a", "x"), (1, 0, "a", "x"), (1, None, None, None), (None, 1, "b", "<|end|>"), (2, 1, "system", "s")] if documents else []
    spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").write.parquet(f"{path}/conversations.parquet")
    return path


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_odd_and_empty_tables(spark, tmp_path, name):
    odd = write_tables(spark, str(tmp_path / "odd"), ODD)
    empty = write_tables(spark, str(tmp_path / "empty"), [])
    rows = QUERIES[name](spark, odd).collect()
    assert QUERIES[name](spark, empty).collect() == []
    if name.split("_")[0] in ("op2", "op3", "op4", "op5", "op8", "op12"):
        assert len(rows) == len(ODD)
    if name == "op6_html_extraction":
        assert sorted(r["text"] for r in rows) == ["", "", "a\nb\n<!"]
    if name == "op1_chat_perspectives":
        assert {(r["conv_id"], r["perspective"], r["block"], r["n_turns"]) for r in rows} == {(1, "a", 0, 1), (1, "a", -1, 1), (None, "b", 0, 1)}
    if name == "op5_katz_scores":
        assert all(r["n_tokens"] >= 1 and not math.isnan(r["score"]) for r in rows)
    if name == "op10_secret_scan":
        assert [r["is_secret"] for r in rows] == [True]


def test_pipeline_keeps_clean_documents(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = corpus_pipeline.run(spark, SF)
    assert len(corpus_pipeline.STAGES) == 5
    assert out.select("doc_id").distinct().count() > 0.5 * docs.count()
    assert out.filter(F.col("text").rlike("AKIA[0-9A-Z]{16}|password=[0-9a-f]{18}")).isEmpty()
