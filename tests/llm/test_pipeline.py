"""The pipeline, stage by stage, against plain versions on a small table."""

from __future__ import annotations

from collections import Counter

import corpus_pipeline as pipeline
import duckdb
import pytest
import sentencepiece
from pyspark.sql import functions as F
from rowgauge.llm.mixing import mix
from rowgauge.llm.oracle import OP8
from rowgauge.llm.queries import MIX, domain_labels, piece_model
from rowgauge.llm.storage import settle

from .test_simjoin import brute

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark):
    docs = [spark.read.parquet(f"{SF}/documents.parquet")]
    for name, stage in pipeline.STAGES:
        docs.append(settle(stage(spark, docs[-1], SF), "stage"))
    return docs


def rows(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_language_keeps_known(stages):
    assert stages[1].columns == stages[0].columns
    assert rows(stages[1]) == rows(stages[0])


def test_language_rejects(spark):
    given = spark.read.parquet(f"{SF}/documents.parquet")
    odd = [(90_001, None), (90_002, "123"), (90_003, "これは日本語の文章です" * 20)]
    more = spark.createDataFrame([(i, t, "en", "x", 1) for i, t in odd], given.schema)
    kept = pipeline.known_language(spark, given.union(more), SF)
    assert kept.where("doc_id > 90000").count() == 0 and kept.count() == given.count()


def test_lines(spark, stages):
    con = duckdb.connect()
    frame = stages[1].toPandas()  # noqa: F841  read by the next statement
    con.execute("CREATE TABLE documents AS SELECT * FROM frame")
    want = con.execute(f"SELECT doc_id, n_lines - n_dropped, kept_sha256 FROM ({OP8})").fetchall()
    import hashlib

    found = rows(stages[2])
    assert stages[2].columns == stages[0].columns and len(found) == len(want)
    for i, _, sha in want:
        assert hashlib.sha256(found[i]["text"].encode()).hexdigest() == sha
        assert found[i]["n_chars"] == len(found[i]["text"])


def test_near_copies(stages):
    before = [(r["doc_id"], r["text"]) for r in stages[2].collect()]
    heads = {root for _, root, _ in brute(before)}
    assert set(rows(stages[3])) == heads and stages[3].count() == len(heads)
    assert stages[3].columns == stages[0].columns


def test_mixing(spark, stages):
    want = {r["doc_id"]: r["copies"] for r in mix(stages[3], domain_labels(spark, SF), MIX).collect() if r["copies"]}
    assert Counter(r["doc_id"] for r in stages[4].collect()) == want
    assert stages[4].columns == stages[0].columns


def test_pieces(stages):
    library = sentencepiece.SentencePieceProcessor(model_proto=piece_model())
    texts = {r["doc_id"]: r["text"] for r in stages[4].collect()}
    for r in stages[5].collect():
        assert r["ids"] == library.encode(texts[r["doc_id"]]) and r["n_tokens"] == len(r["ids"])


def test_run(spark, stages):
    want = sorted((r["doc_id"], r["n_tokens"]) for r in stages[5].collect())
    assert sorted((r["doc_id"], r["n_tokens"]) for r in pipeline.run(spark, SF).select("doc_id", "n_tokens").collect()) == want


def test_odd_documents(spark):
    given = spark.read.parquet(f"{SF}/documents.parquet").limit(40)
    odd = [(None, "the and of that this is of the"), (70_001, "the of and"), (70_001, "the of and"), (70_002, "The and of that\n" * 9000), (70_003, ""), (70_004, None)]
    docs = given.union(spark.createDataFrame([(i, t, None, None, None) for i, t in odd], given.schema))
    docs = docs.selectExpr("*", "'x' AS key", "1 AS copies", "2 AS row", "3 AS score", "4 AS rejected")
    for name, stage in pipeline.STAGES:
        before, docs = docs, settle(stage(spark, docs, SF), "stage")
        assert name == "pieces" or docs.columns == before.columns
    assert docs.count() > 30
    for _, stage in pipeline.STAGES:
        assert stage(spark, before.limit(0), SF).count() == 0


def test_no_language_to_learn(spark):
    """Without labels nothing can be rejected: all documents stay, with a warning."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumn("lang", F.lit(None).cast("string"))
    with pytest.warns(UserWarning, match="no labelled text"):
        kept = pipeline.known_language(spark, docs, SF)
    assert kept.columns == docs.columns and kept.count() == docs.count()
    assert pipeline.known_language(spark, docs.limit(0), SF).count() == 0
