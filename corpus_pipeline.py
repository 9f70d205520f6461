"""The corpus pipeline: documents of a known language, without shared lines or near copies, mixed and encoded.

Each stage takes (spark, docs, sf_dir) and gives a DataFrame, which is written
as Parquet in the shared folder and reread as the next one's documents.
"""

from __future__ import annotations

import warnings

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowgauge.llm import langid
from rowgauge.llm.linededup import without_common_lines
from rowgauge.llm.mixing import mixed
from rowgauge.llm.pieces import encode_pieces
from rowgauge.llm.queries import MIX, domain_labels, piece_model, table
from rowgauge.llm.simjoin import without_near_copies
from rowgauge.llm.storage import settle

#: Documents that share a line before it is dropped from all of them.
SHARED_LINE = 10

#: SQL can't express the language models, the join's forest, the mixing or the pieces.
ORACLE_SQL = None


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the models know; those that they reject go.

    Where no document has a language and a text to learn from, nothing can be told and all stay, with a warning.
    """
    model = langid.train(docs)
    if not model.langs:
        if not docs.isEmpty():
            warnings.warn("no labelled text to learn languages from: no document is rejected", stacklevel=2)
        return docs
    others = [c for c in docs.columns if c != "text"]
    rows = docs.select(F.struct(*[docs[c] for c in others]).alias("row"), "text")
    kept = langid.identify(rows, model, keep=("row", "text")).where("NOT rejected")
    return kept.select(*[F.col("text") if c == "text" else F.col("row")[c].alias(c) for c in docs.columns])


def own_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that many share; ``n_chars`` follows the text."""
    return without_common_lines(docs, SHARED_LINE)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies."""
    return without_near_copies(docs)


def in_proportion(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of clean, poor and toxic tokens asks for."""
    return mixed(docs, domain_labels(spark, sf_dir), MIX)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, source, n_tokens, ids``."""
    found = encode_pieces(docs, piece_model(), keep=("doc_id", "source"))
    return found.select("doc_id", "source", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES = [
    ("language id", known_language),
    ("line dedup", own_lines),
    ("near copies", one_of_each),
    ("mixing", in_proportion),
    ("pieces", encoded),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
