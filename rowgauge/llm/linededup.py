"""Line dedup: drop lines whose normalised form occurs in many documents.

Lines are exploded, normalised and hashed; distinct pairs of hash and document
id are dealt by both, then counted per hash with partial aggregation, so a line
that every document has weighs one row per task in the count.
Only positions of dropped lines travel back to their documents, which are
reassembled by position. Rows with one id are one document, counted once; all of
them lose its common lines. A null id is no document that counts, as in SQL's
count(DISTINCT doc_id), but its rows lose common lines too.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .keys import row_key
from .storage import settle

#: Stripped at both ends of a line: the blank and U+0009 to U+000D.
BLANKS = " \t\n\x0b\x0c\r"


def ascii_lower(text: Column) -> Column:
    """A to Z in lower case; all else as it is."""
    plain = F.octet_length(text) == F.length(text)
    return F.when(plain, F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    )


def line_keys(text: Column) -> Column:
    """The normalised lines of a text, an array in order; a null text is one empty line."""
    lines = F.split(ascii_lower(F.coalesce(text, F.lit(""))), "\n", -1)
    return F.transform(lines, lambda line: F.btrim(line, F.lit(BLANKS)))


def _hash(value: Column) -> Column:
    return F.unhex(F.md5(value))


def common_lines(docs: DataFrame, id_col: str = "doc_id", text: str = "text", min_docs: int = 10) -> DataFrame:
    """``line_hash, n_docs`` of the normalised lines, not empty, that at least ``min_docs`` documents hold: distinct ids, null aside."""
    told = docs.where(docs[id_col].isNotNull())
    keys = told.select(told[id_col].alias("id"), F.explode(F.array_distinct(line_keys(told[text]))).alias("key")).where("key != ''")
    counts = keys.groupBy(_hash(F.col("key")).alias("line_hash")).agg(F.count_distinct("id").alias("n_docs"))
    return counts.where(F.col("n_docs") >= min_docs)


def drop_common_lines(
    docs: DataFrame, id_col: str = "doc_id", text: str = "text", min_docs: int = 10
) -> DataFrame:
    """``row`` (the input row, a struct), ``kept``, ``n_lines``, ``n_dropped`` for every row of ``docs``.

    A null or empty text is one empty line, which is never dropped; a document
    that loses all its lines keeps the empty text. Null ids are kept. Columns of
    the input can have any names: they stay inside ``row``.
    """
    rows = docs.select(
        F.struct(*[docs[c] for c in docs.columns]).alias("row"),
        F.coalesce(docs[text], F.lit("")).alias("body"),
        row_key(docs[id_col], docs[text]).alias("row_key"),
    )
    # as a table of its own it meets the lines in a join that Spark may broadcast by its size, and whose
    # hot partitions, those of a line that a third of all rows hold, it can split
    common = settle(common_lines(docs, id_col, text, min_docs).select("line_hash"), "common-lines")
    at = rows.select("row_key", F.posexplode(line_keys(F.col("body"))).alias("pos", "key")).where("key != ''")
    dropped = (
        at.select("row_key", "pos", _hash(F.col("key")).alias("line_hash"))
        .join(common, "line_hash")
        .groupBy("row_key")
        .agg(F.collect_set("pos").alias("gone"))  # no more than the lines of one text
    )
    lines = F.split("body", "\n", -1)
    places = F.sequence(F.lit(0), F.size(lines) - 1)
    return (
        rows.join(dropped, "row_key", "left")
        .withColumn("lines", lines)
        .withColumn("stay", F.when(F.col("gone").isNull(), places).otherwise(F.array_except(places, "gone")))
        .select(
            "row",
            F.when(F.col("gone").isNull(), F.col("body"))
            .otherwise(F.array_join(F.transform("stay", lambda p: F.get("lines", p)), "\n"))
            .alias("kept"),
            F.size("lines").cast("long").alias("n_lines"),
            (F.size("lines") - F.size("stay")).cast("long").alias("n_dropped"),
        )
    )


def without_common_lines(docs: DataFrame, min_docs: int = 10) -> DataFrame:
    """``docs`` with common lines taken out of ``text``, and ``n_chars`` (if there) counted anew."""
    found = drop_common_lines(docs, min_docs=min_docs)
    new = {"text": F.col("kept"), "n_chars": F.length("kept").cast("long")}
    return found.select(*[new.get(c, F.col("row")[c]).alias(c) for c in docs.columns])
