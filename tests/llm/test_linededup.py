"""Line dedup against a plain version."""

from __future__ import annotations

import random
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F
from rowgauge.llm.linededup import BLANKS, ascii_lower, drop_common_lines, without_common_lines
from rowgauge.llm.oracle import OP8


def key(line):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(BLANKS))


def plain(texts, least):
    held = Counter(k for t in texts for k in {key(x) for x in (t or "").split("\n")} if k)
    common = {k for k, n in held.items() if n >= least}
    for t in texts:
        lines = (t or "").split("\n")
        stay = [x for x in lines if key(x) not in common]
        yield "\n".join(stay), len(lines), len(lines) - len(stay)


@pytest.mark.parametrize("seed", range(3))
def test_against_plain(spark, seed):
    rng = random.Random(seed)
    pool = ["", " ", "a", "A ", "\tÉ", "é", "x y", "\x0bx Y\r", "ß", "İ", "long " * 30, "\x85odd", " nbsp"]
    texts = ["\n".join(rng.choice(pool) + rng.choice(["", "", str(rng.randrange(30))]) for _ in range(rng.randrange(9))) for _ in range(80)]
    rows = [(i, t, "r") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, kept string").repartition(4)
    found = drop_common_lines(docs, min_docs=6).select("row.doc_id", "kept", "n_lines", "n_dropped").orderBy("doc_id").collect()
    assert [tuple(r)[1:] for r in found] == list(plain(texts, 6))


def test_odd_rows(spark):
    rows = [(i, "shared\nown %d" % i) for i in range(9)] + [(9, None), (10, ""), (11, "\n"), (None, "shared"), (None, "shared"), (12, "SHARED \n" * 20_000 + "end"), (12, "b")]
    docs = spark.createDataFrame([(i, t, "s", 1, "k") for i, t in rows], "doc_id long, text string, line_hash string, n_chars long, row_key string")
    want = sorted(zip([i for i, _ in rows], plain([t for _, t in rows], 10)), key=repr)
    found = drop_common_lines(docs, min_docs=10).select("row.doc_id", "kept", "n_lines", "n_dropped").collect()
    assert sorted(((r[0], tuple(r)[1:]) for r in found), key=repr) == want
    kept = without_common_lines(docs, 10)
    assert kept.columns == docs.columns and kept.count() == len(rows)
    assert all(r["n_chars"] == len(r["text"]) for r in kept.collect())
    assert without_common_lines(docs.limit(0), 10).count() == 0


def test_ascii_lower(spark):
    texts = ["ABC", "ÀBÇ", "", "ΣΑΣ A", "I İ ı"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", ascii_lower(F.col("t")).alias("l")).collect()
    assert all(r["l"] == "".join(c.lower() if c.isascii() else c for c in r["t"]) for r in rows)


def test_repeated_rows_are_one_document(spark):
    rows = [(i, "shared\nown %d" % i) for i in range(10)] + [(20, "one page\nalone")] * 10 + [(30 + i, "nine hold it") for i in range(9)] + [(30, "nine hold it")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = drop_common_lines(docs, min_docs=10).select("row.doc_id", "kept", "n_lines", "n_dropped").collect()
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    want = {i: (n, gone) for i, n, gone, _ in con.execute(OP8).fetchall()}
    got = {i: tuple(sum(r[c] for r in found if r["doc_id"] == i) for c in ("n_lines", "n_dropped")) for i in want}
    assert len(found) == len(rows) and got == want
    assert all(r["kept"] == "one page\nalone" for r in found if r["doc_id"] == 20)
    # nor do rows without an id make a line common
    none = spark.createDataFrame([(None, f"no id\n{i}") for i in range(12)], docs.schema)
    assert drop_common_lines(docs.union(none), min_docs=10).where("row.doc_id IS NULL").agg(F.sum("n_dropped")).first()[0] == 0


def test_a_null_id_beside_a_clashing_text(spark):
    """The row without an id, whose text is another row's id and text, keeps the line that it alone has."""
    rows = [(i, f"foo\nbar{i}") for i in range(1, 12)] + [(None, "1:foo\nbar1")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = {r["doc_id"]: r for r in drop_common_lines(docs, min_docs=10).select("row.doc_id", "kept", "n_dropped").collect()}
    assert found[None]["kept"] == "1:foo\nbar1" and found[None]["n_dropped"] == 0
    assert found[1]["kept"] == "bar1"
    con = duckdb.connect()
    con.register("documents", docs.toPandas().astype({"doc_id": "Int64"}))
    want = {r[0]: (r[1], r[2]) for r in con.execute(f"SELECT doc_id, n_lines, n_dropped FROM ({OP8})").fetchall()}
    assert want[None] == (2, 0) and want[1] == (2, 1)
