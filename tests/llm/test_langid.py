"""The language models against plain sums, and held-out accuracy."""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pytest
from rowgauge.llm import langid
from pyspark.sql import functions as F
from rowgauge.llm.langid import held_out, identify, normal, train

SF = "/root/testdata/sf0.01"


def text_of(chars) -> str:
    return chars.tobytes().decode("utf-32-le")


def test_normal():
    assert text_of(normal("  A--b--Ç x a1b9 ")) == " a b ç x "
    assert text_of(normal("a1b9")) == " a b "
    assert len(normal("12 .!")) == 0 and len(normal("")) == 0


def test_normal_reads_what_stands_beside_digits():
    assert text_of(normal("今天是2024年3月1日我们去公园 ok")) == " 今天是 年 月 日我们去公园 ok "
    assert text_of(normal("12,the,house,3\nhttp://a.b/the-page?id=7 ok")) == " the house http a b the page id ok "
    assert text_of(normal("le café2 5го Ünï7x")) == " le café го ünï "
    assert text_of(normal("the1of2and3that4 ok")) == " the of and that ok "  # codes are no more than half
    assert len(normal("x" * 100_000 + " 1")) == 100_002


def test_dated_lines_are_judged_whole(spark, model):
    page = "\n".join(f"これは日本語の文章です2024年{i}月1日" for i in range(1, 13)) + "\nthe"
    row = identify(spark.createDataFrame([(1, page)], "doc_id long, text string"), model).first()
    assert row["rejected"]


def plain_p(counts: Counter, gram: str, order: int) -> float:
    """Interpolated Kneser-Ney straight from its definition."""
    def level(n):
        if n == order:
            return counts
        out = Counter()
        for g in level(n + 1):
            out[g[1:]] += 1
        return out

    n = len(gram)
    table = level(n)
    once, twice = (sum(1 for c in table.values() if c == k) for k in (1, 2))
    d = once / (once + 2 * twice) if once and twice else 0.5
    after = {g: c for g, c in table.items() if g[:-1] == gram[:-1]}
    low = plain_p(counts, gram[1:], order) if n > 1 else 1 / (len(level(1)) + 1)
    if not after:
        return low
    total = sum(after.values())
    return max(after.get(gram, 0) - d, 0) / total + d * len(after) / total * low


def test_tables_follow_the_definition():
    samples = {"a": "the then than that thin this the cat", "b": "ein eine einer den dem der die das"}
    order = 3
    counts = {}
    for lang, t in samples.items():
        line = " " * (order - 2) + text_of(normal(t))
        counts[lang] = Counter(line[i : i + order] for i in range(len(line) - order + 1))
    model = langid._assemble(counts, order)
    for probe in ("then", "einen xyz", "q", "das that zz"):
        chars = normal(probe)
        line = " " * (order - 2) + text_of(chars)
        entropy, size = model.scored([chars])
        assert size[0] == len(line) - order + 1
        for i, lang in enumerate(model.langs):
            want = -sum(math.log(plain_p(counts[lang], line[j : j + order], order)) for j in range(size[0])) / size[0]
            assert entropy[0][i] == pytest.approx(want, rel=1e-9)
    # texts scored together are scored as if alone
    several = [normal(t) for t in ("then", "x", "ein das")]
    assert np.allclose(model.scored(several)[0], np.concatenate([model.scored([t])[0] for t in several]))


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")


@pytest.fixture(scope="module")
def model(docs):
    return train(docs.where(~held_out(docs.doc_id)))


def test_accuracy_and_rejection(spark, docs, model):
    found = identify(docs, model, keep=("doc_id", "lang")).collect()
    assert len(found) == docs.count()
    right = sum(r["lang"] == r["lang_pred"] for r in found)
    assert right >= 0.99 * len(found)
    assert not [r for r in found if r["rejected"]]
    assert all(0 <= r["score"] <= 1 for r in found)
    odd = [(1, None), (2, ""), (3, "12 !?"), (4, "これは日本語の文章です" * 9), (5, "qzxj vwkq xxqj zzkw " * 20), (None, "The and of the")]
    rows = identify(spark.createDataFrame(odd, "doc_id long, text string"), model).collect()
    by = {r["doc_id"]: r for r in rows}
    assert [by[i]["lang_pred"] for i in (1, 2, 3)] == ["und"] * 3 and by[1]["score"] == 0.0
    assert all(by[i]["rejected"] for i in (1, 2, 3, 4, 5)) and not by[None]["rejected"]
    assert by[4]["lang_pred"] in model.langs


def test_copies_and_long(spark, model):
    rows = [(1, "the and of that " * 50_000, "en"), (1, "the and of that ", None), (1, "the and of that ", None)]
    found = identify(spark.createDataFrame(rows, "doc_id long, text string, lang_pred string"), model).collect()
    assert len(found) == 3 and {r["lang_pred"] for r in found} == {"en"}


def test_nothing_to_learn(spark):
    none = spark.createDataFrame([], "doc_id long, text string, lang string")
    model = train(none)
    assert identify(none, model).count() == 0
    one = spark.createDataFrame([(1, "abc", None)], "doc_id long, text string, lang string")
    assert [r["lang_pred"] for r in identify(one, train(one)).collect()] == ["und"]


def test_ids_do_not_matter(spark):
    """Null ids, or one id for all, learn what others learn; a text that many rows have is sampled once."""
    from rowgauge.llm.langid import sample_labelled

    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    want = sample_labelled(docs, "lang", "text", 50)
    texts = lambda df: sorted(tuple(r) for r in df.collect())
    assert 100 < want.count() < 400
    for other in (docs.withColumn("doc_id", F.lit(None).cast("long")), docs.withColumn("doc_id", F.lit(1).cast("long")), docs.union(docs)):
        assert texts(sample_labelled(other, "lang", "text", 50)) == texts(want)
    nobody = train(docs.withColumn("doc_id", F.lit(None).cast("long")))
    assert nobody.langs == train(docs).langs != []
