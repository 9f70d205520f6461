"""Typed parts, escaping, and what the mask covers."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F
from rowgauge.llm.chat import PARTS, escaped, format_chat, read_turns, text_part, under_loss, unescaped

ALPHABET = ["<", "|", "\\", ">", "<|", "|>", "<|end|>\n", "<|turn ", "\n", "a", "é", "😀", "<\\|"]


def odd_text(rng):
    return "".join(rng.choice(ALPHABET) for _ in range(rng.randrange(12)))


def read_back(formatted):
    turns = read_turns(F.col("formatted"))
    return formatted.select("conv_id", "n_turns", turns.alias("turns"), under_loss(F.col("formatted"), F.col("loss_spans")).alias("loss"), "formatted")


@pytest.mark.parametrize("seed", range(3))
def test_round_trip(spark, seed):
    rng = random.Random(seed)
    rows = [(c, t, rng.choice(["user", "assistant", odd_text(rng)]), odd_text(rng)) for c in range(60) for t in range(rng.randrange(1, 7))]
    df = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string").repartition(5)
    found = read_back(format_chat(df.withColumn("parts", text_part(F.col("text"))))).collect()
    assert len(found) == 60
    for r in found:
        mine = sorted((x for x in rows if x[0] == r["conv_id"]), key=lambda x: x[1])
        assert [(t["role"], t["text"]) for t in r["turns"]] == [(x[2], x[3]) for x in mine]
        assert r["loss"] == "".join(x[3] for x in mine if x[2] == "assistant") and r["n_turns"] == len(mine)


def test_escapes_hide_controls(spark):
    rng = random.Random(9)
    texts = [odd_text(rng) for _ in range(2000)]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", escaped(F.col("t")).alias("e"), unescaped(escaped(F.col("t"))).alias("u")).collect()
    assert all("<|" not in r["e"] and r["u"] == r["t"] for r in rows)


def test_typed_parts(spark):
    parts = [
        ("text", "see ", None, None, None, None, None),
        ("image", None, "s3://a.png", 57, 28, None, None),
        ("Text", "and <|x", None, None, None, None, None),
        ("audio", None, "b.wav", None, None, 2.01, None),
        ("document", "ignored", "c.pdf", None, None, None, 3),
        ("image", None, None, None, None, None, None),
        ("video", "as text", "v", None, None, None, None),
        (None, None, None, None, None, None, None),
    ]
    rows = [(1, 0, "user", parts, "s"), (1, 1, "assistant", [("text", "two words", None, None, None, None, None)], "s"), (1, 2, None, None, "s"), (2, 0, "user", [], "s")]
    df = spark.createDataFrame(rows, f"conv_id long, turn int, role string, parts {PARTS}, formatted string")
    by = {r["conv_id"]: r for r in format_chat(df).collect()}
    one = by[1]
    assert one["formatted"] == (
        "<|turn user|>\nsee <|image|>and <\\|x<|audio|><|document|><|image|>as text<|end|>\n"
        "<|turn assistant|>\ntwo words<|end|>\n<|turn |>\n<|end|>\n"
    )
    assert [tuple(a) for a in one["attachments"]] == [
        (0, 0, "image", "s3://a.png", 3), (1, 0, "audio", "b.wav", 51), (2, 0, "document", "c.pdf", 768), (3, 0, "image", None, 1),
    ]
    assert one["n_tokens"] == 1 + 3 + 2 + 51 + 768 + 1 + 2 + 2
    a, b = one["loss_spans"][0]
    assert one["formatted"][a:b] == "two words" and by[2]["formatted"] == "<|turn user|>\n<|end|>\n"


def test_odd_rows(spark):
    rows = [(None, 0, "user", "a"), (None, 1, "assistant", None), (3, None, "assistant", "x"), (3, 0, "assistant", "y"), (3, 0, "assistant", "y"), (3, 0, "aaa", "z"), (4, 1, "user", "long " * 50_000)]
    df = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string").withColumn("parts", text_part(F.col("text")))
    by = {r["conv_id"]: r for r in read_back(format_chat(df)).collect()}
    assert [(t["role"], t["text"]) for t in by[None]["turns"]] == [("user", "a"), ("assistant", "")]
    assert [(t["role"], t["text"]) for t in by[3]["turns"]] == [("assistant", "x"), ("aaa", "z"), ("assistant", "y"), ("assistant", "y")]
    assert by[3]["loss"] == "xyy" and by[4]["turns"][0]["text"] == "long " * 50_000
    assert format_chat(df.limit(0)).count() == 0
