"""Single-value semantics on literal rows."""

from __future__ import annotations

from datetime import datetime

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowgauge.functions import display, values
from rowgauge.model import DEFAULT_EMAIL_PATTERN
from rowgauge.operators import checks


def column(spark, items, build, dtype=T.StringType()):
    schema = T.StructType([T.StructField("i", T.IntegerType()), T.StructField("v", dtype)])
    df = spark.createDataFrame(list(enumerate(items)), schema)
    return [r[0] for r in df.select(build(F.col("v")).alias("o"), "i").orderBy("i").select("o").collect()]


def test_numbers(spark):
    texts = ["1", "1d", "0x1A", " 2 ", "inf", "1e3", "1_000", "1,000", "12abc", "nan", None, "1F ", "0x1p3", "-Infinity", "+.5", ""]
    assert column(spark, texts, lambda c: values.to_number(c, T.StringType())) == [
        1.0, None, None, 2.0, float("inf"), 1000.0, None, None, None, None, None, None, None, float("-inf"), 0.5, None,
    ]
    assert column(spark, [1.5, float("nan"), None], lambda c: values.to_number(c, T.DoubleType()), T.DoubleType()) == [1.5, None, None]


def test_email(spark):
    texts = ["a@b.c", "a b@c.d", "a\xa0b@c.d", "x@y", None, "", "a@b.c\n", "a@b.c\r\n", "a@@b.c", "see a@b.c"]
    matched = column(spark, texts, lambda c: values.matches(c, DEFAULT_EMAIL_PATTERN))
    assert matched == [True, False, False, False, False, False, True, False, False, False]


def test_match_starts_at_the_start(spark):
    assert column(spark, ["ab", "xab", "AB"], lambda c: values.matches(c, "a|b")) == [True, False, False]
    assert column(spark, ["ab", "xab", "AB"], lambda c: values.matches(c, "ab", True)) == [True, False, True]


def test_strip(spark):
    texts = ["\tq\t", "\xa0q ", "\u3000q\xa0q\u3000", " \x1f\x85", None, "q"]
    assert column(spark, texts, values.strip) == [t.strip() if t is not None else None for t in texts]


def test_missing_tokens(spark):
    assert column(spark, ["", "NA", "NaN", "null", "None", " q ", "na", None], values.null_tokens) == [
        None, None, None, None, None, " q ", "na", None,
    ]


def test_timestamps(spark):
    texts = ["2024-01-02", "2024-01-02 03:04:05", "2024-01-02T03:04:05+02:00", "03:04:05", "not a time", None, "2024-02-30", "2024-01-02T03:04:05.678Z"]
    got = column(spark, texts, lambda c: values.to_utc(c, T.StringType()).cast("timestamp_ntz"))
    assert got == [
        datetime(2024, 1, 2), datetime(2024, 1, 2, 3, 4, 5), datetime(2024, 1, 2, 1, 4, 5), None, None, None, None,
        datetime(2024, 1, 2, 3, 4, 5, 678000),
    ]
    day_first = column(spark, ["02.01.2024"], lambda c: values.to_utc(c, T.StringType(), "dd.MM.yyyy").cast("timestamp_ntz"))
    assert day_first == [datetime(2024, 1, 2)]
    nanos = column(spark, [1_704_164_645_123_456_789, -1, None], lambda c: values.to_utc(c, T.LongType()).cast("timestamp_ntz"), T.LongType())
    assert nanos == [datetime(2024, 1, 2, 3, 4, 5, 123456), datetime(1969, 12, 31, 23, 59, 59, 999999), None]


def test_delay_bounds(spark):
    rows = [(0, 0), (0, 720 * 60), (0, -1), (0, 720 * 60 + 1), (None, 0), (0, None)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, e long, a long")
    df = df.select("i", F.timestamp_seconds("e").alias("e"), F.timestamp_seconds("a").alias("a"))
    late = df.select(checks.bad_delay(df, "e", "a", 720).alias("o"), "i").orderBy("i").collect()
    assert [r.o for r in late] == [False, False, True, True, True, True]


def test_rounding_on_ties(spark):
    bounds = (8, 40, 200, 400, 800, 1600, 4000, 8000, 15000)
    pairs = [(a, b) for b in bounds for a in range(0, b + 1)]
    df = spark.createDataFrame(pairs, "a long, b long")
    share = F.col("a") / F.col("b")
    got = df.select("a", "b", values.round_score((1 - share) * 100), values.round_share(share * 100)).collect()
    for a, b, score, failed in got:
        assert score == float(np.round((1.0 - np.float64(a) / b) * 100.0, 2))
        assert failed == round(a / b * 100.0, 2)
    assert column(spark, [0.125, 2.675, 99.985], values.round_score, T.DoubleType()) == [0.12, 2.68, 99.98]


def test_sample_json(spark):
    def item(dtype):
        return lambda c: values.json_scalar(values.sample_value(c, dtype))

    assert column(spark, ["a", None, "", 'q"\\\n', "é"], item(T.StringType())) == ['"a"', "null", '""', '"q\\"\\\\\\n"', '"é"']
    assert column(spark, [1, None], item(T.LongType()), T.LongType()) == ["1", "null"]
    assert column(spark, [1.5, float("nan"), float("inf")], item(T.DoubleType()), T.DoubleType()) == ["1.5", "null", "null"]
    assert column(spark, [True], item(T.BooleanType()), T.BooleanType()) == ["true"]
    at = [datetime(2024, 1, 2, 3, 4, 5), datetime(2024, 1, 2, 3, 4, 5, 600000), None]
    assert column(spark, at, item(T.TimestampNTZType()), T.TimestampNTZType()) == [
        '"2024-01-02T03:04:05+00:00"', '"2024-01-02T03:04:05.600000+00:00"', "null",
    ]


def test_sample_text(spark):
    texts = ['["a", null, "", 1.5]', "[null]", None, "oops", '"x"', "  ", "[1, 2", "12", "null", '"x', " [true] "]
    assert column(spark, texts, display.sample_text) == ["a, 1.5", "", "", "oops", "x", "", "[1, 2", "12", "null", '"x', "true"]


def test_status(spark):
    got = column(spark, [95.0, 94.99, 85.0, 84.99, None], display.status, T.DoubleType())
    assert got == ["GOOD", "OK", "OK", "RISK", "RISK"]


def test_formats(spark):
    assert column(spark, [12.3, 100.0, None, float("nan")], display.fmt_pct, T.DoubleType()) == ["12.30%", "100.00%", "N/A", "N/A"]
    assert column(spark, [0.8599999, -1.0, 0.0, None], display.fmt_delta, T.DoubleType()) == ["+0.86 pp", "-1.00 pp", "+0.00 pp", "N/A"]
    assert column(spark, ["1.5", "x", None, "inf"], lambda c: display.number_or(c, -1.0)) == [1.5, -1.0, 0.0, -1.0]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(max_size=12), min_size=1, max_size=40))
def test_strip_and_json_agree_with_python(spark, texts):
    import json

    texts = [t for t in texts if not any(0xD800 <= ord(ch) <= 0xDFFF or ch == "\0" for ch in t)]
    if not texts:
        return
    assert column(spark, texts, values.strip) == [t.strip() for t in texts]
    quoted = column(spark, texts, lambda c: values.json_scalar(values.sample_value(c, T.StringType())))
    assert [json.loads(q) for q in quoted] == texts


def test_unknown_types_are_no_numbers(spark):
    df = spark.createDataFrame([("2024-01-01",)], "d string").select(F.col("d").cast("date").alias("d"))
    assert df.select(checks.below_minimum(df, "d", 0.0)).first()[0] is True


@pytest.mark.parametrize("value,expected", [(None, True), ("", True), (" ", False), ("x", False)])
def test_missing_text(spark, value, expected):
    df = spark.createDataFrame([(value,)], "s string")
    assert df.select(values.is_missing(df, "s")).first()[0] is expected


def test_percent_text_rounds_the_exact_value(spark):
    from decimal import ROUND_HALF_UP, Decimal

    given = [1.005, 1.015, 2.675, 0.125, 0.375, -0.125, 99.995, 12.345, 1e14, 0.0, 100.0, 33.333333, -1.005, 8.345]
    rows = spark.createDataFrame([(x,) for x in given], "x double").select("x", display.fmt_pct(F.col("x")).alias("t")).collect()
    for r in rows:
        want = Decimal(r.x).quantize(Decimal("0.01"), ROUND_HALF_UP)
        assert r.t == f"{want}%"
