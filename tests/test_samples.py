"""Every issue row has its samples, whatever orders the rows."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from rowgauge import Rule, RuleSet, assess, evaluate
from rowgauge.operators.checks import as_type

NOW = "2024-03-01T06:30:00+00:00"


def orders(spark, n=400):
    rows = spark.range(n).withColumnRenamed("id", "row_id")
    k = F.col("row_id")
    return rows.select(
        "row_id",
        F.when(k % 9 == 0, k - 1).otherwise(k).alias("order_id"),
        F.when(k % 7 == 0, "bad").otherwise("a@b.c").alias("email"),
        F.lit("CA").alias("country"),
        F.when(k % 5 == 0, "x").otherwise("1.5").alias("amount"),
        F.lit(NOW).cast("timestamp").alias("order_ts_utc"),
        F.when(k % 11 != 0, F.lit(NOW).cast("timestamp")).alias("ingest_ts_utc"),
    )


KEYS = {
    "named": lambda df: (df, "row_id"),
    "generated": lambda df: (df.drop("row_id"), None),
    "nulls": lambda df: (df.withColumn("row_id", F.when(F.col("row_id") % 3 != 0, F.col("row_id"))), "row_id"),
    "all null": lambda df: (df.withColumn("row_id", F.lit(None).cast("bigint")), "row_id"),
    "text": lambda df: (df.withColumn("row_id", F.concat(F.lit("r"), F.col("row_id"))), "row_id"),
    "repeated": lambda df: (df.withColumn("row_id", F.col("row_id") % 4), "row_id"),
}
INPUTS = {
    "scanned": lambda spark, df: df,
    "dealt": lambda spark, df: df.repartition(7),
    "joined": lambda spark, df: df.join(spark.createDataFrame([("CA", 1)], "country string, region int"), "country"),
}


@pytest.mark.parametrize("key", KEYS)
@pytest.mark.parametrize("given", INPUTS)
def test_five_or_all(spark, tmp_path, key, given):
    path = str(tmp_path / "orders")
    orders(spark).repartition(3).write.parquet(path)
    df, row_id = KEYS[key](INPUTS[given](spark, spark.read.parquet(path)))
    found = assess(df, run_ts=NOW, row_id=row_id).issues.collect()
    assert {r.rule: r.failed_count for r in found} == {
        "required_columns_present": 37, "min_amount:0.0": 80, "email_format": 58, "primary_key:order_id": 88, "max_delay_minutes:720": 37,
    }
    for r in found:
        most = 3 if r.rule == "required_columns_present" else 5
        assert len(json.loads(r.sample_values)) == min(most, r.failed_count), (key, given, r)


def test_named_order_is_kept(spark):
    found = assess(orders(spark), run_ts=NOW, row_id="row_id").issues.where("rule = 'primary_key:order_id'").first()
    assert json.loads(found.sample_values) == [8, 8, 17, 17, 26]


def test_excused_nulls(spark):
    df = spark.createDataFrame([(i, k) for i, k in enumerate([1, 1, None, None, None, 2])], "row_id long, k long")
    rules = [Rule(n, "Uniqueness", "unique", ("k",), nulls_fail=f) for n, f in (("all", True), ("named", False))]
    for chosen in ([rules[0]], [rules[1]], rules):
        got = {r.rule: (r.failed_count, r.sample_values) for r in evaluate(df, RuleSet(tuple(chosen)), row_id="row_id").rules.collect()}
        assert got.get("all", (5, "[1, 1, null, null, null]")) == (5, "[1, 1, null, null, null]")
        assert got.get("named", (2, "[1, 1]")) == (2, "[1, 1]")


@pytest.mark.parametrize(
    "kind,allowed,passing",
    [
        ("string", [1, True, "b", 2.5], ["1", "true", "b", "2.5"]),
        ("int", [1, "2", "x", 3.5, "", True, float("nan")], [1, 2]),
        ("double", ["1.5", 2, "nope"], [1.5, 2.0]),
        ("decimal(9,2)", ["1.50", 3], ["1.50", "3.00"]),
        ("boolean", ["true", 0, "maybe"], [True]),
        ("date", ["2024-01-02", "soon"], ["2024-01-02"]),
    ],
)
def test_allowed_values_of_any_type(spark, kind, allowed, passing):
    texts = ["1", "2", "3", "0", "true", "false", "b", "1.5", "1.50", "2.5", "2.0", "3.00", "2024-01-02", "2024-01-03", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(F.col("t").try_cast(kind).alias("v")).distinct()
    rule = Rule("r", "Validity", "in_set", ("v",), {"allowed": allowed})
    from rowgauge.operators.checks import rule_failed

    kept = {str(r.v) for r in df.where(~rule_failed(df, rule)).collect()}
    assert kept == {str(x) for x in passing}
    assert as_type("zz", df.schema["v"].dataType) is None or kind in ("string", "date")
