"""Duplicate flags under hot keys, against brute force."""

from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

from rowgauge.operators import uniqueness
from rowgauge.operators.checks import Check
from rowgauge.operators.scoring import first_failures
from rowgauge.operators.uniqueness import flag_duplicates


def skewed(spark, rows=30_000):
    """A third of the rows share one key, some share null, the rest are nearly unique."""
    k = F.col("id")
    key = F.when(k % 3 == 0, F.lit(7)).when(k % 50 == 1, F.lit(None)).when(k % 10 == 2, k - 1).otherwise(k + 100)
    return spark.range(rows).select(k.alias("row_id"), key.alias("key"))


def expected(df):
    rows = df.select("row_id", "key").collect()
    sizes = Counter(r["key"] for r in rows)
    return {r["row_id"]: sizes[r["key"]] > 1 for r in rows}


def test_hot_key(spark):
    df = skewed(spark).repartition(8)
    flagged = flag_duplicates(df, ["key"], "row_id", "dup")
    got = flagged.collect()
    assert len(got) == 30_000
    assert {r["row_id"]: r["dup"] for r in got} == expected(df)
    assert flagged.columns == ["row_id", "key", "dup"]


def test_without_hot_keys_and_with_shuffle_join(spark, monkeypatch):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for share in (1, 1000, 10**9):
            monkeypatch.setattr(uniqueness, "hot_share", lambda df, n=share: n)
            df = skewed(spark, 3000)
            got = {r["row_id"]: r["dup"] for r in flag_duplicates(df, ["key"], "row_id", "dup").collect()}
            assert got == expected(df)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_hot_rows_spread(spark):
    """The slot stays among the join keys, so that a hot key's rows do not meet in one task."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        flagged = flag_duplicates(skewed(spark), ["key"], "row_id", "dup")
        plan = flagged._jdf.queryExecution().executedPlan().toString()
        assert any("hashpartitioning" in line and "_slot" in line for line in plan.splitlines())
        flagged = flagged.withColumn("task", F.spark_partition_id())
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        sizes = [r["count"] for r in flagged.groupBy("task").count().collect()]
        assert max(sizes) < 30_000 / 4
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


@pytest.mark.parametrize(
    "keys,flags",
    [([1, None, None, 2, 2], [False, True, True, True, True]), ([None, 1], [False, False])],
)
def test_null_keys(spark, keys, flags):
    df = spark.createDataFrame(list(enumerate(keys)), "row_id int, key int")
    got = flag_duplicates(df, ["key"], "row_id", "dup").orderBy("row_id").collect()
    assert [r["dup"] for r in got] == flags


def test_nan_is_a_missing_key(spark):
    df = spark.createDataFrame([(0, float("nan")), (1, None), (2, 0.0), (3, -0.0), (4, 1.0)], "row_id int, key double")
    got = flag_duplicates(df, ["key"], "row_id", "dup").orderBy("row_id").collect()
    assert [r["dup"] for r in got] == [True, True, True, True, False]


def test_first_duplicates_come_from_all_keys(spark):
    """Keys 30,30,20,20,10,10 interleaved: the five first rows, whatever their keys."""
    df = spark.createDataFrame(
        list(enumerate([30, 20, 99, 30, 20, 30, 10, 30, 10, 98])), "row_id long, key long"
    )
    sample = F.struct(F.col("key").cast("string").alias("text"), F.lit(None).cast("timestamp").alias("time"), F.lit(True).alias("bare"))
    check = Check("Uniqueness", "k", "key", keys=("key",), sample=sample)
    rows = first_failures(df, [check], "row_id", ()).orderBy("rank").collect()
    assert [r["item"] for r in rows] == ["30", "20", "30", "20", "30"]


def test_first_duplicates_per_run_under_hot_keys(spark, monkeypatch):
    """The same samples whether keys count as hot or not, as brute force finds them."""
    df = skewed(spark, 3000).withColumn("run", F.pmod("row_id", F.lit(4)))
    rows = [(r["run"], r["key"], r["row_id"]) for r in df.collect()]
    sizes = Counter((run, key) for run, key, _ in rows)
    repeated = sorted(((i, run, key) for run, key, i in rows if sizes[run, key] > 1), key=lambda r: r[0])
    wanted = {n: [(i, key) for i, run, key in repeated if run == n][:5] for n in range(4)}
    sample = F.struct(F.col("key").cast("string").alias("text"), F.lit(None).cast("timestamp").alias("time"), F.lit(True).alias("bare"))
    check = Check("Uniqueness", "k", "key", keys=("key",), sample=sample)
    for share in (1, 1000, 10**9):
        monkeypatch.setattr(uniqueness, "hot_share", lambda df, n=share: n)
        found = first_failures(df, [check], "row_id", ["run"]).orderBy("run", "rank").collect()
        for run in range(4):
            got = [(r["_row"], r["item"]) for r in found if r["run"] == run]
            assert got == [(i, "null" if k is None else str(k)) for i, k in wanted[run]]
