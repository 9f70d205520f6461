"""What is read and measured once: the scan behind the counts, and the rows that go into a history."""

from __future__ import annotations

import pytest
from catalog import feeds, queries
from pyspark.sql import functions as F
from rowgauge import assess_runs, compile_rules, evaluate
from rowgauge.sources.history import append_summary, read_summary

SF = "/root/testdata/sf0.001"


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def ticking(spark):
    """A number that goes up with every row that is evaluated, and what makes it."""
    seen = spark.sparkContext.accumulator(0)
    return seen, F.udf(lambda x: seen.add(1) or x, "string").asNondeterministic()


@pytest.mark.parametrize("n", [3, 30])
def test_counts_take_one_scan(spark, tmp_path, n):
    cells = [F.when(F.col("id") % (i + 2) != 0, F.col("id") % 7).alias(f"c{i}") for i in range(n)]
    spark.range(1000).select(F.col("id").alias("row_id"), *cells).write.parquet(str(tmp_path / "t"))
    rules = [{"id": f"r{i}", "dimension": "validity", "type": "range", "column": f"c{i}", "params": {"max": 5}} for i in range(n)]
    table = spark.read.parquet(str(tmp_path / "t"))
    report = evaluate(table, compile_rules({"rules": rules}), row_id="row_id", samples=False)
    assert final_plan(report.rules).count("FileScan parquet") == 1
    failed = {r["rule"]: r["failed_count"] for r in report.rules.collect()}
    assert failed == {f"r{i}": sum(x % (i + 2) == 0 or x % 7 > 5 for x in range(1000)) for i in range(n)}


def test_counts_of_runs_take_one_scan(spark, tmp_path):
    """One for the counts of rows, one for those by key, one for the runs' labels."""
    rows = spark.range(500).selectExpr(
        "id AS row_id", "CAST(id % 99 AS string) AS order_id", "'a@b.cd' AS email", "IF(id % 5 = 0, 'x', '1') AS amount",
        "TIMESTAMP_SECONDS(86400 * (id % 3)) AS at",
    )
    rows.write.parquet(str(tmp_path / "t"))
    found = assess_runs(spark.read.parquet(str(tmp_path / "t")), run_ts="at", row_id="row_id")
    assert final_plan(found._facts(False)).count("FileScan parquet") == 3


def test_append_evaluates_rows_once(spark, tmp_path):
    seen, tick = ticking(spark)
    rows = feeds.yearly(spark, SF).settle(samples=False).summary
    path = str(tmp_path / "summary")
    append_summary(rows.where("run_id < '1996'"), path)
    append_summary(rows.withColumn("run_id", tick("run_id")), path)
    n = rows.count()
    assert seen.value == n == read_summary(spark, path).count()


@pytest.mark.parametrize("name", ["summary_append", "issues_append", "history_mixed", "issues_of_key"])
def test_history_queries_measure_once(spark, monkeypatch, name):
    seen, tick = ticking(spark)
    yearly = feeds.yearly

    def counted(spark, sf_dir):
        found = yearly(spark, sf_dir)
        return found._with(lambda samples: found._facts(samples).withColumn("run_id", tick("run_id")))

    monkeypatch.setattr(queries, "yearly", counted)
    queries.QUERIES[name](spark, SF).collect()
    assert seen.value == yearly(spark, SF).summary.count()


def test_settled_summary_still_gives_issues(spark):
    found = feeds.yearly(spark, SF)
    settled = found.settle(samples=False)
    assert settled.issues.orderBy("run_id", "rule").collect() == found.issues.orderBy("run_id", "rule").collect()
    assert settled.summary.orderBy("run_id").collect() == found.summary.orderBy("run_id").collect()
