"""Run history: order, labels and the table union."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def run_order() -> Column:
    """What orders runs: their time, then their id."""
    return F.struct(F.col("run_ts_utc"), F.col("run_id"))


def _order_key() -> Column:
    """A text that begins like the order of runs: runs without a time come first, by their id."""
    untimed = F.concat(F.lit("0"), F.coalesce(F.col("run_id").cast("string"), F.lit("")))
    return F.when(F.col("run_ts_utc").isNull(), untimed).otherwise(F.concat(F.lit("1"), F.col("run_ts_utc").cast("string")))


def sequence_runs(history: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """Add ``run_no``, counting from 1, and ``prev``, the ``carry`` columns of the run before.

    Runs are ranked within their day, at most one per second, days within their month, and what
    comes before a month is summed over the list of months. So no task sees the whole history, nor all
    its days. Runs without a time are dealt by their ids as others are by their times.
    """
    carried = F.struct(F.lit(True).alias("found"), *[F.col(c) for c in carry])
    dated = history.withColumn("_day", F.substring(_order_key(), 1, 11))
    days = dated.groupBy("_day").agg(F.count(F.lit(1)).alias("_runs"), F.max_by(carried, run_order()).alias("_last"))
    days = days.withColumn("_month", F.substring("_day", 1, 8))
    months = days.groupBy("_month").agg(F.sum("_runs").alias("_runs"), F.max_by("_last", "_day").alias("_last"))
    listed = months.agg(F.sort_array(F.collect_list(F.struct("_month", "_runs", "_last")))).scalar()
    in_month = Window.partitionBy("_month").orderBy("_day")
    days = days.withColumn("_months", listed)
    days = days.withColumn("_earlier", F.filter("_months", lambda m: m["_month"] < F.col("_month")))
    months_before = F.aggregate("_earlier", F.lit(0).cast("bigint"), lambda n, m: n + m["_runs"])
    days_before = F.coalesce(F.sum("_runs").over(in_month.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    days = days.select(
        F.col("_day").alias("_d"),
        (months_before + days_before).alias("_before"),
        F.coalesce(F.lag("_last").over(in_month), F.try_element_at("_earlier", F.lit(-1))["_last"]).alias("_prev_day"),
    )
    within = Window.partitionBy("_day").orderBy("run_ts_utc", "run_id")
    ranked = dated.withColumns({"_no": F.row_number().over(within), "_prev_run": F.lag(carried).over(within)})
    joined = ranked.join(days, F.col("_day") == F.col("_d"), "left")
    return joined.withColumns(
        {
            "run_no": F.col("_before") + F.col("_no"),
            "prev": F.when(F.col("_no") == 1, F.col("_prev_day")).otherwise(F.col("_prev_run")),
        }
    ).drop("_day", "_d", "_before", "_prev_day", "_no", "_prev_run")


def default_labels(summary: DataFrame) -> DataFrame:
    """Label the runs of a history that have no label by their position among all runs."""
    numbered = sequence_runs(summary)
    label = F.concat(F.lit("Run "), F.col("run_no").cast("string"))
    if "run_label" in summary.columns:
        label = F.coalesce("run_label", label)
    rest = [c for c in summary.columns if c != "run_label"]
    return numbered.select(label.alias("run_label"), *rest)


def next_run_label(summary: DataFrame) -> DataFrame:
    """One row with the label that follows the last run's.

    The first integer of the last label plus one, else the number of runs plus
    one.
    """
    label = F.col("run_label") if "run_label" in summary.columns else F.lit("")
    last = summary.agg(
        F.max_by(F.coalesce(label, F.lit("")), run_order()).alias("last"), F.count(F.lit(1)).alias("runs")
    )
    number = F.regexp_extract(F.coalesce("last", F.lit("")), r"(\d+)", 1).try_cast("decimal(38,0)")
    following = F.coalesce(number, F.col("runs").cast("decimal(38,0)")) + 1
    return last.select(F.concat(F.lit("Run "), following.cast("string")).alias("run_label"))


def union_history(old: DataFrame, new: DataFrame) -> DataFrame:
    """Both tables by column name; a column only one of them has is null in the other."""
    return old.unionByName(new, allowMissingColumns=True)


def backfill_labels(summary: DataFrame, issues: DataFrame) -> DataFrame:
    """Give issue rows without a label the label of their run; unknown runs get ``""``.

    Only rows that need a label and name a run go through the join, and those
    are at most a few per run.
    """
    blank = F.lit("")
    columns = issues.columns
    issues = issues.withColumns(
        {name: F.coalesce(F.col(name).cast("string"), blank) for name in ("run_label", "run_id")}
    )
    if not {"run_id", "run_label"} <= set(summary.columns):
        return issues
    known = (
        summary.where(F.col("run_id").isNotNull() & F.col("run_label").isNotNull())
        .where(F.length("run_id") > 0)
        .groupBy(F.col("run_id").cast("string").alias("_id"))
        .agg(F.max_by("run_label", F.struct("run_ts_utc", "run_label")).alias("_label"))
    )
    lookup = (F.col("run_label") == "") & (F.col("run_id") != "")
    found = (
        issues.where(lookup)
        .join(known, F.col("run_id") == F.col("_id"), "left")
        .withColumn("run_label", F.coalesce("_label", blank))
    )
    return issues.where(~lookup).select(*columns).unionByName(found.select(*columns))
