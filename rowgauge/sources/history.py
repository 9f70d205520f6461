"""Run history tables: typed, append-only.

Files of a history may differ in their columns, as those written by earlier
versions do; they are read by name, and what a file lacks is null.

A history of keyed runs is a table partitioned by the key that a run's caller
gave it. To store a run is to write its partition, whatever else the history
holds; to store it again replaces that partition, and to read it opens no other.
"""

from __future__ import annotations

from urllib.parse import quote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.values import named
from ..model import ISSUES_SCHEMA, RUN_KEY, SUMMARY_SCHEMA
from ..operators.history import default_labels, union_history
from ..session import path_exists, readable, scratch_path
from .tables import scan_csv, write_table


def scan_history(spark: SparkSession, path: str, fmt: str, schema: T.StructType) -> DataFrame:
    """A history table in its layout, then the columns that only some files have."""
    if fmt == "csv":
        return union_history(spark.createDataFrame([], schema), scan_csv(spark, path, schema))
    reader = spark.read.format(fmt)
    known = set(schema.names)
    more = [f for f in reader.option("mergeSchema", "true").load(path).schema if f.name not in known]
    return spark.read.format(fmt).schema(T.StructType([*schema.fields, *more])).load(path)


KEY = "run_key"


def _keyed_layout(schema: T.StructType) -> T.StructType:
    """What ``put_run`` writes: the history's columns, and the severity that declared rules give issues."""
    more = [T.StructField("severity", T.StringType())] if schema == ISSUES_SCHEMA else []
    return T.StructType([*schema.fields, *more])


def _partition(path: str, run_key: str) -> str:
    return f"{path.rstrip('/')}/{KEY}={quote(run_key, safe='')}"


def put_run(rows: DataFrame, path: str, run_key: str, schema: T.StructType) -> None:
    """Store the rows of one run, none at all included, under its key; what the key held before is replaced."""
    if not run_key:
        raise ValueError("a run key can't be empty")
    layout = _keyed_layout(schema)
    columns = [named(f.name) if f.name in rows.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in layout]
    write_table(rows.select(*columns).coalesce(1), _partition(path, run_key))  # a run's rows are few


def put_runs(rows: DataFrame, path: str, schema: T.StructType) -> None:
    """Store many runs at once, each under the key in its column ``run_key``; only partitions of these keys are replaced.

    A run without rows is none here: ``put_run`` stores such.
    """
    layout = _keyed_layout(schema)
    columns = [named(f.name) if f.name in rows.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in layout]
    keyed = rows.select(*columns, KEY).repartition(KEY)
    keyed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(KEY).parquet(path)


def scan_runs(spark: SparkSession, path: str, schema: T.StructType, run_key: str | None = None) -> DataFrame:
    """A history of keyed runs, or one run of it: then only its partition is listed and opened. Empty if absent."""
    layout = T.StructType([*_keyed_layout(schema).fields, T.StructField(KEY, T.StringType())])
    at = path if run_key is None else _partition(path, run_key)
    if not readable(spark, at):
        return spark.createDataFrame([], layout)
    found = spark.read.schema(layout).option("basePath", path).parquet(at)
    return found if run_key is None else found.where(F.col(KEY) == run_key)


def _same_run(a: str, b: str) -> Column:
    return F.expr(" AND ".join(f"{a}.{c} <=> {b}.{c}" for c in RUN_KEY))


def _append(rows: DataFrame, path: str, fmt: str, schema: T.StructType, whole: bool) -> None:
    """Append the runs that the table lacks; ``whole``: a run is one row, and must equal a stored one."""
    spark = rows.sparkSession
    rows = rows.select(*schema.names, *[c for c in rows.columns if c not in schema.names])
    if path_exists(spark, path):
        stored = scan_history(spark, path, fmt, schema)
        if whole:
            # met twice, and what gives them may be a whole assessment: a row per run
            settled = scratch_path(spark, "appended")
            write_table(rows, settled)
            rows = spark.read.schema(rows.schema).parquet(settled)
            differs = F.expr(" OR ".join(f"NOT (new.{c} <=> old.{c})" for c in schema.names))
            clash = rows.alias("new").join(stored.alias("old"), _same_run("new", "old")).where(differs)
            if (found := clash.select("new.run_label", "new.run_id").first()) is not None:
                raise ValueError(f"{path} holds another run {found['run_label']!r} with id {found['run_id']!r}")
        seen = stored.select(*RUN_KEY).distinct()
        rows = rows.alias("new").join(seen.alias("old"), _same_run("new", "old"), "left_anti")
    write_table(rows, path, fmt, mode="append")


def append_summary(summary: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Append summary rows; a run stored before, the same in every column, is not added again.

    A run is told by its label and id: runs of one second have one id. Another
    run under a stored label and id raises.
    """
    _append(summary, path, fmt, SUMMARY_SCHEMA, whole=True)


def append_issues(issues: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Append issue rows, none at all included; those of a run stored before are not added again."""
    _append(issues, path, fmt, ISSUES_SCHEMA, whole=False)


def read_summary(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """The summary history; runs without a label are labelled by position."""
    if not path_exists(spark, path):
        raise FileNotFoundError(f"Missing {path}. Assess a dataset first.")
    summary = scan_history(spark, path, fmt, SUMMARY_SCHEMA)
    first = summary.select("run_label").orderBy(F.asc_nulls_first("run_label")).first()
    if first is None:
        raise ValueError(f"{path} is empty.")
    return default_labels(summary) if first["run_label"] is None else summary


def read_issues(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """The issues history in its layout, labels and ids that a file lacks as empty texts; empty if there is none yet."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], ISSUES_SCHEMA)
    issues = scan_history(spark, path, fmt, ISSUES_SCHEMA)
    return issues.withColumns({c: F.coalesce(named(c), F.lit("")) for c in RUN_KEY})
