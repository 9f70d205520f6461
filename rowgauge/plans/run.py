"""Full runs: assess a stored dataset, keep the history, report on it."""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..model import ISSUES_SCHEMA, RAW_SCHEMA, SUMMARY_SCHEMA, Profile, RuleSet
from ..operators.history import backfill_labels, next_run_label, union_history
from ..operators.normalize import GENERATED_ROW_ID, with_row_id
from ..operators.views import run_cards
from ..session import committed, path_exists, publish, require_utc, scratch_path
from ..sources import synth
from ..sources.history import append_issues, append_summary, put_run, read_issues, read_summary, scan_runs
from ..sources.manifest import exit_code, manifest
from ..sources.tables import records, scan, staged_path, write_json_object, write_table
from .assess import assess


@dataclass(frozen=True)
class Layout:
    """Where a run keeps its tables, all under one folder."""

    root: str
    fmt: str = "parquet"

    def _at(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    @property
    def staged(self) -> str:
        return self._at("synthetic/input")

    @property
    def raw(self) -> str:
        return self._at("output/raw")

    @property
    def clean(self) -> str:
        return self._at("output/clean")

    @property
    def summary(self) -> str:
        return self._at("reports/summary")

    @property
    def issues(self) -> str:
        return self._at("reports/issues")

    @property
    def keyed_summary(self) -> str:
        return self._at("reports/summary_by_run")

    @property
    def keyed_issues(self) -> str:
        return self._at("reports/issues_by_run")

    def staging(self) -> str:
        """A fresh folder beside the outputs, for one that is not finished."""
        return self._at(f"output/_staging/{uuid.uuid4().hex}")

    @property
    def last_run(self) -> str:
        return self._at("reports/last_run")

    @property
    def last_metrics(self) -> str:
        return self._at("reports/last_metrics")

    def outputs(self, keyed: bool = False) -> dict[str, tuple[str, str]]:
        """Every output with its format; of the histories that of keyed runs, or the other."""
        return {
            "input": (self.staged, self.fmt),
            "raw": (self.raw, self.fmt),
            "clean": (self.clean, self.fmt),
            "summary": (self.keyed_summary if keyed else self.summary, "parquet"),
            "issues": (self.keyed_issues if keyed else self.issues, "parquet"),
            "summary_records": (self._at("reports/summary_records"), "text"),
            "issue_records": (self._at("reports/issue_records"), "text"),
        }


def run_synth(
    spark: SparkSession,
    layout: Layout,
    *,
    now: datetime | str,
    rows: DataFrame | None = None,
    seed: int = synth.DEFAULT_SEED,
    scenario: str | None = "auto",
) -> None:
    """Write a synthetic input and use it as the raw dataset.

    ``rows`` holds the row numbers to make orders for, by default 522 of them.
    """
    require_utc(spark)
    chosen = synth.resolve_scenario(scenario, path_exists(spark, layout.summary))
    if rows is None:
        rows = spark.range(1, synth.DEFAULT_ROWS + 1).withColumnRenamed("id", "row_id")
    orders = synth.clean_orders(rows, now, seed)
    if chosen == "baseline":
        orders = synth.inject_defects(orders, seed)
    write_table(orders, layout.staged, layout.fmt)
    write_table(scan(spark, layout.staged, layout.fmt), layout.raw, layout.fmt)


def run_assessment(
    spark: SparkSession,
    layout: Layout,
    *,
    run_ts: datetime | str,
    profile: Profile = Profile(),
    row_id: str | None = None,
    rules: RuleSet | None = None,
    schema: T.StructType = RAW_SCHEMA,
    run_key: str | None = None,
) -> str:
    """Assess the raw dataset, write the clean table and append to the history; returns the label.

    ``run_key`` tells the run, best by its dataset and delivery: two keys are two runs, whatever their figures
    and times, and a run under a key stored before replaces that one and keeps its label. The history is then that of
    keyed runs. Without a key a run that the history holds already, the same in all its figures, keeps its label and is
    not added again, so that a run cut short can simply be started again either way.

    The clean table is written beside its place and put there after the histories, the pointer comes last: a run that
    raises before leaves them as they were. A text dataset is parsed once, by ``schema``, into a table in the scratch
    folder, as the assessment reads it several times, column by column.
    """
    require_utc(spark)
    source = scan(spark, staged_path(spark, layout.raw, layout.staged), layout.fmt, schema)
    source, row_id = with_row_id(source, row_id)
    if layout.fmt == "csv":
        parsed = scratch_path(spark, "parsed")
        write_table(source, parsed)
        source = scan(spark, parsed)
    found = assess(source, profile, run_ts=run_ts, row_id=row_id, rules=rules).settle()
    label = _label(spark, layout, found.summary) if run_key is None else _keyed_label(spark, layout, run_key)
    found = found.labelled(label)
    staged = layout.staging()
    write_table(found.clean.drop(GENERATED_ROW_ID), staged, layout.fmt)
    if run_key is None:
        append_summary(found.summary, layout.summary)
        append_issues(found.issues, layout.issues)
    else:
        put_run(found.issues, layout.keyed_issues, run_key, ISSUES_SCHEMA)
        put_run(found.summary, layout.keyed_summary, run_key, SUMMARY_SCHEMA)
    publish(spark, staged, layout.clean)
    stored = found.summary  # equal to the history's row, or the append would have raised
    told = [] if run_key is None else [F.lit(run_key).alias("run_key")]
    write_json_object(stored.select("run_label", "run_id", "run_ts_utc", *told), layout.last_run)
    write_json_object(stored, layout.last_metrics)
    return label


def _keyed_label(spark: SparkSession, layout: Layout, run_key: str) -> str:
    """The label of the run stored under the key, or the one that follows the last run's."""
    known = scan_runs(spark, layout.keyed_summary, SUMMARY_SCHEMA, run_key).select("run_label").first()
    if known is not None:
        return known["run_label"]
    return next_run_label(_summaries(spark, layout)).first()["run_label"]


def _summaries(spark: SparkSession, layout: Layout) -> DataFrame:
    """The summaries of all runs, keyed or not."""
    keyed = scan_runs(spark, layout.keyed_summary, SUMMARY_SCHEMA)
    if not path_exists(spark, layout.summary):
        return keyed
    flat = read_summary(spark, layout.summary)
    return union_history(flat, keyed) if committed(spark, layout.keyed_summary) else flat


def _label(spark: SparkSession, layout: Layout, summary: DataFrame) -> str:
    """The label under which the history holds this run, or the next one."""
    if path_exists(spark, layout.summary):
        history = read_summary(spark, layout.summary)
        same = " AND ".join(f"new.{c} <=> old.{c}" for c in SUMMARY_SCHEMA.names if c != "run_label")
        known = history.alias("old").join(summary.alias("new"), F.expr(same), "left_semi").select("run_label")
        if (stored := known.orderBy("run_label").first()) is not None:
            return stored["run_label"]
    return next_run_label(_summaries(spark, layout)).first()["run_label"]


def run_report(spark: SparkSession, layout: Layout) -> DataFrame:
    """Export both histories as records and return the headline figures of every run."""
    require_utc(spark)
    summary = _summaries(spark, layout)
    if summary.isEmpty():
        raise FileNotFoundError(f"Missing {layout.summary}. Assess a dataset first.")
    issues = read_issues(spark, layout.issues)
    if committed(spark, layout.keyed_issues):
        issues = union_history(issues, scan_runs(spark, layout.keyed_issues, ISSUES_SCHEMA))
    issues = backfill_labels(summary, issues)
    outputs = layout.outputs()
    for name, table in (("summary_records", summary), ("issue_records", issues)):
        records(table).write.mode("overwrite").text(outputs[name][0])
    return run_cards(summary, issues)


def stage(raw: DataFrame, layout: Layout) -> None:
    """Write a given table as the staged input and use it as the raw dataset."""
    write_table(raw, layout.staged, layout.fmt)
    write_table(scan(raw.sparkSession, layout.staged, layout.fmt), layout.raw, layout.fmt)


def run_all(
    spark: SparkSession,
    layout: Layout,
    *,
    now: datetime | str,
    raw: DataFrame | None = None,
    rows: DataFrame | None = None,
    seed: int = synth.DEFAULT_SEED,
    row_id: str | None = "row_id",
    rules: RuleSet | None = None,
    run_key: str | None = None,
) -> int:
    """Stage a given table, or a generated one, assess, report and check the outputs; 0 if all exist, else 2."""
    if raw is not None:
        stage(raw, layout)
    else:
        run_synth(spark, layout, now=now, rows=rows, seed=seed)
    run_assessment(spark, layout, run_ts=now, row_id=row_id, rules=rules, run_key=run_key)
    run_report(spark, layout)
    return exit_code(manifest(spark, layout.outputs(run_key is not None)))
