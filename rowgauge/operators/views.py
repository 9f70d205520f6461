"""Questions asked of the run history: each takes and returns DataFrames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.display import fmt_delta, fmt_pct, number_or, sample_text, status
from ..model import DIMENSIONS, SCORE_COLUMNS
from .history import backfill_labels, run_order, sequence_runs

# Report columns and limits.
DRILL_COLUMNS = ("dimension", "rule", "column", "failed_count", "failed_pct", "sample_values")
HISTORY_COLUMNS = (
    "run_label",
    "rows_raw",
    "overall_pct",
    "completeness_pct",
    "validity_pct",
    "uniqueness_pct",
    "timeliness_pct",
)
TREND_ORDER = ("Overall", *DIMENSIONS)
DRILL_ROWS = 50
LATEST_MARK = " (latest)"
NO_ISSUES = "No issues detected."
SOME_ISSUES = "Use drill-down for details."
RULES_PREFIX = "Rules: "


def issues_for_run(issues: DataFrame, label: str | None) -> DataFrame:
    """Issue rows with failures, of one run or, without a label, of all runs."""
    failing = issues.where(number_or(F.col("failed_count"), 0.0) > 0)
    if label is None:
        return failing
    return failing.where(F.coalesce("run_label", F.lit("")) == label)


def drill_dimension(issues: DataFrame, dimension: str) -> DataFrame:
    """Issues of one dimension, whatever its case; ``Overall`` keeps all."""
    if dimension == "Overall":
        return issues
    return issues.where(F.lower("dimension") == dimension.lower())


def drill_search(issues: DataFrame, query: str | None) -> DataFrame:
    """Issues whose dimension, rule, column or samples contain the text; no text keeps all."""
    wanted = (query or "").strip().lower()
    if not wanted:
        return issues
    parts = [F.col("dimension"), F.col("rule"), F.col("column"), sample_text(F.col("sample_values"))]
    hay = F.concat_ws(" | ", *[F.lower(F.coalesce(p, F.lit(""))) for p in parts])
    return issues.where(hay.contains(F.lit(wanted)))


def drilldown(issues: DataFrame, label: str | None, dimension: str = "Overall", query: str | None = None) -> DataFrame:
    return drill_search(drill_dimension(issues_for_run(issues, label), dimension), query)


def drilldown_export(drilled: DataFrame) -> DataFrame:
    """The six report columns of all drilled rows, samples as text."""
    return drilled.select(*DRILL_COLUMNS[:-1], sample_text(F.col("sample_values")).alias("sample_values"))


def write_drilldown(drilled: DataFrame, path: str) -> None:
    """Export as CSV with every value quoted and quotes doubled."""
    drilldown_export(drilled).write.mode("overwrite").options(
        header="true", quoteAll="true", escape='"', emptyValue="",
        ignoreLeadingWhiteSpace="false", ignoreTrailingWhiteSpace="false",
    ).csv(path)


def check_position(rules: Sequence[str]) -> Column:
    """Where an issue's rule stands in the given report order; unlisted rules come last."""
    listed = F.array(*[F.lit(r) for r in rules])
    place = F.array_position(listed, F.col("rule"))
    return F.when(place > 0, place).otherwise(len(rules) + 1)


def drilldown_top50(drilled: DataFrame, rules: Sequence[str] = ()) -> DataFrame:
    """The first fifty drilled rows in run and check order as shown, and how many there are."""
    total = drilled.agg(F.count(F.lit(1))).scalar()
    order = ["run_id", check_position(rules) if rules else F.col("dimension"), "rule", "column"]
    return drilled.orderBy(*order).limit(DRILL_ROWS).select(
        "run_label",
        "dimension",
        "rule",
        "column",
        F.coalesce("failed_count", F.lit(0)).alias("failed_count"),
        fmt_pct(F.col("failed_pct")).alias("failed_pct"),
        sample_text(F.col("sample_values")).alias("sample_values"),
        total.alias("total"),
    )


def run_lookup(summary: DataFrame, label: str) -> DataFrame:
    """The first run with this label."""
    return summary.where(F.col("run_label") == label).orderBy(run_order()).limit(1)


def run_delta(summary: DataFrame, metrics: Sequence[str] = ("overall_pct",)) -> DataFrame:
    """Change of each metric since the run before, in percentage points; null for the first run."""
    numbers = summary.withColumns({f"_{m}": number_or(F.col(m), None) for m in metrics})
    sequenced = sequence_runs(numbers, [f"_{m}" for m in metrics])
    deltas = []
    for m in metrics:
        change = F.col(f"_{m}") - F.col(f"prev._{m}")
        deltas += [change.alias(f"{m}_delta"), fmt_delta(change).alias(f"{m}_delta_text")]
    return sequenced.select("run_label", "run_id", *metrics, *deltas)


def latest_run(summary: DataFrame) -> DataFrame:
    """All runs as selection texts, the last one marked."""
    # one row
    last = F.broadcast(summary.agg(F.max(run_order()).alias("_last")))
    marked = summary.join(last, run_order() == F.col("_last"), "left")
    is_last = F.col("_last").isNotNull()
    return marked.select(
        "run_label",
        "run_id",
        F.when(is_last, F.concat(F.col("run_label"), F.lit(LATEST_MARK))).otherwise(F.col("run_label")).alias("option"),
        is_last.alias("is_latest"),
    )


def _lowest() -> Column:
    """The lowest score, with its dimension; of equal ones the first in scoring order."""
    scores = [
        F.struct(number_or(F.col(SCORE_COLUMNS[d]), None).alias("score"), F.lit(i).alias("place"), F.lit(d).alias("label"))
        for i, d in enumerate(DIMENSIONS)
    ]
    return F.array_min(F.filter(F.array(*scores), lambda s: s["score"].isNotNull()))


def _lowest_text(low: Column) -> Column:
    return F.format_string("%s (%s)", F.coalesce(low["label"], F.lit("N/A")), fmt_pct(low["score"]))


def lowest_dimension(summary: DataFrame) -> DataFrame:
    """The dimension with the lowest score of each run."""
    low = _lowest()
    return summary.select(
        "run_label",
        "run_id",
        F.coalesce(low["label"], F.lit("N/A")).alias("dimension"),
        low["score"].alias("score"),
        _lowest_text(low).alias("text"),
    )


def with_issue_groups(summary: DataFrame, issues: DataFrame) -> DataFrame:
    """``summary`` and ``issue_groups``, how many checks failed in each of its rows.

    An issue belongs to the run of its label, and where it names an id, of that
    id. One without a label takes that of its id's run. Both sides meet once, on the
    label; runs that share a label are told apart by id within it.
    """
    label, rid = F.coalesce("run_label", F.lit("")), F.coalesce("run_id", F.lit(""))
    # a run without a label is found by its id
    key = F.when(label != "", label).otherwise(F.concat(F.lit("\0"), rid))
    failing = issues_for_run(backfill_labels(summary, issues), None).where((label != "") | (rid != ""))
    counts = failing.groupBy(key.alias("_run"), rid.alias("_id")).agg(F.count(F.lit(1)).alias("_n"))
    own = F.collect_list(F.when(F.col("_id") != "", F.struct("_id", "_n")))
    groups = counts.groupBy("_run").agg(
        F.sum(F.when(F.col("_id") == "", F.col("_n"))).alias("_loose"), F.map_from_entries(own).alias("_by_id")
    )
    joined = summary.withColumn("_of", key).join(groups, F.col("_of") == F.col("_run"), "left")
    named = F.coalesce(F.try_element_at("_by_id", rid), F.lit(0))
    total = named + F.coalesce("_loose", F.lit(0))
    return joined.withColumn("issue_groups", total).drop("_of", "_run", "_loose", "_by_id")


def _note() -> Column:
    return F.when(F.col("issue_groups") == 0, NO_ISSUES).otherwise(SOME_ISSUES).alias("note")


def issue_group_count(summary: DataFrame, issues: DataFrame) -> DataFrame:
    """How many checks failed in each run, runs without any included."""
    return with_issue_groups(summary, issues).select("run_label", "run_id", "issue_groups", _note())


def run_cards(summary: DataFrame, issues: DataFrame) -> DataFrame:
    """The headline figures of every row of the summary: score, change, status, weakest dimension, rows, issues."""
    counted = with_issue_groups(summary, issues).withColumn("_overall", number_or(F.col("overall_pct"), None))
    low = _lowest()
    return sequence_runs(counted, ["_overall"]).select(
        "run_id",
        "run_label",
        fmt_pct(number_or(F.col("overall_pct"), 0.0)).alias("overall"),
        status(F.col("overall_pct")).alias("status"),
        "rows_raw",
        F.concat(F.lit(RULES_PREFIX), F.coalesce(F.col("rules_version").cast("string"), F.lit("N/A"))).alias("rules"),
        fmt_delta(F.col("_overall") - F.col("prev._overall")).alias("delta"),
        _lowest_text(low).alias("lowest"),
        "issue_groups",
        _note(),
    )


def score_bars(summary: DataFrame) -> DataFrame:
    """The five scores of each run as rows; a score that is no number shows as 0."""
    metrics = [number_or(F.col(c), 0.0).alias(name) for name, c in SCORE_COLUMNS.items()]
    wide = summary.select("run_label", "run_id", *metrics)
    return wide.unpivot(["run_label", "run_id"], list(SCORE_COLUMNS), "metric", "score")


def trend_series(summary: DataFrame, selected: Sequence[str] = TREND_ORDER) -> DataFrame:
    """The selected scores over all runs, numbered in run order, with the number of runs."""
    chosen = [name for name in TREND_ORDER if name in selected]
    metrics = [number_or(F.col(SCORE_COLUMNS[name]), None).alias(name) for name in chosen]
    runs = summary.agg(F.count(F.lit(1))).scalar()
    wide = sequence_runs(summary).select("run_no", "run_label", *metrics)
    return wide.unpivot(["run_no", "run_label"], chosen, "metric", "score").withColumn("runs", runs)


def history_table(summary: DataFrame) -> DataFrame:
    """The run history as shown."""
    return summary.select(
        *[fmt_pct(F.col(c)).alias(c) if c.endswith("_pct") else F.col(c) for c in HISTORY_COLUMNS]
    )
