"""Assess a table: split, score and list what fails."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from datetime import datetime, timezone
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.display import run_id_text, run_ts_text
from ..functions.values import named, to_utc, type_of
from ..model import ISSUES_SCHEMA, SCORE_COLUMNS, SUMMARY_SCHEMA, Profile, RuleSet
from ..operators.checks import Check, any_of, rule_check, standard_checks
from ..operators.history import sequence_runs
from ..operators.normalize import canonical_names, normalize, with_row_id
from ..operators.scoring import INCOMPLETE, check_rows, issue_rows, measure, with_scores
from ..operators.slices import score_by_slice
from ..session import require_utc, scratch_path


class Assessment:
    """The results of an assessment, all lazy.

    ``clean`` and ``rejects`` split the rows by completeness; late, invalid and
    repeated rows stay clean. ``summary`` and ``issues`` have the history layouts.
    """

    def __init__(
        self,
        table: DataFrame,
        checks: list[Check],
        profile: Profile,
        facts: Callable[[bool], DataFrame],
        weights: Mapping[str, float] | None = None,
    ) -> None:
        self._table = table
        self._checks = checks
        self._profile = profile
        self._facts = facts
        self._weights = weights

    @cached_property
    def clean(self) -> DataFrame:
        return kept_rows(self._table, self._checks, self._profile)

    @cached_property
    def rejects(self) -> DataFrame:
        return rejected_rows(self._table, self._checks, self._profile)

    @cached_property
    def summary(self) -> DataFrame:
        return summary_rows(self._facts(False), self._checks, self._profile.version, self._weights)

    @cached_property
    def issues(self) -> DataFrame:
        return history_issues(self._facts(True), self._checks)

    def settle(self, samples: bool = True) -> Assessment:
        """Measure now, once: summary and issues then share the facts, one row per run.

        The facts are a table in the scratch folder, so that losing an executor
        later costs nothing. Without ``samples`` only the summary is settled; issues are measured when asked for.
        """
        spark = self._table.sparkSession
        path = scratch_path(spark, "facts")
        self._facts(samples).write.parquet(path)
        facts, measure_again = spark.read.parquet(path), self._facts
        return self._with(lambda wanted: facts if samples or not wanted else measure_again(True))

    def labelled(self, label: str) -> Assessment:
        """The same results under another run label; of a settled assessment nothing is measured again."""
        return self._with(lambda wanted: self._facts(wanted).withColumn("run_label", F.lit(label)))

    def _with(self, facts: Callable[[bool], DataFrame]) -> Assessment:
        return Assessment(self._table, self._checks, self._profile, facts, self._weights)


class RuleReport:
    """Lazy results of declared rules: scores (one row) and one row per rule, failing or not."""

    def __init__(self, checks: list[Check], weights: Mapping[str, float], facts: Callable[[bool], DataFrame]) -> None:
        self._checks = checks
        self._weights = weights
        self._facts = facts

    @cached_property
    def scores(self) -> DataFrame:
        scored = with_scores(self._facts(False), self._checks, self._weights)
        return scored.select("rows", *SCORE_COLUMNS.values())

    @cached_property
    def rules(self) -> DataFrame:
        return check_rows(self._facts(True), self._checks)


def run_time(run_ts: datetime | str) -> Column:
    """A run time as a literal, in whole seconds; without a zone it is UTC."""
    if isinstance(run_ts, str):
        run_ts = datetime.fromisoformat(run_ts)
    if run_ts.tzinfo is None:
        run_ts = run_ts.replace(tzinfo=timezone.utc)
    whole = run_ts.astimezone(timezone.utc).replace(microsecond=0)
    return F.lit(whole.isoformat()).cast("timestamp")


def run_identity(run_ts: Column, label: Column) -> dict[str, Column]:
    return {"run_label": label, "run_id": run_id_text(run_ts), "run_ts_utc": run_ts_text(run_ts)}


def summary_rows(
    facts: DataFrame, checks: list[Check], version: str, weights: Mapping[str, float] | None = None
) -> DataFrame:
    """Facts with a run identity as summary rows."""
    rows = F.col("rows")
    counts = {
        "rows_raw": rows,
        "rows_after_global_fixes": rows,
        "rows_after_hard_clean": rows - F.col(INCOMPLETE),
        "rules_version": F.lit(version),
    }
    return with_scores(facts, checks, weights).withColumns(counts).select(*SUMMARY_SCHEMA.names)


def history_issues(facts: DataFrame, checks: list[Check]) -> DataFrame:
    """Facts with a run identity and samples as issue rows; those of declared rules have their severity."""
    ruled = ["severity"] if any(c.severity for c in checks) else []
    return issue_rows(facts, checks, ["run_label", "run_id"]).select(*ISSUES_SCHEMA.names, *ruled)


def kept_rows(df: DataFrame, checks: list[Check], profile: Profile) -> DataFrame:
    """Rows with everything required, under canonical names."""
    return canonical_names(df.where(~incomplete(checks)), profile)


def rejected_rows(df: DataFrame, checks: list[Check], profile: Profile) -> DataFrame:
    """Rows lacking something required, under canonical names."""
    return canonical_names(df.where(incomplete(checks)), profile)


def incomplete(checks: list[Check]) -> Column:
    """Some row check of completeness fails."""
    return any_of([c.failed for c in checks if c.dimension == "Completeness" and c.failed is not None])


def _prepared(
    df: DataFrame, profile: Profile, rules: RuleSet | None, resolve_aliases: bool
) -> tuple[DataFrame, list[Check], Profile, Mapping[str, float] | None]:
    """The normalised table, its checks, and what scores and names them.

    Declared rules take the place of the profile, with their version, weights
    and dataset columns.
    """
    require_utc(df.sparkSession)
    if rules is not None:
        profile = rules.profile()
    table = normalize(df, profile, resolve_aliases)
    if rules is None:
        return table, standard_checks(table, profile), profile, None
    return table, [rule_check(table, rule) for rule in rules.rules], profile, rules.weights


def assess(
    df: DataFrame,
    profile: Profile = Profile(),
    *,
    run_ts: datetime | str,
    run_label: str = "Run 1",
    row_id: str | None = None,
    resolve_aliases: bool = False,
    rules: RuleSet | None = None,
) -> Assessment:
    """Assess a table as one run, by the standard checks of a profile or by declared rules."""
    table, checks, profile, weights = _prepared(df, profile, rules, resolve_aliases)
    keyed, order = with_row_id(table, row_id)
    identity = run_identity(run_time(run_ts), F.lit(run_label))

    def facts(samples: bool) -> DataFrame:
        return measure(keyed, checks, order, samples=samples).withColumns(identity)

    return Assessment(table, checks, profile, facts, weights)


def assess_runs(
    df: DataFrame,
    profile: Profile = Profile(),
    *,
    run_ts: str,
    row_id: str | None = None,
    resolve_aliases: bool = False,
    first_run: int = 1,
    rules: RuleSet | None = None,
) -> Assessment:
    """Assess a table of many deliveries at once, each value of the column ``run_ts`` as a run of its own.

    Runs are labelled in time order, counting from ``first_run``.
    """
    table, checks, profile, weights = _prepared(df, profile, rules, resolve_aliases)
    at = F.date_trunc("second", to_utc(named(run_ts), type_of(df, run_ts)))
    keyed, order = with_row_id(table.withColumn("_run", at), row_id)
    known = keyed.select("_run").distinct().withColumns(run_identity(F.col("_run"), F.lit(None).cast("string")))
    label = F.concat(F.lit("Run "), (F.col("run_no") + (first_run - 1)).cast("string"))
    labels = sequence_runs(known).select(
        F.col("_run").alias("_labelled"), label.alias("run_label"), "run_id", "run_ts_utc"
    )

    def facts(samples: bool) -> DataFrame:
        measured = measure(keyed, checks, order, by=["_run"], samples=samples)
        return measured.join(labels, F.col("_run").eqNullSafe(F.col("_labelled")), "left")

    return Assessment(table, checks, profile, facts, weights)


def evaluate(df: DataFrame, rules: RuleSet, *, row_id: str | None = None, samples: bool = True) -> RuleReport:
    """Evaluate declared rules on a table as it is."""
    require_utc(df.sparkSession)
    keyed, order = with_row_id(df, row_id)
    checks = [rule_check(df, rule) for rule in rules.rules]
    return RuleReport(
        checks, rules.weights, lambda wanted: measure(keyed, checks, order, samples=wanted and samples)
    )


def evaluate_slices(df: DataFrame, rules: RuleSet, *, row_id: str | None = None) -> DataFrame:
    """Scores of declared rules for every value of the declared slices."""
    require_utc(df.sparkSession)
    keyed, order = with_row_id(df, row_id)
    checks = [rule_check(df, rule) for rule in rules.rules]
    return score_by_slice(keyed, checks, rules.slices, order, rules.weights)


def issues_by_severity(rules: DataFrame) -> DataFrame:
    """Failed rules and failures per severity."""
    return (
        rules.where(F.col("failed_count") > 0)
        .groupBy("severity")
        .agg(F.count(F.lit(1)).alias("failing_rules"), F.sum("failed_count").alias("failed_count"))
    )
