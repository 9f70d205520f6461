"""History tables and the questions asked of them."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from rowgauge.model import ISSUES_SCHEMA, SUMMARY_SCHEMA
from rowgauge.operators import history, views
from rowgauge.sources import history as tables
from rowgauge.sources.tables import dataset_line


def summary_of(spark, rows):
    """Rows of (label, id, time, scores...)."""
    full = [(label, rid, ts, 10, 10, 9, *scores, "1.0.0") for label, rid, ts, *scores in rows]
    return spark.createDataFrame(full, SUMMARY_SCHEMA)


SCORES = (90.0, 80.0, 100.0, 70.0, 85.0)
RUNS = [
    ("Run 1", "a", "2024-01-01T00:00:00+00:00", *SCORES),
    ("Run 2", "b", "2024-01-01T05:00:00+00:00", 100.0, 100.0, 100.0, 100.0, 100.0),
    ("Run 3", "c", "2024-01-03T00:00:00+00:00", 100.0, 90.0, 90.0, 100.0, 95.0),
    ("Run 4", "d", "2024-02-01T00:00:00+00:00", None, 50.0, 50.0, 50.0, 50.0),
]


def issue(label, rid, dimension="Validity", rule="email_format", column="email", count=1, pct=1.0, samples='["x"]'):
    return (label, rid, dimension, rule, column, count, pct, samples)


def issues_of(spark, rows):
    return spark.createDataFrame(rows, ISSUES_SCHEMA)


@pytest.fixture()
def summary(spark):
    return summary_of(spark, RUNS).repartition(3)


def test_sequence(summary):
    rows = history.sequence_runs(summary, ["overall_pct"]).orderBy("run_no").collect()
    assert [(r.run_no, r.run_id) for r in rows] == [(1, "a"), (2, "b"), (3, "c"), (4, "d")]
    assert [r.prev and r.prev.overall_pct for r in rows] == [None, 85.0, 100.0, 95.0]


def test_sequence_of_odd_times(spark):
    """Runs without a time, with odd ones and over many months follow their order, and no window sees all days."""
    times = [None] * 30 + ["", "later", "5 March"] + [f"20{y:02}-{m:02}-{d:02}T0{d}:00:00+00:00" for y in (9, 24) for m in (1, 2, 11) for d in (1, 2, 9)]
    rows = [("L", f"r{i % 7}-{i:03}", t, *SCORES[:4], float(i)) for i, t in enumerate(times)] + [("L", None, None, *SCORES[:4], 99.0)]
    found = history.sequence_runs(summary_of(spark, rows).repartition(4), ["overall_pct"])
    got = [(r.run_no, r.overall_pct, r.prev and r.prev.overall_pct) for r in found.orderBy("run_no").collect()]
    order = [r[-1] for r in sorted(rows, key=lambda r: (r[2] is not None, r[2] or "", r[1] is not None, r[1] or ""))]
    assert got == [(n + 1, x, order[n - 1] if n else None) for n, x in enumerate(order)]
    windows = [x for x in found._jdf.queryExecution().optimizedPlan().toString().split("\n") if "Window [" in x]
    assert windows and all("windowspecdefinition(_day" in x or "windowspecdefinition(_month" in x for x in windows)


def test_delta(summary):
    rows = views.run_delta(summary, ("overall_pct", "completeness_pct")).orderBy("run_id").collect()
    assert [r.overall_pct_delta_text for r in rows] == ["N/A", "+15.00 pp", "-5.00 pp", "-45.00 pp"]
    # a null score counts as 0
    assert [r.completeness_pct_delta for r in rows] == [None, 10.0, 0.0, -100.0]


@pytest.mark.parametrize(
    "labels,following",
    [([], "Run 1"), (["Run 9", "Run 12"], "Run 13"), (["x", "y", "z", "abc"], "Run 5"), (["v007 of 9"], "Run 8"), ([None], "Run 2")],
)
def test_next_label(spark, labels, following):
    rows = [(label, f"r{i}", f"2024-01-0{i + 1}T00:00:00+00:00", *SCORES) for i, label in enumerate(labels)]
    assert history.next_run_label(summary_of(spark, rows)).first()[0] == following
    unlabelled = history.next_run_label(summary_of(spark, rows).drop("run_label")).first()[0]
    assert unlabelled == f"Run {len(labels) + 1}"


def test_default_labels(summary):
    rows = history.default_labels(summary.drop("run_label")).orderBy("run_id").collect()
    assert [r.run_label for r in rows] == ["Run 1", "Run 2", "Run 3", "Run 4"]
    assert rows[0].__fields__[0] == "run_label"


def test_backfill(spark, summary):
    found = issues_of(
        spark,
        [issue("Run 1", "a"), issue("", "c"), issue(None, "b"), issue("", "zzz"), issue("", None), issue("", ""), issue("kept", "b")],
    )
    twice = summary.unionByName(summary_of(spark, [("Run 2 again", "b", "2025-01-01T00:00:00+00:00", *SCORES), (None, "c", "2026", *SCORES), ("odd", "", "2026", *SCORES)]))
    got = sorted((r.run_id, r.run_label) for r in history.backfill_labels(twice, found).collect())
    assert got == [("", ""), ("", ""), ("a", "Run 1"), ("b", "Run 2 again"), ("b", "kept"), ("c", "Run 3"), ("zzz", "")]


def test_append_is_idempotent(spark, summary, tmp_path):
    path = str(tmp_path / "summary")
    tables.append_summary(summary.where("run_id < 'c'"), path)
    for _ in range(2):
        tables.append_summary(summary, path)
    assert tables.read_summary(spark, path).count() == 4


def test_run_without_issues_keeps_the_layout(spark, tmp_path):
    for fmt in ("parquet", "csv"):
        path = str(tmp_path / fmt)
        tables.append_issues(issues_of(spark, []), path, fmt)
        tables.append_issues(issues_of(spark, [issue("Run 2", "b")]), path, fmt)
        rows = tables.read_issues(spark, path, fmt).collect()
        assert [tuple(r) for r in rows] == [issue("Run 2", "b")]


def test_absent_histories(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        tables.read_summary(spark, str(tmp_path / "none"))
    path = str(tmp_path / "empty")
    tables.append_summary(summary_of(spark, []), path)
    with pytest.raises(ValueError):
        tables.read_summary(spark, path)
    absent = tables.read_issues(spark, str(tmp_path / "none"))
    assert absent.schema.names == ISSUES_SCHEMA.names and absent.count() == 0


def test_lowest_dimension(summary):
    rows = views.lowest_dimension(summary).orderBy("run_id").collect()
    # all equal: the first; a tie of validity and uniqueness: validity; null counts as 0
    assert [r.text for r in rows] == ["Timeliness (70.00%)", "Completeness (100.00%)", "Validity (90.00%)", "Completeness (0.00%)"]


def test_latest(summary):
    rows = {r.run_id: (r.option, r.is_latest) for r in views.latest_run(summary).collect()}
    assert rows["d"] == ("Run 4 (latest)", True) and rows["a"] == ("Run 1", False)


def test_lookup_takes_the_first(spark, summary):
    again = summary.unionByName(summary_of(spark, [("Run 1", "z", "2030-01-01T00:00:00+00:00", *SCORES)]))
    assert [r.run_id for r in views.run_lookup(again, "Run 1").collect()] == ["a"]


def test_issue_groups(spark, summary):
    found = issues_of(spark, [issue("Run 1", "a"), issue("Run 1", "a", count=0), issue("Run 1", "a", rule="r"), issue("Run 3", "c", count=None)])
    rows = {r.run_id: r.issue_groups for r in views.issue_group_count(summary, found).collect()}
    assert rows == {"a": 2, "b": 0, "c": 0, "d": 0}


def test_drilldown(spark):
    found = issues_of(
        spark,
        [
            issue("Run 1", "a", samples='["Zed", null, "q"]'),
            issue("Run 1", "a", dimension="Uniqueness", rule="primary_key:id", column="id", samples="[1]"),
            issue(None, "b"),
            issue("Run 1", "a", count=0, rule="passing"),
        ],
    )
    assert views.drilldown(found, "Run 1").count() == 2
    assert views.drilldown(found, "Run 1", "uniqueness").count() == 1
    assert views.drilldown(found, "Run 1", "Overall", " ZED, Q ").count() == 1
    assert views.drilldown(found, "Run 1", "Overall", "email | ze").count() == 1
    assert views.drilldown(found, "Run 1", "Overall", "null").count() == 0


def test_top50_and_export(spark, tmp_path):
    found = issues_of(spark, [issue("Run 1", "a", rule=f"r{i:03d}", samples='["a \\"b\\", c"]') for i in range(60)])
    order = [f"r{i:03d}" for i in reversed(range(60))]
    shown = views.drilldown_top50(found, order).collect()
    assert len(shown) == 50 and shown[0].total == 60
    assert [r.rule for r in shown[:2]] == ["r059", "r058"]
    path = str(tmp_path / "export")
    views.write_drilldown(found, path)
    lines = [r.value for r in spark.read.text(path).collect()]
    assert sum(line == '"Validity","r007","email","1","1.0","a ""b"", c"' for line in lines) == 1
    assert sum(line.startswith('"Validity"') for line in lines) == 60


def test_dataset_line(spark, summary):
    assert dataset_line(None) == "Dataset not loaded."
    assert dataset_line(summary, "s").first().line == "Dataset loaded: s (4 rows, 12 columns)."


def test_trend_and_bars(summary):
    trend = views.trend_series(summary, ("Validity",)).orderBy("run_no").collect()
    assert [(r.run_no, r.score, r.runs) for r in trend] == [(1, 80.0, 4), (2, 100.0, 4), (3, 90.0, 4), (4, 50.0, 4)]
    bars = views.score_bars(summary).where(F.col("run_id") == "d").collect()
    assert {r.metric: r.score for r in bars}["Completeness"] == 0.0


def test_two_runs_of_one_second(spark, tmp_path):
    path = str(tmp_path / "summary")
    first = summary_of(spark, [("Run 1", "a", "2024-01-01T00:00:00+00:00", *SCORES)])
    second = summary_of(spark, [("Run 2", "a", "2024-01-01T00:00:00+00:00", *SCORES)])
    for rows in (first, second, first, second):
        tables.append_summary(rows, path)
    assert sorted(r.run_label for r in tables.read_summary(spark, path).collect()) == ["Run 1", "Run 2"]
    other = first.withColumn("rows_raw", F.lit(11).cast("long"))
    with pytest.raises(ValueError, match="another run"):
        tables.append_summary(other, path)
    assert tables.read_summary(spark, path).count() == 2


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_drift_of_a_stored_history(spark, tmp_path, fmt):
    path, issues = str(tmp_path / "summary"), str(tmp_path / "issues")
    old = summary_of(spark, RUNS[:2]).drop("run_label", "rules_version").withColumn("note", F.lit("kept"))
    tables.write_table(old, path, fmt)
    late = summary_of(spark, [("Run 8", *RUNS[2][1:])])
    tables.append_summary(late, path, fmt)
    tables.append_summary(late, path, fmt)
    rows = tables.read_summary(spark, path, fmt).orderBy("run_id").collect()
    assert [(r.run_label, r.run_id, r.rows_raw, r.overall_pct, r.rules_version, r.note) for r in rows] == [
        ("Run 1", "a", 10, 85.0, None, "kept"), ("Run 2", "b", 10, 100.0, None, "kept"), ("Run 8", "c", 10, 95.0, "1.0.0", None),
    ]
    tables.write_table(issues_of(spark, [issue("", "a", samples='["x, y"]')]).drop("run_label"), issues, fmt)
    ruled = issues_of(spark, [issue("Run 8", "c")]).withColumn("severity", F.lit("high"))
    tables.append_issues(ruled, issues, fmt)
    found = tables.read_issues(spark, issues, fmt).orderBy("run_id").collect()
    assert [(r.run_label, r.run_id, r.sample_values, r.severity) for r in found] == [
        ("", "a", '["x, y"]', None), ("Run 8", "c", '["x"]', "high"),
    ]


def test_cards_of_shared_and_missing_ids(spark):
    twins = summary_of(spark, [RUNS[0], ("Twin", "a", "2024-01-01T00:00:01+00:00", *SCORES), ("None", None, "2024-01-01T00:00:02+00:00", *SCORES), (None, "q", "2024-01-01T00:00:03+00:00", *SCORES)])
    found = issues_of(
        spark,
        [issue("Run 1", "a"), issue("Twin", "a"), issue("Twin", "a", rule="r2"), issue("Run 1", ""), issue("None", None), issue("", "q"), issue("Run 1", "zz"), issue("", "")],
    )
    cards = views.run_cards(twins, found).collect()
    assert {(r.run_label, r.issue_groups) for r in cards} == {("Run 1", 2), ("Twin", 2), ("None", 1), (None, 1)} and len(cards) == 4
    groups = views.issue_group_count(twins, found).collect()
    assert {(r.run_label, r.issue_groups) for r in groups} == {(r.run_label, r.issue_groups) for r in cards}
