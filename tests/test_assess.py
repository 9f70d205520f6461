"""Assessment contracts: absent columns, order independence, the split, many runs."""

from __future__ import annotations

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from rowgauge import Profile, Rule, RuleSet, assess, assess_runs, evaluate, evaluate_slices
from rowgauge.operators.checks import rule_check
from rowgauge.operators.normalize import normalize

RUN_TS = "2024-03-01T06:30:00"
SCHEMA = (
    "row_id long, order_id long, email string, country string, amount string, "
    "order_ts_utc timestamp_ntz, ingest_ts_utc timestamp_ntz"
)
AT = datetime(2024, 1, 1)
LATER = datetime(2024, 1, 1, 1)
ROWS = [
    (1, 10, " a@b.c ", "CA", "5.00", AT, LATER),
    (2, 10, "bad", "CA", "-1", AT, LATER),
    (3, None, "a@b.c", "CA", "abc", AT, LATER),
    (4, None, "a@b.c", "\t", "7", AT, None),
    (5, 12, "a@b.c", "US", None, AT, datetime(2024, 1, 2)),
    (6, 13, "a@b.c", "US", "9", AT, AT),
]


@pytest.fixture()
def orders(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def one(df):
    return df.first().asDict()


def by_rule(issues):
    return {r["rule"].split(":")[0]: r.asDict() for r in issues.collect()}


def test_scores_and_issues(orders):
    found = assess(orders, run_ts=RUN_TS, row_id="row_id")
    summary = one(found.summary)
    assert summary == {
        "run_label": "Run 1",
        "run_id": "20240301_063000",
        "run_ts_utc": "2024-03-01T06:30:00+00:00",
        "rows_raw": 6,
        "rows_after_global_fixes": 6,
        "rows_after_hard_clean": 3,
        "completeness_pct": 50.0,
        "validity_pct": 50.0,
        "uniqueness_pct": 33.33,
        "timeliness_pct": 66.67,
        "overall_pct": 50.0,
        "rules_version": "1.0.0",
    }
    issues = by_rule(found.issues)
    assert list(issues) == ["required_columns_present", "min_amount", "email_format", "primary_key", "max_delay_minutes"]
    assert [i["failed_count"] for i in issues.values()] == [3, 3, 1, 4, 2]
    assert issues["required_columns_present"]["sample_values"] == '["", "", ""]'
    assert issues["min_amount"]["sample_values"] == '["-1", "abc", null]'
    assert issues["email_format"]["sample_values"] == '["bad"]'
    assert issues["primary_key"]["sample_values"] == "[10, 10, null, null]"
    assert json.loads(issues["max_delay_minutes"]["sample_values"]) == [None, "2024-01-02T00:00:00+00:00"]


def test_split_is_whole(orders):
    found = assess(orders, run_ts=RUN_TS, row_id="row_id")
    assert sorted(r.row_id for r in found.clean.collect()) == [1, 2, 6]
    assert sorted(r.row_id for r in found.rejects.collect()) == [3, 4, 5]
    assert found.clean.where("row_id = 1").first().email == "a@b.c"


@pytest.mark.parametrize(
    "lost,scores",
    [
        ("order_id", (0.0, 50.0, 100.0, 66.67)),
        ("amount", (0.0, 83.33, 33.33, 66.67)),
        ("email", (0.0, 50.0, 33.33, 66.67)),
        ("country", (0.0, 50.0, 33.33, 66.67)),
        ("order_ts_utc", (0.0, 50.0, 33.33, 0.0)),
        ("ingest_ts_utc", (0.0, 50.0, 33.33, 0.0)),
    ],
)
def test_absent_column(orders, lost, scores):
    found = assess(orders.drop(lost), run_ts=RUN_TS, row_id="row_id")
    s = one(found.summary)
    assert (s["completeness_pct"], s["validity_pct"], s["uniqueness_pct"], s["timeliness_pct"]) == scores
    assert s["rows_after_hard_clean"] == 0 == found.clean.count()
    issues = by_rule(found.issues)
    assert issues["required_columns_present"]["failed_count"] == 6
    quiet = {"order_id": "primary_key", "order_ts_utc": "max_delay_minutes", "ingest_ts_utc": "max_delay_minutes"}
    assert quiet.get(lost, "none") not in issues


def test_empty_table(spark):
    found = assess(spark.createDataFrame([], SCHEMA), run_ts=RUN_TS, row_id="row_id")
    s = one(found.summary)
    assert [s[c] for c in s if c.endswith("_pct")] == [0.0] * 5
    assert s["rows_raw"] == 0
    assert found.issues.count() == 0
    assert found.clean.count() == 0


def test_no_required_columns(orders):
    found = assess(orders, Profile(required=()), run_ts=RUN_TS, row_id="row_id")
    assert one(found.summary)["completeness_pct"] == 100.0


def test_alias_columns(orders):
    old = orders.withColumnsRenamed({"order_ts_utc": "order_ts", "ingest_ts_utc": "ingest_ts"})
    plain = assess(old, run_ts=RUN_TS, row_id="row_id")
    s = one(plain.summary)
    assert (s["completeness_pct"], s["timeliness_pct"]) == (0.0, 66.67)
    assert plain.clean.count() == 0 and "order_ts_utc" in plain.clean.columns
    assert by_rule(plain.issues)["max_delay_minutes"]["column"] == "ingest_ts"
    resolved = assess(old, run_ts=RUN_TS, row_id="row_id", resolve_aliases=True)
    assert one(resolved.summary)["completeness_pct"] == 50.0


def test_order_does_not_matter(orders):
    base = assess(orders, run_ts=RUN_TS, row_id="row_id")
    mixed = assess(orders.orderBy(F.desc("amount")).repartition(5), run_ts=RUN_TS, row_id="row_id")
    assert one(base.summary) == one(mixed.summary)
    assert by_rule(base.issues) == by_rule(mixed.issues)


def test_settled_is_the_same(orders):
    lazy = assess(orders, run_ts=RUN_TS, row_id="row_id")
    settled = lazy.settle()
    assert one(lazy.summary) == one(settled.summary)
    assert by_rule(lazy.issues) == by_rule(settled.issues)


def test_generated_row_id(orders):
    found = assess(orders.drop("row_id").coalesce(1), run_ts=RUN_TS)
    assert by_rule(found.issues)["primary_key"]["sample_values"] == "[10, 10, null, null]"
    assert "_row_id" not in found.clean.columns


def test_runs_are_apart(orders):
    twice = orders.withColumn("at", F.lit("2024-05-01T00:00:00Z").cast("timestamp")).unionByName(
        orders.where("row_id in (1, 3, 6)").withColumn("at", F.lit("2024-04-30T23:00:00.7Z").cast("timestamp"))
    )
    found = assess_runs(twice, run_ts="at", row_id="row_id", first_run=4)
    rows = {r.run_label: r for r in found.summary.collect()}
    assert (rows["Run 4"].run_id, rows["Run 4"].rows_raw, rows["Run 4"].uniqueness_pct) == ("20240430_230000", 3, 100.0)
    assert (rows["Run 5"].run_id, rows["Run 5"].rows_raw, rows["Run 5"].uniqueness_pct) == ("20240501_000000", 6, 33.33)
    alone = assess(orders, run_ts="2024-05-01T00:00:00", run_label="Run 5", row_id="row_id")
    assert one(alone.summary) == rows["Run 5"].asDict()
    latest = found.issues.where("run_label = 'Run 5'")
    assert by_rule(latest) == by_rule(alone.issues)


def rules_of(*rules):
    return RuleSet(tuple(rules))


def test_mixed_uniqueness_dimension(orders):
    """Two key rules and a row rule in one dimension: a row failing several counts once."""
    rules = rules_of(
        Rule("order", "Uniqueness", "unique", ("order_id",)),
        Rule("pair", "Uniqueness", "unique", ("country", "email")),
        Rule("known", "Uniqueness", "not_null", ("order_id",)),
    )
    table = normalize(orders, Profile())
    report = evaluate(table, rules, row_id="row_id")
    counts = {r.rule: (r.failed_count, r.sample_values) for r in report.rules.collect()}
    assert counts["order"] == (4, "[10, 10, null, null]")
    # (CA, a@b.c) is in rows 1 and 3, (US, a@b.c) in rows 5 and 6; no column bears the pair's name
    assert counts["pair"] == (4, '["", "", ""]')
    assert counts["known"] == (2, "[null, null]")
    # rows 1-4 fail on order_id, rows 5 and 6 on the pair
    assert report.scores.first().uniqueness_pct == 0.0


def test_absent_rule_columns(orders):
    rules = rules_of(
        Rule("a", "Completeness", "not_null", ("ghost",)),
        Rule("b", "Validity", "in_set", ("ghost",), {"allowed": [1]}),
        Rule("c", "Uniqueness", "unique", ("ghost",)),
        Rule("d", "Timeliness", "max_lag_hours", (), {"event_ts": "ghost", "ingest_ts": "ingest_ts_utc", "max_hours": 1}),
    )
    scores = evaluate(orders, rules, row_id="row_id").scores.first()
    assert (scores.completeness_pct, scores.validity_pct, scores.uniqueness_pct, scores.timeliness_pct) == (0.0, 100.0, 100.0, 0.0)


def test_nulls_may_pass(orders):
    strict = Rule("v", "Validity", "range", ("amount",), {"min": 0})
    lenient = Rule("v", "Validity", "range", ("amount",), {"min": 0}, nulls_fail=False)
    failed = [orders.where(rule_check(orders, r).failed).count() for r in (strict, lenient)]
    assert failed == [3, 2]


def test_slices_cover_all_rows(orders):
    rules = RuleSet((Rule("u", "Uniqueness", "unique", ("order_id",)),), {}, (("country",), ("country", "email"), ("ghost",)))
    rows = evaluate_slices(orders, rules, row_id="row_id").collect()
    assert {r["slice"] for r in rows} == {"country", "country,email"}
    for name in ("country", "country,email"):
        assert sum(r["rows"] for r in rows if r["slice"] == name) == 6
