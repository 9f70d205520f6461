"""Scans, the synthetic generator, the manifest and whole runs."""

from __future__ import annotations

import pytest
from pyspark.sql import types as T

from rowgauge import Profile, assess, compile_rules, load_config
from rowgauge.model import RAW_SCHEMA
from rowgauge.plans import run as runs
from rowgauge.session import scratch_path
from rowgauge.sources import manifest, synth, tables

NOW = "2024-03-01T06:30:00+00:00"


def test_csv_missing_values_and_quotes(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text('a,b,c\n1,,"x ""y"", z"\nNA,""," q "\nnan,null,"NULL"\n01,1e2,N/A \n', encoding="utf-8")
    text = tables.scan_csv(spark, str(path)).collect()
    assert [tuple(r) for r in text] == [
        ("1", None, 'x "y", z'), (None, None, " q "), (None, None, None), ("01", "1e2", "N/A "),
    ]
    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.DoubleType()), T.StructField("ghost", T.LongType())])
    typed = tables.scan_csv(spark, str(path), schema)
    assert [(r.a, r.b) for r in typed.collect()] == [(1, None), (None, None), (None, None), (1, 100.0)]
    assert typed.columns == ["a", "b", "c"]


def test_whole_numbers_as_fractions(spark):
    df = spark.createDataFrame([(t,) for t in ("7", "7.0", "7.5", "1e3", "9223372036854775807", "1e30", "inf", "x", None)], "n string")
    schema = T.StructType([T.StructField("n", T.LongType())])
    assert [r.n for r in tables.typed(df, schema).collect()] == [7, 7, None, 1000, 2**63 - 1, None, None, None, None]


def test_csv_keeps_blanks(spark, tmp_path):
    df = spark.createDataFrame([(1, "  a ", "x\ty"), (2, "", None)], "i long, s string, t string")
    path = str(tmp_path / "out")
    tables.write_table(df, path, "csv")
    rows = sorted(tuple(r) for r in tables.scan_csv(spark, path).collect())
    assert rows == [("1", "  a ", "x\ty"), ("2", None, None)]


def test_staged_input(spark, tmp_path):
    staged = tmp_path / "staged.csv"
    staged.write_text("a\n1\n")
    assert tables.staged_path(spark, str(tmp_path / "raw.csv"), str(staged)) == str(staged)
    with pytest.raises(FileNotFoundError, match="Missing required file"):
        tables.staged_path(spark, str(tmp_path / "raw.csv"), str(tmp_path / "none.csv"))


def counts(orders):
    found = assess(orders, run_ts=NOW, row_id="row_id")
    return found.summary.first(), {r.rule.split(":")[0]: r.failed_count for r in found.issues.collect()}


@pytest.mark.parametrize("rows,seed", [(522, 42), (33, 1), (522, 7), (6, 3)])
def test_injected_defects_are_found(spark, rows, seed):
    summary, failed = counts(synth.synth_orders(spark, NOW, rows, seed))
    assert summary.rows_raw == rows
    assert failed["required_columns_present"] == 4
    assert failed["min_amount"] == 1
    assert failed["email_format"] == 1
    assert failed.get("primary_key", 0) == (6 if rows >= 33 else 0)
    assert 3 <= failed["max_delay_minutes"] <= 6
    if rows == 522:
        assert (summary.completeness_pct, summary.validity_pct, summary.uniqueness_pct) == (99.23, 99.62, 98.85)


def test_few_rows(spark):
    assert counts(synth.synth_orders(spark, NOW, 2))[0].rows_raw == 2


def test_thirty_rows_repeat_three_ids(spark):
    assert counts(synth.synth_orders(spark, NOW, 30))[1]["primary_key"] == 4


def test_improved_has_no_issues(spark):
    summary, failed = counts(synth.synth_orders(spark, NOW, scenario="improved"))
    assert failed == {} and summary.overall_pct == 100.0


def test_synth_does_not_depend_on_partitions(spark):
    orders = synth.synth_orders(spark, NOW, 100)
    ids = spark.range(1, 101, 1, 7).withColumnRenamed("id", "row_id")
    again = synth.inject_defects(synth.clean_orders(ids, NOW))
    assert sorted(orders.collect()) == sorted(again.collect())


def test_synth_domains(spark):
    orders = synth.synth_orders(spark, NOW, 2000, scenario="improved").collect()
    assert {r.country for r in orders} == set(synth.COUNTRIES)
    assert 5.0 <= min(r.amount for r in orders) and max(r.amount for r in orders) <= 950.0
    assert len({r.amount for r in orders}) > 1500
    assert all(0 <= (r.ingest_ts_utc - r.order_ts_utc).total_seconds() <= 240 * 60 for r in orders)


@pytest.mark.parametrize(
    "text,history,expected",
    [(None, False, "baseline"), ("AUTO ", True, "improved"), ("improved", False, "improved"), ("other", True, "baseline")],
)
def test_scenario(text, history, expected):
    assert synth.resolve_scenario(text, history) == expected


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_whole_run(spark, tmp_path, fmt):
    layout = runs.Layout(str(tmp_path / "hub"), fmt)
    assert runs.run_all(spark, layout, now=NOW) == 0
    assert runs.run_all(spark, layout, now="2024-03-02T06:30:00+00:00") == 0
    cards = {r.run_label: r for r in runs.run_report(spark, layout).collect()}
    assert cards["Run 1"].issue_groups == 5 and cards["Run 1"].delta == "N/A"
    assert cards["Run 2"].issue_groups == 0 and cards["Run 2"].overall == "100.00%"
    assert cards["Run 2"].note == "No issues detected."
    last = spark.read.json(layout.last_run).first()
    assert (last.run_label, last.run_id) == ("Run 2", "20240302_063000")
    assert tables.scan(spark, layout.clean, fmt).count() == 522


def test_manifest(spark, tmp_path):
    layout = runs.Layout(str(tmp_path / "hub"))
    runs.run_synth(spark, layout, now=NOW)
    found = manifest.manifest(spark, layout.outputs())
    assert {r.name: r.row_count for r in found.where("exists").collect()} == {"input": 522, "raw": 522}
    assert manifest.missing_outputs(found).count() == 5
    assert manifest.exit_code(found) == 2


def test_assessing_without_a_dataset(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        runs.run_assessment(spark, runs.Layout(str(tmp_path / "none")), run_ts=NOW)


def test_profile_overrides():
    assert Profile.from_mapping({}) == Profile()
    assert Profile.from_mapping({"version": 2, "amount_min": "1.5", "rules": []}) == Profile(version="2", amount_min=1.5)
    assert Profile.from_mapping({"required_columns": ["a"], "dataset": {"primary_key": "x"}}) == Profile(required=("a",))


def test_rule_grammar(spark, tmp_path):
    config = tmp_path / "rules.yaml"
    config.write_text(
        'version: "1.1.0"\nscoring: {weights: {validity: 0.35}}\nrules:\n'
        "  - {id: v, dimension: validity, type: in_set, column: c, params: {allowed: [x]}, severity: high}\n"
        "dashboard: {suggested_slices: [[a], [b, c]]}\n"
    )
    rules = compile_rules(load_config(spark, str(config)))
    assert rules.rules[0].dimension == "Validity" and rules.rules[0].columns == ("c",)
    assert (rules.weights, rules.slices, rules.version) == ({"Validity": 0.35}, (("a",), ("b", "c")), "1.1.0")
    assert load_config(spark, str(tmp_path / "none.yaml"), missing_ok=True) == {}
    with pytest.raises(FileNotFoundError):
        load_config(spark, str(tmp_path / "none.yaml"))
    with pytest.raises(ValueError, match="unknown type"):
        compile_rules({"rules": [{"id": "x", "dimension": "validity", "type": "sounds_like", "column": "c"}]})


def test_scratch_is_the_shared_folder(spark):
    assert scratch_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


def test_raw_layout():
    assert RAW_SCHEMA.names == ["order_id", "email", "country", "amount", "order_ts_utc", "ingest_ts_utc"]


def staged(spark, tmp_path):
    layout = runs.Layout(str(tmp_path / "hub"))
    runs.run_synth(spark, layout, now=NOW)
    return layout


def stored(spark, layout):
    from rowgauge.sources.history import read_issues, read_summary

    summary = read_summary(spark, layout.summary).collect()
    issues = read_issues(spark, layout.issues).collect()
    last = spark.read.json(layout.last_run).first()
    assert last.run_label in {r.run_label for r in summary}
    return sorted(r.run_label for r in summary), sorted({r.run_label for r in issues}), last.run_label


def test_rerun_and_retry(spark, tmp_path, monkeypatch):
    layout = staged(spark, tmp_path)

    def broken(*args):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(runs, "append_issues", broken)
        with pytest.raises(RuntimeError):
            runs.run_assessment(spark, layout, run_ts=NOW, row_id="row_id")
    assert [runs.run_assessment(spark, layout, run_ts=NOW, row_id="row_id") for _ in range(2)] == ["Run 1", "Run 1"]
    assert stored(spark, layout) == (["Run 1"], ["Run 1"], "Run 1")
    # other figures at the same second are another run
    tables.write_table(tables.scan(spark, layout.staged).limit(500), layout.raw)
    assert runs.run_assessment(spark, layout, run_ts=NOW, row_id="row_id") == "Run 2"
    assert stored(spark, layout) == (["Run 1", "Run 2"], ["Run 1", "Run 2"], "Run 2")


def test_declared_rules_as_a_stored_run(spark, tmp_path):
    layout = staged(spark, tmp_path)
    rules = compile_rules(
        {
            "version": "2.0",
            "dataset": {"primary_key": "order_id", "timestamps": {"event_ts": "order_ts_utc", "ingest_ts": "ingest_ts_utc"}},
            "scoring": {"weights": {"uniqueness": 1.0, "timeliness": 3.0}},
            "rules": [
                {"id": "key", "dimension": "uniqueness", "type": "unique", "severity": "high"},
                {"id": "lag", "dimension": "timeliness", "type": "max_lag_hours", "params": {"max_hours": 12}},
                {"id": "has_email", "dimension": "completeness", "type": "not_null", "column": "email"},
            ],
        }
    )
    assert rules.rules[0].columns == ("order_id",) and rules.rules[1].params["ingest_ts"] == "ingest_ts_utc"
    assert runs.run_assessment(spark, layout, run_ts=NOW, row_id="row_id", rules=rules) == "Run 1"
    from rowgauge.sources.history import read_issues, read_summary

    row = read_summary(spark, layout.summary).first()
    assert row.rules_version == "2.0"
    assert row.overall_pct == round((row.uniqueness_pct + 3 * row.timeliness_pct) / 4, 2)
    found = {r.rule: (r.failed_count, r.severity) for r in read_issues(spark, layout.issues).collect()}
    assert found["key"] == (6, "high") and found["lag"][1] == "medium"


def test_a_session_is_left_alone(spark):
    from rowgauge.session import require_utc

    before = {k: spark.conf.get(k, None) for k in ("spark.sql.session.timeZone", "spark.sql.codegen.hugeMethodLimit")}
    assess(spark.createDataFrame([], RAW_SCHEMA), run_ts=NOW)
    assert before == {k: spark.conf.get(k, None) for k in before}
    other = spark.newSession()
    other.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    with pytest.raises(ValueError, match="UTC"):
        require_utc(other)


def test_rule_files_of_any_file_system(spark, tmp_path):
    (tmp_path / "r.yaml").write_text("rules: []\nversion: '3'\n")
    assert load_config(spark, f"file://{tmp_path}/r.yaml")["version"] == "3"


def test_csv_files_are_read_by_name(spark, tmp_path):
    """Other column orders, missing columns, short and long lines; every line is a row or a reject."""
    folder = tmp_path / "drop"
    folder.mkdir()
    (folder / "a.csv").write_text("order_id,email\n1,a@b.co\n2\n3,x,y\n")
    (folder / "b.csv").write_text("email,order_id\nc@d.co,4\n")
    (folder / "c.csv").write_text("order_id\n5\n")
    (folder / "d.csv").write_text("order_id,email\n")
    assert sorted(tuple(r) for r in tables.scan_csv(spark, str(folder)).select("order_id", "email").collect() if r[0] != "3") == [
        ("1", "a@b.co"), ("2", None), ("4", "c@d.co"), ("5", None)
    ]
    rows, rejects = tables.scan_csv_checked(spark, str(folder))
    assert sorted((r.order_id, r.email) for r in rows.collect()) == [("1", "a@b.co"), ("4", "c@d.co"), ("5", None)]
    assert sorted(r.line for r in rejects.collect()) == ["2", "3,x,y"]
    assert rows.select("order_id").count() == 3 and rejects.count() == 2  # whatever columns are read


def test_publish_keeps_what_was_there(spark, tmp_path):
    from rowgauge.session import committed, publish

    old, new, half = (str(tmp_path / n) for n in ("old", "new", "half"))
    tables.write_table(spark.range(3), old)
    tables.write_table(spark.range(5), f"{half}/_temporary/0")
    assert not committed(spark, half)
    with pytest.raises(ValueError, match="isn't finished"):
        publish(spark, half, old)
    assert spark.read.parquet(old).count() == 3
    tables.write_table(spark.range(5), new)
    publish(spark, new, old)
    assert spark.read.parquet(old).count() == 5 and sorted(p.name for p in tmp_path.iterdir()) == ["half", "old"]


def test_runs_by_key(spark, tmp_path):
    from rowgauge.model import ISSUES_SCHEMA, SUMMARY_SCHEMA
    from rowgauge.sources import history

    path = str(tmp_path / "history")
    row = lambda label, n: spark.createDataFrame([(label, "id", "ts", n, n, n, 1.0, 1.0, 1.0, 1.0, 1.0, "v")], SUMMARY_SCHEMA)
    assert history.scan_runs(spark, path, SUMMARY_SCHEMA).count() == 0
    for key, n in (("a/1", 1), ("b=2", 2), ("a/1", 3)):
        history.put_run(row("Run", n), path, key, SUMMARY_SCHEMA)
    found = history.scan_runs(spark, path, SUMMARY_SCHEMA)
    assert sorted((r.run_key, r.rows_raw) for r in found.collect()) == [("a/1", 3), ("b=2", 2)]
    one = history.scan_runs(spark, path, SUMMARY_SCHEMA, "a/1")
    assert [r.rows_raw for r in one.collect()] == [3] and len(one.inputFiles()) == 1
    assert "PartitionFilters: [isnotnull(run_key" in one._jdf.queryExecution().executedPlan().toString()
    assert history.scan_runs(spark, path, SUMMARY_SCHEMA, "none").count() == 0
    # a run that has no issues any more has none stored
    issues, at = spark.createDataFrame([("Run", "id", "Validity", "r", "c", 1, 1.0, "[]")], ISSUES_SCHEMA), str(tmp_path / "issues")
    history.put_run(issues, at, "k", ISSUES_SCHEMA)
    history.put_run(issues.limit(0), at, "k", ISSUES_SCHEMA)
    assert history.scan_runs(spark, at, ISSUES_SCHEMA, "k").count() == 0


def test_keyed_runs_after_others(spark, tmp_path):
    """A hub whose runs had no keys goes on with keys: labels go on, and the report has all runs."""
    layout = staged(spark, tmp_path)
    assert runs.run_assessment(spark, layout, run_ts=NOW, row_id="row_id") == "Run 1"
    later = "2024-03-02T06:30:00+00:00"
    for _ in range(2):
        assert runs.run_assessment(spark, layout, run_ts=later, row_id="row_id", run_key="hub/2") == "Run 2"
    cards = {r.run_label: r.issue_groups for r in runs.run_report(spark, layout).collect()}
    assert cards == {"Run 1": 5, "Run 2": 5}
    assert not list((tmp_path / "hub/output/_staging").iterdir())


def test_scratch_is_deleted_when_asked(spark, monkeypatch):
    from rowgauge import session

    monkeypatch.setattr(session, "_SCRATCH", {})
    path = session.scratch_path(spark, "some")
    session.scratch_path(spark, "never-written")
    tables.write_table(spark.range(3), path)
    assert session.forget_scratch(spark) == 1 and not session.path_exists(spark, path)
    assert session.forget_scratch(spark) == 0
