"""Registered queries: one per operator, each over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowgauge import Profile, Rule, RuleSet, assess, compile_rules, evaluate, evaluate_slices
from rowgauge.functions import display, values
from rowgauge.model import ISSUES_SCHEMA, RAW_SCHEMA, SCORE_COLUMNS, SUMMARY_SCHEMA
from rowgauge.operators import checks, history, normalize, scoring, views
from rowgauge.operators.uniqueness import flag_duplicates
from rowgauge.plans import run as runs
from rowgauge.plans.assess import issues_by_severity as by_severity
from rowgauge.session import scratch_path
from rowgauge.sources import history as history_tables
from rowgauge.sources import manifest as manifests
from rowgauge.sources import tables

from .feeds import (
    FEED_COLUMNS,
    RUN_TS,
    monthly,
    order_rules,
    raw_feed,
    raw_orders,
    ruled,
    stored_history,
    table,
    wide_orders,
    wide_rules,
    yearly,
)

PROFILE = Profile()
ROW_SCHEMA = T.StructType([T.StructField("row_id", T.LongType()), *RAW_SCHEMA.fields])
STANDARD_RULES = (
    "required_columns_present",
    "min_amount:0.0",
    "email_format",
    "primary_key:order_id",
    "max_delay_minutes:720",
)


def _plain(df: DataFrame) -> DataFrame:
    """Timestamps without a zone, as the given tables have them."""
    zoned = [f.name for f in df.schema if isinstance(f.dataType, T.TimestampType)]
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in zoned})


def _normal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalize.normalize(raw_feed(spark, sf_dir), PROFILE)


def _assessed(spark: SparkSession, sf_dir: str):
    return assess(raw_feed(spark, sf_dir), run_ts=RUN_TS, row_id="row_id")


# Sources and sinks


def csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "raw-csv")
    tables.write_table(raw_feed(spark, sf_dir), path, "csv")
    return _plain(tables.scan_csv(spark, path, ROW_SCHEMA))


def source_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    staged = scratch_path(spark, "staged")
    tables.write_table(raw_feed(spark, sf_dir), staged)
    found = tables.staged_path(spark, scratch_path(spark, "absent"), staged)
    return tables.scan(spark, found).withColumn("from_staged", F.lit(found == staged))


def summary_default_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "legacy-summary")
    tables.write_table(yearly(spark, sf_dir).summary.drop("run_label"), path)
    return history_tables.read_summary(spark, path).select("run_label", "run_id", "overall_pct")


def issues_scan_legacy(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "legacy-issues")
    tables.write_table(yearly(spark, sf_dir).issues.drop("run_label", "run_id"), path)
    return history_tables.read_issues(spark, path)


def _append_twice(spark: SparkSession, rows: DataFrame, append: Callable, name: str) -> str:
    """The runs before 1999 first, then all: those already there are not repeated."""
    path = scratch_path(spark, name)
    append(rows.where(F.col("run_id") < "1999"), path)
    append(rows, path)
    return path


def summary_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = yearly(spark, sf_dir).settle(samples=False).summary
    path = _append_twice(spark, rows, history_tables.append_summary, "summary")
    return history_tables.read_summary(spark, path)


def issues_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = yearly(spark, sf_dir).settle().issues
    path = _append_twice(spark, rows, history_tables.append_issues, "issues")
    return history_tables.read_issues(spark, path)


def last_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "last-metrics")
    tables.write_json_object(_assessed(spark, sf_dir).summary, path)
    return spark.read.schema(SUMMARY_SCHEMA).json(path)


def dashboard_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    summary, issues = stored_history(spark, sf_dir)
    return tables.records(summary).unionByName(tables.records(issues))


def drilldown_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, issues = stored_history(spark, sf_dir, summary=False)
    path = scratch_path(spark, "drilldown")
    views.write_drilldown(views.drilldown(issues, None, "Validity", "email"), path)
    exported = spark.read.options(header="true", escape='"', nullValue="\0").csv(path)
    return exported.withColumns(
        {"failed_count": F.col("failed_count").cast("bigint"), "failed_pct": F.col("failed_pct").cast("double")}
    )


def dataset_shape(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.dataset_line(_assessed(spark, sf_dir).clean.drop("row_id")).select("line")


def manifest_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    clean = scratch_path(spark, "clean")
    tables.write_table(_assessed(spark, sf_dir).clean, clean)
    absent = scratch_path(spark, "absent")
    found = manifests.manifest(spark, {"clean": (clean, "parquet"), "report": (absent, "parquet")})
    return found.drop("path")


def append_same_second(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two datasets assessed at one second into one history, the first stored twice."""
    raw = raw_orders(spark, sf_dir)
    done = F.coalesce(F.col("order_status") == "F", F.lit(False))
    path = scratch_path(spark, "same-second")
    found = [
        assess(raw.where(part).select("row_id", *FEED_COLUMNS), run_ts=RUN_TS, run_label=label, row_id="row_id")
        .settle(samples=False)
        .summary
        for part, label in ((done, "Run 1"), (~done, "Run 2"))
    ]
    for rows in (found[0], found[1], found[0]):
        history_tables.append_summary(rows, path)
    return history_tables.read_summary(spark, path)


def history_mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files without labels and version, later ones with labels of their own, in either format."""
    rows = yearly(spark, sf_dir).settle(samples=False).summary
    late = F.col("run_id") >= "1999"
    parts = []
    for fmt in ("parquet", "csv"):
        path = scratch_path(spark, f"mixed-{fmt}")
        tables.write_table(rows.where(~late).drop("run_label", "rules_version"), path, fmt)
        named = rows.where(late).withColumn("run_label", F.concat(F.lit("R-"), F.col("run_id")))
        history_tables.append_summary(named, path, fmt)
        parts.append(history_tables.read_summary(spark, path, fmt).withColumn("format", F.lit(fmt)))
    return history.union_history(*parts)


def csv_folder(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A folder of CSV files with other column orders, a column less, and lines that don't fit: rows, and the odd lines."""
    raw = raw_feed(spark, sf_dir)
    path = scratch_path(spark, "csv-folder")
    part = F.pmod("row_id", F.lit(3))
    tables.write_table(raw.where(part == 0), path, "csv", mode="append")
    tables.write_table(raw.where(part == 1).select(*reversed(raw.columns)), path, "csv", mode="append")
    tables.write_table(raw.where(part == 2).drop("country"), path, "csv", mode="append")
    odd = raw.where(F.pmod("row_id", F.lit(50)) == 0).select("row_id", F.concat_ws(",", "row_id", F.lit("x@y.z"), F.lit("more")).alias("value"))
    head = spark.createDataFrame([(-1, "row_id,email")], "row_id long, value string")
    head.unionByName(odd).repartition(1).sortWithinPartitions("row_id").select("value").write.mode("append").text(path)
    rows, rejects = tables.scan_csv_checked(spark, path, ROW_SCHEMA)
    return _plain(rows).unionByName(rejects, allowMissingColumns=True)


def half_written(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An output that its writer never finished is missing, and as an input the staged one is read instead."""
    clean, begun = scratch_path(spark, "clean"), scratch_path(spark, "begun")
    rows = raw_feed(spark, sf_dir)
    tables.write_table(rows, clean)
    tables.write_table(rows.limit(0), f"{begun}/_temporary/0")
    found = manifests.manifest(spark, {"clean": (clean, "parquet"), "begun": (begun, "parquet")})
    source = tables.staged_path(spark, begun, clean)
    code = manifests.exit_code(found)
    return found.select("name", "exists", "row_count", F.lit(source == clean).alias("from_staged"), F.lit(code).alias("code"))


# Projections and filters


def normalize_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalize.strip_text(raw_feed(spark, sf_dir), ("email", "country")).select("row_id", "email", "country")


def coerce_timestamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, at = F.col("o_orderkey"), F.col("o_orderdate")
    day = F.date_format(at, "yyyy-MM-dd")
    text = (
        F.when(F.pmod(k, F.lit(5)) == 0, day)
        .when(F.pmod(k, F.lit(5)) == 1, F.concat(day, F.lit(" 01:02:03")))
        .when(F.pmod(k, F.lit(5)) == 2, F.concat(day, F.lit("T01:02:03+02:00")))
        .when(F.pmod(k, F.lit(5)) == 3, F.concat(F.lit(" "), day, F.lit("T23:59:59Z")))
        .otherwise(F.concat(F.lit("not "), day))
    )
    nanos = F.unix_micros(at.cast("timestamp")) * 1000 + 1999
    source = table(spark, sf_dir, "orders").select(
        k.alias("row_id"), text.alias("text_ts"), at.alias("plain_ts"), nanos.alias("nanos_ts")
    )
    return _plain(normalize.coerce_timestamps(source, ("text_ts", "plain_ts", "nanos_ts", "absent_ts")))


def coerce_amount(spark: SparkSession, sf_dir: str) -> DataFrame:
    amount, k = F.col("amount"), F.col("row_id")
    written = (
        F.when(F.pmod(k, F.lit(6)) == 1, F.concat(amount, F.lit("d")))
        .when(F.pmod(k, F.lit(6)) == 2, F.concat(F.lit(" "), amount, F.lit("\t")))
        .when(F.pmod(k, F.lit(6)) == 3, F.concat(amount, F.lit("e2")))
        .when(F.pmod(k, F.lit(6)) == 4, F.concat(amount, F.lit("f")))
        .otherwise(amount)
    )
    raw = raw_feed(spark, sf_dir).select("row_id", written.alias("amount"))
    return raw.select("row_id", values.to_number(F.col("amount"), T.StringType()).alias("number"))


def timestamp_fallback_rename(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = raw_feed(spark, sf_dir).withColumnsRenamed({"order_ts_utc": "order_ts", "ingest_ts_utc": "ingest_ts"})
    parts = []
    for resolve in (False, True):
        found = assess(raw, run_ts=RUN_TS, row_id="row_id", resolve_aliases=resolve)
        parts.append(found.clean.withColumn("resolved", F.lit(resolve)))
    return _plain(parts[0].unionByName(parts[1]))


def ingest_delay(spark: SparkSession, sf_dir: str) -> DataFrame:
    delay = values.delay_minutes(F.col("order_ts_utc"), F.col("ingest_ts_utc"))
    return _normal(spark, sf_dir).select("row_id", delay.alias("delay_minutes"))


def hard_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain(_assessed(spark, sf_dir).clean)


def hard_clean_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain(_assessed(spark, sf_dir).rejects)


def issues_for_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, issues = stored_history(spark, sf_dir, summary=False)
    return views.issues_for_run(issues, "Run 3")


def drill_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, issues = stored_history(spark, sf_dir, summary=False)
    return views.drill_dimension(issues, "vaLidity")


def drill_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, issues = stored_history(spark, sf_dir, summary=False)
    return views.drill_search(issues, "  ABC, ")


def run_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    summary, _ = stored_history(spark, sf_dir, issues=False)
    return views.run_lookup(summary, "Run 4")


# Executed checks: every row with its flag


def _flag(spark: SparkSession, sf_dir: str, number: int) -> DataFrame:
    normal = _normal(spark, sf_dir)
    check = checks.standard_checks(normal, PROFILE)[number]
    return normal.select("row_id", check.failed.alias("failed"))


def check_completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flag(spark, sf_dir, 0)


def check_amount_min(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flag(spark, sf_dir, 1)


def check_email(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flag(spark, sf_dir, 2)


def check_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    flagged = flag_duplicates(raw_feed(spark, sf_dir).select("row_id", "order_id"), ["order_id"], "row_id", "failed")
    return flagged.select("row_id", "order_id", "failed")


def check_delay(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flag(spark, sf_dir, 4)


def check_validity_any(spark: SparkSession, sf_dir: str) -> DataFrame:
    normal = _normal(spark, sf_dir)
    found = [c.failed for c in checks.standard_checks(normal, PROFILE) if c.dimension == "Validity"]
    return normal.select("row_id", checks.any_of(found).alias("failed"))


# Declared rules


def _rule(df: DataFrame, name: str, kind: str, column: str, **params) -> Column:
    return checks.rule_failed(df, Rule(name, "Validity", kind, (column,), params))


def rule_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    keyed, row_id = normalize.with_row_id(items, None)
    return flag_duplicates(keyed, ["l_orderkey", "l_linenumber"], row_id, "failed").drop(row_id)


def rule_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = raw_orders(spark, sf_dir)
    tested = ("order_ts_utc", "ingest_ts_utc", "channel", "country", "email")
    return raw.select("row_id", *[_rule(raw, c, "not_null", c).alias(f"{c}_failed") for c in tested])


def rule_unique_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A unique rule that null keys fail, and one that they pass."""
    raw = raw_feed(spark, sf_dir)
    rules = [
        Rule(f"nulls_{'fail' if fail else 'pass'}", "Uniqueness", "unique", ("order_id",), nulls_fail=fail)
        for fail in (True, False)
    ]
    # one at a time and together: alone a rule is counted by key, else by row
    every = [RuleSet((rules[0],)), RuleSet((rules[1],)), RuleSet(tuple(rules))]
    parts = [evaluate(raw, chosen, row_id="row_id").rules.withColumn("set_no", F.lit(i)) for i, chosen in enumerate(every)]
    found = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return found.select("set_no", "rule", "failed_count", "failed_pct", "sample_values")


def rule_in_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = raw_orders(spark, sf_dir)
    mixed = _rule(raw, "region", "in_set", "region", allowed=[0, "2", "x", 3.5, True])
    texts = _rule(raw, "status", "in_set", "order_status", allowed=[1, "F"])
    known = _rule(raw, "channel", "in_set", "channel", allowed=["AUTOMOBILE", "BUILDING", "MACHINERY"])
    return raw.select(
        "row_id", "channel", known.alias("failed"), mixed.alias("region_failed"), texts.alias("status_failed")
    )


def rule_regex(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = _normal(spark, sf_dir)
    strict = _rule(raw, "email", "regex", "email", pattern=r"^customer\.\d+@EXAMPLE\.com$")
    loose = _rule(raw, "email_i", "regex", "email", pattern=r"customer\.\d+@EXAMPLE", flags="I")
    return raw.select("row_id", strict.alias("failed_as_written"), loose.alias("failed_any_case"))


def rule_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "lineitem")
    quantity = _rule(items, "quantity", "range", "l_quantity", min=1, max=45)
    discount = _rule(items, "discount", "range", "l_discount", min=0.0, max=0.07)
    price = _rule(items, "price", "range", "l_extendedprice", min=20000)
    return items.select(
        "l_orderkey",
        "l_linenumber",
        quantity.alias("quantity_failed"),
        discount.alias("discount_failed"),
        price.alias("price_failed"),
    )


def rule_max_lag(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = raw_feed(spark, sf_dir)
    params = {"event_ts": "order_ts_utc", "ingest_ts": "ingest_ts_utc", "max_hours": 12}
    return raw.select("row_id", checks.rule_failed(raw, Rule("lag", "Timeliness", "max_lag_hours", (), params)).alias("failed"))


def score_weighted(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = {d: F.col(c) for d, c in SCORE_COLUMNS.items() if d != "Overall"}
    weighted = scoring.overall_score(scores, order_rules().weights)
    return yearly(spark, sf_dir).summary.select("run_id", "overall_pct", weighted.alias("weighted_pct"))


def _evaluated(spark: SparkSession, sf_dir: str, samples: bool = True):
    return evaluate(raw_orders(spark, sf_dir), order_rules(), row_id="row_id", samples=samples)


def issues_by_severity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return by_severity(_evaluated(spark, sf_dir, samples=False).rules)


def score_by_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate_slices(raw_orders(spark, sf_dir), order_rules(), row_id="row_id")


def rule_set_eval(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _evaluated(spark, sf_dir).rules


def rule_set_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _evaluated(spark, sf_dir, samples=False).scores


def rule_set_many(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three hundred declared rules on a table of three hundred columns."""
    return evaluate(wide_orders(spark, sf_dir), wide_rules(), row_id="row_id").rules


def rule_set_many_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate(wide_orders(spark, sf_dir), wide_rules(), row_id="row_id", samples=False).scores


# Aggregations


def run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _assessed(spark, sf_dir).summary


def dimension_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_summary(spark, sf_dir).select("completeness_pct", "validity_pct", "uniqueness_pct", "timeliness_pct")


def overall_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_summary(spark, sf_dir).select("overall_pct")


def row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_summary(spark, sf_dir).select("rows_raw", "rows_after_global_fixes", "rows_after_hard_clean")


def failed_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    normal = _normal(spark, sf_dir)
    found = checks.standard_checks(normal, PROFILE)
    facts = scoring.measure(normal, found, "row_id", samples=False)
    return scoring.check_rows(facts, found).select("check_no", "dimension", "rule", "failed_count", "failed_pct")


def issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _assessed(spark, sf_dir).issues


def issues_unkeyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Issues of a table dealt out anew, without a row id: counts, and how many samples there are."""
    found = assess(raw_feed(spark, sf_dir).drop("row_id").repartition(7), run_ts=RUN_TS).issues
    samples = F.size(F.from_json("sample_values", "array<string>"))
    return found.select("dimension", "rule", "failed_count", "failed_pct", samples.alias("n_samples"))


def issue_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monthly(spark, sf_dir).issues.select("run_id", "column", "sample_values")


def yearly_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return yearly(spark, sf_dir).summary


def yearly_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    return yearly(spark, sf_dir).issues


def ruled_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ruled(spark, sf_dir).summary


def ruled_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Issues of declared rules, with their severity, as the history has them."""
    path = scratch_path(spark, "ruled-issues")
    history_tables.append_issues(ruled(spark, sf_dir).issues, path)
    return history_tables.read_issues(spark, path)


# Views of the history


def issue_group_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.issue_group_count(*stored_history(spark, sf_dir))


def lowest_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    summary, _ = stored_history(spark, sf_dir, issues=False)
    return views.lowest_dimension(summary)


def backfill_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Validity rows lost their label, timeliness rows also name an unknown run."""
    summary, found = stored_history(spark, sf_dir)
    lost = F.col("dimension").isin("Validity", "Timeliness")
    unknown = F.col("dimension") == "Timeliness"
    older = found.withColumns(
        {
            "run_label": F.when(~lost, F.col("run_label")).otherwise(F.when(F.col("rule") == "email_format", "")),
            "run_id": F.when(unknown, F.concat(F.lit("x"), F.col("run_id"))).otherwise(F.col("run_id")),
        }
    )
    return history.backfill_labels(summary, older)


def run_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    summary, _ = stored_history(spark, sf_dir, issues=False)
    return views.run_delta(summary, ("overall_pct", "validity_pct"))


def latest_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    summary, _ = stored_history(spark, sf_dir, issues=False)
    return views.latest_run(summary)


def next_run_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    summary, _ = stored_history(spark, sf_dir, issues=False)
    return history.next_run_label(summary)


def drilldown_top50(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, found = stored_history(spark, sf_dir, monthly, summary=False)
    return views.drilldown_top50(views.drilldown(found, None, "Overall", "a"), STANDARD_RULES)


def history_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    new = yearly(spark, sf_dir).summary
    old = new.where(F.col("run_id") < "1999").drop("run_label", "rules_version")
    return history.union_history(old, new.where(F.col("run_id") >= "1999"))


def score_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    summary, _ = stored_history(spark, sf_dir, issues=False)
    return views.score_bars(summary)


def trend_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    summary, _ = stored_history(spark, sf_dir, monthly, issues=False)
    return views.trend_series(summary, ("Overall", "Validity", "Timeliness"))


def history_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    summary, _ = stored_history(spark, sf_dir, issues=False)
    return views.history_table(summary)


def run_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.run_cards(*stored_history(spark, sf_dir))


def run_cards_legacy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cards of a history with a shared and a null run id, and issues that lack the id or the label."""
    summary, found = stored_history(spark, sf_dir)
    third = summary.where(F.col("run_label") == "Run 3")

    def again(label: str, second: str, rid: Column) -> DataFrame:
        later = F.replace(F.col("run_ts_utc"), F.lit("06:30:00"), F.lit(f"06:30:{second}"))
        return third.withColumns({"run_label": F.lit(label), "run_ts_utc": later, "run_id": rid})

    summary = summary.union(again("Other", "01", F.col("run_id"))).union(again("Lost", "02", F.lit(None).cast("string")))
    found = found.withColumns(
        {
            "run_id": F.when(F.col("dimension") != "Validity", F.col("run_id")),
            "run_label": F.when(F.col("dimension") != "Timeliness", F.col("run_label")).otherwise(""),
        }
    )
    return views.run_cards(summary, found)


# Scalar functions


def fmt_pct(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = F.when(F.col("l_linenumber") != 3, F.col("l_extendedprice") * 1.0007)
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", display.fmt_pct(price).alias("text"))


def sample_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sample lists of every month, some as a single JSON text, plain text, blank or null."""
    found = monthly(spark, sf_dir).issues
    samples = (
        F.when(F.col("rule") == "email_format", F.concat(F.lit(' "'), F.col("run_id"), F.lit('"')))
        .when(F.col("column") == "(required)", "oops [")
        .when((F.col("column") == "ingest_ts_utc") & (F.col("failed_count") < 6), F.lit(None))
        .otherwise(F.col("sample_values"))
    )
    return found.select("run_id", "rule", display.sample_text(samples).alias("text"))


def run_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = score_by_slice(spark, sf_dir)
    return scored.select("slice", "channel", "country", "region", "order_status", display.status(F.col("overall_pct")).alias("status"))


def run_identity(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = values.to_utc(F.col("ts"), T.TimestampNTZType())
    return table(spark, sf_dir, "events").select(
        "event_id",
        display.run_id_text(at).alias("run_id"),
        display.run_ts_text(at).alias("run_ts_utc"),
        display.zulu_text(at).alias("generated"),
    )


# Whole runs


def end_to_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Assess the feed, then the feed without minus signs, and report on both."""
    layout = runs.Layout(scratch_path(spark, "run"))
    raw = raw_feed(spark, sf_dir)
    mended = raw.withColumn("amount", F.replace(F.col("amount"), F.lit("-"), F.lit("")))
    for now, given in ((RUN_TS, raw), ("2024-03-02T06:30:00+00:00", mended)):
        if runs.run_all(spark, layout, now=now, raw=given) != 0:
            raise RuntimeError("the run left outputs missing")
    return runs.run_report(spark, layout)


def run_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run cut short after its summary, started again, and once more: one run in every table."""
    layout = runs.Layout(scratch_path(spark, "rerun"))
    raw = raw_feed(spark, sf_dir)
    runs.stage(raw, layout)
    history_tables.append_summary(assess(raw, run_ts=RUN_TS, row_id="row_id").summary, layout.summary)
    labels = [runs.run_assessment(spark, layout, run_ts=RUN_TS, row_id="row_id") for _ in range(2)]
    groups = views.issue_group_count(
        history_tables.read_summary(spark, layout.summary), history_tables.read_issues(spark, layout.issues)
    )
    pointer = spark.read.json(layout.last_run).first()["run_label"]
    return groups.select(
        "run_label", "run_id", "issue_groups", F.lit(pointer).alias("pointer"), F.lit(" ".join(labels)).alias("returned")
    )


def run_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two equal-looking datasets of one second, the first delivered twice: two runs."""
    layout = runs.Layout(scratch_path(spark, "keys"))
    runs.stage(raw_feed(spark, sf_dir), layout)
    for key in ("north/2024-03-01", "south/2024-03-01", "north/2024-03-01"):
        runs.run_assessment(spark, layout, run_ts=RUN_TS, row_id="row_id", run_key=key)
    return history_tables.scan_runs(spark, layout.keyed_summary, SUMMARY_SCHEMA)


def issues_of_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The issues of one run of many, from its partition alone."""
    path = scratch_path(spark, "issues-by-run")
    rows = yearly(spark, sf_dir).settle().issues.withColumn("run_key", F.concat(F.lit("orders/"), "run_id"))
    history_tables.put_runs(rows, path, ISSUES_SCHEMA)
    history_tables.put_runs(rows.where(F.col("run_id") < "1998"), path, ISSUES_SCHEMA)  # delivered again
    found = history_tables.scan_runs(spark, path, ISSUES_SCHEMA, "orders/19970101_063000")
    return views.issues_for_run(found, None).drop("severity")


def run_unpublished(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run that raises at its histories leaves clean table, histories and pointer as they were."""
    layout = runs.Layout(scratch_path(spark, "unpublished"))
    raw = raw_feed(spark, sf_dir)
    runs.stage(raw, layout)
    runs.run_assessment(spark, layout, run_ts=RUN_TS, row_id="row_id", run_key="first")
    runs.stage(raw.where(F.pmod("row_id", F.lit(2)) == 0), layout)
    try:
        runs.run_assessment(spark, layout, run_ts=RUN_TS, row_id="row_id", run_key="")
    except ValueError as error:
        raised = str(error)
    clean = tables.scan(spark, layout.clean).agg(F.count(F.lit(1)).alias("clean_rows"))
    stored = history_tables.scan_runs(spark, layout.keyed_summary, SUMMARY_SCHEMA).select("run_label", "run_key", "rows_after_hard_clean")
    pointer = spark.read.json(layout.last_run).first()["run_key"]
    return stored.join(F.broadcast(clean)).withColumns({"pointer": F.lit(pointer), "raised": F.lit(raised)})


def rows_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With a uniqueness rule under completeness: the summary's kept rows are those of the clean table."""
    rules = compile_rules(
        {
            "rules": [
                {"id": "key", "dimension": "completeness", "type": "unique", "column": "order_id"},
                {"id": "has_email", "dimension": "completeness", "type": "not_null", "column": "email"},
            ]
        }
    )
    found = assess(raw_feed(spark, sf_dir), run_ts=RUN_TS, row_id="row_id", rules=rules)
    clean = found.clean.agg(F.count(F.lit(1)).alias("clean_rows"))
    return found.summary.select("rows_after_hard_clean", "completeness_pct").join(F.broadcast(clean))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        run_summary,
        csv_scan,
        source_fallback,
        summary_default_labels,
        issues_scan_legacy,
        summary_append,
        issues_append,
        last_metrics,
        dashboard_records,
        drilldown_export,
        dataset_shape,
        manifest_check,
        append_same_second,
        history_mixed,
        normalize_strings,
        coerce_timestamps,
        coerce_amount,
        timestamp_fallback_rename,
        ingest_delay,
        hard_clean,
        hard_clean_rejects,
        issues_for_run,
        drill_dimension,
        drill_search,
        run_lookup,
        check_completeness,
        check_amount_min,
        check_email,
        check_unique,
        check_delay,
        check_validity_any,
        rule_unique,
        rule_unique_nulls,
        rule_not_null,
        rule_in_set,
        rule_regex,
        rule_range,
        rule_max_lag,
        score_weighted,
        issues_by_severity,
        score_by_slice,
        rule_set_eval,
        rule_set_scores,
        rule_set_many,
        csv_folder,
        half_written,
        run_keys,
        issues_of_key,
        run_unpublished,
        rows_kept,
        rule_set_many_scores,
        dimension_scores,
        overall_score,
        row_counts,
        failed_counts,
        issues,
        issues_unkeyed,
        issue_samples,
        ruled_summary,
        ruled_issues,
        yearly_summary,
        yearly_issues,
        issue_group_count,
        lowest_dimension,
        backfill_labels,
        run_delta,
        latest_run,
        next_run_label,
        drilldown_top50,
        history_union,
        score_bars,
        trend_series,
        history_table,
        run_cards,
        run_cards_legacy,
        fmt_pct,
        sample_text,
        run_status,
        run_identity,
        end_to_end,
        run_rerun,
    )
}
