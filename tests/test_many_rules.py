"""Rules by the hundred: flags in packs, counts by pattern, against plain Python."""

from __future__ import annotations

import json
import random

import pytest
from pyspark.sql import functions as F

from rowgauge import Rule, RuleSet, assess_runs, evaluate, evaluate_slices
from rowgauge.operators.scoring import CHUNK

WIDTH = 3 * CHUNK + 1
DIMENSIONS = ("Completeness", "Validity", "Timeliness")


@pytest.fixture(scope="module")
def wide(spark):
    rng = random.Random(2)
    rows = [(i, f"s{i % 3}", *[rng.choice([None, *range(8)]) for _ in range(WIDTH)]) for i in range(200)]
    columns = ", ".join(f"c{j} long" for j in range(WIDTH))
    return rows, spark.createDataFrame(rows, f"row_id long, part string, {columns}").repartition(4)


def rules():
    kinds = [("not_null", {}), ("range", {"min": 1, "max": 6}), ("in_set", {"allowed": [0, 1, 2, 3, 4]})]
    made = [Rule(f"r{j}", DIMENSIONS[j % 3], kinds[j % 3][0], (f"c{j}",), kinds[j % 3][1]) for j in range(WIDTH)]
    made.insert(5, Rule("key", "Uniqueness", "unique", ("c0",)))
    made.insert(20, Rule("pair", "Completeness", "unique", ("c1", "c2")))
    return RuleSet(tuple(made), slices=(("part",),))


def fails(rule, rows):
    """The rows that fail, in order."""
    at = [2 + int(c[1:]) for c in rule.columns]
    if rule.kind == "unique":
        keys = [tuple(r[k] for k in at) for r in rows]
        return [r for r, key in zip(rows, keys) if keys.count(key) > 1]
    value = lambda r: r[at[0]]
    bad = {
        "not_null": lambda v: v is None,
        "range": lambda v: v is None or not 1 <= v <= 6,
        "in_set": lambda v: v not in (0, 1, 2, 3, 4),
    }[rule.kind]
    return [r for r in rows if bad(value(r))]


def score(rows, dimension):
    failing = {r[0] for rule in rules().rules if rule.dimension == dimension for r in fails(rule, rows)}
    return round((1 - len(failing) / len(rows)) * 100, 2)


def test_counts_samples_and_scores(wide):
    rows, df = wide
    report = evaluate(df, rules(), row_id="row_id")
    found = {r.rule: r for r in report.rules.collect()}
    assert len(found) == WIDTH + 2
    for rule in rules().rules:
        failing = fails(rule, rows)
        assert found[rule.id].failed_count == len(failing), rule.id
        if len(rule.columns) == 1:
            first = [r[2 + int(rule.columns[0][1:])] for r in failing[:5]]
            assert json.loads(found[rule.id].sample_values) == first, rule.id
    scores = report.scores.first()
    assert [scores[f"{d.lower()}_pct"] for d in (*DIMENSIONS, "Uniqueness")] == [score(rows, d) for d in (*DIMENSIONS, "Uniqueness")]


def test_without_a_row_id(wide):
    rows, df = wide
    for r in evaluate(df.drop("row_id"), rules()).rules.collect():
        if r.rule not in ("pair",):
            assert len(json.loads(r.sample_values)) == min(5, r.failed_count)


def test_runs_and_slices(spark, wide):
    rows, df = wide
    at = F.when(F.col("part") == "s0", F.lit("2024-01-01T00:00:00")).otherwise(F.lit("2024-01-02T00:00:00"))
    found = assess_runs(df.withColumn("at", at), run_ts="at", row_id="row_id", rules=rules())
    parts = [[r for r in rows if (r[1] == "s0") == first] for first in (True, False)]
    for part, got in zip(parts, found.summary.orderBy("run_id").collect()):
        assert got.rows_raw == len(part) and got.validity_pct == score(part, "Validity")
        kept = [r for r in part if not any(r in fails(x, part) for x in rules().rules if x.kind == "not_null")]
        assert got.rows_after_hard_clean == len(kept)
    sliced = {r.part: r.validity_pct for r in evaluate_slices(df, rules(), row_id="row_id").collect()}
    assert sliced == {p: score([r for r in rows if r[1] == p], "Validity") for p in ("s0", "s1", "s2")}
    assert found.clean.count() == found.summary.agg(F.sum("rows_after_hard_clean")).first()[0]


def test_no_rules_and_no_rows(wide):
    _, df = wide
    assert evaluate(df, RuleSet(()), row_id="row_id").scores.first()["rows"] == 200
    assert all(r.failed_count == 0 for r in evaluate(df.limit(0), rules(), row_id="row_id").rules.collect())
