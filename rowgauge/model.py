"""Schemas, rule profiles and declared rules."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from .session import path_exists

# Table layouts.
RAW_SCHEMA = T.StructType(
    [
        T.StructField("order_id", T.LongType()),
        T.StructField("email", T.StringType()),
        T.StructField("country", T.StringType()),
        T.StructField("amount", T.StringType()),
        T.StructField("order_ts_utc", T.TimestampType()),
        T.StructField("ingest_ts_utc", T.TimestampType()),
    ]
)
SUMMARY_SCHEMA = T.StructType(
    [
        T.StructField("run_label", T.StringType()),
        T.StructField("run_id", T.StringType()),
        T.StructField("run_ts_utc", T.StringType()),
        T.StructField("rows_raw", T.LongType()),
        T.StructField("rows_after_global_fixes", T.LongType()),
        T.StructField("rows_after_hard_clean", T.LongType()),
        T.StructField("completeness_pct", T.DoubleType()),
        T.StructField("validity_pct", T.DoubleType()),
        T.StructField("uniqueness_pct", T.DoubleType()),
        T.StructField("timeliness_pct", T.DoubleType()),
        T.StructField("overall_pct", T.DoubleType()),
        T.StructField("rules_version", T.StringType()),
    ]
)
ISSUES_SCHEMA = T.StructType(
    [
        T.StructField("run_label", T.StringType()),
        T.StructField("run_id", T.StringType()),
        T.StructField("dimension", T.StringType()),
        T.StructField("rule", T.StringType()),
        T.StructField("column", T.StringType()),
        T.StructField("failed_count", T.LongType()),
        T.StructField("failed_pct", T.DoubleType()),
        T.StructField("sample_values", T.StringType()),
    ]
)

# What tells a run: several runs of one second share an id.
RUN_KEY = ("run_label", "run_id")

# Dimensions in scoring order, and their score columns.
DIMENSIONS = ("Completeness", "Validity", "Uniqueness", "Timeliness")
SCORE_COLUMNS = {
    "Completeness": "completeness_pct",
    "Validity": "validity_pct",
    "Uniqueness": "uniqueness_pct",
    "Timeliness": "timeliness_pct",
    "Overall": "overall_pct",
}

# Effective defaults of an assessment.
DEFAULT_VERSION = "1.0.0"
DEFAULT_PRIMARY_KEY = "order_id"
DEFAULT_REQUIRED = ("order_id", "email", "country", "amount", "order_ts_utc", "ingest_ts_utc")
DEFAULT_AMOUNT_MIN = 0.0
DEFAULT_MAX_DELAY_MINUTES = 720
DEFAULT_EMAIL_PATTERN = r"^[^@\s]+@[^@\s]+\.[^@\s]+$"


@dataclass(frozen=True)
class Profile:
    """Settings of the standard assessment; column names are parameters."""

    version: str = DEFAULT_VERSION
    primary_key: str = DEFAULT_PRIMARY_KEY
    required: tuple[str, ...] = DEFAULT_REQUIRED
    amount_min: float = DEFAULT_AMOUNT_MIN
    max_delay_minutes: int = DEFAULT_MAX_DELAY_MINUTES
    email_pattern: str = DEFAULT_EMAIL_PATTERN
    amount_column: str = "amount"
    email_column: str = "email"
    event_column: str = "order_ts_utc"
    event_alias: str = "order_ts"
    arrival_column: str = "ingest_ts_utc"
    arrival_alias: str = "ingest_ts"
    strip_columns: tuple[str, ...] = ("email", "country")

    @classmethod
    def from_mapping(cls, config: Mapping[str, Any] | None) -> Profile:
        """Overrides come from six top-level keys; everything else keeps its default."""
        config = config or {}
        readers = {
            "version": ("version", str),
            "primary_key": ("primary_key", str),
            "required_columns": ("required", tuple),
            "amount_min": ("amount_min", float),
            "max_delay_minutes": ("max_delay_minutes", int),
            "email_regex": ("email_pattern", str),
        }
        return cls(**{name: read(config[key]) for key, (name, read) in readers.items() if key in config})


RULE_KINDS = ("unique", "not_null", "in_set", "regex", "range", "max_lag_hours")


@dataclass(frozen=True)
class Rule:
    """One declared rule; ``kind`` is one of RULE_KINDS."""

    id: str
    dimension: str
    kind: str
    columns: tuple[str, ...] = ()
    params: Mapping[str, Any] = field(default_factory=dict)
    severity: str = "medium"
    nulls_fail: bool = True

    def __post_init__(self) -> None:
        if self.kind not in RULE_KINDS:
            raise ValueError(f"rule {self.id}: unknown type {self.kind!r}")
        if self.dimension not in DIMENSIONS:
            raise ValueError(f"rule {self.id}: unknown dimension {self.dimension!r}")


@dataclass(frozen=True)
class RuleSet:
    """Declared rules with the scoring weights and report slices that go with them."""

    rules: tuple[Rule, ...]
    weights: Mapping[str, float] = field(default_factory=dict)
    slices: tuple[tuple[str, ...], ...] = ()
    version: str = DEFAULT_VERSION
    primary_key: str | None = None
    event_column: str | None = None
    arrival_column: str | None = None

    def profile(self) -> Profile:
        """How a table under these rules is normalised: its key and time columns are the declared ones."""
        named = {
            "primary_key": self.primary_key,
            "event_column": self.event_column,
            "arrival_column": self.arrival_column,
        }
        return Profile(version=self.version, **{k: v for k, v in named.items() if v})


def _columns(entry: Mapping[str, Any]) -> tuple[str, ...]:
    named = entry.get("columns", entry.get("column", ()))
    return (named,) if isinstance(named, str) else tuple(named)


def compile_rules(config: Mapping[str, Any]) -> RuleSet:
    """Turn the declared grammar (a mapping, e.g. parsed YAML) into a RuleSet.

    The ``dataset`` block names the primary key and the two time columns, which
    rules of the kinds ``unique`` and ``max_lag_hours`` need not repeat.
    """
    dataset = config.get("dataset") or {}
    stamps = dataset.get("timestamps") or {}
    key = dataset.get("primary_key")

    def columns(entry: Mapping[str, Any]) -> tuple[str, ...]:
        given = _columns(entry)
        return (str(key),) if not given and key and entry["type"] == "unique" else given

    def params(entry: Mapping[str, Any]) -> dict[str, Any]:
        given = dict(entry.get("params") or {})
        if entry["type"] == "max_lag_hours":
            given = {**{k: stamps[k] for k in ("event_ts", "ingest_ts") if k in stamps}, **given}
        return given

    rules = tuple(
        Rule(
            id=str(entry["id"]),
            dimension=str(entry["dimension"]).capitalize(),
            kind=str(entry["type"]),
            columns=columns(entry),
            params=params(entry),
            severity=str(entry.get("severity", "medium")),
            nulls_fail=bool(entry.get("nulls_fail", True)),
        )
        for entry in config.get("rules") or ()
    )
    weights = (config.get("scoring") or {}).get("weights") or {}
    slices: Sequence[Sequence[str]] = (config.get("dashboard") or {}).get("suggested_slices") or ()
    return RuleSet(
        rules=rules,
        weights={str(name).capitalize(): float(weight) for name, weight in weights.items()},
        slices=tuple(tuple(columns) for columns in slices),
        version=str(config.get("version", DEFAULT_VERSION)),
        primary_key=key,
        event_column=stamps.get("event_ts"),
        arrival_column=stamps.get("ingest_ts"),
    )


def load_config(spark: SparkSession, path: str, missing_ok: bool = False) -> Mapping[str, Any]:
    """Read a YAML rule file from any file system that Spark reads.

    An absent file raises; with ``missing_ok`` it means no overrides, which suits a
    ``Profile`` and never declared rules.
    """
    if not path_exists(spark, path):
        if missing_ok:
            return {}
        raise FileNotFoundError(f"Missing rule file: {path}")
    try:
        import yaml
    except ImportError as error:
        raise RuntimeError(f"reading {path} needs PyYAML") from error
    text = spark.read.text(path, wholetext=True).first()
    return (yaml.safe_load(text["value"]) if text else None) or {}
