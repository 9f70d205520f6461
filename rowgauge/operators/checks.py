"""Checks: row predicates and key rules, compiled to Column expressions."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from decimal import Decimal, InvalidOperation
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.values import (
    delay_minutes,
    is_missing,
    matches,
    named,
    sample_value,
    to_number,
    to_utc,
    type_of,
)
from ..model import Profile, Rule
from .normalize import arrival_name, event_name


@dataclass(frozen=True, eq=False)
class Check:
    """One check of a table.

    ``failed`` is a non-null boolean Column; ``keys`` is set instead for a
    uniqueness check, which no single row can decide. ``sample`` is the
    ``sample_value`` of the reported column, or None if the table lacks it.
    ``zero_score`` marks a check whose inputs are absent and whose dimension
    therefore scores 0. ``excuse_nulls``: null keys of a uniqueness check pass.
    """

    dimension: str
    rule: str
    column: str
    failed: Column | None = None
    keys: tuple[str, ...] = ()
    sample: Column | None = None
    severity: str | None = None
    zero_score: bool = False
    excuse_nulls: bool = False


def balanced(values: Sequence[Column], join: Callable[[Column, Column], Column]) -> Column:
    """All values joined as a tree of little depth, which planning walks often."""
    level = list(values)
    while len(level) > 1:
        level = [join(*level[i : i + 2]) if i + 1 < len(level) else level[i] for i in range(0, len(level), 2)]
    return level[0]


def any_of(flags: Sequence[Column]) -> Column:
    return balanced(flags, or_) if flags else F.lit(False)


def missing_required(df: DataFrame, required: Sequence[str]) -> Column:
    """A required column is missing in this row."""
    if any(name not in df.columns for name in required):
        return F.lit(True)
    return any_of([is_missing(df, name) for name in required])


def below_minimum(df: DataFrame, name: str, minimum: float) -> Column:
    """The value is no number or lies under the bound."""
    number = to_number(named(name), type_of(df, name))
    return F.coalesce(number < F.lit(float(minimum)), F.lit(True))


def bad_pattern(df: DataFrame, name: str, pattern: str, ignore_case: bool = False) -> Column:
    """The text is null or does not match from its start."""
    return ~matches(named(name).cast("string"), pattern, ignore_case)


def bad_delay(df: DataFrame, event: str, arrival: str, max_minutes: float) -> Column:
    """A time is missing, or the arrival is early or later than allowed."""
    delay = delay_minutes(
        to_utc(named(event), type_of(df, event)), to_utc(named(arrival), type_of(df, arrival))
    )
    return F.coalesce((delay < 0) | (delay > F.lit(float(max_minutes))), F.lit(True))


def _sample(df: DataFrame, name: str) -> Column | None:
    return sample_value(named(name), type_of(df, name)) if name in df.columns else None


def standard_checks(df: DataFrame, profile: Profile) -> list[Check]:
    """The five checks of the standard assessment, in report order.

    ``df`` is normalised. A column the table lacks fails no row, except that a
    missing required column fails every row and missing times score 0.
    """
    columns = set(df.columns)
    event, arrival = event_name(df, profile), arrival_name(df, profile)
    timed = event in columns and arrival in columns
    nothing = F.lit(False)
    amount_bad = (
        below_minimum(df, profile.amount_column, profile.amount_min)
        if profile.amount_column in columns
        else nothing
    )
    email_bad = (
        bad_pattern(df, profile.email_column, profile.email_pattern)
        if profile.email_column in columns
        else nothing
    )
    unique = profile.primary_key in columns
    return [
        Check(
            "Completeness",
            "required_columns_present",
            "(required)",
            failed=missing_required(df, profile.required),
        ),
        Check(
            "Validity",
            f"min_amount:{profile.amount_min}",
            profile.amount_column,
            failed=amount_bad,
            sample=_sample(df, profile.amount_column),
        ),
        Check(
            "Validity",
            "email_format",
            profile.email_column,
            failed=email_bad,
            sample=_sample(df, profile.email_column),
        ),
        Check(
            "Uniqueness",
            f"primary_key:{profile.primary_key}",
            profile.primary_key,
            failed=None if unique else nothing,
            keys=(profile.primary_key,) if unique else (),
            sample=_sample(df, profile.primary_key),
        ),
        Check(
            "Timeliness",
            f"max_delay_minutes:{profile.max_delay_minutes}",
            arrival,
            failed=bad_delay(df, event, arrival, profile.max_delay_minutes) if timed else nothing,
            sample=_sample(df, arrival),
            zero_score=not timed,
        ),
    ]


def _excuse_nulls(rule: Rule, df: DataFrame, name: str, failed: Column) -> Column:
    return failed if rule.nulls_fail else failed & ~is_missing(df, name)


def as_type(value: object, kind: T.DataType) -> Column | None:
    """An allowed value in the column's type; None if it can't be read as such, and so never matches."""
    if isinstance(kind, T.StringType):
        return F.lit(str(value).lower() if isinstance(value, bool) else str(value))
    if isinstance(kind, T.BooleanType):
        words = {"true": True, "false": False}
        known = value if isinstance(value, bool) else words.get(str(value).strip().lower())
        return None if known is None else F.lit(known)
    if isinstance(kind, T.NumericType):
        if isinstance(value, bool):
            return None
        try:
            number = Decimal(str(value).strip())
        except InvalidOperation:
            return None
        if isinstance(kind, (T.FloatType, T.DoubleType)):
            return F.lit(float(number)).cast(kind)
        return F.lit(number) if number.is_finite() and len(number.as_tuple().digits) <= 38 else None
    return F.lit(str(value)).try_cast(kind)


def rule_failed(df: DataFrame, rule: Rule) -> Column:
    """The row predicate of a declared rule other than ``unique``."""
    params = rule.params
    if rule.kind == "max_lag_hours":
        event, arrival = params["event_ts"], params["ingest_ts"]
        if event not in df.columns or arrival not in df.columns:
            return F.lit(False)
        late = bad_delay(df, event, arrival, float(params["max_hours"]) * 60)
        if rule.nulls_fail:
            return late
        return late & ~is_missing(df, event) & ~is_missing(df, arrival)
    if rule.kind == "not_null":
        return missing_required(df, rule.columns)
    (name,) = rule.columns
    if name not in df.columns:
        return F.lit(False)
    value = named(name)
    if rule.kind == "in_set":
        allowed = [v for v in (as_type(x, type_of(df, name)) for x in params["allowed"]) if v is not None]
        failed = ~F.coalesce(value.isin(*allowed), F.lit(False)) if allowed else F.lit(True)
    elif rule.kind == "regex":
        failed = bad_pattern(df, name, params["pattern"], "I" in params.get("flags", ""))
    else:
        number = to_number(value, type_of(df, name))
        inside = number.isNotNull()
        if params.get("min") is not None:
            inside = inside & (number >= F.lit(float(params["min"])))
        if params.get("max") is not None:
            inside = inside & (number <= F.lit(float(params["max"])))
        failed = ~F.coalesce(inside, F.lit(False))
    return _excuse_nulls(rule, df, name, failed)


def rule_check(df: DataFrame, rule: Rule) -> Check:
    """Compile one declared rule against the columns of a table."""
    if rule.kind == "max_lag_hours":
        column = rule.params["ingest_ts"]
        timed = column in df.columns and rule.params["event_ts"] in df.columns
    else:
        column = rule.columns[0] if len(rule.columns) == 1 else "(" + ", ".join(rule.columns) + ")"
        timed = True
    keyed = rule.kind == "unique" and all(name in df.columns for name in rule.columns)
    if rule.kind == "unique":
        failed = None if keyed else F.lit(False)
    else:
        failed = rule_failed(df, rule)
    return Check(
        rule.dimension,
        rule.id,
        column,
        failed=failed,
        keys=rule.columns if keyed else (),
        sample=_sample(df, column),
        severity=rule.severity,
        zero_score=not timed,
        excuse_nulls=not rule.nulls_fail,
    )
