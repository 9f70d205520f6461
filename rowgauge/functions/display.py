"""Column expressions that turn scores and samples into report text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .values import round_up_share, strip

# Status bounds and texts.
GOOD_FROM = 95
OK_FROM = 85


def number_or(value: Column, fallback: float | None) -> Column:
    """The value as a finite double; null counts as 0, anything unreadable is the fallback."""
    number = value.try_cast("double")
    finite = number.isNotNull() & ~F.isnan(number) & (F.abs(number) != F.lit(float("inf")))
    return (
        F.when(value.isNull(), F.lit(0.0))
        .when(finite, number)
        .otherwise(F.lit(fallback).cast("double"))
    )


def fmt_pct(value: Column) -> Column:
    shown = value.isNotNull() & ~F.isnan(value)
    return F.when(shown, F.format_string("%.2f%%", round_up_share(value))).otherwise("N/A")


def fmt_delta(value: Column) -> Column:
    return F.when(value.isNotNull(), F.format_string("%+.2f pp", round_up_share(value))).otherwise("N/A")


def status(overall: Column) -> Column:
    score = number_or(overall, 0.0)
    return F.when(score >= GOOD_FROM, "GOOD").when(score >= OK_FROM, "OK").otherwise("RISK")


def sample_text(samples: Column) -> Column:
    """Flatten a JSON sample list: items joined by a comma, missing and empty ones left out.

    A JSON scalar shows as its text, and anything that is not JSON as it stands.
    """
    text = strip(samples)
    items = F.from_json(text, "array<string>")
    listed = F.array_join(F.filter(items, lambda item: item != ""), ", ")
    quoted = F.from_json(F.concat(F.lit("["), text, F.lit("]")), "array<string>")
    scalar = F.when(text.startswith('"') & (F.size(quoted) == 1), F.get(quoted, F.lit(0)))
    return F.coalesce(listed, scalar, text, F.lit(""))


def run_id_text(run_ts: Column) -> Column:
    return F.date_format(run_ts, "yyyyMMdd_HHmmss")


def run_ts_text(run_ts: Column) -> Column:
    return F.date_format(run_ts, "yyyy-MM-dd'T'HH:mm:ssxxx")


def zulu_text(stamp: Column) -> Column:
    return F.date_format(stamp, "yyyy-MM-dd'T'HH:mm:ss'Z'")
