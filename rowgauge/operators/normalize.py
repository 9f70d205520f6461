"""Bring a raw table into the shape the checks expect."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.values import named, strip, to_utc, type_of
from ..model import Profile


GENERATED_ROW_ID = "_row_id"


def event_name(df: DataFrame, profile: Profile) -> str:
    """The event time column: the canonical name, else its alias."""
    return profile.event_column if profile.event_column in df.columns else profile.event_alias


def arrival_name(df: DataFrame, profile: Profile) -> str:
    """The arrival time column: the canonical name, else its alias."""
    return profile.arrival_column if profile.arrival_column in df.columns else profile.arrival_alias


def strip_text(df: DataFrame, names: tuple[str, ...]) -> DataFrame:
    """Strip the listed text columns; names the table lacks are skipped."""
    present = [n for n in names if n in df.columns and isinstance(type_of(df, n), T.StringType)]
    return df.withColumns({n: strip(named(n)) for n in present})


def coerce_timestamps(df: DataFrame, names: tuple[str, ...], fmt: str | None = None) -> DataFrame:
    """Turn the listed columns into UTC timestamps; names the table lacks are skipped."""
    present = [n for n in names if n in df.columns]
    return df.withColumns({n: to_utc(named(n), type_of(df, n), fmt) for n in present})


def canonical_names(df: DataFrame, profile: Profile) -> DataFrame:
    """Rename the alias time columns to their canonical names."""
    renames = {
        event_name(df, profile): profile.event_column,
        arrival_name(df, profile): profile.arrival_column,
    }
    return df.withColumnsRenamed({old: new for old, new in renames.items() if old in df.columns})


def normalize(df: DataFrame, profile: Profile, resolve_aliases: bool = False) -> DataFrame:
    """Strip text and read timestamps.

    With ``resolve_aliases`` the alias time columns take their canonical names
    before the checks, so that a table using them can pass completeness.
    """
    if resolve_aliases:
        df = canonical_names(df, profile)
    df = strip_text(df, profile.strip_columns)
    return coerce_timestamps(df, (event_name(df, profile), arrival_name(df, profile)))


def with_row_id(df: DataFrame, row_id: str | None) -> tuple[DataFrame, str]:
    """Give rows an order for samples.

    A generated id follows the scan order and may differ between two readings
    of the input, so it orders samples but bounds nothing; a caller with a real
    row number should name it.
    """
    if row_id is not None:
        return df, row_id
    return df.withColumn(GENERATED_ROW_ID, F.monotonically_increasing_id()), GENERATED_ROW_ID
