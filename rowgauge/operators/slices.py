"""Scores per slice of a table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..model import DIMENSIONS
from .checks import Check, any_of
from .scoring import any_name, attach_flags, with_scores


def score_by_slice(
    df: DataFrame,
    checks: Sequence[Check],
    slices: Sequence[Sequence[str]],
    row_id: str,
    weights: Mapping[str, float] | None = None,
) -> DataFrame:
    """Dimension scores for every value of every slice, in one pass.

    Flags are those of the whole table: a duplicate in another slice counts.
    Rows are first counted by all slice columns together, and only these counts
    are expanded into the grouping sets. Slice columns the table lacks are left
    out, and a slice with none left is skipped.
    """
    present = [tuple(c for c in s if c in df.columns) for s in slices]
    present = [s for s in dict.fromkeys(present) if s]
    columns = list(dict.fromkeys(c for s in present for c in s))
    df, checks = attach_flags(df, checks, row_id, keep=columns)
    tallies = [F.count(F.lit(1)).alias("rows")]
    for dimension in DIMENSIONS:
        flags = [c.failed for c in checks if c.dimension == dimension]
        tallies.append(F.count_if(any_of(flags)).alias(any_name(dimension)))
    finest = df.groupBy(*columns).agg(*tallies)
    names = ["rows", *[any_name(d) for d in DIMENSIONS]]
    # the position of each slice's columns in the grouping bitmap, first column highest
    masks = {
        sum(1 << (len(columns) - 1 - i) for i, c in enumerate(columns) if c not in s): ",".join(s)
        for s in present
    }
    label = F.lit(None).cast("string")
    for mask, text in masks.items():
        label = F.when(F.col("_grouping") == mask, text).otherwise(label)
    sets = finest.groupingSets([[F.col(c) for c in s] for s in present], *[F.col(c) for c in columns]).agg(
        F.grouping_id().alias("_grouping"), *[F.sum(n).alias(n) for n in names]
    )
    scored = with_scores(sets.withColumn("slice", label), checks, weights)
    return scored.select("slice", *columns, *[c for c in scored.columns if c == "rows" or c.endswith("_pct")])
