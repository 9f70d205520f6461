"""Prefix folds and joins that no single key can pile up in one task."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: A key is hot if it has more than one in so many of all rows; there are fewer such keys than that.
HOT_PARTS = 1_000


def beside(rows: DataFrame, key: str, span: str, values: DataFrame) -> DataFrame:
    """``rows`` left-joined with ``values`` (unique in ``key``).

    ``span`` cuts the rows of a key into bounded runs. Values go to runs first, so that what
    meets in the join is one run's rows, however many rows the key has.
    """
    runs = rows.select(key, span).distinct().join(values, key, "left")
    return rows.join(runs, [key, span])


def before(rows: DataFrame, key: str, span: str, order: list[str], values: list[str], fold: Callable, both: Callable) -> DataFrame:
    """``rows`` with ``<value>_before``: the fold of a value over the rows of its key that come first (0 for none).

    ``span``, which grows with ``order``, cuts the rows of a key into bounded runs: runs are folded as wholes,
    rows within their run. ``both`` joins two folds. ``rows`` is read twice.
    """
    up_to = (Window.unboundedPreceding, -1)
    inside = Window.partitionBy(key, span).orderBy(*order).rowsBetween(*up_to)
    across = Window.partitionBy(key).orderBy(span).rowsBetween(*up_to)
    zero = F.lit(0).cast("long")
    runs = rows.groupBy(key, span).agg(*[fold(v).alias(v) for v in values])
    runs = runs.select(key, span, *[F.coalesce(fold(v).over(across), zero).alias(f"_runs_{v}") for v in values])
    own = rows.select("*", *[F.coalesce(fold(v).over(inside), zero).alias(f"_own_{v}") for v in values])
    found = own.join(runs, [key, span])
    return found.select(*rows.columns, *[both(F.col(f"_own_{v}"), F.col(f"_runs_{v}")).alias(f"{v}_before") for v in values])


def join_counted(rows: DataFrame, sides: DataFrame, on: Column, times: str, total: int) -> DataFrame:
    """``rows`` left-joined with ``sides``, whose row meets ``times`` of the ``total`` rows.

    Sides that meet more than one in ``HOT_PARTS`` rows are fewer than ``HOT_PARTS`` and are broadcast; of
    the others each meets a bounded part. ``on`` names columns of both, which must not clash; every row meets one
    side at most.
    """
    hot = F.col(times) * HOT_PARTS > total
    first = rows.join(F.broadcast(sides.where(hot)), on, "left")
    met = first.where(F.col(times).isNotNull())
    rest = first.where(F.col(times).isNull()).select(*rows.columns).join(sides.where(~hot), on, "left")
    return met.unionByName(rest)
