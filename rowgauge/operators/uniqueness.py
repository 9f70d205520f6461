"""Exact duplicate detection that stays spread out under hot keys."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.values import named, nan_to_null, type_of



def hot_share(df: DataFrame) -> int:
    """A key is hot when it holds more than its part, a shuffle partition's, of all rows.

    So fewer keys than partitions can be hot however large the table is, and
    no other key fills a task of the join.
    """
    return max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def key_values(df: DataFrame, keys: Sequence[str]) -> list[Column]:
    """The key columns; NaN and null are the same missing key."""
    return [nan_to_null(named(k), type_of(df, k)) for k in keys]


def key_columns(df: DataFrame, keys: Sequence[str]) -> list[Column]:
    """The key columns as ``_k0.._kn``."""
    return [value.alias(f"_k{i}") for i, value in enumerate(key_values(df, keys))]


def any_null(names: Sequence[str]) -> Column:
    """A key column is null, as it is for NaN too."""
    return reduce(or_, [F.col(n).isNull() for n in names])


def key_counts(
    df: DataFrame, keys: Sequence[str], by: Sequence[str], row_id: str, excuse_nulls: bool = False
) -> DataFrame:
    """Rows per key and the first row of each key; keys with a null are left out if excused.

    Partial aggregation shuffles one narrow row per key and task, so neither a
    hot key nor a mass of null keys loads a single task.
    """
    names = [f"_k{i}" for i in range(len(keys))]
    rows = df.select(*[named(b) for b in by], *key_columns(df, keys), named(row_id).alias("_row"))
    return (
        (rows.where(~any_null(names)) if excuse_nulls else rows)
        .groupBy(*by, *names)
        .agg(F.count(F.lit(1)).alias("_n"), F.min("_row").alias("_first"))
    )


def mark_keys(
    rows: DataFrame, names: Sequence[str], hot: DataFrame, cold: DataFrame, row_id: str, flag: str
) -> DataFrame:
    """Add ``flag``: whether the row's key, in the columns ``names``, is a marked one.

    ``hot`` holds all hot keys, fewer than there are partitions, with the boolean ``_mark``;
    ``cold`` the other marked keys with their row count ``_n``. The rows of hot
    keys get their flag from a broadcast and then travel under a slot of their
    own instead of their key, so only keys of bounded size meet in the join. No
    group is held in memory and no row is read twice. Null equals null.
    """
    hot = hot.select(*[F.col(n).alias(f"_h{n}") for n in names], F.col("_mark").alias("_hot"))
    on_hot = [F.col(n).eqNullSafe(F.col(f"_h{n}")) for n in names]
    rows = rows.join(F.broadcast(hot), on_hot, "left").drop(*[f"_h{n}" for n in names])

    # several slots for each partition, so that the hot rows fill them evenly
    slot = F.pmod(F.xxhash64(named(row_id)), F.lit(8 * hot_share(rows))) + 1
    rows = rows.withColumn("_slot", F.when(F.col("_hot").isNotNull(), slot).otherwise(F.lit(0).cast("bigint")))
    # every cold key has slot 0; written as an expression on the count so that
    # the optimizer keeps the slot among the join keys
    cold = cold.select(*[F.col(n).alias(f"_c{n}") for n in names], F.least("_n", F.lit(0)).alias("_cslot"))
    on_cold = [F.col(n).eqNullSafe(F.col(f"_c{n}")) for n in names]
    on_cold.append(F.col("_slot") == F.col("_cslot"))
    return (
        rows.join(cold, on_cold, "left")
        .withColumn(flag, F.coalesce(F.col("_hot"), F.col("_cslot").isNotNull()))
        .drop(*[f"_c{n}" for n in names], "_cslot", "_slot", "_hot")
    )


def is_hot(counts: DataFrame) -> Column:
    """Whether a key of ``counts`` holds more than its share of all rows."""
    n = F.col("_n")
    if "_first" in counts.columns:
        # always true; reading the first row too makes this aggregation the same as the other uses'
        n = F.when(F.col("_first").isNotNull() | (n > 0), n)
    return F.col("_n") * hot_share(counts) > counts.agg(F.sum(n)).scalar()


def flag_duplicates(
    df: DataFrame, keys: Sequence[str], row_id: str, flag: str, excused: Sequence[str] = ()
) -> DataFrame:
    """Add the boolean column ``flag``: the row's key occurs more than once; null keys equal each other.

    Rows with a null in a key column named in ``excused`` are not repeated.
    """
    names = [f"_k{i}" for i in range(len(keys))]
    rows = df.withColumns(dict(zip(names, key_columns(df, keys))))
    counts = rows.groupBy(*names).agg(F.count(F.lit(1)).alias("_n"))
    repeated = counts.where(F.col("_n") > 1)
    if excused:
        repeated = repeated.where(~any_null([f"_k{i}" for i, k in enumerate(keys) if k in excused]))
    hot = repeated.where(is_hot(counts)).withColumn("_mark", F.lit(True))
    return mark_keys(rows, names, hot, repeated.where(~is_hot(counts)), row_id, flag).drop(*names)
