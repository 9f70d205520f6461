"""Which of the required outputs exist."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import committed
from .tables import scan


def manifest(spark: SparkSession, required: Mapping[str, tuple[str, str]]) -> DataFrame:
    """One row per required output, given as name -> (path, format), with its row count.

    An output is there once its writer has finished it; a half-written one is missing.
    """
    parts = []
    for name, (path, fmt) in required.items():
        entry = [F.lit(name).alias("name"), F.lit(path).alias("path")]
        if committed(spark, path):
            counted = scan(spark, path, fmt).agg(F.count(F.lit(1)).alias("row_count"))
            parts.append(counted.select(*entry, F.lit(True).alias("exists"), "row_count"))
        else:
            absent = [F.lit(False).alias("exists"), F.lit(None).cast("bigint").alias("row_count")]
            parts.append(spark.range(1).select(*entry, *absent))
    table = parts[0]
    for part in parts[1:]:
        table = table.unionByName(part)
    return table


def missing_outputs(table: DataFrame) -> DataFrame:
    return table.where(~F.col("exists")).select("name", "path")


def exit_code(table: DataFrame) -> int:
    """0 if every output exists, else 2."""
    return 0 if missing_outputs(table).isEmpty() else 2
