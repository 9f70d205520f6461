"""Intermediate tables of the operators, in the folder that the whole cluster shares."""

from __future__ import annotations

from pyspark.sql import DataFrame

from rowgauge.session import scratch_path


def settle(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: computed once, and safe when executors go."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
