"""Python over Arrow batches: the package on its way to the tasks, and slices that hold little text."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

_SENT: set[str] = set()


def map_batches(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: T.StructType | str) -> DataFrame:
    """``df.mapInArrow``, with this package sent to the executors first, which need not have it installed."""
    context = df.sparkSession.sparkContext
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    if context.applicationId not in _SENT and os.path.isdir(package):
        archive = os.path.join(tempfile.mkdtemp(), "rowgauge.zip")
        with zipfile.ZipFile(archive, "w") as out:
            for folder, _, names in os.walk(package):
                for name in sorted(n for n in names if n.endswith(".py")):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.relpath(path, os.path.dirname(package)))
        context.addPyFile(archive)  # the driver serves it
        _SENT.add(context.applicationId)
    return df.mapInArrow(run, schema)

#: A slice ends once it holds so many bytes; a longer text is a slice of its own.
SLICE_BYTES = 2_000_000


def text_slices(
    batches: Iterator[pa.RecordBatch], column: int, limit: int = SLICE_BYTES
) -> Iterator[tuple[pa.RecordBatch, list[str | None]]]:
    """Runs of rows with about ``limit`` bytes of text, and their texts."""
    for batch in batches:
        if not batch.num_rows:
            continue
        size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        till = np.cumsum(size.astype(np.int64))
        first = 0
        while first < len(till):
            before = till[first - 1] if first else 0
            last = max(first + 1, int(np.searchsorted(till, before + limit, "right")))
            part = batch.slice(first, last - first)
            yield part, part.column(column).to_pylist()
            first = last
