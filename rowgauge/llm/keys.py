"""Keys of rows that may lack an id or a text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def row_key(id_col: Column, text: Column) -> Column:
    """A digest of id and text; rows have the same only if both are the same. Null differs from every value, the empty text too."""
    name = id_col.cast("string")
    told = F.coalesce(F.concat(F.length(name).cast("string"), F.lit(":"), name), F.lit("-"))
    return F.unhex(F.md5(F.concat(told, F.coalesce(F.concat(F.lit("="), text), F.lit("-")))))
