"""Dataset scans and sinks."""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.values import named, null_tokens, to_number, to_utc
from ..session import readable

# Quotes are doubled inside quoted fields, and blanks around values are data.
_CSV = {
    "header": "true",
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def typed(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project text columns to the types of ``schema``; unreadable values become null.

    Columns the table lacks are left out, columns the schema lacks stay text.
    """

    def read(field: T.StructField):
        value = named(field.name)
        if isinstance(field.dataType, T.StringType):
            return value
        if isinstance(field.dataType, T.TimestampType):
            return to_utc(value, T.StringType())
        if isinstance(field.dataType, (T.FloatType, T.DoubleType)):
            return to_number(value, T.StringType()).cast(field.dataType)
        if isinstance(field.dataType, T.IntegralType):
            # whole numbers may be written as 10.0
            number = to_number(value, T.StringType())
            whole = F.when(number == F.floor(number), number.try_cast(field.dataType))
            return F.coalesce(value.try_cast(field.dataType), whole)
        return value.try_cast(field.dataType)

    return df.withColumns({f.name: read(f) for f in schema if f.name in df.columns})


# The column of a line as it stands in the file, where it doesn't fit its header.
MALFORMED = "_malformed"


def header_groups(spark: SparkSession, path: str | list[str]) -> list[tuple[str, list[str]]]:
    """The different header lines of CSV files, and the files under each."""
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("at"),
        "value",
        F.monotonically_increasing_id().alias("nth"),
    )
    heads = lines.where("at = 0").groupBy("file").agg(F.min_by("value", "nth").alias("head"))
    groups = heads.groupBy("head").agg(F.sort_array(F.collect_list("file")).alias("files")).orderBy("head")
    return [(g["head"], [unquote(f) for f in g["files"]]) for g in groups.collect()]  # paths alone


def _csv_lines(spark: SparkSession, files: str | list[str], multi_line: bool) -> DataFrame:
    """Files of one header as text columns and ``MALFORMED``."""
    options = {**_CSV, "multiLine": str(multi_line).lower(), "emptyValue": ""}
    names = spark.read.options(**options).csv(files).columns
    layout = T.StructType([T.StructField(c, T.StringType()) for c in [*names, MALFORMED]])
    return spark.read.schema(layout).options(**options, columnNameOfCorruptRecord=MALFORMED, mode="PERMISSIVE").csv(files)


def scan_csv_lines(spark: SparkSession, path: str | list[str], multi_line: bool = False) -> DataFrame:
    """All lines of CSV files as text by column name, whatever the order of the columns in each file.

    What a file lacks is null. ``MALFORMED`` is the line itself where it has more or
    fewer values than its header, else null.
    """
    groups = header_groups(spark, path)
    if len(groups) < 2:
        return _csv_lines(spark, path, multi_line)
    found = [_csv_lines(spark, files, multi_line) for _, files in groups]
    names = list(dict.fromkeys(c for part in found for c in part.columns if c != MALFORMED))
    table = found[0]
    for part in found[1:]:
        table = table.unionByName(part, allowMissingColumns=True)
    return table.select(*[named(c) for c in names], MALFORMED)


def scan_csv(
    spark: SparkSession, path: str | list[str], schema: T.StructType | None = None, multi_line: bool = False
) -> DataFrame:
    """Read CSV with a header as text, null out the missing-value texts, then apply types.

    Files of a folder are read by column name. A line too short ends in nulls, one too long loses what is beyond
    its header; ``scan_csv_checked`` tells them apart.
    ``multi_line`` allows line breaks inside quoted fields; such files cannot
    be split, so it is off by default.
    """
    return _texts(scan_csv_lines(spark, path, multi_line).drop(MALFORMED), schema)


def _texts(raw: DataFrame, schema: T.StructType | None) -> DataFrame:
    texts = raw.select(*[null_tokens(named(c)).alias(c) for c in raw.columns])
    return typed(texts, schema) if schema is not None else texts


def scan_csv_checked(
    spark: SparkSession, path: str | list[str], schema: T.StructType | None = None, multi_line: bool = False
) -> tuple[DataFrame, DataFrame]:
    """The lines that fit their header, read as ``scan_csv`` reads them, and the others as ``line``.

    Each line is in one of the two.
    """
    lines = scan_csv_lines(spark, path, multi_line)
    # always true: the parser counts a line's values only where it reads all of them
    whole = F.length(F.concat_ws("", *[named(c) for c in lines.columns])) >= 0
    fits = F.col(MALFORMED).isNull()
    rejects = lines.where(whole & ~fits).select(F.col(MALFORMED).alias("line"))
    return _texts(lines.where(whole & fits).drop(MALFORMED), schema), rejects


def scan(spark: SparkSession, path: str, fmt: str = "parquet", schema: T.StructType | None = None) -> DataFrame:
    """Read a dataset; formats with their own types keep them."""
    return scan_csv(spark, path, schema) if fmt == "csv" else spark.read.format(fmt).load(path)


def staged_path(spark: SparkSession, path: str, fallback: str | None = None) -> str:
    """The dataset's path, or the staged input where the dataset is absent or half-written."""
    for candidate in (path, fallback):
        if candidate is not None and readable(spark, candidate):
            return candidate
    raise FileNotFoundError(f"Missing required file: {path}")


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> None:
    writer = df.write.mode(mode)
    if fmt == "csv":
        writer = writer.options(**_CSV, emptyValue="")
    writer.format(fmt).save(path)


def write_json_object(df: DataFrame, path: str) -> None:
    """Overwrite a JSON object of one row, nulls kept."""
    df.coalesce(1).write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def records(df: DataFrame) -> DataFrame:
    """Every row as one JSON object, nulls kept."""
    return df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("record"))


def dataset_line(df: DataFrame | None, name: str = "clean.csv") -> str | DataFrame:
    """One row describing the table's shape, or a text if there is no table."""
    if df is None:
        return "Dataset not loaded."
    shape = df.agg(F.count(F.lit(1)).alias("rows")).withColumn("columns", F.lit(len(df.columns)))
    line = F.format_string(f"Dataset loaded: {name} (%d rows, %d columns).", "rows", "columns")
    return shape.withColumn("line", line)
