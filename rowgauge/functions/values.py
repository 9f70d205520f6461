"""Column expressions that clean, coerce and test single values."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Field texts that a CSV scan reads as null.
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# The Unicode white space that stripping removes.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

ASCII_WHITE_SPACE = "".join(c for c in WHITE_SPACE if c.isascii())

_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_FRACTIONAL = (T.FloatType, T.DoubleType)


def named(name: str) -> Column:
    """The column called ``name``, whatever characters the name has."""
    return F.col("`" + name.replace("`", "``") + "`")


def type_of(df: DataFrame, name: str) -> T.DataType:
    return df.schema[name].dataType


def strip(value: Column) -> Column:
    """Remove white space around a text; null stays null.

    Trimming tries every character of its set, so plain ASCII texts, which have
    as many bytes as characters, are only tried against ASCII white space.
    """
    ascii_only = F.octet_length(value) == F.length(value)
    return F.when(ascii_only, F.trim(value, F.lit(ASCII_WHITE_SPACE))).otherwise(
        F.trim(value, F.lit(WHITE_SPACE))
    )


def null_tokens(value: Column) -> Column:
    """Texts that stand for a missing value become null."""
    return F.when(~value.isin(*NA_TOKENS), value)


def nan_to_null(value: Column, dtype: T.DataType) -> Column:
    return F.when(~F.isnan(value), value) if isinstance(dtype, _FRACTIONAL) else value


def to_number(value: Column, dtype: T.DataType) -> Column:
    """A double, or null where the value is not a number.

    A cast alone would accept Java's ``1d``, ``1f`` and hexadecimal notation.
    """
    if isinstance(dtype, T.StringType):
        java_only = [value.contains(letter) for letter in ("d", "D", "x", "X")]
        single = value.contains("f") | value.contains("F")
        infinite = value.contains("n") | value.contains("N")
        plain = ~reduce(or_, java_only, single & ~infinite)
        return F.when(plain, F.nanvl(value.try_cast("double"), F.lit(None).cast("double")))
    if isinstance(dtype, _FRACTIONAL):
        return nan_to_null(value.cast("double"), T.DoubleType())
    if isinstance(dtype, (*_INTEGRAL, T.DecimalType, T.BooleanType)):
        return value.cast("double")
    return F.lit(None).cast("double")


def to_utc(value: Column, dtype: T.DataType, fmt: str | None = None) -> Column:
    """A timestamp, or null where the value cannot be read as one.

    Text is read per value: ISO by default, or the given format. Numbers are
    nanoseconds since the epoch. Values without a zone are UTC.
    """
    if isinstance(dtype, T.TimestampType):
        return value
    if isinstance(dtype, (T.TimestampNTZType, T.DateType)):
        return value.cast("timestamp")
    if isinstance(dtype, T.StringType):
        if fmt is not None:
            return F.try_to_timestamp(value, F.lit(fmt))
        # a bare clock time would be completed with today's date
        text = strip(value)
        dash, colon = F.instr(text, "-"), F.instr(text, ":")
        dated = (colon == 0) | ((dash > 0) & (dash < colon))
        return F.when(dated, F.try_to_timestamp(text))
    if isinstance(dtype, (*_INTEGRAL, *_FRACTIONAL, T.DecimalType)):
        nanos = value.try_cast("bigint")
        return F.timestamp_micros(F.call_function("div", nanos - F.pmod(nanos, F.lit(1000)), F.lit(1000)))
    return F.lit(None).cast("timestamp")


def matches(value: Column, pattern: str, ignore_case: bool = False) -> Column:
    """Whether the pattern matches from the start of the text; null does not match.

    Flags: Unicode classes, and only a line feed counts as a line end.
    """
    flags = "Udi" if ignore_case else "Ud"
    return F.coalesce(value.rlike(f"(?{flags})^(?:{pattern})"), F.lit(False))


def is_missing(df: DataFrame, name: str) -> Column:
    """Null, NaN, or a text of length zero; an absent column is missing everywhere."""
    if name not in df.columns:
        return F.lit(True)
    value, dtype = named(name), type_of(df, name)
    # one reference to the value: a filter repeats whatever computes it
    if isinstance(dtype, T.StringType):
        return F.coalesce(value, F.lit("")) == ""
    if isinstance(dtype, _FRACTIONAL):
        return F.isnan(F.coalesce(value, F.lit(float("nan"))))
    return value.isNull()


def delay_minutes(event: Column, arrival: Column) -> Column:
    """Minutes from event to arrival, with fractions."""
    return (F.unix_micros(arrival) - F.unix_micros(event)) / F.lit(60e6)


def iso_text(stamp: Column) -> Column:
    """ISO-8601 with offset; fractional seconds only where there are any."""
    whole = F.date_format(stamp, "yyyy-MM-dd'T'HH:mm:ssxxx")
    fraction = F.date_format(stamp, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx")
    return F.when(F.pmod(F.unix_micros(stamp), F.lit(1_000_000)) == 0, whole).otherwise(fraction)


def sample_value(value: Column, dtype: T.DataType) -> Column:
    """What a sample of this column needs, cheaply: its text, its time, and whether JSON quotes it.

    Sampling looks at many more rows than it keeps, so ``json_scalar`` formats
    the kept ones only.
    """
    timed = isinstance(dtype, (T.TimestampType, T.TimestampNTZType))
    bare = isinstance(dtype, (*_INTEGRAL, *_FRACTIONAL, T.DecimalType, T.BooleanType))
    text = value
    if isinstance(dtype, _FRACTIONAL):
        text = F.when(~F.isnan(value) & (F.abs(value) != F.lit(float("inf"))), value)
    return F.struct(
        F.lit(None).cast("string").alias("text") if timed else text.cast("string").alias("text"),
        value.cast("timestamp").alias("time") if timed else F.lit(None).cast("timestamp").alias("time"),
        F.lit(bare).alias("bare"),
    )


def json_scalar(sample: Column) -> Column:
    """A ``sample_value`` as one JSON item: numbers and booleans bare, the rest quoted, missing null."""
    text = F.coalesce(sample["text"], iso_text(sample["time"]))
    boxed = F.to_json(F.array(text))
    quoted = boxed.substr(F.lit(2), F.length(boxed) - 2)
    return F.when(text.isNull(), "null").when(sample["bare"], text).otherwise(quoted)


def round_score(value: Column) -> Column:
    """Two decimals: scale, round half to even, scale back."""
    return F.rint(value * 100) / 100


def _round_exact(value: Column, tie: Column) -> Column:
    """Two decimals of the exact binary value; ``tie`` is where a true half goes, in hundredths.

    Scaling rounds too. Where it lands on a half, the rounding error, which
    splitting the factor makes exact, tells on which side the value really is.
    """
    scaled = value * 100
    high = value * 134_217_729.0 - (value * 134_217_729.0 - value)
    error = (high * 100 - scaled) + (value - high) * 100
    whole = F.floor(scaled)
    sided = F.when(error > 0, whole + 1).when(error < 0, whole).otherwise(tie)
    return F.when(scaled - whole == 0.5, sided).otherwise(F.rint(scaled)) / 100


def round_share(value: Column) -> Column:
    """Two decimals of the exact binary value, half to even."""
    return _round_exact(value, F.rint(value * 100))


def round_up_share(value: Column) -> Column:
    """Two decimals of the exact binary value, half away from zero, as shown texts have it."""
    number = value.cast("double")
    # beyond this no double has hundredths
    small = F.abs(number) < 1e13
    up = F.when(number < 0, F.floor(number * 100)).otherwise(F.ceil(number * 100))
    return F.when(small, _round_exact(number, up)).otherwise(number)
