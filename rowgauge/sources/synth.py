"""Synthetic orders with a known number of defects."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Value domains and defects.
COUNTRIES = ("CA", "US", "GB", "DE", "FR", "NL", "SE", "TR")
DEFAULT_ROWS = 522
DEFAULT_SEED = 42
AMOUNT_CENTS = (500, 95_000)
BAD_AMOUNT_CENTS = (1_000, 90_000)
MAX_AGE_DAYS = 35
MAX_AGE_MINUTES = 1440
MAX_DELAY_MINUTES = 240
LATE_MINUTES = 900
REPEATED_IDS = (10, 20, 30)
REPEAT_FROM_ROWS = 30
BAD_EMAIL = "invalid-email"

_PRIME = 2_147_483_647


def draw(row: Column, seed: int, field: int, size: int) -> Column:
    """A whole number in [0, size), fixed by row, seed and field.

    Integer arithmetic modulo a prime: the same on any partitioning.
    """
    prime = F.lit(_PRIME).cast("bigint")
    start = F.pmod(row * 48_271 + (seed * 69_621 + field * 40_692) % _PRIME, prime)
    mixed = F.pmod(start * start + 16_807, prime)
    return F.pmod(F.pmod(mixed * mixed + start, prime), F.lit(size).cast("bigint"))


def _between(row: Column, seed: int, field: int, bounds: tuple[int, int]) -> Column:
    low, high = bounds
    return draw(row, seed, field, high - low + 1) + low


def _plus_minutes(stamp: Column, minutes: Column) -> Column:
    return F.timestamp_micros(F.unix_micros(stamp) + minutes.cast("bigint") * 60_000_000)


def clean_orders(rows: DataFrame, now: datetime | str, seed: int = DEFAULT_SEED) -> DataFrame:
    """One faultless order per row number in the column ``row_id`` (1, 2, ...)."""
    row = F.col("row_id")
    age = draw(row, seed, 4, MAX_AGE_DAYS + 1) * 1440 + draw(row, seed, 5, MAX_AGE_MINUTES + 1)
    countries = F.array(*[F.lit(c) for c in COUNTRIES])
    user = F.concat(
        F.lit("user"), draw(row, seed, 1, 1_000_000).cast("string"), F.lit("."), row.cast("string")
    )
    return rows.select(
        row,
        row.alias("order_id"),
        F.concat(user, F.lit("@example.org")).alias("email"),
        F.get(countries, draw(row, seed, 2, len(COUNTRIES)).cast("int")).alias("country"),
        (_between(row, seed, 3, AMOUNT_CENTS) / 100).alias("amount"),
        _plus_minutes(F.lit(str(now)).cast("timestamp"), -age).alias("order_ts_utc"),
    ).withColumn(
        "ingest_ts_utc", _plus_minutes(F.col("order_ts_utc"), draw(row, seed, 6, MAX_DELAY_MINUTES + 1))
    )


def _pick(orders: DataFrame, seed: int, field: int, count: int, kind: str) -> DataFrame:
    """The ``count`` rows that come first in a seeded order, numbered from 0."""
    order = F.struct(draw(F.col("row_id"), seed, field, _PRIME).alias("at"), F.col("row_id"))
    first = orders.select(order.alias("o")).orderBy("o").limit(count)
    return (
        first.agg(F.array_sort(F.collect_list("o")).alias("os"))
        .select(F.posexplode(F.transform("os", lambda o: o["row_id"])).alias("pos", "_row"))
        .select("_row", F.lit(kind).alias("kind"), "pos")
    )


def inject_defects(orders: DataFrame, seed: int = DEFAULT_SEED) -> DataFrame:
    """The baseline defects, as many as the table has rows for.

    Six distinct rows get three missing arrivals, a bad email, a negative
    amount and a blank country. The last three rows repeat earlier ids. Up to
    three rows arrive late, where they have an arrival.
    """
    row = F.col("row_id")
    last = orders.select("row_id").orderBy(F.desc("row_id")).limit(len(REPEATED_IDS))
    enough = orders.agg(F.count(F.lit(1)) >= REPEAT_FROM_ROWS).scalar()
    repeats = (
        last.where(enough)
        .agg(F.array_sort(F.collect_list("row_id")).alias("ids"))
        .select(F.posexplode("ids").alias("pos", "_row"))
        .select("_row", F.lit("repeat").alias("kind"), "pos")
    )
    picks = _pick(orders, seed, 7, 6, "bad").unionByName(_pick(orders, seed, 8, 3, "late")).unionByName(repeats)
    marks = picks.groupBy("_row").agg(
        *[F.max(F.when(F.col("kind") == kind, F.col("pos"))).alias(f"_{kind}") for kind in ("bad", "late", "repeat")]
    )
    bad_amount = -(_between(row, seed, 9, BAD_AMOUNT_CENTS) / 100)
    no_arrival = F.coalesce(F.col("_bad") < 3, F.lit(False))
    repeated = F.get(F.array(*[F.lit(i).cast("bigint") for i in REPEATED_IDS]), F.col("_repeat"))
    # at most twelve marked rows
    marked = orders.join(F.broadcast(marks), row == F.col("_row"), "left")
    return marked.select(
        row,
        F.coalesce(repeated, F.col("order_id")).alias("order_id"),
        F.when(F.col("_bad") == 3, BAD_EMAIL).otherwise(F.col("email")).alias("email"),
        F.when(F.col("_bad") == 5, "").otherwise(F.col("country")).alias("country"),
        F.when(F.col("_bad") == 4, bad_amount).otherwise(F.col("amount")).alias("amount"),
        "order_ts_utc",
        F.when(no_arrival, F.lit(None))
        .when(F.col("_late").isNotNull(), _plus_minutes(F.col("order_ts_utc"), F.lit(LATE_MINUTES)))
        .otherwise(F.col("ingest_ts_utc"))
        .alias("ingest_ts_utc"),
    )


def resolve_scenario(scenario: str | None, history_exists: bool) -> str:
    """``auto`` improves once a history exists; any other text but ``improved`` is the baseline."""
    wanted = (scenario or "auto").strip().lower()
    if wanted == "auto":
        return "improved" if history_exists else "baseline"
    return "improved" if wanted == "improved" else "baseline"


def synth_orders(
    spark: SparkSession,
    now: datetime | str,
    rows: int = DEFAULT_ROWS,
    seed: int = DEFAULT_SEED,
    scenario: str = "baseline",
) -> DataFrame:
    """``rows`` synthetic orders; ``row_id`` keeps their order."""
    numbers = spark.range(1, rows + 1).withColumnRenamed("id", "row_id")
    orders = clean_orders(numbers, now, seed)
    return inject_defects(orders, seed) if scenario == "baseline" else orders
