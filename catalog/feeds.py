"""The order feed the registered queries assess, derived from the given tables.

Orders joined with customer and nation, with defects placed by arithmetic on
the order key, so that every check has something to find at any scale.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rowgauge import Assessment, assess_runs, compile_rules
from rowgauge.model import RuleSet
from rowgauge.session import scratch_path
from rowgauge.sources.history import append_issues, append_summary, read_issues, read_summary

RUN_TS = "2024-03-01T06:30:00+00:00"


def prepare(spark: SparkSession) -> SparkSession:
    """The session of the registered queries keeps time in UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    customer = table(spark, sf_dir, "customer")
    nation = table(spark, sf_dir, "nation")
    joined = orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).join(
        nation, F.col("c_nationkey") == F.col("n_nationkey")
    )
    k = F.col("o_orderkey")

    def every(n: int, at: int = 0):
        return F.pmod(k, F.lit(n)) == at

    def minutes(n: int):
        return F.col("o_orderdate") + F.make_dt_interval(mins=F.lit(n))

    address = F.concat(F.lower(F.replace(F.col("c_name"), F.lit("#"), F.lit("."))), F.lit("@example.com"))
    price = F.col("o_totalprice").cast("decimal(12,2)").cast("string")
    return joined.select(
        k.alias("row_id"),
        F.when(every(1000, 7), None).when(every(500, 499), k - 1).otherwise(k).alias("order_id"),
        F.when(every(211), "invalid-email")
        .when(every(197), None)
        .when(every(193), "   ")
        .when(every(17), F.concat(F.lit("  "), address, F.lit(" ")))
        .otherwise(address)
        .alias("email"),
        F.when(every(173), "").otherwise(F.col("n_name")).alias("country"),
        F.when(every(149), "abc")
        .when(every(151), None)
        .when(every(157), F.concat(F.lit("-"), price))
        .otherwise(price)
        .alias("amount"),
        F.when(every(307), None).otherwise(F.col("o_orderdate")).alias("order_ts_utc"),
        F.when(every(109), None)
        .when(every(101), minutes(720))
        .when(every(103), minutes(900))
        .when(every(107), minutes(-5))
        .otherwise(minutes(45))
        .alias("ingest_ts_utc"),
        F.col("c_mktsegment").alias("channel"),
        F.col("o_orderstatus").alias("order_status"),
        F.col("n_regionkey").alias("region"),
        F.col("o_orderdate").alias("ordered_at"),
        F.year("o_orderdate").alias("run_year"),
    )


FEED_COLUMNS = ("order_id", "email", "country", "amount", "order_ts_utc", "ingest_ts_utc")


def raw_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns of a raw order table, with the row number."""
    return raw_orders(spark, sf_dir).select("row_id", *FEED_COLUMNS)


def delivered() -> Column:
    """New Year's morning after the order."""
    return F.make_timestamp(F.col("run_year") + 1, F.lit(1), F.lit(1), F.lit(6), F.lit(30), F.lit(0))


def ruled(spark: SparkSession, sf_dir: str) -> Assessment:
    """Every order year as a run, under the declared rules."""
    raw = raw_orders(spark, sf_dir).withColumn("delivered", delivered())
    return assess_runs(raw, run_ts="delivered", row_id="row_id", rules=order_rules())


def yearly(spark: SparkSession, sf_dir: str) -> Assessment:
    """Every order year as a run, delivered on New Year's morning."""
    at = delivered()
    raw = raw_orders(spark, sf_dir).select("row_id", *FEED_COLUMNS, at.alias("delivered"))
    return assess_runs(raw, run_ts="delivered", row_id="row_id")


def monthly(spark: SparkSession, sf_dir: str) -> Assessment:
    """Every order month as a run."""
    at = F.date_trunc("month", F.col("ordered_at")).cast("timestamp")
    raw = raw_orders(spark, sf_dir).select("row_id", *FEED_COLUMNS, at.alias("delivered"))
    return assess_runs(raw, run_ts="delivered", row_id="row_id")


def stored_history(
    spark: SparkSession, sf_dir: str, runs=yearly, summary: bool = True, issues: bool = True
) -> tuple[DataFrame | None, DataFrame | None]:
    """The run history as written to and read from its tables."""
    prepare(spark)
    found = runs(spark, sf_dir)
    if summary and issues:
        found = found.settle()
    out: list[DataFrame | None] = [None, None]
    if summary:
        path = scratch_path(spark, "summary")
        append_summary(found.summary, path)
        out[0] = read_summary(spark, path)
    if issues:
        path = scratch_path(spark, "issues")
        append_issues(found.issues, path)
        out[1] = read_issues(spark, path)
    return out[0], out[1]


def order_rules() -> RuleSet:
    """Declared rules for the order feed, one or more of every kind.

    The weights and the slices are fixed values.
    """
    return compile_rules(
        {
            "version": "1.1.0",
            "scoring": {
                "weights": {"completeness": 0.30, "validity": 0.35, "uniqueness": 0.20, "timeliness": 0.15}
            },
            "rules": [
                {"id": "uniq_order", "dimension": "uniqueness", "type": "unique", "column": "order_id", "severity": "high"},
                {"id": "req_order_ts", "dimension": "completeness", "type": "not_null", "column": "order_ts_utc", "severity": "high"},
                {"id": "req_ingest_ts", "dimension": "completeness", "type": "not_null", "column": "ingest_ts_utc", "severity": "high"},
                {"id": "req_country", "dimension": "completeness", "type": "not_null", "column": "country"},
                {"id": "req_email", "dimension": "completeness", "type": "not_null", "column": "email"},
                {"id": "channel_known", "dimension": "validity", "type": "in_set", "column": "channel",
                 "params": {"allowed": ["AUTOMOBILE", "BUILDING", "MACHINERY"]}, "severity": "high"},
                {"id": "email_shape", "dimension": "validity", "type": "regex", "column": "email",
                 "params": {"pattern": r"^\s*customer\.\d+@EXAMPLE\.com\s*$", "flags": "I"}, "severity": "medium"},
                {"id": "amount_range", "dimension": "validity", "type": "range", "column": "amount",
                 "params": {"min": 0.0, "max": 400000}, "severity": "high"},
                {"id": "lag", "dimension": "timeliness", "type": "max_lag_hours",
                 "params": {"event_ts": "order_ts_utc", "ingest_ts": "ingest_ts_utc", "max_hours": 12}},
            ],
            "dashboard": {"suggested_slices": [["channel"], ["country", "region"], ["order_status"], ["shipping_method"]]},
        }
    )


#: Columns and rules of the wide table.
WIDE = 300


def wide_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as a table of 300 number columns; some numbers are missing."""
    seed = F.col("o_orderkey") * 31 + F.col("o_custkey") * 7
    cells = [F.when(F.pmod(seed, F.lit(211 + i)) != 0, F.pmod(seed * (i + 3), F.lit(90 + i))).alias(f"c{i}") for i in range(WIDE)]
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("row_id"), *cells)


def wide_rules() -> RuleSet:
    """A rule for every column of the wide table: a range, a set, presence, and a pattern, in turn."""
    rules = []
    for i in range(WIDE):
        kind, dimension, params = (
            ("range", "validity", {"min": 2, "max": 60 + i}),
            ("in_set", "validity", {"allowed": list(range(80 + i % 7))}),
            ("not_null", "completeness", {}),
            ("regex", "timeliness", {"pattern": r"^\d{1,2}$"}),
        )[i % 4]
        rules.append({"id": f"wide_{i}", "dimension": dimension, "type": kind, "column": f"c{i}", "params": params})
    return compile_rules({"rules": rules})
