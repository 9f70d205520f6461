"""The registered queries in SQL, for comparison."""

from __future__ import annotations

FEED = """
SELECT o_orderkey AS row_id,
  CASE WHEN o_orderkey % 1000 = 7 THEN NULL
       WHEN o_orderkey % 500 = 499 THEN o_orderkey - 1 ELSE o_orderkey END AS order_id,
  CASE WHEN o_orderkey % 211 = 0 THEN 'invalid-email'
       WHEN o_orderkey % 197 = 0 THEN NULL
       WHEN o_orderkey % 193 = 0 THEN '   '
       WHEN o_orderkey % 17 = 0 THEN '  ' || lower(replace(c_name, '#', '.')) || '@example.com '
       ELSE lower(replace(c_name, '#', '.')) || '@example.com' END AS email,
  CASE WHEN o_orderkey % 173 = 0 THEN '' ELSE n_name END AS country,
  CASE WHEN o_orderkey % 149 = 0 THEN 'abc'
       WHEN o_orderkey % 151 = 0 THEN NULL
       WHEN o_orderkey % 157 = 0 THEN '-' || CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS VARCHAR)
       ELSE CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS VARCHAR) END AS amount,
  CASE WHEN o_orderkey % 307 = 0 THEN NULL ELSE o_orderdate END AS order_ts_utc,
  CASE WHEN o_orderkey % 109 = 0 THEN NULL
       WHEN o_orderkey % 101 = 0 THEN o_orderdate + INTERVAL 720 MINUTE
       WHEN o_orderkey % 103 = 0 THEN o_orderdate + INTERVAL 900 MINUTE
       WHEN o_orderkey % 107 = 0 THEN o_orderdate - INTERVAL 5 MINUTE
       ELSE o_orderdate + INTERVAL 45 MINUTE END AS ingest_ts_utc,
  c_mktsegment AS channel, o_orderstatus AS order_status, n_regionkey AS region,
  o_orderdate AS ordered_at, year(o_orderdate) AS run_year
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
"""

COLUMNS = "row_id, order_id, email, country, amount, order_ts_utc, ingest_ts_utc"
ONCE = "TIMESTAMP '2024-03-01 06:30:00'"
YEARLY = "make_timestamp(run_year + 1, 1, 1, 6, 30, 0)"
MONTHLY = "CAST(date_trunc('month', ordered_at) AS TIMESTAMP)"

EMAIL = r"'^[^@\s]+@[^@\s]+\.[^@\s]+$'"
DELAY = "((epoch_us(ingest_ts_utc) - epoch_us(order_ts_utc)) / 60e6)"
ISO = "'%Y-%m-%dT%H:%M:%S+00:00'"


def missing(*names: str) -> str:
    texts = {"email", "country", "amount"}
    tests = [f"{n} IS NULL" + (f" OR CAST({n} AS VARCHAR) = ''" if n in texts else "") for n in names]
    return "(" + " OR ".join(tests) + ")"


def rounded(value: str) -> str:
    """Two decimals: scale, round half to even, scale back."""
    return f"(CAST(round_even(CAST(({value}) AS DOUBLE) * 100, 0) AS DOUBLE) / 100)"


def pct(failed: str, rows: str = "n") -> str:
    return rounded(f"(1 - {failed} / {rows}) * 100")


def share(failed: str = "failed_count", rows: str = "n") -> str:
    """Two decimals of the exact binary value, as printed."""
    x = f"(CAST({failed} AS DOUBLE) / CAST({rows} AS DOUBLE) * CAST(100 AS DOUBLE))"
    return f"CAST(printf('%.2f', {x}) AS DOUBLE)"


def text_item(name: str) -> str:
    return f"CASE WHEN {name} IS NULL THEN 'null' ELSE CAST(to_json({name}) AS VARCHAR) END"


def time_item(name: str) -> str:
    return f"coalesce('\"' || strftime({name}, {ISO}) || '\"', 'null')"


def key_item(name: str) -> str:
    return f"coalesce(CAST({name} AS VARCHAR), 'null')"


def sample_ctes(parts: list[tuple[int, str, str]], source: str = "flags") -> str:
    """The first five failing values per run and check, as JSON lists."""
    hits = " UNION ALL ".join(
        f"SELECT run, row_id, {number} AS chk, {item} AS item FROM {source} WHERE {flag}"
        for number, flag, item in parts
    )
    return f"""
hits AS ({hits}),
ranked AS (SELECT *, row_number() OVER (PARTITION BY run, chk ORDER BY row_id) AS rk FROM hits),
samples AS (SELECT run, chk, '[' || string_agg(item, ', ' ORDER BY row_id) || ']' AS sample_values
            FROM ranked WHERE rk <= 5 GROUP BY run, chk)"""


def history(feed: str = FEED, run: str = YEARLY, amount_item: str = text_item("amount")) -> str:
    """CTEs from the feed to ``summary`` and ``issues``, each value of ``run`` a run."""
    samples = sample_ctes(
        [
            (1, "c1", amount_item),
            (2, "c2", text_item("email")),
            (3, "c3", key_item("order_id")),
            (4, "c4", time_item("ingest_ts_utc")),
        ]
    )
    return f"""
feed AS ({feed}),
norm AS (SELECT {COLUMNS.replace("email", "trim(email) AS email").replace("country", "trim(country) AS country")},
                {run} AS run FROM feed),
flags AS (SELECT *,
  {missing("order_id", "email", "country", "amount", "order_ts_utc", "ingest_ts_utc")} AS c0,
  coalesce(TRY_CAST(amount AS DOUBLE) < 0, true) AS c1,
  NOT coalesce(regexp_matches(email, {EMAIL}), false) AS c2,
  count(*) OVER (PARTITION BY run, order_id) > 1 AS c3,
  coalesce({DELAY} < 0 OR {DELAY} > 720, true) AS c4 FROM norm),
tally AS (SELECT run, count(*) AS n, count(*) FILTER (WHERE c0) AS f0, count(*) FILTER (WHERE c1) AS f1,
  count(*) FILTER (WHERE c2) AS f2, count(*) FILTER (WHERE c3) AS f3, count(*) FILTER (WHERE c4) AS f4,
  count(*) FILTER (WHERE c1 OR c2) AS fv FROM flags GROUP BY run),
scores AS (SELECT *, {pct("f0")} AS completeness_pct, {pct("fv")} AS validity_pct,
  {pct("f3")} AS uniqueness_pct, {pct("f4")} AS timeliness_pct FROM tally),
summary AS (SELECT run, 'Run ' || CAST(row_number() OVER (ORDER BY run) AS VARCHAR) AS run_label,
  strftime(run, '%Y%m%d_%H%M%S') AS run_id, strftime(run, {ISO}) AS run_ts_utc,
  n AS rows_raw, n AS rows_after_global_fixes, n - f0 AS rows_after_hard_clean,
  completeness_pct, validity_pct, uniqueness_pct, timeliness_pct,
  {rounded("(completeness_pct + validity_pct + uniqueness_pct + timeliness_pct) / 4")} AS overall_pct,
  '1.0.0' AS rules_version FROM scores),
{samples},
failures AS (
  SELECT run, 0 AS chk, 'Completeness' AS dimension, 'required_columns_present' AS rule,
         '(required)' AS "column", f0 AS failed_count, n FROM tally
  UNION ALL SELECT run, 1, 'Validity', 'min_amount:0.0', 'amount', f1, n FROM tally
  UNION ALL SELECT run, 2, 'Validity', 'email_format', 'email', f2, n FROM tally
  UNION ALL SELECT run, 3, 'Uniqueness', 'primary_key:order_id', 'order_id', f3, n FROM tally
  UNION ALL SELECT run, 4, 'Timeliness', 'max_delay_minutes:720', 'ingest_ts_utc', f4, n FROM tally),
issues AS (SELECT s.run_label, s.run_id, f.dimension, f.rule, f."column", f.failed_count,
  {share("f.failed_count", "f.n")} AS failed_pct,
  CASE WHEN f.chk = 0 THEN '[' || CASE least(f.failed_count, 3) WHEN 1 THEN '""' WHEN 2 THEN '"", ""' ELSE '"", "", ""' END || ']'
       ELSE p.sample_values END AS sample_values, f.chk
  FROM failures f JOIN summary s ON f.run = s.run
  LEFT JOIN samples p ON p.run = f.run AND p.chk = f.chk WHERE f.failed_count > 0)"""


SUMMARY = (
    "run_label, run_id, run_ts_utc, rows_raw, rows_after_global_fixes, rows_after_hard_clean, "
    "completeness_pct, validity_pct, uniqueness_pct, timeliness_pct, overall_pct, rules_version"
)
ISSUES = 'run_label, run_id, dimension, rule, "column", failed_count, failed_pct, sample_values'


def over(run: str, select: str) -> str:
    return f"WITH {history(run=run)} {select}"


def flat(samples: str = "sample_values") -> str:
    """The items of a JSON list as text."""
    return f"""array_to_string(list_filter(from_json({samples}, '["VARCHAR"]'), lambda x: x <> ''), ', ')"""


HAY = f"""lower(dimension || ' | ' || rule || ' | ' || "column" || ' | ' || {flat()})"""
FMT = "CASE WHEN {0} IS NULL THEN 'N/A' ELSE printf('%.2f%%', {0}) END"
DELTA = "CASE WHEN {0} IS NULL THEN 'N/A' ELSE printf('%+.2f pp', {0}) END"

# Declared rules

def rule_ctes(source: str = FEED, run: str = "1") -> str:
    return f"""
feed AS ({source}),
timed AS (SELECT *, {run} AS run FROM feed),
ruled AS (SELECT *,
  count(*) OVER (PARTITION BY run, order_id) > 1 AS r0,
  order_ts_utc IS NULL AS r1, ingest_ts_utc IS NULL AS r2,
  country IS NULL OR country = '' AS r3, email IS NULL OR email = '' AS r4,
  NOT coalesce(channel IN ('AUTOMOBILE', 'BUILDING', 'MACHINERY'), false) AS r5,
  NOT coalesce(regexp_matches(email, '(?i)^\\s*customer\\.\\d+@EXAMPLE\\.com\\s*$'), false) AS r6,
  NOT coalesce(TRY_CAST(amount AS DOUBLE) BETWEEN 0 AND 400000, false) AS r7,
  coalesce({DELAY} < 0 OR {DELAY} > 720, true) AS r8 FROM timed),
counted AS (SELECT *, r1 OR r2 OR r3 OR r4 AS bad_c, r5 OR r6 OR r7 AS bad_v FROM ruled)"""


RULES = rule_ctes()
TRIMMED = f"SELECT * REPLACE (trim(email) AS email, trim(country) AS country) FROM ({FEED})"

WEIGHTED = rounded(
    "(completeness_pct * 0.30::DOUBLE + validity_pct * 0.35::DOUBLE + uniqueness_pct * 0.20::DOUBLE"
    " + timeliness_pct * 0.15::DOUBLE) / 1"
)


def rule_scores(group: str = "", keep: str = "") -> str:
    return f"""SELECT *, {WEIGHTED} AS overall_pct FROM (
  SELECT {keep} count(*) AS "rows", {pct("count(*) FILTER (WHERE bad_c)", "count(*)")} AS completeness_pct,
  {pct("count(*) FILTER (WHERE bad_v)", "count(*)")} AS validity_pct,
  {pct("count(*) FILTER (WHERE r0)", "count(*)")} AS uniqueness_pct,
  {pct("count(*) FILTER (WHERE r8)", "count(*)")} AS timeliness_pct FROM counted {group})"""


SLICES = rule_scores(
    "GROUP BY GROUPING SETS ((channel), (country, region), (order_status))",
    """CASE WHEN grouping(channel) = 0 THEN 'channel' WHEN grouping(country) = 0 THEN 'country,region'
       ELSE 'order_status' END AS slice, channel, country, region, order_status,""",
)

RULE_LIST = [
    ("Uniqueness", "uniq_order", "order_id", "high", key_item("order_id")),
    ("Completeness", "req_order_ts", "order_ts_utc", "high", time_item("order_ts_utc")),
    ("Completeness", "req_ingest_ts", "ingest_ts_utc", "high", time_item("ingest_ts_utc")),
    ("Completeness", "req_country", "country", "medium", text_item("country")),
    ("Completeness", "req_email", "email", "medium", text_item("email")),
    ("Validity", "channel_known", "channel", "high", text_item("channel")),
    ("Validity", "email_shape", "email", "medium", text_item("email")),
    ("Validity", "amount_range", "amount", "high", text_item("amount")),
    ("Timeliness", "lag", "ingest_ts_utc", "medium", time_item("ingest_ts_utc")),
]
RULE_ROWS = " UNION ALL ".join(
    f"""SELECT {i} AS chk, '{dimension}' AS dimension, '{rule}' AS rule, '{column}' AS "column", '{severity}' AS severity,
    count(*) FILTER (WHERE r{i}) AS failed_count, count(*) AS n FROM counted"""
    for i, (dimension, rule, column, severity, _) in enumerate(RULE_LIST)
)
RULE_SAMPLES = sample_ctes([(i, f"r{i}", item) for i, (*_, item) in enumerate(RULE_LIST)], "counted")

WIDE = 300
WIDE_CELLS = ", ".join(
    f"CASE WHEN seed % {211 + i} <> 0 THEN (seed * {i + 3}) % {90 + i} END AS c{i}" for i in range(WIDE)
)
WIDE_FAILED = [
    (
        f"coalesce(c{i} < 2 OR c{i} > {60 + i}, true)",
        f"coalesce(c{i} >= {80 + i % 7}, true)",
        f"c{i} IS NULL",
        f"coalesce(c{i} > 99, true)",
    )[i % 4]
    for i in range(WIDE)
]
WIDE_DIMENSIONS = ("Validity", "Validity", "Completeness", "Timeliness")
WIDE_TABLE = f"wide AS (SELECT o_orderkey AS row_id, {WIDE_CELLS} FROM (SELECT *, o_orderkey * 31 + o_custkey * 7 AS seed FROM orders))"
WIDE_ROWS = ", ".join(
    f"""{{'check_no': {i}, 'dimension': '{WIDE_DIMENSIONS[i % 4]}', 'rule': 'wide_{i}', 'column': 'c{i}',
    'failed_count': count(*) FILTER (WHERE {failed}),
    'items': arg_min(coalesce(c{i}::VARCHAR, 'null'), row_id, 5) FILTER (WHERE {failed})}}"""
    for i, failed in enumerate(WIDE_FAILED)
)


def wide_pct(dimension: str) -> str:
    failed = " OR ".join(f for i, f in enumerate(WIDE_FAILED) if WIDE_DIMENSIONS[i % 4] == dimension)
    return pct(f"count(*) FILTER (WHERE {failed})", "count(*)")


SECOND = "TIMESTAMP '2024-03-02 06:30:00'"
BOTH_RUNS = f"""SELECT {COLUMNS}, {ONCE} AS run FROM ({FEED})
  UNION ALL SELECT {COLUMNS.replace("amount", "replace(amount, '-', '') AS amount")}, {SECOND} AS run FROM ({FEED})"""

SAME_SECOND = f"CASE WHEN order_status = 'F' THEN {ONCE} ELSE {ONCE} + INTERVAL 1 SECOND END"

CARDS = f"""
SELECT s.run_id, s.run_label, {FMT.format("overall_pct")} AS overall,
  CASE WHEN overall_pct >= 95 THEN 'GOOD' WHEN overall_pct >= 85 THEN 'OK' ELSE 'RISK' END AS status,
  rows_raw, 'Rules: ' || rules_version AS rules, {DELTA.format("d.delta")} AS delta,
  CASE least(completeness_pct, validity_pct, uniqueness_pct, timeliness_pct)
    WHEN completeness_pct THEN 'Completeness' WHEN validity_pct THEN 'Validity'
    WHEN uniqueness_pct THEN 'Uniqueness' ELSE 'Timeliness' END
  || printf(' (%.2f%%)', least(completeness_pct, validity_pct, uniqueness_pct, timeliness_pct)) AS lowest,
  coalesce(g.issue_groups, 0) AS issue_groups,
  CASE WHEN g.issue_groups IS NULL THEN 'No issues detected.' ELSE 'Use drill-down for details.' END AS note
FROM summary s
JOIN (SELECT run_id, overall_pct - lag(overall_pct) OVER (ORDER BY run_ts_utc) AS delta FROM summary) d ON d.run_id = s.run_id
LEFT JOIN (SELECT run_id, count(*) AS issue_groups FROM issues GROUP BY run_id) g ON g.run_id = s.run_id"""


# a shared id with another label, a null id, and the time rows of Run 3 found by their id alone
LEGACY_CARDS = CARDS.replace("FROM summary s", "FROM more s").replace("FROM summary) d ON d.run_id = s.run_id", "FROM more) d ON d.run_label = s.run_label").replace(
    "SELECT run_id, overall_pct - lag", "SELECT run_label, overall_pct - lag"
).replace(
    "(SELECT run_id, count(*) AS issue_groups FROM issues GROUP BY run_id) g ON g.run_id = s.run_id",
    """(SELECT CASE WHEN dimension = 'Timeliness' AND run_label = 'Run 3' THEN 'Other' ELSE run_label END AS owner,
       count(*) AS issue_groups FROM issues GROUP BY owner) g ON g.owner = s.run_label""",
)
MORE = """more AS (SELECT * FROM summary
  UNION ALL SELECT * REPLACE ('Other' AS run_label, replace(run_ts_utc, '06:30:00', '06:30:01') AS run_ts_utc)
    FROM summary WHERE run_label = 'Run 3'
  UNION ALL SELECT * REPLACE ('Lost' AS run_label, replace(run_ts_utc, '06:30:00', '06:30:02') AS run_ts_utc, NULL AS run_id)
    FROM summary WHERE run_label = 'Run 3')"""

RULED_ROWS = " UNION ALL ".join(
    f"""SELECT run, {i} AS chk, '{dimension}' AS dimension, '{rule}' AS rule, '{column}' AS "column", '{severity}' AS severity,
    count(*) FILTER (WHERE r{i}) AS failed_count, count(*) AS n FROM counted GROUP BY run"""
    for i, (dimension, rule, column, severity, _) in enumerate(RULE_LIST)
)
RULED_RUNS = f"""runs AS (SELECT run, 'Run ' || CAST(row_number() OVER (ORDER BY run) AS VARCHAR) AS run_label,
  strftime(run, '%Y%m%d_%H%M%S') AS run_id, strftime(run, {ISO}) AS run_ts_utc FROM (SELECT DISTINCT run FROM timed))"""


def check(number: int) -> str:
    return over(ONCE, f"SELECT row_id, c{number} AS failed FROM flags")


def record(table: str, columns: str) -> str:
    return f"SELECT CAST(to_json(t) AS VARCHAR) AS record FROM (SELECT {columns} FROM {table}) t"


ORACLE: dict[str, str] = {
    "run_summary": over(ONCE, f"SELECT {SUMMARY} FROM summary"),
    "csv_scan": f"""SELECT row_id, order_id, email, nullif(country, '') AS country, amount, order_ts_utc, ingest_ts_utc
                    FROM ({FEED})""",
    "source_fallback": f"SELECT {COLUMNS}, true AS from_staged FROM ({FEED})",
    "summary_default_labels": over(YEARLY, "SELECT run_label, run_id, overall_pct FROM summary"),
    "issues_scan_legacy": over(YEARLY, f"SELECT {ISSUES.replace('run_label, run_id', "'' AS run_label, '' AS run_id")} FROM issues"),
    "summary_append": over(YEARLY, f"SELECT {SUMMARY} FROM summary"),
    "issues_append": over(YEARLY, f"SELECT {ISSUES} FROM issues"),
    "last_metrics": over(ONCE, f"SELECT {SUMMARY} FROM summary"),
    "dashboard_records": over(YEARLY, f"{record('summary', SUMMARY)} UNION ALL {record('issues', ISSUES)}"),
    "drilldown_export": over(
        YEARLY,
        f"""SELECT dimension, rule, "column", failed_count, failed_pct, {flat()} AS sample_values
            FROM issues WHERE dimension = 'Validity' AND contains({HAY}, 'email')""",
    ),
    "dataset_shape": over(
        ONCE,
        """SELECT 'Dataset loaded: clean.csv (' || CAST(rows_after_hard_clean AS VARCHAR) || ' rows, 6 columns).' AS line
           FROM summary""",
    ),
    "manifest_check": over(
        ONCE,
        """SELECT 'clean' AS name, true AS "exists", rows_after_hard_clean AS row_count FROM summary
           UNION ALL SELECT 'report', false, NULL""",
    ),
    "append_same_second": over(
        SAME_SECOND,
        f"""SELECT {SUMMARY.replace("run_id, run_ts_utc", "'20240301_063000' AS run_id, '2024-03-01T06:30:00+00:00' AS run_ts_utc")}
            FROM summary""",
    ),
    "history_mixed": over(
        YEARLY,
        f"""SELECT {SUMMARY.replace("run_label", "CASE WHEN run_id >= '1999' THEN 'R-' || run_id ELSE run_label END AS run_label").replace(
            "rules_version", "CASE WHEN run_id >= '1999' THEN rules_version END AS rules_version")}, format
            FROM summary, (VALUES ('parquet'), ('csv')) f(format)""",
    ),
    "normalize_strings": over(ONCE, "SELECT row_id, email, country FROM norm"),
    "coerce_timestamps": """
SELECT o_orderkey AS row_id,
  CASE o_orderkey % 5 WHEN 0 THEN date_trunc('day', o_orderdate)
    WHEN 1 THEN date_trunc('day', o_orderdate) + INTERVAL '01:02:03'
    WHEN 2 THEN date_trunc('day', o_orderdate) + INTERVAL '01:02:03' - INTERVAL 2 HOUR
    WHEN 3 THEN date_trunc('day', o_orderdate) + INTERVAL '23:59:59' ELSE NULL END::TIMESTAMP AS text_ts,
  o_orderdate AS plain_ts, o_orderdate + INTERVAL 1 MICROSECOND AS nanos_ts FROM orders""",
    "coerce_amount": f"""
SELECT row_id, CASE WHEN row_id % 6 IN (1, 4) THEN NULL WHEN row_id % 6 = 3 THEN TRY_CAST(amount || 'e2' AS DOUBLE)
  ELSE TRY_CAST(amount AS DOUBLE) END AS number FROM ({FEED})""",
    "timestamp_fallback_rename": over(ONCE, f"SELECT {COLUMNS}, true AS resolved FROM flags WHERE NOT c0"),
    "ingest_delay": f"SELECT row_id, {DELAY} AS delay_minutes FROM ({FEED})",
    "hard_clean": over(ONCE, f"SELECT {COLUMNS} FROM flags WHERE NOT c0"),
    "hard_clean_rejects": over(ONCE, f"SELECT {COLUMNS} FROM flags WHERE c0"),
    "issues_for_run": over(YEARLY, f"SELECT {ISSUES} FROM issues WHERE run_label = 'Run 3'"),
    "drill_dimension": over(YEARLY, f"SELECT {ISSUES} FROM issues WHERE dimension = 'Validity'"),
    "drill_search": over(YEARLY, f"SELECT {ISSUES} FROM issues WHERE contains({HAY}, 'abc,')"),
    "run_lookup": over(YEARLY, f"SELECT {SUMMARY} FROM summary WHERE run_label = 'Run 4'"),
    "check_completeness": check(0),
    "check_amount_min": check(1),
    "check_email": check(2),
    "check_unique": over(ONCE, "SELECT row_id, order_id, c3 AS failed FROM flags"),
    "check_delay": check(4),
    "check_validity_any": over(ONCE, "SELECT row_id, c1 OR c2 AS failed FROM flags"),
    "rule_unique": """SELECT l_orderkey, l_linenumber, l_partkey,
                      count(*) OVER (PARTITION BY l_orderkey, l_linenumber) > 1 AS failed FROM lineitem""",
    "rule_unique_nulls": f"""WITH feed AS ({FEED}),
        flags AS (SELECT *, 1 AS run, count(*) OVER (PARTITION BY order_id) > 1 AS r0 FROM feed),
        twice AS (SELECT *, r0 AND order_id IS NOT NULL AS r1 FROM flags),
        {sample_ctes([(0, "r0", key_item("order_id")), (1, "r1", key_item("order_id"))], "twice")},
        tally AS (SELECT 0 AS chk, 'nulls_fail' AS rule, count(*) FILTER (WHERE r0) AS failed_count, count(*) AS n FROM twice
                  UNION ALL SELECT 1, 'nulls_pass', count(*) FILTER (WHERE r1), count(*) FROM twice)
        SELECT set_no, rule, failed_count, {share()} AS failed_pct, sample_values
        FROM tally JOIN samples USING (chk) JOIN (VALUES (0, 0), (1, 1), (2, 0), (2, 1)) s(set_no, chk) USING (chk)""",
    "rule_not_null": f"""SELECT row_id, order_ts_utc IS NULL AS order_ts_utc_failed, ingest_ts_utc IS NULL AS ingest_ts_utc_failed,
                         channel IS NULL OR channel = '' AS channel_failed, country IS NULL OR country = '' AS country_failed,
                         email IS NULL OR email = '' AS email_failed FROM ({FEED})""",
    "rule_in_set": f"""SELECT row_id, channel, NOT coalesce(channel IN ('AUTOMOBILE', 'BUILDING', 'MACHINERY'), false) AS failed,
                       NOT coalesce(region IN (0, 2), false) AS region_failed, NOT coalesce(order_status = 'F', false) AS status_failed
                       FROM ({FEED})""",
    "rule_regex": over(
        ONCE,
        r"""SELECT row_id, NOT coalesce(regexp_matches(email, '^customer\.\d+@EXAMPLE\.com$'), false) AS failed_as_written,
            NOT coalesce(regexp_matches(email, '(?i)^customer\.\d+@EXAMPLE'), false) AS failed_any_case FROM norm""",
    ),
    "rule_range": """SELECT l_orderkey, l_linenumber, NOT coalesce(l_quantity BETWEEN 1 AND 45, false) AS quantity_failed,
                     NOT coalesce(l_discount BETWEEN 0 AND 0.07::DOUBLE, false) AS discount_failed,
                     NOT coalesce(l_extendedprice >= 20000, false) AS price_failed FROM lineitem""",
    "rule_max_lag": check(4),
    "score_weighted": over(YEARLY, f"SELECT run_id, overall_pct, {WEIGHTED} AS weighted_pct FROM summary"),
    "issues_by_severity": f"""WITH {RULES}, listed AS ({RULE_ROWS})
        SELECT severity, count(*) AS failing_rules, CAST(sum(failed_count) AS BIGINT) AS failed_count
        FROM listed WHERE failed_count > 0 GROUP BY severity""",
    "score_by_slice": f"WITH {RULES} {SLICES}",
    "rule_set_many": f"""WITH {WIDE_TABLE}, tally AS (SELECT count(*) AS n, [{WIDE_ROWS}] AS listed FROM wide)
        SELECT r.check_no, r.dimension, r.rule, r."column", 'medium' AS severity, r.failed_count,
          '[' || coalesce(array_to_string(r.items, ', '), '') || ']' AS sample_values, {share("r.failed_count")} AS failed_pct
        FROM (SELECT n, unnest(listed) AS r FROM tally)""",
    "rule_set_many_scores": f"""WITH {WIDE_TABLE}, scored AS (SELECT count(*) AS "rows", {wide_pct("Completeness")} AS completeness_pct,
          {wide_pct("Validity")} AS validity_pct, 100::DOUBLE AS uniqueness_pct, {wide_pct("Timeliness")} AS timeliness_pct FROM wide)
        SELECT *, {rounded("(completeness_pct + validity_pct + uniqueness_pct + timeliness_pct) / 4")} AS overall_pct FROM scored""",
    "rule_set_eval": f"""WITH {RULES}, {RULE_SAMPLES}, listed AS ({RULE_ROWS})
        SELECT l.chk AS check_no, dimension, rule, "column", severity, failed_count, coalesce(sample_values, '[]') AS sample_values,
        {share()} AS failed_pct
        FROM listed l LEFT JOIN samples s ON s.chk = l.chk""",
    "rule_set_scores": f"WITH {RULES} {rule_scores()}",
    "dimension_scores": over(ONCE, "SELECT completeness_pct, validity_pct, uniqueness_pct, timeliness_pct FROM summary"),
    "overall_score": over(ONCE, "SELECT overall_pct FROM summary"),
    "row_counts": over(ONCE, "SELECT rows_raw, rows_after_global_fixes, rows_after_hard_clean FROM summary"),
    "failed_counts": over(
        ONCE,
        f"SELECT chk AS check_no, dimension, rule, failed_count, {share()} AS failed_pct FROM failures",
    ),
    "issues": over(ONCE, f"SELECT {ISSUES} FROM issues"),
    "issues_unkeyed": over(
        ONCE,
        """SELECT dimension, rule, failed_count, failed_pct,
           CAST(least(failed_count, CASE WHEN "column" = '(required)' THEN 3 ELSE 5 END) AS INTEGER) AS n_samples FROM issues""",
    ),
    "ruled_summary": f"""WITH {rule_ctes(TRIMMED, YEARLY)}, {RULED_RUNS}, scored AS ({rule_scores("GROUP BY run", "run, count(*) FILTER (WHERE NOT bad_c) AS kept,")})
        SELECT run_label, run_id, run_ts_utc, "rows" AS rows_raw, "rows" AS rows_after_global_fixes, kept AS rows_after_hard_clean,
        completeness_pct, validity_pct, uniqueness_pct, timeliness_pct, overall_pct, '1.1.0' AS rules_version
        FROM scored JOIN runs USING (run)""",
    "ruled_issues": f"""WITH {rule_ctes(TRIMMED, YEARLY)}, {RULE_SAMPLES}, {RULED_RUNS}, listed AS ({RULED_ROWS})
        SELECT run_label, run_id, dimension, rule, "column", failed_count, {share()} AS failed_pct, sample_values, severity
        FROM listed JOIN runs USING (run) JOIN samples USING (run, chk) WHERE failed_count > 0""",
    "issue_samples": over(MONTHLY, 'SELECT run_id, "column", sample_values FROM issues'),
    "yearly_summary": over(YEARLY, f"SELECT {SUMMARY} FROM summary"),
    "yearly_issues": over(YEARLY, f"SELECT {ISSUES} FROM issues"),
    "issue_group_count": over(
        YEARLY,
        """SELECT s.run_label, s.run_id, coalesce(g.c, 0) AS issue_groups,
           CASE WHEN g.c IS NULL THEN 'No issues detected.' ELSE 'Use drill-down for details.' END AS note
           FROM summary s LEFT JOIN (SELECT run_id, count(*) AS c FROM issues GROUP BY run_id) g ON g.run_id = s.run_id""",
    ),
    "lowest_dimension": over(
        YEARLY,
        """SELECT run_label, run_id, dimension, score, dimension || printf(' (%.2f%%)', score) AS text FROM (
             SELECT run_label, run_id, least(completeness_pct, validity_pct, uniqueness_pct, timeliness_pct) AS score,
               CASE score WHEN completeness_pct THEN 'Completeness' WHEN validity_pct THEN 'Validity'
                 WHEN uniqueness_pct THEN 'Uniqueness' ELSE 'Timeliness' END AS dimension FROM summary)""",
    ),
    "backfill_labels": over(
        YEARLY,
        f"""SELECT CASE WHEN dimension = 'Timeliness' THEN '' ELSE run_label END AS run_label,
            CASE WHEN dimension = 'Timeliness' THEN 'x' || run_id ELSE run_id END AS run_id,
            {ISSUES.replace("run_label, run_id, ", "")} FROM issues""",
    ),
    "run_delta": over(
        YEARLY,
        f"""SELECT run_label, run_id, overall_pct, validity_pct, overall_pct_delta, validity_pct_delta,
            {DELTA.format("overall_pct_delta")} AS overall_pct_delta_text,
            {DELTA.format("validity_pct_delta")} AS validity_pct_delta_text FROM (
              SELECT *, overall_pct - lag(overall_pct) OVER (ORDER BY run_ts_utc, run_id) AS overall_pct_delta,
                validity_pct - lag(validity_pct) OVER (ORDER BY run_ts_utc, run_id) AS validity_pct_delta FROM summary)""",
    ),
    "latest_run": over(
        YEARLY,
        """SELECT run_label, run_id, run_label || CASE WHEN is_latest THEN ' (latest)' ELSE '' END AS option, is_latest FROM (
             SELECT *, row_number() OVER (ORDER BY run_ts_utc DESC, run_id DESC) = 1 AS is_latest FROM summary)""",
    ),
    "next_run_label": over(YEARLY, "SELECT 'Run ' || CAST(count(*) + 1 AS VARCHAR) AS run_label FROM summary"),
    "drilldown_top50": over(
        MONTHLY,
        f"""SELECT run_label, dimension, rule, "column", failed_count, {FMT.format("failed_pct")} AS failed_pct,
            {flat()} AS sample_values, count(*) OVER () AS total FROM issues WHERE contains({HAY}, 'a')
            ORDER BY run_id, chk LIMIT 50""",
    ),
    "history_union": over(
        YEARLY,
        f"""SELECT {SUMMARY.replace("run_label", "CASE WHEN run_id >= '1999' THEN run_label END AS run_label").replace(
            "rules_version", "CASE WHEN run_id >= '1999' THEN rules_version END AS rules_version")} FROM summary""",
    ),
    "score_bars": over(
        YEARLY,
        """SELECT run_label, run_id, metric, score FROM (SELECT run_label, run_id, completeness_pct AS "Completeness",
             validity_pct AS "Validity", uniqueness_pct AS "Uniqueness", timeliness_pct AS "Timeliness",
             overall_pct AS "Overall" FROM summary)
           UNPIVOT (score FOR metric IN ("Completeness", "Validity", "Uniqueness", "Timeliness", "Overall"))""",
    ),
    "trend_series": over(
        MONTHLY,
        """SELECT run_no, run_label, metric, score, runs FROM (SELECT row_number() OVER (ORDER BY run) AS run_no, run_label,
             overall_pct AS "Overall", validity_pct AS "Validity", timeliness_pct AS "Timeliness",
             count(*) OVER () AS runs FROM summary)
           UNPIVOT (score FOR metric IN ("Overall", "Validity", "Timeliness"))""",
    ),
    "history_table": over(
        YEARLY,
        "SELECT run_label, rows_raw, "
        + ", ".join(
            f"{FMT.format(c)} AS {c}"
            for c in ("overall_pct", "completeness_pct", "validity_pct", "uniqueness_pct", "timeliness_pct")
        )
        + " FROM summary",
    ),
    "run_cards": over(YEARLY, CARDS),
    "run_cards_legacy": f"WITH {history(run=YEARLY)}, {MORE} {LEGACY_CARDS}",
    "fmt_pct": f"""SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber = 3 THEN 'N/A'
                   ELSE {FMT.format("(l_extendedprice * 1.0007::DOUBLE)")} END AS text FROM lineitem""",
    "sample_text": over(
        MONTHLY,
        f"""SELECT run_id, rule, CASE WHEN rule = 'email_format' THEN run_id WHEN "column" = '(required)' THEN 'oops ['
            WHEN "column" = 'ingest_ts_utc' AND failed_count < 6 THEN '' ELSE {flat()} END AS text FROM issues""",
    ),
    "run_status": f"""WITH {RULES} SELECT slice, channel, country, region, order_status,
        CASE WHEN overall_pct >= 95 THEN 'GOOD' WHEN overall_pct >= 85 THEN 'OK' ELSE 'RISK' END AS status FROM ({SLICES})""",
    "run_identity": f"""SELECT event_id, strftime(ts, '%Y%m%d_%H%M%S') AS run_id, strftime(ts, {ISO}) AS run_ts_utc,
                        strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS generated FROM events""",
    "end_to_end": f"""WITH {history(BOTH_RUNS, "run")} {CARDS}""",
    "run_rerun": over(
        ONCE,
        """SELECT run_label, run_id, (SELECT count(*) FROM issues) AS issue_groups, 'Run 1' AS pointer, 'Run 1 Run 1' AS returned
           FROM summary""",
    ),
    "csv_folder": f"""SELECT row_id, order_id, email, CASE WHEN row_id % 3 <> 2 THEN nullif(country, '') END AS country, amount,
          order_ts_utc, ingest_ts_utc, NULL::VARCHAR AS line FROM ({FEED})
        UNION ALL SELECT NULL, NULL, NULL, NULL, NULL, NULL, NULL, o_orderkey::VARCHAR || ',x@y.z,more' FROM orders WHERE o_orderkey % 50 = 0""",
    "half_written": """SELECT 'clean' AS name, true AS "exists", count(*) AS row_count, true AS from_staged, 2 AS code FROM orders
        UNION ALL SELECT 'begun', false, NULL, true, 2""",
    "run_keys": over(
        ONCE,
        f"""SELECT {SUMMARY.replace("run_label, ", "")}, label AS run_label, key AS run_key
            FROM summary, (VALUES ('Run 1', 'north/2024-03-01'), ('Run 2', 'south/2024-03-01')) k(label, key)""",
    ),
    "issues_of_key": over(
        YEARLY, f"SELECT {ISSUES}, 'orders/' || run_id AS run_key FROM issues WHERE run_id = '19970101_063000'"
    ),
    "run_unpublished": over(
        ONCE,
        """SELECT run_label, 'first' AS run_key, rows_after_hard_clean, rows_after_hard_clean AS clean_rows,
             'first' AS pointer, 'a run key can''t be empty' AS raised FROM summary""",
    ),
    "rows_kept": f"""
        WITH counted AS (SELECT trim(coalesce(email, '')) = '' AS lacks, count(*) OVER (PARTITION BY order_id) > 1 AS again FROM ({FEED}))
        SELECT count(*) FILTER (WHERE NOT lacks) AS rows_after_hard_clean, {pct("count(*) FILTER (WHERE lacks OR again)", "count(*)")} AS completeness_pct,
          count(*) FILTER (WHERE NOT lacks) AS clean_rows FROM counted""",
}
