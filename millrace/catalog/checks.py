"""Quality checks, dead letters and fallbacks over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructType, TimestampType

from millrace.catalog import tables as T
from millrace.catalog.registry import query
from millrace.functions import values as V
from millrace.operators import deadletter, quality
from millrace.session import spread_shuffles

AS_OF_SQL = "TIMESTAMP '2024-02-01 00:00:00'"
AS_OF = "2024-02-01 00:00:00"

RULES_SQL = f"""SELECT id, concat_ws(',',
    CASE WHEN NOT regexp_matches(email, '{V.EMAIL_PATTERN}') THEN 'email_format' END,
    CASE WHEN NOT age BETWEEN 0 AND 150 THEN 'age_range' END,
    CASE WHEN country NOT IN {V.COUNTRIES} THEN 'country_allowed' END,
    CASE WHEN NOT revenue >= 0 THEN 'revenue_not_negative' END,
    CASE WHEN NOT signup_date <= {AS_OF_SQL} THEN 'signup_not_future' END) AS failed_rules FROM {T.PEOPLE_SQL}"""


@query("validate_record_rules", f"SELECT id, failed_rules, failed_rules = '' AS is_valid FROM ({RULES_SQL})")
def validate_record_rules(spark, sf):
    checked = quality.validate_record_rules(T.people(spark, sf), quality.user_event_rules(T.timestamp(AS_OF)))
    return checked.select("id", F.array_join("failed_rules", ",").alias("failed_rules"), "is_valid")


@query(
    "schema_check",
    f"""SELECT * FROM (
          SELECT unnest(['event_id', 'ts', 'value', 'props', 'revenue', 'user_id', 'event_type']) AS "column",
                 unnest(['bigint', 'timestamp', 'double', 'string', 'double', NULL, NULL]) AS expected,
                 unnest(['bigint', 'timestamp_ntz', 'double', 'string', NULL, 'bigint', 'string']) AS actual,
                 unnest([n_id, n_ts, n_value, n_props, NULL, n_user, n_type]) AS null_count,
                 unnest(['ok', 'type_mismatch', CASE WHEN n_value > 0 THEN 'unexpected_nulls' ELSE 'ok' END, 'ok', 'missing',
                         'extra', 'extra']) AS status
          FROM (SELECT count(*) FILTER (event_id IS NULL) AS n_id, count(*) FILTER (ts IS NULL) AS n_ts,
                       count(*) FILTER (value IS NULL) AS n_value, count(*) FILTER (props IS NULL) AS n_props,
                       count(*) FILTER (user_id IS NULL) AS n_user, count(*) FILTER (event_type IS NULL) AS n_type
                FROM {T.DIRTY_SQL}))""",
)
def schema_check(spark, sf):
    expected = (
        StructType()
        .add("event_id", LongType(), False)
        .add("ts", TimestampType(), False)
        .add("value", DoubleType(), False)
        .add("props", StringType())
        .add("revenue", DoubleType())
    )
    return quality.schema_check(T.dirty_events(spark, sf), expected)


@query(
    "null_report",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count(*) FILTER ({c} IS NULL) AS null_count,
            round(count(*) FILTER ({c} IS NULL) / count(*) * 100.0, 2) AS null_percentage,
            CASE WHEN count(*) FILTER ({c} IS NULL) / count(*) * 100.0 <= 5.0 THEN 'PASS' ELSE 'FAIL' END AS status
            FROM {T.DIRTY_SQL}"""
        for c in ("event_id", "value", "props")
    ),
)
def null_report(spark, sf):
    return quality.null_report(T.dirty_events(spark, sf), ["event_id", "value", "props"])


@query(
    "range_report",
    f"""SELECT 'value' AS "column", CAST(0 AS DOUBLE) AS min_allowed, CAST(300 AS DOUBLE) AS max_allowed,
        count(*) FILTER (value < 0 OR value > 300) AS out_of_range, count(*) FILTER (value IS NULL) AS null_count
        FROM {T.DIRTY_SQL}
        UNION ALL SELECT 'user_id', 1, 100000, count(*) FILTER (user_id < 1 OR user_id > 100000), 0 FROM {T.DIRTY_SQL}""",
)
def range_report(spark, sf):
    return quality.range_report(T.dirty_events(spark, sf), {"value": (0, 300), "user_id": (1, 100_000)})


@query(
    "range_split",
    f"""SELECT event_id, concat_ws(',',
          CASE WHEN value IS NULL THEN 'value:null' WHEN value < 0 OR value > 300 THEN 'value' END,
          CASE WHEN user_id < 1 OR user_id > 100000 THEN 'user_id' END) AS range_errors FROM {T.DIRTY_SQL}""",
)
def range_split(spark, sf):
    rules = {"value": (0, 300), "user_id": (1, 100_000)}
    clean, rejected = quality.range_split(T.dirty_events(spark, sf).select("event_id", "user_id", "value"), rules)
    return clean.select("event_id", F.lit("").alias("range_errors")).unionByName(
        rejected.select("event_id", F.array_join("range_errors", ",").alias("range_errors"))
    )


@query(
    "uniqueness_report",
    """WITH g AS (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)
       SELECT CAST(sum(n) AS BIGINT) AS total_rows, count(*) AS distinct_rows,
              CAST(sum(n - 1) AS BIGINT) AS duplicate_rows, count(*) FILTER (n > 1) AS duplicate_groups,
              max(n) AS largest_group FROM g""",
)
def uniqueness_report(spark, sf):
    return quality.uniqueness_report(T.table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "referential_report",
    f"""WITH o AS (SELECT o_custkey, o_custkey IN (SELECT sign(c_acctbal) * c_custkey FROM customer) AS known
                   FROM {T.UNKEYED_ORDERS_SQL})
        SELECT count(*) AS child_rows, count(*) FILTER (NOT coalesce(known, false)) AS orphan_rows,
               count(*) FILTER (o_custkey IS NULL) AS null_key_rows,
               count(DISTINCT o_custkey) FILTER (NOT known) + max(CASE WHEN o_custkey IS NULL THEN 1 ELSE 0 END) AS orphan_keys
        FROM o""",
)
def referential_report(spark, sf):
    solvent = T.signed_customers(spark, sf)
    return quality.referential_report(T.unkeyed_orders(spark, sf), solvent, "o_custkey", "c_custkey")


@query(
    "freshness_check",
    f"""SELECT event_type, max(ts) AS latest, round((epoch_us({AS_OF_SQL}) - epoch_us(max(ts))) / 3600000000.0, 4) AS age_hours,
        CASE WHEN (epoch_us({AS_OF_SQL}) - epoch_us(max(ts))) / 3600000000.0 > 24 THEN 'STALE' ELSE 'PASS' END AS status
        FROM (SELECT 'all' AS event_type, ts FROM events) GROUP BY event_type""",
)
def freshness_check(spark, sf):
    report = quality.freshness_check(T.events(spark, sf), "ts", T.timestamp(AS_OF))
    return report.withColumn("event_type", F.lit("all"))


@query("fresh_rows", f"SELECT event_id, ts FROM events WHERE ts >= {AS_OF_SQL} - INTERVAL 72 HOUR")
def fresh_rows(spark, sf):
    return quality.fresh_rows(T.events(spark, sf).select("event_id", "ts"), "ts", T.timestamp(AS_OF), 72)


@query(
    "zscore_anomalies",
    """SELECT event_id, value FROM events, (SELECT avg(value) AS m, stddev(value) AS s FROM events)
       WHERE value < m - 3 * s OR value > m + 3 * s""",
)
def zscore_anomalies(spark, sf):
    return quality.zscore_anomalies(T.events(spark, sf).select("event_id", "value"), "value")


@query(
    "zscore_anomalies_upper",
    """SELECT event_id, value FROM events, (SELECT avg(value) AS m, stddev(value) AS s FROM events)
       WHERE value > m + 2 * s""",
)
def zscore_anomalies_upper(spark, sf):
    return quality.zscore_anomalies(T.events(spark, sf).select("event_id", "value"), "value", 2.0, "upper")


@query(
    "baseline_drift",
    """WITH c AS (SELECT 'l_quantity' AS "column", avg(l_quantity) AS m FROM lineitem
                  UNION ALL SELECT 'l_extendedprice', avg(l_extendedprice) FROM lineitem),
            b AS (SELECT 'l_quantity' AS "column", avg(l_quantity) AS m FROM lineitem WHERE l_shipdate < TIMESTAMP '1998-01-01'
                  UNION ALL SELECT 'l_extendedprice', avg(l_extendedprice) / 2 FROM lineitem
                            WHERE l_shipdate < TIMESTAMP '1998-01-01')
       SELECT "column", round(c.m, 6) AS current_mean, round(b.m, 6) AS baseline_mean,
              round(abs(c.m - b.m) / abs(b.m) * 100.0, 4) AS deviation_pct, abs(c.m - b.m) / abs(b.m) * 100.0 > 20 AS drifted
       FROM c JOIN b USING ("column")""",
)
def baseline_drift(spark, sf):
    lines = T.table(spark, sf, "lineitem").select("l_quantity", "l_extendedprice", "l_shipdate")
    past = lines.filter(F.col("l_shipdate") < T.timestamp("1998-01-01 00:00:00"))
    baseline = past.agg(
        F.array(
            F.struct(F.lit("l_quantity").alias("column"), F.avg("l_quantity").alias("baseline_mean")),
            F.struct(F.lit("l_extendedprice").alias("column"), (F.avg("l_extendedprice") / 2).alias("baseline_mean")),
        ).alias("r")
    ).selectExpr("inline(r)")
    return quality.baseline_drift(lines, baseline, ["l_quantity", "l_extendedprice"])


@query(
    "completeness_report",
    """WITH d AS (SELECT CAST(o_orderdate AS DATE) + CAST(day(o_orderdate) = 13 AS INTEGER) AS d FROM orders)
       SELECT CAST(20000 AS BIGINT) AS expected_count, count(*) AS actual_count,
              round(greatest(20000 - count(*), 0) / 20000.0 * 100.0, 1) AS missing_pct, min(d) AS first_date,
              max(d) AS last_date, datediff('day', min(d), max(d)) + 1 - count(DISTINCT d) AS missing_dates FROM d""",
)
def completeness_report(spark, sf):
    orders = T.moved_orders(spark, sf)
    return quality.completeness_report(orders, F.col("o_orderdate"), 20_000)


@query(
    "quality_metrics",
    f"""WITH r AS (SELECT event_id, user_id, value FROM {T.DIRTY_SQL}
                   UNION ALL SELECT event_id, user_id, value FROM {T.DIRTY_SQL} WHERE event_id % 10 = 0),
             g AS (SELECT event_id, user_id, value, count(*) AS n FROM r GROUP BY ALL)
        SELECT CAST(sum(n) AS BIGINT) AS total_records,
               round(coalesce(sum(n) FILTER (value IS NULL), 0) / sum(n), 6) AS value_null_rate,
               round(coalesce(sum(n) FILTER (user_id IS NULL), 0) / sum(n), 6) AS user_id_null_rate,
               round((sum(n) - count(*)) / sum(n), 6) AS duplicate_rate, (sum(n) - count(*)) / sum(n) > 0.01 AS duplicate_alert,
               'v1' AS schema_version, {AS_OF_SQL} AS measured_at FROM g""",
)
def quality_metrics(spark, sf):
    rows = T.dirty_events(spark, sf).select("event_id", "user_id", "value")
    doubled = rows.unionByName(rows.filter(F.col("event_id") % 10 == 0))
    return quality.quality_metrics(doubled, ["value", "user_id"], "v1", T.timestamp(AS_OF))


SUITE_SQL = f"""
  SELECT 'not_null' AS expectation, 'email' AS "column", count(*) FILTER (email IS NULL) AS unexpected_count FROM p
  UNION ALL SELECT 'between', 'age', count(*) FILTER (age < 0 OR age > 150) FROM p
  UNION ALL SELECT 'in_set', 'country', count(*) FILTER (country NOT IN ('US', 'UK', 'CA')) FROM p
  UNION ALL SELECT 'match_regex', 'email', count(*) FILTER (NOT regexp_matches(email, '{V.EMAIL_PATTERN}')) FROM p
  UNION ALL SELECT 'mean_between', 'revenue', CAST(CASE WHEN avg(revenue) BETWEEN 0 AND 10000 THEN 0 ELSE 1 END AS BIGINT) FROM p
  UNION ALL SELECT 'unique', 'id', CAST(coalesce(sum(n) FILTER (n > 1), 0) AS BIGINT)
            FROM (SELECT count(*) AS n FROM p GROUP BY id)
  UNION ALL SELECT 'unique', 'age', CAST(coalesce(sum(n) FILTER (n > 1), 0) AS BIGINT)
            FROM (SELECT count(*) AS n FROM p GROUP BY age)"""


def _suite(spark, sf):
    wanted = [
        quality.Expectation("not_null", "email"),
        quality.Expectation("unique", "id"),
        quality.Expectation("unique", "age"),
        quality.Expectation("between", "age", low=0, high=150),
        quality.Expectation("in_set", "country", allowed=("US", "UK", "CA")),
        quality.Expectation("match_regex", "email", pattern=V.EMAIL_PATTERN),
        quality.Expectation("mean_between", "revenue", low=0, high=10_000),
    ]
    return quality.expectations_suite(T.people(spark, sf), wanted)


@query(
    "expectations_suite",
    f"WITH p AS {T.PEOPLE_SQL} SELECT *, unexpected_count = 0 AS success FROM ({SUITE_SQL})",
)
def expectations_suite(spark, sf):
    return _suite(spark, sf)


@query(
    "suite_success",
    f"""WITH p AS {T.PEOPLE_SQL} SELECT bool_and(unexpected_count = 0) AS success,
        count(*) FILTER (unexpected_count <> 0) AS failed FROM ({SUITE_SQL})""",
)
def suite_success(spark, sf):
    return quality.suite_success(_suite(spark, sf))


CHAIN_SQL = f"""
  WITH raw AS (SELECT event_id, ts, user_id, value FROM {T.DIRTY_SQL}
               UNION ALL SELECT event_id, ts + INTERVAL 1 SECOND, user_id, value FROM {T.DIRTY_SQL} WHERE event_id % 10 = 0),
       ranged AS (SELECT * FROM raw WHERE user_id BETWEEN 1 AND 100000 AND value BETWEEN 0 AND 400),
       deduped AS (SELECT * FROM ranged QUALIFY row_number() OVER (PARTITION BY user_id, event_id ORDER BY ts) = 1),
       fresh AS (SELECT * FROM deduped WHERE ts >= {AS_OF_SQL} - INTERVAL 480 HOUR),
       stats AS (SELECT avg(value) AS m, stddev(value) AS s FROM fresh)"""


def _chain(spark, sf):
    rows = T.dirty_events(spark, sf).select("event_id", "ts", "user_id", "value")
    again = rows.filter(F.col("event_id") % 10 == 0).withColumn("ts", F.col("ts") + F.expr("interval 1 second"))
    config = {
        "critical_columns": ["event_id", "value"],
        "range_rules": {"user_id": (1, 100_000), "value": (0, 400)},
        "unique_columns": ["user_id", "event_id"],
        "timestamp_column": "ts",
        "max_age_hours": 480,
        "numeric_columns": ["value"],
        "date_column": "ts",
    }
    return quality.run_all_checks(rows.unionByName(again), config, T.timestamp(AS_OF))


@query(
    "run_all_checks",
    f"""{CHAIN_SQL}
        SELECT 1 AS step, 'nulls' AS "check", 'event_id' AS item, 0.0::DOUBLE AS measured, 'PASS' AS status
        UNION ALL SELECT 1, 'nulls', 'value', count(*) FILTER (value IS NULL),
               CASE WHEN count(*) FILTER (value IS NULL) / count(*) * 100.0 <= 5 THEN 'PASS' ELSE 'FAIL' END FROM raw
        UNION ALL SELECT 2, 'ranges', 'user_id', count(*) FILTER ((user_id BETWEEN 1 AND 100000) IS NOT TRUE),
               CASE WHEN count(*) FILTER ((user_id BETWEEN 1 AND 100000) IS NOT TRUE) > 0 THEN 'FAIL' ELSE 'PASS' END FROM raw
        UNION ALL SELECT 2, 'ranges', 'value', count(*) FILTER ((value BETWEEN 0 AND 400) IS NOT TRUE),
               CASE WHEN count(*) FILTER ((value BETWEEN 0 AND 400) IS NOT TRUE) > 0 THEN 'FAIL' ELSE 'PASS' END
               FROM raw WHERE user_id BETWEEN 1 AND 100000
        UNION ALL SELECT 3, 'uniqueness', 'user_id,event_id', (SELECT count(*) FROM ranged) - count(*),
               CASE WHEN (SELECT count(*) FROM ranged) > count(*) THEN 'FAIL' ELSE 'PASS' END FROM deduped
        UNION ALL SELECT 4, 'freshness', 'ts', round((epoch_us({AS_OF_SQL}) - epoch_us(max(ts))) / 3600000000.0, 4),
               CASE WHEN (epoch_us({AS_OF_SQL}) - epoch_us(max(ts))) / 3600000000.0 > 480 THEN 'STALE' ELSE 'PASS' END FROM deduped
        UNION ALL SELECT 5, 'anomalies', 'value', count(*) FILTER (value < m - 3 * s OR value > m + 3 * s),
               CASE WHEN count(*) FILTER (value < m - 3 * s OR value > m + 3 * s) > 0 THEN 'FAIL' ELSE 'PASS' END FROM fresh, stats
        UNION ALL SELECT 6, 'completeness', 'ts',
               datediff('day', min(CAST(ts AS DATE)), max(CAST(ts AS DATE))) + 1 - count(DISTINCT CAST(ts AS DATE)),
               CASE WHEN datediff('day', min(CAST(ts AS DATE)), max(CAST(ts AS DATE))) + 1 > count(DISTINCT CAST(ts AS DATE))
                    THEN 'FAIL' ELSE 'PASS' END FROM fresh""",
)
def run_all_checks(spark, sf):
    return _chain(spark, sf)[1]


@query("run_all_checks_clean", f"{CHAIN_SQL} SELECT event_id, ts, user_id, value FROM fresh")
def run_all_checks_clean(spark, sf):
    return _chain(spark, sf)[0].select("event_id", "ts", "user_id", "value")


@query("format_checks", f"SELECT page_id, regexp_matches(url, '{V.URL_PATTERN}') AS is_valid FROM pages")
def format_checks(spark, sf):
    return quality.format_checks(T.table(spark, sf, "pages"), {"url": V.URL_PATTERN}).select("page_id", "is_valid")


@query(
    "business_rules",
    """SELECT l_orderkey, l_linenumber, l_quantity, l_shipdate, concat_ws(',',
         CASE WHEN NOT l_extendedprice >= l_quantity * 10 THEN 'price_covers_quantity' END,
         CASE WHEN NOT (l_returnflag <> 'R' OR l_discount <= 0.05) THEN 'returned_means_small_discount' END) AS broken
       FROM lineitem""",
)
def business_rules(spark, sf):
    rules = {
        "price_covers_quantity": F.col("l_extendedprice") >= F.col("l_quantity") * 10,
        "returned_means_small_discount": (F.col("l_returnflag") != "R") | (F.col("l_discount") <= 0.05),
    }
    checked = quality.business_rules(T.table(spark, sf, "lineitem"), rules)
    return checked.select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_shipdate", F.array_join("failed_rules", ",").alias("broken")
    )


@query(
    "run_health",
    f"""SELECT event_type, count(*) AS runs, round(count(*) FILTER (value > 300) / count(*) * 100.0, 4) AS error_rate_pct,
        round(CAST(sum(user_id) AS DOUBLE) / sum(10 + event_id % 50), 4) AS rows_per_second,
        round(avg(10 + event_id % 50), 4) AS avg_latency_seconds, CAST(max(10 + event_id % 50) AS DOUBLE) AS max_latency_seconds,
        round((epoch_us({AS_OF_SQL}) - epoch_us(max(ts + to_seconds(10 + event_id % 50)))) / 3600000000.0, 4) AS hours_since_last
        FROM events GROUP BY event_type""",
)
def run_health(spark, sf):
    took = F.make_dt_interval(secs=(F.col("event_id") % 50 + 10))
    log = T.events(spark, sf).select(
        "event_type",
        F.col("ts").alias("started_at"),
        (F.col("ts") + took).alias("finished_at"),
        F.col("user_id").alias("rows_out"),
        (F.col("value") > 300).alias("failed"),
    )
    return quality.run_health(log, ["event_type"], T.timestamp(AS_OF))


@query(
    "reconcile_tables",
    f"""WITH a AS (SELECT CASE WHEN event_type = 'view' THEN -1 - event_id ELSE event_id END AS event_id, count(*) AS n,
                          CAST(sum(CAST(value AS DECIMAL(28,9)) + CAST(0.001 AS DECIMAL(28,9))) AS DOUBLE) AS v FROM events GROUP BY 1),
             b AS (SELECT CASE WHEN event_type = 'click' THEN -1 - event_id ELSE event_id END AS event_id, count(*) AS n,
                          CAST(sum(CAST(value AS DECIMAL(28,9)) + CAST(CASE WHEN event_id % 3 = 0 THEN 0.004 ELSE 0.001 END AS DECIMAL(28,9)))
                               AS DOUBLE) AS v FROM {T.DIRTY_SQL} GROUP BY 1)
        SELECT * FROM (
          SELECT coalesce(a.event_id, b.event_id) AS event_id, coalesce(a.n, 0) AS left_rows, coalesce(b.n, 0) AS right_rows,
                 a.v AS left_value, b.v AS right_value,
                 CASE WHEN b.n IS NULL THEN 'only_left' WHEN a.n IS NULL THEN 'only_right' WHEN a.n <> b.n THEN 'count_differs'
                      WHEN a.v IS DISTINCT FROM b.v THEN 'value_differs' END AS status
          FROM a FULL OUTER JOIN b ON a.event_id = b.event_id) WHERE status IS NOT NULL""",
)
def reconcile_tables(spark, sf):
    """Some ids exist on one side only, some values differ below a cent."""
    spread_shuffles(spark)

    def side(events, kind, extra):
        moved = F.when(F.col("event_type") == kind, -1 - F.col("event_id")).otherwise(F.col("event_id"))
        value = F.col("value").cast("decimal(28,9)") + extra.cast("decimal(28,9)")
        return events.select(moved.alias("event_id"), value.cast("double").alias("value"))

    cents = F.when(F.col("event_id") % 3 == 0, 0.004).otherwise(0.001)
    left = side(T.events(spark, sf), "view", F.lit(0.001))
    right = side(T.dirty_events(spark, sf), "click", cents)
    return quality.reconcile_tables(left, right, ["event_id"], ["value"])


@query(
    "distribution_profile",
    """SELECT q AS quantile, round(v, 6) AS value FROM (
         SELECT unnest([0.0, 0.25, 0.5, 0.9, 0.99, 1.0])::DOUBLE AS q,
                unnest(quantile_cont(l_extendedprice, [0.0, 0.25, 0.5, 0.9, 0.99, 1.0])) AS v FROM lineitem)""",
)
def distribution_profile(spark, sf):
    lines = T.table(spark, sf, "lineitem")
    profile = quality.distribution_profile(lines, "l_extendedprice", [0.0, 0.25, 0.5, 0.9, 0.99, 1.0])
    return profile.withColumn("value", F.round("value", 6))


@query(
    "value_histogram",
    """SELECT CAST(floor(value / 25.0) AS BIGINT) AS bucket, count(*) AS row_count, floor(value / 25.0) * 25.0 AS bucket_start
       FROM events GROUP BY floor(value / 25.0)""",
)
def value_histogram(spark, sf):
    return quality.value_histogram(T.events(spark, sf), "value", 25)


@query(
    "daily_trend",
    """SELECT CAST(o_orderdate AS DATE) AS date, count(*) AS row_count,
       CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS mean FROM orders GROUP BY ALL""",
)
def daily_trend(spark, sf):
    return quality.daily_trend(T.table(spark, sf, "orders"), F.col("o_orderdate"), "o_totalprice")


def event_failures() -> list[deadletter.Failure]:
    return [
        deadletter.Failure(F.col("value").isNull(), F.lit("Missing value"), "ValueError", V.VALIDATION_ERRORS),
        deadletter.Failure(
            F.col("value") < 0,
            F.concat(F.lit("Negative value for user "), F.col("user_id").cast("string")),
            "ConnectionError",
            V.PROCESSING_ERRORS,
            (("retryable", "true"),),
        ),
        deadletter.Failure(F.col("props").isNull(), F.lit("No properties"), "RuntimeError"),
    ]


FAILURE_SQL = """
  CASE WHEN value IS NULL THEN 'validation_errors' WHEN value < 0 THEN 'processing_errors'
       WHEN props IS NULL THEN 'unknown_errors' END"""


@query(
    "dead_letter_split",
    f"""SELECT event_id, coalesce({FAILURE_SQL}, 'passed') AS category,
        CASE WHEN value IS NULL THEN 'Missing value' WHEN value < 0 THEN 'Negative value for user ' || user_id
             WHEN props IS NULL THEN 'No properties' END AS error,
        CASE WHEN value IS NULL THEN 'ValueError' WHEN value < 0 THEN 'ConnectionError'
             WHEN props IS NULL THEN 'RuntimeError' END AS error_type,
        CASE WHEN value IS NOT NULL AND value < 0 THEN 'true' END AS retryable FROM {T.DIRTY_SQL}""",
)
def dead_letter_split(spark, sf):
    passed, entries = deadletter.dead_letter_split(T.dirty_events(spark, sf), event_failures(), T.timestamp(AS_OF))
    nothing = F.lit(None).cast("string")
    return entries.select(
        F.get_json_object("message", "$.event_id").cast("bigint").alias("event_id"),
        "category",
        "error",
        "error_type",
        F.try_element_at("metadata", F.lit("retryable")).alias("retryable"),
    ).unionByName(
        passed.select(
            "event_id",
            F.lit("passed").alias("category"),
            nothing.alias("error"),
            nothing.alias("error_type"),
            nothing.alias("retryable"),
        )
    )


@query(
    "dead_letter_reprocess",
    f"""SELECT count(*) FILTER (props IS NOT NULL) AS reprocessed, count(*) FILTER (props IS NULL) AS failed
        FROM {T.DIRTY_SQL} WHERE value < 0""",
)
def dead_letter_reprocess(spark, sf):
    rows = T.dirty_events(spark, sf).select("event_id", "user_id", "value", "props")
    _, entries = deadletter.dead_letter_split(rows, event_failures(), T.timestamp(AS_OF))
    fixed, still = deadletter.dead_letter_reprocess(
        entries,
        V.PROCESSING_ERRORS,
        rows.schema,
        lambda df: df.withColumn("value", F.abs("value")),
        event_failures(),
        T.timestamp(AS_OF),
    )
    return deadletter.reprocess_counts(fixed, still)


@query(
    "run_summary",
    f"""SELECT event_type, count(*) FILTER (props IS NOT NULL AND (value IS NULL OR value >= 0)) AS success,
        count(*) FILTER (props IS NULL OR value < 0) AS failed, count(*) FILTER (props IS NULL) AS failed_validation,
        count(*) FILTER (props IS NOT NULL AND value < 0) AS failed_processing FROM {T.DIRTY_SQL} GROUP BY event_type""",
)
def run_summary(spark, sf):
    rows = T.dirty_events(spark, sf).select(
        "event_type", F.col("event_id").alias("id"), F.col("ts").alias("timestamp"), F.col("props").alias("data"), "value"
    )
    failures = [
        *deadletter.required_field_failures(["id", "timestamp", "data"], (("source", "main"),)),
        deadletter.Failure(F.col("value") < 0, F.lit("Negative value"), "RuntimeError", V.PROCESSING_ERRORS),
    ]
    return deadletter.run_summary(rows, failures, "event_type")


@query(
    "recommend_with_fallback",
    f"""WITH i AS {T.ITEMS_SQL},
          w AS (SELECT CASE WHEN value > 60 THEN user_id ELSE -user_id END AS user_id, item, event_type FROM i),
          m AS (SELECT user_id, item, count(*) AS n FROM w WHERE event_type = 'purchase' GROUP BY user_id, item
                QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY n DESC, item) <= 3),
          r AS (SELECT user_id, item, count(*) AS n FROM w WHERE event_type = 'view' GROUP BY user_id, item
                QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY n DESC, item) <= 3),
          p AS (SELECT item, count(*) AS n FROM i GROUP BY item ORDER BY n DESC, item LIMIT 3),
          ml AS (SELECT user_id, array_to_string(list(item ORDER BY n DESC, item), ',') AS l FROM m GROUP BY user_id),
          rl AS (SELECT user_id, array_to_string(list(item ORDER BY n DESC, item), ',') AS l FROM r GROUP BY user_id),
          pl AS (SELECT array_to_string(list(item ORDER BY n DESC, item), ',') AS l FROM p)
        SELECT c_custkey AS user_id, coalesce(ml.l, rl.l, pl.l) AS recommendations,
               CASE WHEN ml.l IS NOT NULL THEN 'model' WHEN rl.l IS NOT NULL THEN 'rules' ELSE 'popular' END AS source_level
        FROM customer LEFT JOIN ml ON c_custkey = ml.user_id LEFT JOIN rl ON c_custkey = rl.user_id, pl""",
)
def recommend_with_fallback(spark, sf):
    items = T.items(spark, sf)
    # Weak events count for users that nobody serves, so that some users lack a level.
    strong = items.withColumn("user_id", F.when(F.col("value") > 60, F.col("user_id")).otherwise(-F.col("user_id")))
    model = deadletter.top_items_per_user(strong.filter("event_type = 'purchase'"), "user_id", "item")
    rules = deadletter.top_items_per_user(strong.filter("event_type = 'view'"), "user_id", "item")
    users = T.table(spark, sf, "customer").select(F.col("c_custkey").alias("user_id"))
    served = deadletter.recommend_with_fallback(users, model, rules, deadletter.popular_items(items, "item"))
    return served.withColumn("recommendations", F.array_join("recommendations", ","))
