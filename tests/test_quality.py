from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructType

from millrace.functions import columns as C
from millrace.functions import values as V
from millrace.operators import deadletter, quality, ranking


def as_of():
    return F.lit("2024-01-02 00:00:00").cast("timestamp_ntz")


def test_empty_table_reports_without_dividing_by_zero(spark):
    empty = spark.createDataFrame([], "id bigint, v double, ts timestamp_ntz")
    assert quality.null_report(empty, ["v"]).first().asDict() == {
        "column": "v", "null_count": 0, "null_percentage": None, "status": "EMPTY",
    }
    assert quality.freshness_check(empty, "ts", as_of()).first().status == "EMPTY"
    assert quality.uniqueness_report(empty, ["id"]).first().total_rows == 0
    assert quality.quality_metrics(empty, ["v"], "v1", as_of()).first().duplicate_rate is None
    assert quality.completeness_report(empty, F.col("ts"), 10).first().missing_pct == 100.0
    assert quality.zscore_anomalies(empty, "v").count() == 0
    assert quality.distribution_profile(empty, "v", [0.5]).first().value is None
    assert ranking.missing_dates(empty, F.col("ts")).count() == 0


def test_no_variance_means_no_anomalies(spark):
    same = spark.range(10).withColumn("v", F.lit(1.0))
    assert quality.zscore_anomalies(same, "v").count() == 0
    assert quality.zscore_anomalies(same.withColumn("v", F.lit(None).cast("double")), "v").count() == 0


def test_all_null_column_fails_its_null_check_and_leaves_no_clean_row(spark):
    df = spark.range(4).withColumn("v", F.lit(None).cast("double"))
    assert quality.null_report(df, ["v"]).first().status == "FAIL"
    clean, rejected = quality.range_split(df, {"v": (0, 1)})
    assert clean.count() == 0
    assert {row.range_errors[0] for row in rejected.collect()} == {"v:null"}


def test_range_report_can_count_like_a_chain_of_filters(spark):
    df = spark.createDataFrame([(1, 1), (9, 9), (1, 9)], "a int, b int")
    rules = {"a": (0, 5), "b": (0, 5)}
    assert [r.out_of_range for r in quality.range_report(df, rules).collect()] == [1, 2]
    assert [r.out_of_range for r in quality.range_report(df, rules, stacked=True).collect()] == [1, 1]


def test_email_without_at_has_no_domain_and_breaks_the_rule(spark):
    df = spark.createDataFrame([("a@b.com",), ("ab.com",), ("a@b@c.com",)], "email string")
    assert [r.d for r in df.select(C.email_domain("email").alias("d")).collect()] == ["b.com", None, "b"]
    checked = quality.format_checks(df, {"email": V.EMAIL_PATTERN})
    assert [r.is_valid for r in checked.collect()] == [True, False, False]


@pytest.mark.parametrize(
    ("pattern", "good", "bad"),
    [
        (V.IPV4_PATTERN, "192.168.0.255", "192.168.0.256"),
        (V.PHONE_PATTERN, "+44 (20) 7946-0018", "phone"),
        (V.URL_PATTERN, "https://a.example.com/x?y=1", "ftp://a.example.com"),
    ],
)
def test_formats(spark, pattern, good, bad):
    df = spark.createDataFrame([(good,), (bad,)], "text string")
    assert [r.is_valid for r in quality.format_checks(df, {"text": pattern}).collect()] == [True, False]


def test_null_breaks_a_rule(spark):
    df = spark.createDataFrame([(None,), (1,)], "v int")
    valid, invalid = quality.split_valid(df, [quality.Rule("positive", F.col("v") > 0)])
    assert valid.count() == 1
    assert invalid.first().failed_rules == ["positive"]
    assert invalid.first().error_type == "ValueError"


def test_schema_check_looks_at_rows_for_nullability(spark):
    df = spark.createDataFrame([(1, None)], "a bigint, b string")
    expected = StructType().add("a", LongType(), False).add("b", StringType(), False)
    assert {r.column: r.status for r in quality.schema_check(df, expected).collect()} == {"a": "ok", "b": "unexpected_nulls"}


def test_run_all_checks_can_raise_and_filter(spark):
    df = spark.createDataFrame([(1, None), (2, 1.0)], "id bigint, v double")
    config = {"critical_columns": ["v"], "on_fail": "raise"}
    with pytest.raises(quality.QualityError, match="nulls"):
        quality.run_all_checks(df, config, as_of())
    clean, report = quality.run_all_checks(df, {**config, "on_fail": "filter"}, as_of())
    assert [row.id for row in clean.collect()] == [2]
    assert report.first().status == "FAIL"


def test_run_all_checks_covers_referential_and_drops_anomalies(spark):
    parent = spark.createDataFrame([(n,) for n in range(20)], "pk bigint")
    df = spark.createDataFrame([(n, 1.0 + n % 2) for n in range(20)] + [(99, 1.0), (0, 1e6)], "fk bigint, v double")
    config = {
        "referential": (parent, "fk", "pk"), "numeric_columns": ["v"], "std_dev_threshold": 3.0, "drop_anomalies": True,
    }
    clean, report = quality.run_all_checks(df, config, as_of())
    assert {r.check: r.measured for r in report.collect()} == {"referential": 1.0, "anomalies": 1.0}
    assert clean.count() == 20


def test_exact_quantiles_agree_with_spark_percentile(spark):
    df = spark.range(10_001).select(F.pow(F.col("id") % 977, 2).alias("v"))
    quantiles = [0.0, 0.01, 0.333, 0.5, 0.999, 1.0]
    expected = df.agg(F.percentile("v", quantiles)).first()[0]
    got = {r.quantile: r.value for r in quality.distribution_profile(df, "v", quantiles).collect()}
    assert [got[q] for q in quantiles] == pytest.approx(expected)


def test_exact_quantiles_when_one_value_is_most_of_the_column(spark):
    df = spark.range(1000).select(F.when(F.col("id") < 900, 7.0).otherwise(F.col("id")).cast("double").alias("v"))
    got = {r.quantile: r.value for r in quality.distribution_profile(df, "v", [0.5, 0.95]).collect()}
    assert got == pytest.approx({0.5: 7.0, 0.95: 949.05})


def test_reconcile_names_each_difference(spark, rows):
    left = spark.createDataFrame([(1, 1.0), (2, 1.0), (3, 1.0), (3, 1.0), (4, 1.0)], "k int, v double")
    right = spark.createDataFrame([(2, 1.0), (3, 2.0), (4, 5.0), (5, 1.0)], "k int, v double")
    got = quality.reconcile_tables(left, right, ["k"], ["v"])
    assert rows(got, "k", "status") == [
        (1, "only_left"), (3, "count_differs"), (4, "value_differs"), (5, "only_right"),
    ]


def test_dead_letters_keep_the_whole_message_and_first_matching_failure(spark):
    df = spark.createDataFrame([(1, None, None), (2, -1.0, "x"), (3, 1.0, "y")], "id bigint, v double, s string")
    failures = [
        *deadletter.required_field_failures(["v", "s"], (("source", "main"),)),
        deadletter.Failure(F.col("v") < 0, F.lit("negative"), "ConnectionError", V.PROCESSING_ERRORS, (("retryable", "true"),)),
    ]
    passed, entries = deadletter.dead_letter_split(df, failures, as_of(), {"source": "all"})
    assert [r.id for r in passed.collect()] == [3]
    got = {r.message: r for r in entries.collect()}
    missing = got['{"id":1,"v":null,"s":null}']
    assert (missing.error, missing.category, missing.metadata) == (
        "Missing required field: v", V.VALIDATION_ERRORS, {"source": "main"},
    )
    assert got['{"id":2,"v":-1.0,"s":"x"}'].metadata == {"source": "all", "retryable": "true"}
    assert missing.timestamp == datetime(2024, 1, 2)


def test_dead_letters_are_written_by_category(spark, folder):
    df = spark.createDataFrame([(1, -1.0), (2, None)], "id bigint, v double")
    failures = [deadletter.Failure(F.col("v").isNull(), F.lit("no v"), "ValueError", V.VALIDATION_ERRORS),
                deadletter.Failure(F.col("v") < 0, F.lit("negative"), "RuntimeError")]
    _, entries = deadletter.dead_letter_split(df, failures, as_of())
    deadletter.write_dead_letters(entries, f"{folder}/dlq")
    read = spark.read.parquet(f"{folder}/dlq").filter(F.col("category") == V.UNKNOWN_ERRORS)
    fixed, still = deadletter.dead_letter_reprocess(
        read, V.UNKNOWN_ERRORS, df.schema, lambda rows: rows.withColumn("v", F.abs("v")), failures, as_of()
    )
    assert [tuple(r) for r in fixed.collect()] == [(1, 1.0)]
    assert deadletter.reprocess_counts(fixed, still).first().asDict() == {"reprocessed": 1, "failed": 0}


def test_stale_data_can_stop_a_run_and_reports_are_kept(spark, folder):
    df = spark.createDataFrame([(datetime(2023, 12, 1),)], "ts timestamp_ntz")
    report = quality.freshness_check(df, "ts", as_of())
    with pytest.raises(quality.QualityError, match="STALE"):
        quality.require_pass(report)
    quality.require_pass(quality.freshness_check(df, "ts", as_of(), max_age_hours=10_000))
    for _ in range(2):
        quality.record_report(report, folder + "/history", as_of())
    assert spark.read.parquet(folder + "/history").count() == 2
