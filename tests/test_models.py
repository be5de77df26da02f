from __future__ import annotations

import math
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from millrace.operators import aggregates
from millrace.operators.deadletter import Failure
from millrace.plans import layers, serving, training


@pytest.fixture(scope="module")
def features(spark):
    return spark.range(200).select(
        F.col("id").alias("customer_id"),
        (F.col("id") % 17 + 1.0).alias("avg_purchase_value"),
        (F.col("id") % 5 + 1).alias("purchase_frequency"),
        (F.col("id") % 90).alias("days_since_last_purchase"),
        (F.col("id") % 23 * 3.0).alias("total_lifetime_value"),
        (F.col("id") % 4).alias("num_categories_purchased"),
        (F.col("id") % 17 * 2.0).alias(training.LABEL),
    )


def test_model_repeats_with_its_seed_and_survives_saving(spark, features, folder):
    train, test = training.train_test_split(features, "customer_id")
    assert train.count() + test.count() == 200
    errors = []
    for _ in range(2):
        model = training.train_revenue_model(train, num_trees=10)
        errors.append(training.rmse(model.transform(test), training.LABEL, "prediction").first().rmse)
    assert errors[0] == errors[1] and math.isfinite(errors[0])
    training.save_model(model, folder + "/model")
    loaded = training.load_model(folder + "/model").transform(test)
    assert training.rmse(loaded, training.LABEL, "prediction").first().rmse == errors[0]


def test_split_does_not_depend_on_partitioning(features):
    one, _ = training.train_test_split(features.coalesce(1), "customer_id")
    many, _ = training.train_test_split(features.repartition(7), "customer_id")
    assert sorted(r[0] for r in one.select("customer_id").collect()) == sorted(r[0] for r in many.select("customer_id").collect())


def test_features_stop_at_the_cutoff(spark):
    bought = spark.createDataFrame(
        [
            (1, 10, datetime(2023, 12, 30), 5.0, "a"),
            (1, 10, datetime(2023, 12, 30), 7.0, "b"),
            (1, 11, datetime(2024, 1, 1), 100.0, "c"),
            (1, 12, datetime(2024, 2, 1), 900.0, "c"),
            (2, 13, datetime(2024, 1, 5), 50.0, "a"),
        ],
        "customer_id int, order_id int, purchased_at timestamp_ntz, amount double, category string",
    )
    (row,) = training.customer_features(bought, F.lit(date(2024, 1, 1))).collect()
    assert (row.customer_id, row.purchase_frequency, row.num_categories_purchased) == (1, 1, 2)
    assert (row.total_lifetime_value, row.days_since_last_purchase, row.next_month_revenue) == (12.0, 2, 100.0)


def test_layers_are_written(spark, folder):
    raw = spark.createDataFrame([(1, 1, 5.0), (1, 2, 6.0), (2, 1, None)], "k int, at int, v double")
    built = layers.medallion_tables(
        raw,
        [Failure(F.col("v").isNull(), F.lit("no value"), "ValueError", "validation_errors")],
        ["k"], ["at"],
        lambda silver: silver.agg(F.sum("v").alias("total")),
        F.lit(datetime(2024, 1, 1)), F.lit(date(2024, 1, 1)),
    )
    layers.write_medallion(spark, built, folder + "/lake")
    counts = {name: spark.read.parquet(f"{folder}/lake/{name}").count() for name in ("bronze", "silver", "rejected", "gold")}
    assert counts == {"bronze": 3, "silver": 1, "rejected": 1, "gold": 1}
    assert spark.read.parquet(folder + "/lake/gold").first().total == 6.0


def test_cohorts_count_whole_months(spark, rows):
    bought = spark.createDataFrame(
        [(1, datetime(2024, 1, 31), 10.0), (1, datetime(2024, 2, 1), 20.0), (2, datetime(2024, 1, 1), 30.0), (3, datetime(2024, 2, 9), 1.0)],
        "c int, at timestamp_ntz, v double",
    )
    got = aggregates.cohort_retention(bought, "c", "at", "v")
    assert rows(got, "cohort_month", "months_since", "active_customers", "cohort_size", "retention_rate") == [
        (date(2024, 1, 1), 0, 2, 2, 100.0), (date(2024, 1, 1), 1, 1, 2, 50.0), (date(2024, 2, 1), 0, 1, 1, 100.0),
    ]


def test_serving_adds_history_and_recent_windows(spark, rows):
    history = spark.createDataFrame([(1, date(2024, 1, 1), 5.0, 1), (1, date(2024, 1, 2), 7.0, 1)], "user_id int, date date, total_revenue double, event_count bigint")
    recent = spark.createDataFrame([(1, datetime(2024, 1, 2), 7.5, 2), (2, datetime(2024, 1, 3), None, 1)], "user_id int, window_start timestamp_ntz, total_revenue double, event_count bigint")
    got = aggregates.serve_merged_view(history, recent, F.lit(date(2024, 1, 2)))
    assert rows(got) == [(1, 12.5, 3), (2, 0.0, 1)]


def test_online_store_has_the_newest_row(spark, rows):
    offline = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (2, 1, "c")], "k int, at int, v string")
    assert rows(serving.online_features(offline, "k", "at")) == [(1, 2, "b"), (2, 1, "c")]
