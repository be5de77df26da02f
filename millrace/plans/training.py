"""Customer features, split, random forest and error."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import columns as C

# Feature columns and label of the revenue model.
FEATURES = (
    "avg_purchase_value",
    "purchase_frequency",
    "days_since_last_purchase",
    "total_lifetime_value",
    "num_categories_purchased",
)
LABEL = "next_month_revenue"
NUM_TREES = 100
TRAIN_SHARE_PCT = 80


def customer_features(purchases: DataFrame, as_of: Column) -> DataFrame:
    """Features of every customer from purchases before ``as_of``.

    ``purchases`` has customer_id, order_id, purchased_at, amount, category.
    The label is the spend in the month after. Rows shrink to one per customer,
    order and category first, so the two distinct counts copy those and not
    the purchases.
    """
    before = F.col("purchased_at") < as_of
    after = (F.col("purchased_at") >= as_of) & (F.col("purchased_at") < F.add_months(as_of, 1).cast("timestamp_ntz"))
    money = F.col("amount").cast(C.MONEY)
    lines = (
        purchases.filter(before | after)
        .groupBy("customer_id", "order_id", "category")
        .agg(
            F.sum(F.when(before, money)).alias("spent"),
            F.sum(F.when(after, money)).alias("next"),
            F.max(F.when(before, F.col("purchased_at"))).alias("last_at"),
        )
    )
    seen = F.col("spent").isNotNull()
    totals = lines.groupBy("customer_id").agg(
        F.sum("spent").cast("double").alias("total_lifetime_value"),
        F.sum("next").cast("double").alias("next"),
        F.count_distinct(F.when(seen, F.col("order_id"))).alias("purchase_frequency"),
        F.count_distinct(F.when(seen, F.col("category"))).alias("num_categories_purchased"),
        F.max("last_at").alias("last_at"),
    )
    return totals.filter(F.col("purchase_frequency") > 0).select(
        "customer_id",
        F.try_divide("total_lifetime_value", F.col("purchase_frequency").cast("double")).alias("avg_purchase_value"),
        "purchase_frequency",
        F.date_diff(as_of, F.col("last_at").cast("date")).cast("bigint").alias("days_since_last_purchase"),
        "total_lifetime_value",
        "num_categories_purchased",
        F.coalesce("next", F.lit(0.0)).alias(LABEL),
    )


def assembler(features: Sequence[str] = FEATURES) -> VectorAssembler:
    """One vector per row; a row with a missing feature stops the job instead of vanishing."""
    return VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="error")


def train_test_split(df: DataFrame, key: str, train_pct: int = TRAIN_SHARE_PCT) -> tuple[DataFrame, DataFrame]:
    """Split by a hash of the key: the same rows on any cluster and any run."""
    in_train = C.hash_bucket(key, 100) < train_pct
    return df.filter(in_train), df.filter(~in_train)


def train_revenue_model(
    train: DataFrame,
    features: Sequence[str] = FEATURES,
    label: str = LABEL,
    num_trees: int = NUM_TREES,
    seed: int = 42,
    max_depth: int = 5,
) -> PipelineModel:
    """Fit the assembler and a random forest; trees grow level by level on Spark."""
    forest = RandomForestRegressor(
        featuresCol="features", labelCol=label, numTrees=num_trees, seed=seed, maxDepth=max_depth
    )
    return Pipeline(stages=[assembler(features), forest]).fit(train)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def rmse(df: DataFrame, label: str, prediction: str, digits: int = 6) -> DataFrame:
    """Root mean squared error and row count, as one row."""
    error = F.col(label) - F.col(prediction)
    return df.agg(F.round(F.sqrt(F.avg(error * error)), digits).alias("rmse"), F.count("*").alias("rows"))
