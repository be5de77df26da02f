"""Layers, features, split, model and error over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.catalog import checks
from millrace.catalog import tables as T
from millrace.catalog.registry import query
from millrace.functions import columns as C
from millrace.operators import aggregates
from millrace.operators.quality import split_valid, user_event_rules
from millrace.plans import layers, serving, training
from millrace.session import materialize, spread_shuffles

AS_OF = "2000-01-01"

PURCHASES_SQL = """(SELECT o_custkey AS customer_id, o_orderkey AS order_id, o_orderdate AS purchased_at,
  CAST(l_extendedprice AS DECIMAL(18,2)) AS amount, p_type AS category
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey)"""


def features_sql(as_of: str) -> str:
    at = f"TIMESTAMP '{as_of} 00:00:00'"
    return f"""
      SELECT customer_id, CAST(sum(amount) FILTER (purchased_at < {at}) AS DOUBLE)
               / count(DISTINCT order_id) FILTER (purchased_at < {at}) AS avg_purchase_value,
             count(DISTINCT order_id) FILTER (purchased_at < {at}) AS purchase_frequency,
             datediff('day', CAST(max(purchased_at) FILTER (purchased_at < {at}) AS DATE), DATE '{as_of}')
               AS days_since_last_purchase,
             CAST(sum(amount) FILTER (purchased_at < {at}) AS DOUBLE) AS total_lifetime_value,
             count(DISTINCT category) FILTER (purchased_at < {at}) AS num_categories_purchased,
             coalesce(CAST(sum(amount) FILTER (purchased_at >= {at} AND purchased_at < {at} + INTERVAL 1 MONTH) AS DOUBLE), 0.0)
               AS next_month_revenue
      FROM {PURCHASES_SQL} GROUP BY customer_id HAVING count(*) FILTER (purchased_at < {at}) > 0"""


def purchases(spark, sf):
    """Every line with its order and part: the settings hold for what is made of it, too."""
    spread_shuffles(spark)
    lines, orders, parts = (T.table(spark, sf, n) for n in ("lineitem", "orders", "part"))
    return (
        lines.join(orders, lines.l_orderkey == orders.o_orderkey)
        .join(parts, lines.l_partkey == parts.p_partkey)
        .select(
            F.col("o_custkey").alias("customer_id"),
            F.col("o_orderkey").alias("order_id"),
            F.col("o_orderdate").alias("purchased_at"),
            F.col("l_extendedprice").alias("amount"),
            F.col("p_type").alias("category"),
        )
    )


def _features(spark, sf, as_of=AS_OF):
    return training.customer_features(purchases(spark, sf), F.lit(as_of).cast("date"))


@query("assemble_features", features_sql(AS_OF))
def assemble_features(spark, sf):
    assembled = training.assembler().transform(_features(spark, sf))
    return assembled.filter(F.col("features").isNotNull()).drop("features")


@query(
    "train_test_split",
    """SELECT o_orderkey, CASE WHEN CAST(('0x' || substr(sha256(CAST(o_orderkey AS VARCHAR)), 1, 8)) AS BIGINT) % 100 < 80
       THEN 'train' ELSE 'test' END AS part FROM orders""",
)
def train_test_split(spark, sf):
    train, test = training.train_test_split(T.table(spark, sf, "orders").select("o_orderkey"), "o_orderkey")
    return train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))


@query(
    "train_revenue_model",
    f"""WITH f AS (SELECT customer_id, next_month_revenue,
                     CAST(('0x' || substr(sha256(CAST(customer_id AS VARCHAR)), 1, 8)) AS BIGINT) % 100 < {training.TRAIN_SHARE_PCT} AS train
              FROM ({features_sql(AS_OF)}))
        SELECT customer_id, next_month_revenue, true AS in_range FROM f WHERE NOT train""",
)
def train_revenue_model(spark, sf):
    """A forest's prediction is a mean of training labels, so it lies within their range."""
    train, test = training.train_test_split(materialize(_features(spark, sf), "features"), "customer_id")
    model = training.train_revenue_model(train)
    low, high = train.agg(F.min(training.LABEL), F.max(training.LABEL)).first()
    in_range = F.col("prediction").between(low - 1e-6, high + 1e-6)
    return model.transform(test).select("customer_id", training.LABEL, in_range.alias("in_range"))


@query(
    "rmse",
    f"""SELECT round(sqrt(avg(pow(next_month_revenue - avg_purchase_value, 2))), 4) AS rmse, count(*) AS rows
        FROM ({features_sql(AS_OF)})""",
)
def rmse(spark, sf):
    return training.rmse(_features(spark, sf), training.LABEL, "avg_purchase_value", digits=4)


MEDALLION_SQL = f"""
  SELECT event_type AS store_id, user_id AS product_category, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total_sales,
         count(*) AS num_transactions,
         CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS avg_transaction_value,
         count(DISTINCT user_id) AS unique_customers, max(value) AS max_transaction, min(value) AS min_transaction
  FROM (SELECT * FROM (SELECT * FROM {T.DIRTY_SQL}
        UNION ALL SELECT event_id, ts + INTERVAL 1 SECOND, user_id, event_type, value + 1, props FROM {T.DIRTY_SQL}
                  WHERE event_id % 10 = 0)
        WHERE value >= 0 AND props IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY ts DESC) = 1) GROUP BY event_type, user_id"""


@query("medallion_tables", MEDALLION_SQL)
def medallion_tables(spark, sf):
    rows = T.dirty_events(spark, sf)
    again = rows.filter(F.col("event_id") % 10 == 0).withColumns(
        {"ts": F.col("ts") + F.expr("interval 1 second"), "value": F.col("value") + 1}
    )

    def gold(silver):
        renamed = silver.select(
            F.col("event_type").alias("store_id"),
            F.col("user_id").alias("product_category"),
            F.col("value").alias("amount"),
            F.col("event_id").alias("transaction_id"),
            F.col("user_id").alias("customer_id"),
        )
        return aggregates.daily_sales_summary(renamed)

    built = layers.medallion_tables(
        rows.unionByName(again),
        checks.event_failures(),
        ["event_id"],
        ["ts"],
        gold,
        T.timestamp("2024-02-01 06:00:00"),
        F.lit("2024-02-01").cast("date"),
    )
    return built.gold


@query(
    "feature_store_build",
    f"""WITH f AS (SELECT *, DATE '1999-01-01' AS as_of FROM ({features_sql('1999-01-01')})
                   UNION ALL SELECT *, DATE '2000-01-01' FROM ({features_sql('2000-01-01')}))
        SELECT * FROM f QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY as_of DESC) = 1""",
)
def feature_store_build(spark, sf):
    bought, offline = materialize(purchases(spark, sf), "purchases"), None
    for as_of in ("1999-01-01", "2000-01-01"):
        built = training.customer_features(bought, F.lit(as_of).cast("date")).withColumn("as_of", F.lit(as_of).cast("date"))
        offline = built if offline is None else offline.unionByName(built)
    return serving.online_features(offline, "customer_id", "as_of")


@query(
    "valid_people",
    f"""SELECT id, email, split_part(email, '@', 2) AS domain FROM {T.PEOPLE_SQL}
        WHERE id IN (SELECT id FROM ({checks.RULES_SQL}) WHERE failed_rules = '')""",
)
def valid_people(spark, sf):
    valid, _ = split_valid(T.people(spark, sf), user_event_rules(T.timestamp(checks.AS_OF)))
    return valid.select("id", "email", C.email_domain("email").alias("domain"))
