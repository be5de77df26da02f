"""The given tables in the shapes the operators expect.

Defects are injected into some rows by arithmetic on their ids; every view
keeps the whole table. The SQL constants say the same for the oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.sources.batch import scan_parquet


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return scan_parquet(spark, f"{sf}/{name}.parquet")


def timestamp(text: str):
    return F.lit(text).cast("timestamp_ntz")


SALES_SQL = """(
  SELECT l_suppkey AS store_id, p_brand AS product_category, CAST(l_extendedprice AS DECIMAL(18,2)) AS amount,
         l_orderkey AS transaction_id, o_custkey AS customer_id, o_orderdate AS sold_at
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey)"""


def sales(spark: SparkSession, sf: str) -> DataFrame:
    lines, orders, parts = (table(spark, sf, n) for n in ("lineitem", "orders", "part"))
    return (
        lines.join(orders, lines.l_orderkey == orders.o_orderkey)
        .join(parts, lines.l_partkey == parts.p_partkey)
        .select(
            F.col("l_suppkey").alias("store_id"),
            F.col("p_brand").alias("product_category"),
            F.col("l_extendedprice").alias("amount"),
            F.col("l_orderkey").alias("transaction_id"),
            F.col("o_custkey").alias("customer_id"),
            F.col("o_orderdate").alias("sold_at"),
        )
    )


ITEMS_SQL = "(SELECT event_id, ts, user_id, event_type, value, props ->> '$.k' AS item FROM events)"


def events(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events")


def items(spark: SparkSession, sf: str) -> DataFrame:
    return events(spark, sf).withColumn("item", F.get_json_object("props", "$.k")).drop("props")


def moved_orders(spark: SparkSession, sf: str) -> DataFrame:
    """Orders of the 13th a day later, so that every 13th is missing."""
    late = (F.dayofmonth("o_orderdate") == 13).cast("int")
    return table(spark, sf, "orders").withColumn("o_orderdate", F.date_add("o_orderdate", late))


def signed_customers(spark: SparkSession, sf: str) -> DataFrame:
    """Customers whose key carries the sign of their balance: orders of the others lack a parent."""
    return table(spark, sf, "customer").withColumn("c_custkey", (F.signum("c_acctbal") * F.col("c_custkey")).cast("bigint"))


DIRTY_SQL = """(
  SELECT event_id, ts, user_id, event_type,
         CASE WHEN event_id % 17 = 0 THEN NULL WHEN event_id % 23 = 0 THEN -value ELSE value END AS value,
         CASE WHEN event_id % 50 = 0 THEN NULL ELSE props END AS props
  FROM events)"""


def dirty_events(spark: SparkSession, sf: str) -> DataFrame:
    """Events with NULL and negative values and NULL properties."""
    event = F.col("event_id")
    return events(spark, sf).withColumns(
        {
            "value": F.when(event % 17 != 0, F.when(event % 23 == 0, -F.col("value")).otherwise(F.col("value"))),
            "props": F.when(event % 50 != 0, F.col("props")),
        }
    )


RETRIED_SQL = """(
  SELECT event_id, ts, user_id, event_type, value FROM events
  UNION ALL
  SELECT event_id, ts + INTERVAL 1 SECOND, user_id, event_type, value + 1 FROM events WHERE event_id % 10 = 0)"""


def retried_events(spark: SparkSession, sf: str) -> DataFrame:
    """Events plus a late second delivery of every tenth."""
    base = events(spark, sf).drop("props")
    again = base.filter(F.col("event_id") % 10 == 0).withColumns(
        {"ts": F.col("ts") + F.expr("interval 1 second"), "value": F.col("value") + 1}
    )
    return base.unionByName(again)


PEOPLE_SQL = """(
  SELECT c_custkey AS id, split_part(c_name, '#', 1) AS first_name, split_part(c_name, '#', 2) AS last_name,
         CASE WHEN c_custkey % 13 = 0 THEN '' ELSE lower(replace(c_name, '#', '.')) || '@' END
           || CASE WHEN c_custkey % 13 = 0 THEN lower(replace(c_name, '#', '.')) ELSE '' END
           || lower(replace(n_name, '_', '-')) || '.com' AS email,
         CAST(c_custkey % 170 AS BIGINT) AS age, CAST(1940 + c_custkey % 70 AS BIGINT) AS birth_year,
         c_acctbal > 5000 AS is_premium, c_acctbal AS revenue, c_mktsegment AS segment,
         ['US','UK','CA','AU','DE','FR','BR','JP'][CAST(c_nationkey % 8 + 1 AS INTEGER)] AS country,
         TIMESTAMP '2020-01-01' + CAST(c_custkey % 2000 AS INTEGER) * INTERVAL 1 DAY AS signup_date
  FROM customer JOIN nation ON c_nationkey = n_nationkey)"""


def people(spark: SparkSession, sf: str) -> DataFrame:
    """Customers as person records; some e-mails lack their @."""
    customer, nation = table(spark, sf, "customer"), table(spark, sf, "nation")
    local = F.lower(F.replace("c_name", F.lit("#"), F.lit(".")))
    at = F.when(F.col("c_custkey") % 13 == 0, "").otherwise("@")
    codes = F.array(*[F.lit(c) for c in ("US", "UK", "CA", "AU", "DE", "FR", "BR", "JP")])
    return customer.join(nation, customer.c_nationkey == nation.n_nationkey).select(
        F.col("c_custkey").alias("id"),
        F.split_part("c_name", F.lit("#"), F.lit(1)).alias("first_name"),
        F.split_part("c_name", F.lit("#"), F.lit(2)).alias("last_name"),
        F.concat(local, at, F.lower(F.replace("n_name", F.lit("_"), F.lit("-"))), F.lit(".com")).alias("email"),
        (F.col("c_custkey") % 170).alias("age"),
        (F.col("c_custkey") % 70 + 1940).alias("birth_year"),
        (F.col("c_acctbal") > 5000).alias("is_premium"),
        F.col("c_acctbal").alias("revenue"),
        F.col("c_mktsegment").alias("segment"),
        F.element_at(codes, (F.col("c_nationkey") % 8 + 1).cast("int")).alias("country"),
        (timestamp("2020-01-01 00:00:00") + F.make_dt_interval(days=(F.col("c_custkey") % 2000).cast("int"))).alias(
            "signup_date"
        ),
    )


UNKEYED_ORDERS_SQL = """(
  SELECT o_orderkey, CASE WHEN o_orderkey % 29 = 0 THEN NULL ELSE o_custkey END AS o_custkey, o_totalprice FROM orders)"""


def unkeyed_orders(spark: SparkSession, sf: str) -> DataFrame:
    """Orders, some without a customer key."""
    key = F.when(F.col("o_orderkey") % 29 != 0, F.col("o_custkey"))
    return table(spark, sf, "orders").select("o_orderkey", key.alias("o_custkey"), "o_totalprice")


CHANGES_SQL = """(
  SELECT user_id AS id, event_id AS "offset", epoch_us(ts) // 1000 AS ts_ms, event_type AS name, value AS email_score,
         CASE event_type WHEN 'signup' THEN 'c' WHEN 'error' THEN 'd' ELSE 'u' END AS op
  FROM events)"""


def changes(spark: SparkSession, sf: str) -> DataFrame:
    """Events as change-data envelopes of their users."""
    image = F.struct(F.col("user_id").alias("id"), F.col("event_type").alias("name"), F.col("value").alias("email_score"))
    op = F.when(F.col("event_type") == "signup", "c").when(F.col("event_type") == "error", "d").otherwise("u")
    return events(spark, sf).select(
        F.when(op != "c", image).alias("before"),
        F.when(op != "d", image).alias("after"),
        op.alias("op"),
        F.unix_millis(F.col("ts").cast("timestamp")).alias("ts_ms"),
        F.col("event_id").alias("offset"),
    )


TRANSITIONS_SQL = """(
  SELECT user_id AS entity, event_id AS position,
         CASE event_type WHEN 'signup' THEN 'confirmed' WHEN 'view' THEN 'shipped' WHEN 'purchase' THEN 'delivered'
                         WHEN 'error' THEN 'cancelled' ELSE 'returned' END AS wanted,
         'k' || CAST(event_id % 3 AS VARCHAR) AS token
  FROM events)"""


def wanted_status(kind):
    return (
        F.when(kind == "signup", "confirmed")
        .when(kind == "view", "shipped")
        .when(kind == "purchase", "delivered")
        .when(kind == "error", "cancelled")
        .otherwise("returned")
    )


def transitions(spark: SparkSession, sf: str) -> DataFrame:
    """Events as requested status changes of their user's order."""
    return events(spark, sf).select(
        F.col("user_id").alias("entity"),
        F.col("event_id").alias("position"),
        wanted_status(F.col("event_type")).alias("wanted"),
        F.concat(F.lit("k"), (F.col("event_id") % 3).cast("string")).alias("token"),
    )


MESSAGES_SQL = """(
  SELECT event_id, 'events' AS topic, user_id % 3 AS "partition", event_id AS "offset", user_id, event_type FROM events
  UNION ALL
  SELECT event_id, 'events' AS topic, user_id % 3 AS "partition", event_id + 1000000000 AS "offset", user_id, event_type
  FROM events WHERE event_type = 'purchase')"""


def messages(spark: SparkSession, sf: str) -> DataFrame:
    """Events as Kafka messages; purchases were produced twice."""
    base = events(spark, sf).select(
        "event_id",
        F.lit("events").alias("topic"),
        (F.col("user_id") % 3).alias("partition"),
        F.col("event_id").alias("offset"),
        "user_id",
        "event_type",
    )
    again = base.filter(F.col("event_type") == "purchase").withColumn("offset", F.col("offset") + 1_000_000_000)
    return base.unionByName(again)
