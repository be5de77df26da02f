"""Projections, joins, aggregations and ranking over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.catalog import tables as T
from millrace.catalog.registry import query
from millrace.functions import columns as C
from millrace.functions import values as V
from millrace.operators import aggregates, joins, lateness, ranking, transform
from millrace.session import spread_shuffles
from millrace.streaming import views


@query(
    "add_audit_columns",
    "SELECT o_orderkey, o_totalprice, DATE '2024-02-01' AS processing_date,"
    " TIMESTAMP '2024-02-01 06:00:00' AS processed_at FROM orders",
)
def add_audit_columns(spark, sf):
    orders = T.table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return transform.add_audit_columns(orders, T.timestamp("2024-02-01 06:00:00"), F.lit("2024-02-01").cast("date"))


@query(
    "deterministic_projection",
    f"""SELECT id AS user_id, first_name || ' ' || last_name AS full_name,
        CASE WHEN contains(email, '@') THEN split_part(email, '@', 2) END AS email_domain,
        2024 - birth_year AS age, CASE WHEN is_premium THEN 'premium' ELSE 'basic' END AS account_type,
        strftime(signup_date, '%Y-%m-%d') AS created_date
        FROM {T.PEOPLE_SQL}""",
)
def deterministic_projection(spark, sf):
    people = T.people(spark, sf).withColumn("created_at", F.date_format("signup_date", "yyyy-MM-dd'T'HH:mm:ss"))
    return transform.deterministic_projection(people, F.lit("2024-06-01").cast("date"), with_created_date=True)


@query(
    "suspicious_filter",
    "SELECT event_id, user_id, value, event_type FROM events WHERE value > 300 OR regexp_matches(event_type, 'error')",
)
def suspicious_filter(spark, sf):
    rows = T.events(spark, sf).select("event_id", "user_id", "value", "event_type")
    return transform.suspicious_filter(rows, "value", "event_type", limit=300.0, pattern="error")


@query(
    "recent_window_filter",
    "SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate >= DATE '2001-08-01' - INTERVAL 90 DAY",
)
def recent_window_filter(spark, sf):
    orders = T.table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    return transform.recent_window_filter(orders, "o_orderdate", F.lit("2001-08-01").cast("date"), 90)


@query(
    "split_by_operation",
    f"""SELECT CASE WHEN op = 'd' THEN 'delete' ELSE 'upsert' END AS action, id,
        CASE WHEN op = 'd' THEN NULL ELSE name END AS name FROM {T.CHANGES_SQL}""",
)
def split_by_operation(spark, sf):
    upserts, deletes = transform.split_by_operation(T.changes(spark, sf))
    return upserts.select(F.lit("upsert").alias("action"), "id", "name").unionByName(
        deletes.select(F.lit("delete").alias("action"), "id", F.lit(None).cast("string").alias("name"))
    )


@query(
    "record_transform",
    "SELECT event_id, user_id, TIMESTAMP '2024-02-01 00:00:00' AS processed_at, '1.0' AS pipeline_version FROM events",
)
def record_transform(spark, sf):
    rows = T.events(spark, sf).select("event_id", "user_id")
    constants = {"processed_at": T.timestamp("2024-02-01 00:00:00"), "pipeline_version": F.lit("1.0")}
    return transform.record_transform(rows, constants)


@query("drop_null_rows", f"SELECT event_id, value FROM {T.DIRTY_SQL} WHERE value IS NOT NULL AND props IS NOT NULL")
def drop_null_rows(spark, sf):
    return transform.drop_null_rows(T.dirty_events(spark, sf), ["value", "props"]).select("event_id", "value")


@query(
    "similar_items",
    f"""SELECT user_id, time_bucket(INTERVAL 1 DAY, ts) AS window_start,
        array_to_string(list_transform(list_slice(list(item ORDER BY ts, event_id), 1, 5), lambda x: 'rec_' || x), ',')
          AS recommended
        FROM {T.ITEMS_SQL} GROUP BY ALL""",
)
def similar_items(spark, sf):
    first = aggregates.first_items(T.items(spark, sf), "ts", "user_id", "item", "event_id", "1 day")
    return first.select("user_id", "window_start", F.array_join(C.similar_items("items"), ",").alias("recommended"))


@query(
    "join_back_aggregate",
    """SELECT o_orderkey, o_custkey, o_totalprice,
       CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) OVER (PARTITION BY o_custkey) AS DOUBLE) AS customer_total,
       min(o_orderdate) OVER (PARTITION BY o_custkey) AS first_order FROM orders""",
)
def join_back_aggregate(spark, sf):
    orders = T.table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    sums = [C.money_sum("o_totalprice").alias("customer_total"), F.min("o_orderdate").alias("first_order")]
    return joins.join_back_aggregate(orders, ["o_custkey"], sums).drop("o_orderdate")


@query(
    "fraud_interval_join",
    """WITH velocity AS (
         SELECT user_id, time_bucket(INTERVAL 1 DAY, ts) AS w, count(*) AS n,
                CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS s FROM events GROUP BY ALL)
       SELECT e.event_id, e.user_id, e.value, n AS recent_txn_count, s AS recent_amount
       FROM events e JOIN velocity v ON e.user_id = v.user_id AND e.ts >= v.w AND e.ts < v.w + INTERVAL 1 DAY
       WHERE n > 3 AND (e.value > 100 OR regexp_matches(e.event_type, 'error'))""",
)
def fraud_interval_join(spark, sf):
    rows = T.events(spark, sf).select("event_id", "user_id", "ts", "value", "event_type")
    risky = transform.is_suspicious("value", "event_type", 100.0, "error")
    return joins.fraud_interval_join(rows, risky, "ts", "user_id", "value", "1 day", 3).drop("ts", "event_type")


@query(
    "trailing_velocity",
    """WITH s AS (SELECT user_id, date_trunc('second', ts) AS second, count(*) AS row_count FROM events GROUP BY ALL)
       SELECT user_id, second, row_count,
              CAST(sum(row_count) OVER (PARTITION BY user_id ORDER BY second
                   RANGE BETWEEN INTERVAL 86399 SECOND PRECEDING AND CURRENT ROW) AS BIGINT) AS trailing_count
       FROM s""",
)
def trailing_velocity(spark, sf):
    return joins.trailing_velocity(T.events(spark, sf), "ts", "user_id", 86_400)


@query(
    "orphan_rows",
    f"""SELECT o_orderkey, o_custkey FROM {T.UNKEYED_ORDERS_SQL} o
        WHERE NOT EXISTS (SELECT 1 FROM customer WHERE sign(c_acctbal) * c_custkey = o.o_custkey)""",
)
def orphan_rows(spark, sf):
    return joins.orphan_rows(T.unkeyed_orders(spark, sf), T.signed_customers(spark, sf), "o_custkey", "c_custkey").select("o_orderkey", "o_custkey")


@query(
    "valid_child_rows",
    "SELECT doc_id, lang, source FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)",
)
def valid_child_rows(spark, sf):
    documents = T.table(spark, sf, "documents").select("doc_id", "lang", "source")
    return joins.valid_child_rows(documents, T.table(spark, sf, "labels"), "doc_id", "doc_id")


@query(
    "orphan_placeholder",
    """SELECT doc_id, CAST(quality AS INTEGER) AS quality, CAST(toxic AS INTEGER) AS toxic FROM labels
       UNION ALL
       SELECT doc_id, 0, NULL FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)""",
)
def orphan_placeholder(spark, sf):
    documents, labels = T.table(spark, sf, "documents"), T.table(spark, sf, "labels")
    return joins.orphan_placeholder(documents, labels, "doc_id", "doc_id", {"quality": F.lit(0)})


@query(
    "broadcast_dim_join",
    """SELECT c_custkey, n_name, r_name FROM customer JOIN nation ON c_nationkey = n_nationkey
       JOIN region ON n_regionkey = r_regionkey""",
)
def broadcast_dim_join(spark, sf):
    nation, region = T.table(spark, sf, "nation"), T.table(spark, sf, "region")
    dimension = nation.join(region, nation.n_regionkey == region.r_regionkey).withColumn("c_nationkey", F.col("n_nationkey"))
    customers = T.table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    return joins.broadcast_dim_join(customers, dimension, "c_nationkey").select("c_custkey", "n_name", "r_name")


@query(
    "anti_join_ledger",
    """SELECT event_id, user_id, event_type FROM events e WHERE NOT EXISTS (
         SELECT 1 FROM events s WHERE s.event_type = 'signup' AND s.user_id = e.user_id
           AND CAST(s.ts AS DATE) = CAST(e.ts AS DATE))""",
)
def anti_join_ledger(spark, sf):
    rows = T.events(spark, sf).withColumn("day", F.col("ts").cast("date"))
    ledger = rows.filter("event_type = 'signup'").select("user_id", "day")
    return joins.anti_join_ledger(rows, ledger, ["user_id", "day"]).select("event_id", "user_id", "event_type")


DAILY_SALES_SQL = f"""
  SELECT store_id, product_category, CAST(sum(amount) AS DOUBLE) AS total_sales,
         count(transaction_id) AS num_transactions, CAST(sum(amount) AS DOUBLE) / count(amount) AS avg_transaction_value,
         count(DISTINCT customer_id) AS unique_customers, CAST(max(amount) AS DOUBLE) AS max_transaction,
         CAST(min(amount) AS DOUBLE) AS min_transaction
  FROM {T.SALES_SQL} WHERE sold_at >= TIMESTAMP '1995-01-01' AND sold_at < TIMESTAMP '2002-01-01'
  GROUP BY store_id, product_category"""


@query("daily_sales_summary", DAILY_SALES_SQL)
def daily_sales_summary(spark, sf):
    sold = T.sales(spark, sf).filter(
        (F.col("sold_at") >= T.timestamp("1995-01-01 00:00:00")) & (F.col("sold_at") < T.timestamp("2002-01-01 00:00:00"))
    )
    return aggregates.daily_sales_summary(sold)


@query(
    "cohort_retention",
    """WITH o AS (SELECT o_custkey AS c, date_trunc('month', o_orderdate) AS m, CAST(o_totalprice AS DECIMAL(18,2)) AS a
                  FROM orders),
            f AS (SELECT c, min(m) AS cohort FROM o GROUP BY c),
            s AS (SELECT cohort, count(*) AS cohort_size FROM f GROUP BY cohort),
            g AS (SELECT cohort, CAST(datediff('month', cohort, m) AS INTEGER) AS months_since, count(DISTINCT c) AS active,
                         CAST(sum(a) AS DOUBLE) AS revenue, count(*) AS n FROM o JOIN f USING (c) GROUP BY ALL)
       SELECT CAST(cohort AS DATE) AS cohort_month, months_since, active AS active_customers, revenue AS total_revenue,
              revenue / n AS avg_transaction, revenue / active AS avg_revenue_per_customer, cohort_size,
              CAST(active AS DOUBLE) / CAST(cohort_size AS DOUBLE) * 100.0 AS retention_rate
       FROM g JOIN s USING (cohort)""",
)
def cohort_retention(spark, sf):
    return aggregates.cohort_retention(T.table(spark, sf, "orders"), "o_custkey", "o_orderdate", "o_totalprice")


@query(
    "user_day_metrics",
    """SELECT user_id, CAST(ts AS DATE) AS date, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total_revenue,
       count(event_id) AS event_count FROM events GROUP BY ALL""",
)
def user_day_metrics(spark, sf):
    return aggregates.user_day_metrics(T.events(spark, sf), "user_id", F.col("ts").cast("date"), "value", "event_id")


@query(
    "serve_merged_view",
    """SELECT user_id, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total_revenue, count(*) AS total_events
       FROM events GROUP BY user_id""",
)
def serve_merged_view(spark, sf):
    rows = T.events(spark, sf)
    history = aggregates.user_day_metrics(rows, "user_id", F.col("ts").cast("date"), "value", "event_id")
    recent = views.window_columns(views.speed_layer_view(rows, "ts", "user_id", "value", "event_id"))
    return aggregates.serve_merged_view(history, recent, F.lit("2024-01-20").cast("date"))


@query(
    "table_profile",
    """SELECT 'l_quantity' AS "column", round(avg(l_quantity), 6) AS mean, round(stddev(l_quantity), 6) AS stddev,
              min(l_quantity) AS min, max(l_quantity) AS max, count(l_quantity) AS count FROM lineitem
       UNION ALL
       SELECT 'l_discount', round(avg(l_discount), 6), round(stddev(l_discount), 6), min(l_discount), max(l_discount),
              count(l_discount) FROM lineitem""",
)
def table_profile(spark, sf):
    return aggregates.table_profile(T.table(spark, sf, "lineitem"), ["l_quantity", "l_discount"])


@query(
    "distinct_row_count",
    "SELECT count(*) AS distinct_rows FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)",
)
def distinct_row_count(spark, sf):
    return aggregates.distinct_row_count(T.table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("max_event_time", "SELECT max(ts) AS max_event_time FROM events")
def max_event_time(spark, sf):
    return aggregates.max_event_time(T.events(spark, sf), "ts")


@query(
    "collect_recent_items",
    f"""WITH e AS (SELECT *, time_bucket(INTERVAL 1 DAY, ts) AS w,
                   count(item) OVER (PARTITION BY user_id, time_bucket(INTERVAL 1 DAY, ts)) AS n FROM {T.ITEMS_SQL}),
             p AS (SELECT *, CASE WHEN item IS NULL THEN 0 ELSE (row_number() OVER (
                     PARTITION BY user_id, w, item IS NULL ORDER BY ts, event_id) - 1) // 4 END AS part FROM e)
        SELECT w AS window_start, user_id, part, array_to_string(list(item ORDER BY ts, event_id), ',') AS recent_items,
               n AS interaction_count FROM p GROUP BY w, user_id, part, n""",
)
def collect_recent_items(spark, sf):
    parts = aggregates.collect_recent_items(T.items(spark, sf), "ts", "user_id", "item", "event_id", "1 day", part_rows=4)
    return parts.withColumn("recent_items", F.array_join("recent_items", ","))


@query(
    "dedup_keep_latest",
    f"""SELECT event_id, ts, user_id, value FROM {T.RETRIED_SQL}
        QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY ts DESC) = 1""",
)
def dedup_keep_latest(spark, sf):
    rows = T.retried_events(spark, sf).select("event_id", "ts", "user_id", "value")
    return ranking.dedup_keep_latest(rows, ["event_id"], ["ts"])


@query(
    "dedup_keep_first",
    f"""SELECT event_id, ts, user_id, value FROM {T.RETRIED_SQL}
        QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY ts) = 1""",
)
def dedup_keep_first(spark, sf):
    rows = T.retried_events(spark, sf).select("event_id", "ts", "user_id", "value")
    return ranking.dedup_keep_first(rows, ["event_id"], ["ts"])


@query(
    "top_pages",
    """SELECT time_bucket(INTERVAL 1 DAY, ts) AS window_start, event_type AS page, count(*) AS page_views
       FROM events GROUP BY ALL ORDER BY page_views DESC, window_start, page""",
)
def top_pages(spark, sf):
    return ranking.top_pages(T.events(spark, sf), "ts", "event_type", "1 day")


@query(
    "top_pages_limit",
    """SELECT time_bucket(INTERVAL 1 DAY, ts) AS window_start, event_type AS page, count(*) AS page_views
       FROM events GROUP BY ALL ORDER BY page_views DESC, window_start, page LIMIT 20""",
)
def top_pages_limit(spark, sf):
    return ranking.top_pages(T.events(spark, sf), "ts", "event_type", "1 day", limit=20)


@query(
    "duplicate_groups",
    """SELECT l_orderkey, l_linenumber, count(*) AS row_count FROM lineitem GROUP BY ALL HAVING count(*) > 1""",
)
def duplicate_groups(spark, sf):
    return ranking.duplicate_groups(T.table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "tables_equal",
    f"""SELECT CAST((SELECT count(*) FROM events WHERE event_id % 10 = 0) * 2 AS BIGINT) AS differing_rows,
               (SELECT count(*) FROM events WHERE event_id % 10 = 0) = 0 AS equal""",
)
def tables_equal(spark, sf):
    spread_shuffles(spark)
    rows = T.retried_events(spark, sf)
    runs = [ranking.dedup_keep_latest(rows, ["event_id"], ["ts"]) for _ in range(2)]
    return ranking.tables_equal(*runs, ranking.dedup_keep_first(rows, ["event_id"], ["ts"]))


@query(
    "missing_dates",
    """WITH d AS (SELECT DISTINCT CAST(o_orderdate AS DATE) + CAST(day(o_orderdate) = 13 AS INTEGER) AS date FROM orders)
       SELECT CAST(x AS DATE) AS date FROM (SELECT unnest(generate_series(min(date), max(date), INTERVAL 1 DAY)) AS x FROM d)
       WHERE CAST(x AS DATE) NOT IN (SELECT date FROM d)""",
)
def missing_dates(spark, sf):
    orders = T.moved_orders(spark, sf)
    return ranking.missing_dates(orders, F.col("o_orderdate"))


@query(
    "tumbling_velocity",
    """SELECT time_bucket(INTERVAL 5 MINUTE, ts) AS window_start, time_bucket(INTERVAL 5 MINUTE, ts) + INTERVAL 5 MINUTE
       AS window_end, user_id, count(*) AS txn_count, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total_amount
       FROM events GROUP BY ALL""",
)
def tumbling_velocity(spark, sf):
    return views.window_columns(views.tumbling_velocity(T.events(spark, sf), "ts", "user_id", "value"))


@query(
    "sliding_activity",
    """WITH w AS (SELECT event_id, user_id, time_bucket(INTERVAL 10 SECOND, ts) - i * INTERVAL 10 SECOND AS window_start
                  FROM events, range(6) r(i))
       SELECT window_start, window_start + INTERVAL 1 MINUTE AS window_end, count(*) AS event_count,
              count(DISTINCT user_id) AS unique_users FROM w GROUP BY ALL""",
)
def sliding_activity(spark, sf):
    return views.window_columns(views.sliding_activity(T.events(spark, sf), "ts", "user_id"))


@query(
    "late_data_split",
    """WITH e AS (SELECT event_id, CASE WHEN event_id % 31 = 0 THEN ts - INTERVAL 1 HOUR ELSE ts END AS ts FROM events),
            s AS (SELECT event_id, ts, max(ts) OVER (ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
                  - INTERVAL 10 MINUTE AS watermark FROM e)
       SELECT event_id, ts, watermark, coalesce(ts < watermark, false) AS late FROM s""",
)
def late_data_split(spark, sf):
    moved = F.when(F.col("event_id") % 31 == 0, F.col("ts") - F.expr("interval 1 hour")).otherwise(F.col("ts"))
    rows = T.events(spark, sf).select("event_id", moved.alias("ts"))
    on_time, late = lateness.late_data_split(rows, "ts", "event_id", "10 minutes")
    return on_time.withColumn("late", F.lit(False)).unionByName(late.withColumn("late", F.lit(True)))


LATE_SQL = """WITH e AS (SELECT event_id, user_id, value, event_id // 5 AS arrived,
                         CASE WHEN event_id % 31 = 0 THEN ts - INTERVAL 1 HOUR ELSE ts END AS ts FROM events)"""


def _arriving(spark, sf):
    """Events that arrive five at a time; some are an hour older than they look."""
    moved = F.when(F.col("event_id") % 31 == 0, F.col("ts") - F.expr("interval 1 hour")).otherwise(F.col("ts"))
    return T.events(spark, sf).select("event_id", "user_id", "value", F.floor(F.col("event_id") / 5).alias("arrived"), moved.alias("ts"))


@query(
    "late_data_split_ties",
    LATE_SQL + """, p AS (SELECT arrived, max(ts) AS peak FROM e GROUP BY arrived),
       w AS (SELECT arrived, max(peak) OVER (ORDER BY arrived ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - INTERVAL 10 MINUTE AS watermark FROM p)
       SELECT event_id, ts, watermark, coalesce(ts < watermark, false) AS late FROM e JOIN w USING (arrived)""",
)
def late_data_split_ties(spark, sf):
    """Rows that arrive together do not make each other late."""
    on_time, late = lateness.late_data_split(_arriving(spark, sf), "ts", "arrived", "10 minutes")
    both = on_time.withColumn("late", F.lit(False)).unionByName(late.withColumn("late", F.lit(True)))
    return both.select("event_id", "ts", "watermark", "late")


@query(
    "late_corrections",
    LATE_SQL + """ SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, user_id, count(*) AS txn_count,
       CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total_amount FROM e GROUP BY ALL""",
)
def late_corrections(spark, sf):
    """Windows over the rows on time, and the late rows' differences folded in: the result over all rows."""
    on_time, late = lateness.late_data_split(_arriving(spark, sf), "ts", "arrived", "10 minutes")
    keys = [F.window("ts", "1 hour")["start"].alias("window_start"), "user_id"]
    measures = [F.count("*").alias("txn_count"), F.sum(F.col("value").cast("decimal(18,2)")).alias("total_amount")]
    closed = on_time.groupBy(*keys).agg(*measures)
    deltas = lateness.corrections(late, keys, measures)
    folded = lateness.fold_corrections(closed, deltas, ["window_start", "user_id"], ["txn_count", "total_amount"], rows="txn_count")
    return folded.withColumn("total_amount", F.col("total_amount").cast("double"))
