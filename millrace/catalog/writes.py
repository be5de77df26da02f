"""Merges, ledgers, versioned tables and loads over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.catalog import tables as T
from millrace.catalog.registry import query
from millrace.operators import idempotent, ranking, transitions, versions
from millrace.session import scratch_dir
from millrace.sources import batch, files, kafka, loads, paged
from millrace.sources import tables as stored

RUN_AT = "2024-02-01 06:00:00"


@query("scan_parquet", "SELECT event_id, user_id, value FROM events WHERE event_type = 'purchase'")
def scan_parquet(spark, sf):
    rows = batch.scan_parquet(spark, f"{sf}/events.parquet", F.col("event_type") == "purchase")
    return rows.select("event_id", "user_id", "value")


def _json_lines(spark, sf):
    """Events as JSON lines: some with a wrongly typed value, some cut short."""
    good = F.to_json(F.struct("event_id", "user_id", "event_type", "value"))
    text = (
        F.when(F.col("event_id") % 17 == 0, F.to_json(F.struct("event_id", "user_id", "event_type", F.lit("oops").alias("value"))))
        .when(F.col("event_id") % 23 == 0, F.substring(good, 1, 20))
        .otherwise(good)
    )
    return T.events(spark, sf).select(text.alias("value"))


JSON_SCHEMA = "event_id bigint, user_id bigint, event_type string, value double"
JSON_TOTAL = """count(*) AS row_count, CAST(sum(user_id) AS BIGINT) AS users, CAST(sum(length(event_type)) AS BIGINT) AS chars,
                CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total"""


@query(
    "scan_json_modes",
    f"""SELECT 'PERMISSIVE good' AS part, {JSON_TOTAL} FROM events WHERE event_id % 17 <> 0 AND event_id % 23 <> 0
        UNION ALL SELECT 'DROPMALFORMED', {JSON_TOTAL} FROM events WHERE event_id % 17 <> 0 AND event_id % 23 <> 0
        UNION ALL SELECT 'PERMISSIVE corrupt', count(*), NULL, NULL, NULL FROM events
                  WHERE event_id % 17 = 0 OR event_id % 23 = 0""",
)
def scan_json_modes(spark, sf):
    path = scratch_dir(spark, "json")
    _json_lines(spark, sf).write.text(path)
    schema = spark.createDataFrame([], JSON_SCHEMA).schema
    good, corrupt = batch.split_corrupt(batch.scan_json_modes(spark, path, schema))
    dropped = batch.scan_json_modes(spark, path, schema, "DROPMALFORMED")

    def total(df, part):
        return df.agg(
            F.count("*").alias("row_count"),
            F.sum("user_id").alias("users"),
            F.sum(F.length("event_type")).alias("chars"),
            F.sum(F.col("value").cast("decimal(18,2)")).cast("double").alias("total"),
        ).select(F.lit(part).alias("part"), "*")

    none = F.lit(None)
    corrupt_total = corrupt.agg(F.count("*").alias("row_count")).select(
        F.lit("PERMISSIVE corrupt").alias("part"),
        "row_count",
        none.cast("bigint").alias("users"),
        none.cast("bigint").alias("chars"),
        none.cast("double").alias("total"),
    )
    return total(good, "PERMISSIVE good").unionByName(total(dropped, "DROPMALFORMED")).unionByName(corrupt_total)


@query(
    "full_load",
    """SELECT c_custkey, c_name, c_acctbal, TIMESTAMP '2024-02-01 06:00:00' AS load_timestamp, DATE '2024-02-01' AS load_date
       FROM customer""",
)
def full_load(spark, sf):
    path = scratch_dir(spark, "full-load")
    customers = T.table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal")
    for _ in range(2):
        loads.write_full_load(customers, path, T.timestamp(RUN_AT))
    return spark.read.parquet(path)


@query(
    "incremental_timestamp",
    "SELECT o_orderkey, o_custkey, o_orderdate FROM orders WHERE o_orderdate > TIMESTAMP '1998-01-01 00:00:00'",
)
def incremental_timestamp(spark, sf):
    orders = T.table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return loads.incremental_timestamp(orders, "o_orderdate", T.timestamp("1998-01-01 00:00:00"))[0]


@query(
    "incremental_watermark",
    """SELECT 'later' AS load, max(o_orderdate) AS watermark, count(*) AS rows FROM orders
         WHERE o_orderdate > TIMESTAMP '1998-01-01 00:00:00'
       UNION ALL SELECT 'first', max(o_orderdate), count(*) FROM orders
       UNION ALL SELECT 'empty', max(o_orderdate), 0 FROM orders""",
)
def incremental_watermark(spark, sf):
    orders = T.table(spark, sf, "orders")
    later = loads.incremental_timestamp(orders, "o_orderdate", T.timestamp("1998-01-01 00:00:00"))[1]
    first = loads.incremental_timestamp(orders, "o_orderdate", None)[1]
    empty = loads.incremental_timestamp(orders, "o_orderdate", F.lit(first.first()["watermark"]))[1]
    return (
        later.select(F.lit("later").alias("load"), "*")
        .unionByName(first.select(F.lit("first").alias("load"), "*"))
        .unionByName(empty.select(F.lit("empty").alias("load"), "*"))
    )


@query(
    "incremental_load",
    """SELECT o_orderkey, o_orderdate, year(o_orderdate) AS order_year,
              CASE WHEN o_orderdate <= TIMESTAMP '1998-06-30' THEN 1 ELSE 2 END AS load_number FROM orders""",
)
def incremental_load(spark, sf):
    path = scratch_dir(spark, "incremental")
    ledger = loads.WatermarkLedger(spark, f"{path}/ledger")
    orders = T.table(spark, sf, "orders").select("o_orderkey", "o_orderdate", F.year("o_orderdate").alias("order_year"))
    early = orders.filter(F.col("o_orderdate") <= T.timestamp("1998-06-30 00:00:00"))
    for source, stamp in ((early, "2024-01-01 00:00:00"), (orders, "2024-01-02 00:00:00"), (orders, "2024-01-03 00:00:00")):
        loads.run_incremental_load(
            source, "o_orderdate", ledger, "orders", f"{path}/orders", T.timestamp(stamp), partition_by=["order_year"]
        )
    return spark.read.parquet(f"{path}/orders").select(
        "o_orderkey",
        "o_orderdate",
        F.col("order_year").cast("bigint").alias("order_year"),
        F.dayofmonth("ingestion_timestamp").alias("load_number"),
    )


@query("incremental_sequence", "SELECT event_id, ts, user_id FROM events WHERE event_id > 100")
def incremental_sequence(spark, sf):
    return loads.incremental_sequence(T.events(spark, sf).select("event_id", "ts", "user_id"), "event_id", 100)[0]


def _pages(spark, sf):
    """Events as API pages of 100; the last but one tenth of pages fails."""
    rows = T.events(spark, sf)
    page = F.floor(F.col("event_id") / 100) + 1
    result = F.struct("event_id", "user_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("updated_at"))
    last = rows.agg(F.max(page).alias("n")).scalar()
    return (
        rows.groupBy(page.alias("page"))
        .agg(F.collect_list(result).alias("results"))
        .select(
            "page",
            F.when(F.col("page") == F.floor(last * 0.9), 500).otherwise(200).alias("status"),
            F.to_json(F.struct("results", (F.col("page") < last).alias("has_next_page"))).alias("body"),
        )
    )


PAGE_RECORD = "event_id bigint, user_id bigint, updated_at timestamp_ntz"
FETCHED_SQL = """(SELECT event_id // 100 + 1 AS page, event_id, user_id, ts AS updated_at FROM events
                  WHERE event_id // 100 + 1 < (SELECT floor((max(event_id) // 100 + 1) * 0.9) FROM events))"""


@query("paged_payload_flatten", f"SELECT page, event_id, user_id, updated_at FROM {FETCHED_SQL}")
def paged_payload_flatten(spark, sf):
    return paged.paged_payload_flatten(_pages(spark, sf), PAGE_RECORD)


@query(
    "paged_incremental",
    f"SELECT page, event_id, user_id, updated_at FROM {FETCHED_SQL} WHERE updated_at >= TIMESTAMP '2024-01-10 00:00:00'",
)
def paged_incremental(spark, sf):
    return paged.paged_incremental(_pages(spark, sf), PAGE_RECORD, T.timestamp("2024-01-10 00:00:00"))


@query(
    "batch_file_ingest",
    """SELECT 'ok' AS state, 0 AS run, count(*) AS row_count, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total
       FROM events WHERE event_id % 17 <> 0 AND event_id % 23 <> 0
       UNION ALL SELECT 'error', 0, count(*), NULL FROM events WHERE event_id % 17 = 0 OR event_id % 23 = 0
       UNION ALL SELECT 'ok', 1, count(*), CAST(sum(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) FROM customer""",
)
def batch_file_ingest(spark, sf):
    root = scratch_dir(spark, "inbox")
    inbox = files.Inbox(f"{root}/incoming", f"{root}/output", f"{root}/ledger")
    schema = spark.createDataFrame([], JSON_SCHEMA).schema
    _json_lines(spark, sf).write.mode("append").text(inbox.incoming)
    files.batch_file_ingest(spark, inbox, schema, T.timestamp(RUN_AT))
    more = T.table(spark, sf, "customer").select(
        F.to_json(F.struct(F.col("c_custkey").alias("event_id"), F.col("c_acctbal").alias("value"))).alias("value")
    )
    more.write.mode("append").text(inbox.incoming)
    for _ in range(2):
        files.batch_file_ingest(spark, inbox, schema, T.timestamp(RUN_AT))
    total = F.sum(F.when(F.col("state") == "ok", F.col("value").cast("decimal(18,2)"))).cast("double")
    return (
        spark.read.parquet(inbox.output).groupBy("state", "run").agg(F.count("*").alias("row_count"), total.alias("total"))
    )


@query(
    "file_hash_ingest",
    """SELECT 1 AS run, 'processed' AS status, count(DISTINCT lang || source) AS files FROM documents
       UNION ALL SELECT 2, 'already_processed', count(DISTINCT lang || source) FROM documents""",
)
def file_hash_ingest(spark, sf):
    path = scratch_dir(spark, "hashes")
    T.table(spark, sf, "documents").select("lang", "source", "text").write.partitionBy("lang", "source").text(path)
    glob = f"{path}/lang=*/source=*/part-*"
    first = files.file_hash_ingest(spark, glob, None)
    second = files.file_hash_ingest(spark, glob, first)

    def counted(df, run):
        folder = F.regexp_extract("path", "lang=[^/]*/source=[^/]*", 0)
        return df.groupBy("status").agg(F.count_distinct(folder).alias("files")).select(F.lit(run).alias("run"), "*")

    return counted(first, 1).unionByName(counted(second, 2))


def _kafka_rows(spark, sf):
    value = F.to_json(F.struct("event_id", "user_id", F.col("event_type").alias("action")))
    return T.events(spark, sf).select(
        F.col("user_id").cast("string").cast("binary").alias("key"),
        F.when(F.col("event_id") % 23 == 0, F.lit("not json")).otherwise(value).cast("binary").alias("value"),
        F.lit("events").alias("topic"),
        (F.col("user_id") % 3).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("ts").alias("timestamp"),
    )


@query(
    "kafka_decode",
    """SELECT CAST(user_id AS VARCHAR) AS key, CASE WHEN event_id % 23 <> 0 THEN event_id END AS event_id,
       CASE WHEN event_id % 23 <> 0 THEN user_id END AS user_id, CASE WHEN event_id % 23 <> 0 THEN event_type END AS action,
       'events' AS topic, CAST(user_id % 3 AS INTEGER) AS "partition", event_id AS "offset", ts AS kafka_timestamp FROM events""",
)
def kafka_decode(spark, sf):
    return kafka.kafka_decode(_kafka_rows(spark, sf), "event_id bigint, user_id bigint, action string")


@query(
    "kafka_encode",
    """SELECT CAST(user_id AS VARCHAR) AS key, '{"event_id":' || event_id || ',"user_id":' || user_id || ',"event_type":"'
       || event_type || '"}' AS value FROM events""",
)
def kafka_encode(spark, sf):
    return kafka.kafka_encode(T.events(spark, sf).select("event_id", "user_id", "event_type"), "user_id")


@query(
    "partition_overwrite",
    """SELECT event_id, CASE WHEN event_type = 'error' THEN value * 2 ELSE value END AS value, event_type FROM events""",
)
def partition_overwrite(spark, sf):
    path = scratch_dir(spark, "partitions")
    rows = T.events(spark, sf).select("event_id", "value", "event_type")
    stored.partition_overwrite(rows, path, ["event_type"])
    errors = rows.filter("event_type = 'error'").withColumn("value", F.col("value") * 2)
    for _ in range(2):
        stored.partition_overwrite(errors, path, ["event_type"])
    return spark.read.parquet(path)


@query(
    "schema_evolve_union",
    """SELECT event_id, user_id, CASE WHEN ts >= TIMESTAMP '2024-01-15' THEN value END AS value,
       CASE WHEN ts >= TIMESTAMP '2024-01-22' THEN props END AS props FROM events""",
)
def schema_evolve_union(spark, sf):
    rows, path = T.events(spark, sf), scratch_dir(spark, "evolving")
    first, second = T.timestamp("2024-01-15 00:00:00"), T.timestamp("2024-01-22 00:00:00")
    oldest = rows.filter(F.col("ts") < first).select("event_id", "user_id")
    middle = rows.filter((F.col("ts") >= first) & (F.col("ts") < second)).select("event_id", "user_id", "value")
    newest = rows.filter(F.col("ts") >= second).select("event_id", "user_id", "value", "props")
    oldest.write.parquet(f"{path}/load=1")
    middle.write.parquet(f"{path}/load=2")
    return stored.schema_evolve_union(stored.read_evolving(spark, path).drop("load"), newest)


@query(
    "snapshot_as_of",
    """SELECT conv_id, turn, role, length(text) AS chars FROM conversations WHERE turn <= 2
       QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC, text DESC) = 1""",
)
def snapshot_as_of(spark, sf):
    turns = T.table(spark, sf, "conversations")
    latest = stored.snapshot_as_of(turns, ["conv_id"], "turn", 2, ["text"])
    return latest.select("conv_id", "turn", "role", F.length("text").cast("bigint").alias("chars"))


MERGE_SQL = """WITH u AS (
    SELECT user_id AS c_custkey, 'event ' || event_type AS c_name, value AS c_acctbal FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1)"""


def _updates(spark, sf):
    return T.events(spark, sf).select(
        F.col("user_id").alias("c_custkey"),
        F.concat(F.lit("event "), "event_type").alias("c_name"),
        F.col("value").alias("c_acctbal"),
        "ts",
        "event_id",
    )


@query(
    "merge_upsert",
    f"""{MERGE_SQL} SELECT c_custkey, c_name, c_acctbal FROM customer WHERE c_custkey NOT IN (SELECT c_custkey FROM u)
        UNION ALL SELECT c_custkey, c_name, c_acctbal FROM u""",
)
def merge_upsert(spark, sf):
    table = stored.VersionedTable(spark, scratch_dir(spark, "merge"))
    table.publish(T.table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal"))
    for _ in range(2):
        merged = idempotent.merge_upsert(table.read(), _updates(spark, sf), ["c_custkey"], ["ts", "event_id"])
        table.publish(merged.select("c_custkey", "c_name", "c_acctbal"))
    return table.read()


@query(
    "insert_if_absent",
    """WITH n AS (SELECT user_id + 1000000 * CAST(event_type = 'signup' AS BIGINT) AS c_custkey, event_type AS c_name, event_id
                  FROM events)
       SELECT c_custkey, c_name FROM customer
       UNION ALL SELECT c_custkey, c_name FROM n WHERE c_custkey NOT IN (SELECT c_custkey FROM customer)
       QUALIFY row_number() OVER (PARTITION BY c_custkey ORDER BY event_id) = 1""",
)
def insert_if_absent(spark, sf):
    shifted = F.col("user_id") + F.when(F.col("event_type") == "signup", 1_000_000).otherwise(0)
    new = T.events(spark, sf).select(shifted.alias("c_custkey"), F.col("event_type").alias("c_name"), "event_id")
    target = T.table(spark, sf, "customer").select("c_custkey", "c_name")
    return idempotent.insert_if_absent(target, new, ["c_custkey"], ["event_id"]).drop("event_id")


CDC_SQL = f"""
  WITH last AS (SELECT * FROM {T.CHANGES_SQL} QUALIFY row_number() OVER (PARTITION BY id ORDER BY ts_ms DESC, "offset" DESC) = 1)
  SELECT c_custkey AS id, c_name AS name, c_acctbal AS email_score FROM customer WHERE c_custkey NOT IN (SELECT id FROM last)
  UNION ALL SELECT id, name, email_score FROM last WHERE op <> 'd'"""


@query("cdc_apply", CDC_SQL)
def cdc_apply(spark, sf):
    target = T.table(spark, sf, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("email_score")
    )
    return idempotent.cdc_apply(target, T.changes(spark, sf), "id", ["ts_ms", "offset"])


PAYMENT_SQL = "(SELECT event_id, user_id || '-' || CAST(floor(value / 20) AS BIGINT) AS key, value AS amount FROM events)"


def _payments(spark, sf):
    key = F.concat_ws("-", F.col("user_id").cast("string"), F.floor(F.col("value") / 20).cast("string"))
    return T.events(spark, sf).select("event_id", key.alias("key"), F.col("value").alias("amount"))


@query(
    "first_write_wins",
    f"""SELECT event_id, key, amount FROM {PAYMENT_SQL} WHERE key NOT IN (SELECT key FROM {PAYMENT_SQL} WHERE amount > 300)
        QUALIFY row_number() OVER (PARTITION BY key ORDER BY event_id) = 1""",
)
def first_write_wins(spark, sf):
    requests = _payments(spark, sf)
    return idempotent.first_write_wins(requests, requests.filter("amount > 300"), "key", ["event_id"])


@query(
    "replay_results",
    f"""WITH f AS (SELECT key, event_id AS first_event_id, amount FROM {PAYMENT_SQL}
                   QUALIFY row_number() OVER (PARTITION BY key ORDER BY event_id) = 1)
        SELECT p.event_id, key, first_event_id, f.amount, p.event_id <> first_event_id AS replayed
        FROM {PAYMENT_SQL} p JOIN f USING (key)""",
)
def replay_results(spark, sf):
    requests = _payments(spark, sf)
    ledger = idempotent.first_write_wins(requests, None, "key", ["event_id"]).withColumnRenamed("event_id", "first_event_id")
    return idempotent.replay_results(requests, ledger, "key", "event_id")


@query(
    "content_hash_dedup",
    """SELECT doc_id, lang, length(text) AS chars FROM documents
       QUALIFY row_number() OVER (PARTITION BY text, lang ORDER BY doc_id) = 1""",
)
def content_hash_dedup(spark, sf):
    rows = T.table(spark, sf, "documents").select("doc_id", "lang", "text")
    unique = idempotent.content_hash_dedup(rows, ["text", "lang"], ["doc_id"])
    return unique.select("doc_id", "lang", F.length("text").cast("bigint").alias("chars"))


# The default table, and the same with ways back.
ALLOWED = {
    "pending": ["confirmed", "cancelled"],
    "confirmed": ["shipped", "cancelled"],
    "shipped": ["delivered", "returned"],
    "delivered": ["returned"],
}
CYCLIC = ALLOWED | {"delivered": ["returned", "shipped"], "cancelled": ["confirmed"], "returned": ["confirmed"]}


def transition_sql(table):
    pairs = ", ".join(f"('{a}','{b}')" for a, targets in table.items() for b in targets)
    return f"""WITH RECURSIVE e AS (SELECT *, row_number() OVER (PARTITION BY entity ORDER BY position) AS rn FROM {T.TRANSITIONS_SQL}),
        allowed(a, b) AS (VALUES {pairs}),
        v AS (
          SELECT entity, CAST(0 AS BIGINT) AS rn, CAST(NULL AS BIGINT) AS position, CAST(NULL AS VARCHAR) AS wanted,
                 CAST(NULL AS VARCHAR) AS current_status, CAST(NULL AS VARCHAR) AS verdict,
                 'pending' AS status, CAST(NULL AS VARCHAR) AS last_token FROM (SELECT DISTINCT entity FROM e)
          UNION ALL
          SELECT entity, rn, position, wanted, current_status, verdict,
                 CASE WHEN verdict = 'applied' THEN wanted ELSE current_status END,
                 CASE WHEN verdict = 'applied' THEN token ELSE last_token END
          FROM (SELECT e.entity, e.rn, e.position, e.wanted, e.token, v.last_token, v.status AS current_status,
                       CASE WHEN v.status = e.wanted THEN 'same_state'
                            WHEN (v.status, e.wanted) NOT IN (SELECT a, b FROM allowed) THEN 'invalid'
                            WHEN e.token = v.last_token THEN 'same_key' ELSE 'applied' END AS verdict
                FROM v JOIN e ON e.entity = v.entity AND e.rn = v.rn + 1))
        SELECT entity, position, wanted, current_status, verdict FROM v WHERE rn > 0"""


def _judged_transitions(spark, sf, **options):
    judged = transitions.state_transition_check(T.transitions(spark, sf), "entity", "wanted", ["position"], "token", **options)
    return judged.drop("token")


@query("state_transition_check", transition_sql(ALLOWED))
def state_transition_check(spark, sf):
    return _judged_transitions(spark, sf)


@query("state_transition_segments", transition_sql(ALLOWED))
def state_transition_segments(spark, sf):
    """Segments so small that entities span several, in a tree of several levels."""
    return _judged_transitions(spark, sf, max_rows=3, fanout=2)


@query("state_transition_cycle", transition_sql(CYCLIC))
def state_transition_cycle(spark, sf):
    return _judged_transitions(spark, sf, transitions=CYCLIC, max_rows=4, fanout=3)


def _version_updates(spark, sf):
    """Events as updates of their user's record; some expect a wrong version.

    The expected version follows the user's count of earlier days.
    """
    shift = F.when(F.col("event_id") % 11 == 0, F.col("event_id") % 3 - 1).otherwise(0)
    day = F.date_diff("ts", F.lit("2024-01-01").cast("date"))
    return T.events(spark, sf).select("user_id", "event_id", (F.floor(day / 2) + shift).alias("expected"))


@query(
    "version_gated_update",
    """WITH RECURSIVE e AS (
         SELECT user_id, event_id, datediff('day', DATE '2024-01-01', CAST(ts AS DATE)) // 2
                + CASE WHEN event_id % 11 = 0 THEN event_id % 3 - 1 ELSE 0 END AS expected,
                row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS rn FROM events),
       v AS (
         SELECT user_id, CAST(0 AS BIGINT) AS rn, CAST(NULL AS BIGINT) AS event_id, CAST(NULL AS BIGINT) AS expected,
                CAST(0 AS BIGINT) AS current_version, CAST(0 AS BIGINT) AS version FROM (SELECT DISTINCT user_id FROM e)
         UNION ALL
         SELECT e.user_id, e.rn, e.event_id, e.expected, v.version,
                CASE WHEN v.version = e.expected THEN v.version + 1 ELSE v.version END
         FROM v JOIN e ON e.user_id = v.user_id AND e.rn = v.rn + 1)
       SELECT user_id, event_id, expected, current_version,
              CASE WHEN current_version > expected THEN 'already_updated' WHEN current_version < expected THEN 'conflict'
                   ELSE 'applied' END AS verdict FROM v WHERE rn > 0""",
)
def version_gated_update(spark, sf):
    return versions.version_gated_update(_version_updates(spark, sf), "user_id", "expected", ["event_id"])


def _version_walk_sql(expected):
    """Every update in turn, each seeing the version the earlier ones of its record left."""
    return f"""WITH RECURSIVE e AS (
         SELECT user_id, event_id, {expected} AS expected, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS rn FROM events),
       v AS (
         SELECT user_id, CAST(0 AS BIGINT) AS rn, CAST(NULL AS BIGINT) AS event_id, CAST(NULL AS BIGINT) AS expected,
                CAST(0 AS BIGINT) AS current_version, CAST(0 AS BIGINT) AS version FROM (SELECT DISTINCT user_id FROM e)
         UNION ALL
         SELECT e.user_id, e.rn, e.event_id, e.expected, v.version,
                CASE WHEN v.version = e.expected THEN v.version + 1 ELSE v.version END
         FROM v JOIN e ON e.user_id = v.user_id AND e.rn = v.rn + 1)
       SELECT user_id, event_id, expected, current_version,
              CASE WHEN current_version > expected THEN 'already_updated' WHEN current_version < expected THEN 'conflict'
                   ELSE 'applied' END AS verdict FROM v WHERE rn > 0"""


@query(
    "version_gated_update_segments",
    _version_walk_sql("CASE WHEN event_id % 3 = 0 THEN event_id * 7919 % 1000 ELSE event_id * 31 % 7 END"),
)
def version_gated_update_segments(spark, sf):
    """Small segments and scattered versions: every record's maps are composed over several levels."""
    n = F.col("event_id")
    expected = F.when(n % 3 == 0, n * 7919 % 1000).otherwise(n * 31 % 7)
    updates = T.events(spark, sf).select("user_id", "event_id", expected.alias("expected"))
    return versions.version_gated_update(updates, "user_id", "expected", ["event_id"], max_rows=8)


ONE_UPDATE_SQL = """WITH t AS (SELECT c_custkey AS id, c_name AS name, CAST(c_nationkey % 3 AS BIGINT) AS version FROM customer),
            u AS (SELECT user_id AS id, event_type AS name, event_id % 3 AS expected FROM events
                  QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1),
            j AS (SELECT coalesce(t.id, u.id) AS id, t.id IS NOT NULL AS known, coalesce(t.version, 0) AS version,
                         t.name AS old, u.name AS new, expected FROM t FULL OUTER JOIN u ON t.id = u.id),
            r AS (SELECT *, CASE WHEN expected IS NULL THEN 'untouched' WHEN version > expected THEN 'already_updated'
                                 WHEN version < expected THEN 'conflict' ELSE 'applied' END AS verdict FROM j)"""


def _one_update(spark, sf):
    target = T.table(spark, sf, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), (F.col("c_nationkey") % 3).cast("bigint").alias("version")
    )
    latest = ranking.dedup_keep_latest(T.events(spark, sf), ["user_id"], ["event_id"]).select(
        F.col("user_id").alias("id"), F.col("event_type").alias("name"), (F.col("event_id") % 3).alias("expected")
    )
    return idempotent.apply_one_update(target, latest, "id", "expected", ["name"])


@query(
    "apply_one_update",
    f"""{ONE_UPDATE_SQL} SELECT id, CASE WHEN verdict = 'applied' THEN version + 1 ELSE version END AS version,
              CASE WHEN verdict = 'applied' THEN new ELSE old END AS name FROM r WHERE known OR verdict = 'applied'""",
)
def apply_one_update(spark, sf):
    return _one_update(spark, sf)[0]


@query("apply_one_update_verdicts", f"{ONE_UPDATE_SQL} SELECT id, verdict FROM r WHERE verdict <> 'untouched'")
def apply_one_update_verdicts(spark, sf):
    return _one_update(spark, sf)[1]


@query(
    "offset_ledger_apply",
    f"""WITH seen AS (SELECT event_id, "partition", "offset" FROM {T.MESSAGES_SQL} WHERE event_type = 'view'),
             n AS (SELECT * FROM {T.MESSAGES_SQL} m WHERE NOT EXISTS (
                   SELECT 1 FROM seen s WHERE s."partition" = m."partition" AND s."offset" = m."offset"))
        SELECT event_id, topic, "partition", "offset", user_id, event_type,
               row_number() OVER (PARTITION BY event_id ORDER BY "partition", "offset") = 1
                 AND event_id NOT IN (SELECT event_id FROM seen) AS inserted FROM n""",
)
def offset_ledger_apply(spark, sf):
    rows = T.messages(spark, sf)
    ledger = rows.filter("event_type = 'view'").withColumn("inserted", F.lit(True))
    return idempotent.offset_ledger_apply(rows, ledger, "event_id")


@query(
    "process_order_once",
    """WITH done AS (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F'),
            taken AS (SELECT l_partkey, sum(l_quantity) AS q FROM (
                        SELECT l_orderkey, l_linenumber, l_partkey, min(l_quantity) AS l_quantity FROM lineitem
                        GROUP BY l_orderkey, l_linenumber, l_partkey)
                      WHERE l_orderkey NOT IN (SELECT o_orderkey FROM done) GROUP BY l_partkey)
       SELECT p_partkey, 100000.0 + p_size - coalesce(q, 0) AS on_hand FROM part LEFT JOIN taken ON p_partkey = l_partkey""",
)
def process_order_once(spark, sf):
    lines = T.table(spark, sf, "lineitem")
    delivered = lines.unionByName(lines.filter("l_returnflag = 'R'")).withColumn("p_partkey", F.col("l_partkey"))
    done = T.table(spark, sf, "orders").filter("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("l_orderkey"))
    stock = T.table(spark, sf, "part").select("p_partkey", (F.col("p_size") + 100000.0).alias("on_hand"))
    line = ["l_orderkey", "l_linenumber", "p_partkey"]
    return idempotent.process_order_once(stock, delivered, done, "l_orderkey", line, "p_partkey", "l_quantity")[0]
