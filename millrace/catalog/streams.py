"""Streaming queries run to the end over the given tables.

Each stages its table as files that arrive slice after slice, drains them one
slice per micro-batch, and returns what the sink holds. Results are compared
with the same computation in SQL over the whole table.
"""

from __future__ import annotations

from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from millrace.catalog import tables as T
from millrace.catalog.registry import query
from millrace.catalog.writes import ALLOWED, CDC_SQL, transition_sql
from millrace.operators import idempotent, transform
from millrace.plans import serving
from millrace.session import child_names, scratch_dir
from millrace.sources.batch import scan_parquet
from millrace.sources.buckets import BucketTable
from millrace.streaming import health, sinks, transitions, views
from millrace.streaming.logs import LeveledLog, newest

SLICES, SLICE_FILES = 3, 2
FILE_ROWS = 1_000_000  # rows of a staged file


def _stage(spark, sf, folder, name="events", order="ts", slices=range(SLICES)):
    """Write slices of a table by an order column, each as its own files, one after the other.

    Returns the schema and the number of files of a slice, which grows with the largest slice. Every slice
    has as many, empty ones if need be: so many files are a slice to the stream that reads them.
    """
    rows = T.table(spark, sf, name)
    at = F.col(order).cast("bigint") if order == "event_id" else F.unix_micros(F.col(order).cast("timestamp"))
    low, high = rows.agg(F.min(at), F.max(at)).first()
    number = F.floor((at - low) * SLICES / (high - low + 1))
    largest = rows.groupBy(number.alias("slice")).count().agg(F.max("count")).first()[0] or 0
    files = max(SLICE_FILES, -(-largest // FILE_ROWS))
    for n in slices:
        earlier = _files(spark, folder)
        rows.filter(number == n).repartition(files).write.mode("append").parquet(folder)
        for _ in range(earlier + files - _files(spark, folder)):
            spark.createDataFrame([], rows.schema).write.mode("append").parquet(folder)
    return rows.schema, files


def _files(spark, folder):
    return sum(child.endswith(".parquet") for child in child_names(spark, folder))


def _read_slices(spark, folder, schema, files):
    return sinks.file_stream(spark, folder, schema, "parquet", files)


def _stream(spark, sf, name="events", order="ts"):
    """The table as a stream of several micro-batches, in the order of a column."""
    folder = scratch_dir(spark, f"staged-{name}")
    return _read_slices(spark, folder, *_stage(spark, sf, folder, name, order))


def _drain(df, write, checkpoint, mode="update"):
    sinks.foreach_batch_sink(df, write, checkpoint, mode, processing_time=None).awaitTermination()


class _DyingLog(LeveledLog):
    """A log whose writer dies once, after its first merge and before it has cleaned up."""

    died = False

    def sweep(self, keep):
        if not self.died and any(segment.level for segment in self.segments()):
            self.died = True
            raise OSError("the writer died")
        super().sweep(keep)


def _dying(log):
    """The log with merges of two and a writer that dies; its queries are started again."""
    return _DyingLog(log.spark, log.path, log.reduce, fan_in=2)


def _restarted(start, log):
    """Run a draining query until it ends: a micro-batch that failed is repeated from the checkpoint."""
    try:
        start().awaitTermination()
    except StreamingQueryException:
        start().awaitTermination()
    assert log.died and any(segment.level for segment in log.segments())


@query("file_stream_ingest", "SELECT event_id, user_id, event_type, value, true AS has_file, true AS has_time FROM events")
def file_stream_ingest(spark, sf):
    path = scratch_dir(spark, "file-stream")
    schema, files = _stage(spark, sf, f"{path}/events")
    arrived = sinks.file_stream_ingest(spark, f"{path}/events", schema, "parquet", files)
    sinks.stream_file_sink(arrived, f"{path}/out", f"{path}/checkpoint", None).awaitTermination()
    return scan_parquet(spark, f"{path}/out").select(
        "event_id",
        "user_id",
        "event_type",
        "value",
        F.col("file_name").contains("events").alias("has_file"),
        F.col("ingestion_time").isNotNull().alias("has_time"),
    )


@query("checkpoint_resume", "SELECT event_type, count(*) AS row_count FROM events GROUP BY event_type")
def checkpoint_resume(spark, sf):
    """Drained in the middle, then again after more files arrived, then without any."""
    path = scratch_dir(spark, "resume")
    for arriving in (range(2), range(2, SLICES), ()):
        schema, files = _stage(spark, sf, f"{path}/in", slices=arriving)
        stream = _read_slices(spark, f"{path}/in", schema, files).select("event_id", "event_type")
        sinks.stream_file_sink(stream, f"{path}/out", f"{path}/checkpoint", None).awaitTermination()
    return scan_parquet(spark, f"{path}/out").groupBy("event_type").agg(F.count("*").alias("row_count"))


VELOCITY_SQL = """
  SELECT time_bucket(INTERVAL 5 MINUTE, ts) AS window_start, time_bucket(INTERVAL 5 MINUTE, ts) + INTERVAL 5 MINUTE AS window_end,
         user_id, count(*) AS txn_count, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total_amount
  FROM events GROUP BY ALL"""


@query("foreach_batch_sink", VELOCITY_SQL)
def foreach_batch_sink(spark, sf):
    path = scratch_dir(spark, "velocity")
    log = LeveledLog(spark, f"{path}/log", newest(["window_start", "user_id"]))
    windows = views.tumbling_velocity(views.watermark(_stream(spark, sf), "ts", "10 minutes"), "ts", "user_id", "value")
    _drain(views.window_columns(windows), log.write, f"{path}/checkpoint")
    return log.current().drop("batch_id")


@query(
    "closed_windows_stream",
    f"SELECT * FROM ({VELOCITY_SQL}) WHERE window_end <= (SELECT max(ts) - INTERVAL 10 MINUTE FROM events)",
)
def closed_windows_stream(spark, sf):
    path = scratch_dir(spark, "closed")
    windows = views.tumbling_velocity(views.watermark(_stream(spark, sf), "ts", "10 minutes"), "ts", "user_id", "value")
    sinks.stream_file_sink(views.window_columns(windows), f"{path}/out", f"{path}/checkpoint", None).awaitTermination()
    return scan_parquet(spark, f"{path}/out")


@query(
    "fraud_alert_stream",
    """WITH v AS (SELECT user_id, time_bucket(INTERVAL 1 DAY, ts) AS w, count(*) AS n,
                         CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS s FROM events GROUP BY ALL)
       SELECT e.event_id, e.user_id, e.value, e.event_type, n AS recent_txn_count, s AS recent_amount
       FROM events e JOIN v ON e.user_id = v.user_id AND time_bucket(INTERVAL 1 DAY, e.ts) = v.w
       WHERE n > 2 AND (e.value > 100 OR e.event_type = 'error')
         AND v.w + INTERVAL 1 DAY <= (SELECT max(ts) - INTERVAL 10 MINUTE FROM events WHERE value > 100 OR event_type = 'error')""",
)
def fraud_alert_stream(spark, sf):
    path = scratch_dir(spark, "alerts")
    timed = views.watermark(_stream(spark, sf).drop("props"), "ts", "10 minutes")
    risky = transform.is_suspicious("value", "event_type", 100.0, "error")
    alerts = views.fraud_alerts(timed, risky, "ts", "user_id", "value", "1 day", 2)
    sinks.stream_file_sink(alerts, f"{path}/out", f"{path}/checkpoint", None).awaitTermination()
    return scan_parquet(spark, f"{path}/out").drop("ts")


def _dashboard(spark, sf):
    path = scratch_dir(spark, "dashboard")
    activity, pages = serving.activity_log(spark, f"{path}/activity"), serving.pages_log(spark, f"{path}/pages")
    for started in serving.start_dashboard(
        _stream(spark, sf), activity, pages, f"{path}/checkpoints", "ts", "user_id", "event_type", processing_time=None
    ):
        started.awaitTermination()
    return activity, pages


@query(
    "dashboard_activity_stream",
    """SELECT time_bucket(INTERVAL 10 SECOND, ts) - i * INTERVAL 10 SECOND AS window_start, count(*) AS event_count,
       count(DISTINCT user_id) AS unique_users FROM events, range(6) r(i) GROUP BY window_start""",
)
def dashboard_activity_stream(spark, sf):
    """The users of a window come from its panes' sketches, which count a few dozen values exactly."""
    activity, _ = _dashboard(spark, sf)
    return serving.dashboard_activity(activity).select("window_start", "event_count", "unique_users")


@query(
    "dashboard_pages_stream",
    """SELECT time_bucket(INTERVAL 5 MINUTE, ts) AS window_start, time_bucket(INTERVAL 5 MINUTE, ts) + INTERVAL 5 MINUTE
       AS window_end, event_type AS page, count(*) AS page_views FROM events GROUP BY ALL""",
)
def dashboard_pages_stream(spark, sf):
    _, pages = _dashboard(spark, sf)
    return serving.dashboard_pages(pages)


@query(
    "recommendation_stream",
    f"""SELECT time_bucket(INTERVAL 30 MINUTE, ts) AS window_start, user_id, count(item) AS interaction_count,
        array_to_string(list_transform(list_slice(list(item ORDER BY ts, event_id), 1, 5), lambda x: 'rec_' || x), ',') AS recommended
        FROM {T.ITEMS_SQL} GROUP BY ALL""",
)
def recommendation_stream(spark, sf):
    path = scratch_dir(spark, "recommendations")
    log = _dying(serving.items_log(spark, f"{path}/log"))
    stream = _stream(spark, sf).withColumn("item", F.get_json_object("props", "$.k"))
    _restarted(lambda: serving.start_recommendations(
        stream, log, f"{path}/checkpoint", "ts", "user_id", "item", "event_id", processing_time=None
    ), log)
    served = serving.served_recommendations(log)
    return served.select(
        "window_start", "user_id", "interaction_count", F.array_join("recommended_items", ",").alias("recommended")
    )


DAY_SQL = """SELECT time_bucket(INTERVAL 1 DAY, ts) AS window_start, user_id,
   CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total_revenue, count(*) AS event_count FROM events GROUP BY ALL"""


@query("speed_layer_view", DAY_SQL)
def speed_layer_view(spark, sf):
    path = scratch_dir(spark, "speed")
    log, stream = _dying(serving.speed_log(spark, f"{path}/log")), _stream(spark, sf)
    _restarted(lambda: serving.start_speed_layer(
        stream, log, f"{path}/checkpoint", "ts", "user_id", "value", "event_id", processing_time=None
    ), log)
    return serving.speed_view(log).drop("window_end")


@query(
    "lambda_serving",
    """SELECT user_id, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total_revenue, count(*) AS total_events
       FROM events GROUP BY user_id""",
)
def lambda_serving(spark, sf):
    path = scratch_dir(spark, "lambda")
    cutoff = F.lit("2024-01-25").cast("date")
    serving.write_batch_view(T.events(spark, sf), f"{path}/batch", "user_id", F.col("ts").cast("date"), "value", "event_id")
    log, stream = _dying(serving.speed_log(spark, f"{path}/log")), _stream(spark, sf)
    _restarted(lambda: serving.start_speed_layer(
        stream, log, f"{path}/checkpoint", "ts", "user_id", "value", "event_id", processing_time=None
    ), log)
    return serving.serve(scan_parquet(spark, f"{path}/batch"), log, cutoff)


@query(
    "kappa_replay",
    """SELECT user_id, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total_revenue, count(*) AS total_events
       FROM events GROUP BY user_id""",
)
def kappa_replay(spark, sf):
    path = scratch_dir(spark, "kappa")
    log, stream = _dying(serving.speed_log(spark, f"{path}/log")), _stream(spark, sf)
    _restarted(lambda: serving.start_replay(stream, log, f"{path}/checkpoint", "ts", "user_id", "value", "event_id"), log)
    return serving.replayed_totals(log)


@query("stream_health_history", "SELECT count(*) AS input_rows, 3 AS batches, true AS complete FROM events")
def stream_health_history(spark, sf):
    """Every micro-batch of a drained stream, though Spark itself is told to remember one."""
    path, name = scratch_dir(spark, "health"), "spark.sql.streaming.numRecentProgressUpdates"
    before = spark.conf.get(name)
    listener = health.ProgressLog(LeveledLog(spark, f"{path}/log"), every=2)
    spark.streams.addListener(listener)
    try:
        spark.conf.set(name, "1")
        stream = _stream(spark, sf)
        ended = sinks.stream_file_sink(stream, f"{path}/out", f"{path}/checkpoint", None)
        ended.awaitTermination()
        complete = listener.wait(ended)
    finally:
        spark.conf.set(name, before)
        spark.streams.removeListener(listener)
    with_input = listener.history().filter("input_rows > 0")
    return with_input.agg(F.sum("input_rows").alias("input_rows"), F.count("*").cast("int").alias("batches"), F.lit(complete).alias("complete"))


@query("stream_dedup", "SELECT DISTINCT l_orderkey, l_linenumber, l_shipdate FROM lineitem")
def stream_dedup(spark, sf):
    """Every line arrives twice; repeats of a line carry its time, so the watermark holds its state until then."""
    path = scratch_dir(spark, "dedup")
    lines = views.watermark(_stream(spark, sf, "lineitem", "l_shipdate").select("l_orderkey", "l_linenumber", "l_shipdate"), "l_shipdate", "1 day")
    twice = lines.withColumn("_copy", F.explode(F.array(F.lit(1), F.lit(2)))).drop("_copy")
    unique = views.stream_dedup(twice, ["l_orderkey", "l_linenumber", "l_shipdate"])
    sinks.stream_file_sink(unique, f"{path}/out", f"{path}/checkpoint", None).awaitTermination()
    return scan_parquet(spark, f"{path}/out").select("l_orderkey", "l_linenumber", "l_shipdate")


@query(
    "cdc_apply_stream",
    CDC_SQL.split("SELECT c_custkey", maxsplit=1)[0] + "SELECT id, name, email_score FROM last WHERE op <> 'd'",
)
def cdc_apply_stream(spark, sf):
    path = scratch_dir(spark, "cdc")
    log = _dying(sinks.cdc_log(spark, f"{path}/log", ["ts_ms", "offset"]))
    image = F.struct(F.col("user_id").alias("id"), F.col("event_type").alias("name"), F.col("value").alias("email_score"))
    op = F.when(F.col("event_type") == "signup", "c").when(F.col("event_type") == "error", "d").otherwise("u")
    envelopes = _stream(spark, sf, order="event_id").select(
        F.when(op != "c", image).alias("before"),
        F.when(op != "d", image).alias("after"),
        op.alias("op"),
        F.unix_millis(F.col("ts").cast("timestamp")).alias("ts_ms"),
        F.col("event_id").alias("offset"),
    )
    write = sinks.cdc_writer(log, "id", ["ts_ms", "offset"])
    _restarted(lambda: sinks.foreach_batch_sink(envelopes, write, f"{path}/checkpoint", "append", None), log)
    return sinks.cdc_current(log)


@query(
    "offset_ledger_stream",
    """SELECT event_id, 'events' AS topic, user_id % 3 AS "partition", event_id AS "offset", true AS inserted FROM events""",
)
def offset_ledger_stream(spark, sf):
    """Every slice is delivered twice; the second time its offsets are in the stream's state."""
    path = scratch_dir(spark, "offsets")
    log = LeveledLog(spark, f"{path}/log", fan_in=2)
    schema, files = _stage(spark, sf, f"{path}/in", order="event_id", slices=[n for n in range(SLICES) for _ in range(2)])
    messages = _read_slices(spark, f"{path}/in", schema, files).select(
        "event_id",
        F.lit("events").alias("topic"),
        (F.col("user_id") % 3).alias("partition"),
        F.col("event_id").alias("offset"),
    )
    unseen = views.unseen_messages(messages, "event_id", idempotent.OFFSET_KEYS)
    _drain(unseen, sinks.offset_writer(log, "event_id"), f"{path}/checkpoint", "append")
    return log.read().drop("batch_id")


@query(
    "upsert_sink",
    """SELECT user_id, event_type, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1""",
)
def upsert_sink(spark, sf):
    path = scratch_dir(spark, "upsert")
    table = BucketTable(spark, f"{path}/table", ["user_id"], ["event_id"], buckets=16)
    _drain(_stream(spark, sf, order="event_id"), sinks.upsert_writer(table), f"{path}/checkpoint", "append")
    return table.read().select("user_id", "event_type", "value")


@query("transition_stream", transition_sql(ALLOWED))
def transition_stream(spark, sf):
    """The same verdicts as in batch, one slice after the other; the state store is RocksDB."""
    path, name = scratch_dir(spark, "transitions"), "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    spark.conf.set(name, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        events = _stream(spark, sf, order="event_id").withColumn("wanted", T.wanted_status(F.col("event_type")))
        requests = events.withColumn("token", F.concat(F.lit("k"), (F.col("event_id") % 3).cast("string")))
        judged = transitions.transition_stream(requests, "user_id", "wanted", "event_id", "token")
        sinks.stream_file_sink(judged, f"{path}/out", f"{path}/checkpoint", None).awaitTermination()
    finally:
        spark.conf.set(name, before)
    asked = T.transitions(spark, sf).select("position", "wanted", F.col("entity").alias("asked_by"))
    verdicts = scan_parquet(spark, f"{path}/out").join(asked, "position")
    return verdicts.select(F.col("asked_by").alias("entity"), "position", "wanted", "current_status", "verdict")
