"""Streams drained over staged files, compared with the bounded computation."""

from __future__ import annotations

import os
import random

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from millrace.catalog import streams
from millrace.operators import joins, transform
from millrace.operators import transitions as bounded
from millrace.plans import serving
from millrace.sources.buckets import BucketTable
from millrace.streaming import health, sinks, transitions, views
from millrace.streaming.logs import LeveledLog, newest

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="needs the test tables")

SLICES = 6


@pytest.fixture
def staged(spark, folder):
    """Events as one file per time slice, in order, with a closing row far ahead."""
    def stage(flush):
        events = spark.read.parquet(SF + "/events.parquet").drop("props")
        path = folder + "/staged"
        os.mkdir(path)
        frame = events.toPandas().sort_values("ts")
        step = len(frame) // SLICES + 1
        for number in range(SLICES):
            part = spark.createDataFrame(frame.iloc[number * step : (number + 1) * step], events.schema)
            _place(part, path, number)
        _place(spark.createDataFrame([flush], events.schema), path, SLICES)
        stream = sinks.file_stream(spark, path, events.schema, "parquet", max_files=1)
        return events, stream

    def _place(part, path, number):
        part.coalesce(1).write.parquet(f"{folder}/part{number}")
        source = next(f for f in os.listdir(f"{folder}/part{number}") if f.endswith(".parquet"))
        target = f"{path}/{number}.parquet"
        os.link(f"{folder}/part{number}/{source}", target)
        os.utime(target, (1_700_000_000 + number, 1_700_000_000 + number))

    return stage


def flush(event_type="error", value=1000.0):
    from datetime import datetime

    return (10**9, datetime(2030, 1, 1), -1, event_type, value)


def test_append_windows_equal_batch(spark, staged, folder, rows):
    events, stream = staged(flush())
    windows = views.tumbling_velocity(views.watermark(stream, "ts", "10 minutes"), "ts", "user_id", "value")
    sinks.stream_file_sink(views.window_columns(windows), folder + "/out", folder + "/cp", None).awaitTermination()
    expected = views.window_columns(views.tumbling_velocity(events, "ts", "user_id", "value"))
    columns = expected.columns
    assert rows(spark.read.parquet(folder + "/out"), *columns) == rows(expected)


def test_fraud_alerts_equal_batch(spark, staged, folder, rows):
    events, stream = staged(flush())
    risky = transform.is_suspicious("value", "event_type", 100.0, "error")
    timed = views.watermark(stream, "ts", "10 minutes")
    alerts = views.fraud_alerts(timed, risky, "ts", "user_id", "value", "1 day", 1)
    sinks.stream_file_sink(alerts, folder + "/out", folder + "/cp", None).awaitTermination()
    expected = joins.fraud_interval_join(events, risky, "ts", "user_id", "value", "1 day", 1)
    assert expected.count() > 0
    columns = ["event_id", "recent_txn_count", "recent_amount"]
    assert rows(spark.read.parquet(folder + "/out"), *columns) == rows(expected, *columns)


def test_dashboard_users_are_close_to_exact_and_its_state_is_bounded(spark, staged, folder, rows):
    events, stream = staged(flush())
    activity, pages = serving.activity_log(spark, folder + "/activity", fan_in=2), serving.pages_log(spark, folder + "/pages", fan_in=2)
    started = serving.start_dashboard(stream, activity, pages, folder + "/cp", "ts", "user_id", "event_type", "1 minute", "3 hours", None)
    for query in started:
        query.awaitTermination()
    got = {r.window_start: r for r in serving.dashboard_activity(activity, "6 hours", "3 hours").collect()}
    exact = views.window_columns(views.sliding_activity(events, "ts", "user_id", "6 hours", "3 hours")).collect()
    for row in exact:
        assert got[row.window_start].event_count == row.event_count
        assert got[row.window_start].unique_users == pytest.approx(row.unique_users, rel=0.05)
    viewed = views.window_columns(views.page_views(events, "ts", "event_type"))
    assert rows(serving.dashboard_pages(pages).filter("page_views < 10 AND window_start < '2029-01-01'"), *viewed.columns) == rows(viewed)
    # The watermark closes panes and windows: state does not follow the number of either.
    state = [sum(o.numRowsTotal for o in p.stateOperators) for p in started[0].recentProgress]
    assert max(state) < len(exact) / 4


def test_pane_sketches_count_many_users_within_their_bound(spark):
    users = spark.range(300_000).select((F.col("id") % 100_000).alias("user_id"), F.timestamp_seconds(F.col("id") % 60).alias("ts"))
    panes = views.window_columns(views.activity_panes(users, "ts", "user_id", "10 seconds"))
    got = views.activity_of_panes(panes).filter("event_count = 300000").first()
    assert got.unique_users == pytest.approx(100_000, rel=3 * 0.016)


def test_progress_shows_the_watermark_lag(spark, staged, folder):
    _, stream = staged(flush())
    windows = views.tumbling_velocity(views.watermark(stream, "ts", "10 minutes"), "ts", "user_id", "value")
    query = sinks.stream_file_sink(views.window_columns(windows), folder + "/out", folder + "/cp", None)
    query.awaitTermination()
    batches = health.stream_progress(query).collect()
    assert sum(b.input_rows for b in batches) == 1001
    assert any(b.watermark_lag_seconds and b.watermark_lag_seconds >= 600 for b in batches)
    assert max(b.state_rows for b in batches) > 0


def test_the_history_of_a_stream_has_no_holes(spark, staged, folder, rows):
    _, stream = staged(flush())
    kept = spark.conf.get("spark.sql.streaming.numRecentProgressUpdates")
    listener = health.ProgressLog(LeveledLog(spark, folder + "/log", fan_in=2), every=2)
    spark.streams.addListener(listener)
    try:
        spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
        for attempt in range(2):
            query = sinks.stream_file_sink(stream, f"{folder}/out{attempt}", f"{folder}/cp{attempt}", None)
            query.awaitTermination()
            assert listener.wait(query) and len(query.recentProgress) <= 2
    finally:
        spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", kept)
        spark.streams.removeListener(listener)
    history = listener.history().filter("input_rows > 0")
    assert history.count() == 2 * (SLICES + 1)
    assert history.agg(F.sum("input_rows")).first()[0] == 2 * 1001


def test_resume_adds_nothing(spark, staged, folder):
    _, stream = staged(flush())
    for _ in range(3):
        sinks.stream_file_sink(stream, folder + "/out", folder + "/cp", None).awaitTermination()
    out = spark.read.parquet(folder + "/out")
    assert out.count() == out.select("event_id").distinct().count() == 1001


def test_retries_are_dropped_in_stream(spark, staged, folder):
    _, stream = staged(flush())
    doubled = stream.unionByName(stream)
    unique = views.stream_dedup(views.watermark(doubled, "ts", "10 minutes"), ["event_id"])
    sinks.stream_file_sink(unique, folder + "/out", folder + "/cp", None).awaitTermination()
    assert spark.read.parquet(folder + "/out").count() == 1001


def test_recommendations_equal_batch(spark, staged, folder, rows):
    events, stream = staged(flush())
    log = serving.items_log(spark, folder + "/log", fan_in=2)
    serving.start_recommendations(
        stream, log, folder + "/cp", "ts", "user_id", "event_type", "event_id", "1 day", None
    ).awaitTermination()
    from millrace.operators import aggregates

    expected = aggregates.first_items(events, "ts", "user_id", "event_type", "event_id", "1 day")
    got = serving.served_recommendations(log).filter("user_id >= 0")
    assert rows(got, "window_start", "user_id", "recommended_items") == [
        (start, user, [f"rec_{item}" for item in items]) for start, user, items in rows(expected)
    ]


MESSAGE = "event_id bigint, topic string, partition int, offset bigint"


def deliver(spark, folder, name, messages, at):
    """Messages arrive as one file."""
    spark.createDataFrame(messages, MESSAGE).coalesce(1).write.parquet(f"{folder}/staged-{name}")
    os.makedirs(folder + "/in", exist_ok=True)
    source = next(f for f in os.listdir(f"{folder}/staged-{name}") if f.endswith(".parquet"))
    os.link(f"{folder}/staged-{name}/{source}", f"{folder}/in/{name}.parquet")
    os.utime(f"{folder}/in/{name}.parquet", (1_700_000_000 + at, 1_700_000_000 + at))


def drain_offsets(spark, folder, log, write=None):
    stream = sinks.file_stream(spark, folder + "/in", spark.createDataFrame([], MESSAGE).schema, "parquet", max_files=1)
    unseen = views.unseen_messages(stream, "event_id", ["topic", "partition", "offset"])
    query = sinks.foreach_batch_sink(unseen, write or sinks.offset_writer(log, "event_id"), folder + "/cp", "append", None)
    query.awaitTermination()
    return query


def test_offsets_are_applied_once_over_restarts(spark, folder, rows):
    log = LeveledLog(spark, folder + "/log")
    deliver(spark, folder, "a", [(5, "t", 0, 5), (6, "t", 0, 6), (6, "t", 1, 6), (None, "t", 0, 7), (None, "t", 0, 8)], 0)
    drain_offsets(spark, folder, log)
    assert rows(log.read(), "event_id", "partition", "offset", "inserted") == sorted(
        [(5, 0, 5, True), (6, 0, 6, True), (6, 1, 6, False), (None, 0, 7, True), (None, 0, 8, False)], key=repr
    )
    deliver(spark, folder, "b", [(5, "t", 0, 5), (5, "t", 0, 5000), (7777, "t", 0, 7777), (7777, "t", 0, 7777)], 1)
    for _ in range(2):
        drain_offsets(spark, folder, log)
    assert rows(log.read().filter("batch_id > 0"), "offset", "inserted") == [(5000, False), (7777, True)]


def test_offset_batches_read_no_history(spark, folder):
    """Twenty batches, and before each all that earlier ones left is made unreadable."""
    log, found = LeveledLog(spark, folder + "/log", fan_in=100), []
    for n in range(20):
        seen = [(100 * m + k, "t", 0, 100 * m + k) for m in {max(0, n - 7), n} for k in range(50)]
        deliver(spark, folder, f"f{n:02d}", seen, n)
    write = sinks.offset_writer(log, "event_id")

    def spoiling(batch, batch_id):
        write(batch, batch_id)
        newest = log.segments()[-1].folder
        found.append(spark.read.parquet(f"{log.path}/{newest}").filter("inserted").count())
        for name in os.listdir(f"{log.path}/{newest}"):
            os.truncate(f"{log.path}/{newest}/{name}", 0)

    query = drain_offsets(spark, folder, log, spoiling)
    assert found == [50] * 20
    updated = [sum(o.numRowsUpdated for o in p.stateOperators) for p in query.recentProgress if p.numInputRows]
    assert len(updated) == 20 and max(updated) <= updated[0]


def test_seen_messages_expire_with_the_watermark(spark, folder):
    os.mkdir(folder + "/in")
    frame = "event_id bigint, topic string, partition int, offset bigint, ts timestamp_ntz"
    for n in range(12):
        rows = spark.range(50 * n, 50 * n + 50).select(
            F.col("id").alias("event_id"), F.lit("t").alias("topic"), F.lit(0).alias("partition"), F.col("id").alias("offset"),
            F.timestamp_seconds(F.lit(1_700_000_000 + 3600 * n)).cast("timestamp_ntz").alias("ts"),
        )
        rows.coalesce(1).write.parquet(f"{folder}/staged{n}")
        source = next(f for f in os.listdir(f"{folder}/staged{n}") if f.endswith(".parquet"))
        os.link(f"{folder}/staged{n}/{source}", f"{folder}/in/{n:02d}.parquet")
        os.utime(f"{folder}/in/{n:02d}.parquet", (1_700_000_000 + n, 1_700_000_000 + n))
    stream = sinks.file_stream(spark, folder + "/in", spark.createDataFrame([], frame).schema, "parquet", max_files=1)
    log = LeveledLog(spark, folder + "/log")
    unseen = views.unseen_messages(stream, "event_id", ["topic", "partition", "offset"], "ts", "2 hours")
    query = sinks.foreach_batch_sink(unseen, sinks.offset_writer(log, "event_id"), folder + "/cp", "append", None)
    query.awaitTermination()
    assert log.read().filter("inserted").count() == 600
    state = [sum(o.numRowsTotal for o in p.stateOperators) for p in query.recentProgress]
    assert max(state) <= 3 * 50 * 5


def kv(spark, *rows):
    return spark.createDataFrame(rows, "k int, v int").coalesce(1)


def test_log_retry_replaces_its_batch(spark, folder, rows):
    log = LeveledLog(spark, folder + "/log", newest(["k"]))
    with pytest.raises(ValueError):
        log.read()
    log.write(kv(spark, (1, 1), (2, 2)), 0)
    for _ in range(3):
        log.write(kv(spark, (2, 3)), 1)
    assert rows(log.current(), "k", "v") == [(1, 1), (2, 3)]
    assert log.read().count() == 3
    with pytest.raises(ValueError):
        log.write(kv(spark, (1, 1)), 0)


def test_a_log_merges_itself_and_reads_the_same(spark, folder, rows):
    log, state = LeveledLog(spark, folder + "/log", newest(["k"]), fan_in=3), {}
    for n in range(30):
        batch = [(n % 4, n), (100 + n, -n)]
        state |= dict(batch)
        log.write(kv(spark, *batch), n)
        levels = [segment.level for segment in log.segments()]
        assert levels == sorted(levels, reverse=True)
        assert all(levels.count(level) <= 3 for level in levels)
        assert [s.first for s in log.segments()] == [0, *[s.last + 1 for s in log.segments()[:-1]]]
    assert dict(rows(log.current(), "k", "v")) == state
    assert max(levels) == 3
    held = [name for name in os.listdir(log.path) if name.startswith("segment-")]
    assert len(held) <= len(levels) + 4


@pytest.mark.parametrize("step", ["write", "commit", "merge", "merged", "sweep"])
def test_a_log_whose_writer_dies_anywhere_is_whole(spark, folder, rows, step):
    class Dying(LeveledLog):
        alive = False

        def die(self, where):
            if where == step and not self.alive:
                raise OSError(step)

        def _write(self, batch, level):
            folder = super()._write(batch, level)
            self.die("merged" if level else "write")
            return folder

        def _commit(self, segments, dropped):
            super()._commit(segments, dropped)
            self.die("commit")

        def _merge(self, due):
            self.die("merge")
            return super()._merge(due)

        def sweep(self, keep):
            self.die("sweep")
            super().sweep(keep)

    log, state = Dying(spark, folder + "/log", newest(["k"]), fan_in=2), {}
    for n in range(8):
        batch = [(n % 3, n)]
        state |= dict(batch)
        log.alive = n not in (2, 5)
        try:
            log.write(kv(spark, *batch), n)
        except OSError:
            log.alive = True
            assert rows(log.current(), "k", "v")
            log.write(kv(spark, *batch), n)
        assert dict(rows(log.current(), "k", "v")) == state
    assert len(log.segments()) <= 5

    def held():
        return {name for name in os.listdir(log.path) if name.startswith("segment-")}

    stray = held() - {segment.folder for segment in log.segments()}
    log.write(kv(spark), 8)
    assert not stray & held()


def test_an_upsert_rewrites_only_the_buckets_it_hits(spark, folder, rows):
    table = BucketTable(spark, folder + "/table", ["k"], ["v"], buckets=16)
    assert table.read() is None
    table.upsert(spark.range(2000).selectExpr("cast(id AS int) AS k", "0 AS v"))
    assert len(table.folders()) == 16

    def files():
        return {(f, os.stat(f).st_ino) for f in (os.path.join(d, name) for d, _, names in os.walk(folder + "/table") for name in names) if f.endswith(".parquet")}

    before = files()
    for _ in range(3):
        table.upsert(kv(spark, (7, 1), (7, 2), (1234, 5)))
        kept = before & files()
        assert len(before) == 16 and len(kept) >= 14
    expected = {k: 0 for k in range(2000)} | {7: 2, 1234: 5}
    assert rows(table.read(), "k", "v") == sorted(expected.items(), key=repr)
    assert len(files()) <= 18
    table.upsert(spark.createDataFrame([(None, 9, "n")], "k int, v int, note string"))
    table.upsert(spark.createDataFrame([(None, 10, "m")], "k int, v int, note string"))
    assert rows(table.read().filter("note IS NOT NULL"), "k", "v", "note") == [(None, 10, "m")]
    assert rows(table.lookup(kv(spark, (7, 0), (5000, 0), (1234, 0))), "k", "v") == [(1234, 5), (7, 2)]
    with pytest.raises(ValueError):
        BucketTable(spark, folder + "/table", ["k"], ["v"], buckets=8).read()


def test_a_bucket_table_survives_a_writer_that_dies(spark, folder, rows):
    table = BucketTable(spark, folder + "/table", ["k"], ["v"], buckets=4)
    table.upsert(kv(spark, (1, 1), (2, 2), (3, 3)))

    def dies(*_):
        raise OSError

    for name in ("_commit", "_sweep"):
        broken = BucketTable(spark, folder + "/table", ["k"], ["v"], buckets=4)
        setattr(broken, name, dies)
        with pytest.raises(OSError):
            broken.upsert(kv(spark, (2, 20)))
        assert rows(table.read(), "k", "v") == [(1, 1), (2, 2 if name == "_commit" else 20), (3, 3)]
    table.upsert(kv(spark, (2, 20)))
    assert rows(table.read(), "k", "v") == [(1, 1), (2, 20), (3, 3)]


def test_added_column_survives_a_restart(spark, folder, rows):
    import json

    os.mkdir(folder + "/in")

    def place(name, row, at):
        with open(f"{folder}/in/{name}", "w") as out:
            out.write(json.dumps(row) + "\n")
        os.utime(f"{folder}/in/{name}", (at, at))

    def drain(ddl):
        schema = spark.createDataFrame([], ddl).schema
        arrived = sinks.file_stream_ingest(spark, folder + "/in", schema).drop("ingestion_time", "file_name")
        sinks.stream_file_sink(arrived, folder + "/out", folder + "/cp", None).awaitTermination()

    place("1.json", {"a": 1}, 1_700_000_000)
    drain("a int")
    place("2.json", {"a": 2, "b": "x"}, 1_700_000_100)
    drain("a int, b string")
    out = spark.read.schema("a int, b string").parquet(folder + "/out")
    assert rows(out) == [(1, None), (2, "x")]


def test_streamed_transitions_equal_batch(spark, staged, folder, rows):
    events, stream = staged(flush())
    spark.conf.set(
        "spark.sql.streaming.stateStore.providerClass",
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    )
    kinds = random.Random(1).sample(["confirmed", "shipped", "delivered", "cancelled", "returned"], 5)
    names = ["signup", "view", "purchase", "error", "click"]

    def shaped(df):
        wanted = F.coalesce(*[F.when(F.col("event_type") == n, k) for n, k in zip(names, kinds, strict=True)])
        return df.select("user_id", "event_id", wanted.alias("wanted"), (F.col("event_id") % 3).cast("string").alias("token"))

    judged = transitions.transition_stream(shaped(stream), "user_id", "wanted", "event_id", "token")
    query = (
        judged.writeStream.format("parquet").option("checkpointLocation", folder + "/cp").trigger(availableNow=True)
        .start(folder + "/out")
    )
    query.awaitTermination()
    expected = bounded.state_transition_check(shaped(events), "user_id", "wanted", ["event_id"], "token")
    got = spark.read.parquet(folder + "/out").filter("entity <> '-1'")
    assert rows(got, "position", "current_status", "verdict") == rows(expected, "event_id", "current_status", "verdict")


def test_transitions_reach_python_as_rows_and_unchanged_state_is_not_written():
    class State:
        value, written = None, 0

        def get(self):
            return self.value

        def update(self, value):
            self.value, self.written = value, self.written + 1

    judge = transitions.TransitionProcessor({"pending": ["confirmed"], "confirmed": ["shipped"]}, "pending")
    judge.state = State()

    def judged(*asked):
        rows = [Row(position=position, wanted=wanted, token=token) for position, wanted, token in asked]
        return [(r.position, r.current_status, r.verdict) for r in judge.handleInputRows(("e",), iter(rows), None)]

    assert judged((1, "shipped", "a"), (0, "pending", None)) == [(0, "pending", "same_state"), (1, "pending", "invalid")]
    assert judge.state.written == 0
    assert judged((3, "shipped", "a"), (2, "confirmed", "a"), (4, "shipped", "b")) == [
        (2, "pending", "applied"), (3, "confirmed", "same_key"), (4, "confirmed", "applied")]
    assert (judge.state.value, judge.state.written) == (("shipped", "b"), 1)


def test_files_of_a_slice_follow_its_rows(spark, folder, monkeypatch):
    """Nearly all rows lie in the first slice and none in the second: no file is large, and every slice has as many."""
    monkeypatch.setattr(streams, "FILE_ROWS", 100)
    early = spark.range(700).select(F.col("id").alias("event_id"), (F.col("id") % 50).alias("at"))
    early.union(spark.createDataFrame([(700, 3000), (701, 3000)], early.schema)).selectExpr("event_id", "timestamp_seconds(at) AS ts").write.parquet(folder + "/events.parquet")
    schema, files = streams._stage(spark, folder, folder + "/staged")
    staged = spark.read.schema(schema).parquet(folder + "/staged").select("event_id", F.col("_metadata.file_name").alias("file"))
    assert files == 7
    assert sum(name.endswith(".parquet") for name in os.listdir(folder + "/staged")) == 21
    assert staged.count() == staged.select("event_id").distinct().count() == 702
    assert staged.groupBy("file").count().agg(F.max("count")).first()[0] <= 150
