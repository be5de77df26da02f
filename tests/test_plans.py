"""Plans the operators are meant to give, and results when one key is hot."""

from __future__ import annotations

import contextlib
import io
import os
import random
from collections import Counter, defaultdict
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from millrace import session
from millrace.catalog import models
from millrace.functions import columns as C
from millrace.operators import aggregates, joins, lateness, quality, ranking, skew
from millrace.sources import batch

SF = "/root/testdata/sf0.001"
tables = pytest.mark.skipif(not os.path.isdir(SF), reason="needs the test tables")


def plan(df, mode="formatted"):
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain(mode)
    return text.getvalue()


@tables
def test_filter_and_columns_reach_the_scan(spark):
    df = batch.scan_parquet(spark, SF + "/events.parquet", F.col("event_type") == "purchase").select("event_id")
    text = plan(df)
    assert "EqualTo(event_type,purchase)" in text
    assert "ReadSchema: struct<event_id:bigint,event_type:string>" in text


def test_partition_predicate_prunes_folders(spark, folder):
    spark.range(10).withColumn("d", F.col("id") % 3).write.partitionBy("d").parquet(folder + "/t")
    text = plan(batch.scan_parquet(spark, folder + "/t", F.col("d") == 1))
    assert "PartitionFilters: [isnotnull(d" in text


def test_similar_items_runs_in_the_jvm(spark):
    df = spark.createDataFrame([(["a"] * 7,)], "items array<string>").select(C.similar_items("items").alias("r"))
    assert df.first().r == ["rec_a"] * 5
    assert "EvalPython" not in plan(df) and "pythonUDF" not in plan(df)


def test_latest_row_is_picked_before_the_exchange(spark, folder):
    spark.range(10).withColumn("k", F.col("id") % 2).write.parquet(folder + "/t")
    text = plan(ranking.dedup_keep_latest(spark.read.parquet(folder + "/t"), ["k"], ["id"]), "simple")
    assert text.index("Final") < text.index("Exchange") < text.index("Partial")


def test_top_k_does_not_sort_everything(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 1), "p")], "ts timestamp_ntz, page string")
    assert "TakeOrderedAndProject" in plan(ranking.top_pages(df, "ts", "page", limit=3), "simple")


def test_broadcast_only_behind_the_size_check(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        facts, dim = spark.range(1000), spark.range(50)
        assert "BroadcastHashJoin" in plan(joins.broadcast_dim_join(facts, dim, "id"), "simple")
        large = joins.broadcast_dim_join(facts, dim, "id", max_rows=49)
        assert "BroadcastHashJoin" not in plan(large, "simple")
        assert large.count() == 50
        wide = dim.withColumn("text", F.repeat(F.lit("x"), 1000))
        hinted = joins.broadcast_if_small(wide, max_bytes=10_000)
        assert "BroadcastHashJoin" not in plan(facts.join(hinted, "id"), "simple")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_one_pass_reports_scan_once(spark, folder):
    spark.range(10).withColumn("v", F.col("id") * 1.0).write.parquet(folder + "/t")
    df = spark.read.parquet(folder + "/t")
    for report in (quality.null_report(df, ["id", "v"]), quality.range_report(df, {"id": (0, 5), "v": (0, 5)})):
        assert plan(report, "simple").count("FileScan") == 1


def test_cohorts_need_no_join(spark):
    df = spark.createDataFrame([(1, datetime(2024, 1, 1), 1.0)], "c int, d timestamp_ntz, a double")
    text = plan(aggregates.cohort_retention(df, "c", "d", "a"), "simple")
    assert "Join" not in text and text.count("FileScan") == 0


@pytest.fixture(scope="module")
def hot(spark):
    """2000 events, a third of them of one user."""
    rng = random.Random(7)
    start = datetime(2024, 1, 1)
    data = [
        (n, start + timedelta(seconds=rng.randrange(7200)), 0 if n % 3 == 0 else rng.randrange(1, 30), f"i{rng.randrange(9)}")
        for n in range(2000)
    ]
    return data, spark.createDataFrame(data, "event bigint, ts timestamp_ntz, user bigint, item string")


def test_hot_group_is_collected_in_parts_and_whole(hot):
    data, df = hot
    parts = aggregates.collect_recent_items(df, "ts", "user", "item", "event", "30 minutes", part_rows=20).collect()
    got, expected = defaultdict(Counter), defaultdict(Counter)
    for row in parts:
        got[(row.window_start, row.user_id)].update(row.recent_items)
        assert len(row.recent_items) <= 20
    for _, ts, user, item in data:
        expected[(ts.replace(minute=ts.minute // 30 * 30, second=0), user)][item] += 1
    assert got == expected
    assert max(row.part for row in parts) > 3
    assert all(row.interaction_count == sum(expected[(row.window_start, row.user_id)].values()) for row in parts)


def test_trailing_velocity_of_a_hot_user(hot):
    data, df = hot
    got = {(r.user, r.second): r.trailing_count for r in joins.trailing_velocity(df, "ts", "user", 300).collect()}
    for _, ts, user, _ in data[:200]:
        expected = sum(1 for _, t, u, _ in data if u == user and ts - timedelta(seconds=300) < t <= ts)
        assert got[(user, ts)] == expected


def test_late_rows_do_not_depend_on_the_partitions(spark, hot, rows):
    data, df = hot
    seen, late = None, set()
    for event, ts, _, _ in data:
        if seen is not None and ts < seen - timedelta(minutes=10):
            late.add(event)
        seen = ts if seen is None else max(seen, ts)
    on_time, rejected = lateness.late_data_split(df, "ts", "event", "10 minutes")
    assert {r.event for r in rejected.collect()} == late
    assert on_time.count() == len(data) - len(late)


def test_rows_without_an_arrival_are_kept(spark, rows):
    data = [(1, "2024-01-01 12:00:00"), (None, "2024-01-02 00:00:00"), (2, "2024-01-01 11:00:00"), (None, None)]
    df = spark.createDataFrame(data, "arrival int, at string").withColumn("ts", F.col("at").cast("timestamp_ntz"))
    on_time, late = lateness.late_data_split(df, "ts", "arrival", "10 minutes")
    assert rows(late, "arrival") == [(2,)]
    assert len(rows(on_time, "arrival", "watermark")) == 3 and (None, None) in rows(on_time, "arrival", "watermark")


def test_rows_that_arrive_together_spread_over_tasks_and_are_judged_alike(spark):
    """A coarse clock: half of all rows arrive at once, and the order inside an arrival does not count."""
    data = [(n // 10 if n < 500 else 50, 1000 * (n // 10 if n < 500 else 50) - (4000 if n % 7 == 0 else n % 10)) for n in range(1000)]
    df = spark.createDataFrame(data, "arrival int, at int").withColumn("ts", F.timestamp_seconds("at"))
    on_time, late = lateness.late_data_split(df, "ts", "arrival", "10 minutes")
    peaks, mark, expected = {}, None, []
    for arrival, at in data:
        peaks[arrival] = max(peaks.get(arrival, at), at)
    for arrival in sorted(peaks):
        expected += [(a, at) for a, at in data if a == arrival and mark is not None and at < mark - 600]
        mark = peaks[arrival] if mark is None else max(mark, peaks[arrival])
    assert sorted((r.arrival, r.at) for r in late.collect()) == sorted(expected) and expected
    assert on_time.count() == 1000 - len(expected)


def test_corrections_fold_into_closed_windows_and_out_again(spark, rows):
    closed = spark.createDataFrame([(1, 10, 3), (2, 5, 1), (None, 1, 1)], "w int, total long, n long")
    late = spark.createDataFrame([(1, 4), (1, -2), (3, 7), (None, 2)], "w int, v int")
    sums = [F.sum("v").alias("total"), F.count("*").alias("n")]
    deltas = lateness.corrections(late, ["w"], sums)
    folded = lateness.fold_corrections(closed, deltas, ["w"], ["total", "n"], rows="n")
    assert rows(folded) == sorted([(1, 12, 5), (2, 5, 1), (3, 7, 1), (None, 3, 2)], key=repr)
    again = lateness.corrections(late, ["w"], sums, retract=True)
    assert rows(lateness.fold_corrections(folded, again, ["w"], ["total", "n"], rows="n")) == rows(closed)
    assert rows(lateness.fold_corrections(closed, deltas.limit(0), ["w"], ["total", "n"])) == rows(closed)


def test_orphans_with_a_hot_null_key(spark, rows):
    child = spark.createDataFrame([(None if n % 2 else n % 5,) for n in range(100)], "fk int")
    parent = spark.createDataFrame([(0,), (2,), (2,), (None,)], "pk int")
    assert joins.orphan_rows(child, parent, "fk", "pk").count() == 80
    assert joins.valid_child_rows(child, parent, "fk", "pk").count() == 20
    report = quality.referential_report(child, parent, "fk", "pk").first()
    assert (report.child_rows, report.orphan_rows, report.null_key_rows) == (100, 80, 50)


@pytest.mark.parametrize("null_safe", [False, True])
@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_spread_join_gives_the_plain_result(spark, rows, how, null_safe):
    facts = spark.createDataFrame(
        [(None if n % 5 == 0 else 7 if n % 2 else n, "same" if n % 2 else str(n)) for n in range(400)], "k int, v string"
    )
    lookup = spark.createDataFrame([(7, "a"), (7, "b"), (2, "c"), (4, "d"), (None, "n")], "k int, w string")
    assert {row["_parts"] > 1 for row in skew.hot_keys(facts, ["k"], min_rows=20).collect()} == {True}
    spread = skew.lookup_join(facts, lookup, ["k"], how, null_safe, min_rows=20)
    assert rows(spread) == rows(skew.keyed_join(facts, lookup, ["k"], how, null_safe))


def test_small_inputs_have_no_hot_keys(spark):
    assert skew.hot_keys(spark.range(10), ["id"]) is None
    assert skew.hot_keys(spark.range(0), ["id"]) is None
    with pytest.raises(ValueError, match="full_outer"):
        skew.lookup_join(spark.range(1), spark.range(1), ["id"], "full_outer")


def test_equal_rows_of_a_hot_key_are_spread(spark):
    copies = spark.range(0, 4000, 1, 16).select(F.lit(1).alias("k"), F.lit("x").alias("v"))
    salted = skew.add_salt(copies, ["k"], skew.hot_keys(copies, ["k"], min_rows=100))
    assert salted.select("_salt").distinct().count() > 5


@pytest.mark.parametrize(("left", "right"), [("int", "bigint"), ("bigint", "int"), ("string", "int"), ("double", "int")])
def test_spread_join_across_key_types(spark, left, right):
    facts = spark.range(300).select((F.col("id") % 3).cast(left).alias("k"), "id")
    lookup = spark.range(5).select(F.col("id").cast(right).alias("k"), F.lit("x").alias("w"))
    assert skew.hot_keys(facts, ["k"], min_rows=20) is not None
    assert skew.lookup_join(facts, lookup, ["k"], min_rows=20).count() == 300


def test_tasks_of_feature_joins_do_not_grow_with_the_tables(spark, folder):
    """The number of shuffle partitions is enough for large tables; the caller's settings come back with the next query."""
    tables = {
        "lineitem": "id AS l_orderkey, id % 3 AS l_partkey, 2.5D AS l_extendedprice",
        "orders": "id AS o_orderkey, id % 2 AS o_custkey, timestamp_ntz'1999-05-01' AS o_orderdate",
        "part": "id AS p_partkey, 'kind' AS p_type",
    }
    for name, columns in tables.items():
        spark.range(4).selectExpr(*columns.split(", ")).write.parquet(f"{folder}/{name}.parquet")
    session.configure(spark)
    before = {key: spark.conf.get(key, None) for key in session.SPREAD_SETTINGS}
    df = models.assemble_features(spark, folder)
    assert ", 960)" in plan(df)
    assert {tuple(r) for r in df.select("customer_id", "purchase_frequency", "num_categories_purchased").collect()} == {(0, 2, 1), (1, 2, 1)}
    session.configure(spark)
    assert {key: spark.conf.get(key, None) for key in session.SPREAD_SETTINGS} == before


def test_reconciling_exchanges_once_so_that_partitions_can_be_sized(spark, folder):
    for name in ("left", "right"):
        spark.range(10).withColumn("v", F.col("id") * 1.5).write.parquet(f"{folder}/{name}")
    left, right = (spark.read.parquet(f"{folder}/{name}") for name in ("left", "right"))
    df = quality.reconcile_tables(left, right.filter("id > 0"), ["id"], ["v"])
    assert plan(df, "simple").count("Exchange hashpartitioning") == 1
    assert [(r.id, r.left_rows, r.right_rows, r.right_v, r.status) for r in df.collect()] == [(0, 1, 0, None, "only_left")]
