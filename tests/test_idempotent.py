from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from millrace.functions import values as V
from millrace.operators import idempotent, ranking, segments, transitions, versions
from millrace.sources.tables import VersionedTable, partition_overwrite


def judge_transitions(events, table, initial):
    """Brute force: one entity after the other, one event after the other."""
    out, state = {}, {}
    for entity, position, wanted, token in sorted(events, key=lambda e: e[1]):
        status, last = state.get(entity, (initial, None))
        if wanted == status:
            verdict = "same_state"
        elif wanted not in table.get(status, ()):
            verdict = "invalid"
        elif token and token == last:
            verdict = "same_key"
        else:
            verdict = "applied"
            state[entity] = (wanted, token)
        out[(entity, position)] = (status, verdict)
    return out


@pytest.mark.parametrize(
    ("seed", "max_rows", "fanout"), [(0, 2000, 256), (1, 2000, 256), (2, 1, 2), (3, 5, 3), (4, 60, 256), (5, 7, 4)]
)
@pytest.mark.parametrize("cyclic", [False, True])
def test_transitions_agree_with_brute_force(spark, seed, max_rows, fanout, cyclic):
    rng = random.Random(seed)
    statuses = [*V.ORDER_TRANSITIONS, "unknown"]
    events = [
        (rng.choice([0, 0, 0, 1, 2, 3, None]), position, rng.choice(statuses), rng.choice(["a", "b", "", None]))
        for position in range(300)
    ]
    df = spark.createDataFrame(events, "entity int, position int, wanted string, token string")
    table = dict(V.ORDER_TRANSITIONS)
    if cyclic:
        table |= {"delivered": ["shipped", "returned"], "returned": ["pending"], "cancelled": ["confirmed"]}
    judged = transitions.state_transition_check(
        df, "entity", "wanted", ["position"], "token", transitions=table, max_rows=max_rows, fanout=fanout
    )
    got = {(r.entity, r.position): (r.current_status, r.verdict) for r in judged.collect()}
    assert got == judge_transitions(events, table, "pending")


def test_shorter_transition_table_is_an_argument(spark, rows):
    table = {"pending": ["confirmed", "cancelled"], "confirmed": ["shipped", "cancelled"], "shipped": ["delivered"]}
    df = spark.createDataFrame([(1, 1, "confirmed"), (1, 2, "shipped"), (1, 3, "returned")], "e int, p int, w string")
    judged = transitions.state_transition_check(df, "e", "w", ["p"], transitions=table)
    assert rows(judged, "p", "verdict") == [(1, "applied"), (2, "applied"), (3, "invalid")]


@pytest.mark.parametrize("max_rows", [2000, 2])
def test_entities_that_never_start_are_all_invalid(spark, rows, max_rows):
    df = spark.createDataFrame([(n % 9, n, "returned") for n in range(90)], "e int, p int, w string").repartition(4)
    judged = transitions.state_transition_check(df, "e", "w", ["p"], max_rows=max_rows)
    assert set(rows(judged, "current_status", "verdict")) == {("pending", "invalid")}


@pytest.mark.parametrize("max_rows", [10, 5, 1])
def test_cyclic_transition_tables_work_at_every_segment_size(spark, rows, max_rows):
    cyclic = {"a": ["b"], "b": ["a"]}
    df = spark.createDataFrame([(1, n, "ba"[n % 2]) for n in range(8)], "e int, p int, w string")
    judged = transitions.state_transition_check(df, "e", "w", ["p"], transitions=cyclic, initial="a", max_rows=max_rows)
    assert set(rows(judged, "verdict")) == {("applied",)}


def test_segments_are_cut_by_rank(spark, rows):
    df = spark.createDataFrame([("k", n if n < 500 else 10**12) for n in range(501)], "k string, p bigint")
    cut = segments.cut_segments(df, ["k"], ["p"], 50, "test")
    sizes = cut.groupBy("_segment").count().collect()
    assert max(r["count"] for r in sizes) <= 50 and len(sizes) >= 11


def judge_versions(updates, start):
    out, current = {}, {}
    for key, position, expected in sorted(updates, key=lambda u: (str(u[0]), u[1])):
        version = current.get(key, start.get(key, 0))
        if version > expected:
            verdict = "already_updated"
        elif version < expected:
            verdict = "conflict"
        else:
            verdict = "applied"
            current[key] = version + 1
        out[(key, position)] = (version, verdict)
    return out


@pytest.mark.parametrize("max_rows", [5, 50, 5_000])
def test_version_updates_agree_with_brute_force_when_one_record_is_hot(spark, max_rows):
    rng = random.Random(max_rows)
    updates = []
    for position in range(600):
        key = "hot" if position % 3 else f"k{rng.randrange(40)}"
        updates.append((key, position, max(0, position // 12 + rng.choice([-3, -1, 0, 0, 0, 1, 2]) if key == "hot" else rng.randrange(4))))
    start = {"hot": 2, "k1": 1}
    df = spark.createDataFrame(updates, "k string, p bigint, expected bigint")
    current = spark.createDataFrame(list(start.items()), "k string, version bigint")
    judged = versions.version_gated_update(df, "k", "expected", ["p"], current, max_rows)
    got = {(r.k, r.p): (r.current_version, r.verdict) for r in judged.collect()}
    assert got == judge_versions(updates, start)


@pytest.mark.parametrize("seed", range(20))
def test_segment_summaries_say_where_a_version_leads(seed):
    rng = random.Random(seed)
    expected = [rng.randrange(8) for _ in range(40)]
    runs = versions.summarize_segment(expected)
    assert all(a[1] < b[0] for a, b in zip(runs, runs[1:]))
    for start in range(10):
        version = start
        for value in expected:
            version += version == value
        assert version == next((out for low, high, out in runs if low <= start <= high), start)


def test_segments_are_summarised_in_batches(spark, monkeypatch):
    """Many small segments go to Python as rows of Arrow batches, not as a group each."""
    plans, kept = [], versions.materialize

    def noted(df, label):
        plans.append((label, df._jdf.queryExecution().toString()))
        return kept(df, label)

    monkeypatch.setattr(versions, "materialize", noted)
    updates = [(f"k{n % 50}", n, n // 50 - (n % 3 == 0)) for n in range(1000)]
    judged = versions.version_gated_update(spark.createDataFrame(updates, "k string, p bigint, expected bigint"), "k", "expected", ["p"], max_rows=4)
    assert {(r.k, r.p): (r.current_version, r.verdict) for r in judged.collect()} == judge_versions(updates, {})
    maps = [plan for label, plan in plans if label == "version-maps"]
    assert "ArrowEvalPython" in maps[0]
    assert not any("FlatMapGroups" in plan for plan in maps)


@pytest.mark.parametrize("width", [3, 1024])
def test_maps_of_one_record_compose_over_many_levels(spark, monkeypatch, width):
    """Scattered versions, NULL keys and expectations, and segments of a few rows: six levels of maps."""
    monkeypatch.setattr(versions, "WIDTH", width)
    rng, updates, guess = random.Random(width), [], {}
    for position in range(400):
        key = rng.choice([1, 1, 1, 1, None, 2])
        at = guess.setdefault(key, 0)
        expected = rng.choice([at, at, at + rng.randrange(-2, 4), rng.randrange(3000), None])
        guess[key] = at + (expected == at)
        updates.append((key, position, expected))
    df = spark.createDataFrame(updates, "k int, p bigint, expected bigint").repartition(3)
    judged = versions.version_gated_update(df, "k", "expected", ["p"], max_rows=5)
    known = judge_versions([u for u in updates if u[2] is not None], {})
    got = {(r.k, r.p): (r.current_version, r.verdict) for r in judged.collect()}
    assert len(got) == 400
    assert {at: verdict for at, verdict in got.items() if at in known} == known
    assert all(verdict == "conflict" for at, (_, verdict) in got.items() if at not in known)


def test_no_group_of_a_composition_follows_the_record(spark, monkeypatch):
    """A record with 6,000 scattered versions: what a bucket of any of its maps holds stays below the bucket's width."""
    monkeypatch.setattr(versions, "WIDTH", 64)
    kept, largest = versions.materialize, []

    def measured(df, label):
        written = kept(df, label)
        if label == "version-maps":
            counts = written.groupBy("_key", "node", "bucket").count().agg({"count": "max", "*": "count"}).first()
            largest.append((counts[0], counts[1]))
        return written

    monkeypatch.setattr(versions, "materialize", measured)
    rng = random.Random(3)
    updates = [("hot", p, rng.randrange(40_000)) for p in range(6000)]
    df = spark.createDataFrame(updates, "k string, p bigint, expected bigint")
    judged = versions.version_gated_update(df, "k", "expected", ["p"], max_rows=400)
    got = {(r.k, r.p): (r.current_version, r.verdict) for r in judged.collect()}
    assert got == judge_versions(updates, {})
    assert len(largest) == 5 and all(group <= 64 for group, _ in largest)
    assert largest[-1][1] > 500  # the whole record's map lies in as many groups


def test_one_update_per_record(spark, rows):
    target = spark.createDataFrame([(1, 1, "a"), (2, 5, "b"), (3, 0, "c")], "k int, version bigint, v string")
    updates = spark.createDataFrame([(1, 1, "x"), (2, 4, "x"), (3, 2, "x"), (4, 0, "x")], "k int, e bigint, v string")
    updates = updates.unionByName(spark.createDataFrame([(5, 3, "x")], updates.schema))
    table, verdicts = idempotent.apply_one_update(target, updates, "k", "e", ["v"])
    assert rows(table, "k", "version", "v") == [(1, 2, "x"), (2, 5, "b"), (3, 0, "c"), (4, 1, "x")]
    assert rows(verdicts, "k", "verdict") == [
        (1, "applied"), (2, "already_updated"), (3, "conflict"), (4, "applied"), (5, "conflict"),
    ]


def test_null_keys_match_in_a_merge(spark, rows):
    target = spark.createDataFrame([(None, "old", 1), (2, "b", 1)], "k int, v string, at int")
    merged = idempotent.merge_upsert(target, spark.createDataFrame([(None, "new", 2)], target.schema), ["k"], ["at"])
    assert rows(merged, "k", "v") == [(2, "b"), (None, "new")]


def test_merge_creates_then_repeats_without_change(spark, folder):
    table = VersionedTable(spark, folder + "/table")
    source = spark.createDataFrame([(1, "old", 1), (1, "new", 2), (2, "b", 1)], "k int, v string, at int")
    for _ in range(3):
        table.publish(idempotent.merge_upsert(table.read(), source, ["k"], ["at"]))
    assert table.versions() == [0, 1, 2]
    result = ranking.tables_equal(*[table.read(n) for n in table.versions()]).first()
    assert result.equal and result.differing_rows == 0
    assert table.read().filter("k = 1").first().v == "new"


def test_unfinished_version_is_invisible(spark, folder):
    table = VersionedTable(spark, folder + "/table")
    table.publish(spark.range(3))
    spark.range(9).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(
        f"{table.path}/version-0000000001"
    )
    assert table.versions() == [0]
    assert table.read().count() == 3
    table.publish(spark.range(5))
    assert table.read().count() == 5


def test_insert_if_absent_keeps_existing_rows(spark, rows):
    target = spark.createDataFrame([(1, "kept")], "k int, v string")
    source = spark.createDataFrame([(1, "lost", 0), (2, "first", 1), (2, "second", 2), (None, "null", 3)], "k int, v string, at int")
    once = idempotent.insert_if_absent(target, source, ["k"], ["at"])
    twice = idempotent.insert_if_absent(once, source, ["k"], ["at"])
    assert rows(once, "k", "v") == rows(twice, "k", "v") == [(1, "kept"), (2, "first"), (None, "null")]


def test_cdc_takes_the_last_change_of_a_key(spark, rows):
    target = spark.createDataFrame([("1", "a"), ("2", "b"), ("3", "c")], "id string, name string")
    image = "struct<id string, name string>"
    changes = spark.createDataFrame(
        [
            (("1", "a"), None, "d", 10, 1),
            (None, ("1", "again"), "c", 10, 2),
            (("2", "b"), ("2", "b2"), "u", 5, 1),
            (("2", "b2"), None, "d", 6, 1),
            (None, ("4", "d"), "r", 1, 1),
        ],
        f"before {image}, after {image}, op string, ts_ms bigint, offset bigint",
    )
    applied = idempotent.cdc_apply(target, changes, "id", ["ts_ms", "offset"])
    again = idempotent.cdc_apply(applied, changes, "id", ["ts_ms", "offset"])
    assert rows(applied) == rows(again) == [("1", "again"), ("3", "c"), ("4", "d")]


def test_order_is_processed_once(spark, rows):
    stock = spark.createDataFrame([("p", 10)], "product string, on_hand bigint")
    lines = spark.createDataFrame([(1, 1, "p", 2), (1, 1, "p", 2), (2, 1, "p", 3)], "o int, n int, product string, q bigint")
    done = spark.createDataFrame([], "o int")
    args = ("o", ["o", "n"], "product", "q")
    after, ledger = idempotent.process_order_once(stock, lines, done, *args)
    again, _ = idempotent.process_order_once(after, lines, ledger, *args)
    assert rows(after) == rows(again) == [("p", 5)]
    assert rows(ledger) == [(1,), (2,)]


def test_same_key_returns_the_first_result(spark, rows):
    requests = spark.createDataFrame([("k", 1, 5.0), ("k", 2, 9.0), ("j", 3, 1.0)], "key string, rid int, amount double")
    ledger = idempotent.first_write_wins(requests, None, "key", ["rid"]).withColumnRenamed("rid", "first_rid")
    replayed = idempotent.replay_results(requests, ledger, "key", "rid")
    assert rows(replayed, "rid", "amount", "replayed") == [(1, 5.0, False), (2, 5.0, True), (3, 1.0, False)]
    assert idempotent.first_write_wins(requests, ledger, "key", ["rid"]).count() == 0


def test_equal_content_is_kept_once_with_nulls_told_apart(spark):
    df = spark.createDataFrame(
        [("1", "Alice", 100), ("2", "Bob", 200), ("1", "Alice", 100), ("1", None, 100)], "id string, name string, value int"
    ).withColumn("at", F.monotonically_increasing_id())
    assert idempotent.content_hash_dedup(df, ["id", "name", "value"], ["at"]).count() == 3


def test_partition_overwrite_leaves_other_dates(spark, folder, rows):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "v int, d string")
    for _ in range(3):
        partition_overwrite(df, folder + "/t", ["d"])
    partition_overwrite(spark.createDataFrame([(9, "b")], "v int, d string"), folder + "/t", ["d"])
    assert rows(spark.read.parquet(folder + "/t")) == [(1, "a"), (9, "b")]


def test_tables_equal_counts_copies(spark):
    one = spark.createDataFrame([(1,), (1,), (None,)], "v int")
    other = spark.createDataFrame([(1,), (None,), (None,)], "v int")
    assert ranking.tables_equal(one, one, one).first().equal
    result = ranking.tables_equal(one, other).first()
    assert not result.equal and result.differing_rows == 2


def test_tables_equal_tells_nulls_places_and_zeros(spark):
    def pair(*values):
        return spark.createDataFrame(values, "a double, b double")

    assert ranking.tables_equal(pair((0.0, None)), pair((-0.0, None))).first().equal
    assert ranking.tables_equal(pair((float("nan"), 1.0)), pair((float("nan"), 1.0))).first().equal
    moved = ranking.tables_equal(pair((None, 1.0)), pair((1.0, None))).first()
    assert not moved.equal and moved.differing_rows == 2
    empty = pair().limit(0)
    assert ranking.tables_equal(empty, empty).first().equal
    assert ranking.tables_equal(empty, pair((None, None))).first().differing_rows == 1


def test_tables_equal_finds_each_changed_row(spark, folder):
    spark.range(20000).selectExpr("id", "id % 7 AS v").write.parquet(folder + "/a")
    one = spark.read.parquet(folder + "/a")
    other = one.withColumn("v", F.expr("CASE WHEN id IN (3, 19999) THEN -v - 1 ELSE v END"))
    assert ranking.tables_equal(one, one.orderBy(F.desc("id")), other).first().differing_rows == 4
    assert ranking.differing_buckets(one, other).count() <= 4
    assert ranking.differing_buckets(one, one.repartition(5)).count() == 0


def test_equal_tables_are_read_once_each(spark, folder):
    for name in "ab":
        spark.range(20000).selectExpr("id", "id % 7 AS v").write.parquet(f"{folder}/{name}")
    result = ranking.tables_equal(*[spark.read.parquet(f"{folder}/{name}") for name in "ab"])
    assert result.first().equal
    assert result.collect()[0].differing_rows == 0
    final = result._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "Scan parquet" not in final and "EmptyRelation" in final  # the row comparison was left out


def test_three_runs_of_a_job_agree_or_not(spark, folder):
    df = spark.createDataFrame([(1, 1), (1, 2), (2, 1)], "k int, at int")
    assert ranking.runs_agree(lambda: ranking.dedup_keep_latest(df, ["k"], ["at"]), folder + "/same").first().equal
    drifting = iter(range(3))
    assert not ranking.runs_agree(lambda: df.withColumn("n", F.lit(next(drifting))), folder + "/drift").first().equal


def test_merge_reaches_the_catalog(spark):
    """Plain Parquet tables refuse a row-level merge; the statement itself resolves."""
    spark.range(2).withColumn("v", F.lit("a")).createOrReplaceTempView("merge_target_rows")
    spark.sql("DROP TABLE IF EXISTS merge_target")
    spark.sql("CREATE TABLE merge_target USING parquet AS SELECT * FROM merge_target_rows")
    source = spark.createDataFrame([(1, "b", 1)], "id bigint, v string, at int")
    with pytest.raises(Exception, match="(?i)merge"):
        idempotent.merge_into("merge_target", source.drop("at"), ["id"], ["v"])
    spark.sql("DROP TABLE merge_target")
