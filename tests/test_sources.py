from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from millrace.sources import batch, files, kafka, loads, paged
from millrace.sources import tables as stored


def stamp(text="2024-01-01 00:00:00"):
    return F.lit(text).cast("timestamp_ntz")


def write_lines(folder, name, *lines):
    path = f"{folder}/{name}"
    with open(path, "w") as out:
        out.write("\n".join(lines) + "\n")
    return path


@pytest.fixture
def schema(spark):
    return spark.createDataFrame([], "id bigint, v double").schema


def test_json_modes(spark, folder, schema, rows):
    path = write_lines(folder, "a.json", '{"id":1,"v":1.5}', '{"id":2,"v":"oops"}', '{"id":3,"v":', "", '{"id":4}')
    good, corrupt = batch.split_corrupt(batch.scan_json_modes(spark, path, schema))
    assert rows(good) == [(1, 1.5), (4, None)]
    assert rows(corrupt, batch.CORRUPT) == [('{"id":2,"v":"oops"}',), ('{"id":3,"v":',)]
    assert good.select("id").count() == 2
    assert rows(batch.scan_json_modes(spark, path, schema, "DROPMALFORMED")) == [(1, 1.5), (4, None)]
    with pytest.raises(Exception, match="MALFORMED"):
        batch.scan_json_modes(spark, path, schema, "FAILFAST").collect()
    with pytest.raises(ValueError, match="mode"):
        batch.scan_json_modes(spark, path, schema, "LENIENT")


def test_jdbc_options():
    url = "jdbc:postgresql://db/prod"
    assert batch.jdbc_options(url, table="customers", user="u", password="p") == {
        "url": url, "dbtable": "customers", "fetchsize": "10000", "user": "u", "password": "p",
    }
    pushed = batch.jdbc_options(
        url, query="select * from o where id > 5", partition_column="id", lower_bound=5, upper_bound=9, num_partitions=4
    )
    assert pushed["dbtable"] == "(select * from o where id > 5) as source"
    assert pushed["numPartitions"] == "4"
    for wrong in ({}, {"table": "a", "query": "b"}, {"table": "a", "num_partitions": 3}):
        with pytest.raises(ValueError):
            batch.jdbc_options(url, **wrong)


def test_incremental_query_is_pushed_to_the_database():
    query = loads.pushed_incremental_query("orders", "updated_at", datetime(2024, 1, 1, 2))
    assert query == "SELECT * FROM orders WHERE updated_at > TIMESTAMP '2024-01-01 02:00:00'"
    assert loads.pushed_incremental_query("orders", "updated_at", None).endswith("'1970-01-01 00:00:00'")
    assert loads.pushed_incremental_query("orders", "id", 7).endswith("id > 7")


def test_kafka_options():
    assert kafka.kafka_source_options("h:1", "t", "earliest", 10_000, committed_only=True) == {
        "kafka.bootstrap.servers": "h:1",
        "subscribe": "t",
        "startingOffsets": "earliest",
        "maxOffsetsPerTrigger": "10000",
        "kafka.isolation.level": "read_committed",
    }


def test_kafka_round_trip(spark, rows):
    df = spark.createDataFrame([("u1", "login"), ("u2", None)], "user_id string, action string")
    sent = kafka.kafka_encode(df, "user_id").select(F.col("key").cast("binary"), F.col("value").cast("binary"))
    assert rows(kafka.kafka_decode(sent, df.schema, offsets=False)) == rows(df)


def test_incremental_load_repeats_without_change(spark, folder):
    source = spark.createDataFrame(
        [(1, datetime(2024, 1, 1), "a"), (2, datetime(2024, 1, 2), "b")], "id int, at timestamp_ntz, p string"
    )
    ledger = loads.WatermarkLedger(spark, folder + "/ledger")
    args = ("at", ledger, "orders", folder + "/orders", stamp("2024-02-01 00:00:00"))
    assert ledger.last("orders") is None
    assert [loads.run_incremental_load(source, *args, partition_by=["p"]) for _ in range(3)] == [2, 0, 0]
    assert ledger.last("orders") == datetime(2024, 1, 2)
    late = source.unionByName(spark.createDataFrame([(3, datetime(2024, 1, 2), "c")], source.schema))
    assert loads.run_incremental_load(late, *args, partition_by=["p"]) == 0
    assert loads.run_incremental_load(late, *args, partition_by=["p"], keys=["id"]) == 1
    assert spark.read.parquet(folder + "/orders").count() == 3


def test_full_load_replaces_only_its_date(spark, folder):
    df = spark.range(3)
    loads.write_full_load(df, folder + "/t", stamp("2024-01-01 05:00:00"))
    for _ in range(2):
        loads.write_full_load(spark.range(5), folder + "/t", stamp("2024-01-02 05:00:00"))
    assert {r.load_date.day: r["count"] for r in spark.read.parquet(folder + "/t").groupBy("load_date").count().collect()} == {1: 3, 2: 5}


@pytest.mark.parametrize(
    ("pages", "expected"),
    [
        ([(1, 200, '{"results":[{"v":1}],"has_next_page":true}'), (2, 200, '{"results":[{"v":2}],"has_next_page":false}'),
          (3, 200, '{"results":[{"v":3}],"has_next_page":true}')], [1, 2]),
        ([(1, 200, '{"results":[{"v":1}],"has_next_page":true}'), (2, 503, "busy"),
          (3, 200, '{"results":[{"v":3}],"has_next_page":true}')], [1]),
        ([(1, 200, '{"results":[],"has_next_page":true}'), (2, 200, '{"results":[{"v":2}],"has_next_page":true}')], []),
        ([(1, 200, '{"results":[{"v":1},{"v":5}]}'), (2, 200, '{"results":[{"v":2}]}')], [1, 5]),
        ([(1, 200, '{"results":[{"v":1}],"has_next_page":true}')], [1]),
    ],
)
def test_paging_stops_where_a_client_would(spark, pages, expected):
    df = spark.createDataFrame(pages, "page bigint, status int, body string")
    assert sorted(r.v for r in paged.paged_payload_flatten(df, "v bigint").collect()) == expected


def test_new_files_are_ingested_once(spark, folder, schema, rows):
    inbox = files.Inbox(folder + "/in", folder + "/out", folder + "/ledger")
    import os

    os.mkdir(inbox.incoming)
    write_lines(inbox.incoming, "one.json", '{"id":1,"v":1.0}', "broken")
    assert rows(files.batch_file_ingest(spark, inbox, schema, stamp()), "run", "rows_ok", "rows_bad") == [(0, 1, 1)]
    write_lines(inbox.incoming, "two.json", '{"id":2,"v":2.0}')
    assert rows(files.batch_file_ingest(spark, inbox, schema, stamp()), "run", "rows_ok", "rows_bad") == [(1, 1, 0)]
    assert files.batch_file_ingest(spark, inbox, schema, stamp()).count() == 0
    out = spark.read.parquet(inbox.output)
    assert rows(out.filter("state = 'ok'"), "id", "run") == [(1, 0), (2, 1)]
    assert rows(out.filter("state = 'error'"), batch.CORRUPT) == [("broken",)]


def test_new_files_come_in_runs_of_bounded_size(spark, folder, schema, rows):
    import os

    inbox = files.Inbox(folder + "/in", folder + "/out", folder + "/ledger")
    os.mkdir(inbox.incoming)
    for n in range(5):
        write_lines(inbox.incoming, f"{n}.json", f'{{"id":{n},"v":1.0}}')
    assert files.batch_file_ingest(spark, inbox, schema, stamp(), max_files=2).count() == 5
    assert rows(files.read_ledger(spark, inbox).groupBy("run").count()) == [(0, 2), (1, 2), (2, 1)]
    os.remove(inbox.incoming + "/0.json")
    write_lines(inbox.incoming, "5.json", '{"id":5,"v":1.0}')
    assert rows(files.batch_file_ingest(spark, inbox, schema, stamp(), max_files=2), "run", "rows_ok") == [(3, 1)]
    assert rows(spark.read.parquet(inbox.output), "id") == [(n,) for n in range(6)]


def test_changed_content_is_processed_again(spark, folder, rows):
    write_lines(folder, "a.txt", "x")
    write_lines(folder, "b.txt", "y")
    first = files.file_hash_ingest(spark, folder + "/*.txt", None)
    ledger = spark.createDataFrame(first.collect())
    write_lines(folder, "b.txt", "z")
    second = files.file_hash_ingest(spark, folder + "/*.txt", ledger)
    assert rows(second, F.substring_index("path", "/", -1), "status") == [("a.txt", "already_processed"), ("b.txt", "processed")]


def test_a_run_that_died_before_its_ledger_is_repeated_on_another_date(spark, folder, schema, rows):
    import os
    import shutil

    inbox = files.Inbox(folder + "/in", folder + "/out", folder + "/ledger")
    os.mkdir(inbox.incoming)
    write_lines(inbox.incoming, "one.json", '{"id":1,"v":1.0}', '{"id":2,"v":1.0}')
    write_lines(inbox.incoming, "empty.json")
    files.batch_file_ingest(spark, inbox, schema, stamp("2024-01-01 00:00:00"))
    # The run's rows are there; its part of the ledger and the mark that the run is done are not.
    shutil.move(inbox.ledger + "/run=0", folder + "/lost")
    for name in ("0", ".0.crc"):
        os.remove(f"{inbox.checkpoint}/commits/{name}")
    again = files.batch_file_ingest(spark, inbox, schema, stamp("2024-01-02 00:00:00"))
    assert rows(again, "rows_ok", "rows_bad") == [(0, 0), (2, 0)]
    assert spark.read.parquet(inbox.output).count() == 2
    assert files.batch_file_ingest(spark, inbox, schema, stamp()).count() == 0


def test_a_load_that_died_before_its_ledger_is_repeated(spark, folder):
    import shutil

    source = spark.createDataFrame([(1, datetime(2024, 1, 1)), (2, datetime(2024, 1, 2))], "id int, at timestamp_ntz")
    ledger = loads.WatermarkLedger(spark, folder + "/ledger")
    args = ("at", ledger, "orders", folder + "/orders", stamp("2024-02-01 00:00:00"))
    assert loads.run_incremental_load(source, *args) == 2
    shutil.move(folder + "/ledger", folder + "/lost")
    assert loads.run_incremental_load(source, *args) == 2
    assert spark.read.parquet(folder + "/orders").count() == 2


def test_snapshot_and_evolution(spark, rows):
    versions = spark.createDataFrame([("k", 1, "a"), ("k", 2, "b"), ("j", 2, "c")], "k string, n int, v string")
    assert rows(stored.snapshot_as_of(versions, ["k"], "n", 1)) == [("k", 1, "a")]
    wider = stored.schema_evolve_union(versions.drop("v"), versions)
    assert wider.columns == ["k", "n", "v"] and wider.filter("v is null").count() == 3
