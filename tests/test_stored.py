"""Keyed tables, committed files and topics."""

import random
import threading

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from helpers import doc, messages, rows_of
from pulseforge.operators import decode, lookup, route
from pulseforge.plans import pipeline
from pulseforge.sources import keyed, log, sinks, topics
from pulseforge.sources.batch import Batch
from pulseforge.sources.committed import Committed
from pulseforge.streaming import queries as streams

PAIR = T.StructType([T.StructField("k", T.LongType()), T.StructField("v", T.LongType())])


def put(spark, path, pairs, batch):
    keyed.upsert(spark, path, PAIR, spark.createDataFrame(list(pairs), PAIR), ["k"], batch)


def table(spark, path, **more):
    return dict(rows_of(keyed.read(spark, path, PAIR, **more), "k", "v"))


def runs(spark, path):
    return keyed._newest(spark, path)[1]["runs"]


def test_newest_rows_count(spark, tmp_path, monkeypatch):
    """Any order of overlapping, repeated and empty batches equals a dictionary."""
    monkeypatch.setattr(keyed, "BUCKET_ROWS", 8)
    path, rng, want = str(tmp_path / "t"), random.Random(3), {}
    for number in range(14):
        batch = Batch("w", number) if number % 3 else Batch.new()
        pairs = {rng.randrange(60): rng.randrange(1000) for _ in range(rng.choice([0, 1, 5, 30]))}
        if number % 4 == 1:
            put(spark, path, {**pairs, 7: -1}.items(), batch)  # an attempt that is repeated
        put(spark, path, pairs.items(), batch)
        want |= pairs
        assert table(spark, path) == want
    some = spark.createDataFrame([(k,) for k in (1, 2, 59, 1000)], "k LONG")
    assert table(spark, path, keys=some) == {k: want[k] for k in (1, 2, 59) if k in want}
    assert len(runs(spark, path)) < 8 and max(r["buckets"] for r in runs(spark, path)) >= 4


def test_a_repeated_batch_reads_what_it_read_before(spark, tmp_path):
    path = str(tmp_path / "t")
    for number in range(4):
        put(spark, path, [(number, 1), (100, number)], Batch("w", number))
    assert table(spark, path, before=Batch("w", 3)) == {0: 1, 1: 1, 2: 1, 100: 2}
    assert table(spark, path, before=Batch("w", 4)) == table(spark, path) == {0: 1, 1: 1, 2: 1, 3: 1, 100: 3}


def test_a_batch_costs_what_it_touches(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(keyed, "BUCKET_ROWS", 100)
    path = str(tmp_path / "t")
    put(spark, path, [(k, k) for k in range(6_400)], Batch.new())
    before = runs(spark, path)
    assert [r["buckets"] for r in before] == [64]
    put(spark, path, [(5, 0), (6, 0)], Batch("w", 0))
    after = runs(spark, path)
    assert after[0] == before[0] and after[1]["rows"] == 2  # nothing was rewritten
    keys = spark.createDataFrame([(5,), (6,), (9,)], "k LONG")
    rows = keyed.read(spark, path, PAIR, keys=keys)
    assert rows_of(rows, "k", "v") == [(5, 0), (6, 0), (9, 9)]
    pruned = rows._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_bucket" in pruned or "PartitionFilters: [_bucket" in pruned
    touched = keyed._load(spark, path, PAIR, after, {1, 2, 3}).where("v >= 0").select(F.input_file_name()).distinct().count()
    assert touched <= 3 + 2  # three buckets, and the two files of the new run


def test_two_writers_at_once_lose_nothing(spark, tmp_path):
    path, failed = str(tmp_path / "t"), []

    def writer(name, base):
        try:
            for number in range(6):
                put(spark, path, [(base + number, number)], Batch(name, number))
        except Exception as error:  # noqa: BLE001
            failed.append(error)

    threads = [threading.Thread(target=writer, args=(f"w{i}", 100 * i)) for i in range(3)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert not failed
    assert table(spark, path) == {100 * i + n: n for i in range(3) for n in range(6)}


def test_a_run_without_its_commit_is_not_read(spark, tmp_path):
    path = str(tmp_path / "t")
    put(spark, path, [(1, 1)], Batch("w", 0))
    keyed._write(spark.createDataFrame([(1, 9), (2, 9)], PAIR), path, ["k"], Batch("w", 1))  # killed before the commit
    assert table(spark, path) == {1: 1}
    put(spark, path, [(2, 2)], Batch("w", 1))
    assert table(spark, path) == {1: 1, 2: 2}


def test_old_runs_are_removed(spark, tmp_path):
    path = str(tmp_path / "t")
    for number in range(keyed.KEPT + 8):
        put(spark, path, [(1, number)], Batch("w", number))
    assert table(spark, path) == {1: keyed.KEPT + 7}
    assert len(log.names(spark, f"{path}/log")) == keyed.KEPT
    assert len(log.names(spark, f"{path}/data")) < 2 * keyed.KEPT + 4


def test_a_file_is_created_once(spark, tmp_path):
    assert log.create(spark, str(tmp_path / "x"), "one") and not log.create(spark, str(tmp_path / "x"), "two")
    assert log.read_text(spark, str(tmp_path / "x")) == "one" and log.read_text(spark, str(tmp_path / "y")) is None


def valid(spark, values, start=0):
    return route.valid_events(route.route_messages(decode.decode_messages(messages(spark, values, 0, start))))


def days(n):
    return [doc(i, time=f"2026-02-{1 + i % 3:02d}T10:00:00Z") for i in range(n)]


def test_dates_are_outermost_and_no_batch_folder_is_listed(spark, tables):
    for number in range(3):
        sinks.insert_events(spark, valid(spark, days(9)[3 * number:3 * number + 3], 3 * number), tables, Batch("t", number))
    table = tables.events
    assert sorted(log.names(spark, table.data)) == [f"event_date=2026-02-0{d}" for d in (1, 2, 3)]
    files = table.state(spark).files
    assert len(files) == 9 and all(f.startswith("event_date=2026-02-0") for f in files)
    assert table.read(spark, low="2026-02-02", high="2026-02-02").select("event_date").distinct().count() == 1
    assert len(table.read(spark, low="2026-02-03").inputFiles()) == 3


def test_a_killed_batch_is_invisible(spark, tables):
    sinks.insert_events(spark, valid(spark, days(3)), tables, Batch("t", 0))
    killed = valid(spark, days(6)[3:], 3).withColumns({"ingest_time": F.current_timestamp(), "run": F.lit("t"), "batch_id": F.lit(1)})
    tables.events.put(killed)  # its files are there, its commit is not
    assert tables.read_events(spark).count() == 3
    sinks.insert_events(spark, valid(spark, days(6)[3:], 3), tables, Batch("t", 1))
    assert rows_of(tables.read_events(spark), "source_offset") == [(i,) for i in range(6)]


def test_compaction_swaps_files(spark, tables, monkeypatch):
    monkeypatch.setattr("pulseforge.sources.committed.STATE_EVERY", 4)
    for number in range(7):
        sinks.insert_events(spark, valid(spark, days(30)[3 * number:3 * number + 3], 3 * number), tables, Batch("t", number))
    before = rows_of(tables.read_events(spark).drop("ingest_time"), "*")
    assert tables.events.compact(spark, ("customer_id",)) == 18  # not those of the newest batch, which could be repeated
    assert len(tables.events.state(spark).files) == 3 + 3
    assert rows_of(tables.read_events(spark).drop("ingest_time"), "*") == before
    assert tables.events.compact(spark) == 0 or len(tables.events.state(spark).files) < 6
    sinks.insert_events(spark, valid(spark, days(30)[18:24], 18), tables, Batch("t", 6))  # repeated after all
    assert rows_of(tables.read_events(spark), "source_offset") == [(i,) for i in range(24)]
    gone = tables.events.vacuum(spark, keep=0)
    assert gone >= 18 and tables.read_events(spark).count() == 24


def test_writers_of_one_table_take_turns(spark, tables):
    parts = [valid(spark, [doc(10 * i + k) for k in range(3)], 10 * i) for i in range(4)]
    threads = [threading.Thread(target=sinks.write_events, args=(p, tables, Batch(f"w{i}", 0))) for i, p in enumerate(parts)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert rows_of(tables.read_events(spark), "source_offset") == sorted((10 * i + k,) for i in range(4) for k in range(3))
    assert tables.events.state(spark).number == 3


def test_table_panel_follows_commits(spark, tables, tmp_path):
    def panel():
        streams.start_table_panel(spark, tables.events, streams.minute_counts, str(tmp_path / "panel"), ["time"], str(tmp_path / "cp"),
                                  available_now=True).awaitTermination()
        rows = streams.read_panel(spark, str(tmp_path / "panel"), streams.minute_counts(tables.read_events(spark)).schema)
        return rows_of(rows, "time", "value")

    for number in range(3):
        sinks.insert_events(spark, valid(spark, days(9)[3 * number:3 * number + 3], 3 * number), tables, Batch("t", number))
        if number == 1:
            assert [v for _, v in panel()] == [2.0, 2.0, 2.0]
    tables.events.compact(spark)
    sinks.write_events(valid(spark, days(9)[6:8], 6), tables, Batch("t", 2))  # the last batch, repeated with less
    assert [v for _, v in panel()] == [3.0, 3.0, 2.0]
    assert panel() == rows_of(streams.minute_counts(tables.read_events(spark)), "time", "value")


def test_topic_offsets_have_no_gaps(spark, tables):
    name, many = "t", 5
    batches = [[(f"k{i % 7}", f"{n}-{i}") for i in range(40)] for n in range(3)]
    for number, rows in enumerate(batches):
        for _ in range(2):  # each batch is published twice, once it counts
            topics.publish(spark.createDataFrame(rows, "key STRING, value STRING").repartition(3), tables.topic(name), name, Batch("p", number), many)
    topics.publish(spark.createDataFrame([], "key STRING, value STRING"), tables.topic(name), name, Batch("p", 9), many)
    read = tables.read_topic(spark, name)
    assert read.count() == 120 and read.select("value").distinct().count() == 120
    per = read.groupBy("partition").agg(F.count("*"), F.min("offset"), F.max("offset"), F.count_distinct("offset")).collect()
    assert all(low == 0 and high == n - 1 == distinct - 1 for _, n, low, high, distinct in per)
    assert read.groupBy("key").agg(F.count_distinct("partition").alias("n")).where("n > 1").count() == 0
    order = {r.value: (r.partition, r.offset) for r in read.collect()}
    assert all(order[f"0-{i}"][1] < order[f"2-{i}"][1] for i in range(40))


def test_publish_then_replay(spark, tables):
    """A published topic is a raw source again: decoded, stored and replayed."""
    events = valid(spark, [doc(i, customer=f"c{i % 5}", rate=60 + i) for i in range(20)])
    topics.publish(sinks.event_messages(events), tables.topic("again"), "again", Batch("p", 0), 4)
    again = tables.read_topic(spark, "again")
    pipeline.ingest(spark, again, tables, Batch("w", 0))
    columns = ("event_id", "customer_id", "event_time", "heart_rate")
    assert rows_of(tables.read_events(spark), *columns) == rows_of(events, *columns)
    marks = tables.read_checkpoint(spark)
    assert lookup.replay_after(again, marks, "cg.db-writer.v1").count() == 0
    topics.publish(sinks.event_messages(events.limit(3)), tables.topic("again"), "again", Batch("p", 1), 4)
    assert lookup.replay_after(tables.read_topic(spark, "again"), marks, "cg.db-writer.v1").count() == 3


def test_publishers_at_once_share_no_offset(spark, tables):
    def publish(n):
        rows = spark.createDataFrame([(f"k{i}", f"{n}-{i}") for i in range(9)], "key STRING, value STRING")
        topics.publish(rows, tables.topic("t"), "t", Batch(f"p{n}", 0), 2)

    threads = [threading.Thread(target=publish, args=(n,)) for n in range(3)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    read = tables.read_topic(spark, "t")
    assert read.count() == 27 and read.select("partition", "offset").distinct().count() == 27
    assert read.groupBy("partition").agg((F.max("offset") + 1 == F.count("*")).alias("dense")).where("dense").count() == 2


@pytest.mark.parametrize("partition", [None, "d"])
def test_empty_tables(spark, tmp_path, partition):
    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("d", T.StringType())])
    table = Committed(str(tmp_path / "t"), schema, partition)
    assert table.read(spark).count() == 0 and table.compact(spark) == 0 and table.vacuum(spark) == 0
    table.write(spark.createDataFrame([], schema), Batch("w", 0))
    table.write(spark.createDataFrame([(1, "x"), (2, None)], schema), Batch("w", 1))
    assert sorted(rows_of(table.read(spark), "a", "d"), key=str) == [(1, "x"), (2, None)]
