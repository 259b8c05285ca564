import collections
import glob
import os
import random
import threading

import pytest
from pyspark.sql import functions as F

from helpers import doc, messages, rows_of, uid
from pulseforge import session
from pulseforge.operators import anomalies, decode, metrics, route
from pulseforge.plans import catalog, fixture, pipeline
from pulseforge.schema import CHECKPOINT
from pulseforge.sources import keyed, raw
from pulseforge.sources.batch import Batch
from pulseforge.sources.tables import Tables
from pulseforge.streaming import active
from pulseforge.streaming import queries as streams

FOUND = ("event_id", "anomaly_type", "severity", "details")
STORED = ("event_id", "customer_id", "heart_rate", "source_offset", "payload")


@pytest.fixture(scope="module")
def feed(spark, small, tmp_path_factory):
    """The sf0.001 messages as three files, in arrival order."""
    m = fixture.raw_messages(fixture.read_events(spark, small))
    path = tmp_path_factory.mktemp("feed")
    for cut, (low, high) in enumerate(((0, 300), (300, 650), (650, 10**9))):
        part = m.where((m["offset"] >= low) & (m["offset"] < high)).coalesce(1)
        part.write.parquet(str(path / f"tmp{cut}"))
        (source,) = glob.glob(str(path / f"tmp{cut}" / "part-*.parquet"))
        os.makedirs(path / "in", exist_ok=True)
        os.link(source, path / "in" / f"{cut}.parquet")
        os.utime(path / "in" / f"{cut}.parquet", (1_700_000_000 + cut, 1_700_000_000 + cut))
    return str(path / "in")


def test_detector_stream_equals_batch(spark, feed, tables, tmp_path):
    query = streams.start_detector(
        raw.stream_files(spark, feed, 1), tables, str(tmp_path / "progress"), available_now=True)
    query.awaitTermination()
    assert query.lastProgress["batchId"] == 2
    batch = anomalies.detect(decode.schema_valid(decode.decode_messages(raw.read_files(spark, feed))))
    assert rows_of(tables.read_anomalies(spark), *FOUND) == rows_of(batch, *FOUND)
    published = tables.read_topic(spark, "events.anomaly.v1")
    assert published.count() == batch.count()


def test_writer_stream_equals_batch(spark, feed, tables, tmp_path):
    seen = {}
    query = streams.start_writer(
        raw.stream_files(spark, feed, 1), tables, str(tmp_path / "progress"), available_now=True,
        on_counters=lambda batch_id, c: seen.update({batch_id: c}))
    query.awaitTermination()
    whole = Tables(str(tmp_path / "whole"))
    counters = pipeline.ingest(spark, raw.read_files(spark, feed), whole)
    assert {k: sum(c[k] for c in seen.values()) for k in counters} == counters and len(seen) == 3
    assert rows_of(tables.read_events(spark), *STORED) == rows_of(whole.read_events(spark), *STORED)
    marks = CHECKPOINT.names[:4]
    assert rows_of(tables.read_checkpoint(spark), *marks) == rows_of(whole.read_checkpoint(spark), *marks)


def test_retried_batch_changes_nothing(spark, tables):
    first = messages(spark, [doc(1, rate=70)])
    second = messages(spark, [doc(2, rate=105), doc(3, rate=80)], start=1)
    pipeline.detect(spark, first, tables, Batch("t", 0))
    for _ in range(2):
        pipeline.detect(spark, second, tables, Batch("t", 1))
    assert rows_of(tables.read_anomalies(spark), "event_id", "anomaly_type") == [(uid(2), "SPIKE")]
    assert rows_of(tables.read_last_readings(spark), "heart_rate") == [(80,)]


def test_staged_detector_is_the_same(spark, small, tables, tmp_path):
    m = fixture.raw_messages(fixture.read_events(spark, small))
    pipeline.detect(spark, m, tables, staging=str(tmp_path / "staging"))
    batch = anomalies.detect(decode.schema_valid(decode.decode_messages(m)))
    assert rows_of(tables.read_anomalies(spark), *FOUND) == rows_of(batch, *FOUND)


def test_history_survives_a_restart(spark, tables):
    pipeline.detect(spark, messages(spark, [doc(1, customer="a", rate=70), doc(2, customer="b", rate=70)]), tables, Batch("t", 0))
    pipeline.detect(spark, messages(spark, [doc(3, customer="b", rate=71)], start=2), tables, Batch("t", 1))
    pipeline.detect(spark, messages(spark, [doc(4, customer="a", rate=101)], start=3), tables, Batch("t", 2))
    assert rows_of(tables.read_anomalies(spark), "event_id", "anomaly_type") == [(uid(4), "SPIKE")]


def test_stateful_insert_equals_table_insert(spark, feed, tables, tmp_path):
    query = streams.start_stateful_writer(
        raw.stream_files(spark, feed, 1), tables, str(tmp_path / "progress"), available_now=True)
    query.awaitTermination()
    whole = Tables(str(tmp_path / "whole"))
    pipeline.ingest(spark, raw.read_files(spark, feed), whole)
    assert rows_of(tables.read_events(spark), *STORED) == rows_of(whole.read_events(spark), *STORED)
    marks = CHECKPOINT.names[:4]
    assert rows_of(tables.read_checkpoint(spark), *marks) == rows_of(whole.read_checkpoint(spark), *marks)
    for topic in ("events.invalid.v1", "events.dlq.v1"):
        assert rows_of(tables.read_topic(spark, topic), "value") == rows_of(whole.read_topic(spark, topic), "value")


def test_stateful_insert_across_batches(spark, tables, tmp_path):
    """Copies within a batch, across batches and across partitions."""
    feed = tmp_path / "in"
    cuts = [
        messages(spark, [doc(1, rate=70), doc(1, rate=80), doc(2)]),
        messages(spark, [doc(1, rate=90), doc(3)], start=3),
        messages(spark, [doc(3, rate=90), doc(2, customer="b")], partition=1),
    ]
    for cut in cuts:
        cut.coalesce(1).write.mode("append").parquet(str(feed))
        streams.start_stateful_writer(
            raw.stream_files(spark, str(feed)), tables, str(tmp_path / "progress"), available_now=True
        ).awaitTermination()
    assert rows_of(tables.read_events(spark), "event_id", "customer_id", "heart_rate", "source_offset") == [
        (uid(1), "cust_00001", 70, 0), (uid(2), "b", 70, 1), (uid(2), "cust_00001", 70, 2), (uid(3), "cust_00001", 70, 4)]
    assert rows_of(tables.read_checkpoint(spark), "partition", "last_offset") == [(0, 4), (1, 1)]


def panel(spark, counts, key, tmp_path):
    streams.start_panel(counts, str(tmp_path / "panel"), [key], str(tmp_path / "cp"), available_now=True).awaitTermination()
    return keyed.read(spark, str(tmp_path / "panel"), counts.schema)


def valid_of(m):
    return route.valid_events(route.route_messages(decode.decode_messages(m)))


def test_minute_counts_stream(spark, feed, tmp_path):
    out = panel(spark, streams.minute_counts(valid_of(raw.stream_files(spark, feed, 1))), "time", tmp_path)
    assert rows_of(out, "*") == rows_of(metrics.per_minute(valid_of(raw.read_files(spark, feed))), "*")


def test_late_rows_amend_their_minute(spark, tmp_path):
    feed = tmp_path / "in"
    for start, times in ((0, ["10:00:05", "10:07:00"]), (2, ["10:00:40", "10:03:00", "09:00:00"])):
        cut = messages(spark, [doc(start + i, time=f"2026-02-22T{t}Z") for i, t in enumerate(times)], start=start)
        cut.coalesce(1).write.mode("append").parquet(str(feed))
        out = panel(spark, streams.minute_counts(valid_of(raw.stream_files(spark, str(feed)))), "time", tmp_path)
    assert [r.value for r in out.orderBy("time").collect()] == [1.0, 2.0, 1.0, 1.0]


@pytest.mark.parametrize("width, slide", [("10 days", "10 days"), ("3 days", "1 day"), ("10 minutes", "1 minute")])
def test_active_customer_stream(spark, feed, tmp_path, width, slide):
    active.start_active_customers(
        valid_of(raw.stream_files(spark, feed, 1)), str(tmp_path / "panel"), str(tmp_path / "cp"), width, slide, available_now=True
    ).awaitTermination()
    got = active.read_active(spark, str(tmp_path / "panel"), slide)
    window = F.window("event_time", width, slide)
    want = valid_of(raw.read_files(spark, feed)).groupBy(window.alias("w")).agg(F.count_distinct("customer_id").cast("double").alias("value"))
    assert rows_of(got, "time", "value") == rows_of(want.select(F.col("w.end").alias("time"), "value"), "time", "value")


@pytest.mark.parametrize("seed", range(4))
def test_changes_sum_up_to_distinct_customers(spark, seed, monkeypatch):
    """Pairs in any order of arrival, a few at a time."""
    monkeypatch.setattr(active, "SPAN", 7)
    rng, k = random.Random(seed), 4
    pairs = list({(f"c{rng.randrange(4)}", rng.randrange(40)) for _ in range(50)})
    rng.shuffle(pairs)
    schema, known, total = "customer_id STRING, slide BIGINT", [], collections.Counter()
    while pairs:
        new, pairs = pairs[:9], pairs[9:]
        found = active.changes(spark.createDataFrame(known, schema), spark.createDataFrame(new, schema), k)
        total.update({r.slide: r.change for r in found.collect()})
        known += new
    table = spark.createDataFrame(list(total.items()), "slide BIGINT, change BIGINT")
    got = {int(r.time.timestamp()) // 60 - 1: r.value for r in active.counts(table, 60).collect()}
    want = {e: len({c for c, s in known if s <= e < s + k}) for e in range(50)}
    assert got == {e: n for e, n in want.items() if n}


def test_writer_reads_its_source_once(spark, feed, tables, tmp_path):
    query = streams.start_stateful_writer(raw.stream_files(spark, feed), tables, str(tmp_path / "progress"), available_now=True)
    query.awaitTermination()
    seen = query.recentProgress
    assert sum(p["numInputRows"] for p in seen) == raw.read_files(spark, feed).count() == 1000
    counted = [p["observedMetrics"] for p in seen if p["numInputRows"]]
    assert (counted[0]["accepted"]["inserted"], counted[0]["rejected"]["invalid"], counted[0]["rejected"]["dlq"]) == (784, 206, 10)


def test_rejects_are_published_once(spark, tables, tmp_path):
    """The same source positions read again, as after a restored progress folder."""
    feed = tmp_path / "in"
    for _ in range(2):
        messages(spark, ["{", doc(1), doc(2, rate=300)]).coalesce(1).write.mode("append").parquet(str(feed))
        streams.start_stateful_writer(raw.stream_files(spark, str(feed)), tables, str(tmp_path / "progress"), available_now=True).awaitTermination()
    assert tables.read_topic(spark, "events.invalid.v1").count() == 2 and tables.read_events(spark).count() == 1


@pytest.mark.parametrize("late, again", [(False, False), (True, False), (True, True)])
def test_feed_has_a_batch_for_each_stretch(spark, tmp_path, late, again):
    """However many files the table has."""
    columns = ("id AS event_id", "TIMESTAMP_NTZ'2024-01-01' AS ts", "id % 5 AS user_id", "'view' AS event_type", "50D AS value", "'' AS props")
    spark.range(0, 100_000, 1, 6).selectExpr(*columns).write.parquet(str(tmp_path / "events.parquet"))
    stream, seen = catalog._message_stream(spark, str(tmp_path), late, again), []
    cut = (F.col("offset") % catalog.REDELIVERY % 4) if late else F.floor(F.col("offset") / 25_000)

    def batch(rows, batch_id):
        seen.append(rows.agg(F.count("*"), F.min(cut), F.max(cut), F.floor(F.max("offset") / catalog.REDELIVERY)).first())

    stream.writeStream.option("checkpointLocation", str(tmp_path / "cp")).foreachBatch(batch).trigger(availableNow=True).start().awaitTermination()
    assert [tuple(r) for r in seen] == [(25_000, c, c, more) for c in range(4) for more in range(2 if again else 1)]


def _on_two_days(spark, path):
    docs = [doc(n, customer=f"c{n}", time=f"2025-11-0{n % 2 + 3}T16:41:27Z") for n in range(60)]
    messages(spark, docs).coalesce(1).write.parquet(path)
    return raw.stream_files(spark, path)


def test_stateful_writer_gathers_files_by_date(spark, tables, tmp_path):
    feed = _on_two_days(spark, str(tmp_path / "in"))
    streams.start_stateful_writer(feed, tables, str(tmp_path / "progress"), available_now=True).awaitTermination()
    assert len(tables.events.state(spark).files) == 2 and tables.read_events(spark).count() == 60


def test_stateful_writer_keeps_its_state_on_disk(spark, tables, tmp_path):
    """Whatever the session's state store; a later stream of the session has its own."""
    store, on_heap = "spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"
    was, feed = spark.conf.get(store), _on_two_days(spark, str(tmp_path / "in"))
    spark.conf.set(store, on_heap)
    try:
        streams.start_stateful_writer(feed, tables, str(tmp_path / "progress"), available_now=True).awaitTermination()
        assert spark.conf.get(store) == on_heap
    finally:
        spark.conf.set(store, was)
    offsets = (tmp_path / "progress/offsets/0").read_text()
    assert "RocksDBStateStoreProvider" in offsets and "HDFSBackedStateStoreProvider" not in offsets
    assert glob.glob(str(tmp_path / "progress/state/0/*/*.changelog")) and tables.read_events(spark).count() == 60


def test_stateful_writer_writes_what_is_new(spark, tables, tmp_path):
    """A batch of keys known before adds no files; marks still go on."""
    for start in (0, 10):
        messages(spark, [doc(1), doc(2)], start=start).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        streams.start_stateful_writer(raw.stream_files(spark, str(tmp_path / "in")), tables, str(tmp_path / "progress"), available_now=True).awaitTermination()
    assert tables.events.log.numbers(spark) == [0] and tables.topic("events.invalid.v1").log.numbers(spark) == []
    assert rows_of(tables.read_events(spark), "event_id", "source_offset") == [(uid(1), 0), (uid(2), 1)]
    assert rows_of(tables.read_checkpoint(spark), "partition", "last_offset") == [(0, 11)]


def test_writes_side_by_side_all_end(spark):
    done, gate = [], threading.Barrier(2, timeout=60)

    def fails():
        gate.wait()
        raise ValueError("first")

    with pytest.raises(ValueError, match="first"):
        session.at_once(spark, [fails, lambda: (gate.wait(), done.append(spark.range(3).count()))])
    assert done == [3]
    session.at_once(spark, [])


def test_panel_gathers_its_rows(spark, tmp_path):
    docs = [doc(n, time=f"2025-11-03T16:{n:02d}:27Z") for n in range(60)]
    messages(spark, docs).coalesce(1).write.parquet(str(tmp_path / "in"))
    out = panel(spark, streams.minute_counts(valid_of(raw.stream_files(spark, str(tmp_path / "in")))), "time", tmp_path)
    assert out.count() == 60 and len(glob.glob(str(tmp_path / "panel/data/*/*/part-*.parquet"))) == 1


def test_active_customers_run_their_state_once(spark, tmp_path):
    feed = _on_two_days(spark, str(tmp_path / "in"))
    query = active.start_active_customers(valid_of(feed), str(tmp_path / "panel"), str(tmp_path / "cp"), available_now=True)
    query.awaitTermination()
    (progress,) = [p for p in query.recentProgress if p["numInputRows"]]
    assert progress["stateOperators"][0]["numRowsTotal"] == 60
    assert len(glob.glob(str(tmp_path / "panel/seen/data/*/*/part-*.parquet"))) == 2
    assert {r.value for r in active.read_active(spark, str(tmp_path / "panel")).collect()} == {30.0}
