import json
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from helpers import WHEN, doc, messages, rows_of, uid
from pulseforge.operators import decode, dedup, lookup, metrics, route
from pulseforge.plans import fixture, pipeline
from pulseforge.schema import CHECKPOINT
from pulseforge.sources import keyed, raw, sinks
from pulseforge.sources.batch import Batch, run_of

EVENT = ("event_id", "customer_id", "heart_rate", "source_offset")


def valid(spark, values, partition=0, start=0):
    return route.valid_events(route.route_messages(decode.decode_messages(messages(spark, values, partition, start))))


def test_first_arrival_wins(spark, tables):
    sinks.insert_events(spark, valid(spark, [doc(1, rate=70), doc(1, rate=80), doc(2)]), tables, Batch("t", 0))
    sinks.insert_events(spark, valid(spark, [doc(1, rate=90), doc(3)], start=3), tables, Batch("t", 1))
    assert rows_of(tables.read_events(spark), *EVENT) == [
        (uid(1), "cust_00001", 70, 0), (uid(2), "cust_00001", 70, 2), (uid(3), "cust_00001", 70, 4)]


def test_same_event_id_of_another_customer_is_another_event(spark, tables):
    sinks.insert_events(spark, valid(spark, [doc(1), doc(1, customer="b")]), tables, Batch("t", 0))
    assert tables.read_events(spark).count() == 2


@pytest.mark.parametrize("options", [{}, {"reduce_history": True}, {"same_event_date": True},
                                     {"reduce_history": True, "same_event_date": True}])
def test_replay_equals_once(spark, small, tables, options):
    m = fixture.raw_messages(fixture.read_events(spark, small))
    first = pipeline.ingest(spark, m, tables, Batch("t", 0), **options)
    once = rows_of(tables.read_events(spark), *EVENT)
    marks = rows_of(tables.read_checkpoint(spark), *CHECKPOINT.names[:4])
    assert pipeline.ingest(spark, m, tables, Batch("t", 0), **options) == first      # the same batch, retried
    assert pipeline.ingest(spark, m, tables, Batch("t", 1), **options) == first      # the same messages, redelivered
    assert rows_of(tables.read_events(spark), *EVENT) == once
    assert rows_of(tables.read_checkpoint(spark), *CHECKPOINT.names[:4]) == marks
    assert (first["inserted"], first["invalid"], first["dlq"]) == (784, 206, 10)


def test_staged_ingest_is_the_same(spark, small, tables, tmp_path):
    m = fixture.raw_messages(fixture.read_events(spark, small))
    counters = pipeline.ingest(spark, m, tables, Batch("t"), staging=str(tmp_path / "staging"))
    assert counters == {"consumed": 1000, "inserted": 784, "invalid": 206, "dlq": 10}
    assert tables.read_events(spark).count() == 784


def test_hot_copies_are_cut_before_the_shuffle(spark):
    plan = dedup.first_arrivals(valid(spark, [doc(1)]))._jdf.queryExecution().executedPlan().toString()
    before_exchange = plan.split("Exchange", 1)[1]
    assert "WindowGroupLimit" in before_exchange and "Partial" in before_exchange


def test_quarantine_topics(spark, tables):
    values = [doc(1), doc(2, rate=300), "{", doc(3, customer="c" * 65)]
    pipeline.ingest(spark, messages(spark, values), tables, Batch("t", 0))
    invalid = [json.loads(r.value) for r in tables.read_topic(spark, "events.invalid.v1").collect()]
    dlq = [json.loads(r.value) for r in tables.read_topic(spark, "events.dlq.v1").collect()]
    assert sorted(e["raw"] for e in invalid) == sorted([values[1], values[2]])
    assert [(e["raw"], e["error_type"]) for e in dlq] == [(values[3], "PROCESSING")]


def marks(spark, rows):
    return spark.createDataFrame(rows, "consumer_group STRING, topic STRING, partition INT, last_offset BIGINT")


def test_checkpoint_upsert_is_unconditional(spark, tables):
    sinks.upsert_checkpoint(spark, marks(spark, [("g", "t", 0, 10), ("g", "t", 1, 5)]), tables)
    sinks.upsert_checkpoint(spark, marks(spark, [("g", "t", 0, 3), ("h", "t", 0, 7)]), tables)
    assert rows_of(tables.read_checkpoint(spark), *CHECKPOINT.names[:4]) == [
        ("g", "t", 0, 3), ("g", "t", 1, 5), ("h", "t", 0, 7)]


def test_snapshot_retry_reads_the_earlier_base(spark, tables):
    for version, offset in ((0, 1), (1, 2), (2, 3), (2, 30), (3, 4)):
        sinks.upsert_checkpoint(spark, marks(spark, [("g", "t", version, offset)]), tables, Batch("t", version))
    assert rows_of(tables.read_checkpoint(spark), "partition", "last_offset") == [(0, 1), (1, 2), (2, 30), (3, 4)]
    assert rows_of(keyed.read(spark, tables.checkpoint, CHECKPOINT, Batch("t", 3)), "partition") == [(0,), (1,), (2,)]


def test_invalid_rows_do_not_move_the_checkpoint(spark, tables):
    pipeline.ingest(spark, messages(spark, [doc(1), doc(2, rate=300)]), tables, Batch("t", 0))
    assert rows_of(tables.read_checkpoint(spark), "last_offset") == [(0,)]


def test_replay_after_checkpoint(spark):
    m = messages(spark, [doc(i) for i in range(4)]).unionByName(messages(spark, [doc(9)], partition=1))
    stored = marks(spark, [("g", "events.raw.v1", 0, 1), ("other", "events.raw.v1", 1, 99)])
    assert rows_of(lookup.replay_after(m, stored, "g"), "partition", "offset") == [(0, 2), (0, 3), (1, 0)]
    assert json.loads(raw.starting_offsets(stored, "g")) == {"events.raw.v1": {"0": 2}}
    assert raw.starting_offsets(stored, "nobody") == "earliest"
    every = {"events.raw.v1": [0, 1, 2], "x": [0]}
    assert json.loads(raw.starting_offsets(stored, "g", every)) == {"events.raw.v1": {"0": 2, "1": -2, "2": -2}, "x": {"0": -2}}
    assert json.loads(raw.starting_offsets(stored, "nobody", {"t": [1]})) == {"t": {"1": -2}}


def test_trace_to_source(spark):
    m = messages(spark, [doc(1), "{", doc(2)])
    stored = route.valid_events(route.route_messages(decode.decode_messages(m)))
    assert rows_of(lookup.trace_to_source(stored, m), "event_id", "raw") == [(uid(1), doc(1)), (uid(2), doc(2))]


def test_publish_round_trip(spark):
    """Published events are accepted again and come out the same."""
    events = valid(spark, [doc(i, customer=f"c{i}", rate=60 + i) for i in range(5)])
    published = sinks.event_messages(events).select(
        "key", "value", F.lit("t").alias("topic"), F.lit(0).alias("partition"),
        F.monotonically_increasing_id().alias("offset"), F.lit(WHEN).alias("timestamp"))
    again = decode.schema_valid(decode.decode_messages(published))
    columns = ("event_id", "customer_id", "event_time", F.col("heart_rate").cast("int"))
    assert rows_of(again, *columns) == rows_of(events, *columns)


def test_preview_is_the_first_n(spark):
    lines = [r.value for r in sinks.preview_json(valid(spark, [doc(i) for i in range(20)]), 3).collect()]
    assert [json.loads(x)["event_id"] for x in lines] == [uid(0), uid(1), uid(2)]


def test_views_answer_sql(spark, small, tables):
    m = fixture.raw_messages(fixture.read_events(spark, small))
    pipeline.ingest(spark, m, tables)
    pipeline.detect(spark, m, tables)
    tables.register_views(spark)
    got = spark.sql("""
        SELECT (SELECT count(*) FROM heartbeat_events) AS events, (SELECT count(*) FROM anomalies) AS found,
               (SELECT round(avg(heart_rate)::numeric(20,10), 1)::double FROM heartbeat_events) AS mean,
               (SELECT percentile_cont(0.95) WITHIN GROUP (ORDER BY heart_rate) FROM heartbeat_events) AS p95,
               (SELECT count(DISTINCT consumer_group) FROM ingest_checkpoint) AS groups""").first()
    assert tuple(got) == (784, 246 + 44 + 242, 77.1, 135.0, 1)


def test_date_partitions_are_pruned(spark, small, tables):
    pipeline.ingest(spark, fixture.raw_messages(fixture.read_events(spark, small)), tables)
    from datetime import datetime, timezone
    as_of = datetime(2024, 1, 30, 12, tzinfo=timezone.utc)
    recent = metrics.trailing(tables.read_events(spark), timedelta(days=1), as_of)
    plan = recent._jdf.queryExecution().executedPlan().toString()
    line = next(x for x in plan.splitlines() if "PartitionFilters" in x)
    assert "event_date" in line.split("PartitionFilters", 1)[1] and "GreaterThan(event_time" in line
    everything = tables.read_events(spark)
    assert recent.count() == everything.where(F.col("event_time") > F.lit(as_of - timedelta(days=1))).count() > 0


def test_kafka_options():
    options = raw.kafka_options(group="g", max_offsets_per_trigger=5)
    assert options["subscribe"] == "events.raw.v1" and options["startingOffsets"] == "earliest"
    assert sinks.kafka_sink_options("t")["topic"] == "t"


def test_a_batch_of_another_run_replaces_nothing(spark, tables):
    for first, last in ((0, 3), (3, 5)):
        pipeline.ingest(spark, messages(spark, [doc(i) for i in range(first, last)], start=first), tables)
    sinks.insert_events(spark, valid(spark, [doc(7)], start=7), tables, Batch("other", 0))
    sinks.insert_events(spark, valid(spark, [doc(8)], start=8), tables, Batch("other", 0))  # the same batch, anew
    assert [e[3] for e in rows_of(tables.read_events(spark), *EVENT)] == [0, 1, 2, 3, 4, 8]
    assert tables.read_topic(spark, "events.invalid.v1").count() == 0


def test_a_run_lives_with_its_progress(spark, tmp_path):
    first = run_of(spark, str(tmp_path / "a"))
    assert run_of(spark, str(tmp_path / "a")) == first != run_of(spark, str(tmp_path / "b"))


@pytest.mark.parametrize("zone", ["Asia/Tokyo", "America/Los_Angeles", "UTC"])
def test_dates_are_pruned_alike_in_every_zone(spark, tables, zone):
    from datetime import datetime, timezone
    times = ["2026-02-22T23:30:00Z", "2026-02-23T00:30:00Z", "2026-02-22T21:00:00Z"]
    pipeline.ingest(spark, messages(spark, [doc(i, time=t) for i, t in enumerate(times)]), tables)
    as_of = datetime(2026, 2, 23, 1, 0, tzinfo=timezone.utc)
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        stored = tables.read_events(spark)
        assert metrics.trailing(stored, timedelta(hours=2), as_of).count() == 2
        assert metrics.time_range(stored, as_of - timedelta(hours=5), as_of - timedelta(hours=1)).count() == 2
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    with pytest.raises(ValueError, match="no time zone"):
        metrics.trailing(stored, timedelta(hours=2), datetime(2026, 2, 23))


def test_archive_reads_only_matching_files(spark, small, tables):
    m = fixture.raw_messages(fixture.read_events(spark, small)).withColumn("partition", F.col("partition") % 3)
    half = F.col("offset") < 500
    tables.archive.keep(m.where(half), Batch("a", 0))
    for _ in range(2):  # the second attempt takes the first one's place
        tables.archive.keep(m.where(~half), Batch("a", 1))
    archive = tables.archive
    assert archive.read(spark).count() == 1000 and archive.partitions(spark) == {"events.raw.v1": [0, 1, 2]}
    files = len(archive.spans(spark))
    assert files >= 6
    late = marks(spark, [("g", "events.raw.v1", 0, 499), ("g", "events.raw.v1", 1, 10**9), ("h", "events.raw.v1", 2, 10**9)])
    replayed = archive.replay(spark, late, "g")
    assert rows_of(replayed, "offset") == rows_of(lookup.replay_after(m, late, "g"), "offset")
    assert len(replayed.inputFiles()) <= files - 3  # neither the old half of 0 nor partition 1
    stored = route.valid_events(route.route_messages(decode.decode_messages(m))).where("source_partition = 1 AND source_offset > 700")
    traced = archive.trace(stored)
    assert rows_of(traced, "event_id", "raw") == rows_of(lookup.trace_to_source(stored, m), "event_id", "raw")
    source = [f for f in traced.inputFiles() if "raw_archive" in f]
    assert source and all("partition=1" in f for f in source) and len(source) < files / 2
    assert archive.trace(stored.limit(0)).count() == 0


def test_history_is_not_shuffled(spark, tables):
    """Keys in the index, keys not there yet, and a batch that is repeated."""
    sinks.insert_events(spark, valid(spark, [doc(i) for i in range(6)]), tables, Batch("t", 0))
    assert tables.history.catch_up(spark) and not tables.history.catch_up(spark)
    sinks.insert_events(spark, valid(spark, [doc(i, rate=80) for i in range(4, 9)], start=6), tables, Batch("t", 1))
    indexed, recent = tables.history.read(spark)
    assert (indexed.count(), recent.count()) == (6, 3)
    sinks.insert_events(spark, valid(spark, [doc(i) for i in range(12)], start=11), tables, Batch("t", 2))
    assert rows_of(tables.read_events(spark), "event_id", "heart_rate") == [(uid(i), 70 if i < 6 or i > 8 else 80) for i in range(12)]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        fresh = dedup.absent_from(valid(spark, [doc(1), doc(99)]), tables.history.read(spark)[0])
        plan = fresh._jdf.queryExecution().executedPlan().toString()
        history = plan[plan.index("SortMergeJoin"):].splitlines()
        scan = next(i for i, x in enumerate(history) if "FileScan" in x and "Bucketed: true" in x)
        depth = lambda x: len(x) - len(x.lstrip(" :+-|"))
        above, at = [], depth(history[scan])
        for x in reversed(history[:scan]):
            if depth(x) < at:
                above.append(x)
                at = depth(x)
        assert not any("Exchange" in x for x in above) and rows_of(fresh, "event_id") == [(uid(99),)]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_index_follows_replaced_batches(spark, tables):
    sinks.write_events(valid(spark, [doc(1), doc(2)]), tables, Batch("t", 0))
    tables.history.catch_up(spark)
    sinks.write_events(valid(spark, [doc(2), doc(3)]), tables, Batch("t", 0))  # repeated, with other rows
    keys = lambda: sorted(r.event_id for part in tables.history.read(spark) for r in part.collect())
    assert keys() == [uid(2), uid(3)]
    for number in range(1, 6):
        sinks.write_events(valid(spark, [doc(10 * number)]), tables, Batch("t", number))
        tables.history.catch_up(spark)
        assert keys() == [uid(2), uid(3), *[uid(10 * n) for n in range(1, number + 1)]]
    assert len(tables.history._state(spark)[1]["parts"]) < 5  # parts are merged
    tables.events.compact(spark)
    assert not any(r.count() for r in [tables.history.read(spark)[1]]) and len(keys()) == 7
