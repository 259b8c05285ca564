import math
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from pulseforge import Settings
from pulseforge.operators import decode, lookup, metrics, route
from pulseforge.operators.selection import quantile
from pulseforge.plans import fixture

T0 = datetime(2026, 1, 1, 12, 0, 0, tzinfo=timezone.utc)


def events(spark, rows):
    """rows: (seconds after T0, rate, customer)"""
    data = [(f"e{i:04d}", c, T0 + timedelta(seconds=s), r) for i, (s, r, c) in enumerate(rows)]
    return spark.createDataFrame(data, "event_id STRING, customer_id STRING, event_time TIMESTAMP, heart_rate INT")


def value(frame):
    return frame.first()[0]


def test_empty_input(spark):
    none = events(spark, [])
    assert value(metrics.average_rate(none)) is None
    assert value(metrics.p95_rate(none)) is None
    assert value(metrics.active_customers(none)) == 0.0
    assert metrics.per_minute(none).count() == 0


def test_average_rounds_half_up(spark):
    # mean 60.25 and 60.35 exactly
    assert value(metrics.average_rate(events(spark, [(0, r, "a") for r in (60, 60, 60, 61)]))) == 60.3
    assert value(metrics.average_rate(events(spark, [(0, 60, "a")] * 13 + [(0, 61, "a")] * 7))) == 60.4


def test_p95_interpolates(spark):
    assert value(metrics.p95_rate(events(spark, [(0, r, "a") for r in (50, 100)]))) == pytest.approx(97.5)


def test_trailing_is_strict_below_and_open_above(spark):
    rows = events(spark, [(-300, 1, "a"), (-299, 2, "a"), (0, 3, "a"), (50, 4, "a")])
    kept = metrics.trailing(rows, timedelta(minutes=5), T0)
    assert sorted(r.heart_rate for r in kept.collect()) == [2, 3, 4]


def test_range_is_inclusive(spark):
    rows = events(spark, [(-1, 1, "a"), (0, 2, "a"), (10, 3, "a"), (11, 4, "a")])
    kept = metrics.time_range(rows, T0, T0 + timedelta(seconds=10))
    assert sorted(r.heart_rate for r in kept.collect()) == [2, 3]


def test_per_minute_skips_empty_minutes(spark):
    got = [tuple(r) for r in metrics.per_minute(events(spark, [(0, 1, "a"), (59, 1, "a"), (180, 1, "a")])).select(
        F.col("time").cast("string"), "value").collect()]
    assert got == [("2026-01-01 12:00:00", 2.0), ("2026-01-01 12:03:00", 1.0)]


@pytest.mark.parametrize("v, average, p95", [(None, None, None), (59.9, "blue", "green"), (60.0, "green", "green"),
                                             (119.9, "green", "green"), (120.0, "orange", "green"),
                                             (130.0, "orange", "yellow"), (140.0, "red", "yellow"), (160.0, "red", "red")])
def test_bands(spark, v, average, p95):
    row = spark.createDataFrame([(v,)], "v DOUBLE").select(
        metrics.average_band(F.col("v")), metrics.p95_band(F.col("v"))).first()
    assert tuple(row) == (average, p95)


def test_throughput_flags_slow_intervals(spark):
    rows = events(spark, [(0, 1, "a")] * 10 + [(5, 1, "a")] * 9)
    got = metrics.throughput(rows, Settings(throughput_min_eps=2.0)).orderBy("interval_start")
    assert [tuple(r)[1:] for r in got.collect()] == [(10, 2.0, False), (9, 1.8, True)]


@pytest.mark.parametrize("n", [1, 3, 1500])
def test_last_readings(spark, n):
    rows = events(spark, [(i, 60, "hot" if i % 3 else f"c{i}") for i in range(60)])
    got = lookup.last_readings(rows, n)
    hot = [r.event_id for r in got.where("customer_id = 'hot'").orderBy("position").collect()]
    everything = sorted((f"e{i:04d}" for i in range(60) if i % 3), reverse=True)
    assert hot == everything[:n]
    assert got.where("customer_id != 'hot'").count() == 20
    assert [r.event_id for r in lookup.customer_last_readings(rows, "hot", n).collect()] == everything[:n]


def test_recent_anomalies_is_a_top_k(spark):
    rows = events(spark, [(i, 60, "a") for i in range(50)]).withColumns(
        {"anomaly_type": F.lit("SPIKE"), "severity": F.lit("medium")})
    top = metrics.recent_anomalies(rows)
    assert top.count() == 20 and top.columns == ["event_time", "customer_id", "heart_rate", "anomaly_type", "severity"]
    assert "TakeOrderedAndProject" in top._jdf.queryExecution().executedPlan().toString()


def test_latency(spark):
    rows = events(spark, [(0, 60, "a")] * 4).withColumn(
        "ingest_time", F.col("event_time") + F.make_dt_interval(secs=F.lit(2.5).cast("decimal(18,6)")))
    assert tuple(lookup.ingest_latency(rows).first()) == (4, 2.5, 2.5, 2.5)


@pytest.mark.parametrize("values", [[5], [3, 3, 3], list(range(100)), [-(1 << 40), 7, 1 << 40, 1 << 40], [None, 4, None, 9], [i * i * 977 % 1_000_003 - 400_000 for i in range(997)], []])
def test_exact_quantile(spark, values):
    rows = spark.createDataFrame([(v,) for v in values], "v BIGINT")
    known = sorted(v for v in values if v is not None)
    for fraction in (0.0, 0.05, 0.5, 0.95, 1.0):
        want = known[max(1, math.ceil(fraction * len(known))) - 1] if known else None
        assert quantile(rows, F.col("v"), fraction) == want


def test_panels_are_in_order(spark, small):
    """By minute ascending; by count descending, then by type."""
    rows = route.valid_events(route.route_messages(decode.decode_messages(fixture.raw_messages(fixture.read_events(spark, small)))))
    minutes = [r.time for r in metrics.per_minute(rows.repartition(5)).collect()]
    assert len(minutes) > 100 and minutes == sorted(minutes)
    found = spark.createDataFrame([(t,) for t in ["b"] * 3 + ["a"] * 3 + ["c"] * 5 + ["d"]], "anomaly_type STRING").repartition(3)
    assert [(r.anomaly_type, r["count"]) for r in metrics.type_breakdown(found).collect()] == [("c", 5), ("a", 3), ("b", 3), ("d", 1)]
