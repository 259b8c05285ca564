import json

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from helpers import doc, messages, rows_of, uid
from pulseforge import Settings
from pulseforge.config import TOPIC_RAW
from pulseforge.operators import anomalies, decode
from pulseforge.plans import fixture

# history, rate, expected. The limits 50, 140 and 30 are fixed values, and 49 to 51,
# 139 to 141, and differences of 29 to 31 lie around them.
RULES = [
    ([], 50, ("LOW_HEART_RATE", "high")), ([], 49, ("LOW_HEART_RATE", "high")), ([], 33, ("LOW_HEART_RATE", "high")), ([], 51, None),
    ([], 140, ("HIGH_HEART_RATE", "high")), ([], 141, ("HIGH_HEART_RATE", "high")), ([], 188, ("HIGH_HEART_RATE", "high")), ([], 139, None),
    ([62], 93, ("SPIKE", "medium")), ([118], 87, ("SPIKE", "medium")), ([74], 104, ("SPIKE", "medium")), ([74], 103, None),
    ([104], 75, None), ([104], 74, ("SPIKE", "medium")), ([], 88, None), ([97, 84, 61], 99, ("SPIKE", "medium")),
    ([], 66, None), ([81, 79, 83], 82, None), ([96], 50, ("LOW_HEART_RATE", "high")), ([96], 140, ("HIGH_HEART_RATE", "high")),
    ([], 29, ("LOW_HEART_RATE", "high")), ([], 219, ("HIGH_HEART_RATE", "high")), ([112, 72], 78, None),
]


def detect(spark, values, settings=Settings()):
    return anomalies.detect(decode.schema_valid(decode.decode_messages(messages(spark, values))), settings)


@pytest.mark.parametrize("chunk", [1, 2, 1 << 20])
def test_rules(spark, chunk):
    values, expected = [], {}
    for case, (history, rate, outcome) in enumerate(RULES):
        for earlier in history:
            values.append(doc(10_000 + len(values), customer=f"case {case}", rate=earlier))
        values.append(doc(case, customer=f"case {case}", rate=rate))
        if outcome:
            expected[uid(case)] = outcome
    found = detect(spark, values, Settings(lookback_chunk=chunk))
    got = {r.event_id: (r.anomaly_type, r.severity) for r in found.collect() if int(r.event_id[-12:]) < 10_000}
    assert got == expected


def test_details(spark):
    found = detect(spark, [doc(1, rate=70), doc(2, rate=105), doc(3, rate=42), doc(4, rate=165)])
    details = {r.event_id: json.loads(r.details) for r in found.collect()}
    assert details == {
        uid(2): {"delta": 35, "threshold": 30, "previous": 70, "measured": 105},
        uid(3): {"threshold": 50, "measured": 42},
        uid(4): {"threshold": 140, "measured": 165},
    }


def test_arrival_order_not_event_time(spark):
    values = [doc(1, rate=70, time="2026-01-01T00:00:10Z"), doc(2, rate=105, time="2026-01-01T00:00:20Z"),
              doc(3, rate=75, time="2026-01-01T00:00:12Z")]  # back-dated
    assert {r.event_id for r in detect(spark, values).collect()} == {uid(2), uid(3)}


def test_population_and_history(spark):
    values = [doc(1, rate=28), doc(2, rate=60), doc(3, rate="bad"), doc(4, rate=89), doc(5, rate=89)]
    # 28 is quarantined by the writer but is an anomaly, and the predecessor of 60.
    assert rows_of(detect(spark, values), "event_id", "anomaly_type") == [
        (uid(1), "LOW_HEART_RATE"), (uid(2), "SPIKE")]


def test_ids_too_long_to_store_give_no_anomaly(spark):
    assert detect(spark, [doc(1, customer="c" * 65, rate=30), doc(2, customer="c" * 64, rate=30)]).count() == 1


def test_repeated_delivery_gives_a_second_row(spark):
    assert detect(spark, [doc(1, rate=30), doc(1, rate=30)]).count() == 2


def test_published_message(spark):
    row = anomalies.as_messages(detect(spark, [doc(1, rate=30, time="2026-01-01T00:00:10Z")])).first()
    assert row.key == "cust_00001"
    assert json.loads(row.value) == {
        "event_id": uid(1), "customer_id": "cust_00001", "timestamp": "2026-01-01T00:00:10Z", "heart_rate": 30,
        "anomaly_type": "LOW_HEART_RATE", "severity": "high", "details": {"threshold": 50, "measured": 30}}


def hot_readings(spark):
    """A third of all rows belongs to one customer."""
    return spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("c"), (F.col("id") % 97).cast("string"))).alias("customer_id"),
        F.lit(TOPIC_RAW).alias("topic"),
        (F.xxhash64("id") % 3).cast("int").alias("partition"),
        F.col("id").alias("offset"),
        F.pmod(F.xxhash64("id"), F.lit(150)).cast("int").alias("heart_rate"),
    )


@pytest.mark.parametrize("chunk", [1, 7, 64, 1000, 1 << 20])
def test_lookback_equals_plain_window(spark, chunk):
    rows = hot_readings(spark)
    order = Window.partitionBy("customer_id").orderBy("topic", "partition", "offset")
    plain = rows.select("offset", F.lag("heart_rate").over(order).alias("p"),
                        F.collect_list("heart_rate").over(order.rowsBetween(-6, -1)).alias("h"))
    settings = Settings(lookback_chunk=chunk)
    lag = anomalies.with_previous_rate(rows, settings)
    history = anomalies.with_history(rows, settings)
    key = lambda frame, column: sorted((r[0], repr(r[1])) for r in frame.select("offset", column).collect())
    assert key(lag, "previous_rate") == key(plain, "p")
    assert key(history, "recent_rates") == key(plain, "h")


@pytest.mark.parametrize("chunk", [1, 7, 1 << 20])
def test_known_values_precede_all_others(spark, chunk):
    rows = hot_readings(spark)
    known = spark.createDataFrame([("hot", 900), ("c5", 901), ("nobody", 902)], "customer_id STRING, heart_rate INT")
    found = anomalies.with_previous_rate(rows, Settings(lookback_chunk=chunk), known)
    plain = anomalies.with_previous_rate(rows, Settings(lookback_chunk=chunk))
    got = {r.offset: r.previous_rate for r in found.collect()}
    changed = {r.customer_id: got[r.offset] for r in plain.collect() if got[r.offset] != r.previous_rate}
    assert changed == {"hot": 900, "c5": 901} and len(got) == 3000


def test_lookback_bounds_every_window_group(spark):
    """No (customer, chunk) group exceeds the chunk, and edge rows are few."""
    chunk = 50
    rows = hot_readings(spark).where("customer_id = 'hot'")
    groups = rows.groupBy("partition", F.floor(F.col("offset") / chunk)).count()
    assert groups.agg(F.max("count")).first()[0] <= chunk


def test_lookback_sorts_each_reading_once(spark, small, tmp_path):
    """One exchange and one sort of readings; the second read has the columns that
    the chunks' last readings need, and is combined before it is shuffled."""
    fixture.readings(fixture.read_events(spark, small)).write.parquet(str(tmp_path / "readings"))
    found = anomalies.detect(spark.read.parquet(str(tmp_path / "readings")))
    plan = found._jdf.queryExecution().sparkPlan().toString()
    planned = found._jdf.queryExecution().executedPlan().toString()
    lines = [x for x in planned.splitlines() if "Sort [customer_id" in x and "event_id" not in x]
    with_time = [x for x in planned.splitlines() if "Sort [" in x and "offset" in x]
    assert len(with_time) == 1 and len(lines) <= 4
    assert plan.count("Window") == 2 and "partial_max_by" in planned
    narrow = [x for x in planned.splitlines() if "FileScan" in x]
    assert len(narrow) == 2 and sum("event_id" in x.split("ReadSchema", 1)[1] for x in narrow) == 1


def test_history_depth(spark):
    frame = decode.schema_valid(decode.decode_messages(messages(spark, [doc(i, rate=60 + i) for i in range(9)])))
    got = {r.offset: r.recent_rates for r in anomalies.with_history(frame).collect()}
    assert got[0] == [] and got[3] == [60, 61, 62] and got[8] == [62, 63, 64, 65, 66, 67]
