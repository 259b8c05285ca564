import json

import pytest
from pyspark.sql import functions as F

from helpers import WHEN, doc, messages, rows_of, uid
from pulseforge import Settings
from pulseforge.config import TOPIC_RAW
from pulseforge.operators import decode, route
from pulseforge.plans import fixture


def without(text, *names):
    return json.dumps({k: v for k, v in json.loads(text).items() if k not in names})


GOOD = doc(1)
CASES = [
    # message, route, reasons
    (GOOD, "VALID", None),
    ('{"event_id": "5d0c3f7a-91be-4e62-8a47-0b6c2d9e1f53", "customer_id": "cust_71940", '
     '"timestamp": "2025-11-03T16:41:27.318450Z", "heart_rate": 83}', "VALID", None),
    (doc(1, rate=138), "VALID", None),
    (doc(1, customer=""), "VALIDATION", "customer_id_blank"),
    (doc(1, customer="   "), "VALIDATION", "customer_id_blank"),
    (doc(1, customer="  \t"), "VALIDATION", "customer_id_blank"),
    (doc(1, rate=300), "VALIDATION", "heart_rate_hard_bounds"),
    (doc(1, rate=-5), "VALIDATION", "heart_rate_hard_bounds"),
    (doc(1, rate=251), "VALIDATION", "heart_rate_hard_bounds"),
    (doc(1, rate=250), "VALIDATION", "heart_rate_soft_bounds"),
    (doc(1, rate=0), "VALIDATION", "heart_rate_soft_bounds"),
    (doc(1, rate=44), "VALIDATION", "heart_rate_soft_bounds"),
    (doc(1, rate=45), "VALID", None),
    (doc(1, rate=185), "VALID", None),
    (doc(1, rate=186), "VALIDATION", "heart_rate_soft_bounds"),
    (doc(1, rate=28), "VALIDATION", "heart_rate_soft_bounds"),
    (doc(1, rate=222), "VALIDATION", "heart_rate_soft_bounds"),
    (doc(1, rate=70.5), "VALIDATION", "heart_rate_type"),
    (doc(1, rate="70"), "VALID", None),
    (doc(1, rate=" 70 "), "VALID", None),
    (doc(1, rate=70.0), "VALID", None),
    (doc(1, rate=True), "VALIDATION", "heart_rate_soft_bounds"),
    (doc(1, rate=None), "VALIDATION", "heart_rate_type"),
    (doc(1, rate=10**30), "VALIDATION", "heart_rate_type"),
    (doc(1, customer=None), "VALIDATION", "customer_id_type"),
    (doc(1, customer=5), "VALIDATION", "customer_id_type"),
    (doc(1, time=None), "VALIDATION", "timestamp"),
    (doc(1, time="yesterday"), "VALIDATION", "timestamp"),
    (doc(1, time=True), "VALIDATION", "timestamp"),
    (doc(1, extra={"x": [1]}), "VALID", None),
    (doc(1).replace(uid(1), "not-a-uuid"), "VALIDATION", "event_id"),
    (doc(1).replace(f'"{uid(1)}"', "null"), "VALIDATION", "event_id"),
    (without(GOOD, "heart_rate"), "VALIDATION", "heart_rate_missing"),
    (without(GOOD, "customer_id"), "VALIDATION", "customer_id_missing"),
    (without(GOOD, "event_id", "timestamp"), "VALID", None),
    ("{}", "VALIDATION", "customer_id_missing,heart_rate_missing"),
    (doc(1, customer=" ", rate=300), "VALIDATION", "customer_id_blank,heart_rate_hard_bounds"),
    ("5", "VALIDATION", "not_object"),
    ("[1]", "VALIDATION", "not_object"),
    ("null", "VALIDATION", "not_object"),
    ('"text"', "VALIDATION", "not_object"),
    ("", "VALIDATION", "json"),
    (GOOD[:-1], "VALIDATION", "json"),
    (GOOD + " x", "VALIDATION", "json"),
    (GOOD + GOOD, "VALIDATION", "json"),
    (GOOD.replace("70}", "NaN}"), "VALIDATION", "json"),
    (None, "VALIDATION", "encoding"),
    (doc(1, customer="c" * 64), "VALID", None),
    (doc(1, customer="c" * 65), "PROCESSING", "customer_id_length"),
    (doc(1, customer="  " + "c" * 64 + " "), "VALID", None),
    (doc(1, customer="c\u0000d"), "PROCESSING", "customer_id_nul"),
    (doc(1, customer="c" * 65, rate=200), "VALIDATION", "heart_rate_soft_bounds"),
    ('{"customer_id": "a", "heart_rate": 300, "heart_rate": 70}', "VALID", None),
    ('{"customer_id": "a", "heart_rate": 70, "heart_rate": 300}', "VALIDATION", "heart_rate_hard_bounds"),
]


@pytest.fixture(scope="module")
def routed(spark):
    return route.route_messages(decode.decode_messages(messages(spark, [c[0] for c in CASES]))).cache()


def test_every_case(routed):
    got = {r.offset: (r.route, r.reasons) for r in routed.collect()}
    for i, (value, *expected) in enumerate(CASES):
        assert (value, *got[i]) == (value, *expected)


def test_routes_partition_the_input(routed):
    c = route.route_counters(routed).first()
    assert c.consumed == len(CASES) == c.inserted + c.invalid + c.dlq


@pytest.mark.parametrize("change", [" ", "extra"])
def test_producer_form_and_general_form_agree(spark, change):
    """The pattern path and the JSON path give the same readings."""
    times = ["2025-11-03T16:41:27.318450Z", "2025-11-03 16:41:27", "2025-11-03T16:41:27.5+05:30", "2026-13-01T00:00:00Z"]
    values = [doc(i, customer=c, rate=r, time=t) for i, (c, r, t) in enumerate(
        (c, r, t) for c in ("cust_00001", "a}b{c", "x" * 70) for r in (0, 44, 70, 250, 251, 999999999) for t in times)]
    values += [v.replace(": ", ":").replace(", ", ",") for v in values] + [v.upper().replace("EVENT_ID", "event_id") for v in values[:3]]
    general = [" " + v if change == " " else v[:-1] + ', "x": [1]}' for v in values]
    columns = ("offset", "route", "event_id", "customer_id", "event_time", "heart_rate", "reasons", "error")
    run = lambda v: sorted(map(repr, route.route_messages(decode.decode_messages(messages(spark, v))).select(*columns).collect()))
    assert run(values) == run(general)


def test_error_texts(routed):
    errors = {r.raw: r.error for r in routed.where("error is not null").collect()}
    assert errors[doc(1, customer="")] == "customer_id cannot be empty or whitespace"
    assert errors[doc(1, rate=300)] == "heart_rate 300 is outside hard physiological bounds [0, 250]"
    assert errors[doc(1, rate=28)] == "heart_rate 28 is outside the configured domain bounds [45, 185]"
    assert errors[doc(1, customer="c" * 65)] == "value too long for type character varying(64)"
    assert "; " in errors[doc(1, customer=" ", rate=300)]


def test_every_error_has_text(routed):
    assert routed.where("(route = 'VALID') != (error is null) or (error = '')").count() == 0


def test_defaults_are_stable(spark):
    value = '{"customer_id": "a", "heart_rate": 70}'
    frame = decode.decode_messages(messages(spark, [value, value]))
    first, second = rows_of(frame, "offset", "event_id", "event_time"), rows_of(frame, "offset", "event_id", "event_time")
    assert first == second and first[0][1] != first[1][1]
    assert frame.where(F.col("event_time") == F.lit(WHEN)).count() == 2


def test_invalid_utf8_is_quarantined(spark):
    rows = [("k", bytearray(b'{"customer_id": "\xff", "heart_rate": 70}'), TOPIC_RAW, 0, 0, WHEN),
            ("k", bytearray(GOOD.encode()), TOPIC_RAW, 0, 1, WHEN)]
    schema = "key STRING, value BINARY, topic STRING, partition INT, offset BIGINT, timestamp TIMESTAMP"
    routed = route.route_messages(decode.decode_messages(spark.createDataFrame(rows, schema)))
    assert rows_of(routed, "offset", "route", F.coalesce("reasons", F.lit(""))) == [
        (0, "VALIDATION", "encoding"), (1, "VALID", "")]
    assert "�" in route.quarantine(routed, "VALIDATION").first().raw


def test_soft_bounds_are_parameters(spark):
    settings = Settings(heart_rate_min=60, heart_rate_max=65)
    routed = route.route_messages(decode.decode_messages(messages(spark, [doc(1, rate=70), doc(2, rate=65)])), settings)
    assert rows_of(routed, "offset", "route") == [(0, "VALIDATION"), (1, "VALID")]


def test_stored_layout(spark):
    valid = route.valid_events(route.route_messages(decode.decode_messages(messages(spark, [doc(7, rate="70")], 3, 11))))
    row = valid.first()
    assert (row.quality_flag, row.source_topic, row.source_partition, row.source_offset) == ("valid", TOPIC_RAW, 3, 11)
    assert json.loads(row.payload) == {
        "event_id": uid(7), "customer_id": "cust_00001", "timestamp": "2025-11-03T16:41:27.318450+00:00", "heart_rate": 70}
    whole = route.valid_events(route.route_messages(decode.decode_messages(
        messages(spark, [doc(7, time="2025-11-03T17:41:27+01:00")]))))
    assert json.loads(whole.first().payload)["timestamp"] == "2025-11-03T16:41:27+00:00"


def test_envelope(spark, routed):
    row = route.as_envelope_json(route.quarantine(routed, "PROCESSING")).first()
    assert set(json.loads(row.value)) == {"error", "raw", "error_type"}
    assert json.loads(row.value)["error_type"] == "PROCESSING"


def test_message_is_parsed_once_per_row(spark, small):
    """A route filter must not copy the JSON parse below itself."""
    raw = fixture.raw_messages(fixture.read_events(spark, small))
    plan = route.valid_events(route.route_messages(decode.decode_messages(raw)))
    assert plan._jdf.queryExecution().executedPlan().toString().count("parseJson") == 1


def test_needs_configured_session(spark):
    spark.conf.set("spark.sql.session.timeZone", "Europe/Paris")
    try:
        with pytest.raises(RuntimeError):
            decode.decode_messages(messages(spark, [GOOD]))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
