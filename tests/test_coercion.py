"""Lax value forms. Where the validation library is installed, each value is
also put to it directly, so the tables below cannot drift from it."""

import json
from datetime import datetime, timedelta, timezone
from uuid import UUID

import pytest
from pyspark.sql import functions as F

from pulseforge.functions import coercion

BARE = "5d0c3f7a91be4e628a470b6c2d9e1f53"
ID = "5d0c3f7a-91be-4e62-8a47-0b6c2d9e1f53"

INTEGERS = [
    "70", " 70 ", "70.0", "70.", "70.5", "+70", "-5", "+ 70", "070", "0070.00", "7e1", "1_0", "1_000.0", "0x10", "",
    "  ", "true", " 70", "\t70\n", "７０", "--5", "-0", "_1", "1__0", ".0", "-0.0", "\x1c70", "٣", 70.0, 70.5, 1e2,
    True, False, None, [1], {"a": 1}, 70, 70.00000000000001, "0" * 50 + "7",
]
UUIDS = [
    ID, BARE, "{" + ID + "}", "{" + BARE + "}", "urn:uuid:" + ID, "URN:UUID:" + ID, "urn:uuid:" + BARE, ID.upper(),
    ID + "\n", " " + ID, ID.replace("-", "", 1), 5, "", "{" + ID, ID + "}", None, True, [ID], "g" * 32,
    12345678901234567890123456789012,
]
TIMES = [
    "2024-01-01", "2024-01-01T10:00", "2024-01-01t10:00:00z", "2024-01-01 10:00:00.1234567+0530", "2024-01-01_10:00:00",
    "2024-01-01T10:00:00,5", "2024-02-30T10:00:00Z", "2024-01-01T10:00:00+05", "2024-01-01T10:00:00-05:30",
    "2024-01-01T24:00:00", "2024-01-01T10:00:00Z\n", " 2024-01-01", "2024-01-01T10:00:00.", "2024-01-01T10:00Z",
    "2024-01-01T10", "2024-1-1", "20240101", "2024", "2024.5", "-5", "+5", "1700000000", "1700000000.123456",
    "1700000000000", "20000000000", "20000000001", "-20000000001", "1e9", " 1700000000", "1_0", "0001-01-01T00:00:00Z",
    "0000-01-01", "9999-12-31T23:59:59.999999Z", "2024-01-01T10:00:00+23:00", "2024-01-01T10:00:00+24:00",
    "2024-01-01T10:00:60", "2024-01-01T10:00:00 Z", "2024-01-01T10:00:00−05:00", "2024-01-01T10:00:00.12345678912345",
    "2024-01-01T10:00:00+05:60", "2024-01-01T10:00:00-00:00", "T12:30", "yesterday", "", "253402300800000",
    "253402300799999", "1700000000.", "1700000000.1234567", ".5", "2024-01-01Z", 1700000000, 1700000000.5,
    1700000000.1234567, 1700000000000, 1700000000123.456, 20000000001, True, None, -1.5, 10**25, "NaN", "-1.5",
    "2024-02-29", "2023-02-29", "2024-01-01T10:60:00", "2024-01-01T10:00:00+18:00", "2025-11-03T16:41:27.318450Z",
]


def micros(value: datetime) -> int:
    if value.tzinfo is None:
        value = value.replace(tzinfo=timezone.utc)
    return (value - datetime(1970, 1, 1, tzinfo=timezone.utc)) // timedelta(microseconds=1)


def read(spark, values, build):
    rows = [(i, json.dumps({"x": v})) for i, v in enumerate(values)]
    found = spark.createDataFrame(rows, "i INT, value STRING").select(
        "i", F.expr(coercion.parse_message("value")).alias("m")
    ).selectExpr("i", f"{build('m')} AS r")
    return [r.r for r in found.orderBy("i").collect()]


def as_integer(m):
    return coercion.integer_value(m, "x", coercion.kind_of(m, "x"), coercion.number_of(m, "x"))


def as_uuid(m):
    return coercion.uuid_value(m, "x", coercion.text_of(m, "x"))


def as_time(m):
    return f"unix_micros({coercion.timestamp_value(m, 'x', coercion.text_of(m, 'x'))})"


@pytest.mark.parametrize(
    "kind, values, build, to_plain",
    [(int, INTEGERS, as_integer, int), (UUID, UUIDS, as_uuid, str), (datetime, TIMES, as_time, micros)],
    ids=["integer", "uuid", "timestamp"],
)
def test_same_as_validation_library(spark, kind, values, build, to_plain):
    pydantic = pytest.importorskip("pydantic")
    adapter = pydantic.TypeAdapter(kind)

    def expected(value):
        try:
            return to_plain(adapter.validate_python(value))
        except pydantic.ValidationError:
            return None

    got = read(spark, values, build)
    assert [(v, r) for v, r in zip(values, got)] == [(v, expected(v)) for v in values]


def test_integer_forms(spark):
    values = ["70", " 70 ", 70.0, "70.0", True, 70.5, "70.5", None, "seventy", [70]]
    assert read(spark, values, as_integer) == [70, 70, 70, 70, 1, None, None, None, None, None]


def test_uuid_forms(spark):
    values = [ID, BARE, "{" + ID + "}", "urn:uuid:" + ID, ID.upper(), "{" + BARE + "}", ID + "\n", 5]
    assert read(spark, values, as_uuid) == [ID] * 5 + [None] * 3


@pytest.mark.parametrize(
    "text, one_document",
    [('{"a":1}', True), (' {"a":1}\n', True), ("5", True), ('{"a":1} x', False), ('{"a":1}{"b":2}', False),
     ('{"a":1},{"b":2}', False), ('{"a":1}] x', False), ("", False), ("[1", False), ('{"a":1,}', False)],
)
def test_exactly_one_json_document(spark, text, one_document):
    row = spark.createDataFrame([(text,)], "value STRING").selectExpr(
        coercion.is_sealed(coercion.parse_message("value"), "value")
    )
    assert row.first()[0] is one_document


def test_strip_removes_every_kind_of_space(spark):
    text = " \t\x1c cust 1  \n"
    row = spark.createDataFrame([(text,)], "v STRING").selectExpr(coercion.strip("v")).first()
    assert row[0] == text.strip() == "cust 1"


def test_derived_uuid_is_stable_and_well_formed(spark):
    frame = spark.range(100).selectExpr(f"""{coercion.derived_uuid("'t'", "1", "id")} AS u""")
    first, second = [r.u for r in frame.collect()], [r.u for r in frame.collect()]
    assert first == second and len(set(first)) == 100
    assert all(UUID(u).version == 4 and str(UUID(u)) == u for u in first)
