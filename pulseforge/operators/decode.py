"""Raw message -> typed reading, or the reasons why it is not one."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulseforge.config import HARD_RATE_MAX, HARD_RATE_MIN
from pulseforge.functions import coercion, text
from pulseforge.session import require_configured

SOURCE = ("topic", "partition", "offset")
READING = ("event_id", "customer_id", "event_time", "heart_rate", "reasons", "error")

# Why a message is not a reading: condition -> (reason, text), in field order.
WHOLE = (
    ("NOT readable", "encoding", "message is not UTF-8 text"),
    ("NOT parsed", "json", "message is not one JSON document"),
    (
        f"customer_kind IS NULL AND rate_kind IS NULL AND NOT ({coercion.is_object('message')})",
        "not_object", "message is not a JSON object",
    ),
)
FIELDS = (
    (("event_id IS NULL", "event_id", "event_id is not a valid UUID"),),
    (
        ("customer_kind IS NULL", "customer_id_missing", "customer_id is missing"),
        ("customer_id IS NULL", "customer_id_type", "customer_id is not a string"),
        ("customer_id = ''", "customer_id_blank", text.BLANK_CUSTOMER),
    ),
    (("event_time IS NULL", "timestamp", "timestamp is not a valid date and time"),),
    (
        ("rate_kind IS NULL", "heart_rate_missing", "heart_rate is missing"),
        ("rate IS NULL", "heart_rate_type", "heart_rate is not a whole number"),
        (
            f"rate NOT BETWEEN {HARD_RATE_MIN} AND {HARD_RATE_MAX}",
            "heart_rate_hard_bounds", text.HARD_BOUNDS % ("{rate}", HARD_RATE_MIN, HARD_RATE_MAX),
        ),
    ),
)


def decode_messages(messages: DataFrame) -> DataFrame:
    """Decode and validate every message; keeps all rows.

    Input: ``value`` (STRING or BINARY), ``topic``, ``partition``, ``offset``,
    ``timestamp``. Output: ``topic, partition, offset, raw, event_id,
    customer_id, event_time, heart_rate, reasons, error``. ``reasons`` and
    ``error`` are NULL for a schema-valid reading; otherwise they list every
    failed check in field order.

    A message in the producers' own form is recognised by cutting it at its
    quotes; only others are parsed as JSON.

    The decoded struct passes through a one-element generator. Filters on its
    fields then stay above it, so a route filter does not make the optimizer
    copy the JSON parse into the filter and parse every message again.
    """
    require_configured(messages.sparkSession)
    binary = isinstance(messages.schema["value"].dataType, T.BinaryType)
    as_text = "CAST(value AS STRING)"
    read = messages.selectExpr(
        *_quoted(SOURCE), "timestamp",
        f"coalesce({f'make_valid_utf8({as_text})' if binary else as_text}, '') AS raw",
        f"value IS NOT NULL{f' AND is_valid_utf8({as_text})' if binary else ''} AS readable",
    )
    cut = read.selectExpr("*", f"{coercion.split_message('raw')} AS parts").selectExpr(
        "*", f"readable AND {coercion.is_canonical('parts')} AS canonical"
    )
    parsed = cut.selectExpr(
        "*", f"CASE WHEN readable AND NOT canonical THEN {coercion.parse_message('raw')} END AS message"
    )
    judged = _judge(_coerce(_fields(parsed)))
    return judged.selectExpr(*_quoted(SOURCE), "raw", f"inline_outer(array(struct({', '.join(READING)})))")


def _quoted(names: tuple[str, ...]) -> list[str]:
    return [f"`{name}`" for name in names]


def _fields(parsed: DataFrame) -> DataFrame:
    """Read the fields out of the parsed document, each once."""
    def field(plain: str, general: str) -> str:
        return f"CASE WHEN canonical THEN {plain} ELSE {general} END"

    part = lambda name: f"parts[{coercion.CANONICAL_TEXT[name]}]"
    return parsed.selectExpr(
        "*",
        f"canonical OR {coercion.is_sealed('message', 'raw')} AS parsed",
        f"{field(part('event_id'), coercion.text_of('message', 'event_id'))} AS event_text",
        f"{field(part('customer_id'), coercion.text_of('message', 'customer_id'))} AS customer_text",
        f"""{field("'STRING'", coercion.kind_of('message', 'customer_id'))} AS customer_kind""",
        f"{field(part('timestamp'), coercion.text_of('message', 'timestamp'))} AS time_text",
        f"{field(coercion.canonical_rate('parts'), coercion.number_of('message', 'heart_rate'))} AS rate_number",
        f"""{field("'BIGINT'", coercion.kind_of('message', 'heart_rate'))} AS rate_kind""",
    )


def _coerce(fields: DataFrame) -> DataFrame:
    def absent(name: str, found: str) -> str:
        return f"{found} IS NULL AND {coercion.kind_of('message', name)} IS NULL"

    return fields.selectExpr(
        *_quoted(SOURCE), "raw", "customer_kind", "rate_kind", "readable", "parsed",
        f"{_first(WHOLE, reason=True)} AS whole",
        f"""CASE WHEN canonical THEN lower(event_text) WHEN {absent('event_id', 'event_text')}
            THEN {coercion.derived_uuid('topic', 'partition', '`offset`')}
            ELSE {coercion.uuid_value('message', 'event_id', 'event_text')} END AS event_id""",
        f"""CASE WHEN canonical THEN customer_text
            WHEN customer_kind = 'STRING' THEN {coercion.strip('customer_text')} END AS customer_id""",
        f"""CASE WHEN canonical THEN try_to_timestamp(time_text) WHEN {absent('timestamp', 'time_text')} THEN timestamp
            ELSE {coercion.timestamp_value('message', 'timestamp', 'time_text')} END AS event_time""",
        f"{coercion.integer_value('message', 'heart_rate', 'rate_kind', 'rate_number')} AS rate",
    )


def _first(cases: tuple[tuple[str, str, str], ...], reason: bool) -> str:
    """The reason (or text) of the first condition that holds, else NULL."""
    def literal(value: str) -> str:
        before, found, after = value.partition("{rate}")
        return f"'{before}' || rate || '{after}'" if found else f"'{value}'"

    whens = " ".join(f"WHEN {when} THEN {literal(code if reason else message)}" for when, code, message in cases)
    return f"CASE {whens} END"


def _judge(values: DataFrame) -> DataFrame:
    """Keep the values of good readings, explain the others."""
    def explain(separator: str, reason: bool) -> str:
        by_field = ", ".join(_first(cases, reason) for cases in FIELDS)
        whole = "whole" if reason else _first(tuple((f"whole = '{c}'", c, m) for _, c, m in WHOLE), reason=False)
        return f"CASE WHEN NOT ok THEN coalesce({whole}, concat_ws('{separator}', {by_field})) END"

    ok = f"""whole IS NULL AND event_id IS NOT NULL AND event_time IS NOT NULL AND coalesce(customer_id <> ''
        AND rate BETWEEN {HARD_RATE_MIN} AND {HARD_RATE_MAX}, false) AS ok"""
    return values.selectExpr("*", ok).selectExpr(
        *_quoted(SOURCE), "raw",
        "CASE WHEN ok THEN event_id END AS event_id",
        "CASE WHEN ok THEN customer_id END AS customer_id",
        "CASE WHEN ok THEN event_time END AS event_time",
        "CASE WHEN ok THEN CAST(rate AS INT) END AS heart_rate",
        f"{explain(',', reason=True)} AS reasons",
        f"{explain('; ', reason=False)} AS error",
    )


def schema_valid(decoded: DataFrame) -> DataFrame:
    """Readings that passed every schema check (soft bounds not applied)."""
    return decoded.where(F.col("reasons").isNull()).drop("raw", "reasons", "error")
