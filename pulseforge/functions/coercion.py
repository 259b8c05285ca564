"""SQL expressions that read typed values out of untrusted JSON.

The accepted forms are those of a lax data-model validator: numbers may come
as text, identifiers in several spellings, times as ISO text or unix numbers.
Everything here is a built-in expression; a value that does not fit becomes
NULL and never raises. The functions return SQL text, because one parsed
expression is built much faster than the same tree column by column.
"""

from __future__ import annotations

# Accepted spellings. ``\z`` (not ``$``) so that a trailing
# newline is not let through.
UUID = r"[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}"
UUID_HYPHENATED = rf"^{UUID}\z"
UUID_WRAPPED = rf"^(\{{{UUID}\}}|urn:uuid:{UUID}|[0-9a-fA-F]{{32}})\z"
INTEGER_TEXT = r"(?U)^\s*([+-]?(?-U:[0-9]+(?:_[0-9]+)*))(?:\.0+)?\s*\z"
UNIX_TEXT = r"^[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)\z"
ISO = (
    r"(?!0000)[0-9]{4}-[0-9]{2}-[0-9]{2}[T ][0-9]{2}:[0-9]{2}:[0-9]{2}(?:\.[0-9]{1,6})?"
    r"(?:Z|[+-](?:0[0-9]|1[0-7]):[0-5][0-9])?"
)
RFC3339 = rf"^{ISO}\z"
ISO_PARTS = (
    r"^((?!0000)[0-9]{4}-[0-9]{2}-[0-9]{2})"
    r"(?:[Tt _]([0-9]{2}:[0-9]{2})(?::([0-9]{2})(?:[.,]([0-9]+))?)?"
    r"(?:[Zz]|([+\-−])([01][0-9]|2[0-3]):?([0-5][0-9]))?)?\z"
)
PLAIN_ID = r"^[!#-\[\]-~]+\z"
RATE_END = r"^: ?(?:0|[1-9][0-9]{0,8})\}\z"
EDGE_SPACE = r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+\z"

# A unix number above this magnitude counts milliseconds; the
# result must fall in years 1 to 9999.
UNIX_SECONDS_LIMIT = 20_000_000_000
MICROS_MIN = -62_135_596_800_000_000
MICROS_MAX = 253_402_300_799_999_999


def strip(text: str) -> str:
    """Remove white space of any kind from both ends."""
    return f"regexp_replace({text}, r'{EDGE_SPACE}', '')"


def parse_message(value: str) -> str:
    """VARIANT holding ``[document, seal]``, NULL where ``value`` is not JSON.

    The JSON parser stops after the first complete value and ignores what
    follows, so ``{"a":1} x`` alone would pass. Parsing the text as the first
    element of an array whose second element is the text's own hash makes any
    trailing or extra content either a syntax error or a wrong second element.
    """
    return f"try_parse_json('[' || {value} || ',' || xxhash64({value}) || ']')"


def is_sealed(message: str, value: str) -> str:
    """True where :func:`parse_message` read exactly one JSON value."""
    return f"coalesce(try_variant_get({message}, '$[1]', 'bigint') = xxhash64({value}), false)"


def split_message(value: str) -> str:
    """A message cut at its double quotes."""
    return f"split({value}, '\"')"


def is_canonical(parts: str) -> str:
    """True where a cut message has the producers' own form: the four members
    in order, a hyphenated identifier, a plain customer id, RFC 3339 time and a
    whole rate. No part then holds a quote or an escape, so the text is one
    JSON document and the parts are its values."""
    keys = {1: "event_id", 5: "customer_id", 9: "timestamp", 13: "heart_rate"}
    checks = [f"size({parts}) = 15", f"{parts}[0] = '{{'"]
    checks += [f"{parts}[{i}] = '{name}'" for i, name in keys.items()]
    checks += [f"{parts}[{i}] IN (': ', ':')" for i in (2, 6, 10)]
    checks += [f"{parts}[{i}] IN (', ', ',')" for i in (4, 8, 12)]
    forms = {3: UUID_HYPHENATED, 7: PLAIN_ID, 11: RFC3339, 14: RATE_END}
    checks += [f"{parts}[{i}] RLIKE r'{form}'" for i, form in forms.items()]
    return " AND ".join(checks)


# Where the fields of a message in that form are.
CANONICAL_TEXT = {"event_id": 3, "customer_id": 7, "timestamp": 11}


def canonical_rate(parts: str) -> str:
    return f"CAST(translate({parts}[14], ': }}', '') AS DOUBLE)"


def kind_of(message: str, field: str) -> str:
    """JSON type of a field: NULL if absent, ``VOID`` if null."""
    return f"schema_of_variant(try_variant_get({message}, '$[0].{field}', 'variant'))"


def is_object(message: str) -> str:
    return f"schema_of_variant(try_variant_get({message}, '$[0]', 'variant')) LIKE 'OBJECT%'"


def text_of(message: str, field: str) -> str:
    return f"try_variant_get({message}, '$[0].{field}', 'string')"


def number_of(message: str, field: str) -> str:
    return f"try_variant_get({message}, '$[0].{field}', 'double')"


def uuid_value(message: str, field: str, text: str) -> str:
    """Lower-case hyphenated form of any accepted spelling, else NULL.

    Only the bare and wrapped spellings need the JSON type: a 32-digit JSON
    number has the same text as a bare identifier but is not one.
    """
    digits = rf"regexp_replace({text}, r'urn:uuid:|[{{}}\-]', '')"
    hyphens = "r'^(.{8})(.{4})(.{4})(.{4})(.{12})\\z', '$1-$2-$3-$4-$5'"
    return f"""CASE
        WHEN {text} RLIKE r'{UUID_HYPHENATED}' THEN lower({text})
        WHEN {text} RLIKE r'{UUID_WRAPPED}' AND {kind_of(message, field)} = 'STRING'
        THEN lower(regexp_replace({digits}, {hyphens})) END"""


def derived_uuid(*parts: str) -> str:
    """A stable version-4-shaped id computed from ``parts``."""
    digest = f"sha2(concat_ws('|', {', '.join(parts)}), 256)"
    shape = "r'^(.{8})(.{4}).(.{3}).(.{3})(.{12}).*\\z', '$1-$2-4$3-8$4-$5'"
    return f"regexp_replace({digest}, {shape})"


def integer_value(message: str, field: str, kind: str, number: str) -> str:
    """Whole number from a JSON number, boolean or numeric text, else NULL."""
    digits = f"translate(regexp_extract({text_of(message, field)}, r'{INTEGER_TEXT}', 1), '_', '')"
    return f"""CASE WHEN {kind} = 'STRING' THEN try_cast({digits} AS BIGINT)
        WHEN {number} = floor({number}) THEN try_cast({number} AS BIGINT) END"""


def timestamp_value(message: str, field: str, text: str) -> str:
    """Instant from ISO text, or from a unix number or numeric text, else NULL.

    The common form is tried first and needs no look at the JSON type. The
    others are bound by a lambda: evaluated only when met, and kept out of the
    generated code of the common path."""
    other = f"""named_struct('kind', {kind_of(message, field)}, 'text', {text},
        'number', try_variant_get({message}, '$[0].{field}', 'decimal(38,10)'))"""
    return f"""CASE
        WHEN {text} RLIKE r'{RFC3339}' THEN try_to_timestamp({text})
        WHEN {message} IS NOT NULL THEN transform(array({other}), o -> CASE
            WHEN o.kind = 'STRING' AND o.text RLIKE r'{UNIX_TEXT}' OR o.kind RLIKE '^(BIGINT|DOUBLE|DECIMAL)'
            THEN {_from_unix('o.number')}
            WHEN o.kind = 'STRING' AND o.text RLIKE r'{ISO_PARTS}' THEN {_from_iso_parts('o.text')} END)[0] END"""


def _from_unix(number: str) -> str:
    unit = f"CASE WHEN abs({number}) > {UNIX_SECONDS_LIMIT} THEN 1000 ELSE 1000000 END"
    micros = f"try_cast(round(try_multiply({number}, {unit})) AS BIGINT)"
    return f"timestamp_micros(CASE WHEN {micros} BETWEEN {MICROS_MIN} AND {MICROS_MAX} THEN {micros} END)"


def _from_iso_parts(text: str) -> str:
    def part(group: int, default: str) -> str:
        return f"coalesce(nullif(regexp_extract({text}, r'{ISO_PARTS}', {group}), ''), '{default}')"

    clock = f"{part(2, '00:00')} || ':' || {part(3, '00')} || '.' || substring({part(4, '0')}, 1, 6)"
    offset = f"(CAST({part(6, '0')} AS BIGINT) * 60 + CAST({part(7, '0')} AS BIGINT)) * 60000000"
    sign = f"CASE WHEN {part(5, '+')} = '+' THEN 1 ELSE -1 END"
    return f"timestamp_micros(unix_micros(try_to_timestamp({part(1, '')} || ' ' || {clock})) - {sign} * {offset})"
