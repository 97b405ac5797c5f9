"""SQL texts that read loosely typed JSON fields: truth, number and timestamp conversion, quoting in messages.

Fields arrive as text, null when absent or JSON null. Whether a field was a JSON string is asked of the message
itself, and only for the few values that read differently with and without quotes. Strings count as numbers and
times only in the spellings listed here.
"""

from __future__ import annotations

# Accepted spellings of integers, floats and ISO-8601 times.
PLAIN_INT = r"^-?\d++$"
PLAIN_FLOAT = r"^-?\d++(\.\d++)?$"
INT_TEXT = r"^\s*[+-]?\d+(_\d+)*\s*$"
FLOAT_TEXT = r"(?i)^\s*[+-]?(inf(inity)?|nan|(\d+(_\d+)*(\.(\d+(_\d+)*)?)?|\.\d+(_\d+)*)(e[+-]?\d+)?)\s*$"
DATE_TEXT = r"^\d{4}-\d{2}-\d{2}$"
TIME_TEXT = r"^\d{4}-\d{2}-\d{2}.\d{2}(:\d{2}(:\d{2}([.,]\d+)?)?)?([+-]\d{2}(:?\d{2}(:?\d{2})?)?)?$"
BASIC_TEXT = r"^\d{8}(.\d{6}([.,]\d+)?([+-]\d{2}(:?\d{2})?)?)?$"


def bare_text(field: str) -> str:
    """Text of a number field; bare NaN and infinities come out of the JSON reader in quotes."""
    return f"""IF(`{field}` IN ('"NaN"', '"Infinity"', '"-Infinity"'), replace(`{field}`, '"', ''), `{field}`)"""


def quoted(field: str) -> str:
    """Whether a field of the message `raw` is a JSON string. Parses the message: for rare cases only."""
    return f"coalesce(schema_of_variant(try_variant_get(try_parse_json(raw), '$.{field}', 'variant')) = 'STRING', false)"


def is_empty(field: str) -> str:
    """Absent, null, '', 0, false, [] or {}."""
    bare = f"`{field}` IN ('false', '[]', '{{}}') OR `{field}` RLIKE r'^-?0++(\\.0*+)?(e.*)?$'"
    return f"(`{field}` IS NULL OR `{field}` = '' OR (({bare}) AND NOT {quoted(field)}))"


def shown(value: str, is_quoted: str) -> str:
    """A value as quoted in a reject reason: strings in quotes, everything else as written."""
    escaped = f"replace({value}, '\\\\', '\\\\\\\\')"
    return f"""CASE WHEN NOT {is_quoted} THEN {value}
        WHEN contains({value}, "'") AND NOT contains({value}, '"') THEN concat('"', {escaped}, '"')
        ELSE concat("'", replace({escaped}, "'", "\\\\'"), "'") END"""


def shown_field(field: str) -> str:
    return shown(f"`{field}`", quoted(field))


def _spelled(field: str, spelling: str) -> str:
    return f"IF(`{field}` RLIKE r'{spelling}', try_cast(replace(`{field}`, '_', '') AS DOUBLE), NULL)"


def _bare_truth(field: str, otherwise: str) -> str:
    return f"""CASE WHEN `{field}` IN ('true', 'false') THEN IF({quoted(field)}, NULL, IF(`{field}` = 'true', 1D, 0D))
        ELSE {otherwise} END"""


def as_double(field: str) -> str:
    """Number of a field; null when it is absent or none."""
    return f"""CASE WHEN `{field}` IS NULL THEN NULL
        WHEN `{field}` RLIKE r'{PLAIN_FLOAT}' THEN CAST(`{field}` AS DOUBLE)
        ELSE {_bare_truth(field, _spelled(field, FLOAT_TEXT))} END"""


def as_whole(field: str) -> str:
    """Number of a field where an integer is wanted: strings must be integers, JSON floats are left to be cut."""
    loose = f"IF({quoted(field)}, {_spelled(field, INT_TEXT)}, {_spelled(field, FLOAT_TEXT)})"
    return f"""CASE WHEN `{field}` IS NULL THEN NULL
        WHEN `{field}` RLIKE r'{PLAIN_INT}' THEN CAST(`{field}` AS DOUBLE)
        ELSE {_bare_truth(field, loose)} END"""


def stands_for_zero(field: str) -> str:
    """Empty values that mean 0 though they are no number."""
    return f"(`{field}` IS NULL OR `{field}` = '' OR (`{field}` IN ('[]', '{{}}') AND NOT {quoted(field)}))"


def parsed_time(value: str) -> str:
    """ISO-8601 text to a timestamp, naive times being UTC; null when it is not ISO-8601."""
    z = f"replace({value}, 'Z', '+00:00')"
    return f"""CASE
        WHEN {z} RLIKE r'{TIME_TEXT}'
          THEN try_cast(concat(left({z}, 10), 'T', replace(substr({z}, 12), ',', '.')) AS TIMESTAMP)
        WHEN {z} RLIKE r'{DATE_TEXT}' THEN try_cast({z} AS TIMESTAMP)
        WHEN {z} RLIKE r'{BASIC_TEXT}' THEN try_cast(concat(
          left({z}, 4), '-', substr({z}, 5, 2), '-', substr({z}, 7, 2),
          IF(length({z}) > 8, concat('T', substr({z}, 10, 2), ':', substr({z}, 12, 2), ':',
            replace(substr({z}, 14), ',', '.')), '')) AS TIMESTAMP) END"""
