"""Decoded text to the 28 typed fact columns, with defaults for what is missing."""

from __future__ import annotations

from pyspark.sql import DataFrame

from wattloom.functions.jsonvalues import quoted, shown, stands_for_zero
from wattloom.operators.decode import INT_FIELDS, NUMBER_FIELDS, decode
from wattloom.schema import FACT_COLUMNS


def _converted(name: str, type_: str) -> str:
    if type_ == "int":
        return f"coalesce(try_cast({name}_number AS INT), IF({stands_for_zero(name)}, 0, NULL))"
    if type_ == "double":
        return f"coalesce({name}_number, IF({stands_for_zero(name)}, 0D, NULL))"
    if type_ == "timestamp":
        return "date_trunc('MILLISECOND', coalesce(event_ts, current_timestamp()))"
    return f"coalesce(`{name}`, '')"


def with_conversion_error(decoded: DataFrame) -> DataFrame:
    """Adds `conversion_error`: the reject reason of the first field, in column order, that is no number."""
    tests, values = [], []
    for name in NUMBER_FIELDS:
        converted = f"try_cast({name}_number AS INT)" if name in INT_FIELDS else f"{name}_number"
        tests.append(f"WHEN {converted} IS NULL AND NOT {stands_for_zero(name)} THEN '{name}'")
        values.append(f"WHEN '{name}' THEN struct({name} AS value, {quoted(name)} AS quoted)")
    ints = ", ".join(f"'{name}'" for name in INT_FIELDS)
    # The messages that readers of dead letters know.
    complaint = f"""IF(failed IN ({ints}), 'invalid literal for int() with base 10: ',
        'could not convert string to float: ')"""
    return (
        decoded.selectExpr("*", f"CASE {' '.join(tests)} END AS failed")
        .selectExpr("*", f"CASE failed {' '.join(values)} END AS bad")
        .selectExpr("*", f"concat('row_conversion_error:', {complaint}, {shown('bad.value', 'bad.quoted')}) "
                         "AS conversion_error")
        .drop("failed", "bad")
    )


def fact_columns() -> list[str]:
    return [f"{_converted(name, type_)} AS `{name}`" for name, type_ in FACT_COLUMNS]


def conform(decoded: DataFrame, *keep: str) -> DataFrame:
    return decoded.selectExpr(*keep, *fact_columns())


def conform_raw(messages: DataFrame, *keep: str) -> DataFrame:
    """Fact rows of messages known to be valid: (…keep, 28 columns) from a frame with `raw`."""
    return conform(decode(messages), *keep)
