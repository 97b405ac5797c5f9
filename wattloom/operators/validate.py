"""Schema rules. The first rule a message breaks gives its reject reason, `<rule>:<value>`."""

from __future__ import annotations

from pyspark.sql import DataFrame

from wattloom.functions.jsonvalues import is_empty, shown_field
from wattloom.operators.decode import decode, evaluate_once
from wattloom.schema import EVENT_TYPES, SESSION_EVENT_TYPES

# Fields no message may lack, in the order they are tested.
REQUIRED_FIELDS = ("event_id", "event_type", "timestamp", "station_id")


def _quoted(names: tuple[str, ...]) -> str:
    return ", ".join(f"'{name}'" for name in names)


def missing_field_rule() -> str:
    tests = " ".join(f"WHEN {is_empty(f'{name}')} THEN 'missing_field:{name}'" for name in REQUIRED_FIELDS)
    return f"CASE {tests} END"


def event_type_rule() -> str:
    return f"IF(event_type IN ({_quoted(EVENT_TYPES)}), NULL, concat('invalid_event_type:', event_type))"


def timestamp_rule() -> str:
    return f"IF(event_ts IS NULL, concat('invalid_timestamp:', {shown_field('timestamp')}), NULL)"


def session_id_rule() -> str:
    return f"""IF(event_type IN ({_quoted(SESSION_EVENT_TYPES)}) AND {is_empty('session_id')},
        'missing_field:session_id', NULL)"""


def soc_rule() -> str:
    """Cut toward zero before the range test, so anything above -1 and below 101 is in range."""
    return f"""CASE WHEN (soc_percent_number > -1 AND soc_percent_number < 101) OR soc_percent IS NULL THEN NULL
        WHEN soc_percent_number IS NULL OR isnan(soc_percent_number) OR abs(soc_percent_number) = double('infinity')
          THEN concat('invalid_soc_type:', {shown_field('soc_percent')})
        ELSE concat('soc_out_of_range:', soc_percent) END"""


def non_negative_rule(field: str) -> str:
    return f"""CASE WHEN {field}_number >= 0 OR {field} IS NULL THEN NULL
        WHEN {field}_number IS NULL THEN concat('invalid_{field}_type:', {shown_field(field)})
        ELSE concat('negative_{field}:', {field}) END"""


RULES = {
    "missing_field": missing_field_rule(),
    "event_type": event_type_rule(),
    "timestamp": timestamp_rule(),
    "session_id": session_id_rule(),
    "soc": soc_rule(),
    "power": non_negative_rule("power_kw"),
    "energy": non_negative_rule("energy_kwh"),
}


def validate(decoded: DataFrame) -> DataFrame:
    """Adds `reason`; a null reason means valid. To filter by it directly, use `valid_only`."""
    first_broken = ", ".join(f"({rule})" for rule in RULES.values())
    return decoded.selectExpr("*", f"coalesce(decode_reason, {first_broken}) AS reason")


def valid_only(decoded: DataFrame) -> DataFrame:
    return evaluate_once(validate(decoded)).filter("reason IS NULL")


def apply_rule(raw: DataFrame, rule: str) -> DataFrame:
    """One rule alone over the messages that decode: (arrival, reason) of those breaking it."""
    tested = decode(raw).selectExpr("arrival", "decode_reason", f"{RULES[rule]} AS reason")
    return evaluate_once(tested).filter("decode_reason IS NULL AND reason IS NOT NULL").select("arrival", "reason")
