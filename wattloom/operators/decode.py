"""JSON text to flat columns: every field as text, number fields also as numbers, the event time."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from wattloom.functions.jsonvalues import as_double, as_whole, bare_text, parsed_time
from wattloom.schema import FACT_COLUMNS, FACT_NAMES

INT_FIELDS = [name for name, type_ in FACT_COLUMNS if type_ == "int"]
NUMBER_FIELDS = [name for name, type_ in FACT_COLUMNS if type_ in ("int", "double")]

# A message is parsed as the only element of a list: text after it, or a second message, shows as an error or a second
# element, while the parser by itself would stop after the first.
_JSON_DDL = f"array<struct<{', '.join(f'`{name}`: string' for name in FACT_NAMES)}>>"
_OPTIONS = {"mode": "PERMISSIVE", "allowNonNumericNumbers": "true", "allowSingleQuotes": "false"}

_NOT_AN_OBJECT = "NOT (startswith(trim(raw), '{') AND endswith(trim(raw), '}'))"
_DECODE_REASON = f"""CASE
    WHEN {_NOT_AN_OBJECT} AND NOT startswith(trim(raw), '{{') AND try_parse_json(raw) IS NOT NULL
      THEN 'json_decode_error:not_object'
    WHEN raw IS NULL OR {_NOT_AN_OBJECT} OR _one IS NOT TRUE THEN 'json_decode_error:malformed' END"""


def evaluate_once(df: DataFrame) -> DataFrame:
    """The same rows behind a generator. Catalyst rewrites a filter in terms of the expressions below it, which
    would parse a message anew for every use of a field; it does not do so across a generator."""
    return df.select(F.inline(F.array(F.struct(*df.columns))))


def decode(raw: DataFrame) -> DataFrame:
    """Adds `decode_reason`, the 28 fields as text, `<field>_number` for the numbers, and `event_ts`."""
    listed = F.from_json(F.concat(F.lit("["), "raw", F.lit("]")), _JSON_DDL, _OPTIONS)
    parsed = raw.select("*", F.inline(F.array(F.struct(listed.alias("_listed")))))
    parsed = parsed.select(
        *raw.columns, F.expr("size(_listed) = 1 AND _listed[0] IS NOT NULL").alias("_one"),
        F.inline(F.expr(f"IF(size(_listed) = 1, _listed, CAST(array(NULL) AS {_JSON_DDL}))")))
    texts = parsed.selectExpr(
        *raw.columns,
        f"{_DECODE_REASON} AS decode_reason",
        *[f"{bare_text(name)} AS `{name}`" if name in NUMBER_FIELDS else f"`{name}`" for name in FACT_NAMES],
    )
    return texts.selectExpr(
        "*",
        *[f"{as_whole(name) if name in INT_FIELDS else as_double(name)} AS {name}_number" for name in NUMBER_FIELDS],
        f"{parsed_time('`timestamp`')} AS event_ts",
    )
