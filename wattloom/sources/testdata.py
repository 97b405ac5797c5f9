"""The driver's star-schema test tables seen as charging events and as raw JSON messages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wattloom.functions.joins import dimension_join
from wattloom.schema import FACT_NAMES, RAW_DDL
from wattloom.session import prepare, scratch_path, shuffles_dropped

# Declared so that no job has to open files to learn the types.
TABLE_DDL = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "customer": "c_custkey bigint, c_nationkey int",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "region": "r_regionkey int, r_name string",
}

IN_SESSION = "event_type IN ('session_start', 'meter_update', 'session_stop')"
HAS_ENERGY = "event_type IN ('meter_update', 'session_stop')"
IS_FAULT = "event_type = 'fault_alert'"

FACT_EXPRESSIONS = {
    "event_id": "CAST(event_id AS STRING)",
    "event_type": "event_type",
    "timestamp": "CAST(ts AS TIMESTAMP)",
    "station_id": "concat('NET', CAST(u % 10 AS STRING), '_S', lpad(CAST(u AS STRING), 5, '0'))",
    "connector_id": "CAST(1 + k % 4 AS INT)",
    "session_id": f"IF({IN_SESSION}, concat('SES-', CAST(u AS STRING), '-', CAST(CAST(ts AS DATE) AS STRING)), '')",
    "network_id": "concat('NET', CAST(u % 10 AS STRING))",
    "city": "n_name",
    "country": "r_name",
    "latitude": "CAST(36 + n_nationkey % 6 AS DOUBLE)",
    "longitude": "CAST(26 + n_nationkey % 10 AS DOUBLE)",
    "charger_type": "elt(CAST(1 + u % 4 AS INT), 'AC_LEVEL1', 'AC_LEVEL2', 'DC_FAST', 'DC_ULTRA_FAST')",
    "power_kw": "IF(event_type IN ('session_start', 'meter_update'), CAST(k AS DOUBLE), 0D)",
    "energy_kwh": f"IF({HAS_ENERGY}, value, 0D)",
    "soc_percent": f"IF({IN_SESSION}, k, 0)",
    "vehicle_type": f"IF({IN_SESSION}, IF(u % 4 = 3, 'PHEV', 'BEV'), '')",
    "duration_minutes": f"IF({HAS_ENERGY}, CAST((k * 7) % 150 AS INT), 0)",
    "price_per_kwh": "CAST(65 + 3 * (u % 10) AS DOUBLE) / 100D",
    "revenue_eur": f"""IF({HAS_ENERGY}, CAST(round(CAST(value AS DECIMAL(18,2))
        * CAST(65 + 3 * (u % 10) AS DECIMAL(8,0)) * CAST(0.01 AS DECIMAL(4,2)), 2) AS DOUBLE), 0D)""",
    "status": """CASE event_type WHEN 'fault_alert' THEN 'fault'
        WHEN 'session_start' THEN 'charging' WHEN 'meter_update' THEN 'charging'
        WHEN 'status_change' THEN elt(1 + k % 3, 'available', 'offline', 'reserved') ELSE 'available' END""",
    "error_code": f"IF({IS_FAULT} AND k % 9 <> 8, concat('E00', CAST(1 + k % 9 AS STRING)), '')",
    "component": f"IF({IS_FAULT}, concat('COMP', CAST(k % 8 AS STRING)), '')",
    "voltage_v": "IF(event_type = 'meter_update', 400D, 0D)",
    "current_a": "IF(event_type = 'meter_update', CAST(k AS DOUBLE) * 2.5D, 0D)",
    "vehicle_brand": f"""IF({IN_SESSION},
        elt(CAST(1 + u % 7 AS INT), 'Tesla', 'BMW', 'Kia', 'Audi', 'Volvo', 'Renault', ''), '')""",
    "vehicle_model": f"IF({IN_SESSION}, concat('M', CAST(u % 3 AS STRING)), '')",
    "vehicle_ev_id": f"IF({IN_SESSION}, concat('EV', lpad(CAST(u AS STRING), 15, '0')), '')",
    "tariff_id": f"""IF({IN_SESSION} AND k % 5 <> 4,
        concat('tariff-', CAST(u % 10 AS STRING), '-', CAST(k % 5 AS STRING)), '')""",
}

EVENT_TYPE = """CASE source_type WHEN 'signup' THEN 'session_start' WHEN 'view' THEN 'meter_update'
    WHEN 'purchase' THEN 'session_stop' WHEN 'error' THEN 'fault_alert'
    ELSE IF(k % 2 = 0, 'status_change', 'heartbeat') END AS event_type"""

# One of each defect per hundred events; every 37th event is shown an hour old.
MESSAGE = """IF(m = 83, '{bad json', concat(
    '{"event_id":"', event_id,
    '","event_type":"', IF(m = 13, 'unknown_evt', event_type),
    '","timestamp":"', IF(m = 23, 'not-a-date',
        concat(date_format(shown, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), '+00:00')),
    '","station_id":', IF(m = 3, 'null', concat('"', station_id, '"')),
    ',"session_id":"', IF(m = 33, '', session_id),
    '","network_id":"', network_id, '","city":"', city,
    '","connector_id":"', CAST(connector_id AS STRING),
    '","soc_percent":', CASE m WHEN 43 THEN '150' WHEN 53 THEN '"abc"' ELSE CAST(soc_percent AS STRING) END,
    ',"power_kw":', IF(m = 63, '-1.5', CAST(power_kw AS STRING)),
    ',"energy_kwh":', IF(m = 73, '"n/a"', CAST(energy_kwh AS STRING)),
    ',"duration_minutes":', CAST(duration_minutes AS STRING),
    ',"revenue_eur":', CAST(revenue_eur AS STRING), ',"error_code":null}')) AS raw"""


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLE_DDL[name]).parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _spread(df: DataFrame, scan: DataFrame) -> DataFrame:
    """Rows over all cores when their file is too small to be read by several tasks; a large one stays as stored."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if scan.rdd.getNumPartitions() < cores else df


def charging_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events x customer x nation x region -> the 28 fact columns."""
    prepare(spark)
    events = _table(spark, sf_dir, "events").selectExpr(
        "event_id", "ts", "user_id AS u", "value", "event_type AS source_type",
        "CAST(get_json_object(props, '$.k') AS INT) AS k",
    )
    placed = dimension_join(events, _table(spark, sf_dir, "customer"), "u", "c_custkey")
    placed = dimension_join(placed, _table(spark, sf_dir, "nation"), "c_nationkey", "n_nationkey")
    placed = dimension_join(placed, _table(spark, sf_dir, "region"), "n_regionkey", "r_regionkey")
    return placed.selectExpr("*", EVENT_TYPE).selectExpr(
        *[f"{FACT_EXPRESSIONS[name]} AS {name}" for name in FACT_NAMES]
    )


def raw_event_folder(spark: SparkSession, sf_dir: str) -> str:
    """The same events as JSON text with planted defects, resends and late rows: (arrival, raw).

    Written to the shared folder once, as a log would hold it, so that later plans start from stored text.
    """
    messages = (
        _spread(charging_events(spark, sf_dir), _table(spark, sf_dir, "events"))
        .selectExpr(
            "*", "CAST(event_id AS BIGINT) AS i", "CAST(event_id AS BIGINT) % 100 AS m",
            "IF(CAST(event_id AS BIGINT) % 37 = 5, timestamp - INTERVAL 1 HOUR, timestamp) AS shown",
        )
        .selectExpr("explode(IF(m = 7, array(2 * i, 2 * (i + 5) + 1), array(2 * i))) AS arrival", MESSAGE)
    )
    path = scratch_path(spark, "raw-events")
    with shuffles_dropped(spark):
        messages.write.parquet(path)
    return path


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(RAW_DDL).parquet(raw_event_folder(spark, sf_dir))
