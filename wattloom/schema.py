"""Column names, types and fixed domains of the charging-event data model."""

from __future__ import annotations

# The 28 fact columns, in wire order, with their Spark types.
FACT_COLUMNS: list[tuple[str, str]] = [
    ("event_id", "string"),
    ("event_type", "string"),
    ("timestamp", "timestamp"),
    ("station_id", "string"),
    ("connector_id", "int"),
    ("session_id", "string"),
    ("network_id", "string"),
    ("city", "string"),
    ("country", "string"),
    ("latitude", "double"),
    ("longitude", "double"),
    ("charger_type", "string"),
    ("power_kw", "double"),
    ("energy_kwh", "double"),
    ("soc_percent", "int"),
    ("vehicle_type", "string"),
    ("duration_minutes", "int"),
    ("price_per_kwh", "double"),
    ("revenue_eur", "double"),
    ("status", "string"),
    ("error_code", "string"),
    ("component", "string"),
    ("voltage_v", "double"),
    ("current_a", "double"),
    ("vehicle_brand", "string"),
    ("vehicle_model", "string"),
    ("vehicle_ev_id", "string"),
    ("tariff_id", "string"),
]
FACT_NAMES = [name for name, _ in FACT_COLUMNS]
FACT_DDL = ", ".join(f"`{name}` {kind}" for name, kind in FACT_COLUMNS)

RAW_DDL = "arrival bigint, raw string"

DEAD_LETTER_DDL = (
    "rejected_at timestamp, reason string, event_id string, event_type string, "
    "`timestamp` timestamp, station_id string, raw_event string"
)

# The known event types; the first three belong to a session.
SESSION_EVENT_TYPES = ("session_start", "meter_update", "session_stop")
EVENT_TYPES = SESSION_EVENT_TYPES + ("status_change", "heartbeat", "fault_alert")

START, METER, STOP = SESSION_EVENT_TYPES
STATUS_CHANGE, HEARTBEAT, FAULT = EVENT_TYPES[3:]

# Nominal power range (kW) per charger type.
CHARGER_POWER_BOUNDS = [
    ("AC_LEVEL1", 3.7, 7.4),
    ("AC_LEVEL2", 7.4, 22.0),
    ("DC_FAST", 50.0, 150.0),
    ("DC_ULTRA_FAST", 150.0, 350.0),
]

# Demand multiplier per UTC hour range [start, end).
PEAK_WINDOWS = [(7, 9, 2.0), (12, 14, 1.5), (17, 20, 3.0)]

# Fields of a live session's entry and the event columns they hold, as written by a session start and by a
# meter update.
START_FIELDS = {
    "station_id": "station_id", "network_id": "network_id", "charger_type": "charger_type", "power_kw": "power_kw",
    "start_time": "timestamp", "city": "city", "country": "country", "vehicle_type": "vehicle_type",
    "vehicle_brand": "vehicle_brand", "vehicle_model": "vehicle_model", "soc_start": "soc_percent",
    "price_per_kwh": "price_per_kwh", "tariff_id": "tariff_id",
}
METER_FIELDS = {
    "energy_kwh": "energy_kwh", "soc_current": "soc_percent", "duration_minutes": "duration_minutes",
    "revenue_eur": "revenue_eur", "last_updated": "timestamp",
}

# Time-to-live of live state, in seconds.
SESSION_TTL_S = 3600
STATION_TTL_S = 300
LEADERBOARD_TTL_S = 86400

# Ingest and retention defaults.
MAX_LATENESS_S = 300
BACKFILL_LATENESS_S = 999_999
DEDUP_HORIZON_S = 3600
FACT_RETENTION_DAYS = 90
DEAD_LETTER_RETENTION_DAYS = 30
