"""ANSI SQL for every registered query, written independently of the DataFrame code, for a second engine.

Every text starts from the test tables; `ce` is the charging-event view of them, `raw_events` the JSON messages.
"""

from __future__ import annotations

EVENTS_CTE = """
src AS (
  SELECT event_id, ts, user_id AS u, event_type AS et, value,
         CAST(json_extract_string(props, '$.k') AS INT) AS k
  FROM events),
src_typed AS (
  SELECT *, CASE et WHEN 'signup' THEN 'session_start' WHEN 'view' THEN 'meter_update'
                    WHEN 'purchase' THEN 'session_stop' WHEN 'error' THEN 'fault_alert'
                    ELSE CASE WHEN k % 2 = 0 THEN 'status_change' ELSE 'heartbeat' END END AS event_type
  FROM src),
src_flags AS (
  SELECT *, event_type IN ('session_start', 'meter_update', 'session_stop') AS is_sess,
         event_type IN ('meter_update', 'session_stop') AS is_energy
  FROM src_typed),
ce AS (
  SELECT
    CAST(event_id AS VARCHAR) AS event_id,
    event_type,
    ts AS timestamp,
    concat('NET', CAST(u % 10 AS VARCHAR), '_S', lpad(CAST(u AS VARCHAR), 5, '0')) AS station_id,
    CAST(1 + k % 4 AS INT) AS connector_id,
    CASE WHEN is_sess THEN concat('SES-', CAST(u AS VARCHAR), '-', CAST(CAST(ts AS DATE) AS VARCHAR)) ELSE '' END
      AS session_id,
    concat('NET', CAST(u % 10 AS VARCHAR)) AS network_id,
    n_name AS city,
    r_name AS country,
    CAST(36 + n_nationkey % 6 AS DOUBLE) AS latitude,
    CAST(26 + n_nationkey % 10 AS DOUBLE) AS longitude,
    CASE u % 4 WHEN 0 THEN 'AC_LEVEL1' WHEN 1 THEN 'AC_LEVEL2' WHEN 2 THEN 'DC_FAST' ELSE 'DC_ULTRA_FAST' END
      AS charger_type,
    CASE WHEN event_type IN ('session_start', 'meter_update') THEN CAST(k AS DOUBLE) ELSE CAST(0 AS DOUBLE) END
      AS power_kw,
    CASE WHEN is_energy THEN value ELSE CAST(0 AS DOUBLE) END AS energy_kwh,
    CASE WHEN is_sess THEN k ELSE 0 END AS soc_percent,
    CASE WHEN is_sess THEN CASE WHEN u % 4 = 3 THEN 'PHEV' ELSE 'BEV' END ELSE '' END AS vehicle_type,
    CASE WHEN is_energy THEN CAST((k * 7) % 150 AS INT) ELSE 0 END AS duration_minutes,
    CAST(65 + 3 * (u % 10) AS DOUBLE) / CAST(100 AS DOUBLE) AS price_per_kwh,
    CASE WHEN is_energy THEN CAST(ROUND(CAST(value AS DECIMAL(18,2))
          * CAST(65 + 3 * (u % 10) AS DECIMAL(8,0)) * CAST(0.01 AS DECIMAL(4,2)), 2) AS DOUBLE)
         ELSE CAST(0 AS DOUBLE) END AS revenue_eur,
    CASE event_type WHEN 'fault_alert' THEN 'fault' WHEN 'session_start' THEN 'charging'
         WHEN 'meter_update' THEN 'charging'
         WHEN 'status_change' THEN CASE k % 3 WHEN 0 THEN 'available' WHEN 1 THEN 'offline' ELSE 'reserved' END
         ELSE 'available' END AS status,
    CASE WHEN event_type = 'fault_alert' AND k % 9 <> 8 THEN concat('E00', CAST(1 + k % 9 AS VARCHAR)) ELSE '' END
      AS error_code,
    CASE WHEN event_type = 'fault_alert' THEN concat('COMP', CAST(k % 8 AS VARCHAR)) ELSE '' END AS component,
    CASE WHEN event_type = 'meter_update' THEN CAST(400 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS voltage_v,
    CASE WHEN event_type = 'meter_update' THEN CAST(k AS DOUBLE) * CAST(2.5 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END
      AS current_a,
    CASE WHEN is_sess THEN CASE u % 7 WHEN 0 THEN 'Tesla' WHEN 1 THEN 'BMW' WHEN 2 THEN 'Kia' WHEN 3 THEN 'Audi'
         WHEN 4 THEN 'Volvo' WHEN 5 THEN 'Renault' ELSE '' END ELSE '' END AS vehicle_brand,
    CASE WHEN is_sess THEN concat('M', CAST(u % 3 AS VARCHAR)) ELSE '' END AS vehicle_model,
    CASE WHEN is_sess THEN concat('EV', lpad(CAST(u AS VARCHAR), 15, '0')) ELSE '' END AS vehicle_ev_id,
    CASE WHEN is_sess AND k % 5 <> 4
         THEN concat('tariff-', CAST(u % 10 AS VARCHAR), '-', CAST(k % 5 AS VARCHAR)) ELSE '' END AS tariff_id
  FROM src_flags
  JOIN customer ON c_custkey = u
  JOIN nation ON n_nationkey = c_nationkey
  JOIN region ON r_regionkey = n_regionkey)
"""

STOPS = "event_type = 'session_stop'"
TIMED_STOPS = "event_type = 'session_stop' AND duration_minutes > 0"
AS_OF = "(SELECT max(timestamp) FROM ce)"
POWER = "energy_kwh / nullif(duration_minutes / CAST(60 AS DOUBLE), 0)"


def rnd(expression: str, digits: int) -> str:
    return f"CAST(ROUND(CAST({expression} AS DECIMAL(28,10)), {digits}) AS DOUBLE)"


def rsum(column: str, digits: int = 2) -> str:
    return rnd(f"sum({column})", digits)


def ravg(column: str, digits: int = 2) -> str:
    return rnd(f"avg({column})", digits)


def on_events(body: str, *ctes: str) -> str:
    return "WITH " + ",\n".join([EVENTS_CTE.strip(), *[c.strip() for c in ctes]]) + "\n" + body.strip()


AVG_POWER = ravg(POWER, 1)

Q1 = f"""
SELECT network_id, count(*) AS session_count, {rsum('revenue_eur')} AS total_revenue_eur,
       {rsum('energy_kwh')} AS total_energy_kwh, {ravg('duration_minutes', 1)} AS avg_duration_min,
       {ravg('revenue_eur')} AS avg_revenue_per_session
FROM ce WHERE {STOPS} AND timestamp >= {AS_OF} - INTERVAL %s DAY
GROUP BY network_id"""

Q2 = f"""
SELECT date_trunc('hour', timestamp) AS hour, count(*) AS session_count, {rsum('energy_kwh')} AS total_energy_kwh,
       {rsum('revenue_eur')} AS total_revenue_eur, {AVG_POWER} AS avg_power_kw
FROM ce WHERE {TIMED_STOPS} AND timestamp >= {AS_OF} - INTERVAL %s HOUR
GROUP BY 1"""

Q4 = f"""
SELECT city, country, count(*) AS session_count, {rsum('energy_kwh')} AS total_energy_kwh,
       {rsum('revenue_eur')} AS total_revenue_eur, count(DISTINCT station_id) AS unique_stations
FROM ce WHERE {STOPS} GROUP BY city, country ORDER BY total_energy_kwh DESC, city, country LIMIT %s"""

Q5 = f"""
SELECT error_code, count(*) AS occurrences, count(DISTINCT station_id) AS affected_stations,
       count(DISTINCT network_id) AS affected_networks,
       {rnd("CAST(100 AS DOUBLE) * count(*) / (SELECT count(*) FROM ce WHERE event_type = 'fault_alert')", 2)}
         AS pct_of_errors
FROM ce WHERE event_type = 'fault_alert' AND error_code <> '' GROUP BY error_code"""

Q7 = f"""
SELECT CAST(5 AS INT) AS period_minutes, count(*) AS event_count, count(DISTINCT session_id) AS unique_sessions,
       count(DISTINCT station_id) AS active_stations, coalesce({rsum('revenue_eur')}, 0) AS revenue_eur,
       coalesce({rsum('energy_kwh')}, 0) AS energy_kwh, {rnd('count(*) / CAST(300 AS DOUBLE)', 1)} AS events_per_second
FROM ce WHERE timestamp >= {AS_OF} - INTERVAL 5 MINUTE"""

Q9 = f"""
SELECT CAST(hour(timestamp) AS INT) AS hour_of_day, count(*) AS session_count, {ravg('energy_kwh')} AS avg_energy_kwh,
       {AVG_POWER} AS avg_power_kw, {rsum('revenue_eur')} AS total_revenue_eur
FROM ce WHERE {TIMED_STOPS} GROUP BY 1"""

Q13 = f"""
SELECT vehicle_brand, count(*) AS session_count, {ravg('energy_kwh')} AS avg_energy_kwh,
       {rsum('energy_kwh')} AS total_energy_kwh, {ravg('duration_minutes', 1)} AS avg_duration_min,
       {rsum('revenue_eur')} AS total_revenue_eur
FROM ce WHERE {STOPS} AND vehicle_brand <> '' GROUP BY vehicle_brand
ORDER BY total_energy_kwh DESC, vehicle_brand LIMIT %s"""

Q14 = f"""
SELECT tariff_id, count(*) AS session_count, {ravg('revenue_eur')} AS avg_revenue_per_session,
       {rsum('revenue_eur')} AS total_revenue_eur, {ravg('energy_kwh')} AS avg_energy_kwh,
       {ravg('price_per_kwh', 4)} AS avg_price_per_kwh
FROM ce WHERE {STOPS} AND tariff_id <> '' GROUP BY tariff_id
ORDER BY total_revenue_eur DESC, tariff_id LIMIT %s"""

HOURLY = f"""
SELECT date_trunc('hour', timestamp) AS hour, network_id, city, country, charger_type, count(*) AS session_count,
       {{energy}} AS total_energy_kwh, {{revenue}} AS total_revenue_eur,
       CAST(sum(duration_minutes) AS BIGINT) AS total_duration_minutes, {{power}} AS sum_power_kw
FROM ce WHERE {STOPS} GROUP BY 1, 2, 3, 4, 5"""
HOURLY_EXACT = HOURLY.format(energy="sum(energy_kwh)", revenue="sum(revenue_eur)", power="sum(power_kw)")
HOURLY_ROUNDED = HOURLY.format(energy=rsum("energy_kwh"), revenue=rsum("revenue_eur"), power=rsum("power_kw"))

A1_CTES = (
    f"m1 AS ({HOURLY_EXACT})",
    f"""
h AS (SELECT hour, CAST(sum(session_count) AS BIGINT) AS session_count, {rsum('total_energy_kwh')} AS total_energy_kwh,
             {rsum('total_revenue_eur')} AS total_revenue_eur
      FROM m1 WHERE hour >= {AS_OF} - INTERVAL 7 DAY GROUP BY hour)""",
    """
a1 AS (SELECT h.*, CASE WHEN total_energy_kwh = (SELECT max(total_energy_kwh) FROM h) THEN 'PEAK'
                        WHEN total_energy_kwh = (SELECT min(total_energy_kwh) FROM h) THEN 'LOW'
                        ELSE '' END AS label FROM h)""",
)

A2 = f"""
SELECT station_id, network_id, city, session_starts, fault_events, total_events,
       {rnd('CAST(100 AS DOUBLE) * fault_events / total_events', 3)} AS fault_rate_pct,
       {rnd('CAST(100 AS DOUBLE) * session_starts / nullif(session_starts + fault_events, 0)', 1)} AS uptime_pct
FROM (SELECT station_id, network_id, city,
             count(*) FILTER (WHERE event_type = 'session_start') AS session_starts,
             count(*) FILTER (WHERE event_type = 'fault_alert') AS fault_events,
             count(*) AS total_events
      FROM ce GROUP BY station_id, network_id, city)
WHERE fault_events > 0
ORDER BY fault_rate_pct DESC, station_id, network_id, city LIMIT 20"""

A3 = f"""
SELECT CASE WHEN vehicle_brand = 'Tesla' THEN 'Tesla' ELSE 'Other Brands' END AS brand_group,
       count(*) AS session_count, {ravg('duration_minutes', 1)} AS avg_duration_min,
       {ravg('energy_kwh')} AS avg_energy_kwh, {AVG_POWER} AS avg_power_kw, {rsum('energy_kwh')} AS total_energy_kwh,
       {rsum('revenue_eur')} AS total_revenue_eur, {ravg('revenue_eur')} AS avg_revenue_per_session
FROM ce WHERE {TIMED_STOPS} AND vehicle_brand <> '' GROUP BY 1"""

A4_CTES = (
    """
periods AS (SELECT * FROM (VALUES ('Morning Peak (07-09)', 1), ('Evening Peak (17-20)', 2), ('Off-Peak', 3))
            AS t(period, sort_order))""",
    f"""
actuals AS (SELECT CASE WHEN hour(timestamp) IN (7, 8) THEN 'Morning Peak (07-09)'
                        WHEN hour(timestamp) IN (17, 18, 19) THEN 'Evening Peak (17-20)' ELSE 'Off-Peak' END AS period,
                   count(*) AS session_count, {rsum('revenue_eur')} AS total_revenue_eur,
                   {rsum('energy_kwh')} AS total_energy_kwh, {ravg('energy_kwh')} AS avg_energy_kwh,
                   {ravg('revenue_eur')} AS avg_revenue_per_session
            FROM ce WHERE {STOPS} GROUP BY 1)""",
    """
filled AS (SELECT p.period, coalesce(session_count, 0) AS session_count,
                  coalesce(total_revenue_eur, 0) AS total_revenue_eur, coalesce(total_energy_kwh, 0) AS total_energy_kwh,
                  coalesce(avg_energy_kwh, 0) AS avg_energy_kwh,
                  coalesce(avg_revenue_per_session, 0) AS avg_revenue_per_session
           FROM periods p LEFT JOIN actuals a ON p.period = a.period)""",
    f"""
a4 AS (SELECT filled.*, {rnd('''total_revenue_eur / coalesce(nullif((SELECT sum(total_revenue_eur) FROM filled), 0), 1)
         * CAST(100 AS DOUBLE)''', 1)} AS revenue_pct FROM filled)""",
)

A5 = f"""
SELECT city, country, count(*) AS fault_count, count(DISTINCT station_id) AS affected_stations,
       count(DISTINCT error_code) AS distinct_error_types,
       {rnd("CAST(100 AS DOUBLE) * count(*) / (SELECT count(*) FROM ce WHERE event_type = 'fault_alert')", 2)}
         AS pct_of_all_faults,
       {rnd('CAST(count(*) AS DOUBLE) / nullif(count(DISTINCT station_id), 0)', 2)} AS faults_per_station
FROM ce WHERE event_type = 'fault_alert' GROUP BY city, country
ORDER BY fault_count DESC, city, country LIMIT 20"""

A6_CTES = (
    f"sessions AS (SELECT *, {rnd(POWER, 2)} AS p FROM ce WHERE {TIMED_STOPS})",
    "stats AS (SELECT avg(p) AS mean_power, stddev_pop(p) AS std_power FROM sessions)",
    f"""
scored AS (SELECT session_id, station_id, network_id, city, vehicle_brand, p AS power_kw,
                  {rnd('energy_kwh', 2)} AS energy_kwh, duration_minutes, {rnd('revenue_eur', 2)} AS revenue_eur,
                  {rnd('mean_power', 2)} AS fleet_mean_power, {rnd('std_power', 2)} AS fleet_std_power,
                  {rnd('(p - mean_power) / nullif(std_power, 0)', 2)} AS z_score, event_id
           FROM sessions CROSS JOIN stats WHERE abs(p - mean_power) > 2 * std_power)""",
)
A6 = "SELECT * EXCLUDE (event_id) FROM scored ORDER BY abs(z_score) DESC, event_id LIMIT %s"


def analytics_sql() -> dict[str, str]:
    return {
        "q1_revenue_by_network": on_events(Q1 % 7),
        "q2_sessions_per_hour": on_events(Q2 % 24),
        "q3_charger_utilization": on_events(f"""
            SELECT charger_type, count(*) AS session_count, {ravg('duration_minutes', 1)} AS avg_duration_min,
                   {AVG_POWER} AS avg_power_kw, {ravg('energy_kwh')} AS avg_energy_kwh,
                   {rsum('revenue_eur')} AS total_revenue_eur, {ravg('revenue_eur')} AS avg_revenue_per_session
            FROM ce WHERE {TIMED_STOPS} GROUP BY charger_type"""),
        "q4_top_cities_by_energy": on_events(Q4 % 10),
        "q5_error_analysis": on_events(Q5),
        "q6_vehicle_type_breakdown": on_events(f"""
            SELECT vehicle_type, count(*) AS session_count, {ravg('energy_kwh')} AS avg_energy_kwh,
                   {ravg('duration_minutes', 1)} AS avg_duration_min, {rsum('revenue_eur')} AS total_revenue_eur,
                   {AVG_POWER} AS avg_power_kw
            FROM ce WHERE {TIMED_STOPS} GROUP BY vehicle_type"""),
        "q7_real_time_throughput": on_events(Q7),
        "q8_session_duration_distribution": on_events(f"""
            SELECT CASE WHEN duration_minutes < 15 THEN '< 15 min' WHEN duration_minutes < 30 THEN '15–30 min'
                        WHEN duration_minutes < 60 THEN '30–60 min' WHEN duration_minutes < 120 THEN '1–2 hours'
                        ELSE '>= 2 hours' END AS bucket,
                   count(*) AS sessions, {ravg('energy_kwh')} AS avg_energy_kwh, {ravg('revenue_eur')} AS avg_revenue_eur
            FROM ce WHERE {STOPS} GROUP BY 1"""),
        "q9_peak_hours": on_events(Q9),
        "q10_network_error_rate": on_events(f"""
            SELECT network_id, count(*) FILTER (WHERE event_type = 'fault_alert') AS error_count,
                   count(*) AS total_events,
                   {rnd("CAST(100 AS DOUBLE) * count(*) FILTER (WHERE event_type = 'fault_alert') / count(*)", 3)}
                     AS error_rate_pct
            FROM ce GROUP BY network_id"""),
        "q11_revenue_per_kwh": on_events(f"""
            SELECT charger_type, {rnd('sum(revenue_eur) / nullif(sum(energy_kwh), 0)', 4)} AS revenue_per_kwh,
                   {ravg('price_per_kwh', 4)} AS avg_listed_price, count(*) AS session_count
            FROM ce WHERE {STOPS} AND energy_kwh > 0 GROUP BY charger_type"""),
        "q12_country_summary": on_events(f"""
            SELECT country, count(*) AS session_count, count(DISTINCT station_id) AS station_count,
                   {rsum('energy_kwh')} AS total_energy_kwh, {rsum('revenue_eur')} AS total_revenue_eur,
                   {ravg('duration_minutes', 1)} AS avg_session_min
            FROM ce WHERE {STOPS} GROUP BY country"""),
        "q13_vehicle_brand_breakdown": on_events(Q13 % 20),
        "q14_tariff_analysis": on_events(Q14 % 20),
        "a1_hourly_energy_7days": on_events("SELECT * FROM a1", *A1_CTES),
        "a2_station_uptime": on_events(A2),
        "a3_brand_comparison": on_events(A3),
        "a4_peak_hour_revenue": on_events("SELECT * FROM a4", *A4_CTES),
        "a5_fault_geography": on_events(A5),
        "a6_anomaly_detection": on_events(A6 % 20, *A6_CTES),
        "u1_total_events": on_events("SELECT count(*) AS total FROM ce"),
    }


def rollup_sql() -> dict[str, str]:
    members = "event_type = 'fault_alert' AND error_code <> ''"
    return {
        "m1_sessions_hourly": on_events(HOURLY_ROUNDED),
        "m2_station_daily": on_events(f"""
            SELECT CAST(timestamp AS DATE) AS day, station_id, network_id, city, country, charger_type,
                   count(*) AS session_count, {rsum('energy_kwh')} AS total_energy_kwh,
                   {rsum('revenue_eur')} AS total_revenue_eur,
                   CAST(sum(duration_minutes) AS BIGINT) AS total_duration_minutes
            FROM ce WHERE {STOPS} GROUP BY 1, 2, 3, 4, 5, 6"""),
        "m3_errors_daily": on_events(f"""
            SELECT CAST(timestamp AS DATE) AS day, error_code, network_id, count(*) AS error_count,
                   count(DISTINCT station_id) AS affected_stations
            FROM ce WHERE {members} GROUP BY 1, 2, 3"""),
        "m4_network_revenue_daily": on_events(f"""
            SELECT CAST(timestamp AS DATE) AS day, network_id, count(*) AS session_count,
                   {rsum('revenue_eur')} AS total_revenue_eur, {rsum('energy_kwh')} AS total_energy_kwh
            FROM ce WHERE {STOPS} GROUP BY 1, 2"""),
        "m5_rollup_reaggregate": on_events(f"""
            SELECT date_trunc('hour', timestamp) AS hour, count(*) AS session_count,
                   {rsum('energy_kwh')} AS total_energy_kwh, {rsum('revenue_eur')} AS total_revenue_eur,
                   CAST(sum(duration_minutes) AS BIGINT) AS total_duration_minutes, {rsum('power_kw')} AS sum_power_kw
            FROM ce WHERE {STOPS} GROUP BY 1"""),
    }


FAULTS = "event_type = 'fault_alert'"
CITY = "coalesce(nullif(city, ''), 'unknown')"
CODE = "coalesce(nullif(error_code, ''), 'UNKNOWN')"
ACTIVE = """CAST(coalesce(sum(CASE WHEN event_type = 'session_start' AND session_id <> '' THEN 1
                              WHEN event_type = 'session_stop' THEN -1 END), 0) AS BIGINT)"""


def _leaderboard(member: str, alias: str) -> str:
    return f"""
SELECT CAST(timestamp AS DATE) AS day, {member} AS {alias}, {rsum('revenue_eur')} AS revenue_eur
FROM ce WHERE {STOPS} AND revenue_eur > 0 GROUP BY 1, 2"""


# Status writes in order, a new segment after a gap of 300 s, the last value of each field within the segment.
STATION_CTES = (
    f"""
writes AS (SELECT station_id, timestamp, event_id,
             CASE event_type WHEN 'session_start' THEN 'charging' WHEN 'session_stop' THEN 'available'
                  WHEN 'fault_alert' THEN 'fault' ELSE coalesce(nullif(status, ''), 'unknown') END AS new_status,
             CASE event_type WHEN 'session_start' THEN session_id WHEN 'session_stop' THEN '' END AS new_session,
             CASE event_type WHEN 'fault_alert' THEN {CODE} END AS new_error
           FROM ce WHERE event_type IN ('session_stop', 'status_change', 'fault_alert')
              OR (event_type = 'session_start' AND session_id <> ''))""",
    """
marked AS (SELECT *, CASE WHEN timestamp >= lag(timestamp) OVER w + INTERVAL 300 SECOND THEN 1 ELSE 0 END AS is_new
           FROM writes WINDOW w AS (PARTITION BY station_id ORDER BY timestamp, event_id))""",
    """
segments AS (SELECT *, sum(is_new) OVER (PARTITION BY station_id ORDER BY timestamp, event_id
                                         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS segment FROM marked)""",
    f"""
station_state AS (
  SELECT station_id, min(timestamp) AS segment_start, max(timestamp) AS last_updated,
         arg_max(new_status, (timestamp, event_id)) AS status,
         arg_max(new_session, (timestamp, event_id)) FILTER (WHERE new_session IS NOT NULL) AS session_id,
         arg_max(new_error, (timestamp, event_id)) FILTER (WHERE new_error IS NOT NULL) AS error_code,
         max(timestamp) > {AS_OF} - INTERVAL 300 SECOND AS is_live
  FROM segments GROUP BY station_id, segment)""",
)

# Events after the last stop; an entry generation ends where an event finds it expired.
SESSION_CTES = (
    """
sess AS (SELECT * FROM ce WHERE session_id <> '' AND event_type IN ('session_start', 'meter_update', 'session_stop'))""",
    """
numbered AS (SELECT *, row_number() OVER (PARTITION BY session_id ORDER BY timestamp, event_id) AS rn FROM sess)""",
    """
last_stops AS (SELECT session_id, max(rn) AS stop_rn FROM numbered WHERE event_type = 'session_stop' GROUP BY 1)""",
    """
open_events AS (SELECT n.* FROM numbered n LEFT JOIN last_stops l ON n.session_id = l.session_id
                WHERE l.stop_rn IS NULL OR n.rn > l.stop_rn)""",
    """
seen_before AS (SELECT *,
    max(CASE WHEN event_type = 'session_start' THEN timestamp END) OVER w AS prev_start,
    max(CASE WHEN event_type = 'meter_update' THEN timestamp END) OVER w AS prev_meter
  FROM open_events WINDOW w AS (PARTITION BY session_id ORDER BY rn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))""",
    """
generations AS (SELECT *, sum(CASE WHEN timestamp >= prev_start + INTERVAL 3600 SECOND
      AND (prev_meter IS NULL OR prev_meter < prev_start + INTERVAL 3600 SECOND) THEN 1 ELSE 0 END)
    OVER (PARTITION BY session_id ORDER BY rn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS generation
  FROM seen_before)""",
    """
newest AS (SELECT * FROM generations g WHERE generation =
             (SELECT max(generation) FROM generations h WHERE h.session_id = g.session_id))""",
    """
entry_starts AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY session_id ORDER BY rn DESC) AS k
                 FROM newest WHERE event_type = 'session_start') WHERE k = 1)""",
    """
entry_meters AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY session_id ORDER BY rn DESC) AS k
                 FROM newest WHERE event_type = 'meter_update') WHERE k = 1)""",
)
LIVE_SESSIONS = f"""
SELECT i.session_id, s.session_id IS NOT NULL AS has_start,
       s.station_id, s.network_id, s.charger_type, s.power_kw, s.timestamp AS start_time, s.city, s.country,
       s.vehicle_type, s.vehicle_brand, s.vehicle_model, s.soc_percent AS soc_start, s.price_per_kwh, s.tariff_id,
       m.energy_kwh, m.soc_percent AS soc_current, m.duration_minutes, m.revenue_eur, m.timestamp AS last_updated
FROM (SELECT DISTINCT session_id FROM newest) i
LEFT JOIN entry_starts s ON s.session_id = i.session_id
LEFT JOIN entry_meters m ON m.session_id = i.session_id
WHERE s.session_id IS NULL OR s.timestamp > {AS_OF} - INTERVAL 3600 SECOND"""

KPI_TYPES = ",\n       ".join(
    f"count(*) FILTER (WHERE event_type = '{t}') AS {t}_events"
    for t in ("session_start", "meter_update", "session_stop", "status_change", "heartbeat", "fault_alert")
)


def state_sql() -> dict[str, str]:
    return {
        "t1_event_counters": on_events("""
            SELECT event_type, count(*) AS events FROM ce GROUP BY 1
            UNION ALL SELECT 'total', count(*) FROM ce"""),
        "t2_live_sessions": on_events(LIVE_SESSIONS, *SESSION_CTES),
        "t3_station_status": on_events("SELECT * FROM station_state", *STATION_CTES),
        "t3_station_status_live": on_events(
            """SELECT * EXCLUDE (is_live) FROM station_state
               WHERE last_updated > (SELECT max(timestamp) FROM writes) - INTERVAL 300 SECOND""", *STATION_CTES),
        "t2_streamed": on_events(LIVE_SESSIONS, *SESSION_CTES),
        "t3_streamed": on_events("SELECT * FROM station_state", *STATION_CTES),
        "t4_active_by_network": on_events(f"""
            SELECT network_id, {ACTIVE} AS active_sessions FROM ce
            WHERE event_type IN ('session_start', 'session_stop') GROUP BY 1"""),
        "t5_active_by_city": on_events(f"""
            SELECT {CITY} AS city, {ACTIVE} AS active_sessions FROM ce
            WHERE event_type IN ('session_start', 'session_stop') GROUP BY 1"""),
        "t6_active_global": on_events(f"""
            SELECT active_sessions, greatest(0, active_sessions) AS active_shown
            FROM (SELECT {ACTIVE} AS active_sessions FROM ce)"""),
        "t7_leaderboard_station": on_events(_leaderboard("station_id", "station_id")),
        "t8_leaderboard_network": on_events(_leaderboard("network_id", "network_id")),
        "t9_leaderboard_city": on_events(_leaderboard(CITY, "city")),
        "t10_leaderboard_topn": on_events("""
            SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY day ORDER BY revenue_eur DESC, station_id)
                                     AS INT) AS rank FROM board) WHERE rank <= 10""",
            f"board AS ({_leaderboard('station_id', 'station_id')})"),
        "t11_energy_daily": on_events(f"""
            SELECT CAST(timestamp AS DATE) AS day, {rsum('energy_kwh')} AS energy_kwh
            FROM ce WHERE {STOPS} AND energy_kwh > 0 GROUP BY 1"""),
        "t12_energy_network_daily": on_events(f"""
            SELECT CAST(timestamp AS DATE) AS day, network_id, {rsum('energy_kwh')} AS energy_kwh
            FROM ce WHERE {STOPS} AND energy_kwh > 0 GROUP BY 1, 2"""),
        "t13_fault_counters": on_events(f"""
            SELECT {CODE} AS error_code, count(*) AS faults FROM ce WHERE {FAULTS} GROUP BY 1
            UNION ALL SELECT 'total', count(*) FROM ce WHERE {FAULTS}"""),
        "t14_faults_network_daily": on_events(f"""
            SELECT CAST(timestamp AS DATE) AS day, network_id, count(*) AS faults FROM ce WHERE {FAULTS} GROUP BY 1, 2"""),
        "t15_status_counts": on_events("""
            SELECT coalesce(nullif(status, ''), 'unknown') AS status, count(*) AS changes
            FROM ce WHERE event_type = 'status_change' GROUP BY 1"""),
        "t16_live_kpis": on_events(f"""
            SELECT count(*) AS total_events, greatest(0, {ACTIVE}) AS active_sessions,
                   {KPI_TYPES},
                   count(*) FILTER (WHERE {FAULTS}) AS total_faults,
                   coalesce({rnd(f"""sum(energy_kwh) FILTER (WHERE {STOPS} AND energy_kwh > 0
                     AND CAST(timestamp AS DATE) = CAST({AS_OF} AS DATE))""", 1)}, 0) AS energy_today_kwh,
                   {rnd(f"count(*) FILTER (WHERE {FAULTS}) / CAST(greatest(count(*), 1) AS DOUBLE) * 100", 3)}
                     AS error_rate_pct
            FROM ce"""),
    }


BANDS = """CASE WHEN hour_of_day BETWEEN 7 AND 8 THEN 'Morning Peak' WHEN hour_of_day BETWEEN 12 AND 13 THEN 'Lunch Peak'
       WHEN hour_of_day BETWEEN 17 AND 19 THEN 'Evening Peak' ELSE 'Off-Peak' END"""


def _bars(chart: str, source: str, label: str, value: str) -> str:
    load = rnd(f"{value} / nullif(CAST((SELECT max({value}) FROM {source}) AS DOUBLE), 0)", 4)
    return f"""SELECT '{chart}' AS chart, {label} AS label, CAST({value} AS DOUBLE) AS value,
       coalesce({load}, 0) AS relative_load FROM {source}"""


def report_sql() -> dict[str, str]:
    brand = (f"a3 AS ({A3})", """
pair AS (SELECT t.*, o.avg_duration_min AS o_duration, o.avg_energy_kwh AS o_energy, o.avg_power_kw AS o_power,
                o.avg_revenue_per_session AS o_revenue
         FROM a3 t JOIN a3 o ON t.brand_group = 'Tesla' AND o.brand_group = 'Other Brands')""")
    return {
        "d1_kpi_cover": on_events(f"""
            SELECT (SELECT count(*) FROM ce) AS total_events, events_per_second, active_stations, unique_sessions,
                   (SELECT {rsum('total_revenue_eur')} FROM month) AS revenue_30d_eur,
                   (SELECT {rsum('total_energy_kwh')} FROM month) AS energy_30d_kwh
            FROM recent""", f"month AS ({Q1 % 30})", f"recent AS ({Q7})"),
        "d2_hour_bands": on_events(f"SELECT *, {BANDS} AS band FROM q9", f"q9 AS ({Q9})"),
        "d3_station_flags": on_events("""
            SELECT *, fault_rate_pct > 0.5 AS above_threshold,
                   CASE WHEN uptime_pct >= 90 THEN 'good' WHEN uptime_pct >= 70 THEN 'fair' ELSE 'poor' END AS uptime_band,
                   (SELECT count(*) FROM a2_all WHERE fault_rate_pct > 0.5) AS stations_above,
                   (SELECT count(*) FROM a2_all) AS stations_listed
            FROM a2""", f"a2 AS ({A2})", f"a2_all AS ({A2.rpartition('LIMIT')[0]})"),
        "d4_brand_delta": on_events(f"""
            SELECT {rnd('avg_duration_min - o_duration', 1)} AS delta_duration_min,
                   {rnd('avg_energy_kwh - o_energy', 2)} AS delta_energy_kwh,
                   {rnd('avg_power_kw - o_power', 1)} AS delta_power_kw,
                   {rnd('avg_revenue_per_session - o_revenue', 2)} AS delta_revenue_per_session
            FROM pair""", *brand),
        "d5_peak_share": on_events(
            f"SELECT {rsum('revenue_pct', 1)} AS peak_revenue_pct FROM a4 WHERE period <> 'Off-Peak'", *A4_CTES),
        "d6_worst_density_city": on_events(
            "SELECT * FROM a5 ORDER BY faults_per_station DESC, fault_count DESC, city, country LIMIT 1",
            f"a5 AS ({A5.rpartition('LIMIT')[0]})"),
        "d7_anomaly_summary": on_events(f"""
            SELECT count(*) AS anomalies,
                   {rnd(f'CAST(100 AS DOUBLE) * count(*) / (SELECT count(*) FROM ce WHERE {TIMED_STOPS})', 2)}
                     AS anomaly_pct,
                   count(*) FILTER (WHERE z_score > 0) AS high, count(*) FILTER (WHERE NOT z_score > 0) AS low,
                   max(fleet_mean_power) AS fleet_mean_power, max(fleet_std_power) AS fleet_std_power
            FROM listed HAVING count(*) > 0""", *A6_CTES, f"listed AS ({A6.rpartition('LIMIT')[0]})"),
        "d8_relative_load": on_events(
            _bars("hour_of_day", "q9", "CAST(hour_of_day AS VARCHAR)", "session_count")
            + "\nUNION ALL " + _bars("hourly_energy", "a1", "strftime(hour, '%Y-%m-%d %H:%M:%S')", "total_energy_kwh")
            + "\nUNION ALL " + _bars("period", "a4", "period", "total_revenue_eur"),
            f"q9 AS ({Q9})", *A1_CTES, *A4_CTES),
        "d9_panel_networks": on_events(Q1 % 1 + "\nORDER BY total_revenue_eur DESC, network_id LIMIT 6"),
        "d9_panel_cities": on_events(Q4 % 8),
        "d9_panel_errors": on_events(Q5 + "\nORDER BY occurrences DESC, error_code LIMIT 6"),
        "d9_panel_brands": on_events(Q13 % 8),
        "d9_panel_tariffs": on_events(Q14 % 8),
        "d9_panel_hours": on_events(Q2 % 48),
    }


SESSION_EVENTS = "session_id <> '' AND event_type IN ('session_start', 'meter_update', 'session_stop')"
SERIES = f"""
SELECT time_bucket(INTERVAL 300 SECOND, timestamp, TIMESTAMP '1970-01-01') AS interval_start, count(*) AS events,
       {rnd('count(*) / CAST(300 AS DOUBLE)', 4)} AS events_per_second,
       {KPI_TYPES}
FROM ce GROUP BY 1"""


def quality_sql() -> dict[str, str]:
    expected = rnd("energy_kwh * price_per_kwh", 2)
    return {
        "r1_session_lifecycle": on_events(f"""
            SELECT *, coalesce(first_start <= last_stop, false) AS is_complete FROM (
              SELECT session_id, min(timestamp) FILTER (WHERE event_type = 'session_start') AS first_start,
                     max(timestamp) FILTER (WHERE {STOPS}) AS last_stop,
                     count(*) FILTER (WHERE event_type = 'meter_update') AS meter_updates,
                     arg_min(soc_percent, (timestamp, event_id)) AS first_soc,
                     arg_max(soc_percent, (timestamp, event_id)) AS last_soc,
                     arg_max(energy_kwh, (timestamp, event_id)) FILTER (WHERE {STOPS}) AS final_energy_kwh,
                     arg_max(revenue_eur, (timestamp, event_id)) FILTER (WHERE {STOPS}) AS final_revenue_eur
              FROM ce WHERE {SESSION_EVENTS} GROUP BY session_id)"""),
        "r2_lifecycle_violations": on_events("""
            SELECT * FROM (
              SELECT session_id, count(*) FILTER (WHERE energy_kwh < prev_energy) AS energy_drops,
                     count(*) FILTER (WHERE soc_percent < prev_soc) AS soc_drops,
                     coalesce(min(timestamp) FILTER (WHERE event_type = 'session_stop')
                       < min(timestamp) FILTER (WHERE event_type = 'session_start'), false) AS stop_before_start
              FROM readings GROUP BY session_id)
            WHERE energy_drops > 0 OR soc_drops > 0 OR stop_before_start""",
            f"""readings AS (SELECT *, lag(energy_kwh) OVER w AS prev_energy, lag(soc_percent) OVER w AS prev_soc
                FROM ce WHERE {SESSION_EVENTS}
                WINDOW w AS (PARTITION BY session_id ORDER BY timestamp, event_id))"""),
        "r3_revenue_check": on_events(f"""
            SELECT event_id, session_id, energy_kwh, price_per_kwh, charged AS revenue_eur, {expected} AS expected_revenue_eur
            FROM (SELECT *, CASE WHEN CAST(event_id AS BIGINT) % 40 = 7 AND energy_kwh > 0
                    THEN revenue_eur + CAST(0.01 AS DOUBLE) ELSE revenue_eur END AS charged FROM ce)
            WHERE event_type IN ('meter_update', 'session_stop') AND charged <> {expected}"""),
        "r3_revenue_check_by_network": on_events(f"""
            SELECT network_id, count(*) AS checked, count(*) FILTER (WHERE revenue_eur <> {expected}) AS mismatches
            FROM ce WHERE event_type IN ('meter_update', 'session_stop') GROUP BY 1"""),
        "r4_power_bounds": on_events(f"""
            SELECT event_id, station_id, charger_type, power_kw, min_kw, max_kw,
                   {rnd('power_kw * CAST(1000 AS DOUBLE) / nullif(voltage_v, 0)', 1)} AS derived_current_a
            FROM ce JOIN bounds USING (charger_type)
            WHERE power_kw > 0 AND NOT power_kw BETWEEN min_kw AND max_kw""",
            """bounds AS (SELECT charger_type, CAST(lo AS DOUBLE) AS min_kw, CAST(hi AS DOUBLE) AS max_kw
                FROM (VALUES ('AC_LEVEL1', 3.7, 7.4), ('AC_LEVEL2', 7.4, 22.0), ('DC_FAST', 50.0, 150.0),
                             ('DC_ULTRA_FAST', 150.0, 350.0)) AS t(charger_type, lo, hi))"""),
        "r5_peak_multiplier": on_events("""
            SELECT CAST(CASE WHEN hour(timestamp) BETWEEN 7 AND 8 THEN 2.0 WHEN hour(timestamp) BETWEEN 12 AND 13 THEN 1.5
                        WHEN hour(timestamp) BETWEEN 17 AND 19 THEN 3.0 ELSE 1.0 END AS DOUBLE) AS multiplier,
                   count(*) AS events, count(*) FILTER (WHERE event_type = 'session_start') AS session_starts,
                   count(DISTINCT nullif(session_id, '')) AS sessions
            FROM ce GROUP BY 1"""),
        "r6_station_dimension": on_events("""
            SELECT station_id, arg_max(network_id, (timestamp, event_id)) AS network_id,
                   arg_max(city, (timestamp, event_id)) AS city, arg_max(country, (timestamp, event_id)) AS country,
                   arg_max(charger_type, (timestamp, event_id)) AS charger_type,
                   count(DISTINCT connector_id) AS connectors, min(price_per_kwh) AS min_price_per_kwh,
                   max(price_per_kwh) AS max_price_per_kwh
            FROM ce GROUP BY station_id"""),
        "r7_throughput_series": on_events(SERIES),
        "r7_throughput_summary": on_events(f"""
            SELECT count(*) AS intervals, CAST(sum(events) AS BIGINT) AS events,
                   {rnd('avg(rate)', 4)} AS avg_eps, {rnd('max(rate)', 4)} AS peak_eps,
                   {rnd('stddev_pop(rate)', 4)} AS std_eps, {rnd('avg(rate) / CAST(0.05 AS DOUBLE) * 100', 1)} AS pct_of_target
            FROM (SELECT *, events / CAST(300 AS DOUBLE) AS rate FROM series)""", f"series AS ({SERIES})"),
        "r8_traffic_mix": on_events(f"""
            SELECT event_type, count(*) AS events,
                   {rnd('CAST(100 AS DOUBLE) * count(*) / (SELECT count(*) FROM ce)', 2)} AS share_pct
            FROM ce GROUP BY 1"""),
    }


RAW_CTES = (
    """
numbered_events AS (
  SELECT CAST(event_id AS BIGINT) AS i, CAST(event_id AS BIGINT) % 100 AS m, ce.*,
         CASE WHEN CAST(event_id AS BIGINT) % 37 = 5 THEN timestamp - INTERVAL 1 HOUR ELSE timestamp END AS t2
  FROM ce)""",
    """
messages AS (SELECT i, m, CASE WHEN m = 83 THEN '{bad json' ELSE concat(
    '{"event_id":"', event_id,
    '","event_type":"', CASE WHEN m = 13 THEN 'unknown_evt' ELSE event_type END,
    '","timestamp":"', CASE WHEN m = 23 THEN 'not-a-date'
                            ELSE concat(strftime(t2, '%Y-%m-%dT%H:%M:%S.%f'), '+00:00') END,
    '","station_id":', CASE WHEN m = 3 THEN 'null' ELSE concat('"', station_id, '"') END,
    ',"session_id":"', CASE WHEN m = 33 THEN '' ELSE session_id END,
    '","network_id":"', network_id, '","city":"', city,
    '","connector_id":"', CAST(connector_id AS VARCHAR),
    '","soc_percent":', CASE WHEN m = 43 THEN '150' WHEN m = 53 THEN '"abc"' ELSE CAST(soc_percent AS VARCHAR) END,
    ',"power_kw":', CASE WHEN m = 63 THEN '-1.5' ELSE CAST(power_kw AS VARCHAR) END,
    ',"energy_kwh":', CASE WHEN m = 73 THEN '"n/a"' ELSE CAST(energy_kwh AS VARCHAR) END,
    ',"duration_minutes":', CAST(duration_minutes AS VARCHAR),
    ',"revenue_eur":', CAST(revenue_eur AS VARCHAR), ',"error_code":null}') END AS raw
  FROM numbered_events)""",
    """
raw_events AS (SELECT 2 * i AS arrival, raw FROM messages
               UNION ALL SELECT 2 * (i + 5) + 1 AS arrival, raw FROM messages WHERE m = 7)""",
    """
decoded AS (SELECT *, j->>'event_id' AS event_id, j->>'event_type' AS event_type, j->>'timestamp' AS ts_text,
                   j->>'station_id' AS station_id, j->>'session_id' AS session_id,
                   j->>'soc_percent' AS soc, json_type(j, '$.soc_percent') AS soc_type,
                   j->>'power_kw' AS power, j->>'energy_kwh' AS energy,
                   TRY_CAST(replace(j->>'timestamp', '+00:00', '') AS TIMESTAMP) AS event_ts
            FROM (SELECT *, json_valid(raw) AS is_json,
                         CAST(CASE WHEN json_valid(raw) THEN raw ELSE '{}' END AS JSON) AS j FROM raw_events))""",
    """
ruled AS (SELECT *,
    CASE WHEN NOT is_json THEN 'json_decode_error:malformed' END AS decode_reason,
    CASE WHEN coalesce(event_id, '') = '' THEN 'missing_field:event_id'
         WHEN coalesce(event_type, '') = '' THEN 'missing_field:event_type'
         WHEN coalesce(ts_text, '') = '' THEN 'missing_field:timestamp'
         WHEN coalesce(station_id, '') = '' THEN 'missing_field:station_id' END AS missing_rule,
    CASE WHEN event_type NOT IN ('session_start', 'meter_update', 'session_stop', 'status_change', 'heartbeat',
                                 'fault_alert') THEN concat('invalid_event_type:', event_type) END AS type_rule,
    CASE WHEN event_ts IS NULL THEN concat('invalid_timestamp:''', ts_text, '''') END AS time_rule,
    CASE WHEN event_type IN ('session_start', 'meter_update', 'session_stop') AND coalesce(session_id, '') = ''
         THEN 'missing_field:session_id' END AS session_rule,
    CASE WHEN soc IS NULL THEN NULL
         WHEN soc_type = 'VARCHAR' AND TRY_CAST(soc AS INT) IS NULL THEN concat('invalid_soc_type:''', soc, '''')
         WHEN TRY_CAST(soc AS DOUBLE) NOT BETWEEN 0 AND 100 THEN concat('soc_out_of_range:', soc) END AS soc_rule,
    CASE WHEN power IS NULL THEN NULL
         WHEN TRY_CAST(power AS DOUBLE) IS NULL THEN concat('invalid_power_kw_type:''', power, '''')
         WHEN TRY_CAST(power AS DOUBLE) < 0 THEN concat('negative_power_kw:', power) END AS power_rule,
    CASE WHEN energy IS NULL THEN NULL
         WHEN TRY_CAST(energy AS DOUBLE) IS NULL THEN concat('invalid_energy_kwh_type:''', energy, '''')
         WHEN TRY_CAST(energy AS DOUBLE) < 0 THEN concat('negative_energy_kwh:', energy) END AS energy_rule
  FROM decoded)""",
    """
validated AS (SELECT *, coalesce(decode_reason, missing_rule, type_rule, time_rule, session_rule, soc_rule,
                                 power_rule, energy_rule) AS reason FROM ruled)""",
    """
fresh AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY arrival) AS nth
          FROM validated WHERE reason IS NULL) WHERE nth = 1)""",
    """
timed AS (SELECT *, max(event_ts) OVER (ORDER BY arrival ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS high_water
          FROM fresh)""",
)


def _judged(lateness_s: int) -> tuple[str, ...]:
    behind = f"(epoch_us(high_water) - CAST({lateness_s} AS BIGINT) * 1000000 - epoch_us(event_ts))"
    seconds = f"CAST(round_even(CAST({behind} AS DECIMAL(20,0)) / 1000000, 0) AS BIGINT)"
    return (
        f"""
judged AS (SELECT arrival, raw, event_id, event_type, station_id, event_ts, high_water, j,
             CASE WHEN {behind} > 0 THEN concat('late_event:', CAST({seconds} AS VARCHAR), 's') END AS reason FROM timed)""",
        """
outcomes AS (SELECT arrival, raw, event_id, event_type, station_id, event_ts, reason FROM judged
             UNION ALL SELECT arrival, raw, event_id, event_type, station_id, event_ts, reason
             FROM validated WHERE reason IS NOT NULL)""",
    )


def on_messages(body: str, *ctes: str, lateness_s: int = 300) -> str:
    return on_events(body, *RAW_CTES, *_judged(lateness_s), *ctes)


def _typed(source: str) -> str:
    """The 28 columns out of JSON; fields the messages do not carry get their defaults."""
    def text(name: str) -> str:
        return f"coalesce(j->>'{name}', '') AS {name}"

    def number(name: str, kind: str) -> str:
        return f"coalesce(CAST(j->>'{name}' AS {kind}), 0) AS {name}"

    zero, none = "CAST(0 AS DOUBLE) AS {}", "'' AS {}"
    columns = [
        text("event_id"), text("event_type"), "date_trunc('millisecond', event_ts) AS timestamp", text("station_id"),
        number("connector_id", "INT"), text("session_id"), text("network_id"), text("city"), none.format("country"),
        zero.format("latitude"), zero.format("longitude"), none.format("charger_type"), number("power_kw", "DOUBLE"),
        number("energy_kwh", "DOUBLE"), number("soc_percent", "INT"), none.format("vehicle_type"),
        number("duration_minutes", "INT"), zero.format("price_per_kwh"), number("revenue_eur", "DOUBLE"),
        none.format("status"), none.format("error_code"), none.format("component"), zero.format("voltage_v"),
        zero.format("current_a"), none.format("vehicle_brand"), none.format("vehicle_model"),
        none.format("vehicle_ev_id"), none.format("tariff_id"),
    ]
    return f"SELECT arrival, {', '.join(columns)} FROM {source}"


def _rule(column: str) -> str:
    return on_messages(f"SELECT arrival, {column} AS reason FROM ruled WHERE is_json AND {column} IS NOT NULL")


SUMMARY = "SELECT split_part(reason, ':', 1) AS rule, count(*) AS events FROM outcomes WHERE reason IS NOT NULL GROUP BY 1"


def ingest_sql() -> dict[str, str]:
    late = "reason LIKE 'late_event:%'"
    valid = "SELECT * FROM validated WHERE reason IS NULL"
    return {
        "i1_decode": on_messages("SELECT arrival, event_id, event_type, station_id, decode_reason FROM ruled"),
        "i2a_missing_field": _rule("missing_rule"),
        "i2b_event_type": _rule("type_rule"),
        "i2c_timestamp": _rule("time_rule"),
        "i2d_session_id": _rule("session_rule"),
        "i2e_soc": _rule("soc_rule"),
        "i2f_power": _rule("power_rule"),
        "i2g_energy": _rule("energy_rule"),
        "i2_validate": on_messages("SELECT arrival, reason FROM validated"),
        "i3_conform_row": on_messages(_typed(f"({valid})")),
        "i4_parse_ts": on_messages("SELECT arrival, event_ts FROM decoded"),
        "i5_dedup": on_messages("SELECT arrival, event_id FROM fresh"),
        "i6_watermark": on_messages("SELECT arrival, high_water FROM timed"),
        "i7_late_split": on_messages("SELECT arrival, coalesce(reason, 'accepted') AS outcome FROM outcomes"),
        "i8_lateness_param": on_messages(
            f"SELECT arrival, event_id, reason FROM judged WHERE {late}", lateness_s=1800),
        "i9_current_watermark": on_messages("SELECT max(event_ts) - INTERVAL 300 SECOND AS watermark_utc FROM fresh"),
        "i10_ingest_metrics": on_messages(f"""
            SELECT messages, accepted, dead_letters, duplicates, late,
                   {rnd('CAST(100 AS DOUBLE) * duplicates / (tested + duplicates)', 2)} AS dedup_hit_pct,
                   {rnd('CAST(100 AS DOUBLE) * late / tested', 2)} AS late_pct,
                   {rnd('accepted / span', 3)} AS events_per_second
            FROM (SELECT (SELECT count(*) FROM raw_events) AS messages,
                         count(*) FILTER (WHERE reason IS NULL) AS accepted,
                         count(*) FILTER (WHERE reason IS NOT NULL) AS dead_letters,
                         (SELECT count(*) FROM raw_events) - count(*) AS duplicates,
                         count(*) FILTER (WHERE {late}) AS late,
                         (SELECT count(*) FROM fresh) AS tested,
                         (max(epoch_us(event_ts)) FILTER (WHERE reason IS NULL)
                          - min(epoch_us(event_ts)) FILTER (WHERE reason IS NULL)) / CAST(1000000 AS DOUBLE) AS span
                  FROM outcomes)"""),
        "i11_dead_letter_summary": on_messages(SUMMARY),
        "i12_replay_late": on_messages(f"""
            SELECT date_trunc('hour', timestamp) AS hour, network_id, city, country, charger_type,
                   count(*) AS session_count, {rsum('energy_kwh')} AS total_energy_kwh,
                   {rsum('revenue_eur')} AS total_revenue_eur,
                   CAST(sum(duration_minutes) AS BIGINT) AS total_duration_minutes, {rsum('power_kw')} AS sum_power_kw
            FROM typed WHERE event_type = 'session_stop' AND date_trunc('hour', timestamp) IN
                 (SELECT date_trunc('hour', event_ts) FROM judged WHERE {late})
            GROUP BY 1, 2, 3, 4, 5""", f"typed AS ({_typed('judged')})"),
        "i12_replay_days": on_messages(f"""
            SELECT CAST(timestamp AS DATE) AS day, station_id, network_id, city, country, charger_type,
                   count(*) AS session_count, {rsum('energy_kwh')} AS total_energy_kwh,
                   {rsum('revenue_eur')} AS total_revenue_eur,
                   CAST(sum(duration_minutes) AS BIGINT) AS total_duration_minutes
            FROM typed WHERE event_type = 'session_stop' AND CAST(timestamp AS DATE) IN
                 (SELECT CAST(event_ts AS DATE) FROM judged WHERE {late})
            GROUP BY 1, 2, 3, 4, 5, 6""", f"typed AS ({_typed('judged')})"),
    }


FACT_JSON = """concat('{"event_id":"', event_id, '","event_type":"', event_type, '","timestamp":"',
    strftime(timestamp, '%Y-%m-%dT%H:%M:%S.%f'), '+00:00","station_id":"', station_id,
    '","connector_id":', connector_id, ',"session_id":"', session_id, '","network_id":"', network_id,
    '","city":"', city, '","country":"', country, '","latitude":', latitude, ',"longitude":', longitude,
    ',"charger_type":"', charger_type, '","power_kw":', power_kw, ',"energy_kwh":', energy_kwh,
    ',"soc_percent":', soc_percent, ',"vehicle_type":"', vehicle_type, '","duration_minutes":', duration_minutes,
    ',"price_per_kwh":', price_per_kwh, ',"revenue_eur":', revenue_eur, ',"status":"', status,
    '","error_code":"', error_code, '","component":"', component, '","voltage_v":', voltage_v,
    ',"current_a":', current_a, ',"vehicle_brand":"', vehicle_brand, '","vehicle_model":"', vehicle_model,
    '","vehicle_ev_id":"', vehicle_ev_id, '","tariff_id":"', tariff_id, '"}')"""


def storage_sql() -> dict[str, str]:
    return {
        "s1_event_source": on_messages("SELECT arrival, raw FROM raw_events"),
        "s2_backfill_mode": on_messages(
            SUMMARY + " UNION ALL SELECT 'accepted', count(*) FROM outcomes WHERE reason IS NULL", lateness_s=999_999),
        "s3_fact_append": on_events("SELECT *, strftime(timestamp, '%Y-%m') AS event_month FROM ce"),
        "s4_dead_letter_sink": on_messages("""
            SELECT reason, coalesce(event_id, '') AS event_id, coalesce(event_type, '') AS event_type,
                   event_ts AS timestamp, coalesce(station_id, '') AS station_id, raw AS raw_event
            FROM outcomes WHERE reason IS NOT NULL"""),
        "s5_export_day": on_events("SELECT * FROM ce WHERE CAST(timestamp AS DATE) = DATE '2024-01-15'"),
        "s5_export_all": on_events("SELECT * FROM ce"),
        "s6_retention": on_events(
            f"SELECT event_id, timestamp FROM ce WHERE timestamp >= {AS_OF} - INTERVAL 10 DAY"),
        "s7_fanout": on_messages("""
            SELECT event_type, count(*) AS events, 'warehouse' AS consumer FROM judged WHERE reason IS NULL GROUP BY 1
            UNION ALL SELECT event_type, count(*), 'live' FROM judged GROUP BY 1"""),
        "s8_encode_publish": on_events(f"SELECT station_id AS key, {FACT_JSON} AS value FROM ce"),
    }


# Questions answered from stored rollups, and panels read from live tables, ask the same as those over the facts.
STORED_AS = {
    "t1_panel": "t1_event_counters", "t4_panel": "t4_active_by_network", "t5_panel": "t5_active_by_city",
    "t6_panel": "t6_active_global", "t7_panel": "t7_leaderboard_station", "t8_panel": "t8_leaderboard_network",
    "t9_panel": "t9_leaderboard_city", "t10_panel": "t10_leaderboard_topn", "t11_panel": "t11_energy_daily",
    "t12_panel": "t12_energy_network_daily", "t13_panel": "t13_fault_counters", "t14_panel": "t14_faults_network_daily",
    "t15_panel": "t15_status_counts", "t16_panel": "t16_live_kpis",
    "q1_stored": "q1_revenue_by_network", "q2_stored": "q2_sessions_per_hour", "q3_stored": "q3_charger_utilization",
    "q4_stored": "q4_top_cities_by_energy", "q5_stored": "q5_error_analysis", "q6_stored": "q6_vehicle_type_breakdown",
    "q7_stored": "q7_real_time_throughput", "q8_stored": "q8_session_duration_distribution", "q9_stored": "q9_peak_hours",
    "q10_stored": "q10_network_error_rate", "q11_stored": "q11_revenue_per_kwh", "q12_stored": "q12_country_summary",
    "a1_stored": "a1_hourly_energy_7days", "a5_stored": "a5_fault_geography", "d1_stored": "d1_kpi_cover",
    "a6_stored": "a6_anomaly_detection", "d7_stored": "d7_anomaly_summary",
    "m3_stored": "m3_errors_daily", "u1_stored": "u1_total_events",
}


def oracle_sql() -> dict[str, str]:
    found = {
        **analytics_sql(), **rollup_sql(), **state_sql(), **report_sql(), **quality_sql(), **ingest_sql(),
        **storage_sql(),
    }
    return {**found, **{name: found[same] for name, same in STORED_AS.items()}}
