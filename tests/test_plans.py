"""Analytics, rollups and quality: empty input, boundaries, rollup = direct aggregate, and plan shapes."""

from datetime import datetime, timezone

import pytest

from wattloom.operators import quality, rollups
from wattloom.plans import analytics, report
from wattloom.sources import testdata

STOP = {"event_type": "session_stop", "duration_minutes": 60, "timestamp": "2024-03-01T08:00:00"}
ONE_ROW_ALWAYS = {"real_time_throughput", "total_events"}
QUESTIONS = [
    analytics.revenue_by_network, analytics.sessions_per_hour, analytics.charger_utilization,
    analytics.top_cities_by_energy, analytics.error_analysis, analytics.vehicle_type_breakdown,
    analytics.real_time_throughput, analytics.session_duration_distribution, analytics.peak_hours,
    analytics.network_error_rate, analytics.revenue_per_kwh, analytics.country_summary,
    analytics.vehicle_brand_breakdown, analytics.tariff_analysis, analytics.hourly_energy_7days,
    analytics.station_uptime, analytics.brand_comparison, analytics.fault_geography, analytics.anomalies,
    analytics.total_events, report.hour_bands, report.station_flags, report.brand_delta, report.worst_density_city,
    report.anomaly_summary,
]


@pytest.mark.parametrize("question", QUESTIONS, ids=lambda q: q.__name__)
def test_empty_table(events, question):
    rows = question(events()).collect()
    assert len(rows) == (1 if question.__name__ in ONE_ROW_ALWAYS else 0)
    if question is analytics.real_time_throughput:
        assert tuple(rows[0]) == (5, 0, 0, 0, 0.0, 0.0, 0.0)


def test_periods_are_zero_filled(events):
    rows = analytics.peak_hour_revenue(events()).collect()
    assert [r.period for r in rows] == [analytics.MORNING, analytics.EVENING, analytics.OFF_PEAK]
    assert all(r.session_count == 0 and r.revenue_pct == 0.0 for r in rows)


def test_single_hour_is_a_peak(events):
    assert [r.label for r in analytics.hourly_energy_7days(events({**STOP, "energy_kwh": 1.0})).collect()] == ["PEAK"]


def test_ties_label_several_hours(events):
    df = events(*[{**STOP, "energy_kwh": e, "timestamp": f"2024-03-01T0{h}:00:00"} for h, e in enumerate((1.0, 2.0, 2.0))])
    assert [r.label for r in analytics.hourly_energy_7days(df).collect()] == ["LOW", "PEAK", "PEAK"]


def test_trailing_window_includes_its_edge(events):
    df = events({**STOP, "network_id": "a", "timestamp": "2024-03-01T00:00:00"},
                {**STOP, "network_id": "a", "timestamp": "2024-03-08T00:00:00"},
                {**STOP, "network_id": "a", "timestamp": "2024-02-29T23:59:59"})
    assert analytics.revenue_by_network(df, days=7).first().session_count == 2
    later = datetime(2024, 3, 8, 0, 0, 1, tzinfo=timezone.utc)
    assert analytics.revenue_by_network(df, days=7, as_of=later).first().session_count == 1


def test_newest_event_of_any_type_is_now(events):
    df = events(STOP, {"event_type": "heartbeat", "timestamp": "2024-03-20T00:00:00"})
    assert analytics.revenue_by_network(df, days=7).count() == 0


def test_equal_powers_are_no_anomaly(events):
    assert analytics.anomalies(events(*[{**STOP, "energy_kwh": 7.0}] * 5)).count() == 0


def test_anomaly_scores(events):
    df = events(*[{**STOP, "energy_kwh": 10.0}] * 20, {**STOP, "energy_kwh": 100.0, "session_id": "odd"})
    row, = analytics.anomalies(df).collect()
    assert (row.session_id, row.power_kw, row.fleet_mean_power) == ("odd", 100.0, 14.29) and row.z_score > 4


def rows(df):
    return sorted(map(repr, df.collect()))


def test_partial_rollups_add_up(spark, sf):
    facts = testdata.charging_events(spark, sf)
    halves = [facts.filter("CAST(event_id AS INT) % 2 = 0"), facts.filter("CAST(event_id AS INT) % 2 = 1")]
    members = rollups.error_members_daily(halves[0]).union(rollups.error_members_daily(halves[1]))
    assert rows(rollups.errors_from_members(members)) == rows(rollups.errors_daily(facts))
    partial = rollups.sessions_hourly(halves[0]).union(rollups.sessions_hourly(halves[1]))
    combined = rollups.combine(partial, rollups.HOURLY_KEYS)
    assert rows(analytics.hourly_energy_7days(facts, rollup=combined)) == rows(analytics.hourly_energy_7days(facts))


def test_lifecycle_across_cells_equals_a_plain_lag(events):
    df = events(
        {"event_type": "session_start", "session_id": "x", "soc_percent": 10, "timestamp": "2024-03-01T00:00:00"},
        {"event_type": "meter_update", "session_id": "x", "soc_percent": 20, "energy_kwh": 2.0, "timestamp": "2024-03-01T00:00:30"},
        {"event_type": "meter_update", "session_id": "x", "soc_percent": 15, "energy_kwh": 3.0, "timestamp": "2024-03-01T00:00:40"},
        {"event_type": "session_stop", "session_id": "x", "soc_percent": 30, "energy_kwh": 1.0, "timestamp": "2024-03-01T00:05:00"},
        {"event_type": "session_stop", "session_id": "y", "timestamp": "2024-03-01T00:00:00"},
        {"event_type": "session_start", "session_id": "y", "timestamp": "2024-03-01T00:05:00"},
        {"event_type": "session_start", "session_id": "ok", "timestamp": "2024-03-01T00:00:00"},
        {"event_type": "session_stop", "session_id": "ok", "energy_kwh": 3.0, "timestamp": "2024-03-01T01:00:00"},
    )
    found = {r.session_id: (r.energy_drops, r.soc_drops, r.stop_before_start)
             for r in quality.lifecycle_violations(df).collect()}
    assert found == {"x": (1, 1, False), "y": (0, 0, True)}


def test_revenue_and_power_checks(events):
    df = events({**STOP, "energy_kwh": 10.0, "price_per_kwh": 0.5, "revenue_eur": 5.0},
                {**STOP, "energy_kwh": 10.0, "price_per_kwh": 0.5, "revenue_eur": 5.01},
                {"event_type": "meter_update", "charger_type": "AC_LEVEL2", "power_kw": 22.0, "timestamp": "2024-03-01T00:00:00"},
                {"event_type": "meter_update", "charger_type": "AC_LEVEL2", "power_kw": 22.1, "voltage_v": 400.0,
                 "timestamp": "2024-03-01T00:00:00"})
    assert [r.event_id for r in quality.revenue_mismatches(df).collect()] == ["000001"]
    row, = quality.power_out_of_bounds(df).collect()
    assert (row.event_id, row.derived_current_a) == ("000003", 55.3)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_query_uses_a_cartesian_or_nested_loop_join(spark, sf):
    facts = testdata.charging_events(spark, sf)
    for question in QUESTIONS:
        text = plan(question(facts))
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, question.__name__


def test_hot_keys_of_large_dimensions_are_joined_by_broadcast(spark, sf):
    from wattloom.functions.joins import dimension_join, heavy_hitters

    fact = spark.range(10_000).selectExpr("id", "IF(id % 3 = 0, 7, id % 500) AS key")
    dim = spark.range(490).selectExpr("id AS dim_key", "id * 10 AS label")
    assert heavy_hitters(fact, "key") == [7] and heavy_hitters(fact.limit(0), "key") == []
    assert heavy_hitters(fact.selectExpr("id", "IF(id % 2 = 0, NULL, key) AS key"), "key") == [7]
    large = dimension_join(fact, dim, "key", "dim_key", limit=0)
    plain = dimension_join(fact, dim, "key", "dim_key")
    text = plan(large)
    assert "BroadcastHashJoin" in plan(plain) and "BroadcastHashJoin" in text and "Union" in text
    assert rows(large.select("id", "label")) == rows(plain.select("id", "label"))
    cold = dimension_join(fact.filter("key <> 7"), dim, "key", "dim_key", limit=0)
    assert rows(cold.select("id", "label")) == rows(plain.filter("key <> 7").select("id", "label"))
