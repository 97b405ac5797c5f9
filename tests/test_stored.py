"""Answers from stored rollups against those over the facts, for moments off and on the hour, and their plans."""

from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from wattloom.operators import distincts, rollups
from wattloom.plans import analytics, report
from wattloom.plans.stored import StoredAnalytics
from wattloom.schema import FACT_NAMES
from wattloom.sources import fact, testdata
from wattloom.sources.snapshot import Snapshots
from wattloom.streaming import jobs, tables


def rows(df):
    return sorted(map(repr, df.collect()))


@pytest.fixture(scope="module")
def warehouse(spark, sf, tmp_path_factory):
    """Three loads, one of them merged with another."""
    folder = str(tmp_path_factory.mktemp("warehouse"))
    facts = testdata.charging_events(spark, sf)
    for load in range(3):
        jobs.load_facts(spark, folder, facts.filter(F.col("event_id").cast("bigint") % 3 == load), str(load))
        if load == 1:
            assert "fact" in tables.merge_tables(Snapshots(spark, folder), fanout=2)
    return folder, fact.read_fact(spark, f"{folder}/fact").select(*FACT_NAMES).cache()


MOMENTS = [datetime(2024, 1, 20, 13, 37, 11, 5), datetime(2024, 1, 20, 13), datetime(2024, 1, 1, 0, 30), datetime(2025, 1, 1)]


@pytest.mark.parametrize("as_of", MOMENTS)
def test_trailing_answers_at_any_moment(spark, warehouse, as_of):
    folder, facts = warehouse
    stored, as_of = StoredAnalytics(spark, folder, as_of), as_of.replace(tzinfo=timezone.utc)
    for days in (1, 7):
        assert rows(stored.revenue_by_network(days)) == rows(analytics.revenue_by_network(facts, as_of=as_of, days=days))
    assert rows(stored.sessions_per_hour(5)) == rows(analytics.sessions_per_hour(facts, as_of=as_of, hours=5))
    assert rows(stored.hourly_energy_7days()) == rows(analytics.hourly_energy_7days(facts, as_of=as_of))
    assert rows(stored.real_time_throughput(60)) == rows(analytics.real_time_throughput(facts, as_of=as_of, minutes=60))


def test_answers_over_all_time(spark, warehouse):
    folder, facts = warehouse
    stored = StoredAnalytics(spark, folder)
    pairs = [
        (stored.charger_utilization(), analytics.charger_utilization(facts)),
        (stored.top_cities_by_energy(), analytics.top_cities_by_energy(facts)),
        (stored.error_analysis(), analytics.error_analysis(facts)),
        (stored.fault_geography(), analytics.fault_geography(facts)),
        (stored.country_summary(), analytics.country_summary(facts)),
        (stored.session_duration_distribution(), analytics.session_duration_distribution(facts)),
        (stored.anomalies(), analytics.anomalies(facts)),
        (stored.anomaly_summary(), report.anomaly_summary(facts)),
        (stored.kpi_cover(), report.kpi_cover(facts)),
        (stored.errors_daily(), rollups.errors_daily(facts)),
    ]
    for found, expected in pairs:
        assert found.columns == expected.columns and rows(found) == rows(expected)


def test_only_the_cut_hour_is_read_from_facts(spark, warehouse):
    folder, facts = warehouse
    since = datetime(2024, 1, 13, 13, 37, tzinfo=timezone.utc)
    stored = StoredAnalytics(spark, folder, since + timedelta(days=7))
    edge = stored.facts_between(since, since.replace(minute=0) + timedelta(hours=1))
    assert edge.count() == facts.filter(F.col("timestamp").between(since, since.replace(minute=59, second=59, microsecond=999999))).count()
    plan = stored.revenue_by_network()._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation") == 2 and "2024-01-13 14:00:00" in plan
    whole = StoredAnalytics(spark, folder, datetime(2024, 1, 20, 13)).revenue_by_network()
    assert whole._jdf.queryExecution().optimizedPlan().toString().count("Relation") == 1


def test_anomalies_scan_the_facts_once(spark, warehouse):
    plan = StoredAnalytics(spark, warehouse[0]).anomalies()._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation") == 1


def test_an_empty_warehouse_answers(spark, tmp_path):
    stored = StoredAnalytics(spark, str(tmp_path))
    assert stored.as_of is None and stored.total_events().first().total == 0
    assert stored.real_time_throughput().first().event_count == 0
    assert stored.kpi_cover().count() == 1
    for answer in (stored.revenue_by_network(), stored.error_analysis(), stored.anomalies(), stored.hourly_energy_7days(),
                   stored.country_summary(), stored.fault_geography()):
        assert answer.collect() == []


def test_numbers_of_stations_stay(spark, events):
    none = spark.createDataFrame([], distincts.DICTIONARY_DDL)
    first = distincts.new_stations(events(*[{"station_id": f"s{i}", "timestamp": "2024-01-01T00:00:00"} for i in range(300)]), none).cache()
    numbers = sorted(r.number for r in first.collect())
    assert numbers == list(range(1, 301))
    more = events(*[{"station_id": f"s{i}", "timestamp": "2024-01-01T00:00:00"} for i in range(290, 310)])
    assert sorted(r.number for r in distincts.new_stations(more, first).collect()) == list(range(301, 311))


def test_distinct_stations_do_not_add_up_twice(spark, events):
    faults = events(*[{"event_type": "fault_alert", "station_id": f"s{i % 7}", "error_code": f"E{i % 2}", "city": "c", "country": "k",
                       "network_id": f"n{i % 3}", "timestamp": f"2024-01-0{1 + i % 4}T00:00:00"} for i in range(60)])
    dictionary = distincts.new_stations(faults, spark.createDataFrame([], distincts.DICTIONARY_DDL))
    halves = [faults.filter(f"day(timestamp) {op} 2") for op in ("<=", ">")]
    bits = [distincts.fault_stations_daily(h, dictionary) for h in halves]
    merged = distincts.merge_bits(bits[0].unionByName(bits[1]).unionByName(bits[0].withColumn("faults", F.lit(0).cast("bigint"))),
                                  distincts.FAULT_KEYS)
    found = distincts.distinct_by(merged, ["error_code"]).orderBy("error_code").collect()
    assert [(r.error_code, r.faults, r.distinct_stations) for r in found] == [("E0", 30, 7), ("E1", 30, 7)]


def test_a_load_reads_its_facts_once(spark, sf, tmp_path):
    """A dozen tables are made of a load; what its facts come from runs once, not for each of them."""
    passed = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            passed.add(batch.num_rows)
            yield batch

    facts = testdata.charging_events(spark, sf)
    jobs.load_facts(spark, str(tmp_path), facts.mapInArrow(counted, facts.schema), "one")
    assert passed.value == facts.count() == StoredAnalytics(spark, str(tmp_path)).total_events().first()[0]
