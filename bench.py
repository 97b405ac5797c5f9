"""Times every registered query, the analytical questions on a stored fact table, and the ingest path.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_ONLY (comma-separated
prefixes of query names). Prints one JSON line; seconds are wall clock of building, planning and running a query to
its last row, after one warm-up query.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from wattloom import registry  # noqa: E402
from wattloom.operators import ingest  # noqa: E402
from wattloom.plans import analytics  # noqa: E402
from wattloom.plans.stored import StoredAnalytics  # noqa: E402
from wattloom.session import build_session, scratch_path  # noqa: E402
from wattloom.sources import deadletter, fact, testdata  # noqa: E402

STORED = {
    "q1": analytics.revenue_by_network, "q2": analytics.sessions_per_hour, "q3": analytics.charger_utilization,
    "q4": analytics.top_cities_by_energy, "q5": analytics.error_analysis, "q6": analytics.vehicle_type_breakdown,
    "q7": analytics.real_time_throughput, "q8": analytics.session_duration_distribution, "q9": analytics.peak_hours,
    "q10": analytics.network_error_rate, "q11": analytics.revenue_per_kwh, "q12": analytics.country_summary,
    "q13": analytics.vehicle_brand_breakdown, "q14": analytics.tariff_analysis,
    "a1": analytics.hourly_energy_7days, "a2": analytics.station_uptime, "a3": analytics.brand_comparison,
    "a4": analytics.peak_hour_revenue, "a5": analytics.fault_geography, "a6": analytics.anomalies,
    "u1": analytics.total_events,
}

ROLLED = {
    "q1": StoredAnalytics.revenue_by_network, "q2": StoredAnalytics.sessions_per_hour, "q3": StoredAnalytics.charger_utilization,
    "q4": StoredAnalytics.top_cities_by_energy, "q5": StoredAnalytics.error_analysis,
    "q6": StoredAnalytics.vehicle_type_breakdown, "q7": StoredAnalytics.real_time_throughput,
    "q8": StoredAnalytics.session_duration_distribution, "q9": StoredAnalytics.peak_hours,
    "q10": StoredAnalytics.network_error_rate, "q11": StoredAnalytics.revenue_per_kwh, "q12": StoredAnalytics.country_summary,
    "a1": StoredAnalytics.hourly_energy_7days, "a5": StoredAnalytics.fault_geography, "u1": StoredAnalytics.total_events,
    "d1": StoredAnalytics.kpi_cover,
}


def timed(job) -> float:
    start = time.perf_counter()
    job()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = [p for p in os.environ.get("BENCH_ONLY", "").split(",") if p]
    spark = build_session(
        "wattloom-bench", f"local[{cpus}]",
        **{"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g"},
    )
    spark.sparkContext.setLogLevel("ERROR")

    queries = {n: q for n, q in registry.queries().items() if not only or any(n.startswith(p) for p in only)}
    timed(lambda: registry.queries()["q3_charger_utilization"](spark, sf_dir).collect())
    seconds = {name: timed(lambda: query(spark, sf_dir).collect()) for name, query in queries.items()}

    path = scratch_path(spark, "bench-fact")
    load = timed(lambda: fact.write_fact(testdata.charging_events(spark, sf_dir), path))
    stored = {}
    for name, question in STORED.items():
        run = lambda: question(fact.read_fact(spark, path)).collect()
        stored[name] = min(timed(run), timed(run))

    # The same questions from the rollups of a warehouse, as a panel asks them again and again.
    answers = StoredAnalytics(spark, registry.warehouse_of(spark, sf_dir))
    rolled = {}
    for name, question in ROLLED.items():
        run = lambda: question(answers).collect()
        rolled[name] = min(timed(run), timed(run))

    raw = testdata.raw_events(spark, sf_dir)
    messages = raw.count()

    def ingest_all() -> None:
        judged = ingest.classify(raw).cache()
        fact.write_fact(ingest.accepted(judged), scratch_path(spark, "bench-accepted"))
        deadletter.write_dead_letters(ingest.rejected(judged), scratch_path(spark, "bench-letters"))
        judged.unpersist()

    took = min(timed(ingest_all), timed(ingest_all))
    print(json.dumps({
        "metric": "total_query_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "stored_fact_queries": stored,
        "stored_rollup_queries": rolled,
        "fact_load_seconds": load,
        "ingest_messages": messages,
        "ingest_seconds": took,
        "ingest_events_per_second": round(messages / took),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
