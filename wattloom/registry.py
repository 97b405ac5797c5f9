"""Every query by name: (spark, sf_dir) -> DataFrame over the given test tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from wattloom.functions.numeric import rnd
from wattloom.operators import ingest, lateness, quality, replay, rollups, state
from wattloom.operators.conform import conform
from wattloom.operators.decode import decode
from wattloom.operators.validate import apply_rule, valid_only, validate
from wattloom.plans import analytics, report
from wattloom.plans.stored import StoredAnalytics
from wattloom.schema import BACKFILL_LATENESS_S, FACT_DDL, FACT_NAMES
from wattloom.session import scratch_path
from wattloom.sources import deadletter, export, fact, streams, testdata
from wattloom.streaming import jobs, keyed, tables
from wattloom.streaming.panel import LivePanel

Query = Callable[[SparkSession, str], DataFrame]


def plain_times(df: DataFrame) -> DataFrame:
    """Timestamps without a zone (all are UTC), so that other engines read the same values."""
    return df.select(*[
        F.col(f.name).cast("timestamp_ntz").alias(f.name) if isinstance(f.dataType, T.TimestampType) else F.col(f.name)
        for f in df.schema.fields
    ])


def rounded(df: DataFrame, digits: int = 2) -> DataFrame:
    """Sums of doubles to a fixed number of digits; their last bits depend on the order of addition."""
    return df.select(*[
        rnd(F.col(f.name), digits).alias(f.name) if isinstance(f.dataType, T.DoubleType) else F.col(f.name)
        for f in df.schema.fields
    ])


def on_events(job: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: plain_times(job(testdata.charging_events(spark, sf_dir)))


ANALYTICS: dict[str, Query] = {
    "q1_revenue_by_network": on_events(analytics.revenue_by_network),
    "q2_sessions_per_hour": on_events(analytics.sessions_per_hour),
    "q3_charger_utilization": on_events(analytics.charger_utilization),
    "q4_top_cities_by_energy": on_events(analytics.top_cities_by_energy),
    "q5_error_analysis": on_events(analytics.error_analysis),
    "q6_vehicle_type_breakdown": on_events(analytics.vehicle_type_breakdown),
    "q7_real_time_throughput": on_events(analytics.real_time_throughput),
    "q8_session_duration_distribution": on_events(analytics.session_duration_distribution),
    "q9_peak_hours": on_events(analytics.peak_hours),
    "q10_network_error_rate": on_events(analytics.network_error_rate),
    "q11_revenue_per_kwh": on_events(analytics.revenue_per_kwh),
    "q12_country_summary": on_events(analytics.country_summary),
    "q13_vehicle_brand_breakdown": on_events(analytics.vehicle_brand_breakdown),
    "q14_tariff_analysis": on_events(analytics.tariff_analysis),
    "a1_hourly_energy_7days": on_events(analytics.hourly_energy_7days),
    "a2_station_uptime": on_events(analytics.station_uptime),
    "a3_brand_comparison": on_events(analytics.brand_comparison),
    "a4_peak_hour_revenue": on_events(analytics.peak_hour_revenue),
    "a5_fault_geography": on_events(analytics.fault_geography),
    "a6_anomaly_detection": on_events(analytics.anomalies),
    "u1_total_events": on_events(analytics.total_events),
}

ROLLUPS: dict[str, Query] = {
    "m1_sessions_hourly": on_events(lambda df: rounded(rollups.sessions_hourly(df))),
    "m2_station_daily": on_events(lambda df: rounded(rollups.station_daily(df))),
    "m3_errors_daily": on_events(rollups.errors_daily),
    "m4_network_revenue_daily": on_events(lambda df: rounded(rollups.network_revenue_daily(df))),
    "m5_rollup_reaggregate": on_events(lambda df: rounded(rollups.hourly_totals(rollups.sessions_hourly(df)))),
}


def at_last_write(df: DataFrame) -> DataFrame:
    """Station entries alive at the moment of the newest write of any."""
    return state.station_status_live(df, as_of=state.station_writes(df).agg(F.max("timestamp")).scalar())


def streamed(entries: keyed.Entries, answer: Callable[[DataFrame, Column], DataFrame], rounds: int = 5) -> Query:
    """Entries kept by a stateful stream that is stopped and started again for every stretch of the events in time order."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        folder, source = scratch_path(spark, "entries"), scratch_path(spark, "fact-log")
        facts = testdata.charging_events(spark, sf_dir)
        first, last = facts.agg(F.unix_micros(F.min("timestamp")), F.unix_micros(F.max("timestamp"))).first()
        stretch = F.floor((F.unix_micros("timestamp") - F.lit(first)) * rounds / F.lit(last - first + 1))
        for number in range(rounds):
            facts.filter(stretch == number).write.mode("append").parquet(source)
            stream = spark.readStream.schema(FACT_DDL).parquet(source)
            keyed.start_entries(stream, folder, entries, keep_history=True, run_as_backfill=True).awaitTermination()
        cells = keyed.read_entries(spark, folder, entries, keep_history=True)
        return plain_times(answer(cells, F.timestamp_micros(F.lit(last))))

    return run


STATE: dict[str, Query] = {
    "t1_event_counters": on_events(state.event_counters),
    "t2_live_sessions": on_events(state.live_sessions_at),
    "t3_station_status": on_events(state.station_status_history),
    "t3_station_status_live": on_events(at_last_write),
    "t2_streamed": streamed(keyed.SESSIONS, state.live_sessions),
    "t3_streamed": streamed(keyed.STATIONS, state.station_status),
    "t4_active_by_network": on_events(state.active_by_network),
    "t5_active_by_city": on_events(state.active_by_city),
    "t6_active_global": on_events(state.active_global),
    "t7_leaderboard_station": on_events(lambda df: state.leaderboard(df, "station_id")),
    "t8_leaderboard_network": on_events(lambda df: state.leaderboard(df, "network_id")),
    "t9_leaderboard_city": on_events(lambda df: state.leaderboard(df, "city")),
    "t10_leaderboard_topn": on_events(state.leaderboard_top),
    "t11_energy_daily": on_events(state.energy_daily),
    "t12_energy_network_daily": on_events(lambda df: state.energy_daily(df, "network_id")),
    "t13_fault_counters": on_events(state.fault_counters),
    "t14_faults_network_daily": on_events(state.faults_network_daily),
    "t15_status_counts": on_events(state.status_counts),
    "t16_live_kpis": on_events(state.live_kpis),
}

REPORT: dict[str, Query] = {
    "d1_kpi_cover": on_events(report.kpi_cover),
    "d2_hour_bands": on_events(report.hour_bands),
    "d3_station_flags": on_events(report.station_flags),
    "d4_brand_delta": on_events(report.brand_delta),
    "d5_peak_share": on_events(report.peak_share),
    "d6_worst_density_city": on_events(report.worst_density_city),
    "d7_anomaly_summary": on_events(report.anomaly_summary),
    "d8_relative_load": on_events(report.load_bars),
    **{f"d9_panel_{name}": on_events(panel) for name, panel in report.PANELS.items()},
}

def overcharged(df: DataFrame) -> DataFrame:
    """The events with a cent too much on every 40th of those that carry energy, for the check to find."""
    wrong = (F.col("event_id").cast("bigint") % 40 == 7) & (F.col("energy_kwh") > 0)
    return df.withColumn("revenue_eur", F.when(wrong, F.col("revenue_eur") + 0.01).otherwise(F.col("revenue_eur")))


QUALITY: dict[str, Query] = {
    "r1_session_lifecycle": on_events(quality.session_lifecycle),
    "r2_lifecycle_violations": on_events(quality.lifecycle_violations),
    "r3_revenue_check": on_events(lambda df: quality.revenue_mismatches(overcharged(df))),
    "r3_revenue_check_by_network": on_events(quality.revenue_check),
    "r4_power_bounds": on_events(quality.power_out_of_bounds),
    "r5_peak_multiplier": on_events(quality.sessions_per_multiplier),
    "r6_station_dimension": on_events(quality.station_dimension),
    "r7_throughput_series": on_events(quality.throughput_series),
    "r7_throughput_summary": on_events(quality.throughput_summary),
    "r8_traffic_mix": on_events(quality.traffic_mix),
}


def on_messages(job: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: plain_times(job(testdata.raw_events(spark, sf_dir)))


def rule_query(rule: str) -> Query:
    return on_messages(lambda raw: apply_rule(raw, rule))


def valid_rows(raw: DataFrame) -> DataFrame:
    return conform(valid_only(decode(raw)), "arrival")


def late_messages(raw: DataFrame, lateness_s: int) -> DataFrame:
    judged = ingest.classify(raw, lateness_s=lateness_s)
    return judged.filter(F.col("reason").startswith("late_event:")).select("arrival", "event_id", "reason")


def outcome(raw: DataFrame) -> DataFrame:
    """What became of every message that is no duplicate."""
    return ingest.classify(raw).select("arrival", F.coalesce("reason", F.lit("accepted")).alias("outcome"))


def replayed(recompute: Callable[[DataFrame, DataFrame], DataFrame]) -> Callable[[DataFrame], DataFrame]:
    """The hours or days that late events belong to, computed again after their replay."""
    def run(raw: DataFrame) -> DataFrame:
        judged = ingest.classify(raw)
        facts = ingest.accepted(judged)
        late = replay.replayed_rows(ingest.rejected(judged), facts)
        return rounded(recompute(facts, late))

    return run


INGEST: dict[str, Query] = {
    "i1_decode": on_messages(lambda raw: decode(raw).select("arrival", "event_id", "event_type", "station_id",
                                                            "decode_reason")),
    "i2a_missing_field": rule_query("missing_field"),
    "i2b_event_type": rule_query("event_type"),
    "i2c_timestamp": rule_query("timestamp"),
    "i2d_session_id": rule_query("session_id"),
    "i2e_soc": rule_query("soc"),
    "i2f_power": rule_query("power"),
    "i2g_energy": rule_query("energy"),
    "i2_validate": on_messages(lambda raw: validate(decode(raw)).select("arrival", "reason")),
    "i3_conform_row": on_messages(valid_rows),
    "i4_parse_ts": on_messages(lambda raw: decode(raw).select("arrival", "event_ts")),
    "i5_dedup": on_messages(lambda raw: ingest.first_unseen(raw).filter("reason IS NULL").select("arrival", "event_id")),
    "i6_watermark": on_messages(
        lambda raw: ingest.classify(raw).filter("dedup_key LIKE 'id:%'").select("arrival", "high_water")),
    "i7_late_split": on_messages(outcome),
    "i8_lateness_param": on_messages(lambda raw: late_messages(raw, 1800)),
    "i9_current_watermark": on_messages(
        lambda raw: lateness.current_watermark(ingest.first_unseen(raw).filter("reason IS NULL"), ts="event_ts")),
    "i10_ingest_metrics": on_messages(lambda raw: ingest.ingest_metrics(raw, ingest.classify(raw))),
    "i11_dead_letter_summary": on_messages(
        lambda raw: ingest.dead_letter_summary(ingest.rejected(ingest.classify(raw)))),
    "i12_replay_late": on_messages(replayed(replay.recomputed_hours)),
    "i12_replay_days": on_messages(replayed(replay.recomputed_days)),
}


def streamed_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = streams.read_folder(spark, testdata.raw_event_folder(spark, sf_dir))
    return jobs.drain(events, scratch_path(spark, "stream-copy"))


def backfilled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outcome counts of the warehouse stream reading a whole log with the lateness test switched off."""
    folder = scratch_path(spark, "backfill")
    events = streams.read_folder(spark, testdata.raw_event_folder(spark, sf_dir))
    jobs.start_warehouse(events, folder, BACKFILL_LATENESS_S).awaitTermination()
    rejects = ingest.dead_letter_summary(deadletter.read_dead_letters(spark, f"{folder}/dead_letters"))
    taken = fact.read_fact(spark, f"{folder}/fact").agg(F.count(F.lit(1)).alias("events"))
    return rejects.unionByName(taken.select(F.lit("accepted").alias("rule"), "events"))


def stored_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "fact")
    fact.write_fact(testdata.charging_events(spark, sf_dir), path)
    return plain_times(fact.read_fact(spark, path).select(*FACT_NAMES, "event_month"))


def stored_dead_letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "dead-letters")
    judged = ingest.classify(testdata.raw_events(spark, sf_dir))
    deadletter.write_dead_letters(ingest.rejected(judged), path)
    stored = deadletter.read_dead_letters(spark, path)
    return plain_times(stored.select("reason", "event_id", "event_type", "timestamp", "station_id", "raw_event"))


def exported(day: date | None) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        path = scratch_path(spark, "export")
        export.export(testdata.charging_events(spark, sf_dir), path, day)
        return plain_times(spark.read.parquet(path))

    return run


def fanned_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two consumers of one stream, each with its own progress: events per type as each has counted them."""
    folder = scratch_path(spark, "fanout")
    source = testdata.raw_event_folder(spark, sf_dir)
    warehouse = jobs.start_warehouse(
        streams.read_folder(spark, source), f"{folder}/warehouse", run_as_backfill=True)
    live = jobs.start_live(streams.read_folder(spark, source), f"{folder}/live", run_as_backfill=True)
    for query in (warehouse, live):
        query.awaitTermination()
    taken = state.event_counts(fact.read_fact(spark, f"{folder}/warehouse/fact"))
    counted = tables.read_partials(spark, f"{folder}/live/live", tables.LIVE_PARTIALS, "event_counts")
    return taken.withColumn("consumer", F.lit("warehouse")).unionByName(
        counted.withColumn("consumer", F.lit("live")))


_warehouses: dict[tuple[str, str], str] = {}


def warehouse_of(spark: SparkSession, sf_dir: str) -> str:
    """Folder of a warehouse with the events of the tables in two loads; made once per application."""
    made = (spark.sparkContext.applicationId, sf_dir)
    if made not in _warehouses:
        folder = scratch_path(spark, "warehouse")
        facts = testdata.charging_events(spark, sf_dir)
        for load, share in (("even", 0), ("odd", 1)):
            jobs.load_facts(spark, folder, facts.filter(F.col("event_id").cast("bigint") % 2 == share), load)
        _warehouses[made] = folder
    return _warehouses[made]


def on_stored(question: Callable[[StoredAnalytics], DataFrame]) -> Query:
    return lambda spark, sf_dir: plain_times(question(StoredAnalytics(spark, warehouse_of(spark, sf_dir))))


STORED: dict[str, Query] = {
    "q1_stored": on_stored(StoredAnalytics.revenue_by_network),
    "q2_stored": on_stored(StoredAnalytics.sessions_per_hour),
    "q3_stored": on_stored(StoredAnalytics.charger_utilization),
    "q4_stored": on_stored(StoredAnalytics.top_cities_by_energy),
    "q5_stored": on_stored(StoredAnalytics.error_analysis),
    "q6_stored": on_stored(StoredAnalytics.vehicle_type_breakdown),
    "q7_stored": on_stored(StoredAnalytics.real_time_throughput),
    "q8_stored": on_stored(StoredAnalytics.session_duration_distribution),
    "q9_stored": on_stored(StoredAnalytics.peak_hours),
    "q10_stored": on_stored(StoredAnalytics.network_error_rate),
    "q11_stored": on_stored(StoredAnalytics.revenue_per_kwh),
    "q12_stored": on_stored(StoredAnalytics.country_summary),
    "a1_stored": on_stored(StoredAnalytics.hourly_energy_7days),
    "a5_stored": on_stored(StoredAnalytics.fault_geography),
    "a6_stored": on_stored(StoredAnalytics.anomalies),
    "d1_stored": on_stored(StoredAnalytics.kpi_cover),
    "d7_stored": on_stored(StoredAnalytics.anomaly_summary),
    "m3_stored": on_stored(StoredAnalytics.errors_daily),
    "u1_stored": on_stored(StoredAnalytics.total_events),
}

_panels: dict[tuple[str, str], str] = {}


def live_tables_of(spark: SparkSession, sf_dir: str) -> str:
    """Folder of the live tables after the stream of the tables' events, as messages, in four micro-batches; made once per
    application."""
    made = (spark.sparkContext.applicationId, sf_dir)
    if made not in _panels:
        folder, source = scratch_path(spark, "live"), scratch_path(spark, "messages")
        facts = testdata.charging_events(spark, sf_dir).withColumn("arrival", F.col("event_id").cast("bigint"))
        messages = facts.select("arrival", export.encoded().alias("raw"))
        messages.repartition(4, "arrival").write.parquet(source)
        events = streams.read_folder(spark, source, files_per_trigger=1)
        jobs.start_live(events, folder, run_as_backfill=True).awaitTermination()
        _panels[made] = folder
    return _panels[made]


def on_panel(read: Callable[[LivePanel], DataFrame]) -> Query:
    return lambda spark, sf_dir: plain_times(read(LivePanel(spark, live_tables_of(spark, sf_dir))))


PANEL: dict[str, Query] = {
    "t1_panel": on_panel(LivePanel.event_counters),
    "t4_panel": on_panel(lambda p: p.active_by("network_id")),
    "t5_panel": on_panel(lambda p: p.active_by("city")),
    "t6_panel": on_panel(LivePanel.active_global),
    "t7_panel": on_panel(lambda p: p.leaderboard("station_id")),
    "t8_panel": on_panel(lambda p: p.leaderboard("network_id")),
    "t9_panel": on_panel(lambda p: p.leaderboard("city")),
    "t10_panel": on_panel(LivePanel.leaderboard_top),
    "t11_panel": on_panel(LivePanel.energy_daily),
    "t12_panel": on_panel(lambda p: p.energy_daily("network_id")),
    "t13_panel": on_panel(LivePanel.fault_counters),
    "t14_panel": on_panel(LivePanel.faults_network_daily),
    "t15_panel": on_panel(LivePanel.status_counts),
    "t16_panel": on_panel(LivePanel.kpis),
}

STORAGE: dict[str, Query] = {
    "s1_event_source": streamed_messages,
    "s2_backfill_mode": backfilled,
    "s3_fact_append": stored_fact,
    "s4_dead_letter_sink": stored_dead_letters,
    "s5_export_day": exported(date(2024, 1, 15)),
    "s5_export_all": exported(None),
    "s6_retention": on_events(lambda df: fact.retain(df, days=10).select("event_id", "timestamp")),
    "s7_fanout": fanned_out,
    "s8_encode_publish": on_events(export.encode),
}


def queries() -> dict[str, Query]:
    return {**ANALYTICS, **ROLLUPS, **STATE, **REPORT, **QUALITY, **INGEST, **STORED, **PANEL, **STORAGE}
