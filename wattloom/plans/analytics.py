"""The analytical questions over the fact table: one function per question, one DataFrame per answer."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from wattloom.functions.numeric import count_where, mean_power, n_rows, ratio, ravg, rnd, rsum
from wattloom.functions.windows import AsOf, hour_bucket, reference_time, trailing
from wattloom.operators.rollups import sessions_hourly
from wattloom.schema import FAULT, START, STOP


def _stops(df: DataFrame) -> DataFrame:
    return df.filter(F.col("event_type") == STOP)


def _timed_stops(df: DataFrame) -> DataFrame:
    return _stops(df).filter(F.col("duration_minutes") > 0)


def _faults(df: DataFrame) -> DataFrame:
    return df.filter(F.col("event_type") == FAULT)


def _avg_power() -> Column:
    return rnd(F.avg(mean_power()), 1)


def revenue_by_network(df: DataFrame, *, as_of: AsOf = None, days: int = 7, limit: int | None = None) -> DataFrame:
    out = (
        _stops(trailing(df, as_of, days=days))
        .groupBy("network_id")
        .agg(
            n_rows().alias("session_count"),
            rsum("revenue_eur").alias("total_revenue_eur"),
            rsum("energy_kwh").alias("total_energy_kwh"),
            ravg("duration_minutes", 1).alias("avg_duration_min"),
            ravg("revenue_eur").alias("avg_revenue_per_session"),
        )
        .orderBy(F.desc("total_revenue_eur"), "network_id")
    )
    return out if limit is None else out.limit(limit)


def sessions_per_hour(df: DataFrame, *, as_of: AsOf = None, hours: int = 24) -> DataFrame:
    return (
        _timed_stops(trailing(df, as_of, hours=hours))
        .groupBy(hour_bucket().alias("hour"))
        .agg(
            n_rows().alias("session_count"),
            rsum("energy_kwh").alias("total_energy_kwh"),
            rsum("revenue_eur").alias("total_revenue_eur"),
            _avg_power().alias("avg_power_kw"),
        )
        .orderBy("hour")
    )


def charger_utilization(df: DataFrame) -> DataFrame:
    return (
        _timed_stops(df)
        .groupBy("charger_type")
        .agg(
            n_rows().alias("session_count"),
            ravg("duration_minutes", 1).alias("avg_duration_min"),
            _avg_power().alias("avg_power_kw"),
            ravg("energy_kwh").alias("avg_energy_kwh"),
            rsum("revenue_eur").alias("total_revenue_eur"),
            ravg("revenue_eur").alias("avg_revenue_per_session"),
        )
        .orderBy(F.desc("session_count"), "charger_type")
    )


def top_cities_by_energy(df: DataFrame, *, limit: int = 10) -> DataFrame:
    return (
        _stops(df)
        .groupBy("city", "country")
        .agg(
            n_rows().alias("session_count"),
            rsum("energy_kwh").alias("total_energy_kwh"),
            rsum("revenue_eur").alias("total_revenue_eur"),
            F.count_distinct("station_id").alias("unique_stations"),
        )
        .orderBy(F.desc("total_energy_kwh"), "city", "country")
        .limit(limit)
    )


def error_analysis(df: DataFrame, *, limit: int | None = None) -> DataFrame:
    all_faults = _faults(df).agg(n_rows().alias("n")).scalar()
    out = (
        _faults(df)
        .filter(F.col("error_code") != "")
        .groupBy("error_code")
        .agg(
            n_rows().alias("occurrences"),
            F.count_distinct("station_id").alias("affected_stations"),
            F.count_distinct("network_id").alias("affected_networks"),
        )
        .withColumn("pct_of_errors", rnd(ratio(F.lit(100.0) * F.col("occurrences"), all_faults), 2))
        .orderBy(F.desc("occurrences"), "error_code")
    )
    return out if limit is None else out.limit(limit)


def vehicle_type_breakdown(df: DataFrame) -> DataFrame:
    return (
        _timed_stops(df)
        .groupBy("vehicle_type")
        .agg(
            n_rows().alias("session_count"),
            ravg("energy_kwh").alias("avg_energy_kwh"),
            ravg("duration_minutes", 1).alias("avg_duration_min"),
            rsum("revenue_eur").alias("total_revenue_eur"),
            _avg_power().alias("avg_power_kw"),
        )
        .orderBy(F.desc("session_count"), "vehicle_type")
    )


def real_time_throughput(df: DataFrame, *, as_of: AsOf = None, minutes: int = 5) -> DataFrame:
    """One row for the last minutes, over all event types; zeros when there were none."""
    return trailing(df, as_of, minutes=minutes).agg(
        F.lit(minutes).cast("int").alias("period_minutes"),
        n_rows().alias("event_count"),
        F.count_distinct("session_id").alias("unique_sessions"),
        F.count_distinct("station_id").alias("active_stations"),
        F.coalesce(rsum("revenue_eur"), F.lit(0.0)).alias("revenue_eur"),
        F.coalesce(rsum("energy_kwh"), F.lit(0.0)).alias("energy_kwh"),
        F.coalesce(rnd(ratio(n_rows(), F.lit(minutes * 60)), 1), F.lit(0.0)).alias("events_per_second"),
    )


def session_duration_distribution(df: DataFrame) -> DataFrame:
    minutes = F.col("duration_minutes")
    # The duration classes and their labels.
    bucket = (
        F.when(minutes < 15, "< 15 min")
        .when(minutes < 30, "15–30 min")
        .when(minutes < 60, "30–60 min")
        .when(minutes < 120, "1–2 hours")
        .otherwise(">= 2 hours")
    )
    return (
        _stops(df)
        .groupBy(bucket.alias("bucket"))
        .agg(
            n_rows().alias("sessions"),
            ravg("energy_kwh").alias("avg_energy_kwh"),
            ravg("revenue_eur").alias("avg_revenue_eur"),
            F.min("duration_minutes").alias("_shortest"),
        )
        .orderBy("_shortest")
        .drop("_shortest")
    )


def peak_hours(df: DataFrame) -> DataFrame:
    return (
        _timed_stops(df)
        .groupBy(F.hour("timestamp").alias("hour_of_day"))
        .agg(
            n_rows().alias("session_count"),
            ravg("energy_kwh").alias("avg_energy_kwh"),
            _avg_power().alias("avg_power_kw"),
            rsum("revenue_eur").alias("total_revenue_eur"),
        )
        .orderBy("hour_of_day")
    )


def network_error_rate(df: DataFrame) -> DataFrame:
    errors = count_where(F.col("event_type") == FAULT)
    return (
        df.groupBy("network_id")
        .agg(
            errors.alias("error_count"),
            n_rows().alias("total_events"),
            rnd(ratio(F.lit(100.0) * errors, n_rows()), 3).alias("error_rate_pct"),
        )
        .orderBy(F.desc("error_rate_pct"), "network_id")
    )


def revenue_per_kwh(df: DataFrame) -> DataFrame:
    return (
        _stops(df)
        .filter(F.col("energy_kwh") > 0)
        .groupBy("charger_type")
        .agg(
            rnd(ratio(F.sum("revenue_eur"), F.sum("energy_kwh")), 4).alias("revenue_per_kwh"),
            ravg("price_per_kwh", 4).alias("avg_listed_price"),
            n_rows().alias("session_count"),
        )
        .orderBy(F.desc("revenue_per_kwh"), "charger_type")
    )


def country_summary(df: DataFrame) -> DataFrame:
    return (
        _stops(df)
        .groupBy("country")
        .agg(
            n_rows().alias("session_count"),
            F.count_distinct("station_id").alias("station_count"),
            rsum("energy_kwh").alias("total_energy_kwh"),
            rsum("revenue_eur").alias("total_revenue_eur"),
            ravg("duration_minutes", 1).alias("avg_session_min"),
        )
        .orderBy(F.desc("total_energy_kwh"), "country")
    )


def vehicle_brand_breakdown(df: DataFrame, *, limit: int = 20) -> DataFrame:
    return (
        _stops(df)
        .filter(F.col("vehicle_brand") != "")
        .groupBy("vehicle_brand")
        .agg(
            n_rows().alias("session_count"),
            ravg("energy_kwh").alias("avg_energy_kwh"),
            rsum("energy_kwh").alias("total_energy_kwh"),
            ravg("duration_minutes", 1).alias("avg_duration_min"),
            rsum("revenue_eur").alias("total_revenue_eur"),
        )
        .orderBy(F.desc("total_energy_kwh"), "vehicle_brand")
        .limit(limit)
    )


def tariff_analysis(df: DataFrame, *, limit: int = 20) -> DataFrame:
    return (
        _stops(df)
        .filter(F.col("tariff_id") != "")
        .groupBy("tariff_id")
        .agg(
            n_rows().alias("session_count"),
            ravg("revenue_eur").alias("avg_revenue_per_session"),
            rsum("revenue_eur").alias("total_revenue_eur"),
            ravg("energy_kwh").alias("avg_energy_kwh"),
            ravg("price_per_kwh", 4).alias("avg_price_per_kwh"),
        )
        .orderBy(F.desc("total_revenue_eur"), "tariff_id")
        .limit(limit)
    )


def label_extremes(hourly: DataFrame) -> DataFrame:
    """PEAK on every row equal to the maximum energy, LOW on every row equal to the minimum, PEAK if both.

    The window has no key: its input is one row per hour of a week, 169 at most.
    """
    everything = Window.partitionBy(F.lit(0))
    energy = F.col("total_energy_kwh")
    label = (
        F.when(energy == F.max("total_energy_kwh").over(everything), "PEAK")
        .when(energy == F.min("total_energy_kwh").over(everything), "LOW")
        .otherwise("")
    )
    return hourly.withColumn("label", label)


def hourly_energy_week(hourly_rollup: DataFrame, now: Column) -> DataFrame:
    """The last seven days by hour, re-aggregated from the hourly session rollup."""
    hourly = (
        hourly_rollup.filter(F.col("hour") >= now - F.expr("INTERVAL 7 DAYS"))
        .groupBy("hour")
        .agg(
            F.sum("session_count").alias("session_count"),
            rsum("total_energy_kwh").alias("total_energy_kwh"),
            rsum("total_revenue_eur").alias("total_revenue_eur"),
        )
    )
    return label_extremes(hourly).orderBy("hour")


def hourly_energy_7days(df: DataFrame, *, as_of: AsOf = None, rollup: DataFrame | None = None) -> DataFrame:
    """`rollup` is the stored hourly rollup; without one it is computed from the fact table."""
    if rollup is None:
        # An hour of the week has no rows from before it, so older ones need not be read.
        rollup = sessions_hourly(trailing(df, as_of, days=7))
    return hourly_energy_week(rollup, reference_time(df, as_of))


def _ranked(df: DataFrame, *order, limit: int | None) -> DataFrame:
    return df if limit is None else df.orderBy(*order).limit(limit)


def station_uptime(df: DataFrame, *, limit: int | None = 20) -> DataFrame:
    """The worst stations; all with a fault if `limit` is None."""
    starts = count_where(F.col("event_type") == START)
    faults = count_where(F.col("event_type") == FAULT)
    return (
        df.groupBy("station_id", "network_id", "city")
        .agg(
            starts.alias("session_starts"),
            faults.alias("fault_events"),
            n_rows().alias("total_events"),
            rnd(ratio(F.lit(100.0) * faults, n_rows()), 3).alias("fault_rate_pct"),
            rnd(ratio(F.lit(100.0) * starts, starts + faults), 1).alias("uptime_pct"),
        )
        .filter(F.col("fault_events") > 0)
        .transform(_ranked, F.desc("fault_rate_pct"), "station_id", "network_id", "city", limit=limit)
    )


def brand_comparison(df: DataFrame) -> DataFrame:
    return (
        _timed_stops(df)
        .filter(F.col("vehicle_brand") != "")
        .groupBy(F.when(F.col("vehicle_brand") == "Tesla", "Tesla").otherwise("Other Brands").alias("brand_group"))
        .agg(
            n_rows().alias("session_count"),
            ravg("duration_minutes", 1).alias("avg_duration_min"),
            ravg("energy_kwh").alias("avg_energy_kwh"),
            _avg_power().alias("avg_power_kw"),
            rsum("energy_kwh").alias("total_energy_kwh"),
            rsum("revenue_eur").alias("total_revenue_eur"),
            ravg("revenue_eur").alias("avg_revenue_per_session"),
        )
        .orderBy("brand_group")
    )


# The three tariff periods, in report order.
MORNING, EVENING, OFF_PEAK = "Morning Peak (07-09)", "Evening Peak (17-20)", "Off-Peak"


def peak_hour_revenue(df: DataFrame) -> DataFrame:
    """All three periods, zero-filled, with their share of revenue.

    The share uses a window without a key over the three literal rows.
    """
    hour = F.hour("timestamp")
    period = F.when(hour.isin(7, 8), MORNING).when(hour.isin(17, 18, 19), EVENING).otherwise(OFF_PEAK)
    actuals = (
        _stops(df)
        .groupBy(period.alias("period"))
        .agg(
            n_rows().alias("session_count"),
            rsum("revenue_eur").alias("total_revenue_eur"),
            rsum("energy_kwh").alias("total_energy_kwh"),
            ravg("energy_kwh").alias("avg_energy_kwh"),
            ravg("revenue_eur").alias("avg_revenue_per_session"),
        )
    )
    periods = df.sparkSession.sql(
        f"SELECT * FROM VALUES ('{MORNING}', 1), ('{EVENING}', 2), ('{OFF_PEAK}', 3) AS t(period, sort_order)"
    )
    filled = periods.join(F.broadcast(actuals), "period", "left").select(
        "period",
        "sort_order",
        F.coalesce("session_count", F.lit(0)).alias("session_count"),
        *[
            F.coalesce(name, F.lit(0.0)).alias(name)
            for name in ("total_revenue_eur", "total_energy_kwh", "avg_energy_kwh", "avg_revenue_per_session")
        ],
    )
    grand = F.sum("total_revenue_eur").over(Window.partitionBy(F.lit(0)))
    share = F.col("total_revenue_eur") / F.when(grand == 0, F.lit(1.0)).otherwise(grand) * F.lit(100.0)
    return filled.withColumn("revenue_pct", rnd(share, 1)).orderBy("sort_order").drop("sort_order")


def fault_geography(df: DataFrame, *, limit: int | None = 20) -> DataFrame:
    """The cities with most faults; all if `limit` is None."""
    per_city = (
        _faults(df)
        .groupBy("city", "country")
        .agg(
            n_rows().alias("fault_count"),
            F.count_distinct("station_id").alias("affected_stations"),
            F.count_distinct("error_code").alias("distinct_error_types"),
        )
    )
    all_faults = per_city.agg(F.sum("fault_count").alias("n")).scalar()
    return (
        per_city.withColumn("pct_of_all_faults", rnd(ratio(F.lit(100.0) * F.col("fault_count"), all_faults), 2))
        .withColumn("faults_per_station", rnd(ratio(F.col("fault_count"), F.col("affected_stations")), 2))
        .transform(_ranked, F.desc("fault_count"), "city", "country", limit=limit)
    )


def anomalies(df: DataFrame, *, limit: int | None = 20, fleet: tuple[float | None, float | None] | None = None) -> DataFrame:
    """Stops whose mean power lies more than two population standard deviations from the fleet mean; the farthest ones,
    all if `limit` is None. With `fleet`, mean and deviation known already, the facts are read once."""
    sessions = _timed_stops(df).select(
        "event_id", "session_id", "station_id", "network_id", "city", "vehicle_brand",
        rnd(mean_power(), 2).alias("power_kw"),
        "energy_kwh", "duration_minutes", "revenue_eur",
    )
    if fleet is None:
        both = F.struct(F.avg("power_kw").alias("mean"), F.stddev_pop("power_kw").alias("std"))
        found = sessions.agg(both.alias("fleet")).scalar()
        mean, std = found["mean"], found["std"]
    else:
        mean, std = (F.lit(value).cast("double") for value in fleet)
    return (
        sessions.filter(F.abs(F.col("power_kw") - mean) > F.lit(2.0) * std)
        .select(
            "session_id", "station_id", "network_id", "city", "vehicle_brand", "power_kw",
            rnd(F.col("energy_kwh"), 2).alias("energy_kwh"),
            "duration_minutes",
            rnd(F.col("revenue_eur"), 2).alias("revenue_eur"),
            rnd(mean, 2).alias("fleet_mean_power"),
            rnd(std, 2).alias("fleet_std_power"),
            rnd(ratio(F.col("power_kw") - mean, std), 2).alias("z_score"),
            "event_id",
        )
        .transform(_ranked, F.desc(F.abs("z_score")), "event_id", limit=limit)
        .drop("event_id")
    )


def total_events(df: DataFrame) -> DataFrame:
    return df.agg(n_rows().alias("total"))
