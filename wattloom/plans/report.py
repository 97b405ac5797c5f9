"""Figures the report pages and panels derive from the analytical answers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from wattloom.functions.numeric import count_where, n_rows, ratio, rnd
from wattloom.functions.windows import AsOf
from wattloom.plans import analytics
from wattloom.schema import STOP
from wattloom.session import materialize


def kpi_cover(df: DataFrame, *, as_of: AsOf = None) -> DataFrame:
    """One row: all-time total, the last five minutes, and revenue and energy of the last 30 days."""
    month = analytics.revenue_by_network(df, as_of=as_of, days=30).agg(
        F.struct(
            F.coalesce(rnd(F.sum("total_revenue_eur"), 2), F.lit(0.0)).alias("revenue"),
            F.coalesce(rnd(F.sum("total_energy_kwh"), 2), F.lit(0.0)).alias("energy"),
        )
    ).scalar()
    return analytics.real_time_throughput(df, as_of=as_of, minutes=5).select(
        analytics.total_events(df).scalar().alias("total_events"),
        "events_per_second", "active_stations", "unique_sessions",
        month["revenue"].alias("revenue_30d_eur"),
        month["energy"].alias("energy_30d_kwh"),
    )


def hour_bands(df: DataFrame) -> DataFrame:
    hour = F.col("hour_of_day")
    # Bands of hours and their labels.
    band = (
        F.when((hour >= 7) & (hour < 9), "Morning Peak")
        .when((hour >= 12) & (hour < 14), "Lunch Peak")
        .when((hour >= 17) & (hour < 20), "Evening Peak")
        .otherwise("Off-Peak")
    )
    return analytics.peak_hours(df).withColumn("band", band)


def station_flags(df: DataFrame, *, threshold: float = 0.5, limit: int = 20) -> DataFrame:
    """The worst stations with their bands and, on every row, how many of all stations with a fault exceed the threshold."""
    uptime = F.col("uptime_pct")
    above = F.col("fault_rate_pct") > threshold
    stations = materialize(analytics.station_uptime(df, limit=None), "station-flags")  # one row per station with a fault
    counts = stations.agg(F.struct(count_where(above).alias("above"), n_rows().alias("listed")).alias("counts")).scalar()
    return (
        stations.orderBy(F.desc("fault_rate_pct"), "station_id", "network_id", "city").limit(limit)
        .withColumn("above_threshold", above)
        .withColumn("uptime_band", F.when(uptime >= 90, "good").when(uptime >= 70, "fair").otherwise("poor"))
        .withColumn("stations_above", counts["above"])
        .withColumn("stations_listed", counts["listed"])
    )


def brand_delta(df: DataFrame) -> DataFrame:
    """Tesla less all others; no row unless both groups exist."""
    def of(group: str, name: str) -> Column:
        return F.max(F.when(F.col("brand_group") == group, F.col(name)))

    def delta(name: str, digits: int, alias: str) -> Column:
        return rnd(of("Tesla", name) - of("Other Brands", name), digits).alias(alias)

    return (
        analytics.brand_comparison(df)
        .agg(
            n_rows().alias("_groups"),
            delta("avg_duration_min", 1, "delta_duration_min"),
            delta("avg_energy_kwh", 2, "delta_energy_kwh"),
            delta("avg_power_kw", 1, "delta_power_kw"),
            delta("avg_revenue_per_session", 2, "delta_revenue_per_session"),
        )
        .filter("_groups = 2")
        .drop("_groups")
    )


def peak_share(df: DataFrame) -> DataFrame:
    peak = F.when(F.col("period") != analytics.OFF_PEAK, F.col("revenue_pct"))
    return analytics.peak_hour_revenue(df).agg(rnd(F.sum(peak), 1).alias("peak_revenue_pct"))


def worst_density_city(df: DataFrame) -> DataFrame:
    return (
        analytics.fault_geography(df, limit=None)
        .orderBy(F.desc("faults_per_station"), F.desc("fault_count"), "city", "country")
        .limit(1)
    )


def anomaly_summary(df: DataFrame) -> DataFrame:
    """Counts over all anomalies; nothing when there are none."""
    stops = df.filter((F.col("event_type") == STOP) & (F.col("duration_minutes") > 0)).agg(n_rows()).scalar()
    return summarised(analytics.anomalies(df, limit=None), stops)


def summarised(anomalies: DataFrame, stops: Column) -> DataFrame:
    """The summary of all anomalies among a number of stops with a duration."""
    return (
        anomalies
        .agg(
            n_rows().alias("anomalies"),
            count_where(F.col("z_score") > 0).alias("high"),
            F.max("fleet_mean_power").alias("fleet_mean_power"),
            F.max("fleet_std_power").alias("fleet_std_power"),
        )
        .filter("anomalies > 0")
        .select(
            "anomalies",
            rnd(ratio(F.lit(100.0) * F.col("anomalies"), stops), 2).alias("anomaly_pct"),
            "high",
            (F.col("anomalies") - F.col("high")).alias("low"),
            "fleet_mean_power", "fleet_std_power",
        )
    )


def relative_load(answer: DataFrame, value: str) -> DataFrame:
    """Adds value / maximum, 0 when the maximum is 0. For answers of a fixed small number of rows only."""
    top = F.max(value).over(Window.partitionBy(F.lit(0)))
    return answer.withColumn("relative_load", F.coalesce(rnd(ratio(F.col(value), top), 4), F.lit(0.0)))


def load_bars(df: DataFrame, *, as_of: AsOf = None) -> DataFrame:
    """The three bar charts: hours of the day by sessions, hours of the week by energy, periods by revenue."""
    def bars(chart: str, answer: DataFrame, label: Column, value: str) -> DataFrame:
        return relative_load(answer, value).select(
            F.lit(chart).alias("chart"), label.alias("label"), F.col(value).cast("double").alias("value"), "relative_load"
        )

    hours = bars("hour_of_day", analytics.peak_hours(df), F.col("hour_of_day").cast("string"), "session_count")
    week = bars(
        "hourly_energy", analytics.hourly_energy_7days(df, as_of=as_of),
        F.date_format("hour", "yyyy-MM-dd HH:mm:ss"), "total_energy_kwh",
    )
    periods = bars("period", analytics.peak_hour_revenue(df), F.col("period"), "total_revenue_eur")
    return hours.unionByName(week).unionByName(periods)


# The live panels are the same questions with panel parameters.
PANELS = {
    "networks": lambda df, as_of=None: analytics.revenue_by_network(df, as_of=as_of, days=1, limit=6),
    "cities": lambda df, as_of=None: analytics.top_cities_by_energy(df, limit=8),
    "errors": lambda df, as_of=None: analytics.error_analysis(df, limit=6),
    "brands": lambda df, as_of=None: analytics.vehicle_brand_breakdown(df, limit=8),
    "tariffs": lambda df, as_of=None: analytics.tariff_analysis(df, limit=8),
    "hours": lambda df, as_of=None: analytics.sessions_per_hour(df, as_of=as_of, hours=48),
}
