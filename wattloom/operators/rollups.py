"""Hourly and daily rollups.

Each rollup is additive: partial rows of several batches are combined by `combine`, which is also how a stored
rollup is read. A distinct count is not additive, so the error rollup is kept as its set of members.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from wattloom.functions.numeric import count_where, mean_power, n_rows, rnd
from wattloom.functions.windows import day_bucket, hour_bucket
from wattloom.schema import FAULT, STOP

HOURLY_KEYS = ["hour", "network_id", "city", "country", "charger_type"]
STATION_KEYS = ["day", "station_id", "network_id", "city", "country", "charger_type"]
ERROR_KEYS = ["day", "error_code", "network_id"]
NETWORK_KEYS = ["day", "network_id"]


def _sum_of(name: str, alias: str) -> Column:
    return F.sum(name).alias(alias)


def sessions_hourly(df: DataFrame) -> DataFrame:
    return (
        df.filter(F.col("event_type") == STOP)
        .groupBy(hour_bucket().alias("hour"), *HOURLY_KEYS[1:])
        .agg(
            n_rows().alias("session_count"),
            _sum_of("energy_kwh", "total_energy_kwh"),
            _sum_of("revenue_eur", "total_revenue_eur"),
            _sum_of("duration_minutes", "total_duration_minutes"),
            _sum_of("power_kw", "sum_power_kw"),
        )
    )


def station_daily(df: DataFrame) -> DataFrame:
    return (
        df.filter(F.col("event_type") == STOP)
        .groupBy(day_bucket().alias("day"), *STATION_KEYS[1:])
        .agg(
            n_rows().alias("session_count"),
            _sum_of("energy_kwh", "total_energy_kwh"),
            _sum_of("revenue_eur", "total_revenue_eur"),
            _sum_of("duration_minutes", "total_duration_minutes"),
        )
    )


def network_revenue_daily(df: DataFrame) -> DataFrame:
    return (
        df.filter(F.col("event_type") == STOP)
        .groupBy(day_bucket().alias("day"), "network_id")
        .agg(
            n_rows().alias("session_count"),
            _sum_of("revenue_eur", "total_revenue_eur"),
            _sum_of("energy_kwh", "total_energy_kwh"),
        )
    )


def error_members_daily(df: DataFrame) -> DataFrame:
    """The additive form of the error rollup: faults per day, code, network and station."""
    return (
        df.filter((F.col("event_type") == FAULT) & (F.col("error_code") != ""))
        .groupBy(day_bucket().alias("day"), "error_code", "network_id", "station_id")
        .agg(n_rows().alias("error_count"))
    )


def errors_from_members(members: DataFrame) -> DataFrame:
    """Sum the counts and count the distinct stations, whatever number of partial rows a station has."""
    return (
        combine(members, [*ERROR_KEYS, "station_id"])
        .groupBy(*ERROR_KEYS)
        .agg(F.sum("error_count").alias("error_count"), n_rows().alias("affected_stations"))
    )


def errors_daily(df: DataFrame) -> DataFrame:
    return errors_from_members(error_members_daily(df))


STOP_HOUR_KEYS = ["hour", "network_id", "city", "country", "charger_type", "vehicle_type"]
LENGTH_KEYS = ["day", "length_class"]
MOMENT_KEYS = ["day"]
EVENT_HOUR_KEYS = ["hour", "network_id", "event_type"]
# Lower bounds, in minutes, of the duration classes after the first.
LENGTH_BOUNDS = (15, 30, 60, 120)


def stops_hourly(df: DataFrame) -> DataFrame:
    """Sums and counts from which the averages over all stops, over those with a duration (timed) and over those with
    energy (charged) follow for any whole hours."""
    timed, charged = F.col("duration_minutes") > 0, F.col("energy_kwh") > 0

    def part(condition: Column, value: Column | str, alias: str) -> Column:
        value = F.col(value) if isinstance(value, str) else value
        return F.coalesce(F.sum(F.when(condition, value)), F.lit(0).cast("double")).alias(alias)

    return (
        df.filter(F.col("event_type") == STOP)
        .groupBy(hour_bucket().alias("hour"), *STOP_HOUR_KEYS[1:])
        .agg(
            n_rows().alias("stops"), _sum_of("energy_kwh", "energy"), _sum_of("revenue_eur", "revenue"),
            _sum_of("duration_minutes", "minutes"),
            count_where(timed).alias("timed"), part(timed, "energy_kwh", "timed_energy"),
            part(timed, "revenue_eur", "timed_revenue"), part(timed, "duration_minutes", "timed_minutes"),
            part(timed, mean_power(), "timed_power"),
            count_where(charged).alias("charged"), part(charged, "energy_kwh", "charged_energy"),
            part(charged, "revenue_eur", "charged_revenue"), part(charged, "price_per_kwh", "charged_price"),
        )
    )


def stop_lengths_daily(df: DataFrame) -> DataFrame:
    """Stops by class of duration, 0 being the shortest."""
    length = sum((F.when(F.col("duration_minutes") >= bound, 1).otherwise(0) for bound in LENGTH_BOUNDS), F.lit(0))
    return (
        df.filter(F.col("event_type") == STOP)
        .groupBy(day_bucket().alias("day"), length.alias("length_class"))
        .agg(n_rows().alias("stops"), _sum_of("energy_kwh", "energy"), _sum_of("revenue_eur", "revenue"))
    )


def power_moments_daily(df: DataFrame) -> DataFrame:
    """Number, sum and sum of squares of the mean power of a day's timed stops, to the hundredth: decimals, so that any
    order of adding days up gives the same mean and deviation."""
    power = rnd(mean_power(), 2).cast("decimal(15,2)")
    return (
        df.filter((F.col("event_type") == STOP) & (F.col("duration_minutes") > 0))
        .groupBy(day_bucket().alias("day"))
        .agg(F.count(power).alias("timed"), F.sum(power.cast("decimal(28,2)")).alias("power"),
             F.sum((power * power).cast("decimal(28,4)")).alias("power_squared"))
    )


def events_hourly(df: DataFrame) -> DataFrame:
    return df.groupBy(hour_bucket().alias("hour"), *EVENT_HOUR_KEYS[1:]).agg(n_rows().alias("events"))


def combine(partials: DataFrame, keys: list[str]) -> DataFrame:
    """Add up partial rollup rows per key; every non-key column is a measure."""
    measures = [name for name in partials.columns if name not in keys]
    return partials.groupBy(*keys).agg(*[_sum_of(name, name) for name in measures])


def hourly_totals(hourly: DataFrame) -> DataFrame:
    """The hourly rollup read back at hour grain."""
    return combine(hourly.drop("network_id", "city", "country", "charger_type"), ["hour"])


# name -> (keys of the stored partial rows, partial rows of one batch)
STORED_ROLLUPS = {
    "sessions_hourly": (HOURLY_KEYS, sessions_hourly),
    "station_daily": (STATION_KEYS, station_daily),
    "error_members_daily": ([*ERROR_KEYS, "station_id"], error_members_daily),
    "network_revenue_daily": (NETWORK_KEYS, network_revenue_daily),
    "stops_hourly": (STOP_HOUR_KEYS, stops_hourly),
    "stop_lengths_daily": (LENGTH_KEYS, stop_lengths_daily),
    "power_moments_daily": (MOMENT_KEYS, power_moments_daily),
    "events_hourly": (EVENT_HOUR_KEYS, events_hourly),
}
