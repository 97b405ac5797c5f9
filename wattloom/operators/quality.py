"""Data-quality reports over sessions, stations and traffic."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from wattloom.functions.numeric import count_where, n_rows, ratio, rnd
from wattloom.functions.windows import time_cell
from wattloom.schema import CHARGER_POWER_BOUNDS, EVENT_TYPES, METER, PEAK_WINDOWS, SESSION_EVENT_TYPES, START, STOP


def _is(event_type: str) -> Column:
    return F.col("event_type") == event_type


def _session_events(df: DataFrame) -> DataFrame:
    return df.filter((F.col("session_id") != "") & F.col("event_type").isin(*SESSION_EVENT_TYPES))


def session_lifecycle(df: DataFrame) -> DataFrame:
    """One row per session id."""
    position = F.struct("timestamp", "event_id")
    closing = F.when(_is(STOP), position)
    return (
        _session_events(df)
        .groupBy("session_id")
        .agg(
            F.min(F.when(_is(START), F.col("timestamp"))).alias("first_start"),
            F.max(F.when(_is(STOP), F.col("timestamp"))).alias("last_stop"),
            count_where(_is(METER)).alias("meter_updates"),
            F.min_by("soc_percent", position).alias("first_soc"),
            F.max_by("soc_percent", position).alias("last_soc"),
            F.max_by("energy_kwh", closing).alias("final_energy_kwh"),
            F.max_by("revenue_eur", closing).alias("final_revenue_eur"),
        )
        .withColumn("is_complete", F.coalesce(F.col("first_start") <= F.col("last_stop"), F.lit(False)))
    )


def lifecycle_violations(df: DataFrame) -> DataFrame:
    """Sessions in which energy or state of charge drops between consecutive readings, or a stop precedes any start.

    Consecutive readings are compared inside one-minute cells of a session first and then across its cells, so a
    session id shared by a large part of the table is spread over as many groups as it has minutes.
    """
    inside = Window.partitionBy("session_id", "cell").orderBy("timestamp", "event_id")
    readings = _session_events(df).select(
        "session_id", "event_type", "timestamp", "event_id", "energy_kwh", "soc_percent",
        time_cell(F.col("timestamp"), 60).alias("cell"),
    )
    reading = F.struct("timestamp", "event_id", "energy_kwh", "soc_percent")

    def drop(name: str) -> Column:
        return F.when(F.col(name) < F.lag(name).over(inside), 1).otherwise(0)

    cells = (
        readings.withColumn("_energy_drop", drop("energy_kwh"))
        .withColumn("_soc_drop", drop("soc_percent"))
        .groupBy("session_id", "cell")
        .agg(
            F.sum("_energy_drop").alias("energy_drops"),
            F.sum("_soc_drop").alias("soc_drops"),
            F.min(reading).alias("first"),
            F.max(reading).alias("last"),
            F.min(F.when(_is(START), F.col("timestamp"))).alias("start"),
            F.min(F.when(_is(STOP), F.col("timestamp"))).alias("stop"),
        )
    )
    before = F.lag("last").over(Window.partitionBy("session_id").orderBy("cell"))

    def across(name: str) -> Column:
        return F.when(F.col(f"first.{name}") < F.col(f"_before.{name}"), 1).otherwise(0)

    return (
        cells.withColumn("_before", before)
        .groupBy("session_id")
        .agg(
            F.sum(F.col("energy_drops") + across("energy_kwh")).alias("energy_drops"),
            F.sum(F.col("soc_drops") + across("soc_percent")).alias("soc_drops"),
            F.coalesce(F.min("stop") < F.min("start"), F.lit(False)).alias("stop_before_start"),
        )
        .filter("energy_drops > 0 OR soc_drops > 0 OR stop_before_start")
    )


def _expected_revenue() -> Column:
    return rnd(F.col("energy_kwh") * F.col("price_per_kwh"), 2)


def revenue_mismatches(df: DataFrame) -> DataFrame:
    """Rows whose revenue is not energy times price, to the cent."""
    return df.filter(F.col("event_type").isin(METER, STOP) & (F.col("revenue_eur") != _expected_revenue())).select(
        "event_id", "session_id", "energy_kwh", "price_per_kwh", "revenue_eur",
        _expected_revenue().alias("expected_revenue_eur"),
    )


def revenue_check(df: DataFrame) -> DataFrame:
    """Rows checked and mismatching per network."""
    wrong = F.col("revenue_eur") != _expected_revenue()
    return (
        df.filter(F.col("event_type").isin(METER, STOP))
        .groupBy("network_id")
        .agg(n_rows().alias("checked"), count_where(wrong).alias("mismatches"))
    )


def power_out_of_bounds(df: DataFrame) -> DataFrame:
    """Rows drawing power outside the nominal range of their charger type; the range table has four rows."""
    values = ", ".join(f"('{kind}', {low}D, {high}D)" for kind, low, high in CHARGER_POWER_BOUNDS)
    bounds = df.sparkSession.sql(f"SELECT * FROM VALUES {values} AS t(charger_type, min_kw, max_kw)")
    return (
        df.filter(F.col("power_kw") > 0)
        .join(F.broadcast(bounds), "charger_type")
        .filter(~F.col("power_kw").between(F.col("min_kw"), F.col("max_kw")))
        .select(
            "event_id", "station_id", "charger_type", "power_kw", "min_kw", "max_kw",
            rnd(ratio(F.col("power_kw") * F.lit(1000.0), F.col("voltage_v")), 1).alias("derived_current_a"),
        )
    )


def peak_multiplier(hour: Column) -> Column:
    """First configured hour range that holds the hour; 1 outside all of them."""
    picked = F.lit(1.0)
    for start, end, factor in reversed(PEAK_WINDOWS):
        picked = F.when((hour >= start) & (hour < end), F.lit(factor)).otherwise(picked)
    return picked


def sessions_per_multiplier(df: DataFrame) -> DataFrame:
    return df.groupBy(peak_multiplier(F.hour("timestamp")).alias("multiplier")).agg(
        n_rows().alias("events"),
        count_where(_is(START)).alias("session_starts"),
        F.count_distinct(F.nullif(F.col("session_id"), F.lit(""))).alias("sessions"),
    )


def station_dimension(df: DataFrame) -> DataFrame:
    """One row per station, described as in its latest event."""
    latest = F.max(F.struct("timestamp", "event_id", "network_id", "city", "country", "charger_type"))
    return (
        df.groupBy("station_id")
        .agg(
            latest.alias("_latest"),
            F.count_distinct("connector_id").alias("connectors"),
            F.min("price_per_kwh").alias("min_price_per_kwh"),
            F.max("price_per_kwh").alias("max_price_per_kwh"),
        )
        .select(
            "station_id",
            *[F.col(f"_latest.{c}").alias(c) for c in ("network_id", "city", "country", "charger_type")],
            "connectors", "min_price_per_kwh", "max_price_per_kwh",
        )
    )


def throughput_series(df: DataFrame, *, interval_s: int = 300) -> DataFrame:
    """Events per tumbling interval, in total and by type."""
    return df.groupBy(F.window("timestamp", f"{interval_s} seconds").alias("_w")).agg(
        n_rows().alias("events"),
        *[count_where(_is(t)).alias(f"{t}_events") for t in EVENT_TYPES],
    ).select(
        F.col("_w.start").alias("interval_start"),
        "events",
        rnd(F.col("events") / F.lit(float(interval_s)), 4).alias("events_per_second"),
        *[f"{t}_events" for t in EVENT_TYPES],
    )


def throughput_summary(df: DataFrame, *, interval_s: int = 300, target_eps: float = 0.05) -> DataFrame:
    """Average, peak and spread of the interval rates, and the average against a target rate."""
    rate = F.col("events") / F.lit(float(interval_s))
    return throughput_series(df, interval_s=interval_s).agg(
        n_rows().alias("intervals"),
        F.coalesce(F.sum("events"), F.lit(0)).alias("events"),
        rnd(F.avg(rate), 4).alias("avg_eps"),
        rnd(F.max(rate), 4).alias("peak_eps"),
        rnd(F.stddev_pop(rate), 4).alias("std_eps"),
        rnd(F.avg(rate) / F.lit(target_eps) * F.lit(100.0), 1).alias("pct_of_target"),
    )


def traffic_mix(df: DataFrame) -> DataFrame:
    """Share of all events per type, known or not."""
    counts = df.groupBy("event_type").agg(n_rows().alias("events"))
    total = counts.agg(F.sum("events").alias("n")).scalar()
    return counts.withColumn("share_pct", rnd(ratio(F.lit(100.0) * F.col("events"), total), 2))
