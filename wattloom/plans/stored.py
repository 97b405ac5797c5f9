"""The analytical questions answered from the stored rollups of a running ingest.

A trailing period is cut into its whole hours, which the hourly rollups answer, and the part of an hour at its beginning, for
which alone facts are read. All answers of one object come from one published state of the tables.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from datetime import datetime, timedelta
from fractions import Fraction

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from wattloom.functions.joins import broadcast_if_small
from wattloom.functions.numeric import ratio, rnd
from wattloom.functions.windows import utc
from wattloom.operators import distincts, rollups
from wattloom.plans import analytics, report
from wattloom.schema import FACT_DDL, FAULT
from wattloom.sources import fact
from wattloom.sources.snapshot import Manifest, Snapshots
from wattloom.streaming import tables

# Labels of the duration classes.
LENGTH_NAMES = ["< 15 min", "15–30 min", "30–60 min", "1–2 hours", ">= 2 hours"]


def _total(name: str, digits: int = 2) -> Column:
    return rnd(F.sum(name), digits)


def _mean(total: str, count: str, digits: int = 2) -> Column:
    return rnd(ratio(F.sum(total), F.sum(count)), digits)


class StoredAnalytics:
    """Questions over the warehouse that `start_warehouse` or `load_facts` keep under a folder."""

    def __init__(self, spark: SparkSession, folder: str, as_of: datetime | None = None):
        self.spark, self._snapshots = spark, Snapshots(spark, folder)
        self._manifest = self._snapshots.current() or Manifest()
        self._as_of = utc(as_of) if as_of else None
        self._tables: dict[str, DataFrame] = {}  # listed and analysed once, as the published state does not change

    @property
    def as_of(self) -> datetime | None:
        """The moment the questions are asked for: the newest event, found once, unless one was given."""
        if self._as_of is None:
            months = sorted({m for run in self._manifest.runs(fact.TABLE) for m in run.parts})
            if months:
                newest = self._facts(lambda month: month == months[-1]).agg(F.unix_micros(F.max("timestamp"))).first()[0]
                self._as_of = tables.instant(newest)
        return self._as_of

    def _facts(self, wanted: Callable[[str], bool] | None = None) -> DataFrame:
        return self._snapshots.read(fact.TABLE, FACT_DDL, fact.MONTH, wanted, runs=self._manifest.runs(fact.TABLE))

    def facts_between(self, since: datetime, until: datetime | None = None) -> DataFrame:
        """Facts of a period (until is exclusive), from the months it touches."""
        low, high = since.strftime("%Y-%m"), until.strftime("%Y-%m") if until else "9999-99"
        rows = self._facts(lambda month: low <= month <= high).filter(F.col("timestamp") >= F.lit(since))
        return rows.filter(F.col("timestamp") < F.lit(until)) if until else rows

    def _rollup(self, name: str) -> DataFrame:
        """Partial rows of a rollup, several per key perhaps; what is made of them adds them up."""
        if name not in self._tables:
            shape = rollups.STORED_ROLLUPS[name][1](tables.empty_facts(self.spark))
            table = f"rollups/{name}"
            rows = self._snapshots.read(table, tables.ddl_of(shape), runs=self._manifest.runs(table))
            self._tables[name] = rows.select(*shape.columns)
        return self._tables[name]

    def _station_sets(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = tables.read_station_sets(self._snapshots, self._manifest, name)
        return self._tables[name]

    def stops_since(self, since: datetime) -> DataFrame:
        """Hourly sums of the stops at a time or later: rollup rows of whole hours, and of the hour that is cut the facts."""
        whole = since.replace(minute=0, second=0, microsecond=0)
        whole = whole if whole == since else whole + timedelta(hours=1)
        hourly = self._rollup("stops_hourly").filter(F.col("hour") >= F.lit(whole))
        if whole == since:
            return hourly
        return hourly.unionByName(rollups.stops_hourly(self.facts_between(since, whole)))

    def _trailing(self, **length: int) -> DataFrame:
        if self.as_of is None:
            return self._rollup("stops_hourly")
        return self.stops_since(self.as_of - timedelta(**length))

    def revenue_by_network(self, days: int = 7, limit: int | None = None) -> DataFrame:
        out = self._trailing(days=days).groupBy("network_id").agg(
            F.sum("stops").alias("session_count"), _total("revenue").alias("total_revenue_eur"),
            _total("energy").alias("total_energy_kwh"), _mean("minutes", "stops", 1).alias("avg_duration_min"),
            _mean("revenue", "stops").alias("avg_revenue_per_session"),
        ).orderBy(F.desc("total_revenue_eur"), "network_id")
        return out if limit is None else out.limit(limit)

    def sessions_per_hour(self, hours: int = 24) -> DataFrame:
        return self._trailing(hours=hours).filter("timed > 0").groupBy("hour").agg(
            F.sum("timed").alias("session_count"), _total("timed_energy").alias("total_energy_kwh"),
            _total("timed_revenue").alias("total_revenue_eur"), _mean("timed_power", "timed", 1).alias("avg_power_kw"),
        ).orderBy("hour")

    def charger_utilization(self) -> DataFrame:
        return self._rollup("stops_hourly").filter("timed > 0").groupBy("charger_type").agg(
            F.sum("timed").alias("session_count"), _mean("timed_minutes", "timed", 1).alias("avg_duration_min"),
            _mean("timed_power", "timed", 1).alias("avg_power_kw"), _mean("timed_energy", "timed").alias("avg_energy_kwh"),
            _total("timed_revenue").alias("total_revenue_eur"), _mean("timed_revenue", "timed").alias("avg_revenue_per_session"),
        ).orderBy(F.desc("session_count"), "charger_type")

    def top_cities_by_energy(self, limit: int = 10) -> DataFrame:
        cities = distincts.distinct_by(self._station_sets("stop_stations_daily"), ["city", "country"])
        return cities.select(
            "city", "country", F.col("stops").alias("session_count"), rnd(F.col("energy"), 2).alias("total_energy_kwh"),
            rnd(F.col("revenue"), 2).alias("total_revenue_eur"), F.col("distinct_stations").alias("unique_stations"),
        ).orderBy(F.desc("total_energy_kwh"), "city", "country").limit(limit)

    def error_analysis(self, limit: int | None = None) -> DataFrame:
        faults = self._station_sets("fault_stations_daily")
        everything = faults.agg(F.sum("faults")).scalar()
        coded = faults.filter("error_code <> ''")
        networks = coded.groupBy("error_code").agg(F.count_distinct("network_id").alias("affected_networks"))
        out = distincts.distinct_by(coded, ["error_code"]).join(F.broadcast(networks), "error_code").select(
            "error_code", F.col("faults").alias("occurrences"), F.col("distinct_stations").alias("affected_stations"),
            "affected_networks", rnd(ratio(F.lit(100.0) * F.col("faults"), everything), 2).alias("pct_of_errors"),
        ).orderBy(F.desc("occurrences"), "error_code")
        return out if limit is None else out.limit(limit)

    def vehicle_type_breakdown(self) -> DataFrame:
        return self._rollup("stops_hourly").filter("timed > 0").groupBy("vehicle_type").agg(
            F.sum("timed").alias("session_count"), _mean("timed_energy", "timed").alias("avg_energy_kwh"),
            _mean("timed_minutes", "timed", 1).alias("avg_duration_min"), _total("timed_revenue").alias("total_revenue_eur"),
            _mean("timed_power", "timed", 1).alias("avg_power_kw"),
        ).orderBy(F.desc("session_count"), "vehicle_type")

    def real_time_throughput(self, minutes: int = 5) -> DataFrame:
        """From the facts of these minutes; distinct sessions of a few minutes are not worth a rollup."""
        if self.as_of is None:
            return analytics.real_time_throughput(tables.empty_facts(self.spark), minutes=minutes)
        facts = self.facts_between(self.as_of - timedelta(minutes=minutes))
        return analytics.real_time_throughput(facts, as_of=self.as_of, minutes=minutes)

    def session_duration_distribution(self) -> DataFrame:
        names = F.array(*[F.lit(name) for name in LENGTH_NAMES])
        return self._rollup("stop_lengths_daily").groupBy("length_class").agg(
            F.sum("stops").alias("sessions"), _mean("energy", "stops").alias("avg_energy_kwh"),
            _mean("revenue", "stops").alias("avg_revenue_eur"),
        ).orderBy("length_class").select(
            F.element_at(names, F.col("length_class") + 1).alias("bucket"), "sessions", "avg_energy_kwh", "avg_revenue_eur")

    def peak_hours(self) -> DataFrame:
        return self._rollup("stops_hourly").filter("timed > 0").groupBy(F.hour("hour").alias("hour_of_day")).agg(
            F.sum("timed").alias("session_count"), _mean("timed_energy", "timed").alias("avg_energy_kwh"),
            _mean("timed_power", "timed", 1).alias("avg_power_kw"), _total("timed_revenue").alias("total_revenue_eur"),
        ).orderBy("hour_of_day")

    def network_error_rate(self) -> DataFrame:
        faults = F.coalesce(F.sum(F.when(F.col("event_type") == FAULT, F.col("events"))), F.lit(0).cast("bigint"))
        return self._rollup("events_hourly").groupBy("network_id").agg(
            faults.alias("error_count"), F.sum("events").alias("total_events"),
            rnd(ratio(F.lit(100.0) * faults, F.sum("events")), 3).alias("error_rate_pct"),
        ).orderBy(F.desc("error_rate_pct"), "network_id")

    def revenue_per_kwh(self) -> DataFrame:
        return self._rollup("stops_hourly").filter("charged > 0").groupBy("charger_type").agg(
            rnd(ratio(F.sum("charged_revenue"), F.sum("charged_energy")), 4).alias("revenue_per_kwh"),
            _mean("charged_price", "charged", 4).alias("avg_listed_price"), F.sum("charged").alias("session_count"),
        ).orderBy(F.desc("revenue_per_kwh"), "charger_type")

    def country_summary(self) -> DataFrame:
        countries = distincts.distinct_by(self._station_sets("stop_stations_daily"), ["country"])
        return countries.select(
            "country", F.col("stops").alias("session_count"), F.col("distinct_stations").alias("station_count"),
            rnd(F.col("energy"), 2).alias("total_energy_kwh"), rnd(F.col("revenue"), 2).alias("total_revenue_eur"),
            rnd(ratio(F.col("minutes"), F.col("stops")), 1).alias("avg_session_min"),
        ).orderBy(F.desc("total_energy_kwh"), "country")

    def hourly_energy_7days(self) -> DataFrame:
        """From the hourly session rollup alone: it is asked for whole hours."""
        return analytics.hourly_energy_week(self._rollup("sessions_hourly"), F.lit(self.as_of).cast("timestamp"))

    def fault_geography(self, limit: int | None = 20) -> DataFrame:
        faults = self._station_sets("fault_stations_daily")
        everything = faults.agg(F.sum("faults")).scalar()
        kinds = faults.groupBy("city", "country").agg(F.count_distinct("error_code").alias("distinct_error_types"))
        found = distincts.distinct_by(faults, ["city", "country"]).join(broadcast_if_small(kinds), ["city", "country"])
        out = found.select(
            "city", "country", F.col("faults").alias("fault_count"), F.col("distinct_stations").alias("affected_stations"),
            "distinct_error_types", rnd(ratio(F.lit(100.0) * F.col("faults"), everything), 2).alias("pct_of_all_faults"),
            rnd(ratio(F.col("faults"), F.col("distinct_stations")), 2).alias("faults_per_station"),
        ).orderBy(F.desc("fault_count"), "city", "country")
        return out if limit is None else out.limit(limit)

    def fleet_power(self) -> tuple[int, float | None, float | None]:
        """Number of timed stops, mean and population deviation of their mean power, exactly from the daily moments."""
        n, total, squares = self._rollup("power_moments_daily").agg(
            F.coalesce(F.sum("timed"), F.lit(0)), F.sum("power"), F.sum("power_squared")).first()
        if not n:
            return 0, None, None
        mean = Fraction(total) / n
        return n, float(mean), math.sqrt(max(Fraction(squares) / n - mean * mean, 0))

    def anomalies(self, limit: int | None = 20) -> DataFrame:
        """One scan of the facts, for the candidates alone."""
        return analytics.anomalies(self._facts(), limit=limit, fleet=self.fleet_power()[1:])

    def anomaly_summary(self) -> DataFrame:
        stops, *fleet = self.fleet_power()
        return report.summarised(analytics.anomalies(self._facts(), limit=None, fleet=tuple(fleet)), F.lit(stops))

    def errors_daily(self) -> DataFrame:
        """The error rollup with its distinct stations counted from bits."""
        coded = self._station_sets("fault_stations_daily").filter("error_code <> ''")
        return distincts.distinct_by(coded, ["day", "error_code", "network_id"]).select(
            "day", "error_code", "network_id", F.col("faults").alias("error_count"),
            F.col("distinct_stations").alias("affected_stations"))

    def total_events(self) -> DataFrame:
        return self._rollup("events_hourly").agg(F.coalesce(F.sum("events"), F.lit(0).cast("bigint")).alias("total"))

    def kpi_cover(self) -> DataFrame:
        """One row: all-time total, the last five minutes, and revenue and energy of the last 30 days."""
        month = self.revenue_by_network(days=30).agg(F.struct(
            F.coalesce(rnd(F.sum("total_revenue_eur"), 2), F.lit(0.0)).alias("revenue"),
            F.coalesce(rnd(F.sum("total_energy_kwh"), 2), F.lit(0.0)).alias("energy"))).scalar()
        return self.real_time_throughput().select(
            self.total_events().scalar().alias("total_events"), "events_per_second", "active_stations", "unique_sessions",
            month["revenue"].alias("revenue_30d_eur"), month["energy"].alias("energy_30d_kwh"))
