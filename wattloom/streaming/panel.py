"""The live panel: counters, entries and boards read from the tables that `start_live` keeps."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from wattloom.functions.numeric import ratio, rnd
from wattloom.functions.windows import utc
from wattloom.operators import state
from wattloom.schema import EVENT_TYPES
from wattloom.sources.snapshot import Manifest, Snapshots
from wattloom.streaming import tables


class LivePanel:
    """What the stream has counted up to its last published batch. `as_of` is the newest event seen unless one is given."""

    def __init__(self, spark: SparkSession, folder: str, as_of: datetime | None = None):
        self._spark, self._folder = spark, f"{folder.rstrip('/')}/live"
        manifest = Snapshots(spark, folder).current() or Manifest()
        self.as_of = utc(as_of) if as_of else tables.instant(manifest.high_water)

    def _now(self) -> Column:
        return F.lit(self.as_of).cast("timestamp")

    def _table(self, name: str) -> DataFrame:
        return tables.read_partials(self._spark, self._folder, tables.LIVE_PARTIALS, name)

    def event_counters(self) -> DataFrame:
        return state.with_total(self._table("event_counts"), "event_type", "events")

    def live_sessions(self) -> DataFrame:
        return state.live_sessions(self._table("session_cells"), self._now())

    def station_status(self) -> DataFrame:
        return state.station_status(self._table("station_cells"), self._now()).filter("is_live").drop("is_live")

    def active_by(self, key: str) -> DataFrame:
        """Signed counters per `network_id` or `city`."""
        return self._table("active_counts").groupBy(key).agg(F.sum("active_sessions").alias("active_sessions"))

    def active_global(self) -> DataFrame:
        total = F.coalesce(F.sum("active_sessions"), F.lit(0).cast("bigint")).alias("active_sessions")
        return self._table("active_counts").agg(total).withColumn(
            "active_shown", F.greatest(F.lit(0).cast("bigint"), "active_sessions"))

    def leaderboard(self, member: str) -> DataFrame:
        """Revenue per day and `station_id`, `network_id` or `city`, of stops that earned any."""
        paid = self._table("day_sums").filter("revenue_eur IS NOT NULL")
        return paid.groupBy("day", member).agg(rnd(F.sum("revenue_eur"), 2).alias("revenue_eur"))

    def leaderboard_top(self, member: str = "station_id", *, n: int = 10) -> DataFrame:
        by_revenue = Window.partitionBy("day").orderBy(F.desc("revenue_eur"), member)
        return self.leaderboard(member).withColumn("rank", F.row_number().over(by_revenue)).filter(F.col("rank") <= n)

    def energy_daily(self, *keys: str) -> DataFrame:
        delivered = self._table("day_sums").filter("energy_kwh IS NOT NULL")
        return delivered.groupBy("day", *keys).agg(rnd(F.sum("energy_kwh"), 2).alias("energy_kwh"))

    def fault_counters(self) -> DataFrame:
        codes = self._table("fault_counts").groupBy("error_code").agg(F.sum("faults").alias("faults"))
        return state.with_total(codes, "error_code", "faults")

    def faults_network_daily(self) -> DataFrame:
        return self._table("fault_counts").groupBy("day", "network_id").agg(F.sum("faults").alias("faults"))

    def status_counts(self) -> DataFrame:
        return self._table("status_counts")

    def kpis(self) -> DataFrame:
        """The whole panel in one row, from tables of a few rows each."""
        def of(kind: str) -> Column:
            return F.coalesce(F.sum(F.when(F.col("event_type") == kind, F.col("events"))), F.lit(0).cast("bigint"))

        total, faults = F.coalesce(F.sum("events"), F.lit(0).cast("bigint")), of("fault_alert")
        today = self._table("day_sums").filter(F.col("day") == F.to_date(self._now()))
        return self._table("event_counts").agg(
            total.alias("total_events"),
            self.active_global().select("active_shown").scalar().alias("active_sessions"),
            *[of(kind).alias(f"{kind}_events") for kind in EVENT_TYPES],
            faults.alias("total_faults"),
            today.agg(F.coalesce(rnd(F.sum("energy_kwh"), 1), F.lit(0.0))).scalar().alias("energy_today_kwh"),
            rnd(ratio(faults, F.greatest(total, F.lit(1).cast("bigint"))) * F.lit(100.0), 3).alias("error_rate_pct"),
        )
