"""Tables of a running ingest, all under one manifest: how a batch adds to them and how they are read and merged."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F

from wattloom.operators import distincts, rollups, state
from wattloom.operators.rollups import STORED_ROLLUPS, combine
from wattloom.schema import DEAD_LETTER_DDL, DEDUP_HORIZON_S, FACT_DDL
from wattloom.sources import deadletter, fact
from wattloom.sources.snapshot import FANOUT, Manifest, Run, Snapshots, merge_due

Fold = Callable[[DataFrame], DataFrame]

# name -> (partial rows of one batch, partial rows of many batches folded)
LIVE_PARTIALS: dict[str, tuple[Fold, Fold]] = {
    "event_counts": (state.event_counts, lambda p: combine(p, ["event_type"])),
    "status_counts": (state.status_counts, lambda p: combine(p, ["status"])),
    "active_counts": (state.active_counts, lambda p: combine(p, ["network_id", "city"])),
    "fault_counts": (state.fault_counts, lambda p: combine(p, ["day", "network_id", "error_code"])),
    "day_sums": (state.day_sums, lambda p: combine(p, ["day", "station_id", "network_id", "city"])),
    "station_cells": (state.station_cells, state.station_lives),
    "session_cells": (state.session_cells, lambda p: state.merge_cells(p, ["session_id"])),
}

ROLLUP_PARTIALS: dict[str, tuple[Fold, Fold]] = {
    name: (partial, lambda p, keys=keys: combine(p, keys)) for name, (keys, partial) in STORED_ROLLUPS.items()
}

# Folder of a group of tables -> its tables. A history keeps what a live table drops.
PARTIALS = {"rollups": ROLLUP_PARTIALS, "live": LIVE_PARTIALS, "history": LIVE_PARTIALS}

# What a live table drops when its runs are merged: state that no event of the last hour of stream time can see again.
EXPIRY = {"live/station_cells": state.lives_since, "live/session_cells": state.sessions_since}

SEEN, METRICS, STATIONS = "state/seen", "metrics", "state/stations"
REPLAYED = "state/replayed"
SEEN_DDL, REPLAYED_DDL = "dedup_key string, mark bigint", "event_id string, replay_id string"


def empty_facts(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], FACT_DDL)


def ddl_of(df: DataFrame) -> str:
    return ", ".join(f"`{name}` {kind}" for name, kind in df.dtypes)


Steps = dict[str, Callable[[], Run]]


def partial_steps(snapshots: Snapshots, facts: DataFrame, group: str, partials: dict[str, tuple[Fold, Fold]], run: Run) -> Steps:
    """What writes the partial rows of one batch, table by table."""
    return {f"{group}/{name}": lambda name=name, fold=fold: snapshots.write(fold(facts), f"{group}/{name}", run)
            for name, (fold, _) in partials.items()}


def write_new_stations(snapshots: Snapshots, facts: DataFrame, past: Manifest, run: Run) -> Run:
    """The stations of the batch that the dictionary lacks."""
    known = snapshots.read(STATIONS, distincts.DICTIONARY_DDL, runs=past.runs(STATIONS)).drop("batch_id")
    return snapshots.write(distincts.new_stations(facts, known), STATIONS, run)


def station_set_steps(snapshots: Snapshots, facts: DataFrame, past: Manifest, run: Run) -> Steps:
    """What writes the batch's rows of the rollups that count stations, once its new stations are written."""
    dictionary = snapshots.read(STATIONS, distincts.DICTIONARY_DDL, runs=(*past.runs(STATIONS), run)).drop("batch_id")
    return {f"stations/{name}": lambda name=name, rows=rows: snapshots.write(rows(facts, dictionary), f"stations/{name}", run)
            for name, (_, rows) in distincts.STATION_SETS.items()}


def _station_set_shape(spark: SparkSession, name: str) -> DataFrame:
    return distincts.STATION_SETS[name][1](empty_facts(spark), spark.createDataFrame([], distincts.DICTIONARY_DDL))


def read_station_sets(snapshots: Snapshots, manifest: Manifest, name: str) -> DataFrame:
    """Rows of a rollup that counts stations, several per key perhaps."""
    shape, table = _station_set_shape(snapshots.spark, name), f"stations/{name}"
    return snapshots.read(table, ddl_of(shape), runs=manifest.runs(table)).select(*shape.columns)


def read_partials(spark: SparkSession, folder: str, partials: dict[str, tuple[Fold, Fold]], name: str) -> DataFrame:
    """The table as of the last published batch or replay, one row per key."""
    root, _, group = folder.rstrip("/").rpartition("/")
    partial, fold = partials[name]
    shape = partial(empty_facts(spark))
    return fold(Snapshots(spark, root).read(f"{group}/{name}", ddl_of(shape)).select(*shape.columns))


def read_metrics(spark: SparkSession, folder: str) -> DataFrame:
    """The counters of every micro-batch."""
    root, _, name = folder.rstrip("/").rpartition("/")
    return Snapshots(spark, root).read(name, METRICS_DDL).drop("batch_id")


METRICS_DDL = ("messages bigint, accepted bigint, dead_letters bigint, duplicates bigint, late bigint, dedup_hit_pct double, "
               "late_pct double, events_per_second double")


def read_errors_daily(spark: SparkSession, folder: str) -> DataFrame:
    return rollups.errors_from_members(read_partials(spark, folder, ROLLUP_PARTIALS, "error_members_daily"))


def instant(micros: int | None) -> datetime | None:
    return None if micros is None else datetime(1970, 1, 1, tzinfo=timezone.utc) + timedelta(microseconds=micros)


def _cutoff(manifest: Manifest, horizon_s: int) -> int | None:
    return None if manifest.high_water is None else manifest.high_water - horizon_s * 1_000_000


def read_seen(snapshots: Snapshots, manifest: Manifest, horizon_s: int = DEDUP_HORIZON_S) -> DataFrame | None:
    """Ids first seen within the horizon of stream time before the last batch; none before the first batch."""
    cutoff = _cutoff(manifest, horizon_s)
    if cutoff is None or not manifest.runs(SEEN):
        return None
    table = snapshots.read(SEEN, SEEN_DDL, runs=manifest.runs(SEEN))
    return table.filter(F.col("mark") >= cutoff).select("dedup_key")


def write_seen(snapshots: Snapshots, classified: DataFrame, run: Run) -> Run:
    ids = classified.filter(F.col("dedup_key").startswith("id:"))
    return snapshots.write(ids.select("dedup_key", F.lit(run.mark).cast("bigint").alias("mark")), SEEN, run)


def without_expired(manifest: Manifest, horizon_s: int = DEDUP_HORIZON_S) -> Manifest:
    """The manifest without runs whose seen ids are all beyond the horizon."""
    cutoff = _cutoff(manifest, horizon_s)
    live = tuple(run for run in manifest.runs(SEEN) if cutoff is None or run.mark is None or run.mark >= cutoff)
    return replace(manifest, tables={**manifest.tables, SEEN: live}) if SEEN in manifest.tables else manifest


def merge_tables(snapshots: Snapshots, fanout: int = FANOUT) -> list[str]:
    """Merge what is due, at most one level of every table; names of the merged tables."""
    return merge_due(snapshots, lambda table, old, new: _rewrite(snapshots, table, old, new), fanout, EXPIRY)


def _rewrite(snapshots: Snapshots, table: str, old: list[Run], new: Run) -> Run:
    if table == fact.TABLE:
        return fact.write_fact_run(snapshots, snapshots.read(table, FACT_DDL, fact.MONTH, runs=old), new, clustered=True)
    if table == deadletter.TABLE:
        letters = snapshots.read(table, DEAD_LETTER_DDL, deadletter.MONTH, runs=old).drop("batch_id")
        return deadletter.write_letters_run(snapshots, letters, new)
    if table == SEEN:
        cutoff = _cutoff(snapshots.current(), DEDUP_HORIZON_S)
        ids = snapshots.read(table, SEEN_DDL, runs=old).drop("batch_id")
        return snapshots.write(ids.filter(F.col("mark") >= cutoff) if cutoff is not None else ids, table, new)
    if table == REPLAYED:
        return snapshots.write(snapshots.read(table, REPLAYED_DDL, runs=old).drop("batch_id"), table, new)
    if table == STATIONS:
        return snapshots.write(snapshots.read(table, distincts.DICTIONARY_DDL, runs=old).drop("batch_id"), table, new)
    if table.startswith("stations/"):
        name = table.split("/")[1]
        shape = _station_set_shape(snapshots.spark, name)
        rows = snapshots.read(table, ddl_of(shape), runs=old).select(*shape.columns)
        merged = distincts.merge_bits(rows, distincts.STATION_SETS[name][0])
        return snapshots.write(merged.repartitionByRange("day").sortWithinPartitions("day"), table, new)
    if table == METRICS:
        return snapshots.write(snapshots.read(table, METRICS_DDL, runs=old).drop("batch_id").coalesce(1), table, new)
    group, _, name = table.partition("/")
    partial, fold = PARTIALS[group][name]
    shape = partial(empty_facts(snapshots.spark))
    rows = fold(snapshots.read(table, ddl_of(shape), runs=old).select(*shape.columns))
    high_water = snapshots.current().high_water
    if table in EXPIRY and high_water is not None:
        rows = EXPIRY[table](rows, F.lit(instant(high_water - DEDUP_HORIZON_S * 1_000_000)))
    # Sorted by the leading key (an hour, a day, a station), so that a reader of a range skips files.
    return snapshots.write(rows.repartitionByRange(shape.columns[0]).sortWithinPartitions(*shape.columns[:2]), table, new)


def finished_batches(spark: SparkSession, folder: str) -> list[int]:
    """Numbers of the published batches of the ingest whose state folder this is."""
    manifest = Snapshots(spark, folder.rstrip("/").rpartition("/")[0]).current()
    return list(range(manifest.last_batch + 1)) if manifest else []
