"""Station and session entries kept by stateful streams: no Python, no scan of the fact table.

Spark holds the writes of each key and time cell in its state store (RocksDB) until the watermark passes the cell, and passes
on every cell that a micro-batch has changed. These are added to the table of entries as runs; cells of one key are folded
into lives (stations) or the latest writes (sessions) when runs are merged and when the table is read. A cell that is passed
on twice says the same or more the second time, so neither a repeated batch nor a resent message changes the result.

A live table drops, when it is merged, the entries that ended before the allowance; with `keep_history` all lives of a
station stay. Events that come later than the allowance are not seen, as a live panel has no use for them.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from wattloom.functions.windows import time_cell
from wattloom.operators import state
from wattloom.operators.ingest import check
from wattloom.schema import SESSION_TTL_S, STATION_TTL_S
from wattloom.session import prepare
from wattloom.sources.snapshot import FANOUT, Manifest, Run, Snapshots
from wattloom.sources.streams import trigger_of
from wattloom.streaming import tables

ALLOWANCE = "1 hour"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@dataclass(frozen=True)
class Entries:
    """How the entries of one kind are written: their key, length of a cell, the events that count, the fields kept."""

    table: str
    key: str
    cell_s: int
    writes: Callable[[DataFrame], DataFrame]
    fields: Callable[[], list[Column]]


STATIONS = Entries("station_cells", "station_id", STATION_TTL_S, state.station_writes, state.station_fields)
SESSIONS = Entries("session_cells", "session_id", SESSION_TTL_S, state.session_writes, state.session_fields)


def facts_of(messages: DataFrame) -> DataFrame:
    """The typed rows of the valid messages of a stream; there is no need to drop resent ones."""
    numbered = messages.select(F.lit(0).cast("bigint").alias("arrival"), "raw")
    return check(numbered).filter("reason IS NULL AND conversion_error IS NULL").select("fact.*")


def changed_cells(facts: DataFrame, entries: Entries, allowance: str = ALLOWANCE) -> DataFrame:
    """The cells of a stream of facts, each again whenever it changes; `seen_micros` is its newest event."""
    window = F.window("timestamp", f"{entries.cell_s} seconds").alias("span")
    grouped = entries.writes(facts.withWatermark("timestamp", allowance)).groupBy(entries.key, window)
    cells = grouped.agg(*entries.fields(), F.max(F.unix_micros("timestamp")).alias("seen_micros"))
    return cells.withColumn("cell", time_cell(F.col("span.start"), entries.cell_s)).drop("span")


def _add_cells(folder: str, entries: Entries, group: str, fanout: int) -> Callable:
    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        snapshots = Snapshots(spark, folder)
        past = snapshots.current() or Manifest()
        if batch_id <= past.last_batch:
            return
        shape = tables.LIVE_PARTIALS[entries.table][0](tables.empty_facts(spark)).columns
        seen, table = Observation(f"{entries.table}-{batch_id}"), f"{group}/{entries.table}"
        # Written once: a second action would run the stateful operator again.
        marked = batch.observe(seen, F.max("seen_micros").alias("mark"))
        added = snapshots.write(marked.select(*shape), table, Run(f"batch_id={batch_id}", 0, batch_id, batch_id))
        marks = [m for m in (past.high_water, seen.get.get("mark")) if m is not None]
        snapshots.publish(replace(past.with_runs({table: added}), last_batch=batch_id, high_water=max(marks, default=None)))
        tables.merge_tables(snapshots, fanout)

    return run


def start_entries(facts: DataFrame, folder: str, entries: Entries, *, keep_history: bool = False, allowance: str = ALLOWANCE,
                  run_as_backfill: bool = False, fanout: int = FANOUT) -> StreamingQuery:
    """Keep the table of entries under `folder` up to date with a stream of facts."""
    spark = facts.sparkSession
    prepare(spark)
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    group = "history" if keep_history else "live"
    return (
        changed_cells(facts, entries, allowance)
        .writeStream.queryName(f"{group}-{entries.table}")
        .outputMode("update")
        .foreachBatch(_add_cells(folder, entries, group, fanout))
        .option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(**trigger_of(10**9 if run_as_backfill else 0))
        .start()
    )


def read_entries(spark: SparkSession, folder: str, entries: Entries, *, keep_history: bool = False) -> DataFrame:
    """The cells as of the last published batch, folded: for `state.station_status` or `state.live_sessions`."""
    group = "history" if keep_history else "live"
    return tables.read_partials(spark, f"{folder}/{group}", tables.LIVE_PARTIALS, entries.table)
