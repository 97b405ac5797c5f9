"""The two consumers of the event stream, each with its own checkpoint, tables and manifest.

Both run the batch functions on every micro-batch. A batch writes its rows as runs nobody sees yet and then publishes them
all at once; one that has been published is not run again, one that has not leaves nothing behind that counts.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import datetime

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from wattloom.functions.joins import is_sized
from wattloom.functions.numeric import n_rows
from wattloom.operators import ingest, replay
from wattloom.operators.dedup import drop_seen
from wattloom.operators.lateness import BLOCK
from wattloom.schema import FACT_NAMES, MAX_LATENESS_S
from wattloom.session import drop_folder, prepare, shuffles_dropped, store
from wattloom.sources.deadletter import TABLE as LETTERS, read_dead_letters, write_letters_run
from wattloom.sources.fact import TABLE as FACT, read_fact, write_fact_run
from wattloom.sources.snapshot import FANOUT, Manifest, Run, Snapshots, together
from wattloom.sources.streams import trigger_of, with_arrival
from wattloom.streaming import tables
from wattloom.streaming.tables import LIVE_PARTIALS, METRICS, ROLLUP_PARTIALS, SEEN

NEVER_LATE_S = 10**9
COUNTS_DDL = ("messages bigint, accepted bigint, dead_letters bigint, late bigint, tested bigint, kept bigint, "
              "first_micros bigint, last_micros bigint")


class Intake:
    """A micro-batch classified against what earlier ones left, with its counters.

    The counters are observed while the batch is stored, so they cost no pass of their own. A step's table goes once the
    next one is stored, and a consumer without `letters` does not carry the text of the messages.
    """

    def __init__(self, batch: DataFrame, batch_id: int, snapshots: Snapshots, past: Manifest, lateness_s: int, block: int,
                 letters: bool):
        self.snapshots, self.past, self.batch_id = snapshots, past, batch_id
        self.spark, self.stage = batch.sparkSession, f"{snapshots.root}/stage"
        taken, judged = Observation(f"messages-{batch_id}"), Observation(f"outcome-{batch_id}")
        raw = with_arrival(batch)
        # Messages of a stored table are read from there; a log's get a copy, which tells their number of parts.
        if "arrival" not in batch.columns or not is_sized(batch):
            raw = store(raw.observe(taken, n_rows().alias("messages")), f"{self.stage}/messages")
            counted = taken.get
        else:  # not observed ahead of a shuffle, whose tasks may run again
            counted = {"messages": raw.count()}
        first = ingest.first_unseen(raw)
        # Stored before the seen ids are asked for, so that messages are not parsed a second time for theirs.
        fresh = store(first if letters else first.drop("raw"), f"{self.stage}/first")
        self._drop("messages")
        seen = tables.read_seen(snapshots, past)
        if seen is not None:
            fresh = store(drop_seen(fresh, seen), f"{self.stage}/fresh")
            self._drop("first")
        classified = ingest.judge(
            fresh, lateness_s=lateness_s, prior_high_water=tables.instant(past.high_water), block=block)
        mark = F.max(F.unix_micros("high_water")).alias("mark")
        observed = ingest.only_used(classified.observe(judged, *ingest.outcome_counts(), mark))
        self.classified = store(observed, f"{self.stage}/classified")
        self._drop("first", "fresh")
        self.counts = {**counted, **judged.get}
        marks = [m for m in (past.high_water, self.counts.pop("mark", None)) if m is not None]
        self.high_water = max(marks, default=None)
        self.run = Run(f"batch_id={batch_id}", 0, batch_id, batch_id, mark=self.high_water)

    def _drop(self, *names: str) -> None:
        for name in names:
            drop_folder(self.spark, f"{self.stage}/{name}")

    def publish(self, steps: tables.Steps, fanout: int, runs: dict[str, Run] | None = None) -> None:
        """Metrics and seen ids join what the batch writes; then all of it is there at once. Merges follow, as a step of
        their own."""
        counted = {name.split()[0]: self.counts.get(name.split()[0]) for name in COUNTS_DDL.split(", ")}
        row = self.spark.createDataFrame([tuple(counted.values())], COUNTS_DDL).coalesce(1)
        steps[METRICS] = lambda: self.snapshots.write(ingest.metrics_of(row), METRICS, self.run)
        steps[SEEN] = lambda: tables.write_seen(self.snapshots, self.classified, self.run)
        written = {**(runs or {}), **together(steps)}
        after = replace(self.past.with_runs(written), last_batch=self.batch_id, high_water=self.high_water)
        self.snapshots.publish(tables.without_expired(after))
        tables.merge_tables(self.snapshots, fanout)
        drop_folder(self.spark, self.stage)


def _fact_steps(snapshots: Snapshots, facts: DataFrame, past: Manifest, run: Run, *, clustered: bool) -> tuple[tables.Steps, dict[str, Run]]:
    """What writes facts and all that a warehouse keeps of them, and the run that is written already: new stations."""
    stations = {tables.STATIONS: tables.write_new_stations(snapshots, facts, past, run)}
    steps = tables.partial_steps(snapshots, facts, "rollups", ROLLUP_PARTIALS, run)
    steps.update(tables.station_set_steps(snapshots, facts, past, run))
    steps[FACT] = lambda: write_fact_run(snapshots, facts, run, clustered=clustered)
    return steps, stations


def _take_in(batch: DataFrame, batch_id: int, folder: str, lateness_s: int, block: int, letters: bool) -> Intake | None:
    """Nothing if the batch is published already, as when a query failed just before it could note that."""
    prepare(batch.sparkSession)
    snapshots = Snapshots(batch.sparkSession, folder)
    past = snapshots.current() or Manifest()
    return None if batch_id <= past.last_batch else Intake(batch, batch_id, snapshots, past, lateness_s, block, letters)


def warehouse_batch(folder: str, lateness_s: int = MAX_LATENESS_S, block: int = BLOCK, fanout: int = FANOUT) -> Callable:
    """Fact rows, dead letters and rollup partials of one micro-batch."""
    def run(batch: DataFrame, batch_id: int) -> None:
        with shuffles_dropped(batch.sparkSession):
            intake = _take_in(batch, batch_id, folder, lateness_s, block, letters=True)
            if intake is None:
                return
            facts = ingest.accepted(intake.classified)
            steps, stations = _fact_steps(intake.snapshots, facts, intake.past, intake.run, clustered=False)
            steps[LETTERS] = lambda: write_letters_run(intake.snapshots, ingest.rejected(intake.classified), intake.run)
            intake.publish(steps, fanout, stations)

    return run


def live_batch(folder: str, block: int = BLOCK, fanout: int = FANOUT) -> Callable:
    """Live-state partials of one micro-batch; late events count here."""
    def run(batch: DataFrame, batch_id: int) -> None:
        with shuffles_dropped(batch.sparkSession):
            intake = _take_in(batch, batch_id, folder, NEVER_LATE_S, block, letters=False)
            if intake is not None:
                facts = ingest.accepted(intake.classified)
                intake.publish(tables.partial_steps(intake.snapshots, facts, "live", LIVE_PARTIALS, intake.run), fanout)

    return run


def load_facts(spark: SparkSession, folder: str, facts: DataFrame, load_id: str) -> None:
    """Add a table of typed facts to a warehouse, rollups included, all at once. A load that is there already adds nothing."""
    prepare(spark)
    snapshots = Snapshots(spark, folder)
    past = snapshots.current() or Manifest()
    if f"load-{load_id}" in past.replays:
        return
    stage, run = f"{folder}/stage-load-{load_id}", Run(f"batch_id=load-{load_id}", 0, past.last_batch, past.last_batch)
    # A dozen tables are made of the facts: stored once, what they come from is read, joined and broadcast once.
    facts = store(facts.select(*FACT_NAMES), f"{stage}/facts")
    steps, stations = _fact_steps(snapshots, facts, past, run, clustered=True)
    snapshots.publish(replace(past.with_runs({**stations, **together(steps)}), replays=(*past.replays, f"load-{load_id}")))
    drop_folder(spark, stage)


def replay_late(spark: SparkSession, folder: str, replay_id: str, since: datetime | None = None,
                until: datetime | None = None) -> None:
    """Put late dead letters of a warehouse back, of events between two times if they are given: fact rows, and all that the
    warehouse keeps of exactly those rows.

    Rollups are additive, so the touched hours and days come out as if computed again. A ledger keeps the ids that replays
    have taken: the same replay run twice, or one whose period overlaps an earlier one, takes nothing twice. Letters are
    read from the month of `since` on, as none is rejected before its event.
    """
    prepare(spark)
    snapshots = Snapshots(spark, folder)
    past = snapshots.current() or Manifest()
    if replay_id in past.replays:
        return
    stage, run = f"{folder}/stage-replay-{replay_id}", Run(f"batch_id=replay-{replay_id}", 0, past.last_batch, past.last_batch)
    ledger = snapshots.read(tables.REPLAYED, tables.REPLAYED_DDL, runs=past.runs(tables.REPLAYED))
    letters = replay.late_letters(read_dead_letters(spark, f"{folder}/{LETTERS}", since), since, until)
    letters = store(replay.not_replayed(letters, ledger), f"{stage}/letters")
    rows = store(replay.late_rows(letters), f"{stage}/late")
    missing = store(replay.not_in_fact(rows, read_fact(spark, f"{folder}/{FACT}")), f"{stage}/missing")
    steps, stations = _fact_steps(snapshots, missing, past, run, clustered=True)
    steps[LETTERS] = lambda: write_letters_run(snapshots, replay.unconvertible(letters), run)
    taken = letters.select("event_id", F.lit(replay_id).alias("replay_id")).distinct()
    steps[tables.REPLAYED] = lambda: snapshots.write(taken, tables.REPLAYED, run)
    snapshots.publish(replace(past.with_runs({**stations, **together(steps)}), replays=(*past.replays, replay_id)))
    drop_folder(spark, stage)


def _start(events: DataFrame, run: Callable, folder: str, lateness_s: int, name: str) -> StreamingQuery:
    return (
        events.writeStream.queryName(name)
        .foreachBatch(run)
        .option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(**trigger_of(lateness_s))
        .start()
    )


def start_warehouse(events: DataFrame, folder: str, lateness_s: int = MAX_LATENESS_S, *, name: str = "warehouse",
                    run_as_backfill: bool = False, block: int = BLOCK) -> StreamingQuery:
    """`run_as_backfill` drains what is there and stops, whatever the allowance."""
    trigger_lateness = NEVER_LATE_S if run_as_backfill else lateness_s
    return _start(events, warehouse_batch(folder, lateness_s, block), folder, trigger_lateness, name)


def start_live(events: DataFrame, folder: str, *, name: str = "live", run_as_backfill: bool = False,
               block: int = BLOCK) -> StreamingQuery:
    return _start(
        events, live_batch(folder, block), folder, NEVER_LATE_S if run_as_backfill else MAX_LATENESS_S, name
    )


def drain(events: DataFrame, folder: str) -> DataFrame:
    """Everything a stream holds now, through a Parquet sink."""
    spark: SparkSession = events.sparkSession
    query = (
        events.writeStream.format("parquet")
        .option("path", f"{folder}/data")
        .option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return spark.read.schema(events.schema).parquet(f"{folder}/data")
