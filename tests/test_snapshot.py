"""Manifests, merges and crashes of running ingests, and the entries that stateful streams keep."""

import os
import random
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from wattloom.operators import ingest, replay, state
from wattloom.schema import FACT_DDL, FACT_NAMES
from wattloom.sources import deadletter, fact, testdata
from wattloom.sources.snapshot import KEPT, Manifest, Run, Snapshots, due, merge_due
from wattloom.streaming import jobs, keyed, tables


def rows(df):
    return sorted(map(repr, df.collect()))


def numbers(snapshots, values, batch):
    listed = snapshots.spark.range(values[0], values[-1] + 1, 1, 1).select(F.col("id").alias("v"))
    run = snapshots.write(listed, "t", Run(f"batch_id={batch}", 0, batch, batch))
    past = snapshots.current() or Manifest()
    return past.with_runs({"t": run})


def values(snapshots):
    return sorted(r.v for r in snapshots.read("t", "v long").collect())


def test_rows_are_there_once_published(spark, tmp_path):
    snapshots = Snapshots(spark, str(tmp_path))
    assert snapshots.current() is None and values(snapshots) == []
    first = snapshots.publish(numbers(snapshots, [1, 2], 0))
    unpublished = numbers(snapshots, [3], 1)
    assert values(snapshots) == [1, 2] and first.version == 1
    other = numbers(snapshots, [9], 2)
    snapshots.publish(unpublished)
    assert values(snapshots) == [1, 2, 3]
    with pytest.raises(RuntimeError):  # made from a manifest that is not the newest any more
        snapshots.publish(other)
    assert values(snapshots) == [1, 2, 3]
    assert snapshots.vacuum() == ["t/batch_id=2"] and values(snapshots) == [1, 2, 3]


def test_two_hundred_batches_keep_few_runs_and_files(spark, tmp_path):
    snapshots, runs, folders, manifests = Snapshots(spark, str(tmp_path)), [], [], []

    def rewrite(table, old, new):
        return snapshots.write(snapshots.read("t", "v long", runs=old).drop("batch_id").coalesce(1), "t", new)

    for batch in range(200):
        snapshots.publish(numbers(snapshots, [batch], batch))
        merge_due(snapshots, rewrite, fanout=4)
        runs.append(len(snapshots.current().runs("t")))
        folders.append(len([d for d in os.listdir(tmp_path / "t") if "=" in d]))
        manifests.append(len(snapshots.versions()))
    assert values(snapshots) == list(range(200))
    # At most three runs on each of four levels, and what the last few manifests still name.
    assert max(runs) <= 13 and max(runs[150:]) <= max(runs[50:150]) + 3
    assert max(manifests) <= KEPT and max(folders) <= 13 + 4 * KEPT


def test_levels_are_merged_when_they_are_full():
    assert due([Run("a"), Run("b"), Run("c", 1)], 3) == []
    assert [r.name for r in due([Run("a", 1), Run("b"), Run("c", 1), Run("d", 1)], 3)] == ["a", "c", "d"]


@pytest.fixture(scope="module")
def pieces(spark, sf):
    raw = testdata.raw_events(spark, sf)
    edges = [0, 300, 600, 900, 1300, 10**9]
    return raw, [raw.filter((F.col("arrival") >= a) & (F.col("arrival") < b)).cache() for a, b in zip(edges, edges[1:])]


def warehouse(spark, folder):
    letters = deadletter.read_dead_letters(spark, f"{folder}/dead_letters").drop("rejected_at", "reject_month", "batch_id")
    sums = tables.read_partials(spark, f"{folder}/rollups", tables.ROLLUP_PARTIALS, "sessions_hourly")
    return (rows(fact.read_fact(spark, f"{folder}/fact").select(*FACT_NAMES)), rows(letters),
            rows(tables.read_errors_daily(spark, f"{folder}/rollups")), rows(sums.select("hour", "network_id", "city", "session_count")),
            rows(tables.read_metrics(spark, f"{folder}/metrics")))


def test_merged_tables_equal_unmerged_ones(spark, pieces, tmp_path):
    raw, parts = pieces
    plain, merged = str(tmp_path / "plain"), str(tmp_path / "merged")
    for number, piece in enumerate([*parts[:2], raw.filter("arrival >= 600")]):
        jobs.warehouse_batch(plain, fanout=100)(piece, number)
        jobs.warehouse_batch(merged, fanout=2)(piece, number)
    assert warehouse(spark, merged) == warehouse(spark, plain)
    manifest = Snapshots(spark, merged).current()
    assert len(manifest.runs("fact")) <= 2 and len(Snapshots(spark, plain).current().runs("fact")) == 3
    assert any(r.level > 0 for r in manifest.runs("fact"))
    judged = ingest.classify(raw)
    assert warehouse(spark, merged)[0] == rows(ingest.accepted(judged).select(*FACT_NAMES))


class Crash(Exception):
    pass


@pytest.mark.parametrize("step", ["fact", "publish", "merge"])
def test_a_crash_before_any_publication_changes_nothing(spark, pieces, tmp_path, monkeypatch, step):
    _, parts = pieces
    folder, whole = str(tmp_path / "crashed"), str(tmp_path / "whole")
    for number, piece in enumerate(parts[:2]):
        jobs.warehouse_batch(whole, fanout=2)(piece, number)
    jobs.warehouse_batch(folder, fanout=2)(parts[0], 0)
    before = warehouse(spark, folder)
    write, publish, published = Snapshots.write, Snapshots.publish, []

    def failing_write(self, df, table, run, part=None):
        done = write(self, df, table, run, part)
        if table == step or (step == "merge" and run.level):
            raise Crash
        return done

    def failing_publish(self, manifest):
        if step == "publish":
            raise Crash
        published.append(manifest)
        return publish(self, manifest)

    with monkeypatch.context() as m:
        m.setattr(Snapshots, "write", failing_write)
        m.setattr(Snapshots, "publish", failing_publish)
        with pytest.raises(Crash):
            jobs.warehouse_batch(folder, fanout=2)(parts[1], 1)
    assert tables.finished_batches(spark, f"{folder}/state") == ([0, 1] if step == "merge" else [0])
    assert warehouse(spark, folder) == (warehouse(spark, whole) if step == "merge" else before)
    jobs.warehouse_batch(folder, fanout=2)(parts[1], 1)
    assert warehouse(spark, folder) == warehouse(spark, whole)


def test_letters_of_a_repeated_batch_count_once_over_a_months_end(spark, pieces, tmp_path, monkeypatch):
    _, parts = pieces
    folder, publish = str(tmp_path / "w"), Snapshots.publish
    rejected = ingest.rejected
    for month, fails in ((1, True), (2, False)):
        stamp = datetime(2024, month, 28, tzinfo=timezone.utc)
        with monkeypatch.context() as m:
            m.setattr(jobs.ingest, "rejected", lambda df, now=None: rejected(df, stamp))
            if fails:
                m.setattr(Snapshots, "publish", lambda self, manifest: (_ for _ in ()).throw(Crash()))
                with pytest.raises(Crash):
                    jobs.warehouse_batch(folder)(parts[0], 0)
            else:
                jobs.warehouse_batch(folder)(parts[0], 0)
    letters = deadletter.read_dead_letters(spark, f"{folder}/dead_letters")
    assert Snapshots.publish is publish
    assert {r.reject_month for r in letters.select("reject_month").distinct().collect()} == {"2024-02"}
    assert letters.count() == rejected(ingest.classify(parts[0])).count()


def test_expired_months_leave_the_manifest(spark, events, tmp_path):
    months = events(*[{"event_type": "heartbeat", "timestamp": f"2024-0{m}-15T12:00:00"} for m in range(1, 6)])
    snapshots = Snapshots(spark, str(tmp_path))
    run = fact.write_fact_run(snapshots, months, Run("batch_id=0"))
    snapshots.publish(Manifest().with_runs({"fact": run}))
    path = str(tmp_path / "fact")
    assert run.parts == tuple(f"2024-0{m}" for m in range(1, 6))
    assert fact.read_fact(spark, path, since=datetime(2024, 4, 1)).count() == 2
    assert fact.newest_timestamp(spark, path) == datetime(2024, 5, 15, 12, tzinfo=timezone.utc)
    assert fact.drop_expired(spark, path, days=60, as_of=datetime(2024, 5, 20)) == ["event_month=2024-01", "event_month=2024-02"]
    assert fact.read_fact(spark, path).count() == 3


def test_replay_of_a_period_is_exact_and_happens_once(spark, pieces, tmp_path):
    """Half the late events first, an overlapping period next, then the rest: each is taken once, and only its own days change."""
    raw, parts = pieces
    folder = str(tmp_path / "w")
    for number, piece in enumerate(parts):
        jobs.warehouse_batch(folder)(piece, number)
    late = ingest.rejected(ingest.classify(raw)).filter("reason LIKE 'late_event:%'")
    middle = datetime.fromtimestamp(late.agg(F.percentile_approx(F.unix_micros("timestamp"), 0.5)).first()[0] / 1e6, timezone.utc)
    letters = deadletter.read_dead_letters(spark, f"{folder}/dead_letters").count()
    before = {r.event_id for r in fact.read_fact(spark, f"{folder}/fact").select("event_id").collect()}
    jobs.replay_late(spark, folder, "early", until=middle)
    first = {r.event_id for r in fact.read_fact(spark, f"{folder}/fact").filter("batch_id = 'replay-early'").collect()}
    assert first == {r.event_id for r in late.collect() if r.timestamp.replace(tzinfo=None) < middle.astimezone().replace(tzinfo=None)} - before
    jobs.replay_late(spark, folder, "early", until=middle)
    jobs.replay_late(spark, folder, "again", until=middle)
    assert fact.read_fact(spark, f"{folder}/fact").count() == len(before) + len(first)
    jobs.replay_late(spark, folder, "rest", since=middle)
    whole = ingest.accepted(ingest.classify(raw, lateness_s=jobs.NEVER_LATE_S))
    assert rows(fact.read_fact(spark, f"{folder}/fact").select(*FACT_NAMES)) == rows(whole.select(*FACT_NAMES))
    ledger = Snapshots(spark, folder).read(tables.REPLAYED, tables.REPLAYED_DDL)
    assert ledger.count() == ledger.select("event_id").distinct().count() == late.select("event_id").distinct().count()
    assert deadletter.read_dead_letters(spark, f"{folder}/dead_letters").count() == letters


def test_recomputed_hours_read_their_months_only(spark, events, tmp_path):
    months = events(*[{"event_type": "session_stop", "timestamp": f"2024-0{m}-15T12:00:00", "energy_kwh": 1.0} for m in range(1, 6)])
    fact.write_fact(months, str(tmp_path / "fact"))
    late = events({"event_id": "late", "event_type": "session_stop", "timestamp": "2024-03-15T12:30:00", "energy_kwh": 2.0})
    late.write.parquet(str(tmp_path / "late"))
    late = spark.read.parquet(str(tmp_path / "late"))
    stored = fact.read_fact(spark, str(tmp_path / "fact"))
    for recompute, n in ((replay.recomputed_hours, 1), (replay.recomputed_days, 1)):
        found = recompute(stored, late)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "dynamicpruning" in plan.lower() and [r.total_energy_kwh for r in found.collect()] == [3.0] * n


def random_events(seed, n=400, minutes=400):
    r, start = random.Random(seed), datetime(2024, 3, 1, tzinfo=timezone.utc)
    kinds = ["session_start", "meter_update", "session_stop", "status_change", "fault_alert", "heartbeat"]
    return [{"event_id": f"e{i:05d}", "event_type": r.choice(kinds), "station_id": f"st{r.randint(0, 5)}",
             "session_id": f"se{r.randint(0, 12)}", "status": r.choice(["", "offline", "available"]), "error_code": f"E{i % 4}",
             "energy_kwh": float(i), "soc_percent": i % 100, "network_id": "n",
             "timestamp": (start + timedelta(seconds=r.randint(0, 60 * minutes))).isoformat()[:19]} for i in range(n)]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_lives_join_in_any_order(events, seed):
    listed = random_events(seed)
    r = random.Random(seed)
    df = events(*listed)
    now = df.agg(F.max("timestamp")).scalar()
    share = {e["event_id"]: r.randint(0, 2) for e in listed}
    batches = [events(*[e for e in listed if share[e["event_id"]] == b]) for b in range(3)]
    lives = [state.station_cells(b) for b in batches]
    joined = state.station_lives(state.station_lives(lives[2].unionByName(lives[0])).unionByName(lives[1]))
    assert rows(state.station_status(joined, now)) == rows(state.station_status_history(df))


@pytest.mark.parametrize("seed", [4, 5, 6])
def test_expired_entries_are_not_missed(events, seed):
    """Old cells pruned at a cutoff, then later events: the entries alive now come out as without pruning."""
    listed = sorted(random_events(seed, 500, 600), key=lambda e: e["timestamp"])
    df = events(*listed)
    now = df.agg(F.max("timestamp")).scalar()
    cut = listed[300]["timestamp"]
    early, late = events(*[e for e in listed if e["timestamp"] < cut]), events(*[e for e in listed if e["timestamp"] >= cut])
    cutoff = F.lit(datetime.fromisoformat(cut).replace(tzinfo=timezone.utc))

    cells = state.session_cells(early)
    kept = state.sessions_since(cells, cutoff)
    assert kept.count() < cells.count()
    both = state.merge_cells(kept.unionByName(state.session_cells(late)), ["session_id"])
    assert rows(state.live_sessions(both, now)) == rows(state.live_sessions_at(df))

    lives = state.lives_since(state.station_lives(state.station_cells(early)), cutoff)
    stations = state.station_status(lives.unionByName(state.station_cells(late)), now).filter("is_live").drop("is_live")
    assert rows(stations) == rows(state.station_status_live(df, as_of=now))
    assert lives.count() <= 6


def test_streamed_entries_stay_few(spark, events, tmp_path):
    """Twelve batches of an hour each, with restarts: neither the state store nor the live table grows, and resent events
    change nothing."""
    start, source, folder, held, stored = datetime(2024, 3, 1), str(tmp_path / "log"), str(tmp_path / "live"), [], []
    seen = []
    for hour in range(12):
        at = [start + timedelta(hours=hour, minutes=m) for m in range(0, 60, 4)]
        batch = [{"event_id": f"{hour:02d}{i:02d}", "event_type": ["session_start", "session_stop", "fault_alert"][i % 3],
                  "station_id": f"st{i % 3}", "session_id": f"se{hour}-{i // 3}", "error_code": "E1", "timestamp": t.isoformat()}
                 for i, t in enumerate(at)]
        seen += batch
        again = seen[-3:] if hour % 4 == 0 else []
        events(*batch, *again).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(FACT_DDL).parquet(source)
        query = keyed.start_entries(stream, folder, keyed.STATIONS, run_as_backfill=True, fanout=3)
        query.awaitTermination()
        held.append(max(p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]))
        stored.append(spark.read.parquet(*[
            f"{folder}/live/station_cells/{r.name}" for r in Snapshots(spark, folder).current().runs("live/station_cells")]).count())
    assert max(held[6:]) <= max(held[:6]) and max(stored[6:]) <= max(stored[:6]) + 3
    facts = events(*seen)
    now = facts.agg(F.max("timestamp")).scalar()
    live = state.station_status(keyed.read_entries(spark, folder, keyed.STATIONS), now).filter("is_live").drop("is_live")
    assert rows(live) == rows(state.station_status_live(facts, as_of=now))


def test_messages_become_facts_for_the_streams(spark, pieces):
    raw, _ = pieces
    from pyspark.sql.types import TimestampType

    found = keyed.facts_of(raw)
    assert found.columns == FACT_NAMES and isinstance(found.schema["timestamp"].dataType, TimestampType)
    valid = ingest.check(raw).filter("reason IS NULL AND conversion_error IS NULL")
    assert found.count() == valid.count() > 0
