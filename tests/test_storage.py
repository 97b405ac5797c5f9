"""Fact and dead-letter tables, export, encoding, and the two streaming consumers."""

import json
import os
import time
from datetime import date, datetime, timezone

import pytest
from pyspark.sql import functions as F

from wattloom.functions.windows import trailing
from wattloom.operators import ingest, state
from wattloom.schema import FACT_NAMES
from wattloom.sources import deadletter, export, fact, streams, testdata
from wattloom.streaming import jobs, tables

NOW = datetime(2024, 5, 20, tzinfo=timezone.utc)


def rows(df):
    return sorted(map(repr, df.collect()))


@pytest.fixture()
def months(events):
    return events(*[
        {"event_type": "session_stop", "timestamp": f"2024-0{m}-{d:02d}T12:00:00"} for m in range(1, 6) for d in (1, 15)
    ])


def test_fact_months_pruning_and_retention(spark, months, tmp_path):
    path = str(tmp_path / "fact")
    fact.write_fact(months, path, "first")
    fact.write_fact(months, path, "first")
    assert rows(fact.read_fact(spark, path).select(*FACT_NAMES)) == rows(months)
    recent = fact.read_fact(spark, path, since=datetime(2024, 4, 10))
    assert recent.count() == 3
    scan = recent._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_month" in scan and "PushedFilters: [IsNotNull(timestamp)" in scan
    assert fact.newest_timestamp(spark, path) == datetime(2024, 5, 15, 12, tzinfo=timezone.utc)
    assert fact.drop_expired(spark, path, days=90, as_of=NOW) == ["event_month=2024-01"]
    assert fact.read_fact(spark, path).count() == 8
    assert fact.retain(fact.read_fact(spark, path), days=90, as_of=NOW).count() == 6


def test_loads_without_an_id_add_up(spark, months, tmp_path):
    path = str(tmp_path / "fact")
    early, late = months.filter("day(timestamp) = 1"), months.filter("day(timestamp) = 15")
    fact.write_fact(early, path)
    fact.write_fact(late, path)
    assert rows(fact.read_fact(spark, path).select(*FACT_NAMES)) == rows(months)


def test_months_are_utc_whatever_the_session_says(spark, events, tmp_path):
    path = str(tmp_path / "fact")
    moved = events({"event_type": "heartbeat", "timestamp": "2024-02-01T02:00:00"})
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        fact.write_fact(moved, path)
        assert fact.read_fact(spark, path, since=datetime(2024, 2, 1)).count() == 1
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_trailing_windows_read_their_months_only(spark, months, tmp_path):
    path = str(tmp_path / "fact")
    fact.write_fact(months, path)
    stored = fact.read_fact(spark, path)
    for as_of in (None, NOW, F.current_timestamp(), F.lit(NOW)):
        asked = trailing(stored, as_of, days=7)
        assert "event_month" in asked._jdf.queryExecution().executedPlan().toString().split("PartitionFilters: [")[1]
    assert trailing(stored, None, days=7).count() == 1
    assert trailing(stored, NOW, days=25).count() == 2


def test_export_of_one_day_in_time_order(spark, months, tmp_path):
    export.export(months, str(tmp_path / "day"), date(2024, 3, 15))
    export.export(months, str(tmp_path / "all"), batch=3)
    assert spark.read.parquet(str(tmp_path / "day")).count() == 1
    out = spark.read.parquet(str(tmp_path / "all"))
    assert out.columns == FACT_NAMES and out.count() == 10
    assert all("snappy" in f.name for f in (tmp_path / "all").glob("*.parquet"))


def test_encoded_messages_read_back_as_the_same_rows(spark, sf):
    facts = testdata.charging_events(spark, sf).filter("event_id < '2'")
    messages = export.encode(facts).select(F.monotonically_increasing_id().alias("arrival"), F.col("value").alias("raw"))
    assert len(json.loads(messages.first().raw)) == 28
    back = ingest.accepted(ingest.classify(messages, lateness_s=10**9))
    ms = facts.withColumn("timestamp", F.date_trunc("MILLISECOND", "timestamp"))
    assert rows(back.select(*FACT_NAMES)) == rows(ms)


def test_dead_letters_as_json_lines(spark, tmp_path):
    raw = spark.createDataFrame([(0, "{bad"), (1, '{"event_id":"a","x":[1]}')], "arrival bigint, raw string")
    deadletter.write_dead_letters(ingest.rejected(ingest.classify(raw), NOW), str(tmp_path / "letters"))
    stored = deadletter.read_dead_letters(spark, str(tmp_path / "letters"))
    deadletter.export_dead_letters(stored, str(tmp_path / "lines"))
    lines = sorted((json.loads(r.value) for r in spark.read.text(str(tmp_path / "lines")).collect()),
                   key=lambda r: r["reason"])
    assert [r["reason"] for r in lines] == ["json_decode_error:malformed", "missing_field:event_type"]
    assert lines[0]["event"] == "{bad" and lines[1]["event"] == {"event_id": "a", "x": [1]}
    assert lines[0]["rejected_at"].startswith("2024-05-20T00:00:00")


def test_stream_options():
    live, backfill = (streams.kafka_options("h:9092", "t", s) for s in (300, 999_999))
    assert live["startingOffsets"] == "latest" and backfill["startingOffsets"] == "earliest"
    assert "maxOffsetsPerTrigger" not in live and "maxOffsetsPerTrigger" not in backfill
    limited = streams.kafka_options("h:9092", "t", 300, per_trigger=250_000, min_partitions=64)
    assert (limited["maxOffsetsPerTrigger"], limited["minPartitions"]) == ("250000", "64")
    assert streams.trigger_of(999_999) == {"availableNow": True}
    assert streams.trigger_of(300) == {"processingTime": "5 seconds"}


def test_log_order_becomes_arrival_order(spark):
    log = spark.range(1000).selectExpr(
        "CAST(id AS STRING) AS raw", "CAST(id % 4 AS INT) AS partition", "id AS offset",
        "timestamp_seconds(1700000000 + id DIV 10) AS log_time")
    numbered = streams.with_arrival(log).collect()
    ordered = [r.raw for r in sorted(numbered, key=lambda r: r.arrival)]
    expected = sorted(range(1000), key=lambda i: (i // 10, i % 4, i))
    assert ordered == [str(i) for i in expected] and len({r.arrival for r in numbered}) == 1000


@pytest.fixture(scope="module")
def chunks(spark, sf):
    """The raw messages cut by arrival into four pieces."""
    raw = testdata.raw_events(spark, sf)
    edges = [0, 500, 900, 1500, 10**9]
    return raw, [raw.filter((F.col("arrival") >= a) & (F.col("arrival") < b)) for a, b in zip(edges, edges[1:])]


def feed(folder, piece):
    piece.coalesce(1).write.mode("append").parquet(str(folder))


def warehouse_state(spark, folder):
    letters = deadletter.read_dead_letters(spark, f"{folder}/dead_letters").drop("rejected_at", "reject_month", "batch_id")
    return (
        rows(fact.read_fact(spark, f"{folder}/fact").select(*FACT_NAMES)),
        rows(letters),
        rows(tables.read_errors_daily(spark, f"{folder}/rollups")),
    )


def test_micro_batches_and_restarts_equal_one_batch(spark, chunks, tmp_path):
    raw, pieces = chunks
    source, folder = tmp_path / "source", str(tmp_path / "warehouse")
    for piece in pieces:  # each round is a new query on the same checkpoint
        feed(source, piece)
        jobs.start_warehouse(streams.read_folder(spark, str(source)), folder, run_as_backfill=True).awaitTermination()
    judged = ingest.classify(raw)
    facts = ingest.accepted(judged)
    from wattloom.operators import rollups

    letters = ingest.rejected(judged).drop("rejected_at")
    assert warehouse_state(spark, folder) == (
        rows(facts.select(*FACT_NAMES)), rows(letters), rows(rollups.errors_daily(facts)))
    assert tables.finished_batches(spark, f"{folder}/state") == [0, 1, 2, 3]
    hourly = tables.read_partials(spark, f"{folder}/rollups", tables.ROLLUP_PARTIALS, "sessions_hourly")
    assert hourly.agg(F.sum("session_count")).first()[0] == facts.filter("event_type = 'session_stop'").count()


def test_a_repeated_batch_replaces_its_own_rows(spark, chunks, tmp_path):
    _, pieces = chunks
    folder = str(tmp_path / "warehouse")
    run = jobs.warehouse_batch(folder)
    run(pieces[0], 0)
    run(pieces[1], 1)
    before = warehouse_state(spark, folder)
    run(pieces[1], 1)
    assert warehouse_state(spark, folder) == before


def test_replay_fills_facts_and_rollups_once(spark, chunks, tmp_path):
    raw, pieces = chunks
    folder = str(tmp_path / "warehouse")
    run = jobs.warehouse_batch(folder)
    for number, piece in enumerate(pieces):
        run(piece, number)
    for replay_id in ("one", "one", "two"):
        jobs.replay_late(spark, folder, replay_id)
    whole = ingest.accepted(ingest.classify(raw, lateness_s=jobs.NEVER_LATE_S))
    assert rows(fact.read_fact(spark, f"{folder}/fact").select(*FACT_NAMES)) == rows(whole.select(*FACT_NAMES))
    from wattloom.operators import rollups

    assert rows(tables.read_errors_daily(spark, f"{folder}/rollups")) == rows(rollups.errors_daily(whole))
    stored = tables.read_partials(spark, f"{folder}/rollups", tables.ROLLUP_PARTIALS, "network_revenue_daily")
    expected = rollups.network_revenue_daily(whole)
    counts = ["day", "network_id", "session_count"]
    assert rows(stored.select(counts)) == rows(expected.select(counts))


def test_live_consumer_counts_late_events_too(spark, chunks, tmp_path):
    raw, pieces = chunks
    folder = str(tmp_path / "live")
    run = jobs.live_batch(folder)
    for number, piece in enumerate(pieces):
        run(piece, number)
    facts = ingest.accepted(ingest.classify(raw, lateness_s=jobs.NEVER_LATE_S))
    now = facts.agg(F.max("timestamp")).scalar()

    def stored(name):
        return tables.read_partials(spark, f"{folder}/live", tables.LIVE_PARTIALS, name)

    assert rows(stored("event_counts")) == rows(state.event_counts(facts))
    assert rows(stored("active_counts")) == rows(state.active_counts(facts))
    assert rows(state.station_status(stored("station_cells"), now)) == rows(state.station_status_history(facts))
    assert rows(state.live_sessions(stored("session_cells"), now)) == rows(state.live_sessions_at(facts))


@pytest.mark.parametrize("consumer, letters", [(jobs.live_batch, False), (jobs.warehouse_batch, True)])
def test_a_batch_keeps_on_disk_only_what_its_next_step_reads(spark, sf, tmp_path, monkeypatch, consumer, letters):
    batch, folder, stored, staged = testdata.raw_events(spark, sf), str(tmp_path / "consumer"), {}, []
    store, together = jobs.store, jobs.together

    def watched_store(df, path):
        stored[os.path.basename(path)] = set(df.columns)
        return store(df, path)

    def watched_steps(steps):
        staged.append(sorted(os.listdir(f"{folder}/stage")))
        judged = spark.read.parquet(f"{folder}/stage/classified")
        assert judged.filter("reason IS NULL AND fact IS NULL").isEmpty()
        if letters:
            assert judged.filter("isnull(reason) = isnotnull(raw)").isEmpty()
        return together(steps)

    def shuffles():
        found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
        return {name for top in found for _, _, names in os.walk(str(top)) for name in names if name.startswith("shuffle_")}

    monkeypatch.setattr(jobs, "store", watched_store)
    monkeypatch.setattr(jobs, "together", watched_steps)
    before = shuffles()
    consumer(folder)(batch, 0)
    # Stored messages get no copy, and only letters need their text.
    assert sorted(stored) == ["classified", "first"] and staged == [["classified"]]
    assert all(("raw" in columns) == letters for columns in stored.values())
    until = time.time() + 30
    while shuffles() - before and time.time() < until:  # they are deleted in the background
        time.sleep(0.2)
    assert not shuffles() - before
    assert batch.sparkSession.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"
