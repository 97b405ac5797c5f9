"""Validation, conversion, deduplication and lateness on hand-made messages."""

import json
import random
from datetime import datetime, timedelta, timezone

import pytest

from wattloom.operators import ingest, lateness, replay
from wattloom.operators.conform import conform_raw
from wattloom.operators.decode import decode
from wattloom.operators.validate import validate
from wattloom.schema import FACT_NAMES, RAW_DDL

BASE = {"event_id": "e", "event_type": "meter_update", "timestamp": "2024-06-15T10:00:00Z", "station_id": "N_S1",
        "session_id": "s"}


def message(**fields) -> str:
    return json.dumps({k: v for k, v in {**BASE, **fields}.items() if v != "ABSENT"})


def raw_frame(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), RAW_DDL)


REASONS = {
    "valid": (message(), None),
    "missing id": (message(event_id="ABSENT"), "missing_field:event_id"),
    "null id": (message(event_id=None), "missing_field:event_id"),
    "empty id": (message(event_id=""), "missing_field:event_id"),
    "zero id": (message(event_id=0), "missing_field:event_id"),
    "text zero id": (message(event_id="0"), None),
    "missing type": (message(event_type=""), "missing_field:event_type"),
    "missing time": (message(timestamp=None), "missing_field:timestamp"),
    "missing station": (message(station_id=None), "missing_field:station_id"),
    "first rule wins": (message(station_id="", event_type="nope"), "missing_field:station_id"),
    "unknown type": (message(event_type="session_end"), "invalid_event_type:session_end"),
    "bad time": (message(timestamp="not-a-date"), "invalid_timestamp:'not-a-date'"),
    "year only": (message(timestamp="2024"), "invalid_timestamp:'2024'"),
    "month 13": (message(timestamp="2024-13-01T00:00:00"), "invalid_timestamp:'2024-13-01T00:00:00'"),
    "naive time": (message(timestamp="2024-06-15T10:00:00"), None),
    "compact time": (message(timestamp="20240615T100000"), None),
    "date only": (message(timestamp="2024-06-15"), None),
    "no session id": (message(session_id=""), "missing_field:session_id"),
    "no session id needed": (message(event_type="heartbeat", session_id=None), None),
    "soc null": (message(soc_percent=None), None),
    "soc 0": (message(soc_percent=0), None),
    "soc 100": (message(soc_percent=100), None),
    "soc 100.9": (message(soc_percent=100.9), None),
    "soc -0.5": (message(soc_percent=-0.5), None),
    "soc 101": (message(soc_percent=101), "soc_out_of_range:101"),
    "soc -1": (message(soc_percent=-1), "soc_out_of_range:-1"),
    "soc text 0": (message(soc_percent="0"), None),
    "soc text 80": (message(soc_percent=" 80 "), None),
    "soc text 150": (message(soc_percent="150"), "soc_out_of_range:150"),
    "soc text 50.5": (message(soc_percent="50.5"), "invalid_soc_type:'50.5'"),
    "soc empty text": (message(soc_percent=""), "invalid_soc_type:''"),
    "soc list": (message(soc_percent=[1]), "invalid_soc_type:[1]"),
    "soc true": (message(soc_percent=True), None),
    "soc quote": (message(soc_percent="a'b"), 'invalid_soc_type:"a\'b"'),
    "power text": (message(power_kw="150.0"), None),
    "power exponent": (message(power_kw="1e3"), None),
    "power NaN text": (message(power_kw="NaN"), None),
    "power NaN": (message(power_kw=float("nan")), None),
    "power negative": (message(power_kw=-1.5), "negative_power_kw:-1.5"),
    "power hex": (message(power_kw="0x10"), "invalid_power_kw_type:'0x10'"),
    "power suffix": (message(power_kw="1.5d"), "invalid_power_kw_type:'1.5d'"),
    "energy n/a": (message(energy_kwh="n/a"), "invalid_energy_kwh_type:'n/a'"),
    "energy negative": (message(energy_kwh="-3"), "negative_energy_kwh:-3"),
    "power before energy": (message(power_kw=-1, energy_kwh=-1), "negative_power_kw:-1"),
    "broken json": ("{bad json", "json_decode_error:malformed"),
    "empty text": ("", "json_decode_error:malformed"),
    "trailing text": (message() + " x", "json_decode_error:malformed"),
    "single quotes": ("{'event_id':'a','event_type':'heartbeat'}", "json_decode_error:malformed"),
    "two messages": (message() + " " + message(), "json_decode_error:malformed"),
    "two messages, no space": (message() + "{}", "json_decode_error:malformed"),
    "two messages, comma": (message() + "," + message(), "json_decode_error:malformed"),
    "array": ("[1, 2]", "json_decode_error:not_object"),
    "number": ("12", "json_decode_error:not_object"),
    "null": ("null", "json_decode_error:not_object"),
}


def test_reject_reasons(spark):
    raw = raw_frame(spark, [text for text, _ in REASONS.values()])
    found = {r.arrival: r.reason for r in validate(decode(raw)).select("arrival", "reason").collect()}
    wrong = {name: (found[i], expected) for i, (name, (_, expected)) in enumerate(REASONS.items()) if found[i] != expected}
    assert wrong == {}


def test_event_times(spark):
    forms = {
        "2024-06-15T14:30:00+00:00": datetime(2024, 6, 15, 14, 30),
        "2024-01-01T00:00:00Z": datetime(2024, 1, 1),
        "2024-06-15 10:30": datetime(2024, 6, 15, 10, 30),
        "2024-06-15T10:30:05.123456+02:00": datetime(2024, 6, 15, 8, 30, 5, 123456),
        "2024-06-15T10:30:05,5": datetime(2024, 6, 15, 10, 30, 5, 500000),
        "2024-06-15T10:30:05+0530": datetime(2024, 6, 15, 5, 0, 5),
        "20240101": datetime(2024, 1, 1),
        "20240101T000001": datetime(2024, 1, 1, 0, 0, 1),
        "2024-W01-1": None,
        "10:00:00": None,
    }
    raw = raw_frame(spark, [message(timestamp=t) for t in forms])
    rows = decode(raw).selectExpr("arrival", "CAST(event_ts AS timestamp_ntz) AS t").collect()
    assert {list(forms)[r.arrival]: r.t for r in rows} == forms


STOP_EVENT = {
    "event_id": "17", "event_type": "session_stop", "timestamp": "2024-01-15T06:45:10.250+00:00",
    "station_id": "NET4_S00034", "connector_id": "3", "session_id": "SES-34-2024-01-15", "network_id": "NET4",
    "city": "NATION_7", "latitude": "37", "longitude": "43.5", "power_kw": "22.25", "energy_kwh": "8.5",
    "duration_minutes": "51", "revenue_eur": "3.4", "vehicle_brand": None, "fault_severity": None,
}


def conformed(spark, *messages):
    return conform_raw(raw_frame(spark, [json.dumps(m) for m in messages]), "arrival").orderBy("arrival").collect()


def test_texts_become_typed_columns_in_table_order(spark):
    row, = conformed(spark, STOP_EVENT)
    values = row.asDict()
    assert [f for f in values if f != "arrival"] == FACT_NAMES and len(FACT_NAMES) == 28
    assert {k: values[k] for k in ("connector_id", "duration_minutes", "soc_percent")} == {
        "connector_id": 3, "duration_minutes": 51, "soc_percent": 0}
    assert {k: values[k] for k in ("power_kw", "energy_kwh", "latitude", "longitude", "price_per_kwh")} == {
        "power_kw": 22.25, "energy_kwh": 8.5, "latitude": 37.0, "longitude": 43.5, "price_per_kwh": 0.0}
    assert values["vehicle_brand"] == "" and values["country"] == "" and values["city"] == "NATION_7"


def test_error_code_kept_and_missing_fields_defaulted(spark):
    kept, minimal = conformed(spark, {**STOP_EVENT, "error_code": "E77"}, {"event_type": "heartbeat"})
    assert kept.error_code == "E77"
    assert (minimal.event_id, minimal.connector_id, minimal.power_kw, minimal.tariff_id) == ("", 0, 0.0, "")


def test_missing_time_becomes_now(spark):
    rows = conform_raw(raw_frame(spark, [message(timestamp=None), message(timestamp="not-a-date")]))
    ages = rows.selectExpr("abs(unix_micros(current_timestamp()) - unix_micros(timestamp)) / 1e6 AS age").collect()
    assert all(r.age < 60 for r in ages)


def test_falsy_numbers_become_zero_and_floats_are_cut(spark):
    row, = conformed(spark, {**STOP_EVENT, "connector_id": "", "latitude": False, "duration_minutes": 2.9, "voltage_v": []})
    assert (row.connector_id, row.latitude, row.duration_minutes, row.voltage_v) == (0, 0.0, 2, 0.0)


def test_conversion_errors_are_rejected_after_lateness(spark):
    raw = raw_frame(spark, [
        message(event_id="a", connector_id="2.0"),
        message(event_id="b", latitude="north", price_per_kwh="x"),
        message(event_id="c", connector_id="two", timestamp="2024-06-15T09:00:00Z"),
    ])
    found = {r.event_id: r.reason for r in ingest.classify(raw).collect()}
    assert found == {
        "a": "row_conversion_error:invalid literal for int() with base 10: '2.0'",
        "b": "row_conversion_error:could not convert string to float: 'north'",
        "c": "late_event:3300s",
    }


def test_lateness_boundary(spark):
    raw = raw_frame(spark, [
        message(event_id="a"),
        message(event_id="exact", timestamp="2024-06-15T09:55:00Z"),
        message(event_id="late", timestamp="2024-06-15T09:54:59.999Z"),
        message(event_id="half", timestamp="2024-06-15T09:54:57.500Z"),
        message(event_id="own", timestamp="2024-06-15T11:00:00Z"),
        message(event_id="after", timestamp="2024-06-15T10:00:00Z"),
    ])
    found = {r.event_id: r.reason for r in ingest.classify(raw).collect()}
    assert found == {"a": None, "exact": None, "late": "late_event:0s", "half": "late_event:2s", "own": None,
                     "after": "late_event:3300s"}


def test_first_arrival_wins_and_invalid_messages_do_not_count(spark):
    raw = raw_frame(spark, [
        message(event_id="a", soc_percent=500),
        message(event_id="a", city="first"),
        message(event_id="a", city="second"),
        message(event_id="a", soc_percent=500),
        "{bad", "{bad",
    ])
    judged = ingest.classify(raw)
    assert [r.city for r in ingest.accepted(judged).collect()] == ["first"]
    assert ingest.rejected(judged).count() == 4


def test_duplicates_do_not_advance_the_mark(spark):
    raw = raw_frame(spark, [
        message(event_id="a"),
        message(event_id="a", timestamp="2024-06-15T12:00:00Z"),
        message(event_id="b", timestamp="2024-06-15T10:00:01Z"),
    ])
    assert {r.event_id: r.reason for r in ingest.classify(raw).collect()} == {"a": None, "b": None}


def reference_outcome(texts, lateness_s=300):
    """The same rules one message at a time."""
    seen, high, out = set(), None, {}
    for i, text in enumerate(texts):
        event = json.loads(text)
        if event["event_id"] in seen:
            continue
        seen.add(event["event_id"])
        ts = datetime.fromisoformat(event["timestamp"].replace("Z", "+00:00"))
        high = ts if high is None or ts > high else high
        out[i] = ts < high - timedelta(seconds=lateness_s)
    return out


@pytest.mark.parametrize("block", [2, 7, 8192])
def test_running_mark_equals_one_at_a_time(spark, block):
    rng = random.Random(block)
    start = datetime(2024, 6, 15, tzinfo=timezone.utc)
    texts = [
        message(event_id=str(rng.randrange(250)),
                timestamp=(start + timedelta(seconds=60 * i - rng.randrange(900))).isoformat())
        for i in range(300)
    ]
    judged = ingest.classify(raw_frame(spark, texts), block=block)
    found = {r.arrival: r.reason is not None for r in judged.collect()}
    assert found == reference_outcome(texts)


def test_one_id_holding_a_third_of_all_messages(spark):
    texts = [message(event_id="hot" if i % 3 == 0 else str(i)) for i in range(3000)]
    judged = ingest.classify(raw_frame(spark, texts))
    assert judged.count() == 2001 and judged.filter("event_id = 'hot'").first().arrival == 0


def test_metrics_and_watermark_of_nothing(spark):
    raw = raw_frame(spark, [])
    row = ingest.ingest_metrics(raw, ingest.classify(raw)).first()
    assert (row.messages, row.accepted, row.duplicates, row.late_pct) == (0, 0, 0, 0.0)
    assert lateness.current_watermark(ingest.accepted(ingest.classify(raw))).first().watermark_utc is None


def test_replay_takes_each_late_event_once(spark):
    raw = raw_frame(spark, [
        message(event_id="a", event_type="session_stop", energy_kwh=1, timestamp="2024-06-15T10:00:00Z"),
        message(event_id="b", event_type="session_stop", energy_kwh=2, timestamp="2024-06-15T08:10:00Z"),
        message(event_id="c", event_type="session_stop", energy_kwh=4, timestamp="2024-06-15T07:59:00Z"),
    ])
    judged = ingest.classify(raw)
    facts, letters = ingest.accepted(judged), ingest.rejected(judged)
    rows = replay.replayed_rows(letters.union(letters), facts)
    assert sorted(r.event_id for r in rows.collect()) == ["b", "c"]
    assert replay.replayed_rows(letters, facts.drop("arrival").union(rows)).count() == 0
    hours = replay.recomputed_hours(facts, rows).selectExpr("hour(hour) AS h", "total_energy_kwh AS e").collect()
    assert {r.h: r.e for r in hours} == {8: 2.0, 7: 4.0}


def test_a_large_stored_file_is_parsed_in_parts(spark, tmp_path):
    """One file is one task's; its messages are dealt out evenly before they are parsed, whatever hash the log was cut by."""
    texts = [message(event_id=f"e{i // 2}", vehicle_model=random.Random(i).randbytes(200).hex()) for i in range(30_000)]
    raw = raw_frame(spark, texts).repartition(4, "arrival")
    raw.filter("spark_partition_id() = 1").coalesce(1).write.parquet(str(tmp_path / "small"))
    raw.coalesce(1).write.parquet(str(tmp_path / "large"))
    small, large = (spark.read.schema(RAW_DDL).parquet(str(tmp_path / name)) for name in ("small", "large"))
    assert ingest.spread(small) is small
    assert "xxhash64(arrival" in ingest.first_unseen(large)._jdf.queryExecution().optimizedPlan().toString()
    for stored, part_bytes in ((large, ingest.PART_BYTES), (small, 100_000)):
        spread = ingest.spread(stored, part_bytes)
        sizes = [len(p) for p in spread.select("arrival").rdd.glom().collect()]
        assert len(sizes) >= 8 and sum(sizes) == stored.count() and max(sizes) < 1.5 * sum(sizes) / len(sizes)
    assert ingest.first_unseen(large).count() == 15_000


@pytest.fixture
def two_partitions(spark):
    """A session whose shuffles have two partitions, whatever the size of the input."""
    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    spark.conf.set(name, "2")
    yield
    spark.conf.set(name, before)


def test_whole_rows_are_sorted_in_parts_of_a_bounded_size(spark, tmp_path, two_partitions):
    """The shuffles of first arrivals, blocks and late letters follow the stored size, not the session's setting; a hot id
    and repeated rows still leave the earliest message."""
    rng = random.Random(1)
    texts = [
        message(event_id="hot" if i % 3 == 0 else f"e{i // 2}", vehicle_model=rng.randbytes(500).hex(),
                timestamp=f"2024-06-15T{12 - rng.randrange(3):02}:{rng.randrange(60):02}:00Z")
        for i in range(30_000)
    ]
    raw_frame(spark, texts).coalesce(1).write.parquet(str(tmp_path / "stored"))
    stored = spark.read.schema(RAW_DDL).parquet(str(tmp_path / "stored"))
    fresh, judged = ingest.first_unseen(stored), ingest.classify(stored, block=64)
    for rows in (fresh, judged):
        sizes = [len(p) for p in rows.select("arrival", "raw", "reason").rdd.glom().collect()]
        assert len(sizes) >= 8 and max(sizes) < 2 * sum(sizes) / len(sizes)
    found = {r.arrival: r.reason is not None for r in judged.select("arrival", "reason").collect()}
    assert found == reference_outcome(texts) and 1_000 < sum(found.values())


def test_many_late_letters_are_dealt_out_in_parts_and_not_broadcast(spark, tmp_path, two_partitions, monkeypatch):
    """Behind a parsed message Catalyst takes any number of ids for few."""
    texts = [message(event_id=f"e{i}", event_type="session_stop", vehicle_model=random.Random(i).randbytes(500).hex(),
                     timestamp=f"2024-06-15T{10 + i % 2 if i else 23}:00:00Z") for i in range(20_000)]
    raw_frame(spark, texts).coalesce(1).write.parquet(str(tmp_path / "late"))
    judged = ingest.classify(spark.read.schema(RAW_DDL).parquet(str(tmp_path / "late")))
    monkeypatch.setattr(replay, "BROADCAST_BYTES", 1_000_000)
    letters, facts = ingest.rejected(judged), ingest.accepted(judged)
    rows = replay.replayed_rows(letters, facts)
    assert "strategy=broadcast" not in rows._jdf.queryExecution().optimizedPlan().toString()
    assert rows.select("event_id", "vehicle_model").rdd.getNumPartitions() >= 8
    assert rows.count() == 19_999 == replay.late_checked(letters.union(letters)).count()
    hours = replay.recomputed_hours(facts, rows).selectExpr("hour(hour) AS h", "session_count AS n").collect()
    assert {r.h: r.n for r in hours} == {10: 9_999, 11: 10_000}


def test_a_hot_id_is_reduced_before_it_is_dealt_out_by_id(spark, tmp_path):
    texts = [message(event_id="hot", vehicle_model=random.Random(i).randbytes(200).hex()) for i in range(20_000)]
    raw_frame(spark, texts).coalesce(1).write.parquet(str(tmp_path / "hot"))
    stored = spark.read.schema(RAW_DDL).parquet(str(tmp_path / "hot"))
    cells = ingest.spread(stored).select("_cell").distinct().count()
    kept = ingest.first_unseen(stored)
    assert [r.arrival for r in kept.collect()] == [0]
    assert cells <= 8 * ingest.CELLS
    plan = kept._jdf.queryExecution().executedPlan().toString()
    by_id = plan.index("hashpartitioning(dedup_key")
    assert "windowspecdefinition(_cell" in plan[by_id:] and "hashpartitioning(_cell" in plan[by_id:]
