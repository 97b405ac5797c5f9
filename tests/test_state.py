"""Live state against a one-event-at-a-time model with the same time-to-live rules."""

import random
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from wattloom.operators import state
from wattloom.schema import FACT_DDL, FACT_NAMES

START = datetime(2024, 3, 1, tzinfo=timezone.utc)


class Store:
    """Hashes with expiry."""

    def __init__(self):
        self.data, self.dies = {}, {}

    def _purge(self, key, now):
        if key in self.dies and now >= self.dies[key]:
            self.data.pop(key, None)
            self.dies.pop(key)

    def put(self, key, now, life=None, **fields):
        self._purge(key, now)
        self.data.setdefault(key, {}).update(fields)
        if life:
            self.dies[key] = now + timedelta(seconds=life)

    def delete(self, key):
        self.data.pop(key, None)
        self.dies.pop(key, None)

    def alive(self, now):
        for key in list(self.data):
            self._purge(key, now)
        return self.data


def replay_events(rows):
    sessions, stations = Store(), Store()
    for r in sorted(rows, key=lambda r: (r["timestamp"], r["event_id"])):
        kind, now, sid, station = r["event_type"], r["timestamp"], r["session_id"], r["station_id"]
        if kind == "session_start":
            sessions.put(sid, now, 3600, start_time=now, soc_start=r["soc_percent"])
            stations.put(station, now, 300, status="charging", session_id=sid, last_updated=now)
        elif kind == "meter_update":
            sessions.put(sid, now, energy_kwh=r["energy_kwh"], last_updated=now)
        elif kind == "session_stop":
            sessions.delete(sid)
            stations.put(station, now, 300, status="available", session_id="", last_updated=now)
        elif kind == "status_change":
            stations.put(station, now, 300, status=r["status"], last_updated=now)
        elif kind == "fault_alert":
            stations.put(station, now, 300, status="fault", error_code=r["error_code"], last_updated=now)
    newest = max(r["timestamp"] for r in rows)
    return sessions.alive(newest), stations.alive(newest)


def random_rows(seed, n=1500, span_s=6 * 3600, keys=40):
    rng = random.Random(seed)
    kinds = ["session_start"] * 4 + ["meter_update"] * 4 + ["session_stop", "status_change", "fault_alert", "heartbeat"]
    rows = []
    for i in range(n):
        key = rng.randrange(keys)
        rows.append({
            "event_id": f"{i:05d}", "event_type": rng.choice(kinds),
            "timestamp": START + timedelta(seconds=rng.randrange(0, span_s, 100)),
            "session_id": f"s{key}", "station_id": f"st{key}", "soc_percent": rng.randrange(100),
            "energy_kwh": float(i), "status": rng.choice(["available", "offline"]), "error_code": rng.choice(["E1", "E2"]),
        })
    return rows


def frame(spark, rows):
    empty = {"string": "", "int": 0, "double": 0.0}
    types = dict(part.strip().replace("`", "").split(" ") for part in FACT_DDL.split(","))
    return spark.createDataFrame([tuple(r.get(n, empty.get(types[n])) for n in FACT_NAMES) for r in rows], FACT_DDL)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_live_sessions_and_stations_equal_the_model(spark, seed):
    rows = random_rows(seed)
    sessions, stations = replay_events(rows)
    df = frame(spark, rows)

    def moment(value):
        return None if value is None else value.astimezone(timezone.utc)

    found = {
        r.session_id: {k: v for k, v in (("start_time", moment(r.start_time)),
                                         ("soc_start", r.soc_start if r.has_start else None),
                                         ("energy_kwh", r.energy_kwh), ("last_updated", moment(r.last_updated)))
                       if v is not None}
        for r in state.live_sessions_at(df).collect()
    }
    assert found == sessions
    live = {
        r.station_id: {k: v for k, v in (("status", r.status), ("session_id", r.session_id),
                                         ("error_code", r.error_code), ("last_updated", moment(r.last_updated)))
                       if v is not None}
        for r in state.station_status_live(df).collect()
    }
    assert live == stations


def test_cells_of_batches_merge_into_the_same_state(spark):
    df = frame(spark, random_rows(9))
    now = df.agg(F.max("timestamp")).scalar()
    halves = [df.filter("CAST(event_id AS INT) % 2 = 0"), df.filter("CAST(event_id AS INT) % 2 = 1")]
    sessions = state.merge_cells(state.session_cells(halves[0]).union(state.session_cells(halves[1])), ["session_id"])
    stations = state.merge_cells(state.station_cells(halves[0]).union(state.station_cells(halves[1])), ["station_id"])

    def rows(result):
        return sorted(map(repr, result.collect()))

    assert rows(state.live_sessions(sessions, now)) == rows(state.live_sessions_at(df))
    assert rows(state.station_status(stations, now)) == rows(state.station_status_history(df))


def test_gap_of_exactly_the_life_starts_an_empty_entry(events):
    def history(seconds):
        df = events(
            {"event_type": "fault_alert", "station_id": "a", "error_code": "E1", "timestamp": "2024-03-01T00:00:00"},
            {"event_type": "status_change", "station_id": "a", "status": "offline",
             "timestamp": f"2024-03-01T00:0{seconds // 60}:{seconds % 60:02d}"},
        )
        return [(r.status, r.error_code) for r in state.station_status_history(df).orderBy("segment_start").collect()]

    assert history(299) == [("offline", "E1")]
    assert history(300) == [("fault", "E1"), ("offline", None)]


def test_counters_go_negative_and_the_display_does_not(events):
    df = events({"event_type": "session_stop", "network_id": "n", "timestamp": "2024-03-01T00:00:00"})
    assert tuple(state.active_global(df).first()) == (-1, 0)
    assert tuple(state.active_by_city(df).first()) == ("unknown", -1)


def test_live_board_ends_a_day_after_its_last_write(events):
    rows = [{"event_type": "session_stop", "station_id": "a", "revenue_eur": 5.0, "timestamp": "2024-03-01T10:00:00"},
            {"event_type": "session_stop", "station_id": "b", "revenue_eur": 0.0, "timestamp": "2024-03-02T09:00:00"}]
    last = {"event_type": "heartbeat", "station_id": "b"}
    alive = events(*rows, {**last, "timestamp": "2024-03-02T09:59:59"})
    dead = events(*rows, {**last, "timestamp": "2024-03-02T10:00:00"})
    assert [r.station_id for r in state.leaderboard(alive, "station_id", live_only=True).collect()] == ["a"]
    assert state.leaderboard(dead, "station_id", live_only=True).count() == 0


def test_top_n_breaks_ties_by_member(events):
    df = events(*[
        {"event_type": "session_stop", "station_id": s, "revenue_eur": 2.0, "timestamp": "2024-03-01T10:00:00"}
        for s in "cab"
    ])
    top = state.leaderboard_top(df, n=2).orderBy("rank").collect()
    assert [(r.station_id, r.rank) for r in top] == [("a", 1), ("b", 2)]
