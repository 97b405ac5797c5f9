"""Live state of sessions, stations and counters, derived from the events in (timestamp, event_id) order.

Keyed state with a time-to-live is first reduced per key and fixed time cell of that length: within one cell no gap
can reach the time-to-live, so a cell needs only its first and last writes. That reduction is a plain aggregation
with map-side partials, and the windows over a key then see one row per cell of the retained period, however hot
the key is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from wattloom.functions.numeric import count_where, n_rows, ratio, rnd, rsum
from wattloom.functions.windows import AsOf, day_bucket, reference_time, seconds_between, time_cell
from wattloom.schema import (
    EVENT_TYPES, FAULT, LEADERBOARD_TTL_S, METER, METER_FIELDS, SESSION_TTL_S, START, START_FIELDS, STATION_TTL_S, STATUS_CHANGE, STOP,
)


def _is(event_type: str) -> Column:
    return F.col("event_type") == event_type


def _or(name: str, default: str) -> Column:
    return F.coalesce(F.nullif(F.col(name), F.lit("")), F.lit(default))


def _city() -> Column:
    return _or("city", "unknown")


def _until(df: DataFrame, as_of: AsOf) -> DataFrame:
    return df if as_of is None else df.filter(F.col("timestamp") <= reference_time(df, as_of))


# ---- counters --------------------------------------------------------------------------------------------------


def with_total(counts: DataFrame, key: str, measure: str) -> DataFrame:
    """The counts plus one row 'total'; the input has one row per key."""
    return (
        counts.rollup(key)
        .agg(F.sum(measure).alias(measure), F.grouping(key).alias("_all"))
        .select(F.when(F.col("_all") == 1, "total").otherwise(F.col(key)).alias(key), measure)
    )


def event_counts(df: DataFrame) -> DataFrame:
    return df.groupBy("event_type").agg(n_rows().alias("events"))


def event_counters(df: DataFrame) -> DataFrame:
    return with_total(event_counts(df), "event_type", "events")


def fault_counts(df: DataFrame) -> DataFrame:
    code = _or("error_code", "UNKNOWN").alias("error_code")
    return df.filter(_is(FAULT)).groupBy(day_bucket().alias("day"), "network_id", code).agg(n_rows().alias("faults"))


def fault_counters(df: DataFrame) -> DataFrame:
    return with_total(fault_counts(df).groupBy("error_code").agg(F.sum("faults").alias("faults")), "error_code", "faults")


def faults_network_daily(df: DataFrame) -> DataFrame:
    return fault_counts(df).groupBy("day", "network_id").agg(F.sum("faults").alias("faults"))


def status_counts(df: DataFrame) -> DataFrame:
    return (
        df.filter(_is(STATUS_CHANGE)).groupBy(_or("status", "unknown").alias("status")).agg(n_rows().alias("changes"))
    )


def _active() -> Column:
    """Starts less stops; may go below zero."""
    opened = _is(START) & (F.col("session_id") != "")
    return F.coalesce(F.sum(F.when(opened, 1).when(_is(STOP), -1)), F.lit(0)).alias("active_sessions")


def active_counts(df: DataFrame) -> DataFrame:
    return (
        df.filter(F.col("event_type").isin(START, STOP)).groupBy("network_id", _city().alias("city")).agg(_active())
    )


def active_by_network(df: DataFrame) -> DataFrame:
    return df.filter(F.col("event_type").isin(START, STOP)).groupBy("network_id").agg(_active())


def active_by_city(df: DataFrame) -> DataFrame:
    return df.filter(F.col("event_type").isin(START, STOP)).groupBy(_city().alias("city")).agg(_active())


def active_global(df: DataFrame) -> DataFrame:
    """One row: the signed counter, and what a display shows of it."""
    return df.agg(_active()).withColumn("active_shown", F.greatest(F.lit(0).cast("bigint"), "active_sessions"))


def energy_daily(df: DataFrame, *keys: str) -> DataFrame:
    delivered = df.filter(_is(STOP) & (F.col("energy_kwh") > 0))
    return delivered.groupBy(day_bucket().alias("day"), *keys).agg(rsum("energy_kwh").alias("energy_kwh"))


def day_sums(df: DataFrame) -> DataFrame:
    """Revenue and energy of a day's stops per station, the additive base of leaderboards and daily energy."""
    return (
        df.filter(_is(STOP))
        .groupBy(day_bucket().alias("day"), "station_id", "network_id", _city().alias("city"))
        .agg(
            F.sum(F.when(F.col("revenue_eur") > 0, F.col("revenue_eur"))).alias("revenue_eur"),
            F.sum(F.when(F.col("energy_kwh") > 0, F.col("energy_kwh"))).alias("energy_kwh"),
        )
    )


# ---- leaderboards ----------------------------------------------------------------------------------------------


def leaderboard(df: DataFrame, member: str, *, as_of: AsOf = None, live_only: bool = False) -> DataFrame:
    """Revenue per day and member; a day's board lives until 24 h after its last write."""
    name = _city() if member == "city" else F.col(member)
    paid = _until(df, as_of).filter(_is(STOP) & (F.col("revenue_eur") > 0))
    sums = paid.groupBy(day_bucket().alias("day"), name.alias(member)).agg(
        F.sum("revenue_eur").alias("_revenue"), F.max("timestamp").alias("_written")
    )
    if live_only:
        now = reference_time(df, as_of)
        boards = sums.groupBy("day").agg(F.max("_written").alias("_last")).filter(
            seconds_between(now, F.col("_last")) < LEADERBOARD_TTL_S
        )
        sums = sums.join(boards, "day", "left_semi")
    return sums.select("day", member, rnd(F.col("_revenue"), 2).alias("revenue_eur"))


def leaderboard_top(df: DataFrame, member: str = "station_id", *, n: int = 10) -> DataFrame:
    """The n best members of each day. The rank filter is a top-n, applied before the shuffle too."""
    by_revenue = Window.partitionBy("day").orderBy(F.desc("revenue_eur"), member)
    ranked = leaderboard(df, member).withColumn("rank", F.row_number().over(by_revenue))
    return ranked.filter(F.col("rank") <= n)


# ---- stations --------------------------------------------------------------------------------------------------


def station_writes(df: DataFrame) -> DataFrame:
    """The events that write a station's status entry."""
    opened = _is(START) & (F.col("session_id") != "")
    return df.filter(opened | F.col("event_type").isin(STOP, STATUS_CHANGE, FAULT))


def station_fields() -> list[Column]:
    """First and last write, and the last write of each field, as aggregates over `station_writes`."""
    status = (
        F.when(_is(START), "charging").when(_is(STOP), "available").when(_is(FAULT), "fault")
        .otherwise(_or("status", "unknown"))
    )

    def stamped(value: Column) -> Column:
        return F.struct(F.col("timestamp").alias("ts"), F.col("event_id").alias("id"), value.alias("value"))

    session = F.when(_is(START), F.col("session_id")).when(_is(STOP), F.lit(""))
    return [
        F.min("timestamp").alias("first_ts"),
        F.max("timestamp").alias("last_ts"),
        F.max(stamped(status)).alias("status"),
        F.max(F.when(F.col("event_type").isin(START, STOP), stamped(session))).alias("session"),
        F.max(F.when(_is(FAULT), stamped(_or("error_code", "UNKNOWN")))).alias("error"),
    ]


def station_cells(df: DataFrame) -> DataFrame:
    """Last write of each status field per station and five-minute cell. Additive over batches: see `station_lives`."""
    cell = time_cell(F.col("timestamp"), STATION_TTL_S).alias("cell")
    return station_writes(df).groupBy("station_id", cell).agg(*station_fields())


def merge_cells(cells: DataFrame, keys: list[str]) -> DataFrame:
    """Cells of several batches into one row per key and cell: the earliest first, the latest of everything else."""
    earliest = {"first_ts", "first_start"}
    return cells.groupBy(*keys, "cell").agg(*[
        (F.min(c) if c in earliest else F.max(c)).alias(c) for c in cells.columns if c not in {*keys, "cell"}
    ])


def station_lives(cells: DataFrame) -> DataFrame:
    """Cells, and lives of earlier calls, joined to lives: spans of writes of a station without a gap of five minutes.

    The columns stay those of cells (a life has the number of its last one), so lives and cells can be joined again in
    any order: a write that comes late and closes a gap makes one life of two.
    """
    before = Window.partitionBy("station_id").orderBy("first_ts", "last_ts").rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy("station_id").orderBy("first_ts", "last_ts").rowsBetween(Window.unboundedPreceding, 0)
    gap = seconds_between(F.col("first_ts"), F.max("last_ts").over(before))
    numbered = cells.withColumn("_new", F.when(gap >= STATION_TTL_S, 1).otherwise(0)).withColumn(
        "_life", F.sum("_new").over(upto))
    fields = [c for c in cells.columns if c != "station_id"]
    return numbered.groupBy("station_id", "_life").agg(
        *[(F.min(c) if c == "first_ts" else F.max(c)).alias(c) for c in fields]).drop("_life")


def lives_since(lives: DataFrame, cutoff: Column) -> DataFrame:
    """Lives that a write at the cutoff or later can still continue."""
    return lives.filter(F.col("last_ts") >= cutoff - F.expr(f"INTERVAL {STATION_TTL_S} SECONDS"))


def station_status(cells: DataFrame, now: Column) -> DataFrame:
    """One row per uninterrupted life of a station's status entry, with the fields as last written in it.

    A write at least five minutes after the one before finds an expired entry and starts an empty one.
    """
    return station_lives(cells).select(
        "station_id",
        F.col("first_ts").alias("segment_start"),
        F.col("last_ts").alias("last_updated"),
        F.col("status.value").alias("status"),
        F.col("session.value").alias("session_id"),
        F.col("error.value").alias("error_code"),
        (seconds_between(now, F.col("last_ts")) < STATION_TTL_S).alias("is_live"),
    )


def station_status_history(df: DataFrame, *, as_of: AsOf = None) -> DataFrame:
    return station_status(station_cells(_until(df, as_of)), reference_time(df, as_of))


def station_status_live(df: DataFrame, *, as_of: AsOf = None) -> DataFrame:
    return station_status_history(df, as_of=as_of).filter("is_live").drop("is_live")


# ---- sessions --------------------------------------------------------------------------------------------------

def session_writes(df: DataFrame) -> DataFrame:
    """The events that write a session's entry."""
    return df.filter(F.col("session_id") != "").filter(F.col("event_type").isin(START, METER, STOP))


def session_fields() -> list[Column]:
    """First start and last start, meter update and stop, as aggregates over `session_writes`."""
    position = [F.col("timestamp").alias("ts"), F.col("event_id").alias("id")]

    def stamped(fields: dict[str, str]) -> Column:
        return F.struct(*position, F.struct(*[F.col(src).alias(f"f_{dst}") for dst, src in fields.items()]).alias("v"))

    return [
        F.min(F.when(_is(START), F.struct(*position))).alias("first_start"),
        F.max(F.when(_is(START), stamped(START_FIELDS))).alias("start"),
        F.max(F.when(_is(METER), stamped(METER_FIELDS))).alias("meter"),
        F.max(F.when(_is(STOP), F.struct(*position))).alias("stop"),
    ]


def session_cells(df: DataFrame) -> DataFrame:
    """Last start, meter update and stop per session and one-hour cell. Additive over batches: see `merge_cells`."""
    cell = time_cell(F.col("timestamp"), SESSION_TTL_S).alias("cell")
    return session_writes(df).groupBy("session_id", cell).agg(*session_fields())


def sessions_since(cells: DataFrame, cutoff: Column) -> DataFrame:
    """Cells without those that no event at the cutoff or later can see again.

    Of a stopped session the stop stays until the cutoff passes it, so that a start or meter update that comes late finds
    it; of an open one all cells stay while its life lasts. An entry without a life stays until it is stopped.
    """
    whole = Window.partitionBy("session_id")
    last_stop = F.max("stop").over(whole)
    last_start = F.max("start").over(whole)
    last_meter = F.max("meter").over(whole)

    def open_since_stop(name: str) -> Column:
        return F.col(name).isNotNull() & (F.col("_stop").isNull() | (_position(name) > F.col("_stop")))

    known = cells.withColumn("_stop", last_stop).withColumn("_start", last_start).withColumn("_meter", last_meter)
    life = F.expr(f"INTERVAL {SESSION_TTL_S} SECONDS")
    started, metered = open_since_stop("_start"), open_since_stop("_meter")
    in_life = started & (F.col("_start.ts") >= cutoff - life)
    lifeless = metered & (~started | (seconds_between(F.col("_meter.ts"), F.col("_start.ts")) >= SESSION_TTL_S))
    newest_stop = F.col("stop").isNotNull() & (F.col("stop") == F.col("_stop")) & (F.col("_stop.ts") >= cutoff)
    open_cell = open_since_stop("start") | open_since_stop("meter")
    kept = F.coalesce(newest_stop, F.lit(False)) | (open_cell & (F.coalesce(in_life, F.lit(False)) | F.coalesce(lifeless, F.lit(False))))
    return known.filter(kept).select(*cells.columns)


def _position(stamped: str) -> Column:
    return F.struct(F.col(f"{stamped}.ts").alias("ts"), F.col(f"{stamped}.id").alias("id"))


def live_sessions(cells: DataFrame, now: Column) -> DataFrame:
    """Session entries alive at `now`.

    A start writes its fields and sets a one-hour life, a meter update writes its fields and leaves the life as it
    is, a stop deletes the entry. A meter update that finds no entry makes one that lives until a stop, or until
    a later start sets a life. Meter fields written before a restart survive it unless the entry expired between.
    """
    whole = Window.partitionBy("session_id")
    earlier = whole.orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)

    def after_stop(name: str) -> Column:
        present = F.col(name).isNotNull() & (F.col("_stop").isNull() | (_position(name) > F.col("_stop")))
        return F.when(present, F.col(name))

    open_cells = (
        cells.withColumn("_stop", F.max("stop").over(whole))
        .withColumn("start", after_stop("start"))
        .withColumn("meter", after_stop("meter"))
        .filter("start IS NOT NULL OR meter IS NOT NULL")
        .withColumn("_meter", F.max("meter").over(whole))
        .withColumn("_before", F.max("start").over(earlier))
    )
    expired = seconds_between(F.col("first_start.ts"), F.col("_before.ts")) >= SESSION_TTL_S
    meter_first = _position("_meter") < F.col("first_start")
    without_life = seconds_between(F.col("_meter.ts"), F.col("_before.ts")) >= SESSION_TTL_S
    lost = F.coalesce(F.col("start").isNotNull() & expired & meter_first & ~without_life, F.lit(False))
    entries = (
        open_cells.groupBy("session_id")
        .agg(F.max("start").alias("s"), F.max("meter").alias("m"), F.bool_or(lost).alias("_lost"))
        .withColumn("_started", F.coalesce(seconds_between(now, F.col("s.ts")) < SESSION_TTL_S, F.lit(False)))
    )
    orphan = F.col("m").isNotNull() & (
        F.col("s").isNull() | (seconds_between(F.col("m.ts"), F.col("s.ts")) >= SESSION_TTL_S)
    )
    keeps_meter = F.when(F.col("_started"), ~F.col("_lost") | (_position("m") > _position("s"))).otherwise(True)
    alive = entries.filter(F.col("_started") | orphan)
    return alive.select(
        "session_id",
        F.col("_started").alias("has_start"),
        *[F.when(F.col("_started"), F.col(f"s.v.f_{f}")).alias(f) for f in START_FIELDS],
        *[F.when(keeps_meter, F.col(f"m.v.f_{f}")).alias(f) for f in METER_FIELDS],
    )


def live_sessions_at(df: DataFrame, *, as_of: AsOf = None) -> DataFrame:
    return live_sessions(session_cells(_until(df, as_of)), reference_time(df, as_of))


# ---- panel -----------------------------------------------------------------------------------------------------


def live_kpis(df: DataFrame, *, as_of: AsOf = None) -> DataFrame:
    """The live panel in one row and one pass."""
    today = day_bucket() == F.to_date(reference_time(df, as_of))
    faults = count_where(_is(FAULT))
    return _until(df, as_of).agg(
        n_rows().alias("total_events"),
        F.greatest(F.lit(0).cast("bigint"), _active()).alias("active_sessions"),
        *[count_where(_is(t)).alias(f"{t}_events") for t in EVENT_TYPES],
        faults.alias("total_faults"),
        F.coalesce(
            rnd(F.sum(F.when(_is(STOP) & (F.col("energy_kwh") > 0) & today, F.col("energy_kwh"))), 1), F.lit(0.0)
        ).alias("energy_today_kwh"),
        rnd(ratio(faults, F.greatest(n_rows(), F.lit(1).cast("bigint"))) * F.lit(100.0), 3).alias("error_rate_pct"),
    )
