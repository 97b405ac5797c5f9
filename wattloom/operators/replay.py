"""Late dead letters put back into the fact table, and the windows they touch computed again."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from wattloom.functions.joins import BROADCAST_BYTES, broadcast_if_small, parts_of, stored_bytes
from wattloom.functions.windows import day_bucket, hour_bucket, utc
from wattloom.operators.decode import evaluate_once
from wattloom.operators.ingest import check, rejected
from wattloom.operators.rollups import sessions_hourly, station_daily
from wattloom.schema import FACT_NAMES


def late_letters(letters: DataFrame, since: datetime | None = None, until: datetime | None = None) -> DataFrame:
    """Late dead letters, of events between two times (until is exclusive) if they are given."""
    late = letters.filter(F.col("reason").startswith("late_event:"))
    late = late.filter(F.col("timestamp") >= utc(since)) if since else late
    return late.filter(F.col("timestamp") < utc(until)) if until else late


def not_replayed(letters: DataFrame, ledger: DataFrame) -> DataFrame:
    """Letters whose event id no replay has taken yet. The ids in question are looked up in the ledger."""
    own = broadcast_if_small(letters.select("event_id"))
    return letters.join(ledger.select("event_id").join(own, "event_id", "left_semi"), "event_id", "left_anti")


def late_rows(letters: DataFrame) -> DataFrame:
    """Fact rows of the late dead letters, the first rejected of each event id, that convert to rows at all."""
    return late_checked(letters).filter("conversion_error IS NULL").select("fact.*")


def late_checked(letters: DataFrame) -> DataFrame:
    """The first late dead letter of each event id with its typed row and the conversion error it meets, if any."""
    first = F.min_by("raw_event", F.struct("rejected_at", "raw_event"))
    late, parts = late_letters(letters), parts_of(letters)
    # Texts are sorted to be grouped. They are dealt out in parts first; an id is rejected as late but a few times.
    late = late if parts is None else late.repartition(parts, "event_id")
    late = late.groupBy("event_id").agg(first.alias("raw"))
    return evaluate_once(check(late.select(F.lit(0).cast("bigint").alias("arrival"), "raw")))


def unconvertible(letters: DataFrame, now: datetime | None = None) -> DataFrame:
    """Dead letters for the late events that convert to no row."""
    bad = late_checked(letters).filter("conversion_error IS NOT NULL").withColumn("reason", F.col("conversion_error"))
    return rejected(bad, now)


def not_in_fact(rows: DataFrame, fact: DataFrame) -> DataFrame:
    """Rows whose event id the fact table lacks.

    The ids in question are looked up in the fact table, not the other way round: few of them, once stored, are
    broadcast and the fact table is only scanned. Behind a parsed message Catalyst takes any number of ids for few, so the
    table the rows are made of has to be small, too; rows of a larger one are dealt out in parts of a bounded size.
    """
    parts, small = parts_of(rows), stored_bytes(rows) <= BROADCAST_BYTES
    rows = rows if parts is None else rows.repartition(parts, "event_id")
    ids = rows.select("event_id")
    known = fact.select("event_id").join(broadcast_if_small(ids) if small else ids, "event_id", "left_semi").distinct()
    return rows.join(known, "event_id", "left_anti").select(*FACT_NAMES)


def replayed_rows(letters: DataFrame, fact: DataFrame) -> DataFrame:
    return not_in_fact(late_rows(letters), fact)


def _of_touched(fact: DataFrame, replayed: DataFrame, bucket: Column) -> DataFrame:
    """Facts and replayed rows of the hours or days that received replayed rows.

    Late events may carry any time, so the touched buckets are broadcast only if they are few. A stored fact table is read
    in their months alone: its month is part of the join, by which Spark prunes folders when the query runs.
    """
    # Every event has an id; Spark prunes folders only by a side that is filtered.
    touched = replayed.filter(F.col("event_id") != "").select(
        bucket.alias("_bucket"), F.date_format(bucket, "yyyy-MM").alias("_month")).distinct()
    match = bucket == F.col("_bucket")
    if "event_month" in fact.columns:
        match = match & (F.col("event_month") == F.col("_month"))
    old = fact.join(broadcast_if_small(touched), match, "left_semi").select(*FACT_NAMES)
    return old.unionByName(replayed.select(*FACT_NAMES))


def recomputed_hours(fact: DataFrame, replayed: DataFrame) -> DataFrame:
    """The hourly rollup of exactly the hours that received replayed rows."""
    return sessions_hourly(_of_touched(fact, replayed, hour_bucket()))


def recomputed_days(fact: DataFrame, replayed: DataFrame) -> DataFrame:
    """The daily station rollup of exactly the days that received replayed rows."""
    return station_daily(_of_touched(fact, replayed, day_bucket()))
