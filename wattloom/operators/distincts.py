"""Exact distinct stations of any period, from rollups that can be merged.

A dictionary gives each station a number when it is first seen. Rollups hold, per day, place and block of 32,768 numbers, one
bit per station; bits of several days or batches are joined by OR, and counting them is exact whatever was merged.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from wattloom.functions.joins import broadcast_if_small
from wattloom.functions.numeric import n_rows
from wattloom.functions.windows import day_bucket
from wattloom.schema import FAULT, STOP

DICTIONARY_DDL = "station_id string, number bigint"
STOP_KEYS = ["day", "city", "country", "block"]
FAULT_KEYS = ["day", "error_code", "network_id", "city", "country", "block"]
GROUPS = 64


def new_stations(df: DataFrame, known: DataFrame) -> DataFrame:
    """station_id, number of the stations that the dictionary lacks; numbers go on from its highest.

    Ranks are taken in groups by hash, then the groups, a fixed number of them, are put behind one another.
    """
    missing = df.select("station_id").distinct().join(broadcast_if_small(known.select("station_id")), "station_id", "left_anti")
    group = F.pmod(F.xxhash64("station_id"), F.lit(GROUPS)).alias("grp")
    inside = missing.select("station_id", group).withColumn(
        "rank", F.row_number().over(Window.partitionBy("grp").orderBy("station_id")))
    before = Window.orderBy("grp").rowsBetween(Window.unboundedPreceding, -1)
    starts = missing.groupBy(group).agg(n_rows().alias("size")).select(
        "grp", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("start"))
    top = known.agg(F.coalesce(F.max("number"), F.lit(0).cast("bigint"))).scalar()
    return inside.join(F.broadcast(starts), "grp").select(
        "station_id", (top + F.col("start") + F.col("rank")).cast("bigint").alias("number"))


def _bits(rows: DataFrame, keys: list[str], measures: list[str]) -> DataFrame:
    """Rows of a key and station into one row per key and block of numbers."""
    block, position = F.bitmap_bucket_number("number"), F.bitmap_bit_position("number")
    return rows.groupBy(*keys[:-1], block.alias(keys[-1])).agg(
        *[F.sum(m).alias(m) for m in measures], F.bitmap_construct_agg(position).alias("stations"))


def stop_stations_daily(df: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Stops with their sums and stations per day and city; each station's stops are first added up by hash aggregation."""
    per_station = (
        df.filter(F.col("event_type") == STOP)
        .groupBy(day_bucket().alias("day"), "city", "country", "station_id")
        .agg(n_rows().alias("stops"), F.sum("energy_kwh").alias("energy"), F.sum("revenue_eur").alias("revenue"),
             F.sum("duration_minutes").alias("minutes"))
    )
    return _bits(per_station.join(broadcast_if_small(dictionary), "station_id"), STOP_KEYS, ["stops", "energy", "revenue", "minutes"])


def fault_stations_daily(df: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Faults and stations per day, code, network and city; the empty code is one of the codes."""
    per_station = df.filter(F.col("event_type") == FAULT).groupBy(
        day_bucket().alias("day"), *FAULT_KEYS[1:-1], "station_id").agg(n_rows().alias("faults"))
    return _bits(per_station.join(broadcast_if_small(dictionary), "station_id"), FAULT_KEYS, ["faults"])


def merge_bits(partials: DataFrame, keys: list[str]) -> DataFrame:
    """Sums of the measures and union of the stations per key."""
    measures = [c for c in partials.columns if c not in {*keys, "stations"}]
    return partials.groupBy(*keys).agg(*[F.sum(m).alias(m) for m in measures], F.bitmap_or_agg("stations").alias("stations"))


def distinct_by(partials: DataFrame, keys: list[str]) -> DataFrame:
    """Per key the sums and `distinct_stations`."""
    measures = [c for c in partials.columns if c not in {*FAULT_KEYS, *STOP_KEYS, "stations", *keys}]
    blocks = partials.groupBy(*keys, "block").agg(
        *[F.sum(m).alias(m) for m in measures], F.bitmap_count(F.bitmap_or_agg("stations")).alias("n"))
    return blocks.groupBy(*keys).agg(*[F.sum(m).alias(m) for m in measures], F.sum("n").alias("distinct_stations"))


# name -> (keys, rows of one batch)
STATION_SETS = {
    "stop_stations_daily": (STOP_KEYS, stop_stations_daily),
    "fault_stations_daily": (FAULT_KEYS, fault_stations_daily),
}
