"""First arrival of an event id wins."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from wattloom.functions.joins import broadcast_if_small

# Rejected messages take part under a key of their own, so one pass carries them along untouched.
DEDUP_KEY = "IF(reason IS NULL, concat('id:', event_id), concat('at:', CAST(arrival AS STRING)))"


def _first_of(keyed: DataFrame, *keys: str) -> DataFrame:
    by_id = Window.partitionBy(*keys).orderBy("arrival")
    return keyed.withColumn("_rank", F.row_number().over(by_id)).filter("_rank = 1").drop("_rank")


def first_arrivals(checked: DataFrame, parts: int | None = None) -> DataFrame:
    """One row per event id, the earliest.

    The rank filter is a top-1 per key, which Spark also applies before the shuffle: of an id resent a billion
    times each task passes on one row. Messages that come in parts are dealt out by id in as many, as a task sorts whole
    rows; then the filter runs once more before that shuffle, in each cell of a part.
    """
    keyed = checked.selectExpr("*", f"{DEDUP_KEY} AS dedup_key")
    if parts is not None:
        keyed = _first_of(keyed, "_cell", "dedup_key").drop("_cell").repartition(parts, "dedup_key")
    return _first_of(keyed, "dedup_key")


def drop_seen(fresh: DataFrame, seen: DataFrame | None) -> DataFrame:
    """Remove ids already taken in earlier batches. Both sides have one row per key.

    The batch's own ids, few beside an hour of ids, are looked up among the seen ones: these are scanned, not shuffled.
    """
    if seen is None:
        return fresh
    own = broadcast_if_small(fresh.select("dedup_key"))
    known = seen.select("dedup_key").join(own, "dedup_key", "left_semi")
    return fresh.join(known, "dedup_key", "left_anti")
