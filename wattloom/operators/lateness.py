"""Event-time high-water mark in arrival order, and the split of late events.

The running maximum over all messages is a sequence without a key. It is computed in blocks of consecutive
arrivals: a window inside each block, plus the maximum of all earlier blocks joined in. `arrival` is unique, so a
block never holds more than BLOCK rows; block maxima are folded once more the same way, which leaves one row per
BLOCK * BLOCK messages (15,000 for 10^12) for the only window without a key.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, Window, functions as F

from wattloom.functions.joins import parts_of
from wattloom.functions.windows import utc
from wattloom.schema import MAX_LATENESS_S

BLOCK = 8_192


def _earlier_maximum(blocks: DataFrame, block: int) -> DataFrame:
    """(_block, _top) -> (_block, _carry): the maximum of all blocks before this one."""
    grouped = blocks.withColumn("_group", F.expr(f"_block div {block}"))
    inside = Window.partitionBy("_group").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    across = Window.orderBy("_group").rowsBetween(Window.unboundedPreceding, -1)
    groups = grouped.groupBy("_group").agg(F.max("_top").alias("_top"))
    carried = groups.select("_group", F.max("_top").over(across).alias("_group_carry"))
    return (
        grouped.withColumn("_inside", F.max("_top").over(inside))
        .join(carried, "_group")
        .select("_block", F.greatest("_inside", "_group_carry").alias("_carry"))
    )


def running_maximum(df: DataFrame, position: str, value: str, name: str, block: int = BLOCK) -> DataFrame:
    """Adds `name`: the maximum of `value` (nulls ignored) over all rows up to this one by unique `position`.

    The rows are sorted whole, so those of a stored table are dealt out by block in parts of a bounded size.
    """
    blocked = df.withColumn("_block", F.expr(f"{position} div {block}"))
    tops = blocked.groupBy("_block").agg(F.max(value).alias("_top"))
    inside = Window.partitionBy("_block").orderBy(position).rowsBetween(Window.unboundedPreceding, 0)
    parts = parts_of(df)
    dealt = blocked if parts is None else blocked.repartition(parts, "_block")
    return (
        dealt.withColumn("_running", F.max(value).over(inside))
        .join(_earlier_maximum(tops, block), "_block")
        .withColumn(name, F.greatest("_running", "_carry"))
        .drop("_block", "_running", "_carry")
    )


def with_high_water(fresh: DataFrame, prior: datetime | None = None, block: int = BLOCK) -> DataFrame:
    """Adds `high_water` over the valid events; `prior` is where earlier batches left it."""
    advancing = fresh.withColumn("_advance", F.expr("IF(reason IS NULL, event_ts, NULL)"))
    out = running_maximum(advancing, "arrival", "_advance", "high_water", block).drop("_advance")
    if prior is not None:
        out = out.withColumn("high_water", F.greatest("high_water", F.lit(utc(prior))))
    return out


def late_reason(lateness_s: int = MAX_LATENESS_S) -> str:
    """Strictly older than the high-water mark less the allowance; the seconds are rounded half to even."""
    behind = f"(unix_micros(high_water) - {lateness_s} * 1000000L - unix_micros(event_ts))"
    seconds = f"CAST(bround(CAST({behind} AS DECIMAL(20,0)) / 1000000, 0) AS BIGINT)"
    return f"IF({behind} > 0, concat('late_event:', CAST({seconds} AS STRING), 's'), NULL)"


def current_watermark(events: DataFrame, lateness_s: int = MAX_LATENESS_S, ts: str = "timestamp") -> DataFrame:
    """One row: newest event time less the allowance, null when nothing was seen."""
    return events.agg((F.max(ts) - F.expr(f"INTERVAL {lateness_s} SECONDS")).alias("watermark_utc"))
