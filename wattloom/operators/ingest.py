"""Messages to accepted fact rows and dead letters: decode, validate, deduplicate, late test, convert.

`classify` is the whole sequence for one bounded set of messages. Batch jobs call it on a table, the stream calls it
on every micro-batch with what earlier batches left behind (`seen`, `prior_high_water`).
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from wattloom.functions.joins import PART_BYTES, parts_of
from wattloom.functions.numeric import count_where, n_rows, ratio, rnd
from wattloom.operators.conform import fact_columns, with_conversion_error
from wattloom.operators.decode import decode
from wattloom.operators.dedup import drop_seen, first_arrivals
from wattloom.operators.lateness import BLOCK, late_reason, with_high_water
from wattloom.operators.validate import validate
from wattloom.schema import MAX_LATENESS_S
from wattloom.session import materialize

# Shares of a part of the messages, enough to make parts even.
CELLS = 64

PAYLOAD = ["arrival", "raw", "event_id", "event_type", "station_id", "event_ts", "reason", "fact"]


def check(raw: DataFrame) -> DataFrame:
    """Row-wise part: schema reason, the typed row of a valid message, and the conversion error it would meet later.

    Parsing costs far more than moving the typed row along, so it is done here once and for all.
    """
    checked = with_conversion_error(validate(decode(raw)))
    typed = f"IF(reason IS NULL, struct({', '.join(fact_columns())}), NULL) AS fact"
    cell = [c for c in raw.columns if c == "_cell"]
    return checked.selectExpr(*[c for c in PAYLOAD if c != "fact"], typed, "conversion_error", *cell)


def spread(raw: DataFrame, part_bytes: int = PART_BYTES) -> DataFrame:
    """Stored messages in parts of a bounded size, at least one a core, before they are parsed; `_cell` is a share of a part.

    A task that reads a whole split parses all of it alone and keeps the typed rows, many times the stored size, to sort
    them by id ahead of the shuffle. Messages of unknown size, and few of them, stay as they are.
    """
    parts = parts_of(raw, part_bytes)
    if parts is None:
        return raw
    # A log may be partitioned by the hash that Spark uses for a column, so another one is taken.
    cell = F.expr(f"pmod(xxhash64(arrival), {CELLS * parts})")
    return raw.withColumn("_cell", cell).repartition(parts, "_cell")


def first_unseen(raw: DataFrame, seen: DataFrame | None = None) -> DataFrame:
    """Checked messages without duplicates, neither among themselves nor of ids taken earlier."""
    return drop_seen(first_arrivals(check(spread(raw)), parts_of(raw)), seen)


def judge(
    fresh: DataFrame,
    *,
    lateness_s: int = MAX_LATENESS_S,
    prior_high_water: datetime | None = None,
    block: int = BLOCK,
) -> DataFrame:
    """Adds `high_water` and turns `reason` into the final one: schema rule, then lateness, then conversion."""
    timed = with_high_water(fresh, prior_high_water, block)
    final = f"coalesce(reason, {late_reason(lateness_s)}, conversion_error) AS reason"
    carried = [c for c in PAYLOAD if c != "reason" and c in timed.columns]  # without raw if nobody writes letters
    return timed.selectExpr(*carried, "dedup_key", "high_water", final)


def classify(raw: DataFrame, *, seen: DataFrame | None = None, stage: bool = True, **judging) -> DataFrame:
    """Every message but the duplicates, with `high_water` and the final `reason` (null: accepted).

    The deduplicated messages feed both the block maxima and the rows themselves; `stage` writes them once to the
    shared folder instead of decoding and shuffling them twice.
    """
    fresh = first_unseen(raw, seen)
    return judge(materialize(fresh, "fresh-messages") if stage else fresh, **judging)


def only_used(classified: DataFrame) -> DataFrame:
    """The same without what no one reads: the text of accepted messages and the typed row of rejected ones."""
    used = {"raw": F.col("reason").isNotNull(), "fact": F.col("reason").isNull()}
    return classified.withColumns({c: F.when(kept, F.col(c)) for c, kept in used.items() if c in classified.columns})


def accepted(classified: DataFrame) -> DataFrame:
    """Typed fact rows of the accepted messages, with their arrival number."""
    return classified.filter("reason IS NULL").select("arrival", "fact.*")


def rejected(classified: DataFrame, now: datetime | None = None) -> DataFrame:
    """Dead letters of the rejected messages."""
    stamp = F.current_timestamp() if now is None else F.lit(now)
    bad = classified.filter("reason IS NOT NULL")
    return bad.select(
        stamp.alias("rejected_at"),
        "reason",
        F.coalesce("event_id", F.lit("")).alias("event_id"),
        F.coalesce("event_type", F.lit("")).alias("event_type"),
        F.col("event_ts").alias("timestamp"),
        F.coalesce("station_id", F.lit("")).alias("station_id"),
        F.col("raw").alias("raw_event"),
    )


def dead_letter_summary(letters: DataFrame) -> DataFrame:
    """Rejects per rule, the part of the reason before the first colon."""
    return letters.groupBy(F.split_part("reason", F.lit(":"), F.lit(1)).alias("rule")).agg(n_rows().alias("events"))


def outcome_counts() -> list[Column]:
    """What the metrics need to know of the classified messages, as aggregates (also for an observation)."""
    late = F.col("reason").startswith("late_event:")
    tested = F.col("reason").isNull() | late | F.col("reason").startswith("row_conversion_error:")
    taken = F.when(F.col("reason").isNull(), F.unix_micros("event_ts"))
    return [
        count_where(F.col("reason").isNull()).alias("accepted"),
        count_where(F.col("reason").isNotNull()).alias("dead_letters"),
        count_where(late).alias("late"),
        count_where(tested).alias("tested"),
        n_rows().alias("kept"),
        F.min(taken).alias("first_micros"),
        F.max(taken).alias("last_micros"),
    ]


def metrics_of(counts: DataFrame, elapsed_s: float | None = None) -> DataFrame:
    """The metrics from one row of `messages` and `outcome_counts`. Without a wall-clock duration the rate is over the
    event-time span."""
    span = F.lit(elapsed_s) if elapsed_s else (F.col("last_micros") - F.col("first_micros")) / F.lit(1_000_000.0)
    duplicates = F.col("messages") - F.col("kept")
    return counts.select(
        "messages", "accepted", "dead_letters", duplicates.alias("duplicates"), "late",
        rnd(F.coalesce(ratio(F.lit(100.0) * duplicates, F.col("tested") + duplicates), F.lit(0.0)), 2)
        .alias("dedup_hit_pct"),
        rnd(F.coalesce(ratio(F.lit(100.0) * F.col("late"), F.col("tested")), F.lit(0.0)), 2).alias("late_pct"),
        rnd(F.coalesce(ratio(F.col("accepted"), span), F.lit(0.0)), 3).alias("events_per_second"),
    )


def ingest_metrics(raw: DataFrame, classified: DataFrame, elapsed_s: float | None = None) -> DataFrame:
    """One row of counters."""
    return metrics_of(classified.agg(raw.agg(n_rows()).scalar().alias("messages"), *outcome_counts()), elapsed_s)
