"""Time buckets and trailing time ranges."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, functions as F

AsOf = datetime | Column | None


def hour_bucket(ts: str = "timestamp") -> Column:
    return F.date_trunc("hour", F.col(ts))


def day_bucket(ts: str = "timestamp") -> Column:
    return F.to_date(F.col(ts))


def time_cell(ts: Column, seconds: int) -> Column:
    """Index of the fixed grid cell holding a timestamp; two rows of a cell lie less than `seconds` apart."""
    return F.floor(F.unix_micros(ts) / F.lit(seconds * 1_000_000)).cast("bigint")


def seconds_between(later: Column, earlier: Column) -> Column:
    return (F.unix_micros(later) - F.unix_micros(earlier)) / F.lit(1_000_000.0)


def utc(moment: datetime) -> datetime:
    """A naive datetime means UTC."""
    return moment.astimezone(timezone.utc) if moment.tzinfo else moment.replace(tzinfo=timezone.utc)


def reference_time(df: DataFrame, as_of: AsOf, ts: str = "timestamp") -> Column:
    """The 'now' of a query: a literal, a column such as current_timestamp(), or the newest event."""
    if as_of is None:
        if ts == "timestamp" and "event_month" in df.columns:  # the newest event is in the newest month
            newest = df.agg(F.max("event_month").alias("month")).scalar()
            df = df.filter(F.col("event_month") == newest)
        return df.agg(F.max(ts).alias("as_of")).scalar()
    if isinstance(as_of, Column):
        return as_of
    return F.lit(utc(as_of))


def trailing(df: DataFrame, as_of: AsOf, **length: int) -> DataFrame:
    """Rows not older than the given interval. A table with months is read from the month of the oldest of them on; for
    a reference time known only when the query runs, the months are pruned then."""
    now = reference_time(df, as_of)
    (unit, amount), = length.items()
    span = timedelta(**{unit: amount})
    kept = df.filter(F.col("timestamp") >= now - F.lit(span))
    if "event_month" in df.columns:
        fixed = isinstance(as_of, datetime)
        oldest = F.lit((utc(as_of) - span).strftime("%Y-%m")) if fixed else F.date_format(now - F.lit(span), "yyyy-MM")
        kept = kept.filter(F.col("event_month") >= oldest)
    return kept
