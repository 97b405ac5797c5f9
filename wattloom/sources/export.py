"""Fact rows out: Parquet export of a day or of everything, and JSON messages keyed by station."""

from __future__ import annotations

from datetime import date, datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, functions as F

from wattloom.schema import FACT_NAMES


def day_slice(df: DataFrame, day: date | None) -> DataFrame:
    """Events of one UTC day, as a time range so that it reaches the file scan."""
    if day is None:
        return df
    start = datetime(day.year, day.month, day.day, tzinfo=timezone.utc)
    if "event_month" in df.columns:
        df = df.filter(F.col("event_month") == day.strftime("%Y-%m"))
    return df.filter((F.col("timestamp") >= start) & (F.col("timestamp") < start + timedelta(days=1)))


def export(df: DataFrame, out: str, day: date | None = None, batch: int = 200_000) -> None:
    """Snappy Parquet in time order; files follow one another and hold at most `batch` rows."""
    (
        day_slice(df, day)
        .select(*FACT_NAMES)
        .orderBy("timestamp", "event_id")
        .write.mode("overwrite")
        .option("compression", "snappy")
        .option("maxRecordsPerFile", batch)
        .parquet(out)
    )


def encoded() -> Column:
    """Compact JSON of all 28 fields."""
    options = {"ignoreNullFields": "false", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx"}
    return F.to_json(F.struct(*FACT_NAMES), options)


def encode(df: DataFrame) -> DataFrame:
    """(key, value): station id and compact JSON of all 28 fields, ready for a log or a text sink."""
    return df.select(F.col("station_id").alias("key"), encoded().alias("value"))


def publish(df: DataFrame, **kafka_options: str) -> None:
    encode(df).write.format("kafka").options(**kafka_options).save()
