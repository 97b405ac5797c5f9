"""The fact table: Parquet, one folder per month, rows sorted by (timestamp, network, station).

A table that loads append to has its months as folders and a folder per load below each. The table of a running ingest
has a folder per run, with months below it, and readers take the runs that its manifest names.
"""

from __future__ import annotations

import uuid
from dataclasses import replace
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F

from wattloom.functions.windows import AsOf, reference_time, utc
from wattloom.schema import FACT_DDL, FACT_NAMES, FACT_RETENTION_DAYS
from wattloom.session import drop_folder, prepare, subfolders
from wattloom.sources.snapshot import Run, Snapshots

SORT_KEYS = ["timestamp", "network_id", "station_id"]
STORED_DDL = f"{FACT_DDL}, event_month string, batch_id string"
TABLE, MONTH = "fact", "event_month"


def write_fact(df: DataFrame, path: str, batch_id: str | None = None, *, clustered: bool = True) -> None:
    """Append one batch below its months. A batch with an id replaces what an earlier attempt of it left; without one
    every call is a batch of its own.

    `clustered` range-partitions a large load by the sort keys, so that every file covers a short time range and
    no task writes into every month; a micro-batch, small and recent, is only sorted inside its partitions.
    """
    prepare(df.sparkSession)
    rows = df.select(*FACT_NAMES).withColumn("event_month", F.date_format("timestamp", "yyyy-MM"))
    rows = rows.withColumn("batch_id", F.lit(batch_id or f"load-{uuid.uuid4().hex}"))
    if clustered:
        rows = rows.repartitionByRange(*SORT_KEYS, "event_id")
    (
        rows.sortWithinPartitions("event_month", *SORT_KEYS)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("event_month", "batch_id")
        .parquet(path)
    )


def write_fact_run(snapshots: Snapshots, df: DataFrame, run: Run, *, clustered: bool = False) -> Run:
    """Write the fact rows of a run of a running ingest; they are read once the run is published."""
    rows = df.select(*FACT_NAMES).withColumn(MONTH, F.date_format("timestamp", "yyyy-MM"))
    if clustered:
        rows = rows.repartitionByRange(*SORT_KEYS, "event_id")
    return snapshots.write(rows.sortWithinPartitions(MONTH, *SORT_KEYS), TABLE, run, MONTH)


def _published(spark: SparkSession, path: str) -> Snapshots | None:
    """The manifests beside the table if it is that of a running ingest."""
    root, _, name = path.rstrip("/").rpartition("/")
    snapshots = Snapshots(spark, root)
    return snapshots if name == TABLE and snapshots.versions() else None


def _stored(spark: SparkSession, path: str, since: datetime | None, until: datetime | None) -> DataFrame:
    published = _published(spark, path)
    if published is None:
        return spark.read.schema(STORED_DDL).parquet(path)
    low = utc(since).strftime("%Y-%m") if since else ""
    high = utc(until).strftime("%Y-%m") if until else "9999-99"
    rows = published.read(TABLE, FACT_DDL, MONTH, lambda month: low <= month <= high)
    return rows.select(*FACT_NAMES, MONTH, "batch_id")


def read_fact(
    spark: SparkSession, path: str, since: datetime | None = None, until: datetime | None = None,
    batch_id: str | None = None,
) -> DataFrame:
    """The fact table between two times (until is exclusive); whole months outside are not listed for reading."""
    prepare(spark)
    df = _stored(spark, path, since, until)
    if since is not None:
        df = df.filter(F.col("event_month") >= utc(since).strftime("%Y-%m")).filter(F.col("timestamp") >= utc(since))
    if until is not None:
        df = df.filter(F.col("event_month") <= utc(until).strftime("%Y-%m")).filter(F.col("timestamp") < utc(until))
    if batch_id is not None:
        df = df.filter(F.col("batch_id") == batch_id)
    return df


def _months(spark: SparkSession, path: str) -> list[str]:
    published = _published(spark, path)
    if published:
        return sorted({month for run in published.current().runs(TABLE) for month in run.parts})
    return sorted(name.split("=")[1] for name in subfolders(spark, path) if name.startswith(f"{MONTH}="))


def newest_timestamp(spark: SparkSession, path: str) -> datetime | None:
    """Newest event time, read from the newest month alone."""
    months = _months(spark, path)
    if not months:
        return None
    last = read_fact(spark, path, since=datetime.strptime(months[-1], "%Y-%m"))
    micros = last.agg(F.unix_micros(F.max("timestamp"))).first()[0]
    return utc(datetime(1970, 1, 1) + timedelta(microseconds=micros))


def retain(df: DataFrame, ts: str = "timestamp", days: int = FACT_RETENTION_DAYS, as_of: AsOf = None) -> DataFrame:
    """Rows not older than the retention period."""
    return df.filter(F.col(ts) >= reference_time(df, as_of, ts) - F.expr(f"INTERVAL {days} DAYS"))


def expired_months(spark: SparkSession, path: str, prefix: str, days: int, as_of: datetime) -> list[str]:
    """Month folders that lie wholly before the retention period."""
    oldest = (utc(as_of) - timedelta(days=days)).strftime("%Y-%m")
    months = [name for name in subfolders(spark, path) if name.startswith(f"{prefix}=")]
    return sorted(name for name in months if name.split("=")[1] < oldest)


def drop_expired(
    spark: SparkSession, path: str, prefix: str = "event_month", days: int = FACT_RETENTION_DAYS, *, as_of: datetime
) -> list[str]:
    """Delete the expired month folders; rows of the boundary month are left to `retain`."""
    published = _published(spark, path)
    if published:
        return _expire_runs(published, days, as_of)
    expired = expired_months(spark, path, prefix, days, as_of)
    for name in expired:
        drop_folder(spark, f"{path.rstrip('/')}/{name}")
    return expired


def _expire_runs(published: Snapshots, days: int, as_of: datetime) -> list[str]:
    """Publish the table without its expired months; their files go with the manifests that still name them."""
    oldest = (utc(as_of) - timedelta(days=days)).strftime("%Y-%m")
    manifest = published.current()
    gone = sorted({month for run in manifest.runs(TABLE) for month in run.parts if month < oldest})
    if gone:
        left = (replace(run, parts=tuple(m for m in run.parts if m >= oldest)) for run in manifest.runs(TABLE))
        published.publish(replace(manifest, tables={**manifest.tables, TABLE: tuple(run for run in left if run.parts)}))
    return [f"{MONTH}={month}" for month in gone]
