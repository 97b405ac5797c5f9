"""The dead-letter table and its JSON-lines form."""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from wattloom.functions.windows import utc
from wattloom.schema import DEAD_LETTER_DDL
from wattloom.session import prepare
from wattloom.sources.snapshot import Run, Snapshots

TABLE, MONTH = "dead_letters", "reject_month"
STORED_DDL = f"{DEAD_LETTER_DDL}, reject_month string, batch_id string"


def write_dead_letters(df: DataFrame, path: str, batch_id: str | None = None) -> None:
    """One folder per month of rejection; a repeated batch replaces its own rows, one without an id is always new.

    A batch that may run again stamps its rows with one time, so that both attempts fall into one month.
    """
    prepare(df.sparkSession)
    (
        df.withColumn("reject_month", F.date_format("rejected_at", "yyyy-MM"))
        .withColumn("batch_id", F.lit(batch_id or f"load-{uuid.uuid4().hex}"))
        .sortWithinPartitions("rejected_at", "reason")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("reject_month", "batch_id")
        .parquet(path)
    )


def write_letters_run(snapshots: Snapshots, df: DataFrame, run: Run) -> Run:
    """Write the dead letters of a run of a running ingest. A repeated batch replaces its folder whole, whichever month
    its letters are stamped with the second time."""
    months = df.withColumn(MONTH, F.date_format("rejected_at", "yyyy-MM"))
    return snapshots.write(months.sortWithinPartitions(MONTH, "rejected_at", "reason"), TABLE, run, MONTH)


def read_dead_letters(spark: SparkSession, path: str, since: datetime | None = None) -> DataFrame:
    """Dead letters rejected at a time or later, of a running ingest those of published runs."""
    prepare(spark)
    letters = _stored(spark, path, utc(since).strftime("%Y-%m") if since else "")
    return letters.filter(F.col("rejected_at") >= utc(since)) if since else letters


def _stored(spark: SparkSession, path: str, first_month: str) -> DataFrame:
    root, _, name = path.rstrip("/").rpartition("/")
    snapshots = Snapshots(spark, root)
    if name == TABLE and snapshots.versions():
        rows = snapshots.read(TABLE, DEAD_LETTER_DDL, MONTH, lambda month: month >= first_month)
        return rows.select(*[c.split()[0].strip("`") for c in STORED_DDL.split(", ")])
    return spark.read.schema(STORED_DDL).parquet(path).filter(F.col(MONTH) >= first_month)


def as_json_lines(letters: DataFrame) -> DataFrame:
    """One column `value`: {"rejected_at", "reason", "event"}; text that is no JSON stays a string."""
    stamp = "date_format(rejected_at, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx\")"
    event = "coalesce(try_parse_json(raw_event), CAST(raw_event AS VARIANT))"
    return letters.selectExpr(
        f"to_json(named_struct('rejected_at', {stamp}, 'reason', reason, 'event', {event})) AS value"
    )


def export_dead_letters(letters: DataFrame, out: str) -> None:
    as_json_lines(letters).write.mode("overwrite").text(out)
