"""Event streams: the log in production, a folder of stored messages otherwise."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from wattloom.schema import BACKFILL_LATENESS_S, RAW_DDL


def mode_of(lateness_s: int) -> str:
    """An allowance of 999999 seconds or more means reading the whole log once."""
    return "backfill" if lateness_s >= BACKFILL_LATENESS_S else "live"


def kafka_options(servers: str, topic: str, lateness_s: int, per_trigger: int | None = None,
                  min_partitions: int | None = None) -> dict[str, str]:
    """A trigger takes all there is unless the caller limits it; `min_partitions` splits long offset ranges."""
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": "earliest" if mode_of(lateness_s) == "backfill" else "latest",
    }
    if per_trigger:
        options["maxOffsetsPerTrigger"] = str(per_trigger)
    if min_partitions:
        options["minPartitions"] = str(min_partitions)
    return options


def trigger_of(lateness_s: int, every: str = "5 seconds") -> dict[str, object]:
    """A backfill stops when it has caught up; a live query runs on."""
    return {"availableNow": True} if mode_of(lateness_s) == "backfill" else {"processingTime": every}


def read_log(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """(raw, partition, offset, log_time) of a partitioned log. Needs the Kafka connector on the class path."""
    return spark.readStream.format("kafka").options(**options).load().select(
        F.col("value").cast("string").alias("raw"), "partition", "offset", F.col("timestamp").alias("log_time")
    )


def read_folder(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """(arrival, raw) of a folder of Parquet files."""
    reader = spark.readStream.schema(RAW_DDL)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def with_arrival(batch: DataFrame) -> DataFrame:
    """Unique numbers in arrival order: by log time, then partition and offset.

    The order is a distributed sort; each sorted partition numbers its own rows. The result must be stored before
    it is read twice, as a second sort may cut the partitions elsewhere.
    """
    if "arrival" in batch.columns:
        return batch.select("arrival", "raw")
    order = ["log_time", "partition", "offset"]
    return (
        batch.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select(F.monotonically_increasing_id().alias("arrival"), "raw")
    )
