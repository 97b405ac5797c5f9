"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


# Session settings every job relies on. Hour and day buckets are UTC. HotSpot compiles no method beyond 8000 bytes of
# bytecode, so a stage that would generate a larger one runs as separate, compiled projections instead.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build_session(app: str = "wattloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the jobs rely on; cluster sizing stays with spark-submit."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    defaults = {
        **RUNTIME_SETTINGS,
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
    }
    for key, value in {**defaults, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def prepare(spark: SparkSession) -> None:
    """The same settings on a session built elsewhere."""
    for key, value in RUNTIME_SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Every query of the session gives back its shuffle files as it ends. Else they lie on the executors' disks until the
    driver happens to collect its garbage. For queries whose results are stored, and that are not run a second time."""
    before = spark.conf.get(DROP_SHUFFLES, "false")
    spark.conf.set(DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.set(DROP_SHUFFLES, before)


def shared_dir(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; a temporary folder only in local mode with none set."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder:
        return folder
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="wattloom-"))
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused folder below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared folder and read it back: cuts lineage, survives lost executors."""
    return store(df, scratch_path(df.sparkSession, name))


def store(df: DataFrame, path: str) -> DataFrame:
    """Write a frame to a given folder, replacing what an earlier attempt left, and read it back."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _file_system(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    file_system, target = _file_system(spark, path)
    return file_system.exists(target)


def subfolders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly below a path; partition names, so their number is small."""
    file_system, target = _file_system(spark, path)
    if not file_system.exists(target):
        return []
    return [s.getPath().getName() for s in file_system.listStatus(target) if s.isDirectory()]


def file_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the files directly below a path, for folders that hold a bounded number of them."""
    file_system, target = _file_system(spark, path)
    if not file_system.exists(target):
        return []
    return [s.getPath().getName() for s in file_system.listStatus(target) if s.isFile()]


def read_text(spark: SparkSession, path: str) -> str:
    file_system, target = _file_system(spark, path)
    stream = file_system.open(target)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def create_text(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file that appears whole or not at all; false if there is one of this name already."""
    file_system, target = _file_system(spark, path)
    if file_system.exists(target):
        return False
    draft = target.suffix(f".{uuid.uuid4().hex}.tmp")
    stream = file_system.create(draft, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    return file_system.rename(draft, target)


def drop_file(spark: SparkSession, path: str) -> None:
    file_system, target = _file_system(spark, path)
    file_system.delete(target, False)


def drop_folder(spark: SparkSession, path: str) -> None:
    file_system, target = _file_system(spark, path)
    file_system.delete(target, True)
