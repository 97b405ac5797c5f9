"""Helpers shared by the training-data operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wattloom.session import materialize

# The white space of the contracts; everything between two of these characters is a word.
SPACE_CLASS = r"\x20\x09-\x0D"
SPACE_CHARS = " \t\n\x0b\x0c\r"
WORD_PATTERN = f"[^{SPACE_CLASS}]+"

BATCH_ROWS = "1000"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Python workers get at most 1,000 texts at a time, so that a batch of long ones still fits."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(key, "10000") != BATCH_ROWS:
        spark.conf.set(key, BATCH_ROWS)


def words_of(text: Column) -> Column:
    """The words of a text, an empty array for null."""
    parts = F.split(F.coalesce(text, F.lit("")), f"[{SPACE_CLASS}]+")
    return F.filter(parts, lambda w: w != "")


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD_PATTERN)).cast("long")


def whole_row(df: DataFrame) -> Column:
    """All columns of a row as one value, so that derived columns cannot clash with their names."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns])


ADDRESS = ["file", "place"]


def addressed(docs: DataFrame, name: str) -> DataFrame:
    """row, file, place: every row with the file and the position it is stored at, unique and the same in every pass.

    Rows that are not those of a stored table as it is are stored first, under `name`.
    """
    if docs._jdf.queryExecution().analyzed().nodeName() != "LogicalRelation":
        docs = materialize(docs, name)
    stored = docs.metadataColumn("_metadata")
    return docs.select(whole_row(docs).alias("row"), stored["file_path"].alias("file"), stored["row_index"].alias("place"))


def rows_at(placed: DataFrame, chosen: DataFrame) -> DataFrame:
    """The addressed rows that `chosen` names, with its columns. At every size the rows go through one exchange, and wait
    in no sort, for the addresses are the side that is hashed."""
    return placed.join(chosen.hint("shuffle_hash"), ADDRESS)


def parts_for(rows: int, per_part: int) -> int:
    """How many groups of about per_part rows cover a table; grows with it."""
    return max(1, -(-rows // per_part))


def running_sum(df: DataFrame, keys: list[str], group: str, order: list[Column], value: Column, name: str) -> DataFrame:
    """Sum of `value` over the rows before a row in its `keys`, ordered by `group` and then by `order`.

    Two levels: within groups, which the caller keeps of bounded size, and over the totals of the groups. So a key with
    most of the rows is spread over as many tasks as it has groups.
    """
    sums = df.groupBy(*keys, group).agg(F.sum(value).alias("_in_group"))
    earlier = Window.partitionBy(*keys).orderBy(group).rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.withColumn("_start", F.coalesce(F.sum("_in_group").over(earlier), F.lit(0))).drop("_in_group")
    within = Window.partitionBy(*keys, group).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    df = df.withColumn("_within", F.coalesce(F.sum(value).over(within), F.lit(0)))
    match = [df[k].eqNullSafe(starts[k]) for k in (*keys, group)]
    placed = df.join(starts, match, "inner").select(*[df[c] for c in df.columns], "_start")
    return placed.withColumn(name, F.col("_start") + F.col("_within")).drop("_start", "_within")
