"""Mixing sources to target weights by a low-discrepancy schedule.

The mix is a sequence of slots of equally many words. Slot k has the point k * g mod 1, g near the golden ratio; the
source whose share of the unit interval holds the point fills the slot. The r-th slot of a source takes the r-th block
of its shuffled words, going round when it is through. Points and boundaries are integers of one modulus, so every run
and every engine places them alike.

Built-in functions only. Ranks and offsets are running sums in two levels, inside groups of bounded size and over the
totals of the groups, so a source with most of the rows is spread over many tasks. The only frames without a key are
over one row per source and one row per group of a source.

* Null texts and texts without words have size 0 and are taken 0 times; a null source is a source of its own, last in order.
* Repeated rows are documents of their own. No words at all: every target and every taken is 0.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wattloom.session import materialize

from .common import ADDRESS, addressed, parts_for, rows_at, running_sum, word_count

# Points are multiples of 1 / 2**31; the step is 2**31 over the golden ratio, rounded to an odd number.
MODULUS = 2147483648
STEP = 1327217885


@dataclass(frozen=True)
class MixRules:
    weights: tuple[int, ...] = (3, 1, 2)
    percent_of_all: int = 150
    max_epochs: int = 2
    block_words: int = 64
    rows_per_group: int = 20_000
    cells: int = 1024
    seed: int = 42


def targets(sizes: DataFrame, rules: MixRules = MixRules()) -> DataFrame:
    """source, source_size, target of every source: its weight's share, at most max_epochs times its size.

    Sources are raised together until the smallest ratio of cap and weight is met; what is left goes to the others by
    weight. Sorted by that ratio, the level follows from running sums.
    """
    per_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(order) - 1) % len(rules.weights)
    weight = F.element_at(F.array(*map(F.lit, rules.weights)), (turn + 1).cast("int"))
    df = per_source.withColumn("_weight", weight.cast("double"))
    df = df.withColumn("_cap", F.col("source_size") * F.lit(float(rules.max_epochs)))
    everything = Window.partitionBy()
    by_ratio = Window.orderBy(F.col("_cap") / F.col("_weight"), F.col("source").asc_nulls_last())
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    total = F.sum("source_size").over(everything) * (rules.percent_of_all / 100)
    left = total - F.coalesce(F.sum("_cap").over(before), F.lit(0.0))
    weights_left = F.sum("_weight").over(everything) - F.coalesce(F.sum("_weight").over(before), F.lit(0.0))
    df = df.withColumn("_level", left / weights_left)
    full = F.col("_cap") <= F.col("_level") * F.col("_weight")
    level = F.max(F.when(~full, F.col("_level"))).over(everything)
    share = F.when(full, F.col("_cap")).otherwise(level * F.col("_weight"))
    return df.select("source", "source_size", share.alias("target"))


def schedule(spark, shares: DataFrame, rules: MixRules = MixRules()) -> DataFrame:
    """source, rank of every slot of the mix; the number of slots is the mix divided by the block."""
    total = shares.agg(F.coalesce(F.sum("target"), F.lit(0.0)).alias("total")).first()["total"]
    slots = int(-(-total // rules.block_words))
    upto = Window.orderBy(F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, 0)
    bounds = shares.where("target > 0").withColumn(
        "_high", F.round(F.sum("target").over(upto) / F.lit(max(total, 1.0)) * MODULUS).cast("long"))
    before = Window.orderBy("_high", F.col("source").asc_nulls_last())
    bounds = bounds.withColumn("_low", F.coalesce(F.lag("_high").over(before), F.lit(0))).where("_high > _low")
    width = MODULUS // rules.cells
    bounds = bounds.select("source", "_low", "_high", F.explode(F.sequence(
        F.floor(F.col("_low") / width), F.floor((F.col("_high") - 1) / width))).alias("_cell"))
    points = spark.range(slots).select(
        F.col("id").alias("_k"), ((F.col("id") % MODULUS) * STEP % MODULUS).alias("_point"))
    points = points.withColumn("_cell", F.floor(F.col("_point") / width))
    drawn = points.join(bounds, "_cell").where("_low <= _point and _point < _high")
    drawn = drawn.select("source", "_k", F.floor(F.col("_k") / rules.rows_per_group).alias("_group"))
    ranked = running_sum(drawn, ["source"], "_group", [F.col("_k")], F.lit(1), "rank")
    return ranked.select("source", "rank")


def take(docs: DataFrame, rules: MixRules = MixRules(), text: str = "text", source: str = "source",
         key: str = "doc_id", carry: list[str] | None = None) -> DataFrame:
    """key, size, source_size, target and taken of every row, and the columns of `carry`."""
    spark, carry = docs.sparkSession, carry or []
    columns = [F.col(f"`{key}`").alias("key"), F.col(f"`{source}`").alias("source"),
               word_count(F.col(f"`{text}`")).alias("size")]
    listed = docs.select(*columns, *carry)
    # Stored, a row keeps the number it is given here, whatever is recomputed later.
    listed = materialize(listed.withColumn("uid", F.monotonically_increasing_id()), "mix-sizes")
    sizes = listed.select("uid", "key", "source", "size")
    shares = materialize(targets(sizes, rules), "mix-targets")
    groups = parts_for(sizes.count(), rules.rows_per_group)
    digest = F.md5(F.concat_ws(":", F.lit(rules.seed), "key"))
    stream = sizes.where("size > 0").withColumn("_order", F.conv(F.substring(digest, 1, 15), 16, 10).cast("long"))
    stream = stream.withColumn("_group", F.shiftright(F.shiftright("_order", 30) * groups, 30))
    order = [F.col(c) for c in ("_order", "key", "size", "uid")]
    stream = running_sum(stream, ["source"], "_group", order, F.col("size"), "_offset")

    known = shares.select("source", "source_size", "target")
    stream = stream.join(known, stream["source"].eqNullSafe(known["source"])).drop(known["source"])
    words = rules.block_words
    rounds = F.sequence(F.lit(0), F.lit(rules.max_epochs - 1))
    passes = stream.withColumn("_pass", F.explode(rounds)).withColumn(
        "_from", F.col("_offset") + F.col("_pass") * F.col("source_size"))
    passes = passes.where(F.col("_from") < F.col("target")).withColumn("_to", F.col("_from") + F.col("size"))
    blocks = passes.select("uid", "source", "target", "_from", "_to", F.explode(F.sequence(
        F.floor(F.col("_from") / words), F.floor((F.col("_to") - 1) / words))).alias("rank"))
    slots = schedule(spark, shares, rules)
    joined = blocks.join(slots, (blocks["rank"] == slots["rank"]) & blocks["source"].eqNullSafe(slots["source"]))
    start = F.greatest(F.col("_from"), blocks["rank"] * words)
    end = F.least(F.col("_to"), (blocks["rank"] + 1) * words, F.round("target").cast("long"))
    used = joined.select("uid", F.greatest(end - start, F.lit(0)).alias("n"))
    used = used.groupBy("uid").agg(F.sum("n").alias("taken"))

    result = listed.join(used, "uid", "left")
    result = result.join(known, result["source"].eqNullSafe(known["source"])).drop(known["source"])
    kept = ["key", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken")]
    return result.select(*kept, *carry)


def mix(docs: DataFrame, rules: MixRules = MixRules(), text: str = "text", source: str = "source",
        key: str = "doc_id") -> DataFrame:
    """The mixed corpus with the columns of docs: a row for each full copy that is taken, and one with the leading words
    of a copy that is taken in part (up to and without the white space after its last word). Rows not taken go.

    What is taken is settled on sizes and addresses; the rows themselves then move once.
    """
    placed = addressed(docs, "mix-rows")
    field = F.col("row").getField
    slim = placed.select(field(key).alias("key"), field(source).alias("source"), field(text).alias("text"), *ADDRESS)
    took = materialize(take(slim, rules, "text", "source", "key", carry=ADDRESS).where("taken > 0"), "mix-taken")
    took = rows_at(placed, took.select("size", "taken", *ADDRESS))
    full, part = F.col("taken").cast("long"), F.pmod(F.col("taken"), F.greatest("size", F.lit(1)))
    copies = F.floor(full / F.greatest("size", F.lit(1))).cast("int")
    lengths = F.concat(F.array_repeat("size", copies), F.when(part > 0, F.array(part)).otherwise(
        F.array().cast("array<bigint>")))
    rows = took.select("row", "size", F.explode(lengths).alias("_n"))
    body = field(text)
    pieces = F.regexp_extract_all(body, F.lit(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+"), F.lit(0))
    cut = F.when(F.col("_n") < F.col("size"), F.array_join(F.slice(pieces, 1, F.col("_n").cast("int")), "")).otherwise(body)
    return rows.withColumn("row", F.col("row").withField(f"`{text}`", cut)).select("row.*")
