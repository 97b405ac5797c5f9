"""Interaction audit of corpus filters: what every filter removes at every place of every order of the filters.

1. Each document becomes a mask of the filters it fails. Documents are counted by part and mask, so that from here on a
   part has at most 2**n rows (32 for five filters), however many documents it holds.
2. Orders are numbered by their Lehmer rank, which is lexicographic. A document goes at step s of an order if the first
   s - 1 filters pass it and the next one does not; the orders that begin so are one interval of ranks. The intervals of
   all masks are a table made by that rule (840 rows for five filters).
3. Every interval adds its count at its first rank and takes it away behind its last one; the running sum over the ranks
   is what each order removes at that step. Totals of labelled documents run along in the same way.

A text is known by its SHA-256 sum. The copies of a text are counted per part and label before the copies of all parts
meet, so no text, source or label has a task of its own.

* Null or empty text: no words, no characters; two of them are identical. A null part is the empty string's part.
* A row without id is never a copy of another and makes none; it has no label. Rows with one id and one text are copies
  of any smaller id but not of each other, and count one by one. Of several labels of an id, any 1 counts.
* An empty table has no parts, hence no rows. Other columns of docs, whatever their names, are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattloom.session import materialize

from .common import words_of

COPY = "E"


@dataclass(frozen=True)
class AuditRules:
    min_words: int = 50
    min_distinct_percent: int = 65
    max_upper_percent: int = 5
    symbols: str = "[#$%&*|]"


def failures(text: Column, rules: AuditRules = AuditRules()) -> dict[str, Column]:
    """The filters that look at one text alone; each is true if the text fails it."""
    words = words_of(text)
    return {
        "A": F.size(words) < rules.min_words,
        "B": 100 * F.size(F.array_distinct(words)) < rules.min_distinct_percent * F.size(words),
        "C": 100 * F.regexp_count(text, F.lit("[A-Z]")) > rules.max_upper_percent * F.length(text),
        "D": text.rlike(rules.symbols),
    }


def bit(letters: str, letter: str) -> int:
    return 1 << letters.index(letter)


def orders(letters: str) -> list[str]:
    """All orders; the place of one in the list is its Lehmer rank."""
    return ["".join(p) for p in permutations(sorted(letters))]


def intervals(letters: str) -> Iterator[tuple[int, int, int, int]]:
    """(mask, step, first rank, rank behind the last one) for every way in which documents of a mask can go."""
    letters = "".join(sorted(letters))

    def walk(mask: int, rest: str, step: int, low: int) -> Iterator[tuple[int, int, int, int]]:
        width = factorial(len(rest) - 1)
        for digit, letter in enumerate(rest):
            start = low + digit * width
            if mask & bit(letters, letter):
                yield mask, step, start, start + width
            else:
                yield from walk(mask, rest.replace(letter, ""), step + 1, start)

    for mask in range(1, 1 << len(letters)):
        yield from walk(mask, letters, 1, 0)


def _labelled(stored: DataFrame, labels: DataFrame) -> DataFrame:
    """good and toxic (0 or 1) of every row; rows without an id, which could all meet in one task, stay out of the join."""
    known = labels.where("doc_id is not null").groupBy("doc_id").agg(
        F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"),
        F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic"))
    named = stored.where("doc_id is not null").join(known, "doc_id", "left")
    nameless = stored.where("doc_id is null").select("*", F.lit(0).alias("good"), F.lit(0).alias("toxic"))
    return named.unionByName(nameless).fillna(0, ["good", "toxic"])


def masks(docs: DataFrame, labels: DataFrame, rules: AuditRules = AuditRules(), text: str = "text", key: str = "doc_id",
          part: str = "source") -> DataFrame:
    """part, mask, n, good, toxic: how many rows of each part fail just the filters of a mask."""
    cols = docs.select(F.col(f"`{key}`").cast("long").alias("doc_id"), F.coalesce(F.col(f"`{part}`"), F.lit("")).alias("part"),
                       F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    alone = failures(F.col("text"), rules)
    letters = "".join(alone) + COPY
    failed = sum((F.when(fails, bit(letters, f)).otherwise(0) for f, fails in alone.items()), F.lit(0))
    rows = cols.select("doc_id", "part", failed.alias("alone"), F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("sum"))
    rows = materialize(rows.groupBy("doc_id", "part", "alone", "sum").agg(F.count(F.lit(1)).alias("n")), "audit-rows")

    # One row per text, part and label. An id has one label, so that the rows of the smallest id are one row here.
    held = _labelled(rows, labels).groupBy("sum", "part", "alone", "good", "toxic").agg(
        F.sum("n").alias("n"), F.min("doc_id").alias("lowest"), F.min_by("n", "doc_id").alias("at_lowest"),
        F.sum(F.when(F.col("doc_id").isNull(), F.col("n")).otherwise(0)).alias("nameless"))
    first = F.min("lowest").over(Window.partitionBy("sum"))
    held = held.withColumn("fresh", F.col("nameless") + F.when(
        F.col("lowest") == first, F.col("at_lowest")).otherwise(0))
    each = held.select("part", "good", "toxic", F.explode(F.array(
        F.struct(F.col("alone").alias("mask"), F.col("fresh").alias("n")),
        F.struct((F.col("alone") + bit(letters, COPY)).alias("mask"), (F.col("n") - F.col("fresh")).alias("n")))).alias("m"))
    n = F.col("m.n")
    return each.where(n > 0).groupBy("part", F.col("m.mask").alias("mask")).agg(
        F.sum(n).alias("n"), F.sum(n * F.col("good")).alias("good"), F.sum(n * F.col("toxic")).alias("toxic"))


def audit(counted: DataFrame, letters: str = "ABCDE") -> DataFrame:
    """The audit of counted masks: part, filter_order, step and its figures, for every part, order and step."""
    letters, n_filters = "".join(sorted(letters)), len(letters)
    spark, ranked = counted.sparkSession, orders(letters)
    listed = F.array(*[F.lit(o) for o in ranked])
    sums = ["n", "good", "toxic"]

    table = spark.createDataFrame(list(intervals(letters)), "mask int, step int, low int, high int")
    ends = counted.join(F.broadcast(table), "mask").select(
        "part", "step", *sums, F.explode(F.array(
            F.struct(F.col("low").alias("rank"), F.lit(1).alias("sign")),
            F.struct(F.col("high").alias("rank"), F.lit(-1).alias("sign")))).alias("end"))
    ends = ends.where(F.col("end.rank") < len(ranked)).select(
        "part", "step", F.col("end.rank").alias("rank"), *[(F.col(c) * F.col("end.sign")).alias(c) for c in sums])

    # Every rank and step of every part, with the totals of the step's filter, so that places without an end exist too.
    def failing(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0))

    bits = [F.lit(bit(letters, letter)) for letter in letters]
    totals = counted.groupBy("part").agg(
        F.sum("n").alias("all"), F.array(*[failing(F.col("mask").bitwiseAND(b) > 0) for b in bits]).alias("fails"),
        F.array(*[failing(F.col("mask") == b) for b in bits]).alias("only"))
    grid = totals.withColumn("rank", F.explode(F.sequence(F.lit(0), F.lit(len(ranked) - 1)))).withColumn(
        "step", F.explode(F.sequence(F.lit(1), F.lit(n_filters))))
    letter = F.element_at(F.split(F.element_at(listed, F.col("rank") + 1), ""), F.col("step"))
    grid = grid.withColumn("letter", letter).withColumn("at", F.instr(F.lit(letters), F.col("letter")))
    grid = grid.select("part", "step", "rank", *[F.lit(0).cast("long").alias(c) for c in sums], "letter", "all",
                       F.element_at("fails", F.col("at")).alias("fails"), F.element_at("only", F.col("at")).alias("only"))

    # A part has a bounded number of rows here, so all that follows can keep it together.
    both = grid.unionByName(ends, allowMissingColumns=True).repartition("part")
    carried = ["letter", "all", "fails", "only"]
    places = both.groupBy("part", "step", "rank").agg(
        *[F.sum(c).alias(c) for c in sums], *[F.max(c).alias(c) for c in carried])
    along = Window.partitionBy("part", "step").orderBy("rank").rowsBetween(Window.unboundedPreceding, 0)
    removed = places.select("part", "step", "rank", *carried, *[F.sum(c).over(along).alias(c) for c in sums])
    so_far = Window.partitionBy("part", "rank").orderBy("step").rowsBetween(Window.unboundedPreceding, 0)
    return removed.select(
        "part", F.element_at(listed, F.col("rank") + 1).alias("filter_order"), "step",
        (F.col("all") - F.sum("n").over(so_far)).alias("kept"), F.col("n").alias("removed"),
        (F.col("fails") - F.col("n")).alias("redundant"), F.col("only").alias("unique_fails"),
        F.col("good").alias("good_lost"), F.col("toxic").alias("toxic_lost"),
        F.sum("n").over(Window.partitionBy("part", "letter")).alias("shapley"))
