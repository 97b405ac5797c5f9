"""Exact length histogram of encoded documents.

Documents are encoded where they are read; only one row per length leaves a task, so the histogram has as many rows as
there are different lengths. Totals for every context limit are suffix sums over it, in two levels (lengths, then spans
of 4,096 lengths), so no frame holds more than one span or one row per span.

* A null or empty text has length 0. Repeated rows count each time. An empty table has an empty histogram and no totals.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import small_batches
from .tokens import Encoder, tokenizer_path

SPAN = 4096


def histogram(docs: DataFrame, path: str | None = None, text: str = "text") -> DataFrame:
    """length, n_docs."""
    path = path or tokenizer_path()
    small_batches(docs.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(path, encode_special_tokens=False)
        for batch in batches:
            texts = [t or "" for t in batch.column(0).to_pylist()]
            sizes = [len(ids) // 4 for ids in encoder.encode(texts)]
            yield pa.RecordBatch.from_pydict({"length": pa.array(sizes, pa.int64())})

    counted = docs.select(F.col(f"`{text}`").alias("text")).mapInArrow(count, "length long")
    return counted.groupBy("length").agg(F.count(F.lit(1)).alias("n_docs"))


def totals(hist: DataFrame) -> DataFrame:
    """For every length as context limit: documents of that length, documents and tokens of at least it, tokens left
    when every document is truncated to it, all documents, all tokens, and the share of documents at most as long."""
    df = hist.withColumn("_span", F.floor(F.col("length") / SPAN)).withColumn("_tokens", F.col("length") * F.col("n_docs"))
    spans = df.groupBy("_span").agg(F.sum("n_docs").alias("_d"), F.sum("_tokens").alias("_t"))
    later = Window.orderBy("_span").rowsBetween(1, Window.unboundedFollowing)
    everything = Window.partitionBy()
    spans = spans.select(
        "_span", F.coalesce(F.sum("_d").over(later), F.lit(0)).alias("_later_d"),
        F.coalesce(F.sum("_t").over(later), F.lit(0)).alias("_later_t"),
        F.sum("_d").over(everything).alias("all_docs"), F.sum("_t").over(everything).alias("all_tokens"))
    on = Window.partitionBy("_span").orderBy("length").rowsBetween(0, Window.unboundedFollowing)
    df = df.withColumn("_on_d", F.sum("n_docs").over(on)).withColumn("_on_t", F.sum("_tokens").over(on))
    df = df.join(spans, "_span")
    longer_docs = F.col("_later_d") + F.col("_on_d")
    longer_tokens = F.col("_later_t") + F.col("_on_t")
    return df.select(
        "length", "n_docs", longer_docs.alias("docs_at_least"), longer_tokens.alias("tokens_at_least"),
        (F.col("all_tokens") - longer_tokens + F.col("length") * longer_docs).alias("truncated_tokens"),
        "all_docs", "all_tokens",
        ((F.col("all_docs") - longer_docs + F.col("n_docs")) / F.col("all_docs")).alias("share_at_most"))


def quantile(all_totals: DataFrame, share: float) -> DataFrame:
    """The smallest length that at least this share of all documents does not exceed, one row."""
    return all_totals.where(F.col("share_at_most") >= share).agg(F.min("length").alias("length"))


def truncated_total(all_totals: DataFrame, limit: int) -> DataFrame:
    """Tokens left when every document is cut to `limit`, one row, for any limit."""
    above = all_totals.where(F.col("length") > limit).orderBy("length").limit(1)
    exact = above.select((F.col("all_tokens") - F.col("tokens_at_least") + limit * F.col("docs_at_least")).alias("tokens"))
    untouched = all_totals.agg(F.max("all_tokens").alias("_all"), F.max("length").alias("_longest"))
    untouched = untouched.where(F.col("_longest") <= limit).select(F.col("_all").alias("tokens"))
    return exact.unionByName(untouched)
