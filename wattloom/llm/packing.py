"""Harmonic packing of documents into training sequences.

Piece sizes fall into classes by the reciprocal of the capacity: class k holds pieces of at most capacity / k tokens, and
every sequence of class k takes exactly k of them, so a piece's sequence follows from its rank in its class alone and
workers fill sequences independently. Documents are cut so that pieces lie close under their class's size: whole
sequences first, then the largest unit fraction that fits, until what is left fits at least `min_share` times.

Only the fewer than k pieces of each class that fill no sequence are put together by size, first fit; for any input
those are at most a few thousand rows (the sum of the class numbers).

* A null or empty text is a document of the end id alone. Repeated rows are documents of their own.
* Texts of any length are encoded whole; a piece never spans two documents. An empty table has no pieces.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wattloom.session import materialize

from .common import parts_for, running_sum, small_batches
from .tokens import Encoder, tokenizer_path


@dataclass(frozen=True)
class PackRules:
    capacity: int = 2048
    end_id: int = 1
    min_share: int = 16
    rows_per_group: int = 20_000


def cut(tokens: int, rules: PackRules = PackRules()) -> list[tuple[int, int]]:
    """(length, class) of the pieces of a document, in order."""
    pieces = [(rules.capacity, 1)] * (tokens // rules.capacity)
    left = tokens % rules.capacity
    while left:
        k = rules.capacity // left
        if k >= rules.min_share or left == rules.capacity // k:
            pieces.append((left, k))
            break
        size = rules.capacity // (k + 1)
        pieces.append((size, k + 1))
        left -= size
    return pieces


PIECE = "key long, start long, length long, ids_crc32 long, doc_tokens long, class long"


def pieces(docs: DataFrame, rules: PackRules = PackRules(), path: str | None = None, text: str = "text",
           key: str = "doc_id", keep_ids: bool = False) -> DataFrame:
    """The pieces of all documents; with keep_ids also their ids as little-endian unsigned 32-bit numbers."""
    path = path or tokenizer_path()
    small_batches(docs.sparkSession)
    end = rules.end_id.to_bytes(4, "little")
    schema = PIECE + (", ids binary" if keep_ids else "")

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(path, encode_special_tokens=False)
        for batch in batches:
            keys = batch.column(0).to_pylist()
            rows: list[tuple] = []
            for key_value, ids in zip(keys, encoder.encode([t or "" for t in batch.column(1).to_pylist()])):
                ids += end
                start, tokens = 0, len(ids) // 4
                for length, k in cut(tokens, rules):
                    body = ids[4 * start:4 * (start + length)]
                    row = (key_value, start, length, zlib.crc32(body), tokens, k)
                    rows.append((*row, body) if keep_ids else row)
                    start += length
            columns = list(zip(*rows)) if rows else [[] for _ in names]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    names = [part.split()[0] for part in schema.split(", ")]
    types = [pa.binary() if n == "ids" else pa.int64() for n in names]
    columns = [F.col(f"`{key}`").cast("long").alias("key"), F.col(f"`{text}`").alias("text")]
    return docs.select(*columns).mapInArrow(split, schema)


def _fit_rest(rules: PackRules):
    def fit(group: pd.DataFrame) -> pd.DataFrame:
        """First fit, longest first, over the few pieces that fill no sequence of their class."""
        group = group.sort_values(["length", "key", "start", "piece"], ascending=[False, True, True, True])
        room: list[int] = []
        where, offsets = [], []
        for length in group["length"].tolist():
            at = next((i for i, free in enumerate(room) if free >= length), len(room))
            if at == len(room):
                room.append(rules.capacity)
            where.append(at)
            offsets.append(rules.capacity - room[at])
            room[at] -= length
        return group[["piece"]].assign(bin=where, offset=offsets)

    return fit


def pack(docs: DataFrame, rules: PackRules = PackRules(), path: str | None = None, text: str = "text",
         key: str = "doc_id", keep_ids: bool = False) -> DataFrame:
    """key, start, length, ids_crc32, doc_tokens, sequence_id, offset of every piece (with keep_ids also ids).

    Concatenating the pieces of a sequence by offset gives its tokens; what is missing to the capacity is padding.
    """
    stored = pieces(docs, rules, path, text, key, keep_ids).withColumn("piece", F.monotonically_increasing_id())
    stored = materialize(stored, "pieces")
    slim = stored.select("piece", "key", "start", "length", "class")
    groups = parts_for(slim.count(), rules.rows_per_group)
    slim = slim.withColumn("_group", F.pmod(F.xxhash64("key", "start"), F.lit(groups)))
    order = [F.col(c) for c in ("key", "start", "piece")]
    ranked = running_sum(slim, ["class"], "_group", order, F.lit(1), "rank").drop("_group")
    classes = slim.groupBy("class").agg(F.floor(F.count(F.lit(1)) / F.col("class")).alias("_full"))
    upto = Window.orderBy("class").rowsBetween(Window.unboundedPreceding, -1)
    classes = classes.withColumn("_base", F.coalesce(F.sum("_full").over(upto), F.lit(0)))
    classes = materialize(classes, "classes")
    sequences = classes.agg(F.coalesce(F.sum("_full"), F.lit(0)).alias("n")).first()["n"]
    ranked = ranked.join(classes, "class").withColumn("_bin", F.floor(F.col("rank") / F.col("class")))
    ranked = materialize(ranked, "ranked")

    inside = Window.partitionBy("class", "_bin").orderBy("rank").rowsBetween(Window.unboundedPreceding, -1)
    full = ranked.where("_bin < _full").select(
        "piece", (F.col("_base") + F.col("_bin")).alias("sequence_id"),
        F.coalesce(F.sum("length").over(inside), F.lit(0)).cast("long").alias("offset"))
    rest = ranked.where("_bin >= _full").select("piece", "key", "start", "length", F.lit(0).alias("_all"))
    rest = rest.groupBy("_all").applyInPandas(
        _fit_rest(rules), "piece long, bin long, offset long")
    rest = rest.select("piece", (F.col("bin") + F.lit(sequences)).alias("sequence_id"), "offset")
    placed = stored.join(full.unionByName(rest), "piece")
    names = ["key", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    return placed.select(*names, *(["ids"] if keep_ids else []))
