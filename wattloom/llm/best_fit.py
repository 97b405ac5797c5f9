"""Best-fit decreasing packing of documents into training sequences.

Documents go by falling length, each into the open sequence with the least room that still holds it. Documents of one
length are alike, so the packing of a whole corpus follows from how many there are of each length:

1. Workers encode and cut documents, and number the pieces of each length within their task.
2. The histogram of lengths (at most `capacity` numbers) is packed. Open sequences lie in a segment tree over their
   remaining capacities, which finds the tightest fit in logarithmic time; sequences that look alike are one entry, and
   so are the pieces of one length that go into them. An entry's room at least halves each time it is used, and a length
   opens at most four entries, so the plan has at most 4 * capacity * log2(capacity) runs whatever the corpus.
3. A piece's rank among all pieces of its length finds its run, and from that its sequence and place, on any worker.

The result is what placing the documents one by one gives; no task and no group holds more than a task's documents.

* A null or empty text is a document of the end id alone. Repeated rows are documents of their own; ids may be null.
* Texts of any length are encoded whole. Only a document longer than the capacity is cut: its first piece is what is left
  over, if anything, the others are whole sequences. An empty table has no pieces.
* Other columns of docs, whatever their names, are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wattloom.session import materialize

from .common import small_batches
from .tokens import Encoder, tokenizer_path


@dataclass(frozen=True)
class FitRules:
    capacity: int = 2048
    end_id: int = 0


class OpenSequences:
    """Entries (first sequence, number of sequences) by remaining capacity, under a segment tree."""

    def __init__(self, capacity: int):
        self._size = 1 << capacity.bit_length()
        self._filled = [False] * (2 * self._size)
        self._entries: list[list[tuple[int, int]]] = [[] for _ in range(self._size)]

    def _refresh(self, room: int) -> None:
        node = self._size + room
        self._filled[node] = bool(self._entries[room])
        while node > 1:
            node //= 2
            self._filled[node] = self._filled[2 * node] or self._filled[2 * node + 1]

    def add(self, room: int, first: int, n: int) -> None:
        if room and n:
            self._entries[room].append((first, n))
            self._refresh(room)

    def take(self, room: int) -> tuple[int, int]:
        entry = self._entries[room].pop()
        self._refresh(room)
        return entry

    def tightest(self, need: int) -> int | None:
        """The least remaining capacity of an open sequence that is at least `need`."""
        node = self._size + need
        while not self._filled[node]:
            while node > 1 and node % 2:
                node //= 2
            if node <= 1:
                return None
            node += 1
        while node < self._size:
            node = 2 * node if self._filled[2 * node] else 2 * node + 1
        return node - self._size


def plan(histogram: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Runs (length, first rank, first sequence, pieces per sequence, offset): pieces of a length from this rank up to the
    next run of the length go into sequences from the first one on, so many into each, beginning at the offset."""
    sequences, runs, opened = OpenSequences(capacity), [], 0
    for length in sorted(histogram, reverse=True):
        left, rank = histogram[length], 0
        while left:
            room = sequences.tightest(length)
            if room is None:
                room, first, n = capacity, opened, -(-left // (capacity // length))
                opened += n
            else:
                first, n = sequences.take(room)
            per = room // length
            full = min(n, left // per)
            if full:
                runs.append((length, rank, first, per, capacity - room))
                sequences.add(room - per * length, first, full)
                rank, left, first, n = rank + full * per, left - full * per, first + full, n - full
            if n and left:  # fewer than fill one sequence
                runs.append((length, rank, first, left, capacity - room))
                sequences.add(room - left * length, first, 1)
                left, first, n = 0, first + 1, n - 1
            sequences.add(room, first, n)
    return runs


def cut(tokens: int, capacity: int) -> list[int]:
    """Lengths of the pieces of a document, in order."""
    over = tokens % capacity
    return ([over] if over else []) + [capacity] * (tokens // capacity)


PIECE = "task long, rank long, key long, piece int, start long, length long, ids_crc32 long"


def pieces(docs: DataFrame, rules: FitRules = FitRules(), path: str | None = None, text: str = "text",
           key: str = "doc_id", keep_ids: bool = False) -> DataFrame:
    """The pieces of all documents, each with its task and its rank among the pieces of its length there; with keep_ids
    also their ids as little-endian unsigned 32-bit numbers."""
    path = path or tokenizer_path()
    small_batches(docs.sparkSession)
    schema = PIECE + (", ids binary" if keep_ids else "")
    names = [column.split()[0] for column in schema.split(", ")]
    kinds = [{"ids": pa.binary(), "piece": pa.int32()}.get(n, pa.int64()) for n in names]
    end = rules.end_id.to_bytes(4, "little")

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, task = Encoder(path, encode_special_tokens=False), TaskContext.get().partitionId()
        seen = [0] * (rules.capacity + 1)
        for batch in batches:
            rows: list[tuple] = []
            for key_value, ids in zip(batch.column(0).to_pylist(), encoder.encode([t or "" for t in batch.column(1).to_pylist()])):
                ids += end
                start = 0
                for piece, length in enumerate(cut(len(ids) // 4, rules.capacity)):
                    body = ids[4 * start:4 * (start + length)]
                    row = (task, seen[length], key_value, piece, start, length, zlib.crc32(body))
                    rows.append((*row, body) if keep_ids else row)
                    seen[length] += 1
                    start += length
            columns = list(zip(*rows)) if rows else [[] for _ in names]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=names)

    columns = [F.col(f"`{key}`").cast("long").alias("key"), F.col(f"`{text}`").alias("text")]
    return docs.select(*columns).mapInArrow(split, schema)


def pack(docs: DataFrame, rules: FitRules = FitRules(), path: str | None = None, text: str = "text",
         key: str = "doc_id", keep_ids: bool = False) -> DataFrame:
    """key, piece, start, length, ids_crc32, sequence_id, offset of every piece (with keep_ids also ids).

    The pieces of a sequence, joined by offset, are its tokens; what is missing to the capacity is padding.
    """
    stored = materialize(pieces(docs, rules, path, text, key, keep_ids), "fit-pieces")
    counts = stored.groupBy("task", "length").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    starts = materialize(starts, "fit-starts")
    histogram = {r["length"]: r["n"] for r in starts.groupBy("length").agg(F.sum("n").alias("n")).collect()}

    runs = np.array(sorted(plan(histogram, rules.capacity)), dtype=np.int64).reshape(-1, 5)
    shared = docs.sparkSession.sparkContext.broadcast(runs)
    ranked = stored.join(starts.select("task", "length", "before"), ["task", "length"]).withColumn(
        "rank", F.col("before") + F.col("rank"))
    kept = ["key", "piece", "start", "length", "ids_crc32", *(["ids"] if keep_ids else [])]
    shape = ranked.select(*kept, F.col("length").alias("sequence_id"), F.col("length").alias("offset"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        length, first_rank, first, per, offset = shared.value.T
        begins = (length << 48) + first_rank
        for batch in batches:
            n, rank = (batch[c].to_numpy() for c in ("length", "rank"))
            run = np.searchsorted(begins, (n << 48) + rank, side="right") - 1
            turn, within = np.divmod(rank - first_rank[run], per[run])
            arrays = [*[batch[c] for c in kept], pa.array(first[run] + turn), pa.array(offset[run] + within * n)]
            yield pa.RecordBatch.from_arrays(arrays, names=[*kept, "sequence_id", "offset"])

    return ranked.select("rank", *kept).mapInArrow(place, shape.schema)
