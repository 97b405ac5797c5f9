"""Placing keys on shards by a permutation-filled lookup table.

Each shard prefers the slots of a table of prime size in an order of its own (an offset and a step, both from the hash
of its name). In turn, every shard claims its next free slot in that order until the table is full, so shards hold
nearly equally many slots, and most slots stay where they are when a shard comes or goes. The table has a fixed size and
is broadcast; a key's slot is its hash modulo the size.

* A null key is placed as the empty text is. Repeated keys go to one shard. One shard takes everything; none is an error.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import whole_row

# Primes; a table should have some hundred slots per shard. At most this many entries are ever broadcast.
SLOTS = 65_537


def _hash(text: str) -> int:
    return int(hashlib.md5(text.encode()).hexdigest()[:15], 16)


def lookup_table(shards: Sequence[str], slots: int = SLOTS) -> list[int]:
    """For every slot the place of its shard in `shards`. Depends on the names, not on their order."""
    if not shards or len(set(shards)) < len(shards) or len(shards) > slots:
        raise ValueError("shards must be different names, at least one and no more than slots")
    order = sorted(range(len(shards)), key=lambda i: shards[i])
    starts = {i: _hash(f"offset:{shards[i]}") % slots for i in order}
    steps = {i: _hash(f"step:{shards[i]}") % (slots - 1) + 1 if slots > 1 else 1 for i in order}
    table, claimed = [-1] * slots, 0
    while claimed < slots:
        for i in order:
            while table[starts[i]] >= 0:
                starts[i] = (starts[i] + steps[i]) % slots
            table[starts[i]] = i
            claimed += 1
            if claimed == slots:
                break
    return table


def slot_of(key: Column, slots: int = SLOTS) -> Column:
    digest = F.md5(F.coalesce(key.cast("string"), F.lit("")))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long") % slots


def place(df: DataFrame, key: str, shards: Sequence[str], slots: int = SLOTS) -> DataFrame:
    """`row` (the row itself), slot and shard."""
    spark: SparkSession = df.sparkSession
    names = F.array(*map(F.lit, shards))
    filled = F.split(F.lit(",".join(map(str, lookup_table(shards, slots)))), ",")
    table = spark.range(1).select(F.posexplode(filled).alias("slot", "at")).select(
        F.col("slot").cast("long"), F.element_at(names, F.col("at").cast("int") + 1).alias("shard"))
    rows = df.select(whole_row(df).alias("row"), slot_of(F.col(f"`{key}`"), slots).alias("slot"))
    return rows.join(F.broadcast(table), "slot").select("row", "slot", "shard")
