"""Dimension lookups that hold up under a hot key, and the number of parts that a shuffle deals a table out in."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

BROADCAST_BYTES = 32 * 1024 * 1024
# A key with more than 1 of this many rows is hot; so there are at most this many.
HOT_SHARE = 100
# Stored size of the messages in a part, some 35,000 of 600 characters in snappy Parquet. Sizes that Catalyst does not know,
# it takes for larger than any table.
PART_BYTES = 4 * 1024 * 1024
UNKNOWN_BYTES = 2**60
# Up to as many parts a task writes its rows straight to files; for more, Spark keeps them in memory to sort them by part.
SHUFFLE_PARTS = 200


def estimated_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate, the one its own broadcast decision uses."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def stored_bytes(df: DataFrame) -> int:
    """Size of the largest table that a frame reads; joins and windows on the way, which Catalyst can't size, don't count."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    return max((int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())), default=0)


def is_sized(df: DataFrame) -> bool:
    """Whether Catalyst knows the size of the tables that a frame reads."""
    return stored_bytes(df) < UNKNOWN_BYTES


def parts_of(df: DataFrame, part_bytes: int = PART_BYTES) -> int | None:
    """Number of parts that bound a task's share of a frame, at least one a core; none if it is small or of unknown size.

    Parts hold `part_bytes` of the stored table, or more of a table beyond SHUFFLE_PARTS of these, up to eight times as much.
    """
    size = stored_bytes(df)
    if not part_bytes < size < UNKNOWN_BYTES:
        return None
    parts = max(min(-(-size // part_bytes), SHUFFLE_PARTS), -(-size // (8 * part_bytes)))
    return max(parts, df.sparkSession.sparkContext.defaultParallelism)


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    return F.broadcast(df) if estimated_bytes(df) <= limit else df


def heavy_hitters(fact: DataFrame, key: str, share: int = HOT_SHARE) -> list:
    """Keys that may hold more than 1/share of the rows, by a frequency sketch of fixed size: at most `share` of them.

    The sketch merges map-side, so one small row reaches the driver whatever the size of the fact.
    """
    top = f"approx_top_k(`{key}`, {share}, {share * 64})"
    found = fact.selectExpr(f"{top} AS top", "count(*) AS n").first()
    return [entry["item"] for entry in found["top"] or () if entry["item"] is not None and entry["count"] * share >= found["n"]]


def dimension_join(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Inner join of a fact to a dimension unique on its key.

    Up to `limit` estimated bytes the dimension is broadcast. Beyond it the join shuffles, and a key that holds
    a large share of the fact would land in one task. Such keys, at most HOT_SHARE of them, are joined to their own few
    rows of the dimension by broadcast and are not shuffled; all others are shuffled once, and so is the dimension.
    """
    if estimated_bytes(dim) <= limit:
        return fact.join(F.broadcast(dim), fact[fact_key] == dim[dim_key])
    hot = heavy_hitters(fact, fact_key)
    if not hot:
        return fact.join(dim, fact[fact_key] == dim[dim_key])
    few = F.broadcast(dim.filter(F.col(dim_key).isin(hot)))
    rest = dim.filter(~F.col(dim_key).isin(hot))
    hot_rows = fact.filter(F.col(fact_key).isin(hot)).join(few, F.col(fact_key) == F.col(dim_key))
    other_rows = fact.filter(~F.col(fact_key).isin(hot)).join(rest, F.col(fact_key) == F.col(dim_key))
    return hot_rows.unionByName(other_rows)
