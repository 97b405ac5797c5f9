"""Exact Jaccard join of documents on word shingles by vertical partitioning.

A document's set holds its distinct runs of five words, each as a 64-bit hash. All sets follow one global order of the
n-grams, and that order is cut into fragments:

1. The n-grams below `tier` of the hash space come first, ordered by how many different sets hold them (rare first) and
   then by hash; the others follow by hash. Counting only the first tier needs a third of all n-grams.
2. Two sets that link share an n-gram among the first n - ceil(0.8 n) + 1 of each. Those that only one set holds can
   find no partner, so most documents drop out after the count.
3. Sets that may find a partner are gathered into blocks of bounded size around their most shared n-gram. Of the blocks
   that hold an n-gram of step 2, the first meets all others, and each meets itself.
4. The hash space is cut into fragments; for each pair of blocks every fragment counts the overlaps of all their sets
   apart, and the partial counts are summed per pair of sets.
5. Links inside a block pair leave it as a spanning forest; components follow by label propagation.
6. The remaining pairs of blocks meet only for n-grams whose holders are not all in one component by then. So a group
   of near copies costs block pairs in proportion to its size, and no link that joins components is lost.

Documents with equal sets are one set throughout, whatever their number. Nothing but bounded block pairs meets in a task.

* A null or empty text has an empty set, links with nothing and is its own component.
* Fewer words than a shingle: the whole sequence is the one element. Repeated rows are equal sets.
* A null id cannot be named as a component: such rows keep a null component and still connect others.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattloom.session import materialize

from .common import ADDRESS, addressed, parts_for, rows_at, small_batches

SPREAD = np.uint64(0x9E3779B97F4A7C15)
MIX = np.uint64(0xBF58476D1CE4E5B9)


@dataclass(frozen=True)
class JoinRules:
    words: int = 5
    percent: int = 80
    tier: float = 0.35
    fragments: int = 4
    block_tokens: int = 200_000
    least_tokens: int = 200
    filter_bits: int = 1 << 23
    tokens_per_group: int = 4_000_000


def shingles(text: bytes, words: int = 5) -> np.ndarray:
    """Distinct 64-bit hashes of the runs of `words` words of a UTF-8 text, ascending. Only A-Z are lower-cased, and only
    ASCII white space separates words, which is what these two methods of bytes do."""
    parts = text.lower().split()
    if not parts:
        return np.empty(0, dtype=np.uint64)
    if len(parts) < words:
        return np.array([xxhash.xxh64_intdigest(b" ".join(parts), seed=len(parts))], dtype=np.uint64)
    each = np.fromiter(map(xxhash.xxh64_intdigest, parts), dtype=np.uint64, count=len(parts))
    runs = len(parts) - words + 1
    mixed = np.zeros(runs, dtype=np.uint64)
    for i in range(words):
        mixed = mixed * SPREAD + each[i:i + runs]
        mixed ^= mixed >> np.uint64(29)
    mixed *= MIX
    mixed ^= mixed >> np.uint64(32)
    return np.unique(mixed)


def prefix_length(size: int, percent: int) -> int:
    return size + (-percent * size // 100) + 1


def _text_hash(text: bytes) -> int:
    return xxhash.xxh64_intdigest(text) - (1 << 63)


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64))


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    offsets = np.cumsum([0, *map(len, arrays)]).astype(np.int32)
    flat = np.concatenate(arrays) if arrays else np.empty(0, dtype=np.uint64)
    return pa.ListArray.from_arrays(pa.array(offsets), _signed(flat))


def _signatures(docs: DataFrame, rules: JoinRules, carry: list[str]) -> DataFrame:
    """doc_id, n, set_id (128 bits of the whole set, null if empty) and a hash of the text of every row."""
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or b"" for t in batch.column(1).to_pylist()]
            sets = [shingles(t, rules.words) for t in texts]
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array([len(s) for s in sets], pa.int64()),
                pa.array([xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets], pa.binary()),
                pa.array([_text_hash(t) for t in texts], pa.int64()),
                *[batch.column(c) for c in carry],
            ], names=["doc_id", "n", "set_id", "text_hash", *carry])

    kinds = [f", {c} {kind}" for c, kind in docs.dtypes if c in carry]
    return docs.mapInArrow(sign, "doc_id long, n long, set_id binary, text_hash long" + "".join(kinds))


def _leading(docs: DataFrame, rules: JoinRules) -> DataFrame:
    """set_id, n, and of its n-grams: those of the first tier, and, if they are fewer than the prefix, the next ones; of
    equal sets in a task one."""
    bound = np.uint64(int(rules.tier * 2.0**64))

    def lead(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()
        for batch in batches:
            ids, sizes, first, next_ones = [], [], [], []
            for text in batch.column(0).to_pylist():
                found = shingles(text or b"", rules.words)
                set_id = xxhash.xxh3_128_digest(found.tobytes())
                if len(found) and set_id not in seen:
                    seen.add(set_id)
                    ids.append(set_id)
                    sizes.append(len(found))
                    at = int(np.searchsorted(found, bound))
                    first.append(found[:at])
                    next_ones.append(found[at:max(at, prefix_length(len(found), rules.percent))])
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.binary()), pa.array(sizes, pa.int64()), _lists(first), _lists(next_ones)],
                names=["set_id", "n", "first", "next"])

    return docs.select("text").mapInArrow(lead, "set_id binary, n long, first array<long>, next array<long>")


def _set_blocks(docs: DataFrame, parts: int, rules: JoinRules) -> DataFrame:
    """block and the columns of _leading, one row of each set, however many documents have it.

    Rows already lie by block when equal sets become one, so that this and grouping by block need a single exchange; of
    each set it has at most one row per task that read documents.
    """
    leading = _leading(docs, rules).withColumn("block", F.pmod(F.xxhash64("set_id"), F.lit(parts)))
    firsts = [F.first(c).alias(c) for c in ("n", "first", "next")]
    return leading.repartition("block").groupBy("block", "set_id").agg(*firsts)


def _sets(rows: list[dict]) -> dict[bytes, dict]:
    """The rows of a group by set id, in its order."""
    return dict(sorted((row["set_id"], row) for row in rows))


def _grams(sets: dict[bytes, dict]) -> tuple[np.ndarray, np.ndarray]:
    """First-tier n-grams of all sets, one after the other, and where each set's begin."""
    each = [np.array(row["first"], dtype=np.int64).view(np.uint64) for row in sets.values()]
    return np.concatenate(each), np.cumsum([0, *map(len, each)])


def _digests(grams: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """Part and 32-bit digest of n-grams, ascending with them. Two n-grams of one digest only count as one another's
    holders; the order stays the same for all sets, which is what the join needs."""
    low = grams & np.uint64(0xFFFFFFFF)
    return ((grams >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32), (low ^ (grams >> np.uint64(32))).astype("<u4")


ASK = pa.schema([("block", pa.int64()), ("part", pa.int64()), ("digests", pa.binary()), ("holders", pa.binary())])


def _prefixes(docs: DataFrame, n_tokens: int, rules: JoinRules) -> DataFrame:
    """set_id, n, gram: the n-grams of the prefixes, without those of the first tier that no other set holds.

    Blocks of sets ask each part of the hash space how many sets hold their n-grams. A block names every n-gram once
    with the number of its own sets, so a frequent one costs a few bytes per block.
    """
    parts = parts_for(n_tokens, rules.tokens_per_group)
    blocks = _set_blocks(docs, parts, rules)

    def ask(table: pa.Table) -> pa.Table:
        grams, _ = _grams(_sets(table.to_pylist()))
        grams, holders = np.unique(grams, return_counts=True)
        part, digests = _digests(grams, parts)
        edges = np.searchsorted(part, np.arange(parts + 1, dtype=np.uint64))
        block = table["block"][0].as_py()
        return pa.Table.from_pylist([
            {"block": block, "part": p, "digests": digests[x:y].tobytes(), "holders": holders[x:y].astype("<u4").tobytes()}
            for p, (x, y) in enumerate(zip(edges, edges[1:])) if x < y], schema=ASK)

    def reply(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        digests, holders = (np.concatenate([np.frombuffer(r[c], dtype="<u4") for r in rows]) for c in ("digests", "holders"))
        _, at = np.unique(digests, return_inverse=True)
        total = np.minimum(np.bincount(at, weights=holders)[at], 0xFFFF).astype("<u2")
        cuts = np.cumsum([0, *[len(r["digests"]) // 4 for r in rows]])
        return pa.table({
            "block": pa.array([r["block"] for r in rows], pa.int64()), "part": pa.array([r["part"] for r in rows], pa.int64()),
            "holders": pa.array([total[x:y].tobytes() for x, y in zip(cuts, cuts[1:])], pa.binary())})

    def finish(table: pa.Table, replies: pa.Table) -> pa.Table:
        out: list[tuple[bytes, int, int]] = []
        if table.num_rows:
            sets = _sets(table.to_pylist())
            grams, cuts = _grams(sets)
            _, at = np.unique(grams, return_inverse=True)
            rows = sorted(replies.to_pylist(), key=lambda r: r["part"])
            holders = np.concatenate([np.empty(0, dtype="<u2"), *[np.frombuffer(r["holders"], dtype="<u2") for r in rows]])[at]
            for (set_id, row), x, y in zip(sets.items(), cuts, cuts[1:]):
                n, known = row["n"], holders[x:y]
                # N-grams that only this set holds come first and use up the prefix.
                slots = prefix_length(n, rules.percent) - int((known < 2).sum())
                if slots > 0:
                    shared = grams[x:y][known > 1]
                    shared = shared[np.lexsort((shared, known[known > 1]))]
                    prefix = [*shared.view(np.int64).tolist(), *row["next"]][:slots]
                    out += [(set_id, n, g) for g in prefix]
        columns = list(zip(*out)) if out else [[], [], []]
        return pa.table({"set_id": pa.array(columns[0], pa.binary()), "n": pa.array(columns[1], pa.int64()),
                         "gram": pa.array(columns[2], pa.int64())})

    asked = blocks.groupBy("block").applyInArrow(ask, "block long, part long, digests binary, holders binary")
    replied = asked.groupBy("part").applyInArrow(reply, "block long, part long, holders binary")
    return blocks.groupBy("block").cogroup(replied.groupBy("block")).applyInArrow(
        finish, "set_id binary, n long, gram long")


def _blocks(prefixes: DataFrame, rules: JoinRules) -> DataFrame:
    """gram, set_id, block: every set under the n-grams of its prefix that another set has in its own.

    A set's block is that of the most frequent n-gram in its prefix, in parts of bounded size.
    """
    prefixes = materialize(prefixes, "prefixes")
    shared = prefixes.groupBy("gram").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    prefixes = materialize(prefixes.join(shared, "gram"), "shared-prefixes")
    anchors = prefixes.groupBy("set_id").agg(F.first("n").alias("n"), F.max(F.struct("df", "gram")).alias("a"))
    anchors = anchors.select("set_id", "n", F.col("a.gram").alias("anchor"))
    load = F.ceil(F.sum(F.greatest("n", F.lit(rules.least_tokens))) / rules.block_tokens)
    loads = anchors.groupBy("anchor").agg(load.alias("parts"))
    placed = anchors.join(loads, "anchor").select("set_id", F.xxhash64(
        "anchor", F.pmod(F.xxhash64("set_id"), F.col("parts"))).alias("block"))
    return prefixes.select("gram", "set_id").join(placed, "set_id")


def _pivot_pairs(placed: DataFrame) -> DataFrame:
    """gram, left, right: of the blocks that hold an n-gram the first one with every other, and each with itself that
    holds it twice. One row at most for each block of an n-gram, and one more."""
    seen = placed.groupBy("gram", "block").agg(F.count(F.lit(1)).alias("sets"))
    pivots = seen.groupBy("gram").agg(F.min("block").alias("left"))
    across = seen.join(pivots, "gram").where("left < block").select("gram", "left", F.col("block").alias("right"))
    return across.unionByName(seen.where("sets > 1").select("gram", F.col("block").alias("left"), F.col("block").alias("right")))


def _open_pairs(placed: DataFrame, roots: DataFrame) -> DataFrame:
    """gram, left, right: the pairs of blocks that the first round has left out, but for those whose holders of the
    n-gram already are in one component: a link between them would join nothing.

    So an n-gram of a group of near copies that the first round has joined is dropped before blocks meet.
    """
    labelled = placed.join(roots.withColumnRenamed("node", "set_id"), "set_id", "left").select(
        "gram", "block", F.coalesce("root", "set_id").alias("root"))
    seen = labelled.groupBy("gram", "block").agg(F.min("root").alias("low"), F.max("root").alias("high"))
    still = seen.groupBy("gram").agg(
        F.min("block").alias("pivot"), F.count(F.lit(1)).alias("blocks"), F.min("low").alias("lowest"),
        F.max("high").alias("highest")).where("blocks > 2 and lowest < highest").select("gram", "pivot")
    seen = materialize(seen.join(still, "gram").where("block != pivot").drop("pivot"), "open-blocks")
    right = seen.select("gram", F.col("block").alias("right"), F.col("low").alias("low_"), F.col("high").alias("high_"))
    both = seen.withColumnRenamed("block", "left").join(right, "gram").where("left < right")
    return both.where("not (low = high and low_ = high_ and low = low_)").select("gram", "left", "right")


def _members(pairs: DataFrame, placed: DataFrame) -> DataFrame:
    """pair, side, set_id: for every pair of blocks the sets that hold an n-gram it was chosen for."""
    both = pairs.select("gram", "left", "right", F.xxhash64("left", "right").alias("pair"))
    members = [
        both.select("gram", F.col(side).alias("block"), "pair").join(placed, ["gram", "block"]).select(
            "pair", F.lit(at).alias("side"), "set_id").distinct() for at, side in enumerate(("left", "right"))]
    return members[0].unionByName(members[1])


def _marks(wanted: DataFrame, rules: JoinRules) -> bytes:
    """A bit set of fixed size with the hashes of the texts that are wanted again."""
    bit = F.pmod("text_hash", F.lit(rules.filter_bits)) + 1  # these two functions count from 1
    parts = wanted.select(bit.alias("bit")).groupBy(F.bitmap_bucket_number("bit").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("bits"))
    marks = bytearray(rules.filter_bits // 8 + 4096)
    for row in parts.toLocalIterator():
        start = (row["bucket"] - 1) * 4096
        marks[start:start + 4096] = row["bits"]
    return bytes(marks)


def _segments(docs: DataFrame, signed: DataFrame, members: DataFrame, rules: JoinRules) -> DataFrame:
    """set_id, n, parts: the n-grams of every set that is a member of a pair, cut by fragment.

    One text of every set is read again; a bit set of fixed size tells a task which texts cannot be among them.
    """
    edges = np.array([int(i * 2.0**64 / rules.fragments) for i in range(1, rules.fragments)], dtype=np.uint64)
    wanted = signed.join(members.select("set_id").distinct(), "set_id").groupBy("set_id").agg(F.min("text_hash").alias("text_hash"))
    marks = docs.sparkSession.sparkContext.broadcast(_marks(wanted, rules))

    def segment(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, seen = marks.value, set()
        for batch in batches:
            ids, sizes, cuts = [], [], []
            for text in batch.column(0).to_pylist():
                text_hash = _text_hash(text or b"")
                bit = text_hash % rules.filter_bits
                if bits[bit >> 3] >> (bit & 7) & 1 and text_hash not in seen:
                    seen.add(text_hash)
                    found = shingles(text or b"", rules.words)
                    if len(found):
                        ids.append(xxhash.xxh3_128_digest(found.tobytes()))
                        sizes.append(len(found))
                        cuts.append([part.tobytes() for part in np.split(found, np.searchsorted(found, edges))])
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.binary()), pa.array(sizes, pa.int64()), pa.array(cuts, pa.list_(pa.binary()))],
                names=["set_id", "n", "parts"])

    cut = docs.select("text").mapInArrow(segment, "set_id binary, n long, parts array<binary>")
    return cut.groupBy("set_id").agg(F.first("n").alias("n"), F.first("parts").alias("parts"))


def _incidence(sets: list[np.ndarray], known: np.ndarray) -> np.ndarray:
    """0/1 matrix of sets by the n-grams of `known`."""
    held = np.zeros((len(sets), len(known)), dtype=np.float32)
    for i, grams in enumerate(sets):
        at = np.searchsorted(known, grams)
        at[at == len(known)] = 0
        held[i, at[known[at] == grams]] = 1
    return held


def overlaps(left: list[np.ndarray], right: list[np.ndarray], columns: int = 4096) -> np.ndarray:
    """Sizes of the intersections of every set of `left` with every set of `right`."""
    counts = np.zeros((len(left), len(right)), dtype=np.int32)
    if left and right:
        known = np.intersect1d(np.unique(np.concatenate(left)), np.unique(np.concatenate(right)))
        for start in range(0, len(known), columns):
            part = known[start:start + columns]
            counts += (_incidence(left, part) @ _incidence(right, part).T).astype(np.int32)
    return counts


def forest(pairs: np.ndarray, n: int) -> list[tuple[int, int]]:
    """A spanning forest of a graph on 0..n-1: (smallest member, member) of every component of two or more."""
    root = list(range(n))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for a, b in pairs.tolist():
        a, b = find(a), find(b)
        if a != b:
            root[max(a, b)] = min(a, b)
    return [(find(i), i) for i in range(n) if find(i) != i]


SETS = pa.list_(pa.list_(pa.struct([("id", pa.binary()), ("n", pa.int64())])))


def _promising(counts: np.ndarray, left: list[dict], right: list[dict], percent: int) -> np.ndarray:
    """Where a pair can still link: its overlap here, and all that the other fragments could add, reach the threshold."""
    size = [np.array([s["n"] for s in side], dtype=np.int64) for side in (left, right)]
    rest = [n - np.array([len(s["grams"]) // 8 for s in side], dtype=np.int64) for n, side in zip(size, (left, right))]
    most = counts + np.minimum.outer(*rest)
    return (counts > 0) & ((100 + percent) * most >= percent * np.add.outer(*size))


def _links(members: DataFrame, segments: DataFrame, rules: JoinRules) -> DataFrame:
    """a, b: set ids; within every pair of blocks, a spanning forest of the links between their sets."""
    sets = members.join(segments, "set_id").select(
        "pair", "side", "set_id", "n", F.posexplode("parts").alias("fragment", "grams"))
    percent = rules.percent

    def partial(table: pa.Table) -> pa.Table:
        """Overlaps of one fragment of one pair of blocks, without those that rule a link out."""
        rows = sorted(table.to_pylist(), key=lambda r: r["set_id"])
        a, b = ([r for r in rows if r["side"] == side] for side in (0, 1))
        counts = overlaps(*([np.frombuffer(s["grams"], dtype=np.uint64) for s in side] for side in (a, b)))
        at = np.flatnonzero(_promising(counts, a, b, percent))
        ids = [[{"id": s["set_id"], "n": s["n"]} for s in side] for side in (a, b)]
        return pa.table({
            "pair": table["pair"][:1], "at": pa.array([at.astype("<i4").tobytes()], pa.binary()),
            "n": pa.array([counts.ravel()[at].astype("<i4").tobytes()], pa.binary()), "sets": pa.array([ids], SETS)})

    def total(rows: pa.Table) -> pa.Table:
        """Sums the partial counts of a pair of blocks and keeps a forest of the sets that link."""
        a, b = rows["sets"][0].as_py()
        counts = np.zeros(len(a) * len(b), dtype=np.int64)
        for at, n in zip(rows["at"].to_pylist(), rows["n"].to_pylist()):
            counts[np.frombuffer(at, dtype="<i4")] += np.frombuffer(n, dtype="<i4")
        counts = counts.reshape(len(a), len(b))
        union = np.add.outer([s["n"] for s in a], [s["n"] for s in b]) - counts
        i, j = np.nonzero((counts > 0) & (100 * counts >= percent * union))
        ids = sorted({s["id"] for s in (*a, *b)})
        place = {s: k for k, s in enumerate(ids)}
        ends = [np.array([place[s["id"]] for s in side])[k] for side, k in ((a, i), (b, j))]
        found = forest(np.column_stack(ends), len(ids))
        return pa.table({"a": pa.array([ids[k] for k, _ in found], pa.binary()),
                         "b": pa.array([ids[k] for _, k in found], pa.binary())})

    counted = sets.groupBy("pair", "fragment").applyInArrow(
        partial, "pair long, at binary, n binary, sets array<array<struct<id binary, n long>>>")
    return counted.groupBy("pair").applyInArrow(total, "a binary, b binary").distinct()


def components(links: DataFrame) -> DataFrame:
    """node, root: the smallest node that each linked node reaches.

    Every round joins each node's neighbours to the smallest of them, first from below, then from above, until nothing
    moves; the number of rounds grows with the logarithm of the longest chain.
    """
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u != v").distinct()
    edges = materialize(edges, "edges")
    state = None
    while True:
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        state = now
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("m", "u").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u != v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v")
        edges = materialize(small.unionByName(low.select("u", F.col("m").alias("v"))).distinct(), "edges")


def _roots(docs: DataFrame, signed: DataFrame, rules: JoinRules) -> DataFrame:
    """node, root: the component of every set that links with another, in two rounds of block pairs."""
    n_tokens = signed.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]
    placed = materialize(_blocks(_prefixes(docs, n_tokens, rules), rules), "placed")
    segments = materialize(_segments(docs, signed, placed, rules), "segments")
    members = materialize(_members(_pivot_pairs(placed), placed), "members")
    links = materialize(_links(members, segments, rules), "links")
    roots = components(links)
    pairs = materialize(_open_pairs(placed, roots), "open-pairs")
    if pairs.isEmpty():
        return roots
    return components(links.unionByName(_links(_members(pairs, placed), segments, rules)))


def join(docs: DataFrame, rules: JoinRules = JoinRules(), text: str = "text", key: str = "doc_id",
         carry: list[str] | None = None) -> DataFrame:
    """doc_id, n_shingles, component_id of every row, and the columns of `carry`."""
    carry = carry or []
    small_batches(docs.sparkSession)
    docs = docs.select(F.col(f"`{key}`").cast("long").alias("doc_id"),
                       F.col(f"`{text}`").cast("binary").alias("text"), *carry)
    signed = materialize(_signatures(docs, rules, carry), "signatures")
    roots = _roots(docs, signed, rules)
    classes = signed.where("set_id is not null").groupBy("set_id").agg(F.min("doc_id").alias("lowest"))
    classes = classes.join(roots, classes["set_id"] == roots["node"], "left").select(
        "set_id", "lowest", F.coalesce("root", "set_id").alias("root"))
    lowest = classes.groupBy("root").agg(F.min("lowest").alias("component_id"))
    named = materialize(classes.join(lowest, "root").select("set_id", "component_id"), "components")
    full = signed.join(named, "set_id", "left")
    return full.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce(
        F.when(F.col("doc_id").isNotNull(), F.col("component_id")), F.col("doc_id")).alias("component_id"), *carry)


def keep_one(docs: DataFrame, rules: JoinRules = JoinRules(), text: str = "text", key: str = "doc_id") -> DataFrame:
    """docs with one row of each component: that of its smallest id, and of several rows with this id one. Rows without
    words or without an id stay.

    Which rows stay is settled on their addresses alone; the rows themselves then move once.
    """
    placed = addressed(docs, "join-rows")
    slim = placed.select(F.col("row").getField(key).cast("long").alias("doc_id"), F.col("row").getField(text).alias("text"), *ADDRESS)
    joined = materialize(join(slim, rules, carry=ADDRESS), "joined")
    single = F.col("doc_id").isNull() | (F.col("n_shingles") == 0)
    named = joined.where(~single & (F.col("doc_id") == F.col("component_id")))
    first = named.groupBy("doc_id").agg(F.min(F.struct(*ADDRESS)).alias("at")).select("at.*")
    kept = materialize(joined.where(single).select(*ADDRESS).unionByName(first), "kept-rows")
    return rows_at(placed, kept).select("row.*")
