"""Scoring texts with a probabilistic suffix tree over words.

A state of the tree is a context of one to `depth` words. A context that precedes at least `min_count` training tokens is
kept if its next-token distribution diverges from that of the context one word shorter: the gain in log likelihood must
exceed the number of different next tokens. The least count is absolute, so the tree grows with the text learnt from, and
text that does not share a context takes no other away. A token is scored in the longest kept context before it, where
counts are smoothed with the next shorter kept context in proportion to the number of different next tokens
(Witten-Bell), down to the root with one added to every count.

Blocks of documents ask twice. First for the training counts of their different tokens, from parts dealt by the hash of
the token. Then, with these, for the probabilities of their different (context, token) entries, from parts dealt by the
word before the token. All contexts that end in a word meet in its part, which learns that branch of the tree and scores
in it at once, so the tree is never in one place. A word with more than half a part's share of all tokens, or a 200th of them, is hot: its
branch is spread by the word before it. Its own statistics then come from a grouped count of the pairs it begins, and
each block gets the counts of these pairs with those of its tokens. Blocks are shuffled once, as hashes of their different
words and, for every token, the place of its word, so that no text is split and no word hashed again after it. Broadcasts
and the driver hold totals and the hot words, at most 1 / `hot_share`.

What follows one pair of words meets in one task, each block's different entries once.

* A null or empty text has one token, its end. Repeated rows count and are scored each.
* Documents without an id are learnt from. Without any training document every text scores as under one unknown token.
* Tokens are told apart by 64-bit hashes. Log probabilities are sums of multiples of 2**-20.
* Columns other than key and text are left aside, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattloom.session import drop_folder, scratch_path, store

from .common import addressed, parts_for, small_batches

END = xxhash.xxh64_intdigest(b"\n")  # no word holds white space
UNIT = 2.0**20


@dataclass(frozen=True)
class TreeRules:
    depth: int = 3
    min_count: int = 4
    gain_per_token: float = 1.0
    tokens_per_part: int = 1_500_000
    hot_share: float = 5e-5


def _words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of UTF-8 texts in turn, A-Z lower-cased, and how many each text has."""
    lowered = pc.ascii_trim_whitespace(pc.ascii_lower(texts.cast(pa.large_binary()).view(pa.large_string())))
    lists = pc.ascii_split_whitespace(pc.if_else(pc.equal(lowered, ""), None, lowered))
    return lists.flatten(), pc.fill_null(pc.list_value_length(lists), 0).to_numpy().astype(np.int64)


def tokens(words: pa.Array, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the different words of texts and of their ends, in order, and the place there of every token: of the
    words of each text in turn, then its end."""
    first, group = _alike(words)
    different, place = np.unique(_hashes(words.take(pa.array(first))), return_inverse=True)
    ends = np.cumsum(sizes + 1) - 1
    inside = np.ones(len(words) + len(sizes), dtype=bool)
    inside[ends] = False
    token = np.empty(len(inside), dtype=np.int64)
    token[inside], token[ends] = place[group], place[-1]
    return different, token


def _hashes(words: pa.Array) -> np.ndarray:
    listed = pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), words.cast(pa.large_binary()))
    line = pc.binary_join(listed, pa.scalar(b" ", pa.large_binary()))[0].as_py()  # much faster than word by word
    found = np.fromiter(map(xxhash.xxh64_intdigest, line.split()), dtype=np.uint64, count=len(words))
    return np.append(found, np.uint64(END))


def _alike(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Groups of equal words: a place of each, and the group of every word. A word may have several groups.

    Words are read eight bytes at a time. Those of up to eight bytes are told apart by them and their length, longer
    ones by 64 mixed bits. The sort sees some of these bits beside the place of the word, which is why groups may split."""
    n, long = len(words), 128
    _, offsets, data = words.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[words.offset:words.offset + n + 1]
    begin, size = offsets[:-1], np.diff(offsets)
    data = np.append(np.frombuffer(data or b"", dtype=np.uint8)[offsets[0]:offsets[-1]], np.zeros(8, dtype=np.uint8))
    eight = np.lib.stride_tricks.as_strided(data[:8].view(np.uint64), shape=(len(data) - 7,), strides=(1,))
    begin = begin - offsets[0]
    prime, masks = np.uint64(0x9E3779B97F4A7C15), np.array([2**(8 * i) - 1 for i in range(9)], dtype=np.uint64)
    key = (eight[begin] & masks[np.minimum(size, 8)]) ^ (size.astype(np.uint64) * prime)
    left = np.flatnonzero((size > 8) & (size <= long))
    done = 8
    while len(left):
        mixed = key[left] * prime
        mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        key[left] = mixed ^ (mixed >> np.uint64(32)) ^ (eight[begin[left] + done] & masks[np.minimum(size[left] - done, 8)])
        done += 8
        left = left[size[left] > done]
    for i in np.flatnonzero(size > long):
        key[i] = xxhash.xxh64_intdigest(data[begin[i]:begin[i] + size[i]])
    mixed = key * prime
    mixed = (mixed ^ (mixed >> np.uint64(32))) * np.uint64(0xBF58476D1CE4E5B9)
    bits = n.bit_length()
    both = np.sort((mixed >> np.uint64(bits) << np.uint64(bits)) | np.arange(n, dtype=np.uint64))
    order = (both & np.uint64((1 << bits) - 1)).view(np.int64)
    new = _new(key[order])
    group = np.empty(n, dtype=np.int64)
    group[order] = np.cumsum(new) - 1
    return order[new], group


def _blob(values: np.ndarray, kind: str) -> bytes:
    """Numbers in little space: their first bytes, then their second ones, and so on, compressed."""
    planes = np.ascontiguousarray(values, dtype=kind).reshape(-1, 1).view(np.uint8).T
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())


def _array(blob: bytes, kind: str) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), dtype=np.uint8)
    return np.ascontiguousarray(planes.reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()


def _steps(values: np.ndarray, kind: str = "<i8") -> bytes:
    """Numbers that mostly rise or mostly fall, as their differences."""
    values = values.astype(kind, copy=False)
    step = np.diff(values, prepend=values.dtype.type(0))
    return _blob((step << 1) ^ (step >> 8 * values.itemsize - 1), kind)


def _from_steps(blob: bytes, kind: str = "<i8") -> np.ndarray:
    step = _array(blob, kind.replace("i", "u"))
    return np.cumsum((step >> 1).view(kind) ^ -(step & 1).view(kind), dtype=kind)


def _known(words: np.ndarray, sorted_words: np.ndarray) -> np.ndarray:
    """The 1-based place of each word in `sorted_words`, 0 for others."""
    if not len(sorted_words):
        return np.zeros(len(words), dtype=np.int64)
    at = np.searchsorted(sorted_words, words)
    at[at == len(sorted_words)] = 0
    return np.where(sorted_words[at] == words, at + 1, 0)


def _ranked(keys: np.ndarray, room: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys below `room` in order, and their places, which rise for equal keys. A sort of values is much faster than one
    of places, so both go into one number if they fit."""
    bits = len(keys).bit_length()
    if room << bits > 2**63:
        order = np.argsort(keys, kind="stable")
        return keys[order], order
    both = keys.astype(np.int64)
    both <<= bits
    both |= np.arange(len(keys))
    both.sort()
    order = both & ((1 << bits) - 1)
    both >>= bits
    return both, order


def _groups(keys: np.ndarray, room: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The different keys below `room` in order, the first place of each, and the group of every key."""
    ranked, order = _ranked(keys, room)
    new = _new(ranked)
    group = np.empty(len(keys), dtype=np.int64)
    group[order] = np.cumsum(new) - 1
    return ranked[new], order[new], group


def _rows(columns: list[np.ndarray], width: int) -> tuple[np.ndarray, np.ndarray]:
    """One place of each different row of numbers below `width`, in the order of rows, and the rank of every row. The
    last columns are sorted first, as many at once as fit."""
    keys, room = [columns[-1]], width
    order = None
    for column in columns[-2::-1]:
        if room * width << len(column).bit_length() > 2**63:
            order = _after(keys[-1], room, order)
            keys.append(column)
            room = width
        else:
            keys[-1] = column.astype(np.int64) * room + keys[-1]
            room *= width
    order = _after(keys[-1], room, order)
    new = np.logical_or.reduce([_new(key[order]) for key in keys])
    rank = np.empty(len(order), dtype=np.int64)
    rank[order] = np.cumsum(new) - 1
    return order[new], rank


def _after(keys: np.ndarray, room: int, order: np.ndarray | None) -> np.ndarray:
    """The order by keys, for equal keys the one given."""
    return _ranked(keys, room)[1] if order is None else order[_ranked(keys[order], room)[1]]


def _new(ranked: np.ndarray) -> np.ndarray:
    """Whether a value differs from the one before it."""
    return np.append(True, ranked[1:] != ranked[:-1])[:len(ranked)]


def _used(columns: np.ndarray, size: int) -> np.ndarray:
    """The different values above 0, in order, of numbers up to `size`."""
    if columns.size * 16 < size:
        used = np.unique(columns)
        return used[used > 0]
    seen = np.zeros(size + 1, dtype=bool)
    seen[columns.ravel()] = True
    seen[0] = False
    return np.flatnonzero(seen)


def _part(words: np.ndarray, second: np.ndarray, parts: int) -> np.ndarray:
    """The part of every entry by the hash of a word and a second value."""
    mixed = words ^ (second.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    mixed = (mixed ^ (mixed >> np.uint64(32))) * np.uint64(0xBF58476D1CE4E5B9)
    mixed ^= mixed >> np.uint64(29)
    return (((mixed >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)).astype(np.int64)


def _slices(part: np.ndarray, parts: int) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
    """The order of entries by part that otherwise keeps theirs, and (part, begin, end) of each part in it."""
    ranked, order = _ranked(part, parts)
    begin = np.flatnonzero(_new(ranked))
    return order, list(zip(ranked[begin].tolist(), begin.tolist(), [*begin[1:].tolist(), len(part)]))


def _positions(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each text starts among all tokens, and the place of every token in its text."""
    starts = np.append(0, np.cumsum(sizes)[:-1])
    return starts, np.arange(sizes.sum()) - np.repeat(starts, sizes)


def _before(flat: np.ndarray, place: np.ndarray, k: int) -> np.ndarray:
    """The k-th value before every position, 0 beyond the start of its text."""
    shifted = np.zeros_like(flat)
    shifted[k:] = flat[:-k]
    return np.where(place >= k, shifted, np.zeros(1, dtype=flat.dtype))


def _chunks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[pa.Table, pa.Array, np.ndarray]]:
    """Neighbouring rows with about `size` tokens, the words of their texts in turn, and how many each has."""
    rows, words, sizes, n = [], [], [], 0
    for batch in batches:
        for piece in _pieces(batch):
            found, count = _words(piece["text"])
            ends, tokens_to = np.append(0, np.cumsum(count)), np.append(0, np.cumsum(count + 1))
            a = 0
            while a < len(count):
                b = min(np.searchsorted(tokens_to, tokens_to[a] + size - n), len(count))
                rows.append(piece.slice(a, b - a))
                words.append(found[ends[a]:ends[b]])
                sizes.append(count[a:b])
                n += tokens_to[b] - tokens_to[a]
                a = b
                if n >= size:
                    yield pa.Table.from_batches(rows), pa.concat_arrays(words), np.concatenate(sizes)
                    rows, words, sizes, n = [], [], [], 0
    if rows:
        yield pa.Table.from_batches(rows), pa.concat_arrays(words), np.concatenate(sizes)
    del rows, words, sizes
    pa.default_memory_pool().release_unused()  # else the next tasks of the worker have that much less


def _pieces(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Rows of a batch with about 8 MB of text, or one row, at a time."""
    size = pc.fill_null(pc.binary_length(batch["text"]), 0).to_numpy().astype(np.int64)
    begin = np.flatnonzero(_new(np.cumsum(size) >> 23)).tolist()
    for a, b in zip(begin, [*begin[1:], len(size)]):
        yield batch.slice(a, b - a)


def _learnt(held_out: list[bool], sizes: np.ndarray) -> np.ndarray:
    """Whether each token of texts with so many tokens is learnt from."""
    return np.repeat(~np.array(held_out, dtype=bool), sizes)


def vocabulary(docs: DataFrame, rules: TreeRules, path: str) -> DataFrame:
    """token, n, stored at a path: occurrences of every token in training documents. The null token counts those in all
    documents."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, words, sizes in _chunks(batches, rules.tokens_per_part):
            different, token = tokens(words, sizes)
            n = np.bincount(token[_learnt(rows["held_out"].to_pylist(), sizes + 1)], minlength=len(different))
            used = n > 0
            yield pa.RecordBatch.from_arrays(
                [pa.concat_arrays([pa.array([None], pa.int64()), pa.array(different[used].view(np.int64))]),
                 pa.array(np.append(len(token), n[used]))], names=["token", "n"])

    counted = docs.select("text", "held_out").mapInArrow(count, "token long, n long")
    return store(counted.groupBy("token").agg(F.sum("n").alias("n")), path)


@dataclass
class Hot:
    """The hot words, sorted, and by 1-based place (0: no word) how often they are learnt, how many tokens are learnt after
    them, different ones, and whether their context is kept; with the numbers of training tokens and of different ones."""

    words: np.ndarray
    counts: np.ndarray
    n: np.ndarray
    kinds: np.ndarray
    kept: np.ndarray
    tokens: int
    vocabulary: int

    def root(self, counts: np.ndarray) -> np.ndarray:
        return (counts + 1) / (self.tokens + self.vocabulary + 1)


def hot_words(docs: DataFrame, known: DataFrame, parts: int, rules: TreeRules) -> Hot:
    total = known.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    found = known.where(F.col("n") > max(rules.hot_share, min(0.5 / parts, 0.005)) * total.n).collect()
    found.sort(key=lambda r: r.token % 2**64)
    words = np.array([r.token % 2**64 for r in found], dtype=np.uint64)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts, sizes in _chunks(batches, rules.tokens_per_part):
            different, token = tokens(texts, sizes)
            code = _before(_known(different, words)[token], _positions(sizes + 1)[1], 1)
            begun = (code > 0) & _learnt(rows["held_out"].to_pylist(), sizes + 1)
            pairs, n = np.unique(token[begun] * (len(words) + 1) + code[begun], return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(different[pairs // (len(words) + 1)].view(np.int64)), pa.array(pairs % (len(words) + 1)),
                 pa.array(n.astype(np.int64))], names=["token", "code", "pair"])

    n, kinds = (np.zeros(len(words) + 1, dtype=np.int64) for _ in range(2))
    gain = np.zeros(len(words) + 1)
    if len(words):
        pairs = docs.select("text", "held_out").mapInArrow(count, "token long, code long, pair long")
        pairs = pairs.groupBy("token", "code").agg(F.sum("pair").alias("pair")).join(known, "token")
        for r in pairs.groupBy("code").agg(F.sum("pair").alias("n"), F.count("*").alias("kinds"), F.sum(
                F.col("pair") * F.log(F.col("pair") / F.col("n"))).alias("gain")).collect():
            n[r.code], kinds[r.code], gain[r.code] = r.n, r.kinds, r.gain + r.n * np.log(total.n / r.n)
    kept = (n >= rules.min_count) & (gain > rules.gain_per_token * kinds)
    return Hot(words, np.array([0, *[r.n for r in found]]), n, kinds, kept, total.n, total.v)


def packed(words: pa.Array, sizes: np.ndarray) -> dict:
    """Texts as the hashes of their different words and, for every token, the place of its hash: common ones first, those
    of one count in order."""
    different, token = tokens(words, sizes)
    order = np.argsort(-np.bincount(token, minlength=len(different)), kind="stable")
    place = np.empty(len(order), dtype=np.int64)
    place[order] = np.arange(len(order))
    return {"sizes": _blob(sizes + 1, "<i8"), "words": _steps(different[order].view(np.int64)),
            "tokens": _blob(place[token], "<i4")}


def blocks_of(docs: DataFrame, rules: TreeRules) -> DataFrame:
    """block, keys, held_out, sizes, words, tokens: about tokens_per_part tokens of neighbouring documents a row, packed. A
    block is named by the address of its first document."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, words, sizes in _chunks(batches, rules.tokens_per_part):
            yield pa.RecordBatch.from_pylist([{
                "block": rows["address"][0].as_py(), "keys": rows["key"].to_pylist(),
                "held_out": rows["held_out"].to_pylist(), **packed(words, sizes)}], schema=_schema(BLOCK_DDL))

    return docs.select("address", "key", "held_out", "text").mapInArrow(pack, BLOCK_DDL)


class Block:
    """The tokens of a block of documents, of a row or more of the same name. Rows may also hold `texts`, compressed, one a
    line. Entries and their order do not depend on the order of rows."""

    def __init__(self, rows: list[dict], hot: Hot, parts: int):
        self.keys = [k for r in rows for k in r["keys"]]
        self.held_out = [h for r in rows for h in r["held_out"]]
        rows = [packed(*_words(pa.array(zstandard.ZstdDecompressor().decompress(r["texts"]).split(b"\n"), pa.binary())))
                if "texts" in r else r for r in rows]
        self.sizes = np.concatenate([_array(r["sizes"], "<i8") for r in rows])
        self.starts, self.place = _positions(self.sizes)
        self.learnt = _learnt(self.held_out, self.sizes).astype(float)
        words = [_from_steps(r["words"]).view(np.uint64) for r in rows]
        self.words, place = np.unique(np.concatenate(words), return_inverse=True)
        begin = np.cumsum([0, *map(len, words)])
        self.token = place[np.concatenate([_array(r["tokens"], "<i4") + a for r, a in zip(rows, begin)])]
        place = _known(self.words, hot.words)
        self.code = _before(place[self.token], self.place, 1)
        self.parts = parts
        self.base = base = len(hot.words) + 1
        # different (token, hot word before it or 0), few of which need a sort
        self._after_hot = np.flatnonzero(self.code)
        plain = np.bincount(self.token[self.code == 0], minlength=len(self.words))
        pairs, _, self._pair = _groups(self.token[self._after_hot] * base + self.code[self._after_hot], len(self.words) * base)
        self._plain = np.flatnonzero(plain)
        pairs, order = _ranked(np.concatenate([self._plain * base, pairs]), len(self.words) * base)
        self._pairs, self._sources = (pairs // base, pairs % base), order
        keys = self.words[self._pairs[0]]
        spread = np.where(place[self._pairs[0]] > 0, self._pairs[1], 0)
        self._pair_order, self._pair_slices = _slices(_part(keys, spread, parts), parts)

    def ask_counts(self) -> Iterator[dict]:
        token, code = (values[self._pair_order] for values in self._pairs)
        learnt = np.where(self.code == 0, self.learnt, 0)
        n = np.concatenate([np.bincount(self.token, weights=learnt, minlength=len(self.words))[self._plain],
                            np.bincount(self._pair, weights=self.learnt[self._after_hot])])[self._sources][self._pair_order]
        for part, a, b in self._pair_slices:
            yield {"part": part, "tokens": _steps(self.words[token[a:b]].view(np.int64)), "codes": _blob(code[a:b], "<i4"),
                   "counts": _blob(n[a:b], "<i4")}

    def take_counts(self, replies: list[dict]) -> None:
        """Sets the number and the training count of every different word, by which words are put in order, and the count
        of the pair that ends at every position, if a hot word begins it."""
        token, code = (values[self._pair_order] for values in self._pairs)
        self.number, self.known = (np.empty(len(self.words), dtype=np.int64) for _ in range(2))
        pair = np.zeros(len(token), dtype=np.int64)
        for row, (part, a, b) in zip(sorted(replies, key=lambda r: r["part"]), self._pair_slices, strict=True):
            here, place = token[a:b][_new(token[a:b])], _array(row["x"], "<i4").astype(np.int64)
            self.number[here] = np.where(place < self.base, place, self.base + (place - self.base) * self.parts + part)
            self.known[here[np.argsort(place)]] = _from_steps(row["y"])
            pair[a:b][code[a:b] > 0] = _array(row["z"], "<i8")
        back = np.empty(len(token), dtype=np.int64)
        back[self._sources[self._pair_order]] = pair
        self.pair = np.zeros(len(self.token), dtype=np.int64)
        self.pair[self._after_hot] = back[len(self._plain):][self._pair]
        self._rank()

    def _rank(self) -> None:
        order = np.argsort(self.number)
        place = np.empty(len(order), dtype=np.int64)
        place[order] = np.arange(len(order))
        self.words, self.known, self.number = self.words[order], self.known[order], self.number[order]
        self.token = place[self.token]

    def contexts(self, rules: TreeRules) -> None:
        """Sets the different (context, token) entries. A word learnt less than min_count times ends a context."""
        width = len(self.words) + 1
        often = np.append(False, self.known >= rules.min_count)
        token = self.token.astype(np.int32)
        before, above = [], np.ones(len(token), dtype=bool)
        for k in range(1, rules.depth + 1):
            word = _before(token + 1, self.place, k)
            above &= often[word]
            before.append(np.where(above, word, np.int32(0)))
        self.deep = np.flatnonzero(before[0])
        first, self._entry = _rows([word[self.deep] for word in [*before, token]], width)
        self._first, self._before = self.deep[first], before
        second = before[1][self._first] if rules.depth > 1 else np.zeros(len(first), dtype=np.int64)
        hashes = np.append(np.uint64(0), self.words)
        spread = np.where(self.code[self._first] > 0, hashes[second], np.uint64(0))
        part = _part(hashes[before[0][self._first]], spread, self.parts)
        self._entry_order, self._entry_slices = _slices(part, self.parts)

    def ask_chances(self) -> Iterator[dict]:
        at = self._first[self._entry_order]
        columns = np.stack([*(word[at] for word in self._before), self.token[at] + 1], dtype=np.int32, casting="unsafe")
        n = np.bincount(self._entry, weights=self.learnt[self.deep], minlength=len(at))[self._entry_order]
        above = np.where(self.code[at] > 0, self.pair[at], 0)
        local = np.zeros(len(self.words) + 1, dtype=np.int32)
        for part, a, b in self._entry_slices:
            used = _used(columns[:, a:b], len(self.words))
            local[used] = np.arange(1, len(used) + 1)
            *before, token = local[columns[:, a:b]]
            yield {"part": part, "words": _steps(self.number[used - 1]), "known": _steps(self.known[used - 1]),
                   # the first word rises, the second inside the first
                   "before": [_steps(word, "<i4") if k < 2 else _blob(word, "<i4") for k, word in enumerate(before)],
                   "token": _blob(token, "<i4"), "counts": _blob(n[a:b], "<i4"), "above": _blob(above[a:b], "<i8")}

    def costs(self, replies: list[dict], hot: Hot) -> np.ndarray:
        """-log10 of the probability of every token, in units of 2**-20."""
        out = np.rint(-np.log10(hot.root(self.known)) * UNIT).astype(np.int64)[self.token]
        if len(self.deep):
            sent = np.concatenate([_array(r["x"], "<i4") for r in sorted(replies, key=lambda r: r["part"])])
            entry = np.empty(len(sent), dtype=np.int64)
            entry[self._entry_order] = sent
            out[self.deep] = entry[self._entry]
        return out


def _sums(groups: np.ndarray, values: np.ndarray, size: int) -> np.ndarray:
    return np.bincount(groups, weights=values, minlength=size)


def count_tokens(rows: list[dict], hot: Hot) -> Iterator[tuple[dict, np.ndarray, np.ndarray, np.ndarray]]:
    """Every row with the places of its different tokens, their training counts in order of places and, for entries with a
    hot word, counts of its pairs.

    Hot tokens, which are in several parts, have places from 1. The others follow, in each part by falling count, so that
    words that are close in place are close in count. Of these places the block makes numbers, different over all parts."""
    hashes = [_from_steps(r["tokens"]).view(np.uint64) for r in rows]
    codes, counts = (np.concatenate([_array(r[c], "<i4") for r in rows]).astype(np.int64) for c in ("codes", "counts"))
    words, token = np.unique(np.concatenate(hashes), return_inverse=True)
    place = _known(words, hot.words)
    known = np.where(place > 0, hot.counts[place], np.bincount(token, weights=counts)).astype(np.int64)
    rank = np.empty(len(words), dtype=np.int64)
    rank[np.argsort(-known, kind="stable")] = np.arange(len(words))
    place = np.where(place > 0, place, len(hot.words) + 1 + rank)
    base = len(hot.words) + 1
    _, _, at = _groups(token * base + codes, len(words) * base)
    pair = np.bincount(at, weights=counts)[at].astype(np.int64)
    ends = np.cumsum([0, *map(len, hashes)])
    for row, a, b in zip(rows, ends[:-1], ends[1:]):
        here = token[a:b][_new(token[a:b])]
        yield row, place[here], known[here[np.argsort(place[here])]], pair[a:b][codes[a:b] > 0]


def _entries(row: dict, depth: int) -> np.ndarray:
    """The columns of a row's entries: the words before a token, nearest first, and the token, as places among its words."""
    before = [(_from_steps if k < 2 else _array)(row["before"][k], "<i4") for k in range(depth)]
    return np.stack([*before, _array(row["token"], "<i4")])


def branch(rows: list[dict], hot: Hot, rules: TreeRules) -> Iterator[tuple[dict, np.ndarray]]:
    """Learns the branches of the tree that end in the words of a part; every row with the costs of its entries."""
    numbers = [_from_steps(r["words"]) for r in rows]
    numbered = np.concatenate(numbers)
    words, _, place = _groups(numbered, int(numbered.max(initial=0)) + 1)
    known = np.zeros(len(words) + 1, dtype=np.int64)
    known[place + 1] = np.concatenate([_from_steps(r["known"]) for r in rows])
    columns, begin = [], 0
    for r, n in zip(rows, map(len, numbers)):
        columns.append(np.append(0, place[begin:begin + n] + 1).astype(np.int32)[_entries(r, rules.depth)])
        begin += n
    ends = np.cumsum([c.shape[1] for c in columns])
    *before, token = np.concatenate(columns, axis=1)
    del columns, numbered, place
    counts, above = (np.concatenate([_array(r[c], kind) for r in rows]) for c, kind in (("counts", "<i4"), ("above", "<i8")))
    width = len(words) + 1
    chance = hot.root(known[token])
    # of the context one word shorter: its id, and how often it is learnt, with the token and in all
    at, context = np.arange(len(token)), np.zeros(len(token), dtype=np.int64)
    parent, parent_size = known[token].astype(float), np.full(len(token), float(hot.tokens))
    size, deeper = 1, True
    for k, word in enumerate(before):
        inside = np.flatnonzero(deeper & (word[at] > 0))
        at, context, parent, parent_size = at[inside], context[inside], parent[inside], parent_size[inside]
        if not len(at):
            break
        different, _, context = _groups(context * width + word[at], size * width)
        size = len(different)
        pairs, first, pair = _groups(context * width + token[at], size * width)
        owner = pairs // width
        n = _sums(pair, counts[at], len(pairs))
        total, kinds = _sums(owner, n, size), _sums(owner, n > 0, size)
        seen = n > 0
        ratio = n[seen] / total[owner[seen]] / (parent[first[seen]] / parent_size[first[seen]])
        gain = _sums(owner[seen], n[seen] * np.log(ratio), size)
        kept = (total >= rules.min_count) & (gain > rules.gain_per_token * kinds)
        if k == 0 and len(hot.words):
            code = np.zeros(size, dtype=np.int64)
            number = words[word[at] - 1]
            code[context] = np.where(number <= len(hot.words), number, 0)
            n = np.where(code[owner] > 0, above[at[first]], n)
            total, kinds, kept = (np.where(code > 0, whole[code], here)
                                  for whole, here in ((hot.n, total), (hot.kinds, kinds), (hot.kept, kept)))
        parent, parent_size = n[pair], total[context]
        use = np.flatnonzero(kept[context])
        here, more = at[use], kinds[context[use]]
        chance[here] = (parent[use] + more * chance[here]) / np.maximum(parent_size[use] + more, 1)
        deeper = (total >= rules.min_count)[context]  # a longer context is no more frequent
    costs = np.rint(-np.log10(chance) * UNIT).astype(np.int64)
    for row, a, b in zip(rows, np.append(0, ends[:-1]), ends):
        yield row, costs[a:b]


BLOCK_DDL = "block long, keys array<long>, held_out array<boolean>, sizes binary, words binary, tokens binary"
COUNTS_DDL = "block long, part long, tokens binary, codes binary, counts binary"
CHANCES_DDL = "block long, part long, words binary, known binary, before array<binary>, token binary, counts binary, above binary"
REPLY_DDL = "block long, about string, part long, x binary, y binary, z binary"
SCORES_DDL = ("key long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, "
              "score double")


def _schema(ddl: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "binary": pa.binary(), "string": pa.string(), "array<long>": pa.list_(pa.int64()),
             "array<boolean>": pa.list_(pa.bool_()), "array<binary>": pa.list_(pa.binary())}
    return pa.schema([(name, kinds[kind]) for name, kind in (field.split() for field in ddl.split(", "))])


def score(docs: DataFrame, rules: TreeRules = TreeRules(), text: str = "text", key: str = "doc_id",
          folds: int = 7, held_out_fold: int = 2) -> DataFrame:
    """key, held_out, n_tokens, n_known, train_tokens, base_score, score of every row."""
    spark = docs.sparkSession
    small_batches(spark)
    held_out = F.coalesce(F.crc32(F.col(f"row.`{key}`").cast("string")) % folds == held_out_fold, F.lit(False))
    docs = addressed(docs, "suffix-tree-documents").select(
        F.col(f"row.`{key}`").cast("long").alias("key"), F.col(f"row.`{text}`").cast("binary").alias("text"),
        held_out.alias("held_out"), F.xxhash64("file", "place").alias("address"))
    path = scratch_path(spark, "vocabulary")
    known = vocabulary(docs, rules, path)
    every = known.where("token is null").first()
    parts = parts_for(every.n if every else 0, rules.tokens_per_part)
    hot = hot_words(docs, known.where("token is not null"), parts, rules)
    drop_folder(spark, path)
    shared = spark.sparkContext.broadcast(hot)

    def ask_counts(table: pa.Table) -> pa.Table:
        rows = Block(table.to_pylist(), shared.value, parts).ask_counts()
        block = table["block"][0].as_py()
        return pa.Table.from_pylist([{"block": block, **row} for row in rows], schema=_schema(COUNTS_DDL))

    def reply_counts(table: pa.Table) -> pa.Table:
        rows = [{"block": row["block"], "about": "counts", "part": row["part"],
                 "x": _blob(place, "<i4"), "y": _steps(known), "z": _blob(pair, "<i8")}
                for row, place, known, pair in count_tokens(table.to_pylist(), shared.value)]
        return pa.Table.from_pylist(rows, schema=_schema(REPLY_DDL))

    def ask_chances(table: pa.Table, replies: pa.Table) -> pa.Table:
        block = Block(table.to_pylist(), shared.value, parts)
        block.take_counts(replies.to_pylist())
        block.contexts(rules)
        rows = [{"block": table["block"][0].as_py(), **row} for row in block.ask_chances()]
        return pa.Table.from_pylist(rows, schema=_schema(CHANCES_DDL))

    def reply_chances(table: pa.Table) -> pa.Table:
        rows = [{"block": row["block"], "about": "chances", "part": row["part"], "x": _blob(costs, "<i4"), "y": None, "z": None}
                for row, costs in branch(table.to_pylist(), shared.value, rules)]
        return pa.Table.from_pylist(rows, schema=_schema(REPLY_DDL))

    def finish(table: pa.Table, replies: pa.Table) -> pa.Table:
        hot = shared.value
        rows = replies.to_pylist()
        block = Block(table.to_pylist(), hot, parts)
        block.take_counts([r for r in rows if r["about"] == "counts"])
        block.contexts(rules)
        costs = block.costs([r for r in rows if r["about"] == "chances"], hot)
        add = lambda values: np.add.reduceat(values, block.starts)
        known = block.known[block.token]
        base_score = np.log10(hot.root(block.known))[block.token]
        return pa.table({
            "key": pa.array(block.keys, pa.int64()), "held_out": pa.array(block.held_out, pa.bool_()),
            "n_tokens": pa.array(block.sizes.astype(np.int64)), "n_known": pa.array(add((known > 0).astype(np.int64))),
            "train_tokens": pa.array(np.full(len(block.sizes), hot.tokens, dtype=np.int64)),
            "base_score": pa.array(add(base_score)), "score": pa.array(-add(costs) / UNIT)})

    blocks = blocks_of(docs, rules)
    counts = blocks.groupBy("block").applyInArrow(ask_counts, COUNTS_DDL).groupBy("part").applyInArrow(reply_counts, REPLY_DDL)
    asked = blocks.groupBy("block").cogroup(counts.groupBy("block")).applyInArrow(ask_chances, CHANCES_DDL)
    replies = counts.unionByName(asked.groupBy("part").applyInArrow(reply_chances, REPLY_DDL))
    return blocks.groupBy("block").cogroup(replies.groupBy("block")).applyInArrow(finish, SCORES_DDL)
