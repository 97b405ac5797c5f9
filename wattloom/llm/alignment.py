"""Alignment of the token ids of two tokenizers over a corpus.

Both tokenizers cut the bytes of a space and the text. Where a token of each ends at one byte, a group ends; two tokens
whose bytes overlap are linked; an id pair's count is how many links of the corpus hold it.

1. Workers gather documents into blocks of bounded size. Neither vocabulary has a token that goes on behind a character
   into a space (checked for the second when it is loaded), so a text without two blanks in a row falls into words, which
   are encoded and aligned once a block; a document is the list of its words. Byte ends of all words of a block are lined
   up in one array, where groups and links come out by sorted search. A block travels as pieces, rows of a few hundred
   kilobytes: for rows of megabytes a JVM takes its whole heap and buffers beside it.
2. Identity map: an array takes each id of A to the id of B with the same bytes. A group of one token each whose ids it
   pairs is regular, and is counted in a vector as long as A's vocabulary. Only the links of other groups enter the pair
   shuffle, one row per block and pair.
3. Totals are summed over blocks and returned to them (a frequent pair has one row in each block, whatever the number
   of its links). Totals of regular pairs and the highest count of every id of B are as long as a vocabulary and broadcast.

* A null or empty text, or one whose bytes a tokenizer does not give back, has no tokens: zeros and an empty digest.
* Texts of any length are aligned whole. Repeated rows are documents of their own; ids may be null. Ties for the highest
  count are all best. An empty table has no rows and no pairs. Other columns of docs, whatever their names, are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, fields

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wattloom.session import materialize

from .common import small_batches
from .tokens import BLANKS, SPACE_AND_BLANK, Encoder, token_bytes, tokenizer_path

B_SHIFT = 32
MARK = "▁"  # stands for a space in pieces


@dataclass(frozen=True)
class AlignRules:
    block_bytes: int = 4_000_000
    block_rows: int = 50_000
    chunk_words: int = 20_000
    piece_numbers: int = 32_768  # of every array
    piece_docs: int = 1_000
    byte_bpe: str | None = None
    piece_bpe: str | None = None


def piece_bytes(model) -> list[bytes]:
    """The bytes of every id of a piece model."""
    names = [model.id_to_piece(i) for i in range(model.get_piece_size())]
    return [bytes([int(name[3:5], 16)]) if model.is_byte(i) else name.replace(MARK, " ").encode()
            for i, name in enumerate(names)]


def identity_map(a: list[bytes], b: list[bytes], usable: list[bool], whole: list[bool]) -> np.ndarray:
    """For every id of A the id of B with the same bytes, -1 if there is none; a whole piece goes before a single byte."""
    ids = {token: i for i, token in enumerate(b) if usable[i] and not whole[i]}
    ids.update({token: i for i, token in enumerate(b) if usable[i] and whole[i]})
    return np.array([ids.get(token, -1) for token in a], dtype=np.int64)


class Vocabularies:
    """Both tokenizers with the bytes of their ids."""

    def __init__(self, rules: AlignRules):
        import sentencepiece

        path = rules.byte_bpe or tokenizer_path()
        self.encoder = Encoder(path, remembered=0)  # blocks ask for each of their words once
        self.model = sentencepiece.SentencePieceProcessor(
            model_file=rules.piece_bpe or tokenizer_path("piece_bpe_32k.model"))
        self.a, self.b = token_bytes(path), piece_bytes(self.model)
        self.a_len, self.b_len = (np.array(list(map(len, table)), dtype=np.int64) for table in (self.a, self.b))
        size = range(len(self.b))
        special = [self.model.is_control(i) or self.model.is_unknown(i) for i in size]
        whole = [not self.model.is_byte(i) for i in size]
        self.same = identity_map(self.a, self.b, [not s for s in special], whole)
        #: Words can be encoded apart only if no piece holds a space behind another character.
        self.by_word = not any(re.search(f"[^{MARK}]{MARK}", self.model.id_to_piece(i)) for i in size)

    def words(self, text: str) -> list[str]:
        """What is encoded apart, each with a space before it; a text with blanks in a row or at its ends is one word."""
        if not self.by_word or text[0] == " " or text[-1] == " " or SPACE_AND_BLANK.search(" " + text):
            return [text]
        return text.split(" ")


@dataclass
class Words:
    """Alignment of distinct words: figures by word, links one after the other."""

    valid: np.ndarray
    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    n_links: np.ndarray
    groups: list[bytes]
    keys: np.ndarray
    regular: np.ndarray


def encode_words(words: list[str], vocabularies: Vocabularies) -> tuple[list[np.ndarray], list[np.ndarray], list[bool]]:
    """Ids of words, each with a space before it, one after the other, and which words both tokenizers give back.

    Words without blanks are encoded as one text; if it does not come back, its halves are tried, down to the words.
    """
    text = " ".join(words)
    whole = (" " + text).encode()
    a = np.frombuffer(vocabularies.encoder.encode([" " + text])[0], dtype="<u4").astype(np.int64)
    b = np.array(vocabularies.model.encode(text, num_threads=1), dtype=np.int64)
    if all(b"".join(map(table.__getitem__, ids.tolist())) == whole for table, ids in ((vocabularies.a, a), (vocabularies.b, b))):
        return [a], [b], [True] * len(words)
    if len(words) == 1:
        return [], [], [False]
    middle = len(words) // 2
    left, right = encode_words(words[:middle], vocabularies), encode_words(words[middle:], vocabularies)
    return tuple(x + y for x, y in zip(left, right))


def stretches(words: list[str]) -> Iterator[list[str]]:
    """Words that can be encoded as one text; one with a space in it, or a blank at an end, is alone."""
    together: list[str] = []
    for word in words:
        if not word or " " in word or word[0] in BLANKS or word[-1] in BLANKS:
            if together:
                yield together
            yield [word]
            together = []
        else:
            together.append(word)
    if together:
        yield together


def align_words(words: list[str], vocabularies: Vocabularies) -> Words:
    """Aligns words, each with a space before it."""
    parts = [encode_words(stretch, vocabularies) for stretch in stretches(words)]
    none = np.empty(0, dtype=np.int64)
    a, b = (np.concatenate([none, *[ids for part in parts for ids in part[side]]]) for side in (0, 1))
    valid = np.array([ok for part in parts for ok in part[2]], dtype=bool)
    n_bytes = np.fromiter((len(w.encode()) + 1 for w in words), dtype=np.int64, count=len(words))
    word_end = np.cumsum(np.where(valid, n_bytes, 0))

    def by_word(ends: np.ndarray) -> np.ndarray:
        return np.diff(np.searchsorted(ends, word_end, side="right"), prepend=0)

    a_end, b_end = np.cumsum(vocabularies.a_len[a]), np.cumsum(vocabularies.b_len[b])
    both, any_end = np.intersect1d(a_end, b_end, assume_unique=True), np.union1d(a_end, b_end)
    # Between two ends that follow each other lie bytes of one token of each, and of no other link of these two.
    a_link, b_link = a[np.searchsorted(a_end, any_end)], b[np.searchsorted(b_end, any_end)]
    group = np.searchsorted(both, any_end)
    links_of_group = np.bincount(group, minlength=len(both))
    regular = (links_of_group[group] == 1) & (vocabularies.same[a_link] == b_link)

    a_cut, b_cut = (np.searchsorted(ends, both, side="right").tolist() for ends in (a_end, b_end))
    a_text, b_text = list(map(str, a.tolist())), list(map(str, b.tolist()))
    texts = [a_text[p] + "|" + b_text[x] if q - p == y - x == 1 else ",".join(a_text[p:q]) + "|" + ",".join(b_text[x:y])
             for p, q, x, y in zip([0, *a_cut], a_cut, [0, *b_cut], b_cut)]
    n_groups = by_word(both)
    ends = np.cumsum(n_groups).tolist()
    groups = [";".join(texts[x:y]).encode() for x, y in zip([0, *ends], ends)]
    return Words(valid, by_word(a_end), by_word(b_end), n_groups, by_word(any_end), groups, (a_link << B_SHIFT) | b_link, regular)


def align_in_chunks(words: list[str], vocabularies: Vocabularies, chunk: int) -> Words:
    """The same for any number of words; what is needed on the way is held for one chunk at a time."""
    parts = [align_words(words[i:i + chunk], vocabularies) for i in range(0, max(len(words), 1), chunk)]
    return Words(*[
        [g for p in parts for g in p.groups] if f.name == "groups" else np.concatenate([getattr(p, f.name) for p in parts])
        for f in fields(Words)])


DOC = [("doc_id", pa.int64()), *[(c, pa.int64()) for c in ("n_a", "n_b", "n_groups", "n_links")],
       ("groups_sha256", pa.string()), ("groups", pa.string())]
DOC_TYPE = pa.struct(DOC)
# Number arrays travel as bytes, a stretch of each in every piece of a block: words of the documents and how many each has, links (an id of A if regular, else the size
# of A's vocabulary and the place in `pairs`) and how many each word has, pairs and regular ids with their counts.
ARRAYS = {"words": "<u4", "n_words": "<u4", "links": "<u4", "n_links": "<u4", "pairs": "<i8", "pair_counts": "<i8",
          "regular": "<u4", "regular_counts": "<i8"}
PIECE = pa.schema([("block", pa.int64()), ("piece", pa.int64()), ("docs", pa.list_(DOC_TYPE)),
                   *[(name, pa.binary()) for name in ARRAYS]])
PIECE_DDL = ("block long, piece long, docs array<struct<doc_id long, n_a long, n_b long, n_groups long, n_links long, "
             "groups_sha256 string, groups string>>, " + ", ".join(f"{name} binary" for name in ARRAYS))


def sums_by(lengths: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Sums of consecutive stretches of the given lengths, which may be 0."""
    ends = np.cumsum(lengths)
    upto = np.concatenate([[0], np.cumsum(values)])
    return upto[ends] - upto[ends - lengths]


def code_block(block: int, keys: list, texts: list[str], vocabularies: Vocabularies, rules: AlignRules,
               keep_groups: bool) -> Iterator[pa.RecordBatch]:
    """The documents of a block, their words and links, and its counts, a row for each piece."""
    index: dict[str, int] = {}
    placed = [np.array([index.setdefault(w, len(index)) for w in vocabularies.words(t)] if t else [], dtype=np.int64)
              for t in texts]
    found = align_in_chunks(list(index), vocabularies, rules.chunk_words)
    placed = [ids if found.valid[ids].all() else ids[:0] for ids in placed]
    n_words = np.array(list(map(len, placed)), dtype=np.int64)
    words = np.concatenate(placed)

    figures = {c: sums_by(n_words, getattr(found, c)[words]) for c in ("n_a", "n_b", "n_groups", "n_links")}
    digests, shown = [], []
    for ids in placed:
        joined = b";".join(map(found.groups.__getitem__, ids.tolist()))
        digests.append(hashlib.sha256(joined).hexdigest() if joined else "")
        shown.append(joined.decode() if keep_groups else None)
    columns = [keys, *figures.values(), digests, shown]
    docs = pa.StructArray.from_arrays([pa.array(c, type=kind) for c, (_, kind) in zip(columns, DOC)], fields=list(DOC_TYPE))

    times = np.repeat(np.bincount(words, minlength=len(index)), found.n_links)
    irregular = ~found.regular
    pairs, at = np.unique(found.keys[irregular], return_inverse=True)
    links = found.keys >> B_SHIFT
    links[irregular] = len(vocabularies.a) + at
    pair_counts = np.bincount(at, weights=times[irregular], minlength=len(pairs))
    vector = np.bincount(links[found.regular], weights=times[found.regular], minlength=len(vocabularies.a))
    regular = np.flatnonzero(vector)
    arrays = {"words": words, "n_words": n_words, "links": links, "n_links": found.n_links, "pairs": pairs,
              "pair_counts": pair_counts, "regular": regular, "regular_counts": vector[regular]}
    arrays = {name: arrays[name].astype(kind) for name, kind in ARRAYS.items()}
    n, m = rules.piece_numbers, rules.piece_docs
    for piece in range(max(-(-len(docs) // m), *[-(-len(values) // n) for values in arrays.values()])):
        few = docs[piece * m:(piece + 1) * m]
        stretches_of = [values[piece * n:(piece + 1) * n].tobytes() for values in arrays.values()]
        yield pa.RecordBatch.from_arrays(
            [pa.array([block]), pa.array([piece]), pa.ListArray.from_arrays(pa.array([0, len(few)], pa.int32()), few),
             *[pa.array([values], pa.binary()) for values in stretches_of]], schema=PIECE)


def code(docs: DataFrame, rules: AlignRules = AlignRules(), text: str = "text", key: str = "doc_id",
         keep_groups: bool = False) -> DataFrame:
    """Blocks of documents, in pieces."""
    small_batches(docs.sparkSession)

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabularies, number = Vocabularies(rules), TaskContext.get().partitionId() << 32
        keys, texts, size = [], [], 0
        for batch in batches:
            for key_value, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                keys.append(key_value)
                texts.append(value or "")
                size += len(value or "")
                if size >= rules.block_bytes or len(keys) >= rules.block_rows:
                    yield from code_block(number, keys, texts, vocabularies, rules, keep_groups)
                    keys, texts, size, number = [], [], 0, number + 1
                    pa.default_memory_pool().release_unused()
        if keys:
            yield from code_block(number, keys, texts, vocabularies, rules, keep_groups)

    columns = [F.col(f"`{key}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text")]
    return docs.select(*columns).mapInArrow(blocks, PIECE_DDL)


def _numbers(block: dict, name: str) -> np.ndarray:
    return np.frombuffer(block[name], dtype=ARRAYS[name]).astype(np.int64)


def _whole(pieces: pa.Table) -> dict:
    """The documents and the arrays of a block out of its pieces."""
    order = np.argsort(pieces["piece"].to_numpy())
    lists = pieces["docs"].combine_chunks()
    docs = pa.concat_arrays([lists[i].values for i in order.tolist()])
    arrays = {name: pieces[name].to_pylist() for name in ARRAYS}
    return {"docs": docs, **{name: b"".join(map(values.__getitem__, order.tolist())) for name, values in arrays.items()}}


def _counts(coded: DataFrame, ids: str, counts: str, name: str) -> DataFrame:
    """block, name, n: the counts of every block, one row each; a piece has as many ids as counts."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                found = _numbers(row, ids)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(found), row["block"])), pa.array(found), pa.array(_numbers(row, counts))],
                    names=["block", name, "n"])

    return coded.select("block", ids, counts).mapInArrow(rows, f"block long, {name} long, n long")


def _identity(spark: SparkSession, rules: AlignRules) -> tuple[np.ndarray, DataFrame]:
    """The identity map, and as rows a, pair; as long as A's vocabulary."""
    same = Vocabularies(rules).same
    rows = [(a, (a << B_SHIFT) | b) for a, b in enumerate(same.tolist()) if b >= 0]
    return same, spark.createDataFrame(rows, "a long, pair long")


def _totals(coded: DataFrame, identity: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(block, pair, total of every irregular pair of a block), (pair, n of every regular pair, irregular links not in it)."""
    regular = _counts(coded, "regular", "regular_counts", "a").groupBy("a").agg(F.sum("n").alias("n"))
    regular = materialize(regular.join(F.broadcast(identity), "a").select("pair", "n"), "regular-pairs")
    irregular = _counts(coded, "pairs", "pair_counts", "pair")
    summed = irregular.withColumn("links", F.sum("n").over(Window.partitionBy("pair"))).select("block", "pair", "links")
    known = F.broadcast(regular.withColumnRenamed("n", "n_regular"))  # at most as many rows as A has ids
    total = F.col("links") + F.coalesce("n_regular", F.lit(0))
    return summed.join(known, "pair", "left").select("block", "pair", total.alias("total")), regular


def pair_counts(docs: DataFrame, rules: AlignRules = AlignRules(), text: str = "text", key: str = "doc_id") -> DataFrame:
    """a, b, count of every id pair that is linked somewhere."""
    coded = materialize(code(docs, rules, text, key), "coded")
    totals, regular = _totals(coded, _identity(docs.sparkSession, rules)[1])
    both = totals.select("pair", "total").unionByName(regular.withColumnRenamed("n", "total"))
    # An irregular row already has the regular links of its pair, a regular one may lack the irregular ones.
    counted = both.groupBy("pair").agg(F.max("total").alias("count"))
    return counted.select(F.shiftright("pair", B_SHIFT).alias("a"), F.col("pair").bitwiseAND((1 << B_SHIFT) - 1).alias("b"),
                          "count")


def align(docs: DataFrame, rules: AlignRules = AlignRules(), text: str = "text", key: str = "doc_id",
          keep_groups: bool = False) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of every row; with keep_groups also groups,
    its ids as a1,a2|b1;a3|b2."""
    spark = docs.sparkSession
    same, identity = _identity(spark, rules)
    coded = materialize(code(docs, rules, text, key, keep_groups), "coded")
    totals, regular = _totals(coded, identity)
    totals = materialize(totals, "pair-totals")

    # Both have at most one entry per id of a vocabulary.
    b_of = F.col("pair").bitwiseAND((1 << B_SHIFT) - 1).alias("b")
    either = totals.select(b_of, "total").unionByName(regular.select(b_of, F.col("n").alias("total")))
    most = {r["b"]: r["most"] for r in either.groupBy("b").agg(F.max("total").alias("most")).collect()}
    found = {r["pair"]: r["n"] for r in regular.collect()}
    mixed = totals.join(F.broadcast(identity.select("pair")), "pair", "left_semi").groupBy("pair").agg(F.max("total").alias("n"))
    found.update({r["pair"]: r["n"] for r in mixed.collect()})
    regular_total = np.zeros(len(same), dtype=np.int64)
    for pair, n in found.items():
        regular_total[pair >> B_SHIFT] = n
    highest = np.zeros(max([*most, *same.tolist(), 0]) + 1, dtype=np.int64)
    highest[list(most)] = list(most.values())
    vectors = spark.sparkContext.broadcast((same, regular_total, highest))
    schema = pa.schema([*DOC[:5], ("n_best", pa.int64()), ("count_sum", pa.int64()), *DOC[5:]])

    def finish(blocks: pa.Table, replies: pa.Table) -> pa.Table:
        same, regular_total, highest = vectors.value
        whole = _whole(blocks)
        pairs, links = _numbers(whole, "pairs"), _numbers(whole, "links")
        order = np.argsort(replies["pair"].to_numpy())
        counts = np.concatenate([regular_total, replies["total"].to_numpy()[order]])[links]
        b = np.concatenate([same, pairs & ((1 << B_SHIFT) - 1)])[links]
        by_word = [sums_by(_numbers(whole, "n_links"), v) for v in (counts == highest[b], counts)]
        n_words, words = _numbers(whole, "n_words"), _numbers(whole, "words")
        sums = [pa.array(sums_by(n_words, w[words]), pa.int64()) for w in by_word]
        told = [whole["docs"].field(name) for name, _ in DOC]
        return pa.Table.from_arrays([*told[:5], *sums, *told[5:]], schema=schema)

    ddl = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, "
           "groups_sha256 string, groups string")
    aligned = coded.groupBy("block").cogroup(totals.groupBy("block")).applyInArrow(finish, ddl)
    return aligned if keep_groups else aligned.drop("groups")
