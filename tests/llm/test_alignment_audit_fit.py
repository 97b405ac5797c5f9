"""Token alignment, filter audit and best-fit packing: against brute force, and on nulls, empty and repeated rows, ties, long
texts, empty tables and other columns with the names that the operators derive."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from itertools import permutations

import pytest
from pyspark.sql import functions as F

from wattloom.llm import alignment, best_fit, filter_audit, tokens

CLASH = ["key", "task", "rank", "piece", "block", "docs", "words", "pair", "mask", "n", "good", "toxic", "sum", "fresh", "part",
         "step", "length", "before", "sequence_id", "offset", "labels", "groups"]
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def frame(spark, rows):
    return spark.createDataFrame(rows, DOCS).withColumns({c: F.lit(f"x-{c}") for c in CLASH})


def prose(n: int, seed: int) -> str:
    r = random.Random(seed)
    return " ".join("".join(r.choice(["ka", "lo", "é", "ß", "the", "ing", "Zu", "ö"]) for _ in range(r.randint(1, 4))) for _ in range(n))


ODD_TEXTS = [
    None, "", " ", "  two  blanks ", " lead", "trail ", "tab\there", "line\nend\n", "a▁b", " hard space 　wide", "aaaaaaa aaaaaaaaaaa",
    "naïve café", "é combining", "emoji 👩‍👩‍👧 end", "<s> </s> <unk> <0x41> <|endoftext|> x<|endoftext|>", "日本語 テキスト", "x",
    "A", "\x00\x01 zero", "don't we'll", "1234567890 3.14", "﻿mark", "a\r\nb", "word " * 300 + "end", "İ İ ı",
]


@pytest.fixture(scope="module")
def docs(spark):
    texts = [*ODD_TEXTS, *[prose(40 + i, i) for i in range(8)], prose(4000, 77), prose(50, 3), prose(50, 3)]
    rows = [(i if i % 11 else None, t, "en", f"s{i % 3}" if i % 4 else None, 1) for i, t in enumerate(texts, 1)]
    return frame(spark, [*rows, *rows[20:24]]).repartition(3).cache()


# alignment

def brute_alignment(texts):
    """Token by token and byte by byte, with the tokenizers' own libraries on whole texts."""
    import sentencepiece
    from tokenizers import Tokenizer

    a_model = Tokenizer.from_file(tokens.tokenizer_path())
    a_model.encode_special_tokens = True
    b_model = sentencepiece.SentencePieceProcessor(model_file=tokens.tokenizer_path("piece_bpe_32k.model"))
    to_byte = {c: b for b, c in zip(
        [*range(33, 127), *range(161, 173), *range(174, 256)],
        map(chr, [*range(33, 127), *range(161, 173), *range(174, 256)]))}
    rest = [b for b in range(256) if b not in to_byte.values()]
    to_byte.update({chr(256 + i): b for i, b in enumerate(rest)})

    def spans(pieces):
        ends, at = [], 0
        for piece in pieces:
            ends.append((at, at + len(piece)))
            at += len(piece)
        return ends

    each, pairs = [], Counter()
    for text in texts:
        row = None
        if text:
            a = a_model.encode(" " + text, add_special_tokens=False)
            a_bytes = [bytes(to_byte[c] for c in token) for token in a.tokens]
            b = b_model.encode(text)
            b_bytes = [bytes([int(m[1], 16)]) if (m := re.fullmatch("<0x(..)>", p)) and b_model.is_byte(i)
                       else p.replace("▁", " ").encode() for i, p in ((i, b_model.id_to_piece(i)) for i in b)]
            if b"".join(a_bytes) == b"".join(b_bytes) == (" " + text).encode():
                sa, sb = spans(a_bytes), spans(b_bytes)
                # Neighbouring tokens only: links of a token lie next to one another.
                links, j = [], 0
                for i, (x, y) in enumerate(sa):
                    while sb[j][1] <= x:
                        j += 1
                    k = j
                    while k < len(sb) and sb[k][0] < y:
                        links.append((a.ids[i], b[k]))
                        k += 1
                cuts = sorted({y for _, y in sa} & {y for _, y in sb})
                groups, start = [], 0
                for end in cuts:
                    groups.append(",".join(str(t) for t, (x, y) in zip(a.ids, sa) if start <= x < end) + "|"
                                  + ",".join(str(t) for t, (x, y) in zip(b, sb) if start <= x < end))
                    start = end
                row = (len(a.ids), len(b), links, groups)
                pairs.update(links)
        each.append(row)
    most = defaultdict(int)
    for (_, b), n in pairs.items():
        most[b] = max(most[b], n)
    out = []
    for row in each:
        if row is None:
            out.append((0, 0, 0, 0, 0, 0, "", ""))
        else:
            n_a, n_b, links, groups = row
            joined = ";".join(groups)
            out.append((n_a, n_b, len(groups), len(links), sum(pairs[p] == most[p[1]] for p in links),
                        sum(pairs[p] for p in links), hashlib.sha256(joined.encode()).hexdigest(), joined))
    return out, pairs


ALIGNED = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "groups"]


@pytest.mark.parametrize("block", [16_000_000, 500])
def test_alignment_equals_brute_force(docs, block):
    rows = docs.select("doc_id", "text").collect()
    expected, pairs = brute_alignment([r.text for r in rows])
    rules = alignment.AlignRules(block_bytes=block)
    found = alignment.align(docs, rules, keep_groups=True)
    assert sorted(map(tuple, found.select("doc_id", *ALIGNED).collect()), key=repr) == sorted(
        ((r.doc_id, *e) for r, e in zip(rows, expected)), key=repr)
    counted = {(r.a, r.b): r["count"] for r in alignment.pair_counts(docs, rules).collect()}
    assert counted == dict(pairs)


def test_blocks_travel_in_rows_of_bounded_size(spark, docs):
    words = [prose(40_000, 5), *[prose(3, i) for i in range(1_100)]]
    wide = frame(spark, [(i, t, "en", "", 1) for i, t in enumerate(words)]).coalesce(1)
    coded = alignment.code(wide)
    size = sum((F.length(name) for name in alignment.ARRAYS), F.lit(0))
    rows = coded.select("block", size.alias("bytes"), F.size("docs").alias("n"), F.length("words").alias("words")).collect()
    assert len({r.block for r in rows}) == 1 and max(r.words for r in rows) <= 4 * 32_768 < sum(r.words for r in rows)
    assert max(r.bytes for r in rows) < 2_000_000 and max(r.n for r in rows) <= 1_000 < sum(r.n for r in rows) == len(words)

    whole = alignment.align(docs, keep_groups=True)
    pieces = alignment.align(docs, alignment.AlignRules(piece_numbers=7, piece_docs=2), keep_groups=True)
    assert sorted(whole.collect(), key=repr) == sorted(pieces.collect(), key=repr)


def test_alignment_meets_odd_texts(docs):
    """The table has what the rules speak of: texts that a tokenizer does not give back, and groups of every shape."""
    expected, pairs = brute_alignment([r.text for r in docs.select("text").collect()])
    groups = {(g.split("|")[0].count(",") + 1, g.split("|")[1].count(",") + 1) for e in expected for g in e[-1].split(";") if g}
    assert {(1, 1), (1, 2), (2, 1), (2, 2)} <= groups
    assert sum(e[0] == 0 for e in expected) >= 3


def test_regular_links_also_count_in_irregular_groups(spark):
    """An id pair of the identity map that overlaps unaligned elsewhere has one count for both kinds of link."""
    texts = ["a" * n for n in range(1, 40)]
    found = alignment.align(frame(spark, [(i, t, "", "", 0) for i, t in enumerate(texts)]))
    expected, _ = brute_alignment(texts)
    assert [tuple(r)[1:] for r in found.orderBy("doc_id").select("doc_id", *ALIGNED[:-1]).collect()] == [e[:-1] for e in expected]


def test_identity_map_prefers_whole_pieces():
    same = alignment.identity_map([b"A", b"\xff", b"no"], [b"<s>", b"A", b"A", b"\xff"], [False, True, True, True],
                                  [True, False, True, False])
    assert same.tolist() == [2, 3, -1]


def test_alignment_of_an_empty_table(docs):
    assert alignment.align(docs.limit(0)).collect() == []
    assert alignment.pair_counts(docs.limit(0)).collect() == []
    nothing = alignment.align(docs.where("text is null or text = ''").limit(1)).collect()
    assert [tuple(r)[1:] for r in nothing] == [(0, 0, 0, 0, 0, 0, "")]


# filter audit

def brute_audit(rows, labels):
    words = re.compile(r"[^\x20\x09-\x0D]+")
    good = {k for k, q, _ in labels if q == 1 and k is not None}
    toxic = {k for k, _, t in labels if t == 1 and k is not None}
    cases = []
    for key, text, part in rows:
        text = text or ""
        w = words.findall(text)
        fails = {"A": len(w) < 50, "B": 100 * len(set(w)) < 65 * len(w),
                 "C": 100 * len(re.findall("[A-Z]", text)) > 5 * len(text), "D": bool(re.search(r"[#$%&*|]", text)),
                 "E": key is not None and any(k is not None and k < key and (t or "") == text for k, t, _ in rows)}
        cases.append((part or "", {f for f, v in fails.items() if v}, key in good, key in toxic))
    out, total = {}, Counter()
    for part in {c[0] for c in cases}:
        for order in permutations("ABCDE"):
            left = [c for c in cases if c[0] == part]
            for step, f in enumerate(order, 1):
                gone = [c for c in left if f in c[1]]
                before = [c for c in cases if c[0] == part and f in c[1]]
                left = [c for c in left if f not in c[1]]
                out[part, "".join(order), step] = (
                    len(left), len(gone), len(before) - len(gone), sum(c[1] == {f} for c in before),
                    sum(c[2] for c in gone), sum(c[3] for c in gone))
                total[part, f] += len(gone)
    return {(*k, *v, total[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def audit_rows(n: int):
    r = random.Random(5)
    plain = [" ".join(r.choice("abcdefgh") + str(r.randint(0, 40 + 30 * (i % 5))) for _ in range(35 + 5 * (i % 9))) for i in range(n)]
    texts = [t.upper() if i % 7 == 0 else t + " #" if i % 5 == 0 else t for i, t in enumerate(plain)]
    texts += [None, "", "", texts[0], texts[0], texts[1], None, "the " * 200, "WORD", "Ä É", *texts[3:9]]
    ids = [i if i % 13 else None for i in range(len(texts), 0, -1)]
    rows = [(k, t, "en", None if i % 6 == 0 else f"src{i % 3}", 1) for i, (k, t) in enumerate(zip(ids, texts))]
    return rows + rows[:4] + [(rows[5][0], "another text", "en", "src1", 1), (rows[6][0], rows[6][1], "en", "elsewhere", 1)]


def test_audit_equals_trying_every_order(spark):
    rows = audit_rows(60)
    labels = [(i, i % 2, int(i % 3 == 0)) for i in range(0, 80, 2)] + [(4, 1, 1), (6, None, None), (None, 1, 1), (8, 1, None)]
    names = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").withColumns({c: F.lit("x") for c in ("n", "good", "sum")})
    counted = filter_audit.masks(frame(spark, rows).repartition(4), names)
    found = filter_audit.audit(counted).collect()
    assert len(found) == len(set(map(tuple, found)))
    assert {tuple(r) for r in found} == brute_audit([(k, t, p) for k, t, _, p, _ in rows], labels)


def test_audit_without_labels_and_of_nothing(spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    some = filter_audit.audit(filter_audit.masks(frame(spark, audit_rows(8)), none))
    assert some.agg(F.sum("good_lost") + F.sum("toxic_lost")).first()[0] == 0
    assert filter_audit.audit(filter_audit.masks(frame(spark, audit_rows(8)).limit(0), none)).collect() == []
    one = filter_audit.audit(filter_audit.masks(frame(spark, [(1, "Clean text " + prose(60, 1), "", "s", 0)]), none))
    assert one.count() == 600 and one.agg(F.min("kept"), F.max("removed")).first()[:2] in [(1, 0), (0, 1)]


def test_intervals_cover_each_order_once():
    names = filter_audit.orders("ABCDE")
    assert names == sorted(names) and len(names) == 120
    for mask in range(1, 32):
        at = Counter()
        for m, step, low, high in filter_audit.intervals("ABCDE"):
            if m == mask:
                for rank in range(low, high):
                    at[rank] += 1
                    first = next(i for i, f in enumerate(names[rank], 1) if mask & filter_audit.bit("ABCDE", f))
                    assert first == step
        assert at == Counter(range(120))


# best fit

def one_by_one(lengths, capacity):
    """Best fit decreasing, a document at a time; the multiset of what is left in the sequences."""
    room = []
    for n in sorted(lengths, reverse=True):
        fitting = [i for i, free in enumerate(room) if free >= n]
        if fitting:
            room[min(fitting, key=room.__getitem__)] -= n
        else:
            room.append(capacity - n)
    return Counter(room)


@pytest.mark.parametrize("seed", range(30))
def test_plan_equals_placing_one_by_one(seed):
    r = random.Random(seed)
    capacity = r.choice([1, 7, 64, 100, 2048])
    lengths = [r.choice([r.randint(1, capacity), max(1, capacity // r.randint(1, 9)), 1]) for _ in range(r.randint(1, 400))]
    histogram = Counter(lengths)
    used, ranks = defaultdict(list), Counter()
    runs = best_fit.plan(dict(histogram), capacity)
    for i, (length, rank, first, per, offset) in enumerate(runs):
        end = next((x[1] for x in runs[i + 1:] if x[0] == length), histogram[length])
        assert rank == ranks[length] and end > rank
        for k in range(end - rank):
            used[first + k // per].append((offset + (k % per) * length, length))
        ranks[length] = end
    assert ranks == histogram and len(runs) <= 4 * capacity * max(1, capacity.bit_length())
    for held in used.values():
        held.sort()
        assert [x for x, _ in held] == [sum(n for _, n in held[:i]) for i in range(len(held))]
    assert Counter(capacity - sum(n for _, n in held) for held in used.values()) == one_by_one(lengths, capacity)


def test_tightest_open_sequence():
    open_ones = best_fit.OpenSequences(10)
    assert open_ones.tightest(1) is None
    for room in (3, 7, 10):
        open_ones.add(room, room, 1)
    assert [open_ones.tightest(n) for n in range(1, 11)] == [3, 3, 3, 7, 7, 7, 7, 10, 10, 10]
    assert open_ones.take(7) == (7, 1) and open_ones.tightest(4) == 10 and open_ones.tightest(2) == 3


@pytest.mark.parametrize("capacity", [2048, 50])
def test_best_fit_is_an_exact_round_trip(docs, capacity):
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(tokens.tokenizer_path())
    whole = [(r.doc_id, [*model.encode(r.text or "", add_special_tokens=False).ids, 0])
             for r in docs.select("doc_id", "text").collect()]
    rows = best_fit.pack(docs, best_fit.FitRules(capacity=capacity), keep_ids=True).collect()
    sequences, pieces, lengths = defaultdict(list), Counter(), []
    for r in rows:
        assert len(r.ids) == 4 * r.length and zlib.crc32(r.ids) == r.ids_crc32
        ids = tuple(int.from_bytes(r.ids[i:i + 4], "little") for i in range(0, len(r.ids), 4))
        pieces[r.key, r.piece, r.start, ids] += 1
        sequences[r.sequence_id].append((r.offset, r.length))
    expected = Counter()
    for key, ids in whole:
        over = len(ids) % capacity
        cuts = ([0, over] if over else [0]) + list(range(over + capacity, len(ids) + 1, capacity))
        for piece, (x, y) in enumerate(zip(cuts, cuts[1:])):
            expected[key, piece, x, tuple(ids[x:y])] += 1
            lengths.append(y - x)
    assert pieces == expected
    for held in sequences.values():
        held.sort()
        assert [x for x, _ in held] == [sum(n for _, n in held[:i]) for i in range(len(held))]
    assert Counter(capacity - sum(n for _, n in held) for held in sequences.values()) == one_by_one(lengths, capacity)


def test_best_fit_of_an_empty_table_and_of_empty_texts(docs):
    assert best_fit.pack(docs.limit(0)).collect() == []
    blank = docs.where("text is null or text = ''").collect()
    rows = best_fit.pack(docs.where("text is null or text = ''")).collect()
    assert len(rows) == len(blank) and {(r.piece, r.start, r.length) for r in rows} == {(0, 0, 1)}
    assert sorted(r.offset for r in rows) == list(range(len(rows)))
