"""The training-data operators on small tables: against brute force, and on nulls, empty and repeated rows."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
import xxhash
import zstandard
from pyspark.sql import functions as F

import corpus_pipeline
from wattloom.llm import (
    html_text, jaccard, lengths, maxscore, mixing, packing, pii, quality, sharding, suffix_tree, tokens)

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
VOCABULARY = "the of and to in is that for it was as with be on not by this are at from".split()
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def prose(n: int, seed: int) -> str:
    r = random.Random(seed)
    return " ".join(r.choice(VOCABULARY) if r.random() < 0.4 else "".join(r.choice("aeinorst") for _ in range(6)) for _ in range(n))


@pytest.fixture(scope="module")
def docs(spark):
    """Null and empty texts, null ids, languages and sources, repeated rows, near copies, one long text, other columns
    with the names that operators derive."""
    base = [prose(60 + 7 * i, i) for i in range(12)]
    near = [base[0] + " tail", "Head " + base[0], base[0].upper()]
    texts = [None, "", "  \n ", "one two", "one two", *base, base[3], *near, prose(6000, 99), "a b c d e f " * 40,
             "mail jane at example dot com or +1 (555) 010-2345, card 4111 1111 1111 1111"]
    rows = [(i if i % 9 else None, t, "en" if i % 4 else None, f"s{i % 3}" if i % 5 else None, len(t or ""))
            for i, t in enumerate(texts, 1)]
    rows += rows[6:8]
    frame = spark.createDataFrame(rows, DOCS)
    clash = ["row", "kept", "n_words", "size", "key", "_text", "set_id", "ids", "piece", "target", "class", "uid"]
    return frame.withColumns({c: F.lit(f"x-{c}") for c in clash}).cache()


@pytest.fixture(scope="module")
def empty(docs):
    return docs.limit(0)


def listed(df, *columns):
    return sorted(map(tuple, df.select(*columns).collect()), key=repr)


# maximum inner product

def test_top_k_equals_brute_force_with_ties_and_odd_vectors(spark):
    r = random.Random(1)
    rows = [(i, [round(r.uniform(-1, 1), 2) for _ in range(9)]) for i in range(300)]
    rows += [(300 + i, v) for i, (_, v) in enumerate(rows[:40])]
    rows += [(1000, None), (1001, [1.0, None]), (1002, [float("nan")] * 9), (1003, [float("inf")] * 9), (None, [1.0] * 9),
             (1050, []), (1100, [0.5] * 4), (7, rows[7][1])]
    found = maxscore.search(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), F.col("vec_id") % 50 == 0,
                            maxscore.SearchRules(shard_rows=64, query_rows=3))
    import numpy as np
    usable = {i: [math.floor(256 * float(np.float32(x))) for x in v] for i, v in rows
              if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)}
    expected = []
    for q in (i for i in usable if i % 50 == 0):
        scores = sorted((-sum(a * b for a, b in zip(usable[q], v)), i) for i, v in usable.items() if i != q)[:5]
        expected += [(q, k, i, -s) for k, (s, i) in enumerate(scores, 1)]
    assert listed(found, "query_id", "rank", "vec_id", "score") == sorted(expected, key=repr)


def test_postings_and_bounds_leave_vectors_out():
    import numpy as np

    rng = np.random.default_rng(3)
    vectors = np.where(rng.random((2000, 64)) < 0.08, np.floor(rng.pareto(1.5, (2000, 64)) * 20), 0.0)
    vectors *= rng.choice([-1, 1], vectors.shape)
    rules = maxscore.SearchRules()
    shard = maxscore.Shard(np.arange(2000), vectors)
    assert all((np.sign(values) == sign).all() and (vectors[at, t] == values).all() for (t, sign), (at, values) in shard.postings.items())
    scored = 0
    for own in range(0, 2000, 50):
        best, n = shard.best(vectors[own], own, rules)
        scores = vectors @ vectors[own]
        assert best == [(int(scores[i]), i) for i in sorted(set(range(2000)) - {own}, key=lambda i: (-scores[i], i))[:rules.k]]
        scored += n
    assert scored < 0.2 * 40 * 2000


def test_every_row_of_a_repeated_id_is_a_candidate_and_a_query(spark):
    rows = [(0, [1.0, 0.0]), (1, [3.0, 1.0]), (1, [3.0, 1.0]), (1, [2.0, 0.0]), (2, [1.0, 5.0]), (50, [0.0, 1.0]), (50, [1.0, 1.0])]
    for factor in (1.0, 2.0**19):  # the second is beyond what doubles add up exactly
        scaled = [(i, [x * factor for x in v]) for i, v in rows]
        found = maxscore.search(spark.createDataFrame(scaled, "vec_id long, embedding array<double>"), F.col("vec_id") % 50 == 0,
                                maxscore.SearchRules(shard_rows=2, query_rows=1))
        ints = [(i, [math.floor(256 * x) for x in v]) for i, v in scaled]
        expected = []
        for own, (q, query) in enumerate(ints):
            others = [(-sum(a * b for a, b in zip(query, v)), i) for row, (i, v) in enumerate(ints) if row != own]
            expected += [(q, k, i, -s) for k, (s, i) in enumerate(sorted(others)[:5], 1) if q % 50 == 0]
        assert listed(found, "query_id", "rank", "vec_id", "score") == sorted(expected, key=repr)


def test_top_k_of_few_and_huge_vectors(spark):
    rows = [(0, [3e30, 1.0]), (1, [2e30, 5.0]), (2, [-1.0, 0.5])]
    found = listed(maxscore.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>"),
                                   F.col("vec_id") == 0), "query_id", "rank", "vec_id", "score")
    assert [(q, k, i) for q, k, i, _ in found] == [(0, 1, 1), (0, 2, 2)] and found[0][3] == 2**63 - 1
    none = spark.createDataFrame([], "vec_id long, embedding array<double>")
    assert maxscore.search(none, F.col("vec_id") == 0).count() == 0


# main text

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p>";</script></head><body>
<header><a href=/>Home</a></header><nav><ul><li><a href=a>One</a><li><a href=b>Two</a></ul></nav>
<div class="cookie-notice"><p>We use cookies, please agree to all of them today.</p></div>
<div id="wrap"><div class="sidebar"><p>Popular: <a href=x>link one</a></p></div>
<div class="content"><h1>A &amp; B</h1><p>First  paragraph with a <a href=y>link</a>,
and words.<p>Second&nbsp;one.<ul><li>Item</li></ul><form><label>Name</label><input></form></div></div>
<div id="comments"><p>Great text, a long comment by a reader that goes on and on and on and on and on.</p></div>
<footer>&copy; 2024</footer></body></html>"""


def test_main_text_of_pages(spark):
    long = "<p>" + "word " * 50_000 + "</p>"
    rows = [(1, "u", PAGE), (2, None, None), (3, "u", ""), (4, "u", "<html><body><script>x</script></body>"), (4, "u", "plain"),
            (None, "u", "<p>1 &lt; 2 < 3<br>next"), (5, "u", long), (6, "u", "<div>" * 5000 + "deep")]
    found = {(r.page_id, r.n_chars): r.text for r in html_text.extract(
        spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    texts = set(found.values())
    assert "A & B\nFirst paragraph with a link, and words.\nSecond one.\nItem" in texts
    assert {"", "plain", "1 < 2 < 3\nnext", "deep", ("word " * 50_000).strip()} <= texts
    assert all(n == len(t) for (_, n), t in found.items())


def paragraphs(n: int, seed: int) -> str:
    return "".join(f"<p>{prose(40 + 7 * i, seed + i)}</p>" for i in range(n))


@pytest.mark.parametrize("page", [
    "<nav><a href=x>menu</a></nav><div class='with-sidebar content'>{}</div>", "<div class='page no-sidebar'><article>{}</article></div>",
    "<form action=x><label>Name</label><input><select><option>a</select><div>{}</div><button>go</button></form>",
    "<div class='menu-open layout'><article>{}</article></div><div class='menu'>one two</div>",
    "<div class='sidebar'><p>short text</p></div><div>{}</div><div class='site-footer'><p>all rights</p></div>",
    "<article>{}</article><div id='comments'><article class='comment'><p>a reader wrote this</p></article></div>",
    "<header class='site-header'>Name</header><main>{}</main><aside>more</aside>"])
def test_layout_names_do_not_take_the_article_away(page):
    inside = paragraphs(5, 3)
    assert html_text.main_text(f"<html><body>{page.format(inside)}</body></html>") == inside[3:-4].replace("</p><p>", "\n")


def test_articles_side_by_side_and_formulas_stay():
    text = html_text.main_text(f"<body><article>{paragraphs(6, 1)}</article><article>{paragraphs(2, 9)}</article></body>")
    assert text.count("\n") == 7
    formula = "<p>so <math><mi>x</mi><mo>=</mo><mn>1</mn></math> holds</p>"
    assert html_text.main_text(f"<body><article>{paragraphs(3, 1)}{formula}</article></body>").endswith("\nso x=1 holds")


def test_content_is_the_node_of_the_largest_density_sum():
    """Densities by another parser and by recursion, over random well-formed pages without names."""
    from html.parser import HTMLParser

    class Tree(HTMLParser):
        def __init__(self):
            super().__init__()
            self.at = self.root = {"tag": "", "inside": [], "up": None}

        def handle_starttag(self, tag, attrs):
            new = {"tag": tag, "inside": [], "up": self.at}
            self.at["inside"].append(new)
            self.at = new

        def handle_endtag(self, tag):
            self.at = self.at["up"]

        def handle_data(self, data):
            self.at["inside"].append(data)

    def measured(node, link):
        """Characters, link characters and tags below; the density sums of all nodes, in page order."""
        chars = links = tags = 0
        total, own, sums = 0.0, 0, []
        for child in node["inside"]:
            if isinstance(child, str):
                own += len("".join(child.split()))
            else:
                c, k, t, inner = measured(child, child["tag"] == "a")
                chars, links, tags = chars + c, links + (c if child["tag"] == "a" else k), tags + t + 1
                total += (c - k) / max(t, 1)
                sums += inner
        return chars + own, links + (own if link else 0), tags, [(total + (0 if link else own), node), *sums]

    r = random.Random(11)

    def page(depth: int) -> str:
        if depth == 0 or r.random() < 0.3:
            return r.choice([f"<p>{prose(r.randint(1, 60), r.randint(0, 99))}</p>", "<ul><li><a>one two</a></li><li><a>three</a></li></ul>"])
        return "<div>" + "".join(page(depth - 1) for _ in range(r.randint(1, 4))) + "</div>"

    def place(node, up, inside) -> list[int]:
        steps = []
        while up(node) is not None:
            steps.append([i for i, c in enumerate(x for x in inside(up(node)) if not isinstance(x, str)) if c is node][0])
            node = up(node)
        return steps

    for _ in range(200):
        source = f"<body>{page(4)}</body>"
        tree = Tree()
        tree.feed(source)
        sums = measured(tree.root, False)[3]
        ours = html_text.parse(source)
        html_text._measure(ours)
        best = html_text._densest(ours)
        assert best.total == pytest.approx(max(s for s, _ in sums))
        at = place(best, lambda n: n.parent, lambda n: n.children)
        assert any(place(n, lambda n: n["up"], lambda n: n["inside"]) == at for s, n in sums if s == pytest.approx(best.total))


def test_no_pages_give_no_rows(spark):
    none = spark.createDataFrame([], "page_id long, url string, html string, text string, n_chars long")
    assert html_text.extract(none).collect() == [] and html_text.extract(none).columns == ["page_id", "url", "text", "n_chars"]


# shards

def test_table_is_even_stable_and_placed(docs, empty):
    names = [f"s{i}" for i in range(10)]
    table = sharding.lookup_table(names, 1009)
    assert max(Counter(table).values()) - min(Counter(table).values()) <= 1
    fewer = sharding.lookup_table(names[:-1], 1009)
    moved = sum(names[a] != names[b] for a, b in zip(table, fewer) if a != 9)
    assert moved < 0.25 * 1009
    placed = sharding.place(docs, "doc_id", names, 1009).select("row.doc_id", "slot", "shard").collect()
    assert len(placed) == docs.count() and all(r.shard == names[table[r.slot]] for r in placed)
    assert all(r.slot == sharding._hash("" if r.doc_id is None else str(r.doc_id)) % 1009 for r in placed)
    assert sharding.place(empty, "doc_id", names, 1009).count() == 0
    with pytest.raises(ValueError):
        sharding.lookup_table([])


# quality

def counted(text: str) -> tuple:
    words = WORDS.findall(text)
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    times = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if times[w] > 1 for k in range(3)}
    lines = [line for line in text.split("\n") if WORDS.search(line)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))


def test_quality_counts_and_verdicts(docs, empty):
    for r in quality.judge(docs).select("row.text", "*").collect():
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == counted(r.text or "")
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
    assert quality.quality_filter(docs).columns == docs.columns and quality.quality_filter(empty).count() == 0


def test_quality_tells_prose_from_symbols_and_capitals(spark):
    good = "The old house on the hill was not as big as it is in the picture that he had from the town. " * 1
    good = " ".join(good.replace("house", f"house{chr(97 + i)}") for i in range(8))
    bad = [" ".join(f"{w}###" for w in good.split()), " ".join(w.upper() + "!!" for w in good.split()), " | ".join(good.split())]
    rules = quality.QualityRules(max_repeat_percent=100)
    kept = [r.kept for r in quality.judge(spark.createDataFrame([(t,) for t in (good, *bad)], "text string"), rules).collect()]
    assert kept == [True, False, False, False]


# Plain running text in the four languages, written for this test.
PROSE = [
    "The bus was late again, so we walked along the river and talked about the garden that my sister wants to plant in the "
    "spring. It is a small place with a wall on one side, and there is not much light in the morning. She thinks that beans "
    "and peas will do well in it. I said that the soil is poor, but she has a plan for this as well, and she is rarely wrong.",
    "Der Bus kam wieder zu spät, und wir gingen am Fluss entlang und sprachen über den Garten, den meine Schwester im Frühling "
    "anlegen will. Es ist ein kleiner Platz mit einer Mauer auf der einen Seite, und am Morgen gibt es dort nicht viel Licht. "
    "Sie meint, dass die Bohnen und die Erbsen sich in dem Boden wohl fühlen, auch wenn er nicht gut ist.",
    "Le bus est encore arrivé en retard, et nous avons suivi la rivière en parlant du jardin que ma soeur veut faire dans le "
    "quartier au printemps. C'est un petit terrain avec un mur sur le côté, et il ne reçoit pas beaucoup de lumière le matin. "
    "Elle pense que les haricots et les pois sont faits pour cette terre, qui est pauvre mais facile à travailler.",
    "El autobús llegó tarde otra vez, y caminamos a lo largo del río y hablamos del jardín que mi hermana quiere plantar en la "
    "primavera. Es un lugar pequeño con una pared en un lado, y no hay mucha luz por la mañana. Ella piensa que las judías y "
    "los guisantes se dan bien en la tierra de ese sitio, que es pobre para otras plantas como el maíz.",
]


def test_quality_tells_prose_from_words_that_are_no_language(spark):
    r = random.Random(5)
    made_up = " ".join("".join(r.choice("bdfgklmnprstv") + r.choice("aeiou") for _ in range(r.randint(1, 4))) for _ in range(120))
    made_up = re.sub(r"((?:\w+ ){9}\w+) ", lambda m: m[1].capitalize() + ". ", made_up)
    keywords = ", ".join(f"{a} {b}" for a in "cheap best buy online discount".split() for b in
                         "shoes watches phones laptops cameras flights hotels cars bikes tyres".split())
    names = ". ".join(f"Ms {a.title()} {b.title()}" for a in "ana bob cleo dan eve fay".split() for b in
                      "smith jones miller brown clark lewis".split())
    judged = quality.judge(spark.createDataFrame([(t,) for t in (*PROSE, made_up, keywords, names)], "text string")).collect()
    assert [j.base_failed for j in judged] == [False] * 7
    assert [j.kept for j in judged] == [True] * 4 + [False] * 3
    assert max(j.word_distance for j in judged[:4]) < 0.8 and min(j.word_distance for j in judged[4:]) > 0.95


# token counts

def test_encoder_gives_the_tokenizers_ids():
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokens.tokenizer_path())
    tokenizer.encode_special_tokens = True
    encoder = tokens.Encoder(tokens.tokenizer_path(), remembered=50)
    r = random.Random(5)
    parts = ["a", "word", "'s", "'", " ", "  ", "\n", "\t", "12", "!", "é", "<|endoftext|>", "\x1c", "　", "\x85", "\r\n", "ß."]
    texts = ["".join(r.choice(parts) for _ in range(r.randint(0, 30))) for _ in range(3000)] + [prose(300, i) for i in range(5)]
    for start in range(0, len(texts), 100):
        some = texts[start:start + 100]
        for text, ids in zip(some, encoder.encode(some)):
            expected = tokenizer.encode(text, add_special_tokens=False).ids
            assert b"".join(i.to_bytes(4, "little") for i in expected) == ids, repr(text)


def test_operators_give_added_tokens_their_ids(spark):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokens.tokenizer_path())
    encoder = tokens.Encoder(tokens.tokenizer_path(), remembered=50, encode_special_tokens=False)
    r = random.Random(6)
    parts = ["a", "word", "'s", " ", "  ", "\n", "12", "é", "<|endoftext|>", "<|endoftext", "|>", "　"]
    texts = ["a <|endoftext|> b", "<|endoftext|>", "<|endoftext|><|endoftext|>x", ""]
    texts += ["".join(r.choice(parts) for _ in range(r.randint(0, 30))) for _ in range(2000)]
    expected = [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    packed = [b"".join(i.to_bytes(4, "little") for i in ids) for ids in expected]
    assert expected[0] == [64, 220, 50256, 275] and encoder.encode(texts) == packed
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts[:4])], "doc_id long, text string")
    found = {x.length: x.n_docs for x in lengths.histogram(frame).collect()}
    assert found == Counter(map(len, expected[:4]))
    placed = packing.pack(frame, packing.PackRules(capacity=256), keep_ids=True).collect()
    assert {x.key: bytes(x.ids) for x in placed} == {i: ids + (1).to_bytes(4, "little") for i, ids in enumerate(packed[:4])}


def token_lists(docs) -> list[bytes]:
    return tokens.Encoder(tokens.tokenizer_path()).encode([r.text or "" for r in docs.select("text").collect()])


def test_length_totals_for_every_limit(docs, empty):
    sizes = [len(ids) // 4 for ids in token_lists(docs)]
    found = lengths.totals(lengths.histogram(docs)).collect()
    assert sorted(r.length for r in found) == sorted(set(sizes))
    for r in found:
        at_least = [s for s in sizes if s >= r.length]
        assert (r.n_docs, r.docs_at_least, r.tokens_at_least, r.truncated_tokens, r.all_docs, r.all_tokens) == (
            sizes.count(r.length), len(at_least), sum(at_least), sum(min(s, r.length) for s in sizes), len(sizes), sum(sizes))
        assert r.share_at_most == pytest.approx(sum(s <= r.length for s in sizes) / len(sizes))
    whole = lengths.totals(lengths.histogram(docs)).cache()
    for limit in (0, 1, 100, 10**6):
        assert lengths.truncated_total(whole, limit).first().tokens == sum(min(s, limit) for s in sizes)
    assert lengths.quantile(whole, 0.5).first().length == sorted(sizes)[math.ceil(len(sizes) / 2) - 1]
    assert lengths.totals(lengths.histogram(empty)).count() == 0


# personal data

PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def holds(kind: str, found: str) -> bool:
    digits = re.sub("[^0-9]", "", found)
    if kind == "ip":
        return all(int(p) <= 255 for p in found.split("."))
    if kind == "card":
        doubled = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
        return 13 <= len(digits) <= 19 and sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0
    return kind == "email" or 9 <= len(digits) <= 15


def test_plain_spans_equal_the_patterns():
    r = random.Random(3)
    parts = list("0123456789.@+- ()a-Z%_,") + ["192.168.1.1", "4111 1111 1111 1111", "+1 (555) 555-7713", "x@y.z", "  ", "٣", "é"]
    for _ in range(4000):
        text = "".join(r.choice(parts) for _ in range(r.randint(0, 40)))
        expected = {k: [m.span() for m in re.finditer(p, text) if holds(k, m[0])] for k, p in PATTERNS.items()}
        assert pii.plain_spans(text) == expected, text
        every = pii.all_spans(text)[1]
        assert all(set(expected[k]) <= set(every[k]) for k in expected)


HIDDEN = {
    "jane dot doe at mail dot example dot org": "email", "jane [at] example [dot] com": "email", "jane(at)example.com": "email",
    "jаne@exаmple.com": "email", "ｊａｎｅ＠ｅｘａｍｐｌｅ．ｃｏｍ": "email", "jane@example dot com": "email",
    "jane at example.com": "email", "jane.doe at example.com": "email", "jane dot doe at uni dot se": "email",
    "jane at uni dot it": "email", "jane @ mail.se": "email", "jane_7 at uni dot no": "email", "jane at uni dot xyz": "email",
    "192 dot 168 dot 1 dot 20": "ip", "one nine two dot one six eight dot zero dot one": "ip",
    "four one one one " + "one " * 11 + "one": "card", "４１１１ １１１１ １１１１ １１１１": "card", "4111​1111​1111​1111": "card",
    "plus one five five five zero one two three four five six": "phone", "＋１ (555) 010-2345": "phone",
}


@pytest.mark.parametrize("text", HIDDEN)
def test_disguised_spans_map_back_to_the_source(text):
    before = "Élan é: "
    plain, every = pii.all_spans(f"{before}{text} - end")
    assert {k: v for k, v in every.items() if v} == {HIDDEN[text]: [(len(before), len(before) + len(text))]}


@pytest.mark.parametrize("text", ["look at the dot product of at example.com", "meet me at noon", "one or two at home dot", "1.5 at 2",
                                  prose(400, 8), "he was at work. The dot is red", "four one two", "",
                                  "look at example.com for more", "Available at example.com", "the shop at example.com is closed",
                                  "email us at example.com", "he pointed at uni dot it was small", "dinner at eight.then home",
                                  "we met at noon. it was late", "arrive at 8.30 in the morning"])
def test_clean_texts_have_no_spans(text):
    assert not any(pii.all_spans(text)[1].values())


def test_a_word_nearby_speaks_for_an_address():
    for text in ("mail jane at example.com today", "you can reach jane at uni dot it if you like", "jane.doe at example.com is mine"):
        span = pii.all_spans(text)[1]["email"]
        assert len(span) == 1 and text[slice(*span[0])].startswith("jane")
    assert pii.masked("mail jane at example.com today") == "mail [EMAIL] today"


def test_digest_is_that_of_the_joined_plain_spans(spark):
    import hashlib

    texts = ["é mail jane@example.com or +1 (555) 010-2345, 10.0.0.1 and 4111 1111 1111 1111", "nothing", None, "a@b.c a@b.c"]
    found = {r.key: r for r in pii.find(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
             .selectExpr("*", "sha2(base_spans, 256) AS digest").collect()}
    for i, text in enumerate(texts):
        plain = {k: [m.span() for m in re.finditer(p, text or "") if holds(k, m[0])] for k, p in PATTERNS.items()}
        joined = ",".join(f"{k}:{a}:{b}" for k in ("email", "ip", "card", "phone") for a, b in plain[k])
        assert found[i].digest == hashlib.sha256(joined.encode()).hexdigest()
        assert found[i].spans == joined and found[i].n_email == len(plain["email"])


def test_pii_rows_and_redaction(docs, empty):
    found = pii.find(docs)
    assert found.count() == docs.count() and found.where("spans <> ''").count() == 1
    masked = pii.redact(docs)
    assert masked.columns == docs.columns and pii.redact(empty).count() == 0
    assert masked.where("text like 'mail %'").first().text == "mail [EMAIL] or [PHONE], card [CARD]"
    assert masked.where("text is null").count() == docs.where("text is null").count()


# near copies

def brute_components(rows):
    sets = []
    for _, text in rows:
        words = WORDS.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets.append({tuple(words[i:i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} if words else set())
    root = list(range(len(rows)))

    def find(i):
        return i if root[i] == i else find(root[i])

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 80 * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    members = defaultdict(list)
    for i, (key, _) in enumerate(rows):
        members[find(i)].append(key)
    lowest = {r: min((k for k in keys if k is not None), default=None) for r, keys in members.items()}
    return sorted(((k, len(sets[i]), None if k is None else lowest[find(i)] if sets[i] else k)
                   for i, (k, _) in enumerate(rows)), key=repr)


def mutated(text: str, changes: int, seed: int) -> str:
    r, words = random.Random(seed), text.split()
    for _ in range(changes):
        words[r.randrange(len(words))] = f"w{r.randrange(10**6)}"
    return " ".join(words)


def test_components_equal_brute_force(spark, docs, empty):
    assert jaccard.join(empty).count() == 0
    base = prose(300, 1)
    passage = prose(60, 2)
    texts = [mutated(base, i % 9, i) for i in range(60)] + [f"{prose(80 + i, 100 + i)} {passage}" for i in range(40)]
    texts += [passage, passage + " x", "a b c d", "A B C D", "a b c d e"]
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()] + [(1000 - i, t) for i, t in enumerate(texts)]
    for rules in (jaccard.JoinRules(), jaccard.JoinRules(block_tokens=3000, fragments=3, tokens_per_group=5000, tier=0.1)):
        found = jaccard.join(spark.createDataFrame(rows, "doc_id long, text string"), rules)
        assert listed(found, "doc_id", "n_shingles", "component_id") == brute_components(rows)


def test_a_joined_group_of_near_copies_leaves_no_pair_of_blocks_open(spark):
    rows = [("g%d" % g, f"s{i}", i % 7) for i in range(70) for g in range(5)]
    placed = spark.createDataFrame(rows, "gram string, set_id string, block long").cache()
    pairs = jaccard._pivot_pairs(placed)
    assert pairs.count() == 5 * (6 + 7) and {r.left for r in pairs.where("left != right").collect()} == {0}
    joined = spark.createDataFrame([(f"s{i}", "s0") for i in range(1, 70)], "node string, root string")
    assert jaccard._open_pairs(placed, joined).count() == 0
    # a set of its own in block 3: its block meets every other but the first, which it has met, and no others meet
    still = jaccard._open_pairs(placed, joined.where("node != 's3'"))
    assert {(r.left, r.right) for r in still.collect()} == {(min(b, 3), max(b, 3)) for b in (1, 2, 4, 5, 6)}


def test_links_that_the_first_round_leaves_out_are_found(spark):
    r = random.Random(5)
    base, tail = prose(200, 1).split(), [f"t{i}" for i in range(400)]
    rows = []
    for i in range(90):  # three families about one passage, each in several blocks, with members that link families
        words = list(base) + tail[:20 * (i % 4)]
        for _ in range(i % 6):
            words[r.randrange(len(words))] = f"w{r.randrange(10**6)}"
        rows.append((i, " ".join(words)))
    rules = jaccard.JoinRules(block_tokens=800, fragments=2, tokens_per_group=5000, tier=0.2)
    found = jaccard.join(spark.createDataFrame(rows, "doc_id long, text string"), rules)
    assert listed(found, "doc_id", "n_shingles", "component_id") == brute_components(rows)


def test_copies_of_a_text_reach_a_block_once(spark):
    rules = jaccard.JoinRules()
    texts = [prose(80, 7)] * 400 + [prose(80, 7).upper()] * 200 + [prose(90, 100 + i) for i in range(50)]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(16)
    found = jaccard._set_blocks(frame, 5, rules)
    sizes = [r.n for r in found.collect()]
    assert len(sizes) == found.select("set_id").distinct().count() == 51
    ids = "set_id binary, n long"
    grouped = found.groupBy("block").applyInArrow(lambda rows: rows.select(["set_id", "n"]), ids)
    assert grouped._jdf.queryExecution().executedPlan().toString().count("hashpartitioning") == 1
    assert sorted(r.n for r in grouped.collect()) == sorted(sizes)
    assert jaccard._prefixes(frame, 50_000, rules).count() == 0


# mixing

def test_mix_meets_targets_and_agrees_with_itself(spark, docs, empty):
    big = spark.createDataFrame([(i, prose(20 + i % 50, i), f"s{i % 4}" if i % 7 else None) for i in range(400)],
                                "doc_id long, text string, source string")
    took = mixing.take(big).cache()
    sizes = took.agg(F.sum("size").alias("n"), F.sum("taken").alias("taken")).first()
    per_source = took.groupBy("source_size", "target").agg(F.sum("taken").alias("taken")).collect()
    assert sum(r.target for r in per_source) == pytest.approx(1.5 * sizes.n)
    assert all(r.target <= 2 * r.source_size and abs(r.taken - r.target) <= 3 * 64 for r in per_source)
    assert took.where("taken > 2 * size").count() == 0
    assert listed(took, "key", "taken") == listed(mixing.take(big.repartition(7)), "key", "taken")
    mixed = mixing.mix(big)
    assert mixed.columns == big.columns
    words = mixed.select(F.size(F.split("text", " ")).alias("n")).agg(F.sum("n").alias("n")).first().n
    assert words == sizes.taken
    odd = mixing.take(docs)
    assert odd.count() == docs.count() and odd.where("size = 0 and taken > 0").count() == 0
    assert mixing.mix(empty).count() == 0 and mixing.take(empty).count() == 0


def test_targets_reshare_what_small_sources_cannot_give(spark):
    sizes = spark.createDataFrame([("a", 10), ("b", 1000), ("c", 1000)], "source string, size long")
    found = {r.source: r.target for r in mixing.targets(sizes).collect()}
    assert found["a"] == 20 and found["b"] == pytest.approx((3015 - 20) / 3) and found["c"] == pytest.approx(2 * (3015 - 20) / 3)


# packing

def test_packing_is_an_exact_round_trip(docs, empty):
    rules = packing.PackRules(capacity=256, rows_per_group=10)
    placed = packing.pack(docs, rules, keep_ids=True).collect()
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in placed:
        assert r.length > 0 and r.ids_crc32 == zlib.crc32(bytes(r.ids)) and len(r.ids) == 4 * r.length
        by_doc[r.key, r.doc_tokens].append((r.start, bytes(r.ids)))
        by_sequence[r.sequence_id].append((r.offset, r.length))
    for parts in by_sequence.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 256
    expected = Counter(ids + (1).to_bytes(4, "little") for ids in token_lists(docs))
    total = sum(len(ids) // 4 * n for ids, n in expected.items())
    assert sum(r.length for r in placed) == total
    # rows that share id and length share a key here; all of their bytes must be there
    found = Counter(i for parts in by_doc.values() for _, ids in parts for i in ids)
    assert found == Counter(i for ids, n in expected.items() for i in ids * n)
    assert 256 * len(by_sequence) - total < 256 + 0.05 * total
    assert packing.pack(empty, rules).count() == 0


def test_cuts_lie_in_their_class():
    for n in range(1, 6000, 7):
        parts = packing.cut(n)
        assert sum(length for length, _ in parts) == n and all(0 < length <= 2048 // k for length, k in parts)


# language model

def dictionary_scores(rows, rules):
    """Rows as the operator returns them, and the kept contexts, with one dictionary of all contexts."""
    held = [k is not None and zlib.crc32(str(k).encode()) % 7 == 2 for k, _ in rows]
    texts = [[*(t or "").encode().lower().split(), b"\n"] for _, t in rows]
    learnt = [w for w, h in zip(texts, held) if not h]
    counts = Counter(w for t in learnt for w in t)
    n, v = sum(counts.values()), len(counts)
    follow = defaultdict(Counter)
    for t in learnt:
        for i, w in enumerate(t):
            for size in range(1, min(i, rules.depth) + 1):
                follow[tuple(t[i - size:i])][w] += 1
    kept = {}
    for context, after in follow.items():
        size = sum(after.values())
        if size >= rules.min_count:
            above = follow[context[1:]] if len(context) > 1 else counts
            gain = sum(c * math.log(c / size / (above[w] / sum(above.values()))) for w, c in after.items())
            if gain > rules.gain_per_token * len(after):
                kept[context] = after

    def chance(context, word):
        if not context:
            return (counts[word] + 1) / (n + v + 1)
        below = chance(context[1:], word)
        if context not in kept:
            return below
        after = kept[context]
        return (after[word] + len(after) * below) / (sum(after.values()) + len(after))

    expected = []
    for (key, _), words, h in zip(rows, texts, held):
        base = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in words)
        score = sum(math.log10(chance(tuple(words[max(0, i - rules.depth):i]), w)) for i, w in enumerate(words))
        expected.append((key, h, len(words), sum(counts[w] > 0 for w in words), n, base, score))
    return expected, kept


def language_rows(docs):
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()] + [(500 + i, prose(150, i)) for i in range(30)]
    return rows + [(600 + i, "red blue green white blue black blue green red " * 5) for i in range(9)]


def assert_scores(found, expected):
    order = lambda r: (repr(r[0]), r[2], round(r[5], 6))
    for a, b in zip(sorted(map(tuple, found), key=order), sorted(expected, key=order), strict=True):
        assert a[:5] == b[:5] and a[5] == pytest.approx(b[5], rel=1e-9) and a[6] == pytest.approx(b[6], rel=1e-6)


@pytest.mark.parametrize("depth, size", [(3, 700), (3, 10**6), (2, 700), (1, 3000), (4, 2000)])
def test_scores_equal_a_dictionary_model(docs, empty, spark, depth, size):
    rules = suffix_tree.TreeRules(depth=depth, min_count=3, gain_per_token=0.05, tokens_per_part=size)
    rows = language_rows(docs)
    expected, kept = dictionary_scores(rows, rules)
    assert {len(c) for c in kept} == set(range(1, depth + 1))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    clash = ("row", "file", "place", "block", "part", "key", "held_out", "address", "token", "n", "about", "keys", "texts")
    assert_scores(suffix_tree.score(frame.withColumns({c: F.lit("x") for c in clash}), rules).collect(), expected)
    assert suffix_tree.score(empty).count() == 0


def test_other_text_takes_no_context_away(docs, spark):
    rows = language_rows(docs)
    rules = suffix_tree.TreeRules(min_count=3, tokens_per_part=5000)
    _, kept = dictionary_scores(rows, rules)
    other = [(10_000 + i, " ".join(f"{w}{i % 7}" for w in prose(400, 50 + i).split())) for i in range(60)]
    expected, more = dictionary_scores(rows + other, rules)
    assert len(more) > 1.5 * len(kept) and {c for c in kept if len(c) > 1} <= set(more)
    assert_scores(suffix_tree.score(spark.createDataFrame(rows + other, "doc_id long, text string"), rules).collect(), expected)


def test_a_hot_word_is_spread_over_the_parts(spark):
    import numpy as np

    texts = [" ".join(f"w{i * 50 + j} of x{j}" for j in range(50)) for i in range(60)]
    hot = suffix_tree.Hot(np.array([xxhash.xxh64_intdigest(b"of")], dtype=np.uint64), *(np.array([0, 3000]),) * 3,
                          np.array([False, True]), 9060, 3052)
    packed = zstandard.compress("\n".join(texts).encode())
    block = suffix_tree.Block([{"keys": [1] * 60, "held_out": [False] * 60, "texts": packed}], hot, 16)
    block.known, block.pair = np.full(len(block.words), 9), np.zeros(len(block.token), dtype=np.int64)
    block.number = np.where(block.words == hot.words[0], 1, 2 + np.arange(len(block.words)))
    block._rank()
    block.contexts(suffix_tree.TreeRules())
    of, sizes = 0, []
    for row in block.ask_chances():
        numbers, columns = suffix_tree._from_steps(row["words"]), suffix_tree._entries(row, 3)
        sizes.append(int((numbers[columns[0] - 1] == 1).sum()))
        of += sizes[-1]
    assert of == 3000 and len(sizes) == 16 and max(sizes) < 2 * of / 16


def test_a_packed_block_has_its_tokens_ready(spark, monkeypatch):
    import numpy as np

    digest = xxhash.xxh64_intdigest
    long = "y" * 128
    texts = [" A\x0bb\tb\x1cc  b ", None, "", f"\u00c9 x\u00a0x {long} {long}y {long} abcdefgh abcdefghi", prose(90, 1), prose(90, 2), " \n "]
    rows = [(i, 100 + i, i % 3 == 0, t) for i, t in enumerate(texts)]
    frame = spark.createDataFrame(rows, "address long, key long, held_out boolean, text string").coalesce(1)
    rules = suffix_tree.TreeRules(tokens_per_part=100)
    packed = [r.asDict() for r in suffix_tree.blocks_of(frame.withColumn("text", F.col("text").cast("binary")), rules).collect()]
    hot = suffix_tree.Hot(np.array([digest(b"b")], dtype=np.uint64), *(np.array([0, 3]),) * 3, np.array([False, True]), 9, 9)
    monkeypatch.setattr(xxhash, "xxh64_intdigest", None)  # no word is hashed again
    found = {}
    for row in packed:
        block = suffix_tree.Block([row], hot, 4)
        found.update(zip(block.keys, zip(block.held_out, np.split(block.words[block.token], block.starts[1:]))))
    assert len(packed) > 1 and sorted(found) == [r[1] for r in rows]
    for _, key, held_out, text in rows:
        expected = [digest(w) for w in [*(text or "").encode().lower().split(), b"\n"]]
        assert found[key][0] == held_out and found[key][1].tolist() == expected


def test_scoring_leaves_no_vocabulary_behind(docs, spark):
    from wattloom.session import shared_dir, subfolders

    stored = lambda: {f for f in subfolders(spark, shared_dir(spark)) if f.startswith("vocabulary")}
    before = stored()
    assert suffix_tree.score(docs.select("doc_id", "text")).count() == docs.count() and stored() == before


def test_held_out_texts_score_better_than_by_counts_alone(spark, sf):
    scored = suffix_tree.score(spark.read.parquet(f"{sf}/documents.parquet")).where("held_out")
    sums = scored.agg(F.sum("score").alias("score"), F.sum("base_score").alias("base")).first()
    assert sums.score > sums.base


# pipeline

def test_pipeline_stages_take_effect(spark, docs, sf):
    kept = docs.drop("row", "kept", "n_words", "size", "key", "_text", "set_id", "ids", "piece", "target", "class", "uid")
    names = [name for name, _ in corpus_pipeline.STAGES]
    frame = kept
    for name, stage in corpus_pipeline.STAGES:
        before = frame.collect()
        frame = spark.createDataFrame(stage(spark, frame, sf).collect() or [], stage(spark, kept.limit(0), sf).schema)
        if name != names[-1]:
            assert frame.columns == kept.columns
        if name == "near_duplicates":
            rows = [(r.doc_id, r.text) for r in before]
            gone = [k for k, n, c in brute_components(rows) if n and k is not None and k != c]
            assert {r.doc_id for r in frame.collect()} == {k for k, _ in rows} - set(gone)
        if name == "source_mix":
            assert {r.doc_id for r in frame.collect()} <= {r.doc_id for r in before}
    assert frame.where("length > 0").count() == frame.count() > 0
