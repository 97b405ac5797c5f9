"""Personal data in texts, also in disguise, with spans in the original characters.

Plain identifiers are found by their patterns in the text as it is. A second pass normalises disguises (look-alike and
full-width characters, zero-width characters, spelled digits, "at" and "dot" written out or in brackets) as a list of
edits, searches the normalised text by the same patterns and maps what it finds back through the edits. A found span
counts only if an edit lies in it and no plain span of its kind overlaps it, so plain spans always stay.

Words alone prove little: an "at" without brackets needs a top-level domain at the end and, if its dots are plain ones, a
mailbox with a mark in it, a word like "mail" nearby or a clause that starts with it; so does an ending that is a word. Words
that commonly stand before "at" are no mailbox. Cards and addresses need their check digits and ranges, as in the plain pass.

* A null or empty text has no spans. Texts of any length are searched whole; every pattern is linear in the text.
* Repeated rows are searched one by one; `redact` keeps all columns, of whatever name.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches, whole_row

KINDS = ("email", "ip", "card", "phone")
Span = tuple[int, int]
Edit = tuple[int, int, str, str]  # start, end, replacement, sort of disguise

DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# A number that does not start where digits already ran: the same matches, without trying every digit of a long run.
ADDRESS = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

# Letters of other scripts that look like ASCII ones.
LOOKALIKES = dict(zip(
    "АВЕЗКМНОРСТУХаеорсухіјѕһԁԛԝΑΒΕΖΗΙΚΜΝΟΡΤΥΧαονρυχıɡ",
    "ABE3KMHOPCTYXaeopcyxijshdqwABEZHIKMNOPTYXaovpuxig"))
INVISIBLE = frozenset("­​‌‍⁠﻿")
# Digits in words of four languages.
DIGIT_WORDS = {
    **{w: str(i) for i, w in enumerate("zero one two three four five six seven eight nine".split())},
    **{w: str(i) for i, w in enumerate("null eins zwei drei vier fünf sechs sieben acht neun".split())},
    **{w: str(i) for i, w in enumerate("zéro un deux trois quatre cinq six sept huit neuf".split())},
    **{w: str(i) for i, w in enumerate("cero uno dos tres cuatro cinco seis siete ocho nueve".split())},
    "oh": "0",
}
# Number words that are common words otherwise; they count only beside other number words.
AMBIGUOUS = frozenset(("un", "null", "oh", "acht", "neuf", "dos", "tres"))
CLEAR = frozenset(DIGIT_WORDS) - AMBIGUOUS
# Generic top-level domains; besides, every ending of two letters counts as that of a country.
TOP_LEVEL = frozenset(
    "com org net edu gov mil int info biz name pro aero coop museum jobs mobi travel tel cat asia post xxx app dev page blog "
    "xyz online site website space tech store shop cloud club live news email media agency studio design digital network "
    "systems solutions services company group global world today life top vip win one link click host press wiki academy "
    "school university institute foundation berlin london paris nyc eus bank law health care energy games".split())
# Endings that are words as well; they need something more to show that an address is meant.
WORD_ENDINGS = frozenset(
    "am an as at be by do go he hi id if in is it la ma me mi my no of oh ok on or pa so to up us we name pro post page "
    "space store shop club live news media agency design digital network systems services company group global world today "
    "life top win one link click host press school university institute foundation bank law health care energy games site "
    "cat travel jobs museum".split())
# Words that stand before "at" without being a mailbox.
NO_MAILBOX = frozenset(
    "a all am an and are arrive arrived article available be been book bought buy came check click come could details did do does "
    "done down download email even file find first found free from get go good had has have he held her here him his hosted i in "
    "info is it just last least less listed located look looked looking looks mail me meet more most my near new no not now of off "
    "on only or order our out page please posted pricing product products published read register registered see seen service "
    "services she shop shopping sign site sold some stay still stop store that the them then there these they thing things this "
    "time today together up us use via visit was we website went were what when where which while who with work worked working "
    "works yet you".split())
MAIL_WORDS = re.compile(r"\b(?:e-?mails?|mailto|mail|contact|write to|reach|address|inbox|kontakt|adresse|courriel|correo)\b", re.IGNORECASE)
CLAUSE_START = re.compile(r"(?:^|[\n.,:;!?(\[<\"'|-])\s*$")
CLAUSE_END = re.compile(r"\s*(?:$|[\n.,:;!?)\]>\"'|-])")
NEAR = 48  # characters on either side in which a word may speak for an address

_NUMBER = "|".join(sorted(DIGIT_WORDS, key=len, reverse=True))
RUN = re.compile(
    rf"\b(?:(?:double|triple)\s+)?(?:{_NUMBER}|[0-9]+)(?:[\s,;/-]+(?:(?:double|triple)\s+)?(?:{_NUMBER}|[0-9]+)\b)*+",
    re.IGNORECASE)
TOKEN = re.compile(rf"(?:(double|triple)\s+)?({_NUMBER}|[0-9]+)\b", re.IGNORECASE)
PLUS = re.compile(rf"\bplus\s+(?=(?:{_NUMBER})\b|[0-9])", re.IGNORECASE)
BRACKETS = re.compile(r"\s*[\[({<]\s*(at|@|dot|\.|point|punkt|punto)\s*[\])}>]\s*", re.IGNORECASE)
BARE = re.compile(r"(?<=[A-Za-z0-9])\s+(at|@|dot)\s+(?=[A-Za-z0-9])|(?<=[A-Za-z0-9])[_-](at|dot)[_-](?=[A-Za-z0-9])",
                  re.IGNORECASE)
LETTERS = re.compile(r"[^\W\d_]+")


def _emails(text: str) -> list[Span]:
    """Each match holds one @ with the longest run of local characters before it, so only these places are tried."""
    spans, free = [], 0
    at = text.find("@")
    while at >= 0:
        domain = DOMAIN.match(text, at + 1)
        if domain:
            start = at
            while start > free and text[start - 1] in LOCAL_CHARS:
                start -= 1
            if start < at:
                spans.append((start, domain.end()))
                free = domain.end()
        at = text.find("@", at + 1)
    return spans


def _addresses(text: str) -> list[Span]:
    def fits(number: str) -> bool:
        number = number.lstrip("0")
        return len(number) < 4 and int(number or 0) <= 255

    return [m.span() for m in ADDRESS.finditer(text) if all(map(fits, m[0].split(".")))]


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += d if i % 2 == 0 else sum(divmod(2 * d, 10))
    return total % 10 == 0


def _cards(text: str) -> list[Span]:
    spans = []
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 13:
            digits = m[0].replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19 and luhn(digits):
                spans.append(m.span())
    return spans


def _phones(text: str) -> list[Span]:
    if "+" not in text:
        return []
    return [m.span() for m in PHONE.finditer(text) if 9 <= sum(c.isdigit() for c in m[0]) <= 15]


FINDERS = dict(zip(KINDS, (_emails, _addresses, _cards, _phones)))


def plain_spans(text: str) -> dict[str, list[Span]]:
    return {kind: find(text) for kind, find in FINDERS.items()}


def _character_edits(text: str) -> list[Edit]:
    if text.isascii():
        return []
    known: dict[str, str] = {}
    for c in set(text):
        if not c.isascii():
            if c in INVISIBLE:
                known[c] = ""
            else:
                plain = LOOKALIKES.get(c) or unicodedata.normalize("NFKC", c)
                digit = unicodedata.digit(c, None)
                if digit is not None:
                    plain = str(digit)
                if len(plain) == 1 and plain.isascii():
                    known[c] = plain
    if not known:
        return []
    odd = re.compile("[" + "".join(map(re.escape, known)) + "]")
    return [(m.start(), m.end(), known[m[0]], "character") for m in odd.finditer(text)]


def _number_edits(text: str, lone: bool) -> list[Edit]:
    """Number words of a run as digits side by side; a single one only if `lone`."""
    edits = []
    for run in RUN.finditer(text):
        tokens = list(TOKEN.finditer(text, run.start(), run.end()))
        words = [t[2].lower() for t in tokens if not t[2].isdigit()]
        if not words or len(words) < 3 and not (lone and CLEAR.intersection(words)):
            continue
        end = None
        for token in tokens:
            if end is not None:
                edits.append((end, token.start(), "", "separator"))
            digits = token[2] if token[2].isdigit() else DIGIT_WORDS[token[2].lower()]
            if token[1]:
                digits = digits * (2 if token[1].lower() == "double" else 3)
            if digits != token[0]:
                edits.append((token.start(), token.end(), digits, "number"))
            end = token.end()
    return edits + [(m.start(), m.end(), "+", "number") for m in PLUS.finditer(text)]


def _word_edits(text: str) -> list[Edit]:
    edits = []
    for m in BRACKETS.finditer(text):
        edits.append((m.start(), m.end(), "@" if m[1].lower() in ("at", "@") else ".", "bracket"))
    for m in BARE.finditer(text):
        word = (m[1] or m[2]).lower()
        edits.append((m.start(), m.end(), "." if word == "dot" else "@", "spaced" if word == "@" else word))
    return edits


class Edited:
    """A text with edits applied, and the way back from its characters to those of the source."""

    def __init__(self, source: str, edits: list[Edit]):
        parts, self.applied, done, length = [], [], 0, 0
        self._starts, self._sources = [], []  # of every stretch: where it starts here, and (start, end, whether edited)
        for edit in sorted(edits):
            start, end, new, _ = edit
            if start < done:
                continue  # of overlapping edits the first holds
            for piece, where in ((source[done:start], (done, start, False)), (new, (start, end, True))):
                if piece:
                    parts.append(piece)
                    self._starts.append(length)
                    self._sources.append(where)
                    length += len(piece)
            self.applied.append(edit)
            done = end
        self._starts.append(length)
        self._sources.append((done, len(source), False))
        self.text = "".join([*parts, source[done:]])

    def back(self, span: Span) -> Span:
        """The source characters of a span; an edited stretch counts as a whole."""
        i, j = (bisect_right(self._starts, at) - 1 for at in (span[0], span[1] - 1))
        start, _, edited = self._sources[i]
        start += 0 if edited else span[0] - self._starts[i]
        last, end, edited = self._sources[j]
        return start, end if edited else last + span[1] - self._starts[j]


def _is_address(found: str, sorts: set[str], before: str, after: str) -> bool:
    """Whether words read as "@" and "." show an address. An ending must be one, and more must speak for it if the ending is
    a word too, or if "at" is the only disguise: a mark in the mailbox, a word like "mail" nearby, or a clause of its own."""
    mailbox, _, domain = found.partition("@")
    ending = domain.rpartition(".")[2].lower()
    if not (ending in TOP_LEVEL or len(ending) == 2 and ending.isalpha()):
        return False
    if "at" in sorts and mailbox.lower() in NO_MAILBOX:
        return False
    if ending not in WORD_ENDINGS and not ("at" in sorts and not sorts & {"dot", "bracket"}):
        return True
    if MAIL_WORDS.search(before) or MAIL_WORDS.search(after):
        return True
    marked = bool(re.search(r"[0-9._+%-]", mailbox))
    alone = bool(CLAUSE_START.search(before))
    return (marked or alone) and (ending not in WORD_ENDINGS or bool(CLAUSE_END.match(after)))


def _proven(kind: str, text: str, span: Span, sorts: set[str]) -> bool:
    if not sorts - {"separator"}:
        return False
    if kind != "email":
        return "at" not in sorts or bool(sorts & {"dot", "bracket"})
    start, end = span
    return not sorts & {"at", "dot", "spaced"} or _is_address(
        text[start:end], sorts, text[max(0, start - NEAR):start], text[end:end + NEAR])


def hidden_spans(text: str, plain: dict[str, list[Span]]) -> dict[str, list[Span]]:
    """Spans that show only once disguises are normalised: characters first, then words."""
    letters = Edited(text, _character_edits(text))
    read = letters.text
    words = set(LETTERS.findall(read.lower()))
    edits = _word_edits(read) if words & {"at", "dot", "point", "punkt", "punto"} or "@" in read else []
    if words & CLEAR:
        edits += [e for e in _number_edits(read, "dot" in words) if not any(e[0] < t[1] and t[0] < e[1] for t in edits)]
    if not (letters.applied or edits):
        return {}
    plainer = Edited(read, edits)
    found: dict[str, list[Span]] = {}
    for kind, find_kind in FINDERS.items():
        for span in find_kind(plainer.text):
            middle = plainer.back(span)
            source = letters.back(middle)
            sorts = {e[3] for e in plainer.applied if middle[0] <= e[0] and e[1] <= middle[1]}
            sorts |= {e[3] for e in letters.applied if source[0] <= e[0] and e[1] <= source[1]}
            clear = all(source[1] <= a or b <= source[0] for a, b in plain[kind])
            if clear and _proven(kind, plainer.text, span, sorts):
                found.setdefault(kind, []).append(source)
    return found


def all_spans(text: str) -> tuple[dict[str, list[Span]], dict[str, list[Span]]]:
    """Plain spans, and all spans, by kind."""
    plain = plain_spans(text)
    hidden = hidden_spans(text, plain)
    return plain, {kind: sorted(plain[kind] + hidden.get(kind, [])) for kind in KINDS}


def joined(spans: dict[str, list[Span]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind in KINDS for start, end in spans[kind])


def find(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """key, n_email, n_ip, n_card, n_phone (plain), base_spans, spans (all) of every row."""
    small_batches(docs.sparkSession)
    names = ["key", *(f"n_{kind}" for kind in KINDS), "base_spans", "spans"]

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [all_spans(t or "") for t in batch.column(1).to_pylist()]
            counts = [pa.array([len(plain[kind]) for plain, _ in found], pa.int64()) for kind in KINDS]
            yield pa.RecordBatch.from_arrays([
                batch.column(0), *counts, pa.array([joined(plain) for plain, _ in found], pa.string()),
                pa.array([joined(every) for _, every in found], pa.string())], names=names)

    columns = [F.col(f"`{key}`").cast("long").alias("key"), F.col(f"`{text}`").alias("text")]
    counts = ", ".join(f"n_{kind} long" for kind in KINDS)
    return docs.select(*columns).mapInArrow(search, f"key long, {counts}, base_spans string, spans string")


def masked(text: str) -> str:
    """The text with every span replaced by the name of its kind; spans that overlap become one."""
    _, spans = all_spans(text)
    parts, done = [], 0
    for start, end, kind in sorted((s, e, kind) for kind, found in spans.items() for s, e in found):
        if start >= done:
            parts += [text[done:start], f"[{kind.upper()}]"]
        done = max(done, end)
    return "".join([*parts, text[done:]])


def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with personal data in the text masked."""
    small_batches(docs.sparkSession)

    @F.pandas_udf("string")
    def mask(texts):
        return texts.map(lambda t: t if t is None else masked(t))

    rows = docs.select(whole_row(docs).alias("row"))
    return rows.withColumn("row", F.col("row").withField(f"`{text}`", mask(F.col("row").getField(text)))).select("row.*")
