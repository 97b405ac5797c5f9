"""Quality rules: counting rules and the divergence of a text from language references.

A text is compared with reference histograms by Jensen-Shannon distance (base 2, so between 0 and 1): how its characters
spread over six classes, and how its words spread over the common words of a language and all others. The word distance
is relative: 1 is a text with none of the language's common words, so lists of keywords and made-up words come near 1 in
every language. Everything is built-in functions on arrays inside the row; nothing is shuffled, and a long text stays in its own row.

* Null and empty texts have no words: all counts 0, base_failed, not kept.
* A known `lang` does not bind: the closest language reference counts, so that a wrong label costs nothing.
* Distances are null under the minimum lengths and then reject nothing.
* Repeated rows are judged one by one; other columns, of whatever name, pass through `quality_filter` unchanged.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE_CLASS, WORD_PATTERN, whole_row, words_of

# Shares of lower-case letters (and letters without case), upper-case letters, digits, white space,
# punctuation and other characters in running text of the four languages.
CHAR_CLASSES = (0.775, 0.030, 0.006, 0.165, 0.023, 0.001)
# Common words of each language per thousand words of running text, rounded.
COMMON_WORDS = {
    "en": {"the": 62, "of": 32, "and": 28, "to": 26, "a": 23, "in": 20, "is": 11, "that": 10, "for": 9, "it": 9, "was": 8,
           "as": 7, "with": 7, "be": 6, "he": 6, "on": 6, "by": 5, "not": 5, "this": 5, "are": 5, "at": 4, "from": 4,
           "have": 4, "or": 4},
    "de": {"der": 33, "die": 32, "und": 28, "in": 18, "den": 13, "von": 12, "zu": 11, "das": 10, "mit": 9, "des": 8,
           "sich": 8, "auf": 8, "ist": 9, "im": 8, "ein": 8, "dem": 7, "eine": 7, "nicht": 7, "als": 6, "es": 6, "an": 5,
           "auch": 5, "er": 5, "für": 7},
    "fr": {"de": 50, "la": 32, "le": 28, "et": 24, "les": 23, "des": 18, "en": 15, "du": 13, "un": 13, "une": 12, "que": 11,
           "est": 10, "dans": 9, "pour": 9, "qui": 9, "a": 8, "par": 8, "au": 7, "il": 7, "ne": 6, "pas": 6, "sur": 6,
           "ce": 5, "plus": 4},
    "es": {"de": 60, "la": 38, "que": 30, "el": 28, "en": 26, "y": 26, "a": 20, "los": 17, "del": 13, "las": 12, "se": 12,
           "un": 11, "por": 10, "con": 9, "no": 9, "una": 8, "su": 7, "para": 7, "es": 7, "al": 6, "lo": 6, "como": 5,
           "más": 4, "o": 4},
}
SYMBOLS = "[#*$%&|<>]"
PUNCTUATION = r"""[.,;:!?'"()-]"""


@dataclass(frozen=True)
class QualityRules:
    min_words: int = 50
    max_repeat_percent: int = 50
    min_chars_for_classes: int = 200
    min_words_for_common: int = 50
    max_char_distance: float = 0.30
    max_word_distance: float = 0.90  # of the distance of a text with no common words, or with no others
    max_sum: float = 0.95


def _distance(shares: Column, reference: list[float]) -> Column:
    """Jensen-Shannon distance of an array of shares and a fixed reference of the same length."""
    def part(p: Column, q: Column) -> Column:
        mean = (p + q) / 2
        return q * F.log2(q / mean) + F.when(p > 0, p * F.log2(p / mean)).otherwise(0.0)

    terms = F.zip_with(shares, F.array(*map(F.lit, reference)), part)
    return F.sqrt(F.greatest(F.aggregate(terms, F.lit(0.0), lambda a, t: a + t / 2), F.lit(0.0)))


def extreme_distances(reference: list[float]) -> tuple[float, float]:
    """Distances of a text with none of the common words and of one with no other words, in the reference's proportions."""
    rest = reference[-1]
    common = 1 - rest
    none = common + rest * math.log2(2 * rest / (1 + rest)) + math.log2(2 / (1 + rest))
    alone = rest + common * math.log2(2 * common / (1 + common)) + math.log2(2 / (1 + common))
    return math.sqrt(none / 2), math.sqrt(alone / 2)


def word_reference(language: str) -> list[float]:
    """Shares of the common words of a language and, last, of all others."""
    common = [v / 1000 for v in COMMON_WORDS[language].values()]
    return [*common, 1 - sum(common)]


def _repeated_window_words(df: DataFrame) -> DataFrame:
    """Words inside three-word windows that occur twice or more in their text.

    Windows are compared by 64-bit hash; sorting them with their positions brings equal ones together.
    """
    n = F.size("_words")
    windows = F.when(n >= 3, F.transform(
        F.sequence(F.lit(1), n - 2),
        lambda i: F.xxhash64(F.element_at("_words", i), F.element_at("_words", i + 1), F.element_at("_words", i + 2)),
    )).otherwise(F.array().cast("array<long>"))
    df = df.withColumn("_windows", windows)
    repeats = F.size("_windows") != F.size(F.array_distinct("_windows"))
    placed = F.zip_with("_windows", F.sequence(F.lit(1), F.size("_windows")),
                        lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    df = df.withColumn("_sorted", F.when(repeats, F.sort_array(placed)))
    size = F.size("_sorted")
    same = F.zip_with(F.slice("_sorted", 1, size - 1), F.slice("_sorted", 2, size - 1), lambda a, b: a["h"] == b["h"])
    df = df.withColumn("_same", F.when(F.col("_sorted").isNotNull(), same))
    no = F.array(F.lit(False))
    marked = F.zip_with(F.concat(no, F.col("_same")), F.concat(F.col("_same"), no), lambda a, b: a | b)
    positions = F.zip_with("_sorted", marked, lambda s, m: F.when(m, s["i"]))
    df = df.withColumn("_starts", F.array_sort(F.array_compact(positions)))
    start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))
    covered = F.aggregate(
        "_starts", start,
        lambda acc, i: F.struct((acc["n"] + i + 3 - F.greatest(i, acc["end"])).alias("n"), (i + 3).alias("end")),
        lambda acc: acc["n"],
    )
    return df.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long"))


def _common_word_distance(df: DataFrame) -> DataFrame:
    """Distance to the closest language, as a share of what a text without its common words has,
    or for a text richer in them than the reference, one with no other words. Equal words stand together once sorted, so counts are differences of places."""
    listed = sorted({w for words in COMMON_WORDS.values() for w in words})
    plain = F.transform("_words", lambda w: F.rtrim(F.lower(w), F.lit(".,;:!?")))
    df = df.withColumn("_hits", F.sort_array(F.filter(plain, lambda w: w.isin(listed))))
    df = df.withColumn("_found", F.array_distinct("_hits"))
    df = df.withColumn("_first", F.transform("_found", lambda w: F.array_position("_hits", w)))
    ends = F.concat(F.slice("_first", 2, F.size("_found")), F.array(F.size("_hits").cast("long") + 1))
    df = df.withColumn("_times", F.zip_with("_first", ends, lambda a, b: b - a))
    df = df.withColumn("_count", F.map_from_arrays("_found", F.slice("_times", 1, F.size("_found"))))
    each = []
    for language, words in COMMON_WORDS.items():
        name = f"_{language}"
        counts = F.transform(F.array(*map(F.lit, words)), lambda w: F.coalesce(F.try_element_at("_count", w), F.lit(0)))
        df = df.withColumn(name, F.transform(counts, lambda c: c / F.greatest(F.size("_words"), F.lit(1))))
        rest = F.greatest(1 - F.aggregate(name, F.lit(0.0), lambda a, s: a + s), F.lit(0.0))
        reference = word_reference(language)
        none, alone = extreme_distances(reference)
        each.append(_distance(F.concat(F.col(name), F.array(rest)), reference) / F.when(rest > reference[-1], none).otherwise(alone))
    return df.withColumn("word_distance", F.least(*each))


def _char_distance(df: DataFrame) -> DataFrame:
    df = df.withColumn("_odd", F.regexp_replace("_text", rf"[\p{{L}}{SPACE_CLASS}]+", ""))
    df = df.withColumn("_classes", F.struct(
        (F.col("word_chars") - F.length("_odd")).alias("letters"),
        F.length(F.regexp_replace("_text", r"\P{Lu}+", "")).alias("upper"),
        F.length(F.regexp_replace("_odd", "[^0-9]+", "")).alias("digits"),
        F.length(F.regexp_replace("_odd", PUNCTUATION.replace("[", "[^", 1) + "+", "")).alias("points"),
        F.length("_odd").alias("odd"),
    ))
    get = F.col("_classes").getField
    counts = F.array(
        get("letters") - get("upper"), get("upper"), get("digits"), F.col("_n_chars") - F.col("word_chars"), get("points"),
        get("odd") - get("digits") - get("points"))
    shares = F.transform(counts, lambda c: c / F.greatest(F.col("_n_chars"), F.lit(1)))
    return df.withColumn("char_distance", _distance(shares, list(CHAR_CLASSES)))


def judge(docs: DataFrame, rules: QualityRules = QualityRules(), text: str = "text") -> DataFrame:
    """Each row as `row`, beside n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    char_distance, word_distance (null for texts under the minimum lengths) and kept."""
    df = docs.select(whole_row(docs).alias("row"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("_text"))
    df = df.withColumn("_words", words_of(F.col("_text")))
    df = df.withColumn("_lines", F.filter(F.split("_text", "\n"), lambda line: line.rlike(WORD_PATTERN)))
    df = (
        df.withColumn("n_words", F.size("_words").cast("long"))
        .withColumn("word_chars", F.length(F.array_join("_words", "")).cast("long"))
        .withColumn("_n_chars", F.length("_text"))
        .withColumn("n_symbols", F.regexp_count("_text", F.lit(SYMBOLS)).cast("long"))
        .withColumn("n_dup_lines", (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"))
    )
    df = _char_distance(_common_word_distance(_repeated_window_words(df)))
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    failed = (F.col("n_words") < rules.min_words) | (
        F.col("n_repeat_words") * 100 > F.col("n_words") * rules.max_repeat_percent)
    df = df.select(
        "row", *names, failed.alias("base_failed"),
        F.when(F.col("_n_chars") >= rules.min_chars_for_classes, F.col("char_distance")).alias("char_distance"),
        F.when(F.col("n_words") >= rules.min_words_for_common, F.col("word_distance")).alias("word_distance"),
    )
    chars, words = F.coalesce("char_distance", F.lit(0.0)), F.coalesce("word_distance", F.lit(0.0))
    near = (chars <= rules.max_char_distance) & (words <= rules.max_word_distance) & (chars + words <= rules.max_sum)
    return df.withColumn("kept", ~F.col("base_failed") & near)


def quality_filter(docs: DataFrame, rules: QualityRules = QualityRules(), text: str = "text") -> DataFrame:
    """The rows that the rules keep, with their own columns only.

    The generator keeps Catalyst from pushing the filter below the judgement, which would write all of it out in terms
    of the text, many times over.
    """
    judged = judge(docs, rules, text).select("row", "kept")
    return judged.select(F.inline(F.array(F.struct("row", "kept")))).where("kept").select("row.*")
