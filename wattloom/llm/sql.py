"""The same results in SQL for a second engine, where SQL can express them."""

from __future__ import annotations

from .filter_audit import AuditRules
from .mixing import MODULUS, STEP, MixRules
from .quality import CHAR_CLASSES, COMMON_WORDS, PUNCTUATION, QualityRules, extreme_distances, word_reference

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


def _numbers(values) -> str:
    return "[" + ", ".join(repr(v) for v in values) + "]::DOUBLE[]"


def _divergence(shares: str, reference: list[float]) -> str:
    return f"""sqrt(greatest(list_sum(list_transform(list_zip({shares}, {_numbers(reference)}),
      lambda z: (z[2] * log2(z[2] / ((z[1] + z[2]) / 2))
        + CASE WHEN z[1] > 0 THEN z[1] * log2(z[1] / ((z[1] + z[2]) / 2)) ELSE 0 END) / 2)), 0))"""


def top_k_sql(k: int = 5, every: int = 50) -> str:
    return f"""
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2]))::BIGINT AS score
      FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % {every} = 0)
SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INT AS rank, vec_id, score
FROM s QUALIFY rank <= {k}"""


def quality_sql(rules: QualityRules = QualityRules()) -> str:
    points = PUNCTUATION.replace("'", "''")
    languages = []
    for language, words in COMMON_WORDS.items():
        listed = "[" + ", ".join(f"'{w}'" for w in words) + "]"
        each = f"list_transform({listed}, lambda v: len(list_filter(plain, lambda w: w = v)) / n_words)"
        reference = word_reference(language)
        rest = f"greatest(1 - list_sum({each}), 0)"
        none, alone = extreme_distances(reference)
        extreme = f"CASE WHEN {rest} > {reference[-1]!r} THEN {none!r} ELSE {alone!r} END"
        languages.append(f"{_divergence(f'list_append({each}, {rest})', reference)} / ({extreme})")
    chars = f"""[length(regexp_replace(t, '[^\\p{{L}}]+', '', 'g')) - length(regexp_replace(t, '\\P{{Lu}}+', '', 'g')),
      length(regexp_replace(t, '\\P{{Lu}}+', '', 'g')), length(regexp_replace(t, '[^0-9]+', '', 'g')),
      length(t) - word_chars, length(regexp_replace(t, '{points.replace("[", "[^", 1)}+', '', 'g')),
      length(regexp_replace(t, '[\\p{{L}}0-9\\x20\\x09-\\x0D]+', '', 'g'))
        - length(regexp_replace(t, '{points.replace("[", "[^", 1)}+', '', 'g'))]"""
    shares = f"list_transform({chars}, lambda c: c / greatest(length(t), 1))"
    return f"""
WITH w AS (SELECT doc_id, coalesce(text, '') AS t, {WORDS} AS words FROM documents),
e AS (SELECT doc_id, unnest(words) AS w, generate_subscripts(words, 1) AS i FROM w),
g AS (SELECT doc_id, i, concat(w, ' ', lead(w) OVER s, ' ', lead(w, 2) OVER s) AS g, lead(w, 2) OVER s AS l
      FROM e WINDOW s AS (PARTITION BY doc_id ORDER BY i)),
r AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, g) AS n FROM g WHERE l IS NOT NULL)
      WHERE n > 1),
c AS (SELECT doc_id, count(DISTINCT p) AS n_repeat_words FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM r)
      GROUP BY doc_id),
b AS (
  SELECT doc_id, t, len(words)::BIGINT AS n_words, coalesce(length(array_to_string(words, '')), 0)::BIGINT AS word_chars,
    len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines,
    list_transform(words, lambda w: rtrim(lower(w), '.,;:!?')) AS plain,
    coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words
  FROM w LEFT JOIN c USING (doc_id)),
d AS (
  SELECT *, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
    n_words < {rules.min_words} OR 100 * n_repeat_words > {rules.max_repeat_percent} * n_words AS base_failed,
    CASE WHEN length(t) >= {rules.min_chars_for_classes} THEN {_divergence(shares, list(CHAR_CLASSES))} ELSE 0 END AS cd,
    CASE WHEN n_words >= {rules.min_words_for_common} THEN least({", ".join(languages)}) ELSE 0 END AS wd
  FROM b)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND cd <= {rules.max_char_distance} AND wd <= {rules.max_word_distance}
    AND cd + wd <= {rules.max_sum} AS kept
FROM d"""


def mix_sql(rules: MixRules = MixRules()) -> str:
    weights = "[" + ", ".join(map(str, rules.weights)) + "]"
    words = rules.block_words
    return f"""
WITH d AS (SELECT doc_id, source, len({WORDS})::BIGINT AS size FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size, {weights}[1 + ((row_number() OVER (ORDER BY source NULLS LAST)) - 1)
        % {len(rules.weights)}]::DOUBLE AS w, sum(size)::DOUBLE * {rules.max_epochs} AS cap
      FROM d GROUP BY source),
l AS (SELECT *, (sum(source_size) OVER () * {rules.percent_of_all / 100} - coalesce(sum(cap) OVER b, 0))
        / (sum(w) OVER () - coalesce(sum(w) OVER b, 0)) AS level
      FROM s WINDOW b AS (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (SELECT source, source_size, CASE WHEN cap <= level * w THEN cap
        ELSE max(CASE WHEN cap > level * w THEN level END) OVER () * w END AS target FROM l),
h AS (SELECT *, round(sum(target) OVER (ORDER BY source NULLS LAST ROWS UNBOUNDED PRECEDING)
        / (sum(target) OVER ()) * {MODULUS})::BIGINT AS high FROM t WHERE target > 0),
b AS (SELECT *, coalesce(lag(high) OVER (ORDER BY high, source NULLS LAST), 0) AS low FROM h),
k AS (SELECT k, (k % {MODULUS}) * {STEP} % {MODULUS} AS point
      FROM range((SELECT ceil(sum(target) / {words})::BIGINT FROM t)) r(k)),
slots AS (SELECT source, row_number() OVER (PARTITION BY source ORDER BY k) - 1 AS rank
          FROM k JOIN b ON point >= low AND point < high),
o AS (SELECT d.*, source_size, target, sum(size) OVER (PARTITION BY d.source
        ORDER BY ('0x' || substr(md5('{rules.seed}:' || doc_id), 1, 15))::BIGINT, doc_id
        ROWS UNBOUNDED PRECEDING) - size AS start
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
p AS (SELECT *, start + e * source_size AS a, start + e * source_size + size AS z
      FROM o, range({rules.max_epochs}) r(e) WHERE size > 0),
x AS (SELECT p.*, unnest(range((a // {words})::BIGINT, ((z - 1) // {words})::BIGINT + 1)) AS rank FROM p WHERE a < target),
u AS (SELECT doc_id, sum(greatest(least(z, (rank + 1) * {words}, round(target)::BIGINT) - greatest(a, rank * {words}), 0))
        AS taken
      FROM x JOIN slots USING (source, rank) GROUP BY doc_id)
SELECT o.doc_id, size, source_size, target, coalesce(taken, 0)::BIGINT AS taken FROM o LEFT JOIN u USING (doc_id)"""


def audit_sql(rules: AuditRules = AuditRules()) -> str:
    return f"""
WITH RECURSIVE t AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t, {WORDS} AS words FROM documents),
l AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
m AS (SELECT t, min(doc_id) AS lowest FROM t GROUP BY t),
d AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
    concat(CASE WHEN len(words) < {rules.min_words} THEN 'A' END,
      CASE WHEN 100 * len(list_distinct(words)) < {rules.min_distinct_percent} * len(words) THEN 'B' END,
      CASE WHEN 100 * len(regexp_extract_all(t.t, '[A-Z]')) > {rules.max_upper_percent} * length(t.t) THEN 'C' END,
      CASE WHEN regexp_matches(t.t, '{rules.symbols}') THEN 'D' END,
      CASE WHEN t.doc_id > lowest THEN 'E' END) AS fails
  FROM t JOIN m ON t.t = m.t LEFT JOIN l ON t.doc_id = l.doc_id),
c AS (SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
      FROM d GROUP BY part, fails),
p AS (SELECT '' AS o UNION ALL
      SELECT o || x FROM p, (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x) WHERE length(o) < 5 AND NOT contains(o, x)),
s AS (SELECT o AS filter_order, step, o[step] AS f FROM p, range(1, 6) r(step) WHERE length(o) = 5),
a AS (
  SELECT part, filter_order, step, f, n, good, toxic, fails, contains(fails, f) AS hit,
    len(list_filter(string_split(filter_order[1:step - 1], ''), lambda x: x <> '' AND contains(fails, x))) > 0 AS gone
  FROM c, s),
r AS (
  SELECT part, filter_order, step, any_value(f) AS f, coalesce(sum(n) FILTER (NOT hit AND NOT gone), 0)::BIGINT AS kept,
    coalesce(sum(n) FILTER (hit AND NOT gone), 0)::BIGINT AS removed, coalesce(sum(n) FILTER (hit AND gone), 0)::BIGINT AS redundant,
    coalesce(sum(n) FILTER (fails = f), 0)::BIGINT AS unique_fails,
    coalesce(sum(good) FILTER (hit AND NOT gone), 0)::BIGINT AS good_lost,
    coalesce(sum(toxic) FILTER (hit AND NOT gone), 0)::BIGINT AS toxic_lost
  FROM a GROUP BY part, filter_order, step)
SELECT part, filter_order, step::INT AS step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
  (sum(removed) OVER (PARTITION BY part, f))::BIGINT AS shapley
FROM r"""


def oracle_sql() -> dict[str, str]:
    return {
        "op1_maxscore_top_k": top_k_sql(),
        "op4_quality_rules": quality_sql(),
        "op8_source_mix": mix_sql(),
        "op12_filter_audit": audit_sql(),
    }
