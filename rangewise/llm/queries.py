"""The registered queries of this subpackage and their DuckDB SQL.

Each applies its operator, with the parameters its module names, to the whole
table; the thin functions here only derive the contract's columns.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rangewise.llm import (
    bit_sliced,
    decontaminate,
    filter_audit,
    lm_score,
    minhash,
    packing,
    quality_classifier,
    quality_rules,
    spelling_variants,
    substring_dedup,
    suffix_dedup,
    token_counts,
    token_output,
)
from rangewise.llm.common import documents

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.digest(documents(spark, sf_dir))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.counted(documents(spark, sf_dir))


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.digest(decontaminate.decontaminate(
        documents(spark, sf_dir), _table(spark, sf_dir, "benchmark")))


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.suffix_dedup(documents(spark, sf_dir))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_rules(documents(spark, sf_dir)).drop("longest_repeat")


def op7_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.lm_score(documents(spark, sf_dir))


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier.classify(documents(spark, sf_dir), _table(spark, sf_dir, "labels"))


def op9_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_output.round_trip(documents(spark, sf_dir))


def op10_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(documents(spark, sf_dir))


def op11_bit_sliced_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bit_sliced.top_k(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(documents(spark, sf_dir), _table(spark, sf_dir, "labels"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants.variants(documents(spark, sf_dir))


def queries() -> dict[str, Query]:
    return {f.__name__: f for f in (
        op1_substring_dedup, op2_token_counts, op3_best_fit_packing, op4_decontamination,
        op5_suffix_dedup, op6_quality_rules, op7_lm_scoring,
        op8_quality_classifier, op9_token_output, op10_minhash,
        op11_bit_sliced_top_k, op12_filter_audit, op13_spelling_variants)}


_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_SPACED = r"'[^\x20\x09-\x0D]+'"
_WORDS = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"

# A word keeps the white space after it (``tok``), and the first of a line what is
# before it (``lead``), so units tile their line.
_OP1 = rf"""
WITH cut AS (
  SELECT doc_id, string_split(text, chr(10)) AS l FROM documents WHERE text IS NOT NULL
), lines AS (
  SELECT doc_id, unnest(l) AS line, generate_subscripts(l, 1) AS k FROM cut
), placed AS MATERIALIZED (
  SELECT doc_id, k, line, regexp_extract(line, '^[\x09-\x0D\x20]*') AS lead,
         sum(strlen(line) + 1) OVER (PARTITION BY doc_id ORDER BY k) - strlen(line) - 1 AS start
  FROM lines
), toks AS (
  SELECT doc_id, k, unnest(t) AS tok, generate_subscripts(t, 1) AS i
  FROM (SELECT doc_id, k, regexp_extract_all(line, '[^\x09-\x0D\x20]+[\x09-\x0D\x20]*') AS t FROM placed)
), checked AS (
  SELECT *, substr(md5(word), 1, 16) AS h
  FROM (SELECT *, {_LOWER.format(r"regexp_replace(tok, '[\x09-\x0D\x20]+$', '')")} AS word FROM toks)
), begun AS (
  SELECT *, CASE WHEN i = 1 OR {" AND ".join(f"h < coalesce({f}(h, {d}) OVER w, 'g')" for f in ("lag", "lead") for d in range(1, substring_dedup.REACH + 1))} THEN 1 ELSE 0 END AS b
  FROM checked WINDOW w AS (PARTITION BY doc_id, k ORDER BY i)
), dealt AS (
  SELECT *, sum(b) OVER (PARTITION BY doc_id, k ORDER BY i) AS u FROM begun
), split AS (
  SELECT *, (row_number() OVER (PARTITION BY doc_id, k, u ORDER BY i) - 1) // {substring_dedup.LONGEST} AS v FROM dealt
), units AS (
  SELECT doc_id, k, u, v, string_agg(word, ' ' ORDER BY i) AS norm, count(*) AS n_words,
         string_agg(tok, '' ORDER BY i) AS body
  FROM split GROUP BY doc_id, k, u, v
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY k, u, v) AS unit,
         row_number() OVER (PARTITION BY norm ORDER BY doc_id, k, u, v) > 1 AS again FROM units
), islands AS (
  SELECT *, unit - row_number() OVER (PARTITION BY doc_id, again ORDER BY unit) AS island FROM ranked
), ruled AS (
  SELECT *, again AND (sum(n_words) OVER r >= {substring_dedup.RUN_WORDS}
                       OR sum(strlen(norm)) OVER r >= {substring_dedup.RUN_BYTES}) AS gone
  FROM islands WINDOW r AS (PARTITION BY doc_id, again, island)
), located AS (
  SELECT r.*, p.start, CASE WHEN u = 1 AND v = 0 THEN p.lead ELSE '' END || body AS whole,
         sum(strlen(CASE WHEN u = 1 AND v = 0 THEN p.lead ELSE '' END || body))
           OVER (PARTITION BY doc_id, k ORDER BY u, v) + p.start AS finish
  FROM ruled r JOIN placed p USING (doc_id, k)
), spans AS (
  SELECT doc_id, min(finish - strlen(whole)) AS s, max(finish) AS e, count(*) AS c
  FROM (SELECT *, sum(CASE WHEN finish - strlen(whole) = before THEN 0 ELSE 1 END)
                    OVER (PARTITION BY doc_id ORDER BY unit) AS g
        FROM (SELECT *, lag(finish) OVER (PARTITION BY doc_id ORDER BY unit) AS before FROM located WHERE gone))
  GROUP BY doc_id, g
), removed AS (
  SELECT doc_id, sum(c)::BIGINT AS n_removed, sum(e - s)::BIGINT AS removed_bytes,
         string_agg(s::BIGINT || '-' || e::BIGINT, ',' ORDER BY s) AS removed_spans
  FROM spans GROUP BY doc_id
), line_left AS (
  SELECT doc_id, k, count(*) AS n_units, bool_and(gone) AS went,
         coalesce(string_agg(whole, '' ORDER BY u, v) FILTER (WHERE NOT gone), '') AS rest
  FROM located GROUP BY doc_id, k
), left_over AS (
  SELECT doc_id, coalesce(sum(n_units), 0)::BIGINT AS n_units,
         coalesce(string_agg(coalesce(rest, line), chr(10) ORDER BY k)
                  FILTER (WHERE NOT coalesce(went, false)), '') AS text
  FROM placed LEFT JOIN line_left USING (doc_id, k) GROUP BY doc_id
)
SELECT doc_id, n_units, coalesce(n_removed, 0) AS n_removed, coalesce(removed_bytes, 0) AS removed_bytes,
       coalesce(removed_spans, '') AS removed_spans, text
FROM left_over LEFT JOIN removed USING (doc_id)
UNION ALL
SELECT doc_id, 0, 0, 0, '', NULL FROM documents WHERE text IS NULL
"""

_OP4 = rf"""
WITH dw AS (
  SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, {_WORDS}) AS w FROM documents
), iw AS (
  SELECT item_id::VARCHAR AS item_id, regexp_extract_all({_LOWER.format("text")}, {_WORDS}) AS w
  FROM benchmark WHERE text IS NOT NULL AND item_id IS NOT NULL
), item_windows AS (
  SELECT DISTINCT item_id, n, array_to_string(w[p:p + n - 1], ' ') AS win
  FROM (SELECT item_id, w, least({decontaminate.WINDOW}, len(w)) AS n,
               unnest(range(1, len(w) - least({decontaminate.WINDOW}, len(w)) + 2)) AS p
        FROM iw WHERE len(w) > 0)
), doc_windows AS (
  SELECT doc_id, n, p, array_to_string(w[p:p + n - 1], ' ') AS win
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS p
        FROM dw, (SELECT DISTINCT n FROM item_windows) WHERE len(w) >= n)
), found AS (
  SELECT doc_id, n, p, item_id FROM doc_windows JOIN item_windows USING (n, win)
), hits AS (
  SELECT doc_id, count(DISTINCT q) AS n_hit
  FROM (SELECT doc_id, unnest(range(p, p + n)) AS q FROM found) GROUP BY doc_id
), items AS (
  SELECT doc_id, count(*) AS n_items, sha256(string_agg(item_id, ',' ORDER BY item_id)) AS s
  FROM (SELECT DISTINCT doc_id, item_id FROM found) GROUP BY doc_id
)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       coalesce(s, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN hits USING (doc_id) LEFT JOIN items USING (doc_id)
"""

_OP5 = f"""
WITH d AS (
  SELECT doc_id, lower(hex(encode(coalesce(text, '')))) AS h FROM documents
), starts AS MATERIALIZED (
  SELECT doc_id, p, md5(substr(h, 2 * p + 1, {2 * suffix_dedup.LENGTH})) AS win
  FROM (SELECT doc_id, h, unnest(range(0, strlen(h) // 2 - {suffix_dedup.LENGTH} + 1)) AS p
        FROM d WHERE strlen(h) >= {2 * suffix_dedup.LENGTH})
), firsts AS (
  SELECT win, min(doc_id * 1000000000 + p) AS f FROM starts GROUP BY win HAVING count(*) > 1
), again AS (
  SELECT doc_id, p, lag(p) OVER (PARTITION BY doc_id ORDER BY p) AS before
  FROM starts JOIN firsts USING (win) WHERE doc_id * 1000000000 + p <> f
), runs AS (
  SELECT doc_id, p, sum(CASE WHEN p <= before + {suffix_dedup.LENGTH} THEN 0 ELSE 1 END)
           OVER (PARTITION BY doc_id ORDER BY p) AS run FROM again
), spans AS (
  SELECT doc_id, min(p) AS s, max(p) + {suffix_dedup.LENGTH} AS e FROM runs GROUP BY doc_id, run
), gaps AS (
  SELECT doc_id, s, e, coalesce(lag(e) OVER (PARTITION BY doc_id ORDER BY s), 0) AS g FROM spans
), done AS (
  SELECT doc_id, sum(e - s)::BIGINT AS n_removed, count(*) AS n_spans, max(e) AS last,
         string_agg(substr(h, 2 * g + 1, 2 * (s - g)), '' ORDER BY s) AS kept
  FROM gaps JOIN d USING (doc_id) GROUP BY doc_id
)
SELECT doc_id, strlen(h) // 2 AS n_bytes, coalesce(n_removed, 0) AS n_removed,
       coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(coalesce(kept, '') || substr(h, 2 * coalesce(last, 0) + 1))) AS kept_sha256
FROM d LEFT JOIN done USING (doc_id)
"""

_LONG = quality_rules.MAX_LONGEST + 1  # a repeat over the limit has a repeated window of this size
_OP6 = rf"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), {_SPACED}) AS w FROM documents
), windows AS (
  SELECT doc_id, n, p, hash(w[p:p + n - 1]) AS h
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS p
        FROM d, (VALUES ({quality_rules.BASE_WORDS}), ({quality_rules.COVER_WORDS}), ({_LONG})) t(n)
        WHERE len(w) >= n)
), again AS (
  SELECT doc_id, n, p FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, n, h) AS c FROM windows)
  WHERE c > 1
), covered AS (
  SELECT doc_id, count(DISTINCT q) FILTER (WHERE n = {quality_rules.BASE_WORDS}) AS base,
         count(DISTINCT q) FILTER (WHERE n = {quality_rules.COVER_WORDS}) AS cover,
         count(*) FILTER (WHERE n = {_LONG}) AS long
  FROM (SELECT doc_id, n, unnest(range(p, p + n)) AS q FROM again) GROUP BY doc_id
), lines AS (
  SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM d)
  WHERE regexp_matches(line, {_SPACED}) GROUP BY doc_id
), counted AS (
  SELECT doc_id, len(w) AS n_words,
         length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) AS n_symbols,
         coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(base, 0) AS n_repeat_words,
         coalesce(cover, 0) AS n_covered_words, coalesce(long, 0) AS long
  FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN lines USING (doc_id)
), based AS (
  SELECT *, n_words < {quality_rules.BASE_LEAST}
            OR 100 * n_repeat_words > {quality_rules.BASE_COVERED} * n_words AS base_failed
  FROM counted
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND long = 0
         AND 100 * n_covered_words <= {quality_rules.MAX_COVERED} * n_words AS kept,
       n_covered_words
FROM based
"""

_OP10 = rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, {_SPACED}) AS w FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[p:p + {minhash.SHINGLE - 1}], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - {minhash.SHINGLE - 1}, 1) + 1)) AS p
        FROM d WHERE len(w) > 0)
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), links AS (
  SELECT a, b FROM (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS i
    FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY 1, 2)
  JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
  WHERE 100 * i >= {minhash.PERCENT} * (p.n + q.n - i)
), reach AS (
  SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
), least AS (
  SELECT a AS doc_id, min(b) AS b FROM reach GROUP BY a
)
SELECT doc_id, coalesce(n, 0) AS n_shingles, least(doc_id, b) AS component_id,
       doc_id = least(doc_id, b) AS kept
FROM d LEFT JOIN sizes USING (doc_id) LEFT JOIN least USING (doc_id)
"""

_OP11 = f"""
WITH v AS (
  SELECT vec_id, [floor({bit_sliced.SCALE} * x::DOUBLE)::BIGINT FOR x IN embedding] AS q FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), scored AS (
  SELECT a.vec_id AS query_id, b.vec_id,
         coalesce(list_sum([z[1] * z[2] FOR z IN list_zip(a.q, b.q)]), 0)::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id AND len(a.q) = len(b.q)
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS r FROM scored
)
SELECT query_id, r::INTEGER AS rank, vec_id, score FROM ranked WHERE r <= {bit_sliced.TOP}
"""

_OP12 = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), firsts AS (SELECT text, min(doc_id) AS least FROM d GROUP BY text
), f AS (
  SELECT part, (CASE WHEN len(w) < 50 THEN 1 ELSE 0 END)
    + (CASE WHEN 100 * len(list_distinct(w)) < 65 * len(w) THEN 2 ELSE 0 END)
    + (CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]+', '', 'g')) > 5 * length(text) THEN 4 ELSE 0 END)
    + (CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 8 ELSE 0 END)
    + (CASE WHEN coalesce(doc_id > least, false) THEN 16 ELSE 0 END) AS failed,
    EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id AND quality = 1) AS good,
    EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id AND toxic = 1) AS toxic
  FROM d JOIN firsts USING (text)
), c AS (
  SELECT part, failed, count(*) AS n, count(*) FILTER (WHERE good) AS good,
         count(*) FILTER (WHERE toxic) AS toxic FROM f GROUP BY ALL
), orders AS (
  SELECT '' AS o UNION ALL
  SELECT o || x FROM orders, (VALUES ('A'), ('B'), ('C'), ('D'), ('E')) t(x) WHERE NOT contains(o, x)
), steps AS (
  SELECT o, k, list_sum([1 << (ascii(y) - 65) for y in string_split(o[1:k - 1], '') if y <> '']) AS before,
         1 << (ascii(o[k]) - 65) AS bit
  FROM (SELECT o, unnest(range(1, 6)) AS k FROM orders WHERE length(o) = 5)
), e AS (
  SELECT part, o, k, bit, failed, n, good, toxic, (failed & coalesce(before, 0)::INTEGER) = 0 AS met,
         (failed & bit) <> 0 AS fails FROM c, steps
), s AS (
  SELECT part, o, k, bit, coalesce(sum(n) FILTER (WHERE met AND NOT fails), 0)::BIGINT AS kept,
         coalesce(sum(n) FILTER (WHERE met AND fails), 0)::BIGINT AS removed,
         coalesce(sum(n) FILTER (WHERE NOT met AND fails), 0)::BIGINT AS redundant,
         coalesce(sum(n) FILTER (WHERE failed = bit), 0)::BIGINT AS unique_fails,
         coalesce(sum(good) FILTER (WHERE met AND fails), 0)::BIGINT AS good_lost,
         coalesce(sum(toxic) FILTER (WHERE met AND fails), 0)::BIGINT AS toxic_lost
  FROM e GROUP BY part, o, k, bit
)
SELECT part, o AS filter_order, k::INTEGER AS step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       (sum(removed) OVER (PARTITION BY part, bit))::BIGINT AS shapley
FROM s
"""

# A CRC is linear: that of a text is the one of as many zero bytes, changed by
# each byte's own remainder after the bytes behind it (table ``t``).
_RUNS = _LOWER.format(r"unnest(regexp_extract_all(text, '[A-Za-z\x{C0}-\x{FF}]+'))")
_OP13 = rf"""
WITH RECURSIVE one AS (
  SELECT b, 0 AS bit, b::BIGINT AS v FROM range(256) r(b)
  UNION ALL
  SELECT b, bit + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END FROM one WHERE bit < 8
), t0 AS MATERIALIZED (SELECT b, v FROM one WHERE bit = 8
), runs AS MATERIALIZED (
  SELECT doc_id, run, count(*) AS c, coalesce(doc_id::VARCHAR, '') || ':' || run AS s
  FROM (SELECT doc_id, {_RUNS} AS run
        FROM documents) GROUP BY doc_id, run
), t AS (
  SELECT b, 0 AS k, v FROM t0
  UNION ALL
  SELECT t.b, t.k + 1, xor(t.v >> 8, t0.v) FROM t JOIN t0 ON t0.b = t.v & 255
  WHERE t.k < (SELECT max(strlen(s)) FROM runs)
), zeros AS (
  SELECT 0 AS k, 4294967295 AS v
  UNION ALL
  SELECT z.k + 1, xor(z.v >> 8, t0.v) FROM zeros z JOIN t0 ON t0.b = z.v & 255
  WHERE z.k < (SELECT max(strlen(s)) FROM runs)
), bytes AS (
  SELECT doc_id, run, n, n - i - 1 AS k, ('0x' || substr(x, 2 * i + 1, 2))::BIGINT AS b
  FROM (SELECT doc_id, run, strlen(s) AS n, lower(hex(encode(s))) AS x, unnest(range(strlen(s))) AS i FROM runs)
), sums AS (
  SELECT doc_id, run, any_value(n) AS n, bit_xor(t.v) AS v FROM bytes JOIN t USING (k, b) GROUP BY doc_id, run
), checked AS (
  SELECT r.run, r.c, xor(xor(s.v, z.v), 4294967295) AS h FROM runs r
  JOIN sums s ON s.run = r.run AND s.doc_id IS NOT DISTINCT FROM r.doc_id JOIN zeros z ON z.k = s.n
), w AS MATERIALIZED (
  SELECT word, sum(c)::BIGINT AS n FROM (
    SELECT c, CASE WHEN h % {spelling_variants.EDIT_EVERY} <> 0 THEN run
                   ELSE substr(run, 1, (h % length(run))::BIGINT) || substr(run, (h % length(run))::BIGINT + 2) END AS word
    FROM checked)
  WHERE length(word) >= {spelling_variants.LEAST_LETTERS}
  GROUP BY word HAVING sum(c) >= {spelling_variants.LEAST_COUNT}
), cut AS MATERIALIZED (
  SELECT word, substr(word, 1, i - 1) AS a, substr(word, i + 1) AS z
  FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM w)
), near AS (
  SELECT x.word, y.word AS other FROM cut x JOIN cut y ON x.a || '_' || x.z = y.a || '_' || y.z AND x.word <> y.word
  UNION
  SELECT cut.word, w.word FROM cut JOIN w ON w.word = cut.a || cut.z
  UNION
  SELECT w.word, cut.word FROM cut JOIN w ON w.word = cut.a || cut.z
), ranked AS (
  SELECT near.word, other, o.n AS other_n, count(*) OVER (PARTITION BY near.word) AS n_near,
         row_number() OVER (PARTITION BY near.word ORDER BY o.n DESC, encode(other)) AS r
  FROM near JOIN w o ON o.word = other
), formed AS MATERIALIZED (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near,
         CASE WHEN other_n >= {spelling_variants.FORM_TIMES} * w.n THEN other END AS form,
         CASE WHEN other_n >= {spelling_variants.FORM_TIMES} * w.n THEN other_n END AS form_n
  FROM w LEFT JOIN ranked ON ranked.word = w.word AND r = 1
), walk AS (
  SELECT word, word AS root FROM formed
  UNION ALL
  SELECT walk.word, formed.form FROM walk JOIN formed ON formed.word = walk.root WHERE formed.form IS NOT NULL
), ends AS (
  SELECT walk.word, walk.root FROM walk JOIN formed ON formed.word = walk.root WHERE formed.form IS NULL
)
SELECT word, form, root, n, n_near, form_n FROM formed JOIN ends USING (word)
"""


def oracle_sql() -> dict[str, str]:
    """Operators on tokenizer ids and trained models have no SQL; tests hold
    those against brute force."""
    return {"op1_substring_dedup": _OP1, "op4_decontamination": _OP4, "op5_suffix_dedup": _OP5,
            "op6_quality_rules": _OP6, "op10_minhash": _OP10, "op11_bit_sliced_top_k": _OP11,
            "op12_filter_audit": _OP12, "op13_spelling_variants": _OP13}
