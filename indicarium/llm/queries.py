"""The operators' queries over the given tables, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from indicarium.llm.common import table
from indicarium.llm.decontamination import report
from indicarium.llm.embedding_dedup import embedding_components
from indicarium.llm.lexical_search import lexical_search
from indicarium.llm.line_dedup import line_dedup
from indicarium.llm.line_quality import FURNITURE, quality_report
from indicarium.llm.packing import pack
from indicarium.llm.simhash import simhash_components
from indicarium.llm.spelling_variants import spelling_variants
from indicarium.llm.substring_dedup import substring_dedup
from indicarium.llm.suffix_dedup import suffix_dedup
from indicarium.llm.token_counts import token_counts
from indicarium.llm.toxicity import toxicity
from indicarium.llm.warc import pages_through_warc


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(spark, table(spark, sf_dir, "documents"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("spans")


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages_through_warc(spark, table(spark, sf_dir, "pages"))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(spark, table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup(spark, table(spark, sf_dir, "documents")).drop("spans", "kept")


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(spark, table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_components(spark, table(spark, sf_dir, "documents"))


def op8_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_components(spark, table(spark, sf_dir, "embeddings"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup(spark, table(spark, sf_dir, "documents"))


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(spark, table(spark, sf_dir, "documents"))


def op13_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_report(spark, table(spark, sf_dir, "documents")).drop("text")


def llm_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_substring_dedup, op2_decontamination, op3_warc, op4_token_counts, op5_suffix_dedup, op6_packing, op7_simhash, op8_embedding_dedup, op9_toxicity, op10_line_dedup, op11_lexical_search, op12_spelling_variants, op13_quality_rules)}


OP2_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id,
                  list_transform(regexp_extract_all(coalesce(text, ''), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'),
                                 lambda x: translate(x, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS w
           FROM documents),
     b AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item_id,
                  list_transform(regexp_extract_all(coalesce(text, ''), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'),
                                 lambda x: translate(x, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS w
           FROM benchmark),
     win AS (SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS win
             FROM (SELECT item_id, w, least(13, len(w)) AS n, unnest(range(1, greatest(1, len(w) - 12) + 1)) AS i
                   FROM b WHERE len(w) > 0)),
     gram AS (SELECT r, i, d.n, array_to_string(w[i:i + d.n - 1], ' ') AS win
              FROM (SELECT r, w, s.n, unnest(range(1, len(w) - s.n + 2)) AS i
                    FROM d, (SELECT DISTINCT n FROM win) s WHERE len(w) >= s.n) d),
     occ AS (SELECT r, i, g.n, item_id FROM gram g JOIN win USING (n, win)),
     hit AS (SELECT r, count(DISTINCT p) AS n_hit
             FROM (SELECT r, unnest(range(i, i + n)) AS p FROM occ) GROUP BY r),
     it AS (SELECT r, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
            FROM (SELECT DISTINCT r, item_id FROM occ) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit USING (r) LEFT JOIN it USING (r)
"""


OP3_SQL = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
     q AS (SELECT page_id, CAST(octet_length(payload) AS BIGINT) AS payload_bytes, sha1(payload) AS payload_digest,
                  max(page_id) OVER (PARTITION BY payload) AS best
           FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id <> best THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id <> best THEN best END AS refers_to
FROM q
"""


OP10_SQL = r"""
WITH d AS (SELECT DISTINCT doc_id, text FROM documents WHERE text IS NOT NULL),
     l AS (SELECT doc_id, pos, list_transform(regexp_split_to_array(trim(line, concat(' ', chr(9), chr(13), chr(12), chr(11))), '[ \t\r\f\x0B]+'),
                                             lambda t: CASE WHEN regexp_matches(t, '[0-9]') THEN '<*>' ELSE t END) AS words
           FROM (SELECT doc_id, unnest(range(len(string_split(text, chr(10))))) AS pos, unnest(string_split(text, chr(10))) AS line FROM d)),
     k AS (SELECT doc_id, pos, words, len(words) AS n, words[1:4] AS head FROM l WHERE len(words) >= 4),
     tok AS (SELECT n, head, p, token, count(*) AS c
             FROM (SELECT n, head, unnest(range(n)) AS p, unnest(words) AS token FROM (SELECT DISTINCT doc_id, n, head, words FROM k)) GROUP BY ALL),
     tpl AS (SELECT n, head, list(CASE WHEN 2 * c > total THEN token END ORDER BY p) AS template
             FROM (SELECT n, head, p, sum(c) AS total, max(c) AS c, arg_max(token, c) AS token FROM tok GROUP BY n, head, p) GROUP BY n, head),
     f AS (SELECT doc_id, pos, n, head FROM k JOIN tpl USING (n, head)
           WHERE len(list_filter(list_zip(words, template), lambda z: z[1] = z[2] AND z[2] <> '<*>')) >= 0.5 * n
                 AND len(list_filter(list_zip(words[5:], template[5:]), lambda z: z[1] = z[2])) >= 0.5 * (n - 4)),
     r AS (SELECT n, head, min(doc_id) AS first FROM f GROUP BY n, head HAVING count(DISTINCT doc_id) >= 10),
     e AS (SELECT words, min(doc_id) AS first FROM k WHERE n >= 8 AND len(list_filter(words, lambda t: t <> '<*>')) >= 0.5 * n
           GROUP BY words HAVING count(DISTINCT doc_id) >= 2),
     x AS (SELECT DISTINCT doc_id, pos FROM f JOIN r USING (n, head) WHERE doc_id <> first
           UNION SELECT DISTINCT doc_id, pos FROM k JOIN e USING (words) WHERE doc_id <> first),
     o AS (SELECT d.doc_id, d.text, i.pos, i.line, x.pos IS NOT NULL AS gone
           FROM d JOIN (SELECT doc_id, unnest(range(len(string_split(text, chr(10))))) AS pos, unnest(string_split(text, chr(10))) AS line FROM d) i USING (doc_id)
                LEFT JOIN x ON x.doc_id = i.doc_id AND x.pos = i.pos)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped, coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '') AS text
FROM o GROUP BY doc_id
UNION ALL
SELECT doc_id, 0, 0, NULL FROM documents WHERE text IS NULL
"""


OP11_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id,
                  list_transform(regexp_extract_all(coalesce(text, ''), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'),
                                 lambda x: translate(x, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS w
           FROM documents),
     b AS (SELECT row_number() OVER () AS i, item_id,
                  list_distinct(list_transform(regexp_extract_all(coalesce(text, ''), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'),
                                               lambda x: translate(x, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'))) AS w
           FROM benchmark),
     c AS (SELECT count(*) AS nd, CAST(sum(len(w)) AS BIGINT) AS l FROM d WHERE len(w) > 0),
     q AS (SELECT i, item_id, unnest(w) AS t FROM b),
     tf AS (SELECT r, t, count(*) AS tf FROM (SELECT r, unnest(w) AS t FROM d) WHERE t IN (SELECT t FROM q) GROUP BY r, t),
     wt AS (SELECT t, CAST(floor(1000 * ln(CAST(2 * nd + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS weight FROM tf, c GROUP BY t, nd),
     s AS (SELECT i, r, CAST(sum(weight * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * len(d.w) * nd) // l)))) AS BIGINT) AS score
           FROM (SELECT i, t FROM q) JOIN tf USING (t) JOIN wt USING (t) JOIN (SELECT r, w FROM d) d USING (r), c GROUP BY i, r),
     k AS (SELECT i, r, score, CAST(row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id ASC NULLS LAST) AS INTEGER) AS rank
           FROM s JOIN (SELECT r, doc_id FROM d) USING (r) WHERE score > 0)
SELECT b.item_id, k.rank, d.doc_id, k.score FROM k JOIN b USING (i) JOIN d USING (r) WHERE k.rank <= 10
"""


OP13_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
     ln AS (SELECT r, unnest(range(len(string_split(text, chr(10))))) AS pos, unnest(string_split(text, chr(10))) AS line FROM d),
     lw AS (SELECT r, pos, line, list_filter(regexp_split_to_array(line, '[ \t\x0B\f\r]+'), lambda x: x <> '') AS w FROM ln),
     m AS (SELECT r, pos, line, len(w) AS n, CAST(length(array_to_string(w, '')) AS BIGINT) AS chars, lower(line) AS low,
                  row_number() OVER (PARTITION BY r, line ORDER BY pos) > 1 AS late,
                  len(regexp_extract_all(line, '[!-/:-@\[-`{-~]')) AS marks,
                  len(list_filter(w, lambda x: regexp_full_match(x, '[|>/*\x{b7}\x{2022}\x{bb}\x{203a}\x{2192}-]{1,2}'))) AS seps
           FROM lw WHERE len(w) > 0),
     f AS (SELECT r, chars, late,
                  marks * 100 > chars * 15 OR (n >= 20 AND NOT regexp_matches(line, '[.,;:!?\x{2026}\x{3002}\x{ff0c}\x{ff01}\x{ff1f}\x{60c}\x{61f}\x{964}]')) AS punctuation,
                  seps >= 3 AND n <= 5 * seps AS navigation,
                  late OR (n <= 30 AND len(list_filter([@FURNITURE@], lambda x: contains(low, x))) > 0) AS boilerplate
           FROM m),
     l AS (SELECT r, count(*) AS n_lines, count(*) FILTER (late) AS n_dup_lines, count(*) FILTER (punctuation) AS n_punctuation,
                  count(*) FILTER (navigation) AS n_navigation, count(*) FILTER (boilerplate) AS n_boilerplate,
                  CAST(coalesce(sum(chars) FILTER (punctuation OR navigation OR boilerplate), 0) AS BIGINT) AS lost_chars
           FROM f GROUP BY r),
     w AS (SELECT r, list_filter(regexp_split_to_array(text, '[ \t\n\x0B\f\r]+'), lambda x: x <> '') AS w FROM d),
     win AS (SELECT r, i, count(*) OVER (PARTITION BY r, w[i:i + 7]) AS c
             FROM (SELECT r, w, unnest(range(1, len(w) - 6)) AS i FROM w WHERE len(w) >= 8)),
     rep AS (SELECT r, count(DISTINCT p) AS n_repeat_words FROM (SELECT r, unnest(range(i, i + 8)) AS p FROM win WHERE c > 1) GROUP BY r),
     q AS (SELECT doc_id, CAST(len(w.w) AS BIGINT) AS n_words, CAST(length(array_to_string(w.w, '')) AS BIGINT) AS word_chars,
                  CAST(len(regexp_extract_all(text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines,
                  coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(n_lines, 0) AS n_lines, coalesce(n_punctuation, 0) AS n_punctuation,
                  coalesce(n_navigation, 0) AS n_navigation, coalesce(n_boilerplate, 0) AS n_boilerplate, coalesce(lost_chars, 0) AS lost_chars
           FROM d JOIN w USING (r) LEFT JOIN l USING (r) LEFT JOIN rep USING (r)),
     v AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM q)
SELECT *, NOT base_failed AND 100 * lost_chars <= 50 * word_chars AS kept FROM v
""".replace("@FURNITURE@", ", ".join(f"'{x}'" for x in FURNITURE))


def llm_oracle_sql() -> dict[str, str]:
    return {"op2_decontamination": OP2_SQL, "op3_warc": OP3_SQL, "op10_line_dedup": OP10_SQL, "op11_lexical_search": OP11_SQL, "op13_quality_rules": OP13_SQL}
