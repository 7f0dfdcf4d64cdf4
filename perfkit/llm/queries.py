"""The registered query of each operator, with production parameters, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from perfkit.llm import (best_fit_packing, byte_bpe, decontaminate, html_extract, quality_rules, simhash_dups,
                         source_divergence, spelling_variants, substring_dedup, suffix_dedup, token_files, toxicity,
                         warc)
from perfkit.llm.common import table


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    chunks = warc.warc_roundtrip(table(spark, sf_dir, "pages"))
    return chunks.where("last").select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op3_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract_pages(table(spark, sf_dir, "pages")).drop("path")


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring_dedup.substring_dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.suffix_dedup(table(spark, sf_dir, "documents"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = quality_rules.quality_rules(docs, features=True)
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      "base_failed", "kept")


def op7_simhash_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (simhash_dups.simhash_components(table(spark, sf_dir, "documents"))
            .select("doc_id", "fingerprint", "component_id"))


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decontaminate.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_words", "n_hit", "n_items",
                      F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), "contaminated")


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.bpe_roundtrip(table(spark, sf_dir, "documents"),
                                  public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_files(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                                   public_tokenizers.PATTERN)


def op11_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_fit_packing.pack_documents(table(spark, sf_dir, "documents"),
                                           public_tokenizers.path("word_bpe_49k.json"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants.spelling_variants(table(spark, sf_dir, "documents"))


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence.source_divergence(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_toxicity, op2_warc, op3_html_extract, op4_substring_dedup, op5_suffix_dedup, op6_quality_rules,
        op7_simhash_dups, op8_decontaminate, op9_byte_bpe, op10_token_files, op11_best_fit_packing,
        op12_spelling_variants, op13_source_divergence)
}

_OP13 = r"""
WITH docs AS (
  SELECT row_number() OVER () AS row_no, COALESCE(lang, '') AS lang, COALESCE(source, '') AS source,
         translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
  FROM documents),
hits AS (
  SELECT row_no, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM docs),
kept AS (
  SELECT lang, term, count(*) AS n FROM hits GROUP BY lang, term HAVING count(DISTINCT row_no) >= 3),
langs AS (SELECT lang, sum(n)::HUGEINT AS total, count(*)::HUGEINT AS size FROM kept GROUP BY lang),
counted AS (
  SELECT h.lang, h.source, h.term, count(*) AS n
  FROM hits h JOIN kept k ON h.lang = k.lang AND h.term = k.term GROUP BY ALL),
groups AS (
  SELECT g.lang, g.source, COALESCE(c.total, 0)::HUGEINT AS total
  FROM (SELECT DISTINCT lang, source FROM docs) g
  LEFT JOIN (SELECT lang, source, sum(n) AS total FROM counted GROUP BY lang, source) c
    ON g.lang = c.lang AND g.source = c.source),
shares AS (
  SELECT g.lang, g.source, k.term, COALESCE(c.n, 0) AS n,
         1 + (1000000000::HUGEINT * (COALESCE(c.n, 0) + 1)) // (g.total + l.size) AS p,
         1 + (1000000000::HUGEINT * (k.n + 1)) // (l.total + l.size) AS q
  FROM groups g JOIN kept k ON g.lang = k.lang JOIN langs l ON l.lang = g.lang
  LEFT JOIN counted c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
  GROUP BY ALL),
every_pair AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, COALESCE(p.value, 0)::BIGINT AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pairs p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source),
terms AS (
  SELECT lang, source, 'term' AS part, term AS item, (((p - q) * (p - q)) // q)::BIGINT AS value
  FROM shares WHERE n > 0 AND p > q),
ranked AS (
  SELECT *, (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INTEGER AS rank
  FROM (SELECT * FROM every_pair UNION ALL SELECT * FROM terms))
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 200
"""

_OP2 = """
WITH p AS (
  SELECT page_id, COALESCE(html, '') AS html, min(page_id) OVER (PARTITION BY COALESCE(html, '')) AS first FROM pages),
d AS (SELECT *, sha1(html) AS h FROM p)
SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(1 +
         ((CAST('0x' || substr(h, CAST(i // 4 * 5 + 1 AS INTEGER), 5) AS BIGINT) // (1 << CAST(15 - 5 * (i % 4) AS INTEGER))) % 32)
         AS INTEGER), 1)), '') AS payload_digest,
       CASE WHEN page_id > first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id > first THEN first END AS refers_to
FROM d
"""

_WORDS = r"""
WITH docs AS (
  SELECT row_number() OVER () AS row_no, doc_id, COALESCE(text, '') AS text,
         regexp_extract_all(COALESCE(text, ''), '[^\x20\x09-\x0D]+') AS words
  FROM documents)"""

_OP4 = _WORDS + """,
starts AS (
  SELECT row_no, doc_id, unnest(range(1, len(words) - 48)) AS pos,
         unnest(list_transform(range(1, len(words) - 48), lambda i: md5(array_to_string(words[i:i + 49], ' ')))) AS h
  FROM docs WHERE len(words) >= 50),
again AS (SELECT row_no, pos FROM (SELECT *, min(doc_id) OVER (PARTITION BY h) AS first FROM starts) WHERE first < doc_id),
gone AS (SELECT DISTINCT row_no, pos + k AS pos FROM again, range(0, 50) r(k)),
each AS (SELECT row_no, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS pos FROM docs),
kept AS (
  SELECT row_no, count(*) AS n, string_agg(word, ' ' ORDER BY pos) AS text
  FROM each ANTI JOIN gone USING (row_no, pos) GROUP BY row_no)
SELECT doc_id, len(words) AS n_words, len(words) - COALESCE(n, 0) AS n_removed,
       sha256(COALESCE(kept.text, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (row_no)
"""

_OP6 = _WORDS + r""",
grams AS (
  SELECT row_no, unnest(range(1, len(words) - 6)) AS pos,
         unnest(list_transform(range(1, len(words) - 6), lambda i: array_to_string(words[i:i + 7], ' '))) AS gram
  FROM docs WHERE len(words) >= 8),
twice AS (SELECT row_no, pos FROM (SELECT *, count(*) OVER (PARTITION BY row_no, gram) AS n FROM grams) WHERE n >= 2),
covered AS (
  SELECT row_no, count(*) AS n FROM (SELECT DISTINCT row_no, pos + k FROM twice, range(0, 8) r(k)) GROUP BY row_no),
lines AS (
  SELECT row_no, count(*) - count(DISTINCT line) AS n FROM (SELECT row_no, unnest(string_split(text, chr(10))) AS line FROM docs)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY row_no),
base AS (
  SELECT d.doc_id, len(words) AS n_words, CAST(COALESCE(list_sum(list_transform(words, lambda w: length(w))), 0) AS BIGINT) AS word_chars,
         length(text) - length(translate(text, '#*$%&|<>', '')) AS n_symbols, COALESCE(l.n, 0) AS n_dup_lines,
         COALESCE(c.n, 0) AS n_repeat_words, length(text) - length(replace(text, chr(10), '')) + 1 AS n_lines,
         len(list_filter(words, lambda w: contains(w, '!'))) AS n_shouted,
         len(list_filter(words, lambda w: contains(w, '|'))) AS n_barred,
         len(list_filter(words, lambda w: NOT regexp_matches(w, '[^\x00-\x40\x5B-\x60\x7B-\x7F]'))) AS n_letterless
  FROM docs d LEFT JOIN covered c USING (row_no) LEFT JOIN lines l USING (row_no)),
judged AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM base)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR 100 * n_symbols > 10 * word_chars OR word_chars < 2 * greatest(n_words, 1)
            OR word_chars > 30 * greatest(n_words, 1) OR 100 * n_dup_lines > 60 * n_lines OR 100 * n_shouted > 60 * n_words
            OR 100 * n_barred > 25 * n_words OR 100 * n_letterless > 50 * n_words) AS kept
FROM judged
"""

_OP8 = r"""
WITH docs AS (
  SELECT row_number() OVER () AS row_no, doc_id, regexp_extract_all(translate(COALESCE(text, ''),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM documents),
items AS (
  SELECT item_id, regexp_extract_all(translate(COALESCE(text, ''),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM benchmark),
sought AS (
  SELECT DISTINCT item_id, least(len(words), 13) AS k, unnest(list_transform(range(1, greatest(len(words) - 11, 2)),
           lambda i: array_to_string(words[i:i + 12], ' '))) AS gram
  FROM items WHERE len(words) > 0),
sizes AS (SELECT DISTINCT k FROM sought),
grams AS (
  SELECT row_no, k, unnest(range(1, len(words) - k + 2)) AS pos, unnest(list_transform(range(1, len(words) - k + 2),
           lambda i: array_to_string(words[i:i + k - 1], ' '))) AS gram
  FROM docs, sizes WHERE len(words) >= k),
found AS (SELECT row_no, item_id, g.k, pos FROM grams g JOIN sought s ON g.k = s.k AND g.gram = s.gram),
hit AS (SELECT row_no, count(*) AS n FROM (SELECT DISTINCT row_no, unnest(range(pos, pos + k)) FROM found) GROUP BY row_no),
named AS (
  SELECT row_no, count(*) AS n, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT row_no, CAST(item_id AS VARCHAR) AS id FROM found) GROUP BY row_no)
SELECT doc_id, len(words) AS n_words, COALESCE(hit.n, 0) AS n_hit, COALESCE(named.n, 0) AS n_items,
       sha256(COALESCE(ids, '')) AS items_sha256, COALESCE(hit.n, 0) > 0 AND 20 * hit.n >= len(words) AS contaminated
FROM docs LEFT JOIN hit USING (row_no) LEFT JOIN named USING (row_no)
"""

ORACLE_SQL: dict[str, str] = {"op2_warc": _OP2, "op4_substring_dedup": _OP4, "op6_quality_rules": _OP6,
                              "op8_decontaminate": _OP8, "op13_source_divergence": _OP13}
