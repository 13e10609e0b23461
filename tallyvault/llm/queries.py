"""The registered queries of the operators, their contracts' columns, and SQL where SQL can say it."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (decontamination, html_extract, jaccard_join, knn_join, license_scan, line_dedup, pii, quality_rules, sentencepieces,
               substring_dedup, token_files, vector_codes, whitening)
from .common import documents

_W = r"[^\x20\x09-\x0D]+"


def tokenizer_path(name: str) -> str:
    """Place of a public tokenizer's file, the same on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepieces.encode_and_decode(documents(spark, sf_dir), tokenizer_path("piece_bpe_32k.model"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.find_leaks(documents(spark, sf_dir), documents(spark, sf_dir, "benchmark"))


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(documents(spark, sf_dir))


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_personal_data(documents(spark, sf_dir))


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_report(documents(spark, sf_dir))


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_report(documents(spark, sf_dir), tokenizer_path("byte_bpe_50k.json"))


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.substring_report(documents(spark, sf_dir))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_report(documents(spark, sf_dir))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_report(documents(spark, sf_dir))


def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract_main_text(documents(spark, sf_dir, "pages"))


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whitened components of every whole vector; ``deviation`` as a long (null beyond 64 bits), and in full as ``deviation_38``."""
    return whitening.whiten(documents(spark, sf_dir, "embeddings")).select(
        "vec_id", "component", "n", F.expr("try_cast(deviation AS long)").alias("deviation"), "whitened", "explained", "identity_error",
        F.col("deviation").alias("deviation_38"))


def op12_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best other rows of every row whose vec_id is divisible by 50."""
    return knn_join.top_k(documents(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes and errors of every whole vector."""
    return vector_codes.compress(documents(spark, sf_dir, "embeddings")).drop("label")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (
        op1_sentencepiece, op2_decontamination, op3_license_scan, op4_pii, op5_jaccard_join, op6_token_files,
        op7_substring_dedup, op8_quality_rules, op9_line_dedup, op10_html_extraction, op11_embedding_whitening, op12_exact_top_k,
        op13_vector_codes)}


OP9_SQL = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
lines AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
         generate_subscripts(string_split(text, chr(10)), 1) AS pos
  FROM d),
keyed AS (
  SELECT doc_id, pos, line,
         translate(trim(line, chr(32)||chr(9)||chr(10)||chr(11)||chr(12)||chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM lines),
frequent AS (
  SELECT k FROM keyed WHERE length(k) >= 1 GROUP BY k HAVING count(DISTINCT doc_id) >= 10),
marked AS (
  SELECT x.doc_id, x.pos, x.line, f.k IS NOT NULL AS gone
  FROM keyed x LEFT JOIN frequent f ON x.k = f.k)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

OP8_SQL = r"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS text FROM documents),
w AS (
  SELECT doc_id, source, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w,
         list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS l
  FROM d),
windows AS (
  SELECT doc_id, p, w[p] AS a, w[p + 1] AS b, w[p + 2] AS c
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS p FROM w)),
again AS (
  SELECT x.doc_id, x.p FROM windows x
  JOIN (SELECT doc_id, a, b, c FROM windows GROUP BY ALL HAVING count(*) > 1) y
    ON x.doc_id = y.doc_id AND x.a = y.a AND x.b = y.b AND x.c = y.c),
covered AS (
  SELECT doc_id, count(DISTINCT q) AS n
  FROM (SELECT doc_id, unnest([p, p + 1, p + 2]) AS q FROM again) GROUP BY doc_id),
base AS (
  SELECT w.doc_id, source, text, l, len(w) AS n_words,
         coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS word_chars,
         length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
         len(l) - len(list_distinct(l)) AS n_dup_lines, coalesce(covered.n, 0) AS n_repeat_words
  FROM w LEFT JOIN covered ON w.doc_id = covered.doc_id),
keys AS (
  SELECT doc_id, source, text,
         translate(trim(line, chr(32)||chr(9)||chr(10)||chr(11)||chr(12)||chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k,
         len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS n
  FROM (SELECT doc_id, source, text, unnest(l) AS line FROM base)),
boilerplate AS (SELECT source, k FROM keys GROUP BY source, k HAVING count(DISTINCT text) >= 20),
lost AS (
  SELECT doc_id, sum(n) AS n FROM keys
  JOIN boilerplate b ON keys.source IS NOT DISTINCT FROM b.source AND keys.k = b.k
  GROUP BY doc_id),
judged AS (
  SELECT base.*, n_words - coalesce(lost.n, 0) AS n_words_left,
         n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed
  FROM base LEFT JOIN lost ON base.doc_id = lost.doc_id)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
       n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, base_failed,
       NOT base_failed AND 100 * n_words_left >= 30 * n_words AS kept,
       n_words_left::BIGINT AS n_words_left
FROM judged
"""


def _sql_text(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _re2(pattern: str) -> str:
    return re.sub(r"\\u([0-9A-F]{4})", r"\\x{\1}", pattern)


def _low_sql(text: str) -> str:
    upper = license_scan._UPPER
    return f"translate({text}, {_sql_text(upper + license_scan._NO_WIDTH)}, {_sql_text(upper.lower())})"


def _holder_sql(line: str) -> str:
    """Whether a lower-cased line names a copyright holder (``license_scan.HOLDER_LINE`` on one line, without looking ahead)."""
    head, gap = r"^[^a-z0-9\n(©]*", r"[^a-z0-9\n]*"
    signed = head + rf"(copyright\b{gap}(\(c\)|©|[0-9]{{4}}|<|\[|\{{)|\(c\){gap}([0-9]{{4}}|copyright\b)|©)"
    word = head + rf"copyright\b{gap}"
    return (f"(regexp_matches({line}, {_sql_text(signed)}) OR (regexp_matches({line}, {_sql_text(word + '[a-z]')})"
            f" AND NOT regexp_matches({line}, {_sql_text(word + '(' + license_scan._NO_NAME + r')\b')})))")


def _words_sql(text: str) -> str:
    """The canonical form of a lower-cased text without its holders' lines."""
    c = f"regexp_replace({text}, {_sql_text(_re2(license_scan.ANY_PUNCTUATION))}, ' ', 'g')"
    for pattern, replacement in license_scan.SPELLINGS:
        c = f"regexp_replace({c}, {_sql_text(pattern)}, {_sql_text(replacement.replace('$', chr(92)))}, 'g')"
    return f"trim({c})"


def op3_sql() -> str:
    """The scan in SQL, from the same fixed values: texts and notices that are known, and the digests of long texts."""
    known = ", ".join(f"({_sql_text(name)}, {_sql_text(text)})" for name, text in license_scan.KNOWN + license_scan.FORMS)
    digests = ", ".join(f"({_sql_text(name)}, {_sql_text(digest)})" for name, digest in license_scan.DIGESTS)
    reserved = _sql_text(r"^[^a-z0-9\n]*all rights reserved[^a-z0-9\n]*$")
    return f"""
WITH known AS (
  SELECT license, sha256({_words_sql(_low_sql("text"))}) AS digest FROM (VALUES {known}) v(license, text)
  UNION
  SELECT license, digest FROM (VALUES {digests}) v(license, digest)),
d AS (
  SELECT row_number() OVER () AS r, doc_id, string_split({_low_sql("coalesce(text, '')")}, chr(10)) AS l FROM documents),
told AS (
  SELECT r, doc_id, l, list_transform(l, lambda x: {_holder_sql("x")}) AS holder,
         list_max(list_transform(range(1, len(l) + 1), lambda i: CASE WHEN regexp_matches(l[i], '[a-z0-9]') THEN i ELSE 0 END)) AS last
  FROM d),
units AS (
  SELECT r, doc_id, true AS whole, array_to_string(list_transform(range(1, len(l) + 1), lambda i:
    CASE WHEN holder[i] OR (i > 1 AND i < last AND holder[i - 1] AND regexp_matches(l[i], {reserved})) THEN '' ELSE l[i] END), chr(10)) AS t
  FROM told
  UNION ALL
  SELECT r, doc_id, false AS whole,
         unnest(list_transform(range(1, len(l) + 1), lambda i: CASE WHEN holder[i] THEN '' ELSE l[i] END)) AS t
  FROM told),
formed AS (SELECT r, doc_id, whole, {_words_sql("t")} AS c FROM units)
SELECT doc_id, license, bool_or(whole) AS whole_text, count(*) FILTER (NOT whole) AS n_lines
FROM (SELECT r, doc_id, whole, sha256(c) AS digest FROM formed WHERE c != '') JOIN known USING (digest)
GROUP BY r, doc_id, license
"""


def oracle_sql() -> dict[str, str]:
    return {"op3_license_scan": op3_sql(), "op8_quality_rules": OP8_SQL, "op9_line_dedup": OP9_SQL}
