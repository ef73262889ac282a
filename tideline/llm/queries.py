"""The queries of the operators over the given tables, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    alignment,
    bagminhash,
    curriculum,
    fill_in_middle,
    language,
    line_runs,
    neighbours,
    packing,
    repetition,
    resampling,
    suffixes,
    token_counts,
    token_files,
)
from .common import table

BYTE_BPE = "byte_bpe_50k.json"
WORD_BPE = "word_bpe_49k.json"
PIECE_BPE = "piece_bpe_32k.model"


def tokenizer_path(name: str) -> str:
    """Place of a public tokenizer file; it is the same on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest_neighbours(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), tokenizer_path(BYTE_BPE))


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_file_round_trip(table(spark, sf_dir, "documents"), tokenizer_path(BYTE_BPE))


def op4_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.importance_resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bagminhash.near_duplicates(table(spark, sf_dir, "documents"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_path(WORD_BPE))


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify_held_out(table(spark, sf_dir, "documents"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = curriculum.curriculum(table(spark, sf_dir, "documents")).orderBy(F.asc_nulls_last("position"), "doc_id")
    return rows.select("doc_id", "size", "source_size", "target", "taken", "position")


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = repetition.quality_rules(table(spark, sf_dir, "documents"))
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.remove_repeats(table(spark, sf_dir, "documents"))


def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = line_runs.drop_frequent_lines(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fill_in_middle.fill_in_middle(table(spark, sf_dir, "documents"))
    text = fill_in_middle.restored(F.col("output"), F.col("form"))
    return rows.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"), F.sha2(text, 256).alias("restored_sha256"),
    )


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align_tokenizers(table(spark, sf_dir, "documents"), tokenizer_path(BYTE_BPE), tokenizer_path(PIECE_BPE))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_nearest_neighbours": op1_nearest_neighbours,
        "op2_token_counts": op2_token_counts,
        "op3_token_files": op3_token_files,
        "op4_resampling": op4_resampling,
        "op5_near_duplicates": op5_near_duplicates,
        "op6_packing": op6_packing,
        "op7_language": op7_language,
        "op8_mixing": op8_mixing,
        "op9_quality_rules": op9_quality_rules,
        "op10_suffix_dedup": op10_suffix_dedup,
        "op11_line_dedup": op11_line_dedup,
        "op12_fill_in_middle": op12_fill_in_middle,
        "op13_alignment": op13_alignment,
    }


# Words are runs of other than blank, tab, newline, vertical tab, form feed and return.
_WORD = r"[^\x20\x09-\x0D]+"

_OP8 = f"""
WITH sized AS (
  SELECT doc_id, source, md5(coalesce(doc_id::VARCHAR, '')) AS key,
         len(regexp_extract_all(coalesce(text, ''), '{_WORD}'))::BIGINT AS size
  FROM documents
), sources AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source
), placed AS (
  SELECT *, [5.0::DOUBLE, 2.0::DOUBLE, 1.0::DOUBLE][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3)::INT + 1] AS weight,
         row_number() OVER (ORDER BY source NULLS LAST) AS place, 2.0::DOUBLE * source_size AS cap
  FROM sources
), levels AS (
  SELECT *, (1.5::DOUBLE * (SELECT sum(source_size) FROM placed)
             - coalesce(sum(cap) OVER (ORDER BY cap / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(weight) OVER (ORDER BY cap / weight, place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level,
         row_number() OVER (ORDER BY cap / weight, place) AS n
  FROM placed
), free AS (
  SELECT n, level FROM levels WHERE level * weight <= cap ORDER BY n LIMIT 1
), targets AS (
  SELECT l.source, l.source_size, [-0.5::DOUBLE, 0.0::DOUBLE, 0.5::DOUBLE][((l.place - 1) % 3)::INT + 1] AS slope,
         CASE WHEN f.n IS NULL OR l.n < f.n THEN l.cap ELSE f.level * l.weight END AS target
  FROM levels l LEFT JOIN free f ON true
), ordered AS (
  SELECT s.*, t.source_size, t.target, t.slope,
         coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.key, s.doc_id, s.size
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
), middles AS (
  SELECT *, (2 * before + size)::DOUBLE / 2 AS first, (2 * (before + source_size) + size)::DOUBLE / 2 AS second
  FROM ordered
), reached AS (
  SELECT *, target > 0 AND first <= target AS once, target > 0 AND second <= target AS twice,
         first / nullif(target, 0) AS part
  FROM middles
)
SELECT doc_id, size, source_size, target, (size * (once::INT + twice::INT))::BIGINT AS taken,
       CASE WHEN once AND slope = 0 THEN part
            WHEN once THEN greatest(0.0::DOUBLE, least(1.0::DOUBLE,
              (slope - 1 + sqrt((1 - slope) * (1 - slope) + 4 * slope * part)) / (2 * slope))) END AS position
FROM reached
"""

_OP9 = f"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '{_WORD}') AS words
  FROM documents
), starts AS (
  SELECT r, words, unnest(range(1, len(words) - 3)) AS p FROM docs
), windows AS (
  SELECT r, p, words[p:p + 4] AS w, CASE WHEN p + 64 <= len(words) THEN words[p:p + 64] END AS long FROM starts
), again AS (
  SELECT r, unnest(range(p, p + 5)) AS word
  FROM (SELECT r, p, count(*) OVER (PARTITION BY r, w) AS n FROM windows) WHERE n > 1
), repeats AS (
  SELECT r, count(DISTINCT word) AS n_repeat_words FROM again GROUP BY r
), longs AS (
  SELECT DISTINCT r FROM (SELECT r FROM windows WHERE long IS NOT NULL GROUP BY r, long HAVING count(*) > 1)
), lines AS (
  SELECT r, line, count(*) AS n FROM (SELECT r, unnest(string_split(text, chr(10))) AS line FROM docs)
  WHERE regexp_matches(line, '{_WORD}') GROUP BY r, line
), dup AS (
  SELECT r, sum(n - 1) AS n_dup_lines FROM lines GROUP BY r
), measured AS (
  SELECT d.r, doc_id, len(words)::BIGINT AS n_words,
         length(regexp_replace(text, '[\\x20\\x09-\\x0D]', '', 'g'))::BIGINT AS word_chars,
         (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
         l.r IS NOT NULL AS has_long
  FROM docs d LEFT JOIN dup USING (r) LEFT JOIN repeats USING (r) LEFT JOIN longs l USING (r)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
       NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words OR has_long) AS kept
FROM measured
"""

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

_OP11 = f"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
), lines AS (
  SELECT r, unnest(range(1, len(lines) + 1)) AS p, unnest(lines) AS line FROM docs
), keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '{_UPPER}', '{_UPPER.lower()}') AS key
  FROM lines
), frequent AS (
  SELECT key FROM keyed WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT r) >= 10
), marked AS (
  SELECT k.*, f.key IS NOT NULL AS dropped FROM keyed k LEFT JOIN frequent f ON k.key = f.key
), joined AS (
  SELECT r, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
         coalesce(string_agg(line, chr(10) ORDER BY p) FILTER (NOT dropped), '') AS kept
  FROM marked GROUP BY r
)
SELECT doc_id, n_lines::BIGINT AS n_lines, n_dropped::BIGINT AS n_dropped, sha256(kept) AS kept_sha256
FROM docs JOIN joined USING (r)
"""

_TOKEN = r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+"

_OP12 = f"""
WITH hashed AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{_TOKEN}') AS tokens,
         sha256('42:' || coalesce(doc_id::VARCHAR, '')) AS h
  FROM documents
), drawn AS (
  SELECT *, len(tokens) AS n, ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2,
         ('0x' || h[17:24])::BIGINT AS h3, ('0x' || h[25:32])::BIGINT AS h4
  FROM hashed
), cuts AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 50 THEN 'plain'
              WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
  FROM drawn
), parts AS (
  SELECT *, array_to_string(tokens[1:a], '') AS prefix, array_to_string(tokens[a + 1:b], '') AS middle,
         array_to_string(tokens[b + 1:n], '') AS suffix
  FROM cuts
)
SELECT doc_id, n::BIGINT AS n, form,
       CASE WHEN form <> 'plain' THEN length(prefix) END::BIGINT AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle) END::BIGINT AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM parts
"""


def oracle_sql() -> dict[str, str]:
    return {"op8_mixing": _OP8, "op9_quality_rules": _OP9, "op11_line_dedup": _OP11, "op12_fill_in_middle": _OP12}
