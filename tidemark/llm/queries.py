"""The operators, each applied to its whole table, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    alignment, decontaminate, exact, jaccard, language, licenses, lines, packing, quality, secrets, spelling, suffix, tokens,
)
from tidemark.session import scratch_path

TOKENIZER = "word_bpe_49k.json"
PIECES = "piece_bpe_32k.model"
BYTES = "byte_bpe_50k.json"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return secrets.digest(secrets.find_secrets(docs, secrets.fit(secrets.labelled(docs))))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.line_classes(table(spark, sf_dir, "documents"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = language.backoff_scores(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", F.round("mean_log_score", 6).alias("mean_log_score"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.rate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_duplicates(table(spark, sf_dir, "documents"))


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With what is left as text; a character that a removed span cuts shows as U+FFFD there."""
    left = F.make_valid_utf8(F.col("kept").cast("string"))
    return suffix.remove_repeats(table(spark, sf_dir, "documents")).withColumn("kept_text", left).drop("kept")


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licences(table(spark, sf_dir, "documents"))


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(table(spark, sf_dir, "documents"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(table(spark, sf_dir, "documents"))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return alignment.token_alignment(docs, public_tokenizers.path(BYTES), public_tokenizers.path(PIECES))


def op13_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With a cache of its own, so that every run encodes what it reads."""
    docs = table(spark, sf_dir, "documents")
    return tokens.token_counts(docs, public_tokenizers.path(PIECES), scratch_path(spark, "token-cache"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_secrets, op2_packing, op3_line_dedup, op4_decontamination, op5_lm_scoring, op6_quality, op7_exact_dedup,
        op8_suffix_dedup, op9_license_scan, op10_jaccard_join, op11_spelling_variants, op12_token_alignment,
        op13_token_counts,
    )
}

ORACLES = {
    "op5_lm_scoring": r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^ \t-\r]+') AS w
  FROM documents
),
tokens AS (
  SELECT doc_id, unnest(w) AS w, generate_subscripts(w, 1) AS i FROM words
),
grams AS (
  SELECT doc_id, w, lag(w) OVER d AS w1, lag(w, 2) OVER d AS w2 FROM tokens WINDOW d AS (PARTITION BY doc_id ORDER BY i)
),
c1 AS (SELECT w, count(*) AS n FROM grams GROUP BY 1),
c2 AS (SELECT w1, w, count(*) AS n FROM grams WHERE w1 IS NOT NULL GROUP BY 1, 2),
c3 AS (SELECT w2, w1, w, count(*) AS n FROM grams WHERE w2 IS NOT NULL GROUP BY 1, 2, 3),
total AS (SELECT count(*)::DOUBLE AS n FROM grams),
scored AS (
  SELECT g.doc_id,
    CASE WHEN c3.n > 1 THEN ln(c3.n - 1) - ln(h2.n - 1)
         WHEN c2.n > 1 THEN ln(c2.n - 1) - ln(h1.n - 1) + CASE WHEN g.w2 IS NULL THEN 0 ELSE ln(0.4) END
         ELSE CASE WHEN c1.n > 1 THEN ln(c1.n - 1) ELSE ln(0.4) END - ln(total.n)
              + CASE WHEN g.w1 IS NULL THEN 0 ELSE ln(0.4) END + CASE WHEN g.w2 IS NULL THEN 0 ELSE ln(0.4) END
    END AS s
  FROM grams g JOIN c1 ON g.w = c1.w CROSS JOIN total
  LEFT JOIN c2 ON g.w1 = c2.w1 AND g.w = c2.w
  LEFT JOIN c3 ON g.w2 = c3.w2 AND g.w1 = c3.w1 AND g.w = c3.w
  LEFT JOIN c1 h1 ON g.w1 = h1.w
  LEFT JOIN c2 h2 ON g.w2 = h2.w1 AND g.w1 = h2.w
)
SELECT d.doc_id, count(s.s) AS n_words, round(avg(s.s), 6) AS mean_log_score
FROM documents d LEFT JOIN scored s ON d.doc_id = s.doc_id GROUP BY 1
""",
    "op7_exact_dedup": r"""
WITH plain AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[ \t-\r]+', ' ', 'g') AS norm FROM documents
)
SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = min(doc_id) OVER g AS kept, sha256(norm) AS text_sha256
FROM plain WINDOW g AS (PARTITION BY norm)
""",
}
