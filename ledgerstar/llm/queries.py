"""One registered query per operator, over its whole table, and the SQL for those it can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerstar.llm import (
    binary, discriminant, exact, html, lm, mixing, neardup, packing, periodic, pii, quality, urls, variants,
)
from ledgerstar.llm.tables import Tables

WORD_BPE, BYTE_BPE = "word_bpe_49k.json", "byte_bpe_50k.json"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages, labels = _table(spark, sf_dir, "pages"), _table(spark, sf_dir, "labels")
    return urls.judged(pages, labels, Tables(spark, "op1")).drop("url")


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.judged(_table(spark, sf_dir, "documents"), Tables(spark, "op2")).select(
        "doc_id", "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256")
    )


def op3_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{Tables(spark, 'op3').base}/shards"
    binary.write(_table(spark, sf_dir, "documents"), folder, public_tokenizers.path(WORD_BPE))
    return binary.read(spark, folder)


def op4_backoff_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.scored(_table(spark, sf_dir, "documents"), Tables(spark, "op4"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    return quality.verdicts(documents, Tables(spark, "op5"), labels).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
        "log_perplexity",
        "lower",
        "upper",
    )


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    path = public_tokenizers.path(BYTE_BPE)
    return packing.pack(documents, Tables(spark, "op6"), path, keep_ids=False).drop("ids")


def op7_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = pii.judged(_table(spark, sf_dir, "documents"), Tables(spark, "op7"))
    return rows.select(
        "doc_id",
        *[F.size(name).cast("long").alias(f"n_{name}") for name in pii.NAMES],
        F.expr(f"sha2({pii.joined('concat(' + ', '.join(pii.NAMES) + ')')}, 256) AS base_sha256"),
        F.expr(f"{pii.joined('spans')} AS spans"),
    )


def op8_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extracted(_table(spark, sf_dir, "pages"))


def op9_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.linked(_table(spark, sf_dir, "documents"), Tables(spark, "op9"), 3, 85)


def op10_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.copies(_table(spark, sf_dir, "documents")).select(
        F.col("doc.doc_id").alias("doc_id"),
        "size",
        "source_size",
        "target",
        F.expr("copies * size AS taken"),
    )


def op11_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    return discriminant.scored(documents, labels, Tables(spark, "op11"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.detected(_table(spark, sf_dir, "documents"), change=True)


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.grouped(_table(spark, sf_dir, "documents"), Tables(spark, "op13"), variants.PLANTED)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        query.__name__: query
        for query in (
            op1_url_rules,
            op2_exact_dedup,
            op3_token_shards,
            op4_backoff_lm,
            op5_quality_rules,
            op6_best_fit_packing,
            op7_personal_data,
            op8_main_text,
            op9_near_dedup,
            op10_source_mix,
            op11_quality_classifier,
            op12_periodic_runs,
            op13_spelling_variants,
        )
    }


OP2_SQL = r"""
WITH rows AS (
    SELECT doc_id, length(coalesce(text, '')) AS n_chars,
           sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
    FROM documents
)
SELECT doc_id,
       first_value(doc_id) OVER ranked AS keep_id,
       count(*) OVER (PARTITION BY text_sha256) AS group_size,
       doc_id = first_value(doc_id) OVER ranked AS kept,
       text_sha256
FROM rows
WINDOW ranked AS (PARTITION BY text_sha256 ORDER BY n_chars DESC, doc_id)
"""

# The common level behind the targets, by the same closed form as the operator's
OP10_SQL = rf"""
WITH sized AS (
    SELECT doc_id, source,
           CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
    FROM documents
), sources AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
           (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight
    FROM sized GROUP BY source
), capped AS (
    SELECT *, source_size / weight AS rank, CAST(sum(source_size) OVER () AS BIGINT) AS total,
           3 * (sum(source_size) OVER upto - source_size) AS capped_before,
           sum(weight) OVER () - sum(weight) OVER upto + weight AS weight_left
    FROM sources
    WINDOW upto AS (ORDER BY source_size / weight, source NULLS LAST ROWS UNBOUNDED PRECEDING)
), levels AS (
    SELECT *, CAST(total - capped_before AS DOUBLE) / weight_left AS level FROM capped
), shared AS (
    SELECT level FROM levels WHERE level * weight <= 3 * source_size ORDER BY rank, level LIMIT 1
), targets AS (
    SELECT source, source_size,
           CASE WHEN source_size = 0 THEN 0.0
                ELSE least(CAST(3 * source_size AS DOUBLE), (SELECT level FROM shared) * weight) END AS target
    FROM levels
), rated AS (
    SELECT *, CASE WHEN source_size = 0 THEN 0.0 ELSE target / source_size END AS rate FROM targets
)
SELECT doc_id, size, source_size, target,
       CAST(size * (floor(rate) + CASE WHEN
            CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':{mixing.SEED}'), 1, 13) AS BIGINT)
            / 4503599627370496.0 < rate - floor(rate) THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM sized JOIN rated ON sized.source IS NOT DISTINCT FROM rated.source
"""


def oracle_sql() -> dict[str, str]:
    return {"op2_exact_dedup": OP2_SQL, "op10_source_mix": OP10_SQL}
