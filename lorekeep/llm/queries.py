"""The registered queries of this subpackage and the SQL that states the same results."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lorekeep.llm import decontam, lm, media, mixing, near_dup, quality, secrets, suffix_dedup, tokens, urls
from lorekeep.llm.common import table


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.without_repeats(table(spark, sf_dir, "documents"))


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.findings(table(spark, sf_dir, "documents"))


def op3_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.described(media.stored(table(spark, sf_dir, "documents")))


def op4_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.scored(table(spark, sf_dir, "documents"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = mixing.in_training_order(mixing.plan(table(spark, sf_dir, "documents")))
    return p.select("doc_id", "size", "source_size", "target", "taken")


def op6_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.token_output(table(spark, sf_dir, "documents"))


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.verdicts(table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.score(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"))


MIXING_SQL = r"""
WITH d AS (
  SELECT doc_id, source, md5(CAST(doc_id AS VARCHAR)) AS k,
         CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size
  FROM documents
), s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         row_number() OVER (ORDER BY source NULLS LAST) - 1 AS i
  FROM d GROUP BY source
), w AS (
  SELECT *, CASE i % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS weight FROM s
), c AS (
  SELECT *, 2.0::DOUBLE * source_size AS cap FROM w
), f AS (
  SELECT *, 1.5::DOUBLE * CAST(sum(source_size) OVER () AS DOUBLE) AS everything,
         sum(cap) OVER o - cap AS filled,
         sum(weight) OVER () - sum(weight) OVER o + weight AS remaining
  FROM c WINDOW o AS (ORDER BY cap / weight, i ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
), l AS (
  SELECT *, CASE WHEN (everything - filled) / remaining * weight <= cap THEN (everything - filled) / remaining END AS level FROM f
), t AS (
  SELECT *, max(level) OVER () AS found FROM l
), g AS (
  SELECT source, source_size, CASE WHEN found IS NULL THEN cap ELSE least(cap, found * weight) END AS target FROM t
), p AS (
  SELECT d.doc_id, d.size, g.source_size, g.target, CAST(floor(g.target) AS BIGINT) AS whole,
         CAST(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.k, d.doc_id, d.size ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) - d.size AS before
  FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source
), q AS (
  SELECT *, CASE WHEN source_size > 0 THEN whole // source_size ELSE 0 END AS passes FROM p
)
SELECT doc_id, size, source_size, target,
       CAST(passes * size + greatest(0, least(whole - passes * source_size - before, size)) AS BIGINT) AS taken
FROM q
"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_suffix_dedup": op1_suffix_dedup,
    "op2_secrets": op2_secrets,
    "op3_media": op3_media,
    "op4_lm_score": op4_lm_score,
    "op5_mixing": op5_mixing,
    "op6_token_output": op6_token_output,
    "op7_url_filter": op7_url_filter,
    "op8_quality": op8_quality,
    "op9_decontaminate": op9_decontaminate,
    "op10_near_dup": op10_near_dup,
}

ORACLE_SQL: dict[str, str] = {"op5_mixing": MIXING_SQL}
