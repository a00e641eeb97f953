"""The queries opN_<name> of this subpackage: each operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import cdc, htmlmain, langid, licences, mixing, packing, pii, quality, radix, simhash
from .common import read_table

Query = Callable[[SparkSession, str], DataFrame]


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_quality(read_table(spark, sf_dir, "documents").select("doc_id", "text"), read_table(spark, sf_dir, "labels").select("doc_id", "quality"))


def op2_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.predict_languages(read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(read_table(spark, sf_dir, "documents").select("doc_id", "source", "text"))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = simhash.near_duplicates(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    digits = F.lower(F.concat(*[F.hex(F.substring("fp", i, 1)) for i in range(8, 0, -1)]))
    return g.select("doc_id", digits.alias("fingerprint"), "component_id")


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_personal_data(read_table(spark, sf_dir, "documents").select("doc_id", "text"), redacted=False)


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(read_table(spark, sf_dir, "documents").select("doc_id", "text"), public_tokenizers.path("word_bpe_49k.json"))


def op7_chunking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cdc.fingerprint_documents(read_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op8_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return htmlmain.extract_main_text(read_table(spark, sf_dir, "pages").select("page_id", "url", "html"))


def op9_radix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return radix.exact_duplicates(read_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op10_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan_licences(read_table(spark, sf_dir, "documents").select("doc_id", "text"))


QUERIES: dict[str, Query] = {f.__name__: f for f in (op1_quality, op2_langid, op3_mixing, op4_simhash, op5_pii, op6_packing, op7_chunking, op8_html, op9_radix, op10_licences)}

ORACLE_SQL: dict[str, str] = {
    "op3_mixing": r"""
WITH d AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         md5('mix-1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS k
  FROM documents
), s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source
), w AS (
  SELECT source, source_size, CAST((row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 + 1 AS BIGINT) AS w FROM s
), o AS (  -- sources that are capped come first in this order
  SELECT *, row_number() OVER (ORDER BY 3.0 * source_size / w, source) AS i FROM w
), t AS (
  SELECT a.i, (SELECT sum(source_size) FROM w) - coalesce((SELECT sum(3 * source_size) FROM o b WHERE b.i < a.i), 0) AS left_,
         (SELECT sum(w) FROM o b WHERE b.i >= a.i) AS share
  FROM o a
), c AS (  -- the first source in order that its share doesn't lift above its cap
  SELECT left_, share FROM t JOIN o USING (i) WHERE o.w * left_ <= 3 * o.source_size * share AND o.source_size > 0 ORDER BY i LIMIT 1
), g AS (
  SELECT o.source, o.source_size,
         CASE WHEN o.w * c.left_ > 3 * o.source_size * c.share OR o.source_size = 0 THEN CAST(3 * o.source_size AS DOUBLE) ELSE CAST(o.w * c.left_ AS DOUBLE) / CAST(c.share AS DOUBLE) END AS target,
         CAST(CASE WHEN o.w * c.left_ > 3 * o.source_size * c.share OR o.source_size = 0 THEN 3 * o.source_size ELSE (o.w * c.left_) // c.share END AS BIGINT) AS budget
  FROM o LEFT JOIN c ON true
), p AS (
  SELECT d.*, coalesce(sum(size) OVER (PARTITION BY source ORDER BY k, doc_id NULLS FIRST, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM d
)
SELECT p.doc_id, p.size, g.source_size, g.target,
       CAST(CASE WHEN g.source_size = 0 THEN 0 ELSE (g.budget // g.source_size) * p.size + greatest(0, least(p.size, g.budget % g.source_size - p.before)) END AS BIGINT) AS taken
FROM p JOIN g ON p.source IS NOT DISTINCT FROM g.source
""",
    "op10_licences": licences.oracle_sql(),
    "op9_radix": """
SELECT doc_id, max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS keep_id,
       count(*) OVER (PARTITION BY coalesce(text, '')) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
""",
}
