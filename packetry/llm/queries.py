"""Queries of the llm subpackage and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from packetry.functions.lexicon import load
from packetry.llm import canonical, language, mixing, names, survivor, tokens
from packetry.runtime import table


def p3_links(spark: SparkSession, d: str) -> DataFrame:
    return names.linked(table(spark, d, "records"), table(spark, d, "name_aliases"), load(table(spark, d, "code_list")))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return names.pairs(p3_links(spark, d))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return canonical.mapped(table(spark, d, "records"), load(table(spark, d, "code_list")))


def p4_unmatched(spark: SparkSession, d: str) -> DataFrame:
    records, rows = table(spark, d, "records"), load(table(spark, d, "code_list"))
    return canonical.unmatched(records, rows).unionByName(canonical.unmatched_items(records, rows))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return survivor.survivors(table(spark, d, "records"), table(spark, d, "source_trust")).select("case_id", "field_name", "kept_value")


def p6_truths(spark: SparkSession, d: str) -> DataFrame:
    return survivor.truths(table(spark, d, "records"), table(spark, d, "source_trust"))


def p6_sources(spark: SparkSession, d: str) -> DataFrame:
    return survivor.source_quality(table(spark, d, "records"), table(spark, d, "source_trust"))


def p7_ids(spark: SparkSession, d: str) -> DataFrame:
    return tokens.encoded(table(spark, d, "documents"))


def p8_mixture(spark: SparkSession, d: str) -> DataFrame:
    return mixing.mixture(table(spark, d, "documents"), table(spark, d, "mix_targets"))


def p8_shares(spark: SparkSession, d: str) -> DataFrame:
    return mixing.shares(table(spark, d, "documents"), table(spark, d, "mix_targets"))


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return language.found(table(spark, d, "documents"))


def p9_segments(spark: SparkSession, d: str) -> DataFrame:
    return language.segments(table(spark, d, "documents")).select("doc_id", F.col("segment_no"), "lang", "confidence")


QUERIES = {f.__name__: f for f in (p3_found, p3_links, p4_found, p4_unmatched, p6_found, p6_truths, p6_sources, p7_ids, p8_mixture, p8_shares, p9_found, p9_segments)}

_USABLE = """
  CASE WHEN field_name = 'arrival_date' THEN regexp_full_match(v, '[0-9]{4}-[0-9]{2}-[0-9]{2}') AND try_cast(v AS DATE) IS NOT NULL
       ELSE regexp_full_match(v, 'SPN-[0-9]{4}') END"""

SQL = {
    "p6_found": f"""
WITH f(field_name) AS (VALUES ('sponsor_id'), ('sponsor_letter_id'), ('arrival_date')),
said AS (
  SELECT r.case_id, f.field_name, r.read_at,
         CASE f.field_name WHEN 'sponsor_id' THEN r.sponsor_id WHEN 'sponsor_letter_id' THEN r.sponsor_letter_id ELSE r.arrival_date END AS v,
         r.field_sources[f.field_name] AS source
  FROM records r CROSS JOIN f WHERE r.case_id IS NOT NULL
  UNION ALL
  SELECT r.case_id, f.field_name, r.read_at,
         unnest(regexp_extract_all(' ' || coalesce(r.corrections[f.field_name], '') || ' ',
           CASE WHEN f.field_name = 'arrival_date' THEN '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}' ELSE 'SPN-[0-9]{{4}}' END)) AS v,
         'correction' AS source
  FROM records r CROSS JOIN f WHERE r.case_id IS NOT NULL),
ranked AS (
  SELECT s.*, CASE WHEN t.source_name IS NULL THEN 1000000 ELSE t.trust_rank END AS rank
  FROM said s LEFT JOIN source_trust t ON s.source = t.source_name WHERE v IS NOT NULL AND ({_USABLE}))
SELECT case_id, field_name, arg_min(v, (rank, -epoch_us(read_at), v)) AS kept_value
FROM ranked WHERE rank IS NOT NULL AND case_id IN (SELECT case_id FROM records GROUP BY 1 HAVING count(*) >= 2)
GROUP BY 1, 2""",
}
