"""Queries of the general problems (missing values, rejected lines, packed fields) and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from packetry.functions.lexicon import load
from packetry.operators import fill, packed, rejects
from packetry.runtime import table


def _filled(spark: SparkSession, d: str, parents: bool) -> tuple[DataFrame, list[tuple]]:
    rows = load(table(spark, d, "code_list"))
    return fill.fill(fill.record_cells(table(spark, d, "records"), rows), ("fee_status",), parents), rows


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    """Cells filled by a prototype of their own case: that of the field, for the fee that at the least gap in time."""
    filled, _ = _filled(spark, d, False)
    return filled.select(F.col("row_id").alias("record_id"), F.col("field").alias("field_name"), F.col("entry").cast("bigint").alias("entry_id"))


def p1_filled(spark: SparkSession, d: str) -> DataFrame:
    filled, rows = _filled(spark, d, True)
    names = spark.createDataFrame([(int(e), c) for e, _, c, *_ in rows] or [(0, "")], "entry int, value string")
    return filled.join(F.broadcast(names), "entry").select(F.col("row_id").alias("record_id"), F.col("field").alias("field_name"), "value", "method", "distance")


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return rejects.rejects(table(spark, d, "submission_lines"))


def p2_accepted(spark: SparkSession, d: str) -> DataFrame:
    return rejects.accepted(table(spark, d, "submission_lines"))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    known = packed.known_values([r for r in load(table(spark, d, "code_list")) if r[1] == "risk_flags"])
    parts = [packed.several(table(spark, d, t), "risk_flags", k, t, known) for t, k in (("records", "record_id"), ("submissions", "submission_id"))]
    return parts[0].unionByName(parts[1])


QUERIES = {f.__name__: f for f in (p1_found, p1_filled, p2_found, p2_accepted, p5_found)}

_FIELD = """(?:"(?:[^"]|"")*"|[^",]*)"""
_LINES = f"""
lines AS (SELECT line_id, raw_text, regexp_full_match(',' || raw_text, '(?:,{_FIELD})+', 's') AS sound,
                 regexp_extract_all(',' || raw_text, ',({_FIELD})', 1, 's') AS raw
          FROM submission_lines WHERE coalesce(line_no, 0) <> 1),
cut AS (SELECT line_id, sound, list_transform(raw, lambda x: CASE WHEN x[1] = '"' THEN replace(x[2:-2], '""', '"') ELSE x END) AS f FROM lines),
judged AS (
  SELECT line_id, sound, len(f) AS n, f,
         coalesce(regexp_full_match(f[6], 'SPN-[0-9]{{4}}'), false) AS sponsor_ok,
         coalesce(regexp_full_match(f[7], '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}') AND try_cast(f[7] AS DATE) IS NOT NULL, false) AS date_ok,
         coalesce(f[10] IN ('paid', 'waived', 'unpaid', 'unknown'), false) AS fee_ok,
         coalesce(regexp_full_match(f[12], '[0-9]+([.][0-9]+)?') AND try_cast(f[12] AS DOUBLE) <= 1, false) AS share_ok
  FROM cut)"""

SQL = {
    "p2_found": f"""
WITH {_LINES}
SELECT line_id, 'quoting' AS reason FROM judged WHERE NOT sound
UNION ALL SELECT line_id, 'column_count' FROM judged WHERE sound AND n <> 12
UNION ALL SELECT line_id, 'sponsor_id' FROM judged WHERE sound AND n = 12 AND NOT sponsor_ok
UNION ALL SELECT line_id, 'arrival_date' FROM judged WHERE sound AND n = 12 AND NOT date_ok
UNION ALL SELECT line_id, 'fee_status' FROM judged WHERE sound AND n = 12 AND NOT fee_ok
UNION ALL SELECT line_id, 'confidence' FROM judged WHERE sound AND n = 12 AND NOT share_ok""",
    "p2_accepted": f"""
WITH {_LINES}
SELECT line_id, f[1] AS case_id, f[2] AS applicant_name, f[3] AS species_code, f[4] AS home_world, f[5] AS visa_class, f[6] AS sponsor_id,
       CAST(f[7] AS DATE) AS arrival_date, f[8] AS declared_purpose, f[9] AS risk_flags, f[10] AS fee_status, f[11] AS adjudication,
       CAST(f[12] AS DOUBLE) AS confidence
FROM judged WHERE sound AND n = 12 AND sponsor_ok AND date_ok AND fee_ok AND share_ok""",
}
