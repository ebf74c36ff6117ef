"""Queries of scoring, validation and mining, with their SQL. Truth is the first reading of a case, predictions are submissions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from packetry.operators import consolidate, scoring
from packetry.runtime import table
from packetry.sources.writers import sorted_json

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def _truth(spark: SparkSession, d: str) -> DataFrame:
    r = table(spark, d, "records").select("record_id", "case_id", *scoring.WEIGHTS)
    return consolidate.first_rows(r, ["case_id"], [F.col("record_id")])


def _predictions(spark: SparkSession, d: str) -> DataFrame:
    return scoring.indexed(table(spark, d, "submissions"))


def _scored(spark: SparkSession, d: str) -> DataFrame:
    return scoring.score_cases(_truth(spark, d), _predictions(spark, d), decided="fee_status")


_N = "lower(trim(regexp_replace(coalesce({0}, ''), '[ \\t\\n\\r\\f\\x0b]+', ' ', 'g')))"
_NF = "CASE WHEN " + _N + " IN ('', 'none', 'null', 'unknown') THEN 'none' ELSE array_to_string(list_sort(list_filter(list_transform(string_split(" + _N + ", '|'), lambda x: trim(x)), lambda x: x <> '')), '|') END"


def _hit(f: str) -> str:
    n = _NF if f == "risk_flags" else _N
    return f"CASE WHEN p.case_id IS NOT NULL AND {n.format('t.' + f)} = {n.format('p.' + f)} THEN 1 ELSE 0 END"


_BASE = f"""t AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY case_id ORDER BY record_id) AS rn FROM records) WHERE rn = 1),
p AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY case_id ORDER BY submission_id) AS rn FROM submissions WHERE trim(coalesce(case_id, '')) <> '') WHERE rn = 1),
s AS (SELECT t.case_id, p.case_id IS NOT NULL AS present, {' + '.join(f'{w} * {_hit(f)}' for f, w in scoring.WEIGHTS.items())} AS raw,
  {', '.join(f'{_hit(f)} AS h_{f}' for f in scoring.WEIGHTS)},
  CASE WHEN p.case_id IS NULL THEN NULL WHEN coalesce(p.confidence BETWEEN 0 AND 1, false) THEN pow(p.confidence - {_hit('fee_status')}, 2) ELSE 1.0 END AS brier,
  CASE WHEN p.case_id IS NOT NULL THEN coalesce(p.confidence BETWEEN 0 AND 1, false) END AS confidence_valid
  FROM t LEFT JOIN p ON p.case_id = t.case_id)"""


@query(f"WITH {_BASE} SELECT case_id, present, raw, brier, confidence_valid FROM s")
def e_scored_cases(spark, d) -> DataFrame:
    return _scored(spark, d).select("case_id", "present", "raw", "brier", "confidence_valid")


@query(f"""WITH {_BASE}, a AS (SELECT count(*) AS truth_cases, count(*) FILTER (WHERE NOT present) AS missing_cases, count(*) FILTER (WHERE present AND NOT confidence_valid) AS invalid_confidence, avg(brier) AS mean_brier,
  sum(raw) AS raw, count(*) * 45 AS top FROM s)
SELECT truth_cases, missing_cases, invalid_confidence, mean_brier, raw / top * 50.0 AS extraction_score, coalesce(greatest(0, 1 - 2 * mean_brier), 0) * 20.0 AS calibration_score, missing_cases / truth_cases * 10.0 AS missing_penalty FROM a""")
def e_totals(spark, d) -> DataFrame:
    return scoring.totals(_scored(spark, d))


@query(f"""WITH {_BASE}, u AS ({' UNION ALL '.join(f"SELECT '{f}' AS field, h_{f} AS h FROM s" for f in scoring.WEIGHTS)})
SELECT field, count(*) AS scorable, count(*) FILTER (WHERE h = 1) AS matched, avg(h) AS accuracy FROM u GROUP BY 1""")
def a_field_accuracy(spark, d) -> DataFrame:
    return scoring.field_accuracy(_scored(spark, d))


@query(f"""WITH {_BASE} SELECT coalesce(t.fee_status, '') || '->' || CASE WHEN p.case_id IS NULL THEN 'MISSING' ELSE coalesce(p.fee_status, '') END AS pair, count(*) AS n FROM t LEFT JOIN p ON p.case_id = t.case_id GROUP BY 1""")
def a_confusion(spark, d) -> DataFrame:
    return scoring.confusion(_truth(spark, d), _predictions(spark, d), "fee_status")


@query(f"""WITH {_BASE} SELECT 'missing' AS kind, case_id FROM t WHERE case_id NOT IN (SELECT case_id FROM p) UNION ALL SELECT 'extra', case_id FROM p WHERE case_id NOT IN (SELECT case_id FROM t)
UNION ALL SELECT 'scored', case_id FROM t WHERE case_id IN (SELECT case_id FROM p)""")
def j_missing_extra(spark, d) -> DataFrame:
    t, p = _truth(spark, d).select("case_id"), _predictions(spark, d).select("case_id")
    out = t.join(p, "case_id", "left_anti").select(F.lit("missing").alias("kind"), "case_id")
    out = out.unionByName(p.join(t, "case_id", "left_anti").select(F.lit("extra").alias("kind"), "case_id"))
    return out.unionByName(t.join(p, "case_id", "left_semi").select(F.lit("scored").alias("kind"), "case_id"))


@query("SELECT case_id, count(*) - 1 AS extra_rows FROM submissions WHERE trim(coalesce(case_id, '')) <> '' GROUP BY 1 HAVING count(*) > 1")
def a_duplicates(spark, d) -> DataFrame:
    return scoring.duplicates(table(spark, d, "submissions"))


_D = "coalesce(regexp_full_match(arrival_date, '[0-9]{4}-[0-9]{2}-[0-9]{2}') AND try_cast(arrival_date AS DATE) IS NOT NULL, false)"


@query(f"""WITH e AS (SELECT submission_id, unnest([
  CASE WHEN NOT coalesce(regexp_full_match(case_id, 'MIB-[0-9]{{6}}'), false) THEN 'case_id' END, CASE WHEN NOT coalesce(regexp_full_match(sponsor_id, 'SPN-[0-9]{{4}}'), false) THEN 'sponsor_id' END,
  CASE WHEN NOT {_D} THEN 'arrival_date' END, CASE WHEN NOT coalesce(fee_status IN ('paid', 'waived', 'unpaid', 'unknown'), false) THEN 'fee_status' END,
  CASE WHEN NOT coalesce(adjudication IN ('APPROVED', 'DENIED', 'NEEDS_REVIEW'), false) THEN 'adjudication' END, CASE WHEN NOT coalesce(confidence BETWEEN 0 AND 1, false) THEN 'confidence' END]) AS error FROM submissions)
SELECT submission_id, error FROM e WHERE error IS NOT NULL""")
def p_row_errors(spark, d) -> DataFrame:
    return scoring.row_errors(table(spark, d, "submissions"), "submission_id")


@query("""SELECT home_world, count(*) AS n, count(*) FILTER (WHERE fee_status = 'unpaid') AS hits, count(*) FILTER (WHERE fee_status = 'unpaid') / count(*) AS rate
FROM records WHERE home_world IS NOT NULL GROUP BY 1 HAVING count(*) >= 5 AND count(*) FILTER (WHERE fee_status = 'unpaid') / count(*) >= 0.3""")
def a_rates(spark, d) -> DataFrame:
    return scoring.rates(table(spark, d, "records"), "home_world", F.col("fee_status") == "unpaid", 5, 0.3)


@query("""WITH l AS (SELECT visa_class AS bucket, fee_status AS outcome, 'species_code' AS feature, species_code AS value FROM records UNION ALL SELECT visa_class, fee_status, 'home_world', home_world FROM records
  UNION ALL SELECT visa_class, fee_status, 'ocr_used', CAST(ocr_used AS VARCHAR) FROM records),
k AS (SELECT bucket, feature, value, outcome, count(*) AS k FROM l WHERE bucket IS NOT NULL AND value IS NOT NULL AND outcome IS NOT NULL GROUP BY ALL),
o AS (SELECT *, sum(k) OVER (PARTITION BY bucket, feature, value) AS n, row_number() OVER (PARTITION BY bucket, feature, value ORDER BY k DESC, outcome DESC) AS rn FROM k),
b AS (SELECT visa_class AS bucket, fee_status AS outcome, count(*) AS bk FROM records WHERE fee_status IS NOT NULL GROUP BY ALL), z AS (SELECT bucket, sum(bk) AS bn FROM b GROUP BY 1),
g AS (SELECT o.bucket, feature, value, CAST(n AS BIGINT) AS n, o.outcome AS best, k AS best_n, round(k - n * bk / bn, 6) AS gain FROM o JOIN b ON b.bucket = o.bucket AND b.outcome = o.outcome JOIN z ON z.bucket = o.bucket WHERE rn = 1 AND n >= 15)
SELECT * FROM g WHERE gain > 0 ORDER BY gain DESC, bucket, feature, value LIMIT 25""")
def a_mined_splits(spark, d) -> DataFrame:
    return scoring.mined_splits(table(spark, d, "records"), "visa_class", ["species_code", "home_world", "ocr_used"], "fee_status")


@query("""WITH a AS (SELECT case_id, mode(fee_status ORDER BY fee_status) AS x FROM records GROUP BY 1),
c AS (SELECT case_id, fee_status, count(*) AS n FROM records WHERE fee_status IS NOT NULL AND fee_status <> '' GROUP BY 1, 2),
v AS (SELECT case_id, fee_status, n, row_number() OVER (PARTITION BY case_id ORDER BY n DESC, fee_status DESC) AS rn FROM c),
f AS (SELECT case_id, arg_min(fee_status, record_id) AS first FROM records WHERE fee_status IS NOT NULL AND fee_status <> '' GROUP BY 1)
SELECT f.case_id, f.first AS filled, CASE WHEN v.n >= 2 THEN v.fee_status ELSE f.first END AS voted FROM f JOIN v ON v.case_id = f.case_id AND v.rn = 1""")
def a_fill_and_vote(spark, d) -> DataFrame:
    r = table(spark, d, "records").where("fee_status is not null and fee_status <> ''")
    top = r.groupBy("case_id", "fee_status").agg(F.count("*").alias("n"), F.min_by("fee_status", "record_id").alias("x"), F.min("record_id").alias("o"))
    per = top.groupBy("case_id").agg(F.max(F.struct("n", "fee_status")).alias("b"), F.min_by("fee_status", "o").alias("filled"))
    return per.select("case_id", "filled", F.when(F.col("b.n") >= 2, F.col("b.fee_status")).otherwise(F.col("filled")).alias("voted"))


@query("""SELECT case_id FROM (SELECT case_id FROM manifest EXCEPT SELECT case_id FROM submissions) ORDER BY case_id LIMIT 20""")
def w_top_missing(spark, d) -> DataFrame:
    return table(spark, d, "manifest").join(table(spark, d, "submissions"), "case_id", "left_anti").select("case_id").distinct().orderBy("case_id").limit(20)


@query("""WITH a AS (SELECT case_id, arg_min(fee_status, record_id) AS x, arg_min(home_world, record_id) AS w, arg_max(fee_status, record_id) AS y, arg_max(home_world, record_id) AS z FROM (SELECT record_id, case_id, coalesce(fee_status, '') AS fee_status, coalesce(home_world, '') AS home_world FROM records) GROUP BY 1)
SELECT case_id, 'fee_status' AS field, x AS base, y AS variant FROM a WHERE x <> y UNION ALL SELECT case_id, 'home_world', w, z FROM a WHERE w <> z""")
def j_variant_diff(spark, d) -> DataFrame:
    r = table(spark, d, "records")
    cols = ["fee_status", "home_world"]
    agg = r.groupBy("case_id").agg(*[g(F.coalesce(c, F.lit("")), F.col("record_id")).alias(f"{c}_{n}") for c in cols for g, n in ((F.min_by, "a"), (F.max_by, "b"))])
    pairs = F.array(*[F.struct(F.lit(c).alias("field"), F.col(f"{c}_a").alias("base"), F.col(f"{c}_b").alias("variant")) for c in cols])
    return agg.select("case_id", F.inline(pairs)).where("base <> variant")


@query("""SELECT to_json({case_id: case_id, fee_status: fee_status, species_code: species_code}) AS json FROM submissions""")
def k_json_rows(spark, d) -> DataFrame:
    rows = table(spark, d, "submissions").select("species_code", "case_id", "fee_status")
    return rows.select(sorted_json(rows).alias("json"))


@query()
def k_results_json(spark, d) -> DataFrame:
    t, p = _truth(spark, d), _predictions(spark, d)
    return scoring.results_json(scoring.totals(_scored(spark, d)), scoring.confusion(t, p, "fee_status"), t.join(p, "case_id", "left_anti").select("case_id"))


@query()
def a_sample(spark, d) -> DataFrame:
    return table(spark, d, "records").select("record_id", "case_id").orderBy(F.xxhash64(F.lit(7), "record_id"), "record_id").limit(48)


@query("""SELECT 'packets/' AS folder, sum(page_count) AS pages, max(page_count) AS most, count(*) FILTER (WHERE page_count <= 5) AS small FROM manifest""")
def a_artifact_sizes(spark, d) -> DataFrame:
    return table(spark, d, "manifest").agg(F.sum("page_count").alias("pages"), F.max("page_count").alias("most"), F.count_if(F.col("page_count") <= 5).alias("small")).select(F.lit("packets/").alias("folder"), "pages", "most", "small")
