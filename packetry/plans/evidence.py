"""Queries of the line and consolidation operators, with their SQL. Lines are those of documents; a packet is a case."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from packetry.functions import extract as X
from packetry.functions.text import absent, canon
from packetry.operators import consolidate, fuzzy, lines
from packetry.runtime import table

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def _lines(spark: SparkSession, d: str) -> DataFrame:
    return lines.from_documents(table(spark, d, "documents"))


_L = """l AS (SELECT case_id AS packet, doc_id AS page, CAST(i AS INT) AS line_no, string_split(text, chr(10))[i] AS text
  FROM documents, unnest(generate_series(1, len(string_split(text, chr(10))))) AS u(i) WHERE text IS NOT NULL)"""
_FOOT = "coalesce(regexp_matches(text, '(?i)^packet\\s+\\S+\\s*/\\s*page\\s*[0-9]'), false)"
_BOILER = """pg AS (SELECT packet, count(DISTINCT page) AS pages FROM l GROUP BY 1 HAVING count(DISTINCT page) >= 3),
ot AS (SELECT packet, text, count(DISTINCT page) AS n FROM l GROUP BY 1, 2),
bp AS (SELECT ot.packet, text FROM ot JOIN pg ON ot.packet = pg.packet WHERE n >= greatest(2, floor(pages * 0.8)))"""


@query(f"WITH {_L} SELECT packet, page, line_no, text FROM l")
def s_lines(spark, d) -> DataFrame:
    return _lines(spark, d)


@query(f"WITH {_L}, {_BOILER} SELECT packet, text FROM bp")
def a_boilerplate(spark, d) -> DataFrame:
    return lines.boilerplate(_lines(spark, d))


@query(f"WITH {_L}, {_BOILER} SELECT packet, page, line_no, text FROM l WHERE NOT EXISTS (SELECT 1 FROM bp WHERE bp.packet = l.packet AND bp.text = l.text)")
def j_without_boilerplate(spark, d) -> DataFrame:
    return lines.without_boilerplate(_lines(spark, d))


@query(f"""WITH {_L}, {_BOILER}, k AS (SELECT * FROM l WHERE trim(text) <> '' AND NOT {_FOOT} AND NOT EXISTS (SELECT 1 FROM bp WHERE bp.packet = l.packet AND bp.text = l.text))
SELECT p.packet, p.page, coalesce(arg_min(k.text, k.line_no), '') AS title FROM (SELECT DISTINCT packet, page FROM l WHERE packet IS NOT NULL) p
LEFT JOIN k ON p.packet = k.packet AND p.page = k.page GROUP BY 1, 2""")
def p_titles(spark, d) -> DataFrame:
    return lines.titles(_lines(spark, d)).where("packet is not null")


@query(f"""WITH {_L} SELECT page, count(*) FILTER (WHERE {_FOOT}) AS footers,
  count(*) FILTER (WHERE regexp_matches(text, '(?i)system\\s*:|answer\\s*key|ignore\\s+(all|visible|previous)|force\\s+adjudication|output\\s+this|barcode\\s+payload')) AS injected,
  count(*) FILTER (WHERE regexp_matches(text, 'SPN-[0-9]|MIB-[0-9]|[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}')) AS legibility FROM l GROUP BY 1""")
def p_line_predicates(spark, d) -> DataFrame:
    c = F.col("text")
    rows = _lines(spark, d).groupBy("page").agg(F.count_if(lines.footer(c)).alias("footers"), F.count_if(lines.injected(c)).alias("injected"), F.count_if(c.rlike(r"SPN-[0-9]|MIB-[0-9]|[0-9]{4}-[0-9]{2}-[0-9]{2}")).alias("legibility"))
    return rows


@query()
def p_unarchived(spark, d) -> DataFrame:
    return lines.unarchived(_lines(spark, d))


@query(f"""WITH {_L}, f AS (SELECT packet, page, arg_min(nullif(regexp_extract(text, 'MIB-[0-9]{{4,}}', 0), ''), line_no) AS id FROM l GROUP BY 1, 2),
m AS (SELECT *, (id IS NULL OR id = packet) AS hit FROM f), s AS (SELECT packet, bool_or(hit) AS any_hit FROM m GROUP BY 1)
SELECT m.packet, page, id FROM m JOIN s ON m.packet IS NOT DISTINCT FROM s.packet WHERE hit OR NOT any_hit""")
def p_active_pages(spark, d) -> DataFrame:
    return lines.active_pages(_lines(spark, d))


@query(f"""WITH {_L}, {_BOILER}, ch AS (SELECT packet, page, sum(length(trim(text))) AS chars FROM l WHERE NOT {_FOOT}
  AND NOT EXISTS (SELECT 1 FROM bp WHERE bp.packet = l.packet AND bp.text = l.text) GROUP BY 1, 2)
SELECT d.case_id AS packet, d.doc_id AS page FROM documents d LEFT JOIN ch ON ch.packet = d.case_id AND ch.page = d.doc_id WHERE coalesce(chars, 0) < 40""")
def p_scan_gate(spark, d) -> DataFrame:
    pages = table(spark, d, "documents").select(F.col("case_id").alias("packet"), F.col("doc_id").alias("page"), F.lit(1).alias("n_images"))
    return lines.scan_gate(pages, _lines(spark, d))


@query(f"""WITH {_L}, s AS (SELECT packet, page, line_no, regexp_replace(text[:instr(text, ':') - 1], '^[\\s\\x{{00A0}}]+|[\\s\\x{{00A0}}]+$', '', 'g') AS label,
  regexp_replace(text[instr(text, ':') + 1:], '^[\\s\\x{{00A0}}]+|[\\s\\x{{00A0}}]+$', '', 'g') AS value FROM l WHERE instr(text, ':') > 1)
SELECT packet, page, label, arg_max(value, line_no) AS value FROM s WHERE value <> '' GROUP BY 1, 2, 3""")
def f_inline_fields(spark, d) -> DataFrame:
    return lines.inline_fields(_lines(spark, d))


@query()
def w_vertical_fields(spark, d) -> DataFrame:
    labels = {"Case": "case_id", "Applicant": "applicant_name", "Sponsor": "sponsor_id", "Arrival": "arrival_date", "Home world": "home_world"}
    parts = _lines(spark, d).select("packet", "page", F.col("line_no").alias("n"), F.posexplode(F.split("text", ": ", 2)).alias("p", "text"))
    stacked = parts.select("packet", "page", (F.col("n") * 2 + F.col("p")).alias("line_no"), F.trim("text").alias("text"))
    return lines.vertical_fields(stacked, labels, {"case_id": "^MIB-[0-9]", "sponsor_id": "SPN-[0-9]", "arrival_date": X.DATE})


@query(f"""WITH {_L}, t AS (SELECT page, arg_min(text, line_no) FILTER (WHERE trim(text) <> '') AS title FROM l GROUP BY 1)
SELECT page, CASE WHEN regexp_matches(title, '(?i)^(case|applicant|sponsor)') THEN 'header' WHEN regexp_matches(title, '(?i)registry') THEN 'registry'
  WHEN regexp_matches(title, '(?i)biometric') THEN 'biometric' ELSE 'untyped' END AS page_type FROM t""")
def p_page_types(spark, d) -> DataFrame:
    first = _lines(spark, d).groupBy("page").agg(F.min_by("text", F.when(F.trim("text") != "", F.col("line_no"))).alias("title"))
    rules = [("(?i)^(case|applicant|sponsor)", "header"), ("(?i)registry", "registry"), ("(?i)biometric", "biometric")]
    return lines.page_types(first, rules).select("page", "page_type")


@query(f"""WITH {_L}, i AS (SELECT packet, page, line_no, unnest(regexp_extract_all(text, 'SPN-[0-9]{{4}}')) AS id FROM l WHERE packet IS NOT NULL),
c AS (SELECT packet, id, count(*) AS n, min(page * 1000000 + line_no) AS pos FROM i GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY packet ORDER BY n DESC, pos, id) AS rn FROM c)
SELECT packet, n FROM r WHERE rn = 1""")
def a_frequent_id(spark, d) -> DataFrame:
    ls = _lines(spark, d).where("packet is not null")
    top = lines.frequent_id(ls, "SPN-[0-9]{4}")
    ids = ls.where(~lines.injected(F.col("text"))).select("packet", F.explode(F.regexp_extract_all("text", F.lit("SPN-[0-9]{4}"), F.lit(0))).alias("id"))
    return ids.join(top, ["packet", "id"]).groupBy("packet").agg(F.count("*").alias("n"))


@query("""WITH i AS (SELECT unnest(regexp_extract_all(text, '\\bSPN-[0-9]{4}\\b')) AS sponsor_id FROM documents) SELECT DISTINCT sponsor_id FROM i""")
def a_harvested_ids(spark, d) -> DataFrame:
    return table(spark, d, "documents").select(F.explode(F.regexp_extract_all("text", F.lit(r"\bSPN-[0-9]{4}\b"), F.lit(0))).alias("sponsor_id")).distinct()


_ORD = "(epoch_us(read_at), record_id)"


def _order() -> list:
    return [F.unix_micros(F.col("read_at").cast("timestamp")), F.col("record_id")]


@query(f"""SELECT case_id, arg_min(applicant_name, {_ORD}) FILTER (WHERE applicant_name IS NOT NULL) AS first_name, arg_max(fee_status, {_ORD}) FILTER (WHERE fee_status IS NOT NULL) AS last_fee
FROM records GROUP BY 1""")
def w_first_last(spark, d) -> DataFrame:
    r = table(spark, d, "records")
    first = consolidate.first_by(r, ["case_id"], _order(), ["applicant_name"]).withColumnRenamed("applicant_name", "first_name")
    return first.join(consolidate.last_by(r, ["case_id"], _order(), ["fee_status"]).withColumnRenamed("fee_status", "last_fee"), "case_id")


@query("""WITH f(field, priority, digital) AS (VALUES ('applicant_name', 1, true), ('species_code', 1, true), ('declared_purpose', 1, false)),
e AS (SELECT r.case_id, f.field, f.digital, r.ocr_used AS is_ocr, CASE f.field WHEN 'applicant_name' THEN applicant_name WHEN 'species_code' THEN species_code ELSE declared_purpose END AS value,
        coalesce(r.field_sources[f.field], 'none') AS source FROM records r CROSS JOIN f),
b AS (SELECT *, regexp_matches(value, '^\\[|\\]$') AS bad, coalesce(t.trust_rank, 99) AS priority FROM e LEFT JOIN source_trust t ON t.source_name = e.source WHERE value IS NOT NULL AND value <> ''),
o AS (SELECT *, row_number() OVER (PARTITION BY case_id, field ORDER BY bad, (digital AND is_ocr AND NOT bad), priority, value) AS rn FROM b)
SELECT case_id, field, value FROM o WHERE rn = 1""")
def w_priority_pick(spark, d) -> DataFrame:
    fields = ["applicant_name", "species_code", "declared_purpose"]
    pairs = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("value"), F.coalesce(F.try_element_at("field_sources", F.lit(f)), F.lit("none")).alias("source")) for f in fields])
    rows = table(spark, d, "records").select("case_id", F.col("ocr_used").alias("is_ocr"), F.inline(pairs))
    trust = F.broadcast(table(spark, d, "source_trust").select(F.col("source_name").alias("source"), "trust_rank"))
    rows = rows.join(trust, "source", "left").withColumn("priority", F.coalesce("trust_rank", F.lit(99))).withColumn("bad", F.col("value").rlike(r"^\[|\]$"))
    return consolidate.priority_pick(rows, ["applicant_name", "species_code"]).select("case_id", "field", "value")


_VOTE = "trim(regexp_replace(lower(regexp_replace({0}, '[ \\t\\n\\r\\f\\x0b]+', ' ', 'g')), '[^a-z0-9 ]', '', 'g'))"


@query(f"""WITH r AS (SELECT case_id, applicant_name AS v, record_id, {_VOTE.format('applicant_name')} AS k FROM records),
cur AS (SELECT case_id, arg_min(v, record_id) AS value, arg_min(k, record_id) AS ck FROM r WHERE v IS NOT NULL GROUP BY 1),
cnt AS (SELECT case_id, k, count(*) AS n, arg_min(v, record_id) AS written FROM r WHERE v IS NOT NULL AND v <> '' GROUP BY 1, 2),
best AS (SELECT case_id, n, k, written, row_number() OVER (PARTITION BY case_id ORDER BY n DESC, k DESC) AS rn FROM cnt)
SELECT cur.case_id, CASE WHEN best.n >= 2 AND coalesce(own.n, 0) <= 1 AND best.k <> cur.ck AND cur.value <> '' THEN best.written ELSE cur.value END AS value,
  coalesce(best.n >= 2 AND coalesce(own.n, 0) <= 1 AND best.k <> cur.ck AND cur.value <> '', false) AS voted
FROM cur LEFT JOIN best ON best.case_id = cur.case_id AND best.rn = 1 LEFT JOIN cnt own ON own.case_id = cur.case_id AND own.k = cur.ck""")
def a_corroborated(spark, d) -> DataFrame:
    r = table(spark, d, "records").where("applicant_name is not null")
    cur = r.groupBy("case_id").agg(F.min_by("applicant_name", "record_id").alias("value")).withColumn("is_digital", F.lit(False))
    return consolidate.corroborated(cur, r.select("case_id", F.col("applicant_name").alias("value"), F.col("record_id").alias("ord")))


@query("""WITH r AS (SELECT case_id, species_code AS v, record_id AS ord FROM records WHERE regexp_full_match(species_code, '[A-Z_]+')),
s AS (SELECT case_id, length(v) AS n, count(*) AS c, min(ord) AS o FROM r GROUP BY 1, 2),
len AS (SELECT case_id, n, c FROM (SELECT *, row_number() OVER (PARTITION BY case_id ORDER BY c DESC, o) AS rn FROM s) WHERE rn = 1),
ch AS (SELECT r.case_id, CAST(i AS INT) AS p, r.v[i] AS ch, ord FROM r JOIN len ON r.case_id = len.case_id AND length(r.v) = len.n AND len.c >= 2, unnest(generate_series(1, length(r.v))) AS u(i)),
v AS (SELECT case_id, p, ch, count(*) AS c, min(ord) AS o FROM ch GROUP BY 1, 2, 3),
t AS (SELECT case_id, p, ch FROM (SELECT *, row_number() OVER (PARTITION BY case_id, p ORDER BY c DESC, o) AS rn FROM v) WHERE rn = 1),
m AS (SELECT case_id, string_agg(ch, '' ORDER BY p) AS value FROM t GROUP BY 1),
w AS (SELECT case_id, v, row_number() OVER (PARTITION BY case_id ORDER BY count(*) DESC, min(ord)) AS rn FROM r GROUP BY 1, 2)
SELECT w.case_id, coalesce(m.value, w.v) AS value FROM w LEFT JOIN m ON m.case_id = w.case_id WHERE w.rn = 1""")
def a_char_majority(spark, d) -> DataFrame:
    r = table(spark, d, "records").where(F.col("species_code").rlike(r"^[A-Z_]+\z"))
    return consolidate.char_majority(r.select("case_id", F.col("species_code").alias("value"), F.col("record_id").alias("ord")))


@query("""WITH o AS (SELECT *, row_number() OVER (PARTITION BY case_id ORDER BY record_id) AS rn FROM records),
b AS (SELECT * FROM o WHERE rn = 1), s AS (SELECT * FROM o WHERE rn = 2)
SELECT b.case_id, coalesce(nullif(b.applicant_name, ''), nullif(s.applicant_name, '')) AS applicant_name, coalesce(nullif(b.home_world, ''), nullif(s.home_world, '')) AS home_world,
  array_to_string(list_sort(list_distinct(coalesce(b.present_pages, []) || coalesce(s.present_pages, []))), '|') AS pages,
  coalesce(b.identity_conflict, false) OR coalesce(s.identity_conflict, false) AS identity_conflict
FROM b LEFT JOIN s ON s.case_id = b.case_id""")
def j_merged(spark, d) -> DataFrame:
    r = table(spark, d, "records").withColumn("rn", F.row_number().over(Window.partitionBy("case_id").orderBy("record_id"))).where("rn <= 2")
    out = consolidate.merged(r.where("rn = 1"), r.where("rn = 2"), "case_id", ["applicant_name", "home_world"], ["present_pages"], ["identity_conflict"])
    return out.select("case_id", "applicant_name", "home_world", F.array_join("present_pages", "|").alias("pages"), "identity_conflict")


_C = "regexp_replace(lower({0}), '[^a-z0-9]', '', 'g')"


@query(f"""WITH n AS (SELECT DISTINCT case_id, {_C.format('applicant_name')} AS k FROM records WHERE applicant_name IS NOT NULL AND NOT regexp_matches(applicant_name, '^\\[|\\]$')),
p AS (SELECT a.case_id, bool_or(NOT (contains(a.k, b.k) OR contains(b.k, a.k) OR levenshtein(a.k, b.k) <= greatest(2, floor(greatest(length(a.k), length(b.k)) * 0.34)))) AS conflict
      FROM n a JOIN n b ON a.case_id = b.case_id AND a.k < b.k GROUP BY 1)
SELECT DISTINCT n.case_id, coalesce(p.conflict, false) AS conflict FROM n LEFT JOIN p ON p.case_id = n.case_id""")
def j_names_conflict(spark, d) -> DataFrame:
    r = table(spark, d, "records").where(F.col("applicant_name").isNotNull() & ~F.col("applicant_name").rlike(r"^\[|\]$"))
    names = r.groupBy("case_id").agg(F.collect_set(canon(F.col("applicant_name"))).alias("names"))  # distinct readings of one case
    return names.select("case_id", consolidate.names_conflict(F.col("names")).alias("conflict"))


@query("""SELECT case_id, array_to_string(list_sort(list_distinct(flatten(list(present_pages)))), '|') AS pages FROM records GROUP BY 1""")
def a_present_pages(spark, d) -> DataFrame:
    r = table(spark, d, "records").select("case_id", F.explode_outer("present_pages").alias("p"))
    return r.groupBy("case_id").agg(F.array_join(F.array_sort(F.collect_set("p")), "|").alias("pages"))


@query("""SELECT record_id, CAST(coalesce(trim(applicant_name) = '', true) AS INT) + CAST(coalesce(trim(species_code) = '', true) AS INT) + CAST(coalesce(trim(home_world) = '', true) AS INT)
  + CAST(coalesce(trim(sponsor_id) = '', true) AS INT) AS blanks FROM records""")
def p_deficiency(spark, d) -> DataFrame:
    return table(spark, d, "records").select("record_id", consolidate.deficiency([F.col(c) for c in ("applicant_name", "species_code", "home_world", "sponsor_id")]).alias("blanks"))


_REF = """v AS (SELECT CAST(arrival_date AS DATE) AS d FROM records WHERE regexp_full_match(arrival_date, '[0-9]{4}-[0-9]{2}-[0-9]{2}') AND try_cast(arrival_date AS DATE) IS NOT NULL),
s AS (SELECT d, row_number() OVER (ORDER BY d) - 1 AS i, count(*) OVER () AS n FROM v), m AS (SELECT d AS median FROM s WHERE i = n // 2),
k AS (SELECT v.d, row_number() OVER (ORDER BY v.d) - 1 AS i, count(*) OVER () AS n FROM v, m WHERE v.d <= m.median + 366),
ref AS (SELECT d + 30 AS reference FROM k WHERE i = least(n - 1, CAST(floor(n * 0.99) AS BIGINT)))"""


def _reference(spark: SparkSession, d: str) -> DataFrame:
    dates = table(spark, d, "records").select(X.parse_date(F.when(F.col("arrival_date").rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}\z"), F.col("arrival_date"))).alias("d"))
    return consolidate.reference_date(dates, "d")


@query(f"WITH {_REF} SELECT reference FROM ref")
def a_reference_date(spark, d) -> DataFrame:
    return _reference(spark, d)


@query(f"""WITH {_REF}, w AS (SELECT record_id, try_cast(nullif(regexp_extract(arrival_date, '\\b([0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}})\\b', 1), '') AS DATE) AS ad FROM records)
SELECT record_id, CASE WHEN ad IS NULL THEN 'none' WHEN reference - ad > 365 THEN 'deep' WHEN reference - ad > 180 THEN 'mid' ELSE 'fresh' END AS band FROM w, ref""")
def j_staleness(spark, d) -> DataFrame:
    r = table(spark, d, "records").select("record_id", X.parse_date(F.col("arrival_date")).alias("ad")).crossJoin(F.broadcast(_reference(spark, d)))  # one row
    age = F.datediff("reference", "ad")
    return r.select("record_id", F.when(F.col("ad").isNull(), "none").when(age > 365, "deep").when(age > 180, "mid").otherwise("fresh").alias("band"))


@query("""WITH r AS (SELECT o_orderkey, o_orderdate AS d, DATE '1996-06-01' AS now FROM orders), s AS (SELECT *, try_cast('1996' || strftime(d, '-%m-%d') AS DATE) AS other FROM r)
SELECT o_orderkey, CAST(CASE WHEN abs(year(d) - 1996) > 1 THEN coalesce(other, CAST(d AS DATE)) ELSE CAST(d AS DATE) END AS DATE) AS repaired FROM s""")
def f_era_repair(spark, d) -> DataFrame:
    return table(spark, d, "orders").select("o_orderkey", X.era_repair(F.col("o_orderdate").cast("date"), F.lit("1996-06-01").cast("date")).alias("repaired"))


@query("""SELECT record_id, array_to_string(list_sort(list_intersect(s, ['memory_edit', 'orbit_ban'])), '|') AS both, array_to_string(list_sort(list_filter(s, lambda x: x NOT IN ('memory_edit', 'orbit_ban'))), '|') AS rest,
  array_to_string(list_sort(list_distinct(s || ['forged_seal'])), '|') AS every
FROM (SELECT record_id, list_distinct(list_filter(list_transform(string_split(lower(coalesce(risk_flags, '')), '|'), lambda x: trim(x)), lambda x: x NOT IN ('', 'none', 'null'))) AS s FROM records)""")
def u_flag_sets(spark, d) -> DataFrame:
    s = F.array_distinct(F.filter(F.transform(F.split(F.lower(F.coalesce("risk_flags", F.lit(""))), "[|]"), lambda x: F.trim(x)), lambda x: ~x.isin("", "none", "null")))
    some = F.array(F.lit("memory_edit"), F.lit("orbit_ban"))
    join = lambda a: F.array_join(F.array_sort(a), "|")
    return table(spark, d, "records").select("record_id", join(F.array_intersect(s, some)).alias("both"), join(F.array_except(s, some)).alias("rest"), join(F.array_union(s, F.array(F.lit("forged_seal")))).alias("every"))


@query("""SELECT 'except' AS op, case_id FROM (SELECT case_id FROM manifest EXCEPT SELECT case_id FROM records) UNION ALL
SELECT 'intersect', case_id FROM (SELECT case_id FROM manifest INTERSECT SELECT case_id FROM submissions)""")
def u_id_sets(spark, d) -> DataFrame:
    m, r, s = (table(spark, d, t).select("case_id") for t in ("manifest", "records", "submissions"))
    return m.subtract(r).select(F.lit("except").alias("op"), "case_id").unionByName(m.intersect(s).select(F.lit("intersect").alias("op"), "case_id"))


@query("""SELECT m.case_id, m.file_path FROM manifest m WHERE NOT EXISTS (SELECT 1 FROM records r WHERE r.case_id = m.case_id AND r.applicant_name IS NOT NULL)""")
def j_resume(spark, d) -> DataFrame:
    done = table(spark, d, "records").where("applicant_name is not null").select("case_id").distinct()
    return table(spark, d, "manifest").join(done, "case_id", "left_anti").select("case_id", "file_path")


@query("""SELECT case_id, regexp_extract(file_path, '([^/]+)\\.pdf$', 1) AS stem, CASE WHEN regexp_matches(file_path, 'MIB-[0-9]{6,}') THEN regexp_extract(file_path, 'MIB-[0-9]{6,}', 0) END AS packet_id FROM manifest""")
def s_manifest_paths(spark, d) -> DataFrame:
    return table(spark, d, "manifest").select("case_id", F.regexp_extract("file_path", r"([^/]+)\.pdf$", 1).alias("stem"), F.nullif(F.regexp_extract("file_path", "MIB-[0-9]{6,}", 0), F.lit("")).alias("packet_id"))


@query("""SELECT record_id, x.k AS field, x.v AS value FROM (SELECT record_id, unnest(map_entries(corrections)) AS e FROM records), LATERAL (SELECT e.key AS k, e.value AS v) x WHERE x.v <> '' AND NOT starts_with(x.v, '[')""")
def f_corrections(spark, d) -> DataFrame:
    rows = table(spark, d, "records").select("record_id", F.explode("corrections").alias("field", "value"))
    return rows.where((F.col("value") != "") & ~F.col("value").startswith("["))
