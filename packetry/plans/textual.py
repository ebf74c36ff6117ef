"""Queries of the scalar functions and row-local fuzzy operators, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from packetry.functions import extract as X
from packetry.functions.lexicon import load
from packetry.functions.text import canon, ocr_fold, valid_iso_date
from packetry.operators import fuzzy
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


def _vocabulary(spark: SparkSession, d: str, field: str) -> list[str]:
    return [r[2] for r in load(table(spark, d, "code_list")) if r[1] == field]


_CANON = "regexp_replace(lower({0}), '[^a-z0-9]', '', 'g')"
_NORM = "lower(trim(regexp_replace(coalesce({0}, ''), '[ \\t\\n\\r\\f\\x0b]+', ' ', 'g')))"


@query(f"""SELECT record_id, {_CANON.format('applicant_name')} AS canon,
  translate(replace({_CANON.format('applicant_name')}, 'rn', 'm'), '0158q', 'olsbo') AS folded FROM records""")
def f_canon_fold(spark, d) -> DataFrame:
    c = canon(F.col("applicant_name"))
    return table(spark, d, "records").select("record_id", c.alias("canon"), ocr_fold(c).alias("folded"))


@query(f"SELECT record_id, {_NORM.format('applicant_name')} AS name, {_NORM.format('home_world')} AS world FROM records")
def f_normalize(spark, d) -> DataFrame:
    return table(spark, d, "records").select("record_id", X.normalize(F.col("applicant_name")).alias("name"), X.normalize(F.col("home_world")).alias("world"))


_PARTS = "list_filter(list_transform(string_split_regex(n, '{0}'), lambda x: trim(x)), lambda x: x <> '')"


@query(f"""WITH r AS (SELECT record_id, {_NORM.format('risk_flags')} AS n FROM records)
SELECT record_id,
  CASE WHEN n IN ('', 'none', 'null', 'unknown') THEN 'none' ELSE array_to_string(list_sort({_PARTS.format('[|]')}), '|') END AS normalized,
  CASE WHEN n IN ('', 'none', 'null') THEN '' ELSE array_to_string(list_sort(list_distinct({_PARTS.format('[|]')})), '|') END AS members,
  CASE WHEN n IN ('', 'none', 'null', 'unknown', 'n/a') OR len(list_filter({_PARTS.format('[|,]')}, lambda x: x <> 'none')) = 0 THEN 'none'
       ELSE array_to_string(list_sort(list_distinct(list_filter({_PARTS.format('[|,]')}, lambda x: x <> 'none'))), '|') END AS listed
FROM r""")
def f_flags(spark, d) -> DataFrame:
    c = F.col("risk_flags")
    return table(spark, d, "records").select("record_id", X.normalize_flags(c).alias("normalized"), F.array_join(X.split_pipe(c), "|").alias("members"), X.flag_list(c).alias("listed"))


@query("""SELECT record_id, replace(regexp_replace(upper(visa_class), '([A-Z])[.,_ ]([0-9])', '\\1-\\2', 'g'), ' ', '') AS visa FROM records""")
def f_visa_normalize(spark, d) -> DataFrame:
    return table(spark, d, "records").select("record_id", X.visa_normalize(F.col("visa_class")).alias("visa"))


_SHAPED = "[0-9OoQDIl|!SsBZzG]"
_FIND_SPONSOR = f"""coalesce(nullif(regexp_extract({{0}}, '\\bSPN-[0-9]{{{{3,}}}}\\b', 0), ''),
  CASE WHEN regexp_full_match(translate(regexp_extract({{0}}, '\\bSPN[\\s\\-–—._]*({_SHAPED}{{{{4}}}})\\b', 1), 'OoQDIl|!SsBZzG', '00001111558226'), '[0-9]{{{{4}}}}')
       THEN 'SPN-' || translate(regexp_extract({{0}}, '\\bSPN[\\s\\-–—._]*({_SHAPED}{{{{4}}}})\\b', 1), 'OoQDIl|!SsBZzG', '00001111558226') END)""".replace("{{{{", "{{").replace("}}}}", "}}")


@query(f"""SELECT record_id, {_FIND_SPONSOR.format('sponsor_id')} AS found,
  coalesce(nullif(regexp_extract(sponsor_id, 'SPN-[0-9]{{4}}', 0), ''), {_FIND_SPONSOR.format('sponsor_id')}, 'SPN-0000') AS clean FROM records""")
def f_sponsor(spark, d) -> DataFrame:
    c = F.col("sponsor_id")
    return table(spark, d, "records").select("record_id", X.find_sponsor(c).alias("found"), X.clean_sponsor(c).alias("clean"))


_DATE = "nullif(regexp_extract({0}, '\\b([0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}})\\b', 1), '')"
_LOOSE = f"""translate(concat_ws('-', nullif(regexp_extract(v, '{{p}}', 1), ''), nullif(regexp_extract(v, '{{p}}', 2), ''), nullif(regexp_extract(v, '{{p}}', 3), '')), 'OoQDIl|!SsBZzG', '00001111558226')""".replace("{p}", f"\\b({_SHAPED}{{4}})[-–—.]({_SHAPED}{{2}})[-–—.]({_SHAPED}{{2}})\\b")
_IS_DATE = "(regexp_full_match({0}, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}') AND try_cast({0} AS DATE) IS NOT NULL)"


@query(f"""WITH r AS (SELECT record_id, arrival_date AS v FROM records),
s AS (SELECT record_id, v, {_DATE.format('v')} AS strict, {_LOOSE} AS loose FROM r),
f AS (SELECT *, coalesce(strict, CASE WHEN {_IS_DATE.format('loose')} THEN loose END) AS found FROM s)
SELECT record_id, found, coalesce({_IS_DATE.format('v')}, false) AS valid, try_cast(strict AS DATE) AS parsed,
  coalesce(CASE WHEN {_IS_DATE.format('strict')} THEN strict END, CASE WHEN {_IS_DATE.format('found')} THEN found END, '1900-01-01') AS clean FROM f""")
def f_dates(spark, d) -> DataFrame:
    c = F.col("arrival_date")
    return table(spark, d, "records").select("record_id", X.find_date(c).alias("found"), valid_iso_date(c).alias("valid"), X.parse_date(c).alias("parsed"), X.clean_date(c).alias("clean"))


@query(f"""SELECT record_id, least(5, levenshtein({_CANON.format('applicant_name')}, {_CANON.format('sponsor_letter_name')})) AS edits
FROM records WHERE applicant_name IS NOT NULL AND sponsor_letter_name IS NOT NULL""")
def f_edit_distance(spark, d) -> DataFrame:
    rows = table(spark, d, "records").where("applicant_name is not null and sponsor_letter_name is not null")
    return rows.select("record_id", X.capped_distance(canon(F.col("applicant_name")), canon(F.col("sponsor_letter_name"))).alias("edits"))


@query(f"""WITH r AS (SELECT record_id, {_CANON.format('applicant_name')} AS a, {_CANON.format('sponsor_letter_name')} AS b FROM records
  WHERE applicant_name IS NOT NULL AND sponsor_letter_name IS NOT NULL)
SELECT record_id, contains(a, b) OR contains(b, a) OR levenshtein(a, b) <= greatest(2, floor(greatest(length(a), length(b)) * 0.34)) AS same FROM r""")
def f_same_person(spark, d) -> DataFrame:
    rows = table(spark, d, "records").where("applicant_name is not null and sponsor_letter_name is not null")
    return rows.select("record_id", X.same_person(F.col("applicant_name"), F.col("sponsor_letter_name")).alias("same"))


@query("""WITH r AS (SELECT record_id, '$' || fee_amount AS t, applicant_name AS n FROM records)
SELECT record_id, CAST(nullif(replace(regexp_extract(t, '\\$\\s*([0-9][0-9,]*\\.[0-9]{2})', 1), ',', ''), '') AS DOUBLE) AS amount,
  regexp_replace(n, '[^A-Za-z)\\]]+$', '') AS stripped,
  coalesce(nullif(trim(regexp_replace(n, '[ \\t\\n\\r\\f\\x0b]+', ' ', 'g')), ''), 'unknown') AS clean FROM r""")
def f_amount_and_cleaning(spark, d) -> DataFrame:
    return table(spark, d, "records").select(
        "record_id", X.amount(F.concat(F.lit("$"), "fee_amount")).cast("double").alias("amount"), X.strip_trailing_junk(F.col("applicant_name")).alias("stripped"), X.clean_text(F.col("applicant_name")).alias("clean")
    )


@query("""WITH r AS (SELECT record_id, applicant_name AS n, string_split(trim(regexp_replace(applicant_name, '[ \\t\\n\\r\\f\\x0b]+', ' ', 'g')), ' ') AS w FROM records)
SELECT record_id, CASE WHEN len(w) > 2 AND lower(w[1]) <> 'unknown' THEN w[1] || ' ' || w[2] ELSE n END AS short FROM r""")
def f_two_words(spark, d) -> DataFrame:
    return table(spark, d, "records").select("record_id", X.first_two_words(F.col("applicant_name")).alias("short"))


@query("""SELECT r.record_id, coalesce(min(c.canonical), any_value(r.species_code)) AS species
FROM records r LEFT JOIN code_list c ON c.field_name = 'species_code' AND length(r.species_code) > length(c.canonical)
  AND starts_with(lower(r.species_code), lower(c.canonical)) AND NOT regexp_matches(substr(r.species_code, length(c.canonical) + 1, 1), '[A-Za-z0-9]')
GROUP BY 1""")
def f_prefix_truncate(spark, d) -> DataFrame:
    return table(spark, d, "records").select("record_id", X.prefix_truncate(F.col("species_code"), _vocabulary(spark, d, "species_code")).alias("species"))


@query("""WITH o AS (SELECT o_orderkey, (o_orderkey * 2654435761) % 16777216 AS color FROM orders)
SELECT o_orderkey, CAST(color >> 16 & 255 AS INT) AS red, CAST(color >> 8 & 255 AS INT) AS green, CAST(color & 255 AS INT) AS blue,
  least(color >> 16 & 255, color >> 8 & 255, color & 255) > 200 AS pale FROM o""")
def f_ink(spark, d) -> DataFrame:
    color = (F.col("o_orderkey").cast("bigint") * F.lit(2654435761)) % F.lit(16777216)
    r, g, b = X.channels(color)
    return table(spark, d, "orders").select("o_orderkey", r.cast("int").alias("red"), g.cast("int").alias("green"), b.cast("int").alias("blue"), X.pale(color).alias("pale"))


def _correct_sql(field: str, ratio: float = 0.34) -> str:
    k, e = _CANON.format("r.v"), _CANON.format("c.canonical")
    fold = "translate(replace({0}, 'rn', 'm'), '0158q', 'olsbo')"
    return f"""WITH r AS (SELECT DISTINCT {field} AS v FROM records WHERE {field} IS NOT NULL),
j AS (SELECT r.v, {k} AS k, c.canonical, {e} AS e, levenshtein({k}, {e}) AS d1, levenshtein({fold.format(k)}, {fold.format(e)}) AS d2,
        greatest(1, CAST(floor(length({e}) * {ratio}) AS INT)) AS cap
      FROM r CROSS JOIN code_list c WHERE c.field_name = '{field}'),
n AS (SELECT v, k, canonical, e, least(CASE WHEN d1 <= cap THEN d1 ELSE 99 END, CASE WHEN d2 <= cap THEN d2 ELSE 99 END) AS d FROM j),
m AS (SELECT v, min(d) AS least, max(CASE WHEN k = e THEN canonical END) AS exact FROM n GROUP BY v),
u AS (SELECT n.v, any_value(m.exact) AS exact, CASE WHEN count(*) FILTER (WHERE n.d = m.least AND n.d < 99) = 1 AND any_value(n.k) <> ''
        THEN max(CASE WHEN n.d = m.least THEN n.canonical END) END AS near FROM n JOIN m ON n.v = m.v GROUP BY n.v)
SELECT records.record_id, coalesce(u.exact, u.near, records.{field}) AS value FROM records LEFT JOIN u ON records.{field} = u.v"""


@query(_correct_sql("species_code"))
def j_correct_species(spark, d) -> DataFrame:
    return fuzzy.corrected(table(spark, d, "records").select("record_id", "species_code"), "species_code", _vocabulary(spark, d, "species_code")).select("record_id", "value")


@query(_correct_sql("home_world"))
def j_correct_world(spark, d) -> DataFrame:
    return fuzzy.corrected(table(spark, d, "records").select("record_id", "home_world"), "home_world", _vocabulary(spark, d, "home_world")).select("record_id", "value")


@query(f"""WITH t AS (SELECT DISTINCT {_CANON.format("string_split(applicant_name, ' ')[1]")} AS token FROM records WHERE applicant_name IS NOT NULL),
g AS (SELECT DISTINCT given_name FROM name_aliases),
j AS (SELECT token, given_name, levenshtein(lower(token), lower(given_name)) AS d FROM t JOIN g ON abs(length(token) - length(given_name)) <= 2),
k AS (SELECT token, given_name, d, min(d) OVER (PARTITION BY token) AS least FROM j WHERE d <= 2),
u AS (SELECT token, CASE WHEN count(*) = 1 THEN min(given_name) END AS hit FROM k WHERE d = least GROUP BY token)
SELECT t.token, coalesce(u.hit, t.token) AS fixed FROM t LEFT JOIN u ON t.token = u.token""")
def j_token_nearest(spark, d) -> DataFrame:
    given = sorted(r[0] for r in table(spark, d, "name_aliases").select("given_name").where("given_name is not null").distinct().limit(fuzzy.MAX_VOCABULARY + 1).collect())
    tokens = table(spark, d, "records").where("applicant_name is not null").select(canon(F.get(F.split("applicant_name", " "), F.lit(0))).alias("token")).distinct()
    return tokens.select("token", fuzzy.token_nearest(F.col("token"), given).alias("fixed"))


_PHRASES = ", ".join(f"'{fuzzy._c(p)}'" for p in fuzzy.DAMAGE_PHRASES)


@query(f"""WITH r AS (SELECT record_id, home_world AS v, {_CANON.format('home_world')} AS k, trim(home_world) AS t FROM records)
SELECT record_id, coalesce(starts_with(t, '[') OR suffix(t, ']') OR regexp_matches(v, '(?i)\\b(unreadable|illegible|washed\\s*out|whiteout|cut\\s*out|torn|redacted|corrupt|registry\\s*lost|missing)\\b')
  OR len(list_filter([{_PHRASES}], lambda p: abs(length(k) - length(p)) <= 3 AND levenshtein(k, p) <= 2)) > 0, false) AS damaged FROM r""")
def p_damaged(spark, d) -> DataFrame:
    return table(spark, d, "records").select("record_id", fuzzy.damaged(F.col("home_world")).alias("damaged"))


_FLAGS_SQL = "(SELECT list(canonical ORDER BY canonical) FROM code_list WHERE field_name = 'risk_flags')"


@query(f"""WITH r AS (SELECT record_id, list_filter({_FLAGS_SQL}, lambda f: contains(regexp_replace(lower(risk_flags), '[ \\t\\n\\r_]+', '_', 'g'), f)) AS found FROM records)
SELECT record_id, CASE WHEN found IS NULL OR len(found) = 0 THEN 'none' ELSE array_to_string(found, '|') END AS flags FROM r""")
def f_contained_flags(spark, d) -> DataFrame:
    return table(spark, d, "records").select("record_id", fuzzy.contained_flags(F.col("risk_flags"), _vocabulary(spark, d, "risk_flags")).alias("flags"))


@query()
def f_correct_flag_tokens(spark, d) -> DataFrame:
    return table(spark, d, "records").select("record_id", fuzzy.correct_flag_tokens(F.col("risk_flags"), _vocabulary(spark, d, "risk_flags")).alias("flags"))


@query(f"""WITH p AS (SELECT record_id, {_CANON.format('x')} AS k FROM (SELECT record_id, unnest(string_split_regex(risk_flags, '[|,;/]')) AS x FROM records)),
j AS (SELECT DISTINCT k FROM p WHERE k NOT IN ('', 'none', 'nome', 'norne')),
c AS (SELECT j.k, l.canonical AS f, levenshtein(j.k, {_CANON.format('l.canonical')}) / length({_CANON.format('l.canonical')}) AS d FROM j CROSS JOIN code_list l WHERE l.field_name = 'risk_flags'),
o AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY d, f) AS rn, lead(d) OVER (PARTITION BY k ORDER BY d, f) AS second FROM c),
b AS (SELECT k, f FROM o WHERE rn = 1 AND (d <= 0.5 OR (d <= CASE WHEN f IN ('orbit_ban', 'open_summons') THEN 0.55 ELSE 0.60 END AND second - d >= 0.08))),
v AS (SELECT record_id, f AS flag, count(*) AS votes FROM p JOIN b ON p.k = b.k GROUP BY 1, 2)
SELECT record_id, array_to_string(list(flag ORDER BY flag), '|') AS flags FROM v WHERE votes >= 2 OR flag NOT IN ('orbit_ban', 'open_summons') GROUP BY 1""")
def a_flag_votes(spark, d) -> DataFrame:
    tight = ["orbit_ban", "open_summons"]
    votes = fuzzy.flag_votes(table(spark, d, "records"), "record_id", "risk_flags", _vocabulary(spark, d, "risk_flags"), tight)
    return fuzzy.accepted_flags(votes, "record_id", tight)


@query()
def p_note_and_anchor(spark, d) -> DataFrame:
    docs = table(spark, d, "documents")
    return docs.select("doc_id", fuzzy.note_like(F.col("text")).alias("note_like"), fuzzy.slip_anchor(F.col("text")).alias("anchor"), fuzzy.label_line_value(F.get(F.split("text", "\n"), F.lit(0))).alias("rest"))


@query()
def f_word_family(spark, d) -> DataFrame:
    families = [(["postponed", "arrival", "shuttle"], "travel"), (["quarantine"], "quarantine"), (["envelope", "portrait"], "evidence")]
    return table(spark, d, "documents").select("doc_id", fuzzy.word_family(F.col("text"), families).alias("family"))
