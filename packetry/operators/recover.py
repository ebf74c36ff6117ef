"""Fields, flags and letters from lines whose labels or layout a scan has damaged: operators over lines (packet, page, line_no, text).

Vocabularies are closed lists given by the caller. The first line that tells a field holds; null texts tell nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from packetry.functions.extract import find_date, find_sponsor, visa_normalize
from packetry.functions.text import bind, canon, strip, valid_iso_date
from packetry.operators.fuzzy import damaged, flag_votes, label_line_value, vocabulary_correct, word_family

# A label of two words, then ':', '.' or a blank; printed matter behind a value; label and words of a flag line.
LABEL = r"^\s*(\S+\s+\S+?)[:.\s]\s*(.+)$"
IMAGE = r"\s*(PASSPORT|REGISTRY|SCAN)\s+IMAGE.*$"
FLAG_LABEL = "observedflags"
NO_FLAG_WORDS = ("none", "nome", "norne")
FINDING = r"(?i)Finding:\s*(APPROVED|DENIED|NEEDS_REVIEW)\.?\s*Reason:\s*(.*)"
REASON_START = r"(?i)reas[oa]?r?|resor|\breason\b"
VERDICT_LETTERS = {"APPROVED": "APPRO|APPRV", "NEEDS_REVIEW": "REVI|NEEDS", "DENIED": r"DENI|DEN1|DEMED|DEWE|DEMIED|\bDEN\b"}
NOTICE = r"(?i)sponsor\s+standing\s+requires\s+additional\s+verification"


def _some(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def _label_value(c: Column) -> tuple[Column, Column]:
    """(label, value) of a line, cut at the first ':', else behind its first two words."""
    at = F.locate(":", c)
    part = lambda i: F.regexp_extract(c, LABEL, i)
    return F.when(at > 0, F.substr(c, F.lit(1), at - 1)).otherwise(part(1)), strip(F.when(at > 0, F.substr(c, at + 1)).otherwise(part(2)))


def _one_of(values: list[str]) -> str:
    return "(" + "|".join(sorted(values, key=len, reverse=True)) + ")"


def visa_of(c: Column, visas: list[str]) -> Column:
    return _some(F.regexp_extract(visa_normalize(c), rf"\b{_one_of(visas)}\b", 1))


def inline_cell(c: Column, labels: dict[str, str]) -> Column:
    """struct(field, value) of a "label value" line, null if it tells none; labels: letters of a label to its field, long ones also within 30 percent."""
    names = F.create_map(*[F.lit(x) for pair in labels.items() for x in pair])

    def cell(x: Column) -> Column:
        near = F.when(F.length(x["key"]) >= 6, vocabulary_correct(x["key"], list(labels), 0.3))
        value = F.when(x["value"].contains("IMAGE"), strip(F.regexp_replace(x["value"], IMAGE, ""))).otherwise(x["value"])
        told = bind(value, lambda v: F.when((v != "") & ~damaged(x["value"]), v))
        field = F.coalesce(F.try_element_at(names, x["key"]), F.try_element_at(names, near))
        return bind(F.when(x["value"] != "", field), lambda f: F.when(f.isNotNull(), bind(told, lambda v: F.when(v.isNotNull(), F.struct(f.alias("field"), v.alias("value"))))))

    label, value = _label_value(c)
    return bind(F.struct(canon(label).alias("key"), value.alias("value")), cell)


def fuzzy_inline_fields(lines: DataFrame, labels: dict[str, str]) -> DataFrame:
    """(packet, page, field, value) of "label value" lines by inline_cell()."""
    rows = lines.select("packet", "page", "line_no", inline_cell(F.col("text"), labels).alias("x")).where("x is not null")
    return rows.groupBy("packet", "page", F.col("x.field").alias("field")).agg(F.min_by("x.value", "line_no").alias("value"))


def swept_cells(text: Column, visas: list[str], vocabularies: dict[str, list[str]]) -> Column:
    """Array of struct(field, value) of what a line tells by its shape alone, null where it tells nothing of a field."""
    at = F.locate(":", text)
    tail = strip(F.when(at > 0, F.substr(text, at + 1)).otherwise(text))
    date = find_date(text)
    found = {"sponsor_id": find_sponsor(text), "arrival_date": F.when(valid_iso_date(date), date), "visa_class": visa_of(text, visas)}
    found |= {f: F.when(visa_of(tail, visas).isNull(), vocabulary_correct(tail, v, 0.25)) for f, v in vocabularies.items()}
    return F.array(*[F.struct(F.lit(f).alias("field"), c.alias("value")) for f, c in found.items()])


def pattern_sweep(lines: DataFrame, visas: list[str], vocabularies: dict[str, list[str]]) -> DataFrame:
    """(packet, page, field, value) of values known by their shape alone: sponsor, calendar date, visa class, words of a vocabulary."""
    text = F.col("text")
    rows = lines.where(text.isNotNull() & ~damaged(text)).select("packet", "page", "line_no", F.inline(swept_cells(text, visas, vocabularies))).where("value is not null")
    return rows.groupBy("packet", "page", "field").agg(F.min_by("value", "line_no").alias("value"))


def garbled_line(c: Column, flags: list[str]) -> Column:
    """Pipe list of the flags of a line with a label like "observed flags" (45 percent of edits); null if it yields none."""
    label, value = _label_value(c)
    k, size = canon(label), len(FLAG_LABEL)
    like = bind(k, lambda k: (k != "") & (F.abs(F.length(k) - size) <= 5) & (F.levenshtein(k, F.lit(FLAG_LABEL), int(size * 0.45)) >= 0))
    tokens = F.filter(F.split(value, "[|,;]"), lambda t: (F.trim(t) != "") & ~canon(t).isin(*NO_FLAG_WORDS))
    hits = F.array_compact(F.transform(tokens, lambda t: vocabulary_correct(F.trim(t), flags, 0.5)))
    return F.when(like, bind(F.array_join(F.array_sort(F.array_distinct(hits)), "|"), _some))


def garbled_flags(lines: DataFrame, flags: list[str]) -> DataFrame:
    """(packet, page, flags) of the first line with a label like "observed flags" (45 percent of edits) that yields any, else none."""
    rows = lines.select("packet", "page", "line_no", garbled_line(F.col("text"), flags).alias("found"))
    first = F.min_by("found", F.when(F.col("found").isNotNull(), F.col("line_no")))
    return rows.groupBy("packet", "page").agg(F.coalesce(first, F.lit("none")).alias("flags"))


def _flag_lines(lines: DataFrame) -> DataFrame:
    value = label_line_value(F.col("text"))
    none = F.when(canon(value).isin(*NO_FLAG_WORDS, "mone"), F.col("line_no"))
    rows = lines.select("packet", "page", "line_no", value.alias("value"), none.alias("none"))
    return rows.join(rows.groupBy("packet", "page").agg(F.min("none").alias("end"), F.count("value").alias("hits")), ["packet", "page"])


def flag_state(lines: DataFrame) -> DataFrame:
    """(packet, page, state) by the lines with a flag label: "none" if one says so, else "true" if there are any, else "false"."""
    state = F.when(F.col("end").isNotNull(), "none").when(F.col("hits") > 0, "true").otherwise("false")
    return _flag_lines(lines).select("packet", "page", state.alias("state")).distinct()


def scanned_votes(lines: DataFrame, flags: list[str], tight: list[str]) -> DataFrame:
    """(packet, page, flag, votes) of the lines with a flag label up to the first that says none."""
    rows = _flag_lines(lines).where("value is not null and (end is null or line_no < end)")
    votes = flag_votes(rows.select(F.struct("packet", "page").alias("at"), "value"), "at", "value", flags, tight)
    return votes.select("at.packet", "at.page", "flag", "votes")


def _pages(lines: DataFrame) -> DataFrame:
    rows = lines.where("text is not null").groupBy("packet", "page").agg(F.array_sort(F.collect_list(F.struct("line_no", "text"))).alias("l"))
    return rows.select("packet", "page", F.array_join("l.text", "\n").alias("text"))


def sponsor_letters(lines: DataFrame, labels: dict[str, str], visas: list[str]) -> DataFrame:
    """(packet, page, sponsor_id, name, purpose, visa, compliance_visa) of sponsor letters, from their prose, else from labelled lines."""
    either = lambda c: F.coalesce(c, f"i_{c}").alias(c)
    return letter_readings(lines, labels, visas).select("packet", "page", "sponsor_id", either("name"), either("purpose"), either("visa"), "compliance_visa")


def letter_prose(text: Column, visas: list[str]) -> dict[str, Column]:
    """What the prose of a sponsor letter says."""
    take = lambda c, pattern: _some(F.trim(F.regexp_extract(c, pattern, 1)))
    visa = rf"class\s+{_one_of(visas)}"
    return {
        "sponsor_id": find_sponsor(text), "name": take(text, "attests that (.+?) is expected"), "purpose": take(F.translate(text, "\n", " "), r"on Earth for (.+?)\."),
        "visa": take(text, visa), "compliance_visa": take(text, rf"{visa}\s+compliance"),
    }


def bare_purpose(c: Column) -> Column:
    """Value of a "Purpose: value" line."""
    label, value = _label_value(c)
    return F.when(c.contains(":"), F.when(canon(label) == "purpose", bind(value, lambda x: F.when((x != "") & ~damaged(x), x))))


def letter_readings(lines: DataFrame, labels: dict[str, str], visas: list[str]) -> DataFrame:
    """Sponsor letters with what their prose says (name, purpose, visa) apart from what labelled lines say (i_name, i_purpose, i_visa)."""
    text = F.col("text")
    pages = _pages(lines).where(text.contains("Sponsor Attestation") | text.contains("attests that"))
    prose = pages.select("packet", "page", *[c.alias(f) for f, c in letter_prose(text, visas).items()])
    field = lambda f: F.max(F.when(F.col("field") == f, F.col("value")))
    inline = fuzzy_inline_fields(lines, labels).groupBy("packet", "page").agg(field("applicant_name").alias("i_name"), field("declared_purpose").alias("i_purpose"), field("visa_class").alias("i_visa"))
    bare = lines.select("packet", "page", "line_no", bare_purpose(text).alias("value")).where("value is not null")
    bare = bare.groupBy("packet", "page").agg(F.min_by("value", "line_no").alias("b_purpose"))
    rows = prose.join(inline, ["packet", "page"], "left").join(bare, ["packet", "page"], "left")
    return rows.select("packet", "page", "sponsor_id", "name", "purpose", "visa", "compliance_visa", "i_name", F.coalesce("i_purpose", "b_purpose").alias("i_purpose"), visa_of(F.col("i_visa"), visas).alias("i_visa"))


def finding(c: Column, families: list[tuple[list[str], str]] = ()) -> Column:
    """struct(finding, reason) of a note: as printed, else by the letters of a verdict before the reason, else by the reason's word families.

    A head that reads both as approval and as something else is a review: a doubt never gives the most permissive word.
    """
    printed = _some(F.upper(F.regexp_extract(c, FINDING, 1)))
    head = F.replace(F.upper(F.get(F.split(c, REASON_START, 2), F.lit(0))), F.lit(" "), F.lit(""))
    yes, doubt, no = (head.rlike(VERDICT_LETTERS[x]) for x in ("APPROVED", "NEEDS_REVIEW", "DENIED"))
    read = F.when(yes & (doubt | no), "NEEDS_REVIEW").when(yes, "APPROVED").when(doubt, "NEEDS_REVIEW").when(no, "DENIED")
    guessed = word_family(c, list(families)) if families else F.lit(None).cast("string")
    return F.struct(F.coalesce(printed, read, guessed).alias("finding"), F.when(printed.isNotNull(), F.trim(F.regexp_extract(c, FINDING, 2))).otherwise("").alias("reason"))


def registry_notice(lines: DataFrame) -> DataFrame:
    """(packet, notice): whether a page of the packet says that the sponsor's standing must be verified, also over line ends."""
    return _pages(lines).groupBy("packet").agg(F.bool_or(F.col("text").rlike(NOTICE)).alias("notice"))
