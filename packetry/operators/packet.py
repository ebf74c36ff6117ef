"""From the lines of a packet to its record.

Pages are typed by their titles and marks; each type yields evidence (packet, source, field, value, scanned), first or last page by the
rule of its form. One aggregate lays the lines of a packet side by side; typing, evidence, picking, voting, corrections and repairs are then
expressions within that row, so that lines are shuffled once, packets that come as rows never, and nothing is written on the way.

lines has packet, page (ordered), line_no, text and, where known, hidden, from_ocr, size and color. Vocabularies are closed lists given
by the caller. Untrusted lines (embedded instructions, hidden ink, archived neighbours) never yield a field. Missing values are "".

Defined results: null texts tell nothing; a packet without lines has no row; repeated lines change nothing but the votes for ids; an
empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from packetry.functions.extract import AMOUNT, corrections, find_date, find_sponsor, flag_list, same_person, strip_trailing_junk, visa_normalize
from packetry.functions.text import bind, canon, strip, valid_iso_date
from packetry.operators import consolidate, fuzzy, recover
from packetry.operators.lines import first_cells, footer, injected, stacked_cells, unarchived_texts

# Printed labels of the forms, the marks that tell a form, and fields of manual corrections.
INTAKE = {"Case ID": "case_id", "Applicant": "applicant_name", "Species Code": "species_code", "Home World": "home_world", "Visa Class": "visa_class", "Sponsor ID": "sponsor_id", "Arrival Date": "arrival_date", "Declared Purpose": "declared_purpose"}
REGISTRY = {"Registry Name": "applicant_name", "Home World": "home_world", "Species Code": "species_code", "Arrival Date": "arrival_date", "Registry Status": "registry_status"}
FEE = {"Fee Status": "fee_status", "Waiver Code": "waiver_code"}
INLINE = {"caseid": "case_id", "applicant": "applicant_name", "registryname": "applicant_name", "speciescode": "species_code", "speciesmatch": "species_code", "homeworld": "home_world", "visaclass": "visa_class", "sponsorid": "sponsor_id", "arrivaldate": "arrival_date", "declaredpurpose": "declared_purpose", "registrystatus": "registry_status", "feestatus": "fee_status", "waivercode": "waiver_code"}
FORMS = (
    ("intake", "FORM I-8090", r"I-8090|Authorization Intake|Primary intake record"),
    ("registry", "Planetary Registry", r"Registry Extract"),
    ("fee", "Fee Receipt", r"Fee Receipt"),
    ("biometric", "FORM B-13", r"B-13|Biometric|\b[B8]\s?[-–—._]?\s?1[23]\b|\b[Bb][il1][o0]met[a-z]{0,3}\b"),
    ("sponsor", "Sponsor Attestation", r"Sponsor Attestation|attests that"),
    ("note", "Manual Adjudicator Note", r"Adjudicator Note"),
)
CORRECTED = {"sponsor": "sponsor_id", "visa class": "visa_class", "applicant": "applicant_name", "fee status": "fee_status"}
FEE_PHRASE = r"(?i)fee status is (paid|waived|unpaid|unknown)"
PACKET_ID = r"MIB-[0-9]{4,}"
SPONSOR_ID = r"\bSPN-[0-9]{3,}\b"
STAMP_COLORS = {0x008000: "APPROVED", 0xFF0000: "DENIED", 0x0000FF: "NEEDS_REVIEW"}
STAMP_WORDS = ("APPROVED", "DENIED", "REVIEW")
#: Sources of a field, the most authoritative first, and fields where an exact reading comes before a scanned one.
ORDER = {
    "applicant_name": ("intake", "biometric", "registry", "sponsor", "untyped"), "species_code": ("intake", "biometric", "registry", "untyped"), "home_world": ("intake", "registry", "untyped"),
    "visa_class": ("intake", "sponsor", "untyped"), "arrival_date": ("intake", "registry", "untyped"), "declared_purpose": ("intake", "sponsor", "untyped"),
}
EXACT_FIRST = ("applicant_name", "species_code", "home_world", "visa_class", "arrival_date")
#: What a value of a field looks like; a page read upwards or downwards is judged by them.
TYPED = {"case_id": r"^MIB-[0-9]", "sponsor_id": r"SPN-[0-9]", "arrival_date": r"\b[0-9]{4}-[0-9]{2}-[0-9]{2}\b", "species_code": r"^[A-Z][A-Z_]{3,}$", "registry_status": r"(?i)^(clear|flagged|review|hold)$"}


@dataclass
class Vocabulary:
    """Closed lists of the values of fields; tight flags need more votes, guarded worlds a closer match."""

    species: list[str]
    worlds: list[str]
    visas: list[str]
    purposes: list[str]
    flags: list[str]
    fees: list[str] = field(default_factory=lambda: ["paid", "waived", "unpaid", "unknown"])
    guarded: list[str] = field(default_factory=list)
    families: list[tuple[list[str], str]] = field(default_factory=list)

    def of(self, name: str) -> list[str]:
        return {"species_code": self.species, "home_world": self.worlds, "visa_class": self.visas, "declared_purpose": self.purposes}[name]


def _some(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def _visa(c: Column, v: Vocabulary) -> Column:
    return _some(F.regexp_extract(visa_normalize(c), r"\b(" + "|".join(sorted(v.visas, key=len, reverse=True)) + r")\b", 1)) if v.visas else F.lit(None).cast("string")


def packed(lines: DataFrame) -> DataFrame:
    """(packet, pages) of lines, one row per packet that shows a line: its pages in order, each with its lines in order. The one shuffle of the path."""
    for c, kind in (("hidden", "boolean"), ("from_ocr", "boolean"), ("size", "double"), ("color", "int")):
        if c not in lines.columns:
            lines = lines.withColumn(c, F.lit(None).cast(kind))
    lines = lines.where("packet is not null and page is not null").withColumns({c: F.coalesce(c, F.lit(False)) for c in ("hidden", "from_ocr")}).repartition("packet")
    pages = lines.groupBy("packet", "page").agg(F.sort_array(F.collect_list(F.struct("line_no", "text", "hidden", "from_ocr", "size", "color"))).alias("lines"), F.bool_or(~F.col("hidden")).alias("shows"))
    return pages.groupBy("packet").agg(F.sort_array(F.collect_list(F.struct("page", "lines"))).alias("pages"), F.bool_or("shows").alias("shows")).where("shows").select("packet", "pages")


def _told(items: Column, f, last: bool = False) -> Column:
    """The first (last) value of f over an array that is not null."""
    return bind(F.filter(F.transform(items, f), lambda x: x.isNotNull()), lambda every: F.try_element_at(every, F.lit(-1 if last else 1)))


def _value(name: str):
    return lambda x: F.when(x["field"] == name, x["value"])


def _early(items: Column, f) -> Column:
    """The first string of f over an array that is not null; f is not asked again once it is found."""
    return F.aggregate(items, F.lit(None).cast("string"), lambda got, x: F.coalesce(got, f(x)))


def typed_pages(packets: DataFrame) -> DataFrame:
    """Pages of the packet itself, as struct(kind, text, scan, shown, said, lines): the first form whose title or mark they bear, else untyped.

    lines are all of a page, said those that are seen and bear no instructions, shown the texts of these outside archived blocks.
    """
    seen = F.filter(F.transform("pages", lambda p: F.struct(p["lines"].alias("lines"), F.filter(p["lines"], lambda x: ~x["hidden"]).alias("seen"))), lambda p: F.size(p["seen"]) > 0)
    own_id = lambda p: _early(p["seen"], lambda x: _some(F.regexp_extract(x["text"], PACKET_ID, 0)))
    own = F.transform("pages", lambda p: bind(own_id(p), lambda i: F.coalesce(i.isNull() | (i == F.col("packet")), F.lit(False))))
    packets = packets.withColumn("pages", seen).withColumn("_own", own)
    packets = packets.withColumn("pages", F.when(F.exists("_own", lambda x: x), F.filter("pages", lambda _, i: F.get("_own", i))).otherwise(F.col("pages")))
    # Boilerplate: texts on most pages of a packet of three or more.
    packets = packets.withColumn("_texts", F.transform("pages", lambda p: F.transform(p["seen"], lambda x: x["text"])))
    packets = packets.withColumn("_least", F.when(F.size("_texts") >= 3, F.greatest(F.lit(2), F.floor(F.size("_texts") * 0.8).cast("int"))).otherwise(1 << 30))
    printed = lambda t: (F.col("_least") < (1 << 30)) & (F.size(F.filter("_texts", lambda ts: F.array_contains(ts, t))) >= F.col("_least"))
    title = lambda p: F.coalesce(_early(p["seen"], lambda x: bind(x["text"], lambda t: F.when((F.trim(t) != "") & ~footer(t) & ~printed(t), t))), F.lit(""))
    said = lambda p: F.filter(p["seen"], lambda x: x["text"].isNotNull() & ~injected(x["text"]))

    def kind(p: Column) -> Column:
        out = F.lit("untyped")
        for name, opening, mark in reversed(FORMS):
            out = F.when(p["title"].startswith(opening) | p["text"].rlike(mark), name).otherwise(out)
        return out

    keep = lambda p, names: [p[n].alias(n) for n in names.split()]
    pages = F.transform("pages", lambda p: F.struct(p["lines"].alias("lines"), title(p).alias("title"), said(p).alias("said"), F.exists(p["lines"], lambda x: x["from_ocr"]).alias("scan")))
    pages = F.transform(pages, lambda p: F.struct(*keep(p, "lines title said scan"), unarchived_texts(F.transform(p["said"], lambda x: x["text"])).alias("shown")))
    pages = F.transform(pages, lambda p: F.struct(*keep(p, "lines title said scan shown"), F.array_join(p["shown"], "\n").alias("text")))
    pages = F.transform(pages, lambda p: F.struct(kind(p).alias("kind"), *keep(p, "text scan shown said lines")))
    return packets.withColumn("pages", pages).drop("_own", "_texts", "_least")


def _of(kind: str) -> Column:
    """Pages of one form on which a line is shown."""
    return F.filter("pages", lambda p: (p["kind"] == kind) & (F.size(p["shown"]) > 0))


def form_cells(p: Column) -> Column:
    """Array of struct(field, value) of a page: stacked fields of intake, registry and fee pages, inline ones filling their gaps."""
    none = F.array().cast("array<struct<field:string,value:string>>")
    stacked = none
    for name, labels in (("intake", INTAKE), ("registry", REGISTRY), ("fee", FEE)):
        stacked = F.when(p["kind"] == name, stacked_cells(p["shown"], labels, TYPED, fuzzy.placeholder)).otherwise(stacked)
    inline = F.when(p["kind"].isin("intake", "registry", "fee", "untyped", "biometric"), inline_cells(p)).otherwise(none)
    return first_cells(F.concat(stacked, inline))


def inline_cells(p: Column) -> Column:
    return F.filter(F.transform(p["shown"], lambda t: recover.inline_cell(t, INLINE)), lambda c: c.isNotNull())


def forms(packets: DataFrame, v: Vocabulary) -> DataFrame:
    """Add cells (a map of <form>__<field> to struct(value, scan) of the first page that tells it), fee_status and waiver_code."""
    packets = packets.withColumn("_cells", F.flatten(F.transform("pages", lambda p: F.transform(form_cells(p), lambda c: F.struct(p["kind"].alias("kind"), c["field"].alias("field"), c["value"].alias("value"), p["scan"].alias("scan"))))))
    whole = F.filter("_cells", lambda c: (c["kind"] != "untyped") | ~fuzzy.damaged(c["value"]))
    keyed = F.transform(whole, lambda c: F.struct(F.concat_ws("__", c["kind"], c["field"]).alias("key"), F.struct(c["value"].alias("value"), c["scan"].alias("scan")).alias("cell")))
    paid = lambda field: F.filter("_cells", lambda c: (c["kind"] == "fee") & (c["field"] == field))
    fee = _told(paid("fee_status"), lambda c: bind(fuzzy.correct_field(F.lower(F.trim(c["value"])), v.fees), lambda x: F.when(x.isin(*v.fees), x)), last=True)
    return packets.withColumns({"cells": F.map_from_entries(first_cells(keyed, "key")), "fee_status": fee, "waiver_code": _told(paid("waiver_code"), lambda c: F.trim(c["value"]), last=True)}).drop("_cells")


def slips(packets: DataFrame, v: Vocabulary) -> DataFrame:
    """Add slip_flags, slip_species, slip_name and slip_scan of the last biometric page; damage and legible panels of any page."""
    def told(label: str):
        def value(t: Column) -> Column:
            at = F.locate(":", t)
            return F.when(at > 1, F.when(strip(F.substr(t, F.lit(1), at - 1)) == label, _some(strip(F.substr(t, at + 1)))))

        return lambda p: _told(p["shown"], value, last=True)

    packets = packets.withColumn("_slips", _of("biometric")).withColumn("_slip", F.try_element_at("_slips", F.lit(-1))).withColumn("_obs", F.transform("_slips", told("Observed flags")))
    none = lambda c: bind(c, lambda x: F.when(x != "none", x))
    listed = flag_list(F.try_element_at("_obs", F.lit(-1)))
    exact = F.when(F.col("_slip.scan"), fuzzy.correct_flag_tokens(listed, v.flags)).otherwise(fuzzy.correct_flag_tokens(listed, v.flags, strict=True))
    garbled = _early(F.col("_slip.shown"), lambda t: recover.garbled_line(t, v.flags))
    flags = F.when(F.col("_slip").isNotNull(), F.coalesce(none(exact), none(fuzzy.contained_flags(F.col("_slip.text"), v.flags)), garbled, F.lit("none")))
    return packets.withColumns({
        "slip_flags": flags, "slip_species": told("Species Match")(F.col("_slip")), "slip_name": told("Applicant")(F.col("_slip")), "slip_scan": F.coalesce("_slip.scan", F.lit(False)), "panel_damaged": F.exists("_obs", fuzzy.damaged),
        "flags_observed": F.exists("_obs", lambda x: F.coalesce(~fuzzy.damaged(x) & (F.trim(x) != ""), F.lit(False))),
    }).drop("_slips", "_slip", "_obs")


def letters(packets: DataFrame, v: Vocabulary) -> DataFrame:
    """Add letter_<what> of what sponsor letters say: prose of the last one, else labelled lines of the first one."""
    pages = F.filter(_of("sponsor"), lambda p: p["text"].contains("Sponsor Attestation") | p["text"].contains("attests that"))
    labelled = lambda p: F.struct(p["text"].alias("text"), p["shown"].alias("shown"), inline_cells(p).alias("cells"))
    packets = packets.withColumn("_all", _of("sponsor")).withColumn("_letters", F.transform(pages, labelled))
    prose = lambda f: _told("_letters", lambda p: recover.letter_prose(p["text"], v.visas)[f], last=True)
    cell = lambda p, field: _told(p["cells"], _value(field))
    inline = {"name": lambda p: cell(p, "applicant_name"), "purpose": lambda p: F.coalesce(cell(p, "declared_purpose"), _told(p["shown"], recover.bare_purpose)), "visa": lambda p: recover.visa_of(cell(p, "visa_class"), v.visas)}
    told = {"sponsor_id": prose("sponsor_id"), "compliance_visa": prose("compliance_visa")} | {f: F.coalesce(prose(f), _told("_letters", g)) for f, g in inline.items()}
    scan = F.when(F.size("_letters") > 0, F.try_element_at(F.transform("_all", lambda p: p["scan"]), F.lit(-1)))
    return packets.withColumns({f"letter_{f}": c for f, c in told.items()} | {"letter_scan": F.coalesce(scan, F.lit(False))}).drop("_all", "_letters")


def note_of(pages: Column, v: Vocabulary) -> Column:
    """note(finding, reason, raw, fee): the last note page, else the first untyped page that reads like a note with a finding."""
    def note(p: Column) -> Column:
        fee = F.lower(_some(F.regexp_extract(p["text"], FEE_PHRASE, 1)))
        return bind(recover.finding(p["text"], v.families), lambda x: F.struct(x["finding"].alias("finding"), x["reason"].alias("reason"), p["text"].alias("raw"), fee.alias("fee")))

    typed = _told(pages, lambda p: F.when(p["kind"] == "note", note(p)), last=True)
    rescued = _told(pages, lambda p: F.when(p["kind"] == "untyped", F.when(fuzzy.note_like(p["text"]), bind(note(p), lambda n: F.when(n["finding"].isNotNull(), n)))))
    return F.coalesce(typed, rescued)


def corroborate(current: Column, exact: Column, cands: Column) -> Column:
    """struct(v, h), value and how, of a value against a short array of readings: a reading met twice beats one met once at most, unless an
    exact value is but misread by it; with no reading met twice, inexact values near each other are merged letter by letter. h is null if it stays."""
    key = consolidate.vote_key
    whole = F.filter(cands, lambda c: (F.coalesce(c, F.lit("")) != "") & ~fuzzy.damaged(c))
    given = F.struct(current.alias("v"), exact.alias("exact"), canon(current).alias("letters"), key(current).alias("key"), whole.alias("cands"))
    result = lambda v, h: F.struct(v.alias("v"), F.lit(h).cast("string").alias("h"))

    def judge(r: Column, keys: Column, best: Column) -> Column:
        own = F.size(F.filter(keys, lambda x: x == r["key"]))
        room = lambda k: F.greatest(F.lit(2), F.floor(F.greatest(F.length(k), F.length(r["letters"])) * 0.34).cast("int"))
        misread = r["exact"] & bind(canon(best["k"]), lambda k: F.levenshtein(k, r["letters"]) <= room(k))
        wins = F.coalesce((r["v"] != "") & ~misread & (best["n"] >= 2) & (own <= 1) & (best["k"] != r["key"]), F.lit(False))
        written = F.get(F.filter(r["cands"], lambda c: key(c) == best["k"]), F.lit(0))
        reach = F.least(F.lit(3), F.greatest(F.lit(1), F.floor(F.length(r["letters"]) / 4).cast("int")))
        close = F.filter(r["cands"], lambda c: F.levenshtein(canon(c), r["letters"]) <= reach)
        merge = lambda m: F.when((m != "") & (key(m) != r["key"]), result(m, "char_majority"))
        merged = F.when((r["v"] != "") & ~r["exact"] & (best["n"] == 1) & (F.size(r["cands"]) >= 2), bind(close, lambda c: F.when(F.size(c) >= 2, bind(majority(c), merge))))
        return F.when(wins, result(written, "corroboration")).otherwise(F.coalesce(merged, result(r["v"], None)))

    counts = lambda keys: F.transform(F.array_distinct(keys), lambda k: F.struct(F.size(F.filter(keys, lambda x: x == k)).alias("n"), k.alias("k")))
    return bind(given, lambda r: bind(F.transform(r["cands"], key), lambda keys: bind(F.array_max(counts(keys)), lambda best: judge(r, keys, best))))


def majority(variants: Column) -> Column:
    """Letter by letter the most frequent one over the variants of the most frequent length; ties go to the first."""
    most = lambda sizes: F.array_max(F.transform(sizes, lambda s, i: F.struct(F.size(F.filter(sizes, lambda x: x == s)).alias("n"), (-i).alias("i"), s.alias("s"))))["s"]
    letter = lambda x, p: F.substr(x, p, F.lit(1))

    def merged(same: Column, size: Column) -> Column:
        votes = lambda p: F.transform(same, lambda x, i: F.struct(F.size(F.filter(same, lambda y: letter(y, p) == letter(x, p))).alias("n"), (-i).alias("i"), letter(x, p).alias("c")))
        return F.when(F.size(same) >= 2, F.array_join(F.transform(F.sequence(F.lit(1), F.greatest(size, F.lit(1))), lambda p: F.array_max(votes(p))["c"]), ""))

    sized = lambda size: bind(F.filter(variants, lambda x: F.length(x) == size), lambda same: merged(same, size))
    return F.coalesce(bind(bind(F.transform(variants, lambda x: F.length(x)), most), sized), F.get(variants, F.lit(0)))


def _pick(name: str, sources: tuple[str, ...]) -> Column:
    """struct(value, source, scan, bad) of the best evidence e_<source>_<field>: usable before damaged, exact before scanned, then in order."""
    dated = name == "arrival_date"

    def judged(x: Column) -> Column:
        v = x["value"]
        v = F.when(v.rlike(TYPED["arrival_date"]), v).otherwise(F.coalesce(find_date(v), v)) if dated else v
        no_day = lambda v: ~valid_iso_date(_some(F.regexp_extract(v, r"\b([0-9]{4}-[0-9]{2}-[0-9]{2})\b", 1)))
        bad = lambda v: fuzzy.damaged(v) | no_day(v) if dated else fuzzy.damaged(v)
        return bind(v, lambda v: F.struct(v.alias("value"), x["source"].alias("source"), x["scan"].alias("scan"), bad(v).alias("bad")))

    found = F.array(*[F.struct(F.col(f"e.{s}__{name}.value").alias("value"), F.lit(s).alias("source"), F.coalesce(F.col(f"e.{s}__{name}.scan"), F.col("ocr_used")).alias("scan")) for s in sources])
    first = lambda every, test: F.get(F.filter(every, test), F.lit(0))
    exact = [lambda x: ~x["bad"] & ~x["scan"]] if name in EXACT_FIRST else []
    tests = [*exact, lambda x: ~x["bad"], lambda x: x["bad"]]
    return bind(F.transform(F.filter(found, lambda x: F.coalesce(x["value"], F.lit("")) != ""), judged), lambda every: F.coalesce(*[first(every, t) for t in tests]))


def _different(a: Column, b: Column) -> Column:
    return F.coalesce((canon(a) != "") & (canon(b) != "") & ~same_person(a, b), F.lit(False))


def evidence(packets: DataFrame, v: Vocabulary) -> DataFrame:
    """One row per packet with all evidence side by side: e (struct of <source>__<field>), slip, letter, note, corrections and the like."""
    packets = letters(slips(forms(typed_pages(packets), v), v), v)
    names = (("intake", INTAKE.values()), ("registry", REGISTRY.values()), ("untyped", ORDER), ("biometric", ("applicant_name", "species_code")))
    cells = [F.try_element_at("cells", F.lit(f"{s}__{f}")).alias(f"{s}__{f}") for s, fs in names for f in fs]
    packets = packets.withColumn("e", F.struct(*cells))
    fixes = F.filter(F.flatten(F.transform("pages", lambda p: corrections(p["text"]))), lambda x: ~fuzzy.damaged(x["value"]) & (x["value"] != ""))
    packets = packets.withColumns({"_fixes": fixes, "_said": F.flatten(F.transform("pages", lambda p: p["said"])), "ocr_used": F.exists("pages", lambda p: p["scan"])})
    fixed = {f"fix_{n}": _told("_fixes", _value(f)) for f, n in CORRECTED.items()}
    fixed["fix_fee"] = _told("_fixes", lambda x: F.when(x["field"] == "fee status", bind(fuzzy.correct_field(F.lower(x["value"]), v.fees), lambda y: F.when(y.isin(*v.fees), y))), last=True)
    amount = lambda p: F.when(p["kind"] == "fee", _some(F.replace(F.regexp_extract(p["text"], AMOUNT, 1), F.lit(","), F.lit(""))))
    ids = F.regexp_extract_all(F.array_join(F.transform("_said", lambda x: x["text"]), "\n"), F.lit(SPONSOR_ID), F.lit(0))
    counted = lambda ids: F.transform(F.array_distinct(ids), lambda i: F.struct(F.size(F.filter(ids, lambda x: x == i)).cast("bigint").alias("n"), F.lower(i).alias("k"), i.alias("id")))
    shapes = {"species_code": v.species, "home_world": v.worlds, "declared_purpose": v.purposes}
    sweep = F.flatten(F.transform("_said", lambda x: F.when(fuzzy.damaged(x["text"]), F.array().cast("array<struct<field:string,value:string>>")).otherwise(recover.swept_cells(x["text"], v.visas, shapes))))
    packets = packets.withColumns(fixed | {
        "present_pages": F.array_sort(F.array_remove(F.array_distinct(F.transform("pages", lambda p: p["kind"])), "untyped")), "fee_amount": _told("pages", amount), "registry_notice": F.exists("pages", lambda p: p["text"].rlike(recover.NOTICE)),
        "_ids": bind(ids, counted), "scan_flags": _early(F.filter("_said", lambda x: x["from_ocr"]), lambda x: recover.garbled_line(x["text"], v.flags)), "note": note_of(F.col("pages"), v),
        "_swept": F.when(F.col("ocr_used"), F.filter(sweep, lambda c: c["value"].isNotNull())),  # only packets with scans have their gaps swept
        "stamp_verdict": stamped(F.flatten(F.transform("pages", lambda p: p["lines"]))), "no_text": ~F.exists("pages", lambda p: F.exists(p["shown"], _plain)),
    })
    swept = {f"swept_{f}": _told("_swept", _value(f)) for f in ("sponsor_id", "arrival_date", "visa_class", *shapes)}
    votes = {"top_id": F.array_max("_ids"), "id_counts": F.map_from_entries(F.transform("_ids", lambda x: F.struct(x["id"], x["n"])))}
    return packets.withColumns(swept | votes).drop("pages", "cells", "_fixes", "_said", "_ids", "_swept")


def stamped(lines: Column) -> Column:
    """The verdict of visible coloured stamps: a review if one is stamped, else the only word, else null."""
    words = F.transform(F.filter(lines, lambda x: ~x["hidden"] & x["size"].between(15.0, 25.0) & x["color"].isin(*STAMP_COLORS)), lambda x: F.trim(F.upper(F.trim(x["text"]))))
    seen = F.array_distinct(F.filter(words, lambda w: w.isin(*STAMP_WORDS)))
    return bind(seen, lambda w: F.when(F.array_contains(w, "REVIEW"), "NEEDS_REVIEW").when(F.size(w) == 1, F.get(w, F.lit(0))))


def _plain(t: Column) -> Column:
    """A text besides printed matter: no label, no footer."""
    return ~t.isin(*{*INTAKE, *REGISTRY, *FEE, "Amount", "Synthetic hiring challenge document"}) & ~t.startswith("Packet ")


def records(lines: DataFrame, v: Vocabulary) -> DataFrame:
    """One record per packet of a table of lines."""
    return read(packed(lines), v)


def read(packets: DataFrame, v: Vocabulary) -> DataFrame:
    """One record per row of (packet, pages), as packed() makes them: the fields, and the evidence a decision would ask for (note, stamps,
    letter, fee, flags, conflicts). All within the row: nothing is shuffled or written."""
    rows = evidence(packets, v)
    blank = lambda c: F.coalesce(c, F.lit(""))
    e = lambda s, f: F.col(f"e.{s}__{f}.value")
    # The slip and the letter are sources like the forms.
    own = {"biometric": {"applicant_name": F.coalesce("slip_name", e("biometric", "applicant_name")), "species_code": F.coalesce("slip_species", e("biometric", "species_code"))}, "sponsor": {"applicant_name": F.col("letter_name"), "visa_class": F.col("letter_visa"), "declared_purpose": F.col("letter_purpose")}}
    scan = {"biometric": F.col("slip_scan"), "sponsor": F.col("letter_scan")}
    mine = {f"{s}__{f}": F.struct(c.alias("value"), scan[s].alias("scan")) for s, fs in own.items() for f, c in fs.items()}
    forms = [F.col(f"e.{c}").alias(c) for c in rows.schema["e"].dataType.names if c not in mine]
    rows = rows.withColumn("e", F.struct(*forms, *[c.alias(n) for n, c in mine.items()]))
    rows = rows.withColumns({f"p_{f}": _pick(f, sources) for f, sources in ORDER.items()})
    rows = rows.withColumns({f: blank(F.col(f"p_{f}.value")) for f in ORDER} | {f"s_{f}": F.col(f"p_{f}.source") for f in ORDER})
    slip_name = F.col("slip_name")
    for f, cands in (("applicant_name", [e("intake", "applicant_name"), e("registry", "applicant_name"), slip_name, F.col("letter_name")]), ("species_code", [e("intake", "species_code"), e("registry", "species_code"), e("biometric", "species_code")])):
        rows = rows.withColumn("_v", corroborate(F.col(f), ~F.coalesce(f"p_{f}.scan", F.lit(True)), F.array(*cands))).withColumns({f: F.col("_v.v"), f"s_{f}": F.coalesce("_v.h", f"s_{f}")})
    # The sponsor: of the readings that are ids an exact one, else the first; then the votes of all ids of the packet.
    readings = [(F.regexp_extract(blank(F.col("fix_sponsor_id")), SPONSOR_ID, 0), F.lit(False)), (e("intake", "sponsor_id"), F.coalesce("e.intake__sponsor_id.scan", "ocr_used")), (F.col("letter_sponsor_id"), scan["sponsor"])]
    ids = F.filter(F.array(*[F.struct(find_sponsor(c).alias("id"), o.alias("scan")) for c, o in readings]), lambda x: x["id"].isNotNull())
    rows = rows.withColumn("_ids", ids).withColumn("_id", F.coalesce(F.get(F.filter("_ids", lambda x: ~x["scan"]), F.lit(0)), F.get("_ids", F.lit(0))))
    own_n = F.coalesce(F.try_element_at("id_counts", F.col("_id.id")), F.lit(0))
    misread = ~F.col("_id.scan") & (F.levenshtein(canon(F.col("top_id.id")), canon(F.col("_id.id"))) <= 2)
    beaten = F.coalesce((F.col("top_id.n") >= 2) & (own_n <= 1) & (F.col("top_id.id") != F.col("_id.id")) & ~misread, F.lit(False))
    rows = rows.withColumn("sponsor_id", blank(F.when(beaten, F.col("top_id.id")).otherwise(F.col("_id.id"))))
    rows = rows.withColumn("s_sponsor_id", F.when(beaten, "corroboration"))
    for f in ("sponsor_id", "arrival_date", "visa_class", "species_code", "home_world", "declared_purpose"):
        gap = F.col("ocr_used") & (F.col(f) == "") & F.col(f"swept_{f}").isNotNull()
        rows = rows.withColumns({f: F.when(gap, F.col(f"swept_{f}")).otherwise(F.col(f)), f"s_{f}": F.when(gap, "sweep").otherwise(F.col(f"s_{f}"))})
    fixed = {"sponsor_id": _some(F.regexp_extract(blank(F.col("fix_sponsor_id")), SPONSOR_ID, 0)), "visa_class": _visa(F.col("fix_visa_class"), v), "applicant_name": _some(F.trim("fix_applicant_name"))}
    for f, c in fixed.items():
        rows = rows.withColumn("_fix", c).withColumns({f: F.coalesce("_fix", f), f"s_{f}": F.when(F.col("_fix").isNotNull(), "correction").otherwise(F.col(f"s_{f}"))})
    signed = F.coalesce(F.col("s_applicant_name") == "correction", F.lit(False))
    name = F.when(signed, F.col("applicant_name")).otherwise(F.trim(strip_trailing_junk(F.col("applicant_name"))))
    rows = rows.withColumn("applicant_name", name)
    a, b = canon(F.col("applicant_name")), canon(F.col("letter_name"))
    close = (a != b) & (F.levenshtein(a, b) <= F.greatest(F.lit(2), F.floor(F.greatest(F.length(a), F.length(b)) * 0.34).cast("int")))
    by_scan = F.coalesce("p_applicant_name.scan", "ocr_used")
    rows = rows.withColumn("applicant_name", F.when(F.coalesce(by_scan & (F.col("applicant_name") != "") & ~signed & close, F.lit(False)), F.trim("letter_name")).otherwise(F.col("applicant_name")))
    day = _some(F.regexp_extract("arrival_date", r"\b([0-9]{4}-[0-9]{2}-[0-9]{2})\b", 1))
    rows = rows.withColumn("arrival_date", blank(F.when(valid_iso_date(day), day)))
    for f in ("species_code", "home_world", "visa_class", "declared_purpose"):
        c, vocabulary = F.col(f), v.of(f)
        if vocabulary:
            rows = rows.withColumn(f, F.when(c == "", c).when(F.col("ocr_used"), fuzzy.correct_field(c, vocabulary, guarded=v.guarded if f == "home_world" else ())).otherwise(fuzzy.correct_field(c, vocabulary, strict=True)))
    rows = rows.withColumns({f"_gone_{f}": fuzzy.damaged(F.col(f)) for f in ORDER})
    for f in ORDER:
        gone = F.col(f"_gone_{f}")
        rows = rows.withColumns({f: F.when(gone, "").otherwise(F.col(f)), f"s_{f}": F.when(gone, "damaged").otherwise(F.col(f"s_{f}"))})
    plain_id = lambda c: _some(F.regexp_extract(blank(c), SPONSOR_ID, 0))
    opening = _some(F.regexp_extract(F.upper("species_code"), "^[A-Z][A-Z_]{2,}", 0))
    rows = rows.withColumns({
        "sponsor_id": blank(F.coalesce(plain_id(F.col("sponsor_id")), plain_id(e("intake", "sponsor_id")), plain_id(F.col("letter_sponsor_id")))), "species_code": F.coalesce(opening, "species_code"), "visa_class": F.coalesce(_visa(F.col("visa_class"), v), "visa_class"),
    })
    fee_fix = F.coalesce(F.col("note.fee"), F.col("fix_fee"))
    rows = rows.withColumns({"fee_correction": blank(fee_fix), "fee_observed": F.col("fee_status").isNotNull() | fee_fix.isNotNull(), "fee_status": F.coalesce(fee_fix, "fee_status", F.lit("unknown"))})
    whole = lambda cs: F.filter(F.array(*cs), lambda c: (F.coalesce(c, F.lit("")) != "") & ~fuzzy.damaged(c))
    named = whole([e("intake", "applicant_name"), e("registry", "applicant_name"), slip_name])
    kind = lambda c: bind(fuzzy.correct_field(F.when(fuzzy.damaged(c), None).otherwise(c), v.species), lambda k: F.when(fuzzy.one_of(k, v.species), F.upper(k)))
    kinds = F.transform(F.array(e("intake", "species_code"), e("registry", "species_code"), e("biometric", "species_code")), kind) if v.species else F.array()
    two_kinds = F.size(F.array_distinct(F.array_compact(kinds))) > 1 if v.species else F.lit(False)
    rows = rows.withColumn("identity_conflict", F.coalesce(consolidate.names_conflict(named), F.lit(False)) | two_kinds)
    registered = e("registry", "applicant_name")
    swap = ~F.col("ocr_used") & (F.coalesce(registered, F.lit("")) != "") & ~fuzzy.damaged(registered) & (F.col("s_applicant_name") == "intake") & _different(F.col("applicant_name"), registered)
    rows, swap = rows.withColumn("_swap", F.coalesce(swap, F.lit(False))), F.col("_swap")
    rows = rows.withColumns({"applicant_name": F.when(swap, F.trim(registered)).otherwise(F.col("applicant_name")), "s_applicant_name": F.when(swap, "registry_conflict").otherwise(F.col("s_applicant_name"))})
    none = lambda c: bind(c, lambda x: F.when(x != "none", x))
    slip_flags, said = none(F.col("slip_flags")), F.lower(F.concat_ws(" ", "note.reason", "note.raw"))
    scan_flags = F.when(~F.array_contains("present_pages", "biometric"), none(F.col("scan_flags")))
    rows = rows.withColumn("_note_flags", F.when(F.col("note").isNotNull(), none(fuzzy.contained_flags(said, v.flags))))
    note_flags = F.col("_note_flags")
    sources = {f: F.col(f"s_{f}") for f in [*ORDER, "sponsor_id"]} | {"risk_flags": F.when(slip_flags.isNull(), F.when(scan_flags.isNotNull(), "garbled_recovery").when(note_flags.isNotNull(), "note_reason"))}
    told = F.map_filter(F.map_from_arrays(F.array(*[F.lit(f) for f in sources]), F.array(*sources.values())), lambda _, x: x.isNotNull())
    return rows.select(
        F.col("packet").alias("case_id"), *ORDER, "sponsor_id", F.coalesce(slip_flags, scan_flags, note_flags, F.lit("none")).alias("risk_flags"), "fee_status", "fee_observed", blank(F.col("waiver_code")).alias("waiver_code"),
        blank(e("registry", "registry_status")).alias("registry_status"), F.struct("note.finding", "note.reason", "note.raw").alias("note"), blank(F.col("letter_sponsor_id")).alias("sponsor_letter_id"), blank(F.col("letter_name")).alias("sponsor_letter_name"),
        blank(F.col("letter_purpose")).alias("sponsor_letter_purpose"), blank(F.col("letter_visa")).alias("sponsor_letter_visa"), blank(F.col("letter_compliance_visa")).alias("sponsor_compliance_visa"), "fee_correction", told.alias("field_sources"),
        "present_pages", "ocr_used", F.coalesce("no_text", F.lit(True)).alias("scanned"), "identity_conflict", blank(F.col("stamp_verdict")).alias("stamp_verdict"), F.coalesce("panel_damaged", F.lit(False)).alias("risk_panel_damaged"),
        F.coalesce("flags_observed", F.lit(False)).alias("flags_observed"), blank(F.col("fee_amount")).alias("fee_amount"), F.coalesce("registry_notice", F.lit(False)).alias("registry_notice"),
    )


def deficiency(damaged: Column | None = None) -> Column:
    """How much a record lacks: core fields that are blank though not destroyed, flags never seen, a fee never seen, a note without finding."""
    gone = lambda f: F.coalesce(F.try_element_at("field_sources", F.lit(f)) == "damaged", F.lit(False))
    unseen = F.coalesce(F.col("risk_flags") == "none", F.lit(True)) & ~F.array_contains(F.coalesce("present_pages", F.array().cast("array<string>")), "biometric")
    mute = F.col("note.finding").isNull() & (F.coalesce("note.raw", F.lit("")) != "")
    total = unseen.cast("int") + (~F.coalesce("fee_observed", F.lit(False))).cast("int") + mute.cast("int")
    for f in [*ORDER, "sponsor_id"]:
        total = total + ((F.coalesce(F.col(f), F.lit("")) == "") & ~gone(f)).cast("int")
    return total


def critical_gap(mute_scans: Column | None = None) -> Column:
    """Whether one thing lacks that outweighs others: flags never seen, a scanned page on which nothing reads, a note without finding."""
    unseen = F.coalesce(F.col("risk_flags") == "none", F.lit(True)) & ~F.array_contains(F.coalesce("present_pages", F.array().cast("array<string>")), "biometric")
    mute = F.col("note.finding").isNull() & (F.coalesce("note.raw", F.lit("")) != "")
    return unseen | mute | F.coalesce(mute_scans, F.lit(False)) if mute_scans is not None else unseen | mute


def merged(base: DataFrame, second: DataFrame) -> DataFrame:
    """Records with their gaps filled by a second, more thorough reading of the same packets: core fields, waiver and registry status if
    blank, flags if none, fee if never seen, note if it has no finding; pages united, conflicts of either kept."""
    fill = [*ORDER, "sponsor_id", "waiver_code", "registry_status"]
    b, s = base.alias("b"), second.alias("s")
    gap = lambda f: (F.coalesce(f"b.{f}", F.lit("")) == "") & (F.coalesce(f"s.{f}", F.lit("")) != "")
    no_flags = (F.coalesce("b.risk_flags", F.lit("none")) == "none") & (F.coalesce("s.risk_flags", F.lit("none")) != "none")
    fee = ~F.coalesce("b.fee_observed", F.lit(False)) & F.coalesce("s.fee_observed", F.lit(False))
    note = F.col("b.note.finding").isNull() & F.col("s.note.finding").isNotNull()
    strings = F.array().cast("array<string>")
    pages = F.array_sort(F.array_union(F.coalesce("b.present_pages", strings), F.coalesce("s.present_pages", strings)))
    new = {f: F.when(gap(f), F.col(f"s.{f}")).otherwise(F.col(f"b.{f}")) for f in fill}
    new |= {"risk_flags": F.when(no_flags, F.col("s.risk_flags")).otherwise(F.col("b.risk_flags")), "fee_status": F.when(fee, F.col("s.fee_status")).otherwise(F.col("b.fee_status")), "fee_observed": F.coalesce("b.fee_observed", F.lit(False)) | fee}
    new |= {"note": F.when(note, F.col("s.note")).otherwise(F.col("b.note")), "present_pages": pages, "identity_conflict": F.coalesce("b.identity_conflict", F.lit(False)) | F.coalesce("s.identity_conflict", F.lit(False))}
    changed = F.array_compact(F.array(*[F.when(gap(f), F.lit(f)) for f in fill], F.when(no_flags, F.lit("risk_flags"))))
    kept = F.map_filter(F.coalesce("b.field_sources", F.create_map().cast("map<string,string>")), lambda k, _: ~F.array_contains(changed, k))
    new["field_sources"] = F.map_concat(kept, F.map_from_arrays(changed, F.transform(changed, lambda _: F.lit("escalation"))))
    return b.join(s, F.col("b.case_id") == F.col("s.case_id"), "left").select(*[new.get(c, F.col(f"b.{c}")).alias(c) for c in base.columns])
