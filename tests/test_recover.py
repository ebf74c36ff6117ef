"""Operators over lines with damaged labels or layout."""

from conftest import got
from packetry.operators import recover

LABELS = {"applicant": "applicant_name", "speciescode": "species_code", "homeworld": "home_world", "visaclass": "visa_class", "declaredpurpose": "declared_purpose"}
VISAS, FLAGS = ["XW-1", "DIP-1", "TRANSIT-7"], ["biohazard_red", "memory_edit", "orbit_ban"]


def pages(spark, *texts: list):
    return spark.createDataFrame([("P", p, i, t) for p, page in enumerate(texts, 1) for i, t in enumerate(page)], "packet string, page int, line_no int, text string")


def test_fuzzy_inline_fields(spark):
    df = pages(spark, ["Applicant: Pele Virfoash PASSPORT IMAGE 3", "Speces Cod. TARN_WEAVER", "Home World Velm-12c", "Species Code: OTHER", "Visa Class: [torn]", "Visa Class:", "a note: x", None])
    assert got(recover.fuzzy_inline_fields(df, LABELS), "field", "value") == [("applicant_name", "Pele Virfoash"), ("home_world", "Velm-12c"), ("species_code", "TARN_WEAVER")]


def test_pattern_sweep(spark):
    df = pages(spark, ["2: SPN-7720", "x 2026-02-30", "y 2026-02-03", "z: TRANSIT-7", "q: transitt", "unreadable SPN-0001", "w: TARN WEAVER", None])
    out = recover.pattern_sweep(df, VISAS, {"species_code": ["TARN_WEAVER"], "declared_purpose": ["transit"]})
    assert got(out, "field", "value") == [("arrival_date", "2026-02-03"), ("declared_purpose", "transit"), ("species_code", "TARN_WEAVER"), ("sponsor_id", "SPN-7720"), ("visa_class", "TRANSIT-7")]


def test_garbled_flags(spark):
    df = pages(spark, ["Obmarved flage: none", "Obmarved flage: bioharard_yed, memory_edlt", "Observed flags: orbit_ban"], ["hello: orbit_ban", None])
    assert got(recover.garbled_flags(df, FLAGS), "page", "flags") == [(1, "biohazard_red|memory_edit"), (2, "none")]


def test_flag_state_and_votes(spark):
    df = pages(spark, ["Observed flags orbit_ban", "Observed flags none", "Observed flags memory_edit"], ["Observed flags memory_edit"], ["hello", None])
    assert got(recover.flag_state(df), "page", "state") == [(1, "none"), (2, "true"), (3, "false")]
    assert got(recover.scanned_votes(df, FLAGS, []), "page", "flag", "votes") == [(1, "orbit_ban", 1), (2, "memory_edit", 1)]


def test_sponsor_letters(spark):
    prose = ["Sponsor Attestation", "SPN-0042 attests that Pele Virfoash is expected", "on Earth for hull", "welding. Takes responsibility for class XW-1 compliance."]
    df = pages(spark, prose, ["Sponsor Attestation SPN-0043", "Applicant: Sid Zumskul", "Purpose: ore assay", "Visa Class: DIP-1"], ["Applicant: nobody"])
    cols = ("page", "sponsor_id", "name", "purpose", "visa", "compliance_visa")
    assert got(recover.sponsor_letters(df, LABELS, VISAS), *cols) == [(1, "SPN-0042", "Pele Virfoash", "hull welding", "XW-1", "XW-1"), (2, "SPN-0043", "Sid Zumskul", "ore assay", "DIP-1", None)]


def test_registry_notice(spark):
    df = pages(spark, ["Registry notice: sponsor standing", "requires additional verification."])
    assert got(recover.registry_notice(df), "packet", "notice") == [("P", True)]
    assert got(recover.registry_notice(pages(spark, ["sponsor standing", None])), "packet", "notice") == [("P", False)]
