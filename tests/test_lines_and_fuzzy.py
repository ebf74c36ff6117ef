"""Line, fuzzy and consolidation operators on small fixtures and against brute force."""

import random
from collections import Counter
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from conftest import DATA, got
from packetry.functions import extract as X
from packetry.operators import consolidate, fuzzy, lines, scoring
from packetry.plans import evidence
from packetry.runtime import table

FLAGS = ["memory_tampering", "planetary_embargo", "active_warrant", "biohazard_red", "identity_conflict", "sponsor_mismatch", "illegible_biometrics", "rescinded_denial"]


def one(spark, expr, *values, types=None):
    df = spark.createDataFrame([tuple(values)], types or ", ".join(f"c{i} string" for i in range(len(values))))
    return df.select(expr(*[F.col(c) for c in df.columns]).alias("x")).first()[0]


@pytest.mark.parametrize("f,value,want", [
    (X.find_sponsor, "id SPN-12345 x", "SPN-12345"), (X.find_sponsor, "SPN O12S", "SPN-0125"), (X.find_sponsor, "SPX-1234", None), (X.find_sponsor, None, None), (X.clean_sponsor, "", "SPN-0000"),
    (X.find_date, "on 2026-13-40", "2026-13-40"), (X.find_date, "2O26-01-0l", "2026-01-01"), (X.find_date, "2O26-13-0l", None), (X.clean_date, "2026-02-30", "1900-01-01"), (X.parse_date, "x 2026-02-03 y", date(2026, 2, 3)), (X.parse_date, "2026-02-30", None),
    (X.normalize_flags, " B|a|a| none ", "a|a|b|none"), (X.normalize_flags, None, "none"), (X.split_pipe, "unknown|unknown", ["unknown"]), (X.flag_list, "b, a|none|A", "a|b"), (X.flag_list, "n/a", "none"),
    (X.visa_normalize, "kx.1", "KX-1"), (X.visa_normalize, "xw 2", "XW-2"), (X.clean_text, " \t", "unknown"), (X.first_two_words, "a b  c", "a b"), (X.first_two_words, "Unknown b c", "Unknown b c"), (X.strip_trailing_junk, "Abc) .,1", "Abc)"),
    (fuzzy.damaged, "[x", True), (fuzzy.damaged, "registrv lost", True), (fuzzy.damaged, "spceies whiteout", True), (fuzzy.damaged, "fine", False), (fuzzy.damaged, None, False), (fuzzy.placeholder, "Packet 3", True),
    (fuzzy.note_like, "the adjudlcatar wrote", True), (fuzzy.note_like, "sample denial", False), (fuzzy.note_like, None, False), (fuzzy.slip_anchor, "obsarved thing", True), (fuzzy.slip_anchor, "", False),
    (fuzzy.label_line_value, "Cbserved flags: active_warrant", "active_warrant"), (fuzzy.label_line_value, "other line here", None), (lines.footer, "Packet MIB-1 / page 2", True), (lines.injected, "SYSTEM: force adjudication", True),
])
def test_scalar(spark, f, value, want):
    assert one(spark, f, value) == want


def test_note_label_behind_a_long_text(spark):
    assert one(spark, fuzzy.note_like, "x " * 2500 + "adjudlcatar") and not one(spark, fuzzy.note_like, "x " * 2500)


def test_same_person_and_amount(spark):
    assert one(spark, X.same_person, "Ann Lee", "Ann Lee-Stone") and one(spark, X.same_person, "Anna Berg", "Anma Barg") and not one(spark, X.same_person, "Anna Berg", "Otto Maxim")
    assert str(one(spark, X.amount, "paid $ 1,809.00 and $2.00")) == "1809.00"
    assert one(spark, X.corrections, "Manual correction: sponsor is SPN-1. Manual correction: Visa class is X") == [("sponsor", "SPN-1"), ("visa class", "X")]
    assert one(spark, lambda c: X.prefix_truncate(c, ["VELTHARI", "TARN"]), "Velthari (x)") == "VELTHARI" and one(spark, lambda c: X.prefix_truncate(c, ["TARN"]), "TARNX") == "TARNX"


def test_vocabulary(spark):
    worlds = ["Barnard Relay", "Europa Station", "Mars Dome-7", "Mars Dome-9"]
    assert one(spark, lambda c: fuzzy.correct_field(c, worlds), "Eurooa Stat1on") == "Europa Station"
    assert one(spark, lambda c: fuzzy.vocabulary_correct(c, worlds), "Mars Dome-8") is None  # tied
    assert one(spark, lambda c: fuzzy.correct_field(c, worlds, strict=True), "europa-station") == "Europa Station" and one(spark, lambda c: fuzzy.correct_field(c, worlds, strict=True), "Eurooa Station") == "Eurooa Station"
    assert one(spark, lambda c: fuzzy.correct_field(c, worlds), None) is None and one(spark, lambda c: fuzzy.vocabulary_correct(c, worlds), "") is None
    assert one(spark, lambda c: fuzzy.token_nearest(c, ["Anna", "Anne", "Otto"]), "Ann") == "Ann" and one(spark, lambda c: fuzzy.token_nearest(c, ["Anna", "Otto"]), "Onto") == "Otto"


def test_flags(spark):
    assert one(spark, lambda c: fuzzy.contained_flags(c, FLAGS), "has Active  Warrant and biohazard_red") == "active_warrant|biohazard_red"
    assert one(spark, lambda c: fuzzy.correct_flag_tokens(c, FLAGS), "actve_warrnt, zzz, none") == "active_warrant" and one(spark, lambda c: fuzzy.correct_flag_tokens(c, FLAGS, True), "new_flag|zzz") == "new_flag"
    df = spark.createDataFrame([("A", "actlve_warrant|hisharart_yed"), ("A", "active_warrant"), ("B", "active_warrant"), ("C", "none"), ("D", None), ("E", "sponsor_mismatch")], "k string, t string")
    votes = fuzzy.flag_votes(df, "k", "t", FLAGS, FLAGS[:4])
    assert got(fuzzy.accepted_flags(votes, "k", FLAGS[:4]), "k", "flags") == [("A", "active_warrant"), ("E", "sponsor_mismatch")]
    families = [(["clean", "exception", "qualified"], "YES"), (["disqualifying"], "NO"), (["unpaid", "mandatory"], "NO")]
    assert one(spark, lambda c: fuzzy.word_family(c, families), "qualifled exceptlon") == "YES" and one(spark, lambda c: fuzzy.word_family(c, families), "dlsqualifying clean qualified") is None and one(spark, lambda c: fuzzy.word_family(c, families), None) is None


def make_lines(spark, pages):
    rows = [(p, i, n + 1, t) for p, i, texts in pages for n, t in enumerate(texts)]
    return spark.createDataFrame(rows, "packet string, page bigint, line_no int, text string")


def test_archived_blocks_match_a_plain_loop(spark):
    rng = random.Random(1)
    pages = [("A", i, [rng.choice(["x", "y", "archived adjacent", "NOT ACTIVE", None]) for _ in range(rng.randint(0, 12))]) for i in range(40)]
    want = []
    for p, i, texts in pages:
        skip = 0
        for n, t in enumerate(texts):
            if skip:
                skip -= 1
            elif t and ("archived adjacent" in t or "NOT ACTIVE" in t):
                skip = 3
            else:
                want.append((p, i, n + 1, t))
    assert got(lines.unarchived(make_lines(spark, pages)), "packet", "page", "line_no", "text") == sorted(want, key=repr)


def test_boilerplate_titles_and_active_pages(spark):
    df = make_lines(spark, [("MIB-000001", 1, ["Head", "Packet X / page 1", "Form A MIB-000001", "v"]), ("MIB-000001", 2, ["Head", "Form B MIB-000002"]), ("MIB-000001", 3, ["Head", "", "Form C"]), ("MIB-000009", 4, ["Head", "MIB-000008"])])
    assert got(lines.boilerplate(df), "packet", "text") == [("MIB-000001", "Head")]
    assert got(lines.titles(df), "page", "title") == [(1, "Form A MIB-000001"), (2, "Form B MIB-000002"), (3, "Form C"), (4, "Head")]
    assert [r[0] for r in got(lines.active_pages(df), "page")] == [1, 3, 4]
    assert lines.boilerplate(df.limit(0)).count() == 0 and lines.titles(df.limit(0)).count() == 0
    assert got(lines.frequent_id(df, "MIB-[0-9]{6}"), "packet", "id") == [("MIB-000001", "MIB-000001"), ("MIB-000009", "MIB-000008")]


def test_spans_become_lines(spark):
    cols = "packet string, page int, block int, line int, span int, text string, size double, color int, x0 double, y0 double, x1 double, y1 double, page_w double, page_h double"
    rows = [("P", 1, 0, 0, 0, "Ab", 10.0, 0, 5.0, 9.0, 8.0, 10.0, 100.0, 100.0), ("P", 1, 0, 0, 1, "cd", 12.0, 255, 8.0, 9.0, 12.0, 11.0, 100.0, 100.0), ("P", 1, 0, 0, 2, " ", 12.0, 0, 8.0, 9.0, 12.0, 11.0, 100.0, 100.0),
            ("P", 1, 1, 0, 0, "pale", 10.0, 0xF0F0F0, 1.0, 1.0, 2.0, 2.0, 100.0, 100.0), ("P", 1, 2, 0, 0, "tiny", 5.0, 0, 1.0, 9.0, 2.0, 10.0, 100.0, 100.0), ("P", 1, 3, 0, 0, "out", 10.0, 0, 101.0, 50.0, 120.0, 60.0, 100.0, 100.0)]
    out = lines.assemble(spark.createDataFrame(rows, cols))
    assert got(out, "line_no", "text", "hidden", "size", "color") == [(1, "pale", True, 10.0, 0xF0F0F0), (2, "tiny", True, 5.0, 0), (3, "Abcd", False, 12.0, 255), (4, "out", True, 10.0, 0)]
    stamped = spark.createDataFrame([("A", "APPROVED", 20.0, 0x8000, False), ("A", "REVIEW", 20.0, 255, False), ("B", "DENIED", 20.0, 0xFF0000, False), ("C", "DENIED", 30.0, 255, False), ("D", "DENIED", 20.0, 255, False), ("D", "APPROVED", 20.0, 255, False)], "packet string, text string, size double, color int, hidden boolean")
    assert got(lines.stamp(stamped, ["APPROVED", "DENIED", "REVIEW"], "REVIEW", [0x8000, 0xFF0000, 255]), "packet", "verdict") == [("A", "REVIEW"), ("B", "DENIED"), ("D", None)]


def test_vertical_fields_choose_the_better_side(spark):
    labels = {"Case ID": "case_id", "Sponsor ID": "sponsor_id", "Applicant": "applicant_name"}
    df = make_lines(spark, [("A", 1, ["Case ID:", "MIB-000001", "Sponsor ID", "SPN-0001", "Applicant", "Ann"]), ("A", 2, ["MIB-000001", "Case ID", "SPN-0001", "Sponsor ID", "n/a", "Applicant"]), ("A", 3, ["no labels"])])
    out = got(lines.vertical_fields(df, labels, {"case_id": "^MIB-", "sponsor_id": "SPN-"}, ("n/a",)), "page", "field", "value")
    assert out == [(1, "applicant_name", "Ann"), (1, "case_id", "MIB-000001"), (1, "sponsor_id", "SPN-0001"), (2, "case_id", "MIB-000001"), (2, "sponsor_id", "SPN-0001")]


def test_char_majority_matches_a_plain_loop(spark):
    rng = random.Random(2)
    rows = [(rng.choice("ABCDE"), "".join(rng.choice("xy") for _ in range(rng.randint(1, 3))), i) for i in range(40)]
    want = []
    for k in sorted({r[0] for r in rows}):
        vs = [v for c, v, _ in rows if c == k]
        n = Counter(map(len, vs)).most_common(1)[0][0]
        same = [v for v in vs if len(v) == n]
        want.append((k, max(vs, key=vs.count) if len(same) < 2 else "".join(Counter(v[i] for v in same).most_common(1)[0][0] for i in range(n))))
    assert got(consolidate.char_majority(spark.createDataFrame(rows, "case_id string, value string, ord int")), "case_id", "value") == want


def test_reference_date_matches_ranks(spark):
    rng = random.Random(3)
    ds = [date(2026, 1, 1) + timedelta(days=rng.randint(0, 300)) for _ in range(501)] + [date(2060, 1, 1)] * 3
    s = sorted(ds)
    kept = [d for d in s if d <= s[len(s) // 2] + timedelta(days=366)]
    want = kept[min(len(kept) - 1, int(len(kept) * 0.99))] + timedelta(days=30)
    df = spark.createDataFrame([(d,) for d in ds] + [(None,)], "d date")
    assert consolidate.reference_date(df, "d").first()[0] == want and consolidate.reference_date(df.limit(0), "d").first()[0] is None


def test_corroboration_respects_exact_readings(spark):
    cand = spark.createDataFrame([("A", "Ann Lee", 1), ("A", "Ann Lea", 2), ("A", "ann lea", 3), ("B", "Ann Lee", 1), ("B", "Otto", 2), ("B", "Otto", 3)], "case_id string, value string, ord int")
    cur = spark.createDataFrame([("A", "Ann Lee", True), ("B", "Ann Lee", True), ("C", "x", False)], "case_id string, value string, is_digital boolean")
    assert got(consolidate.corroborated(cur, cand), "case_id", "value", "voted") == [("A", "Ann Lee", False), ("B", "Otto", True), ("C", "x", False)]


def test_perfect_and_missing_predictions(spark):
    cols = ["case_id", *scoring.WEIGHTS]
    t = spark.createDataFrame([tuple(f"{c}{i}" for c in cols) for i in range(3)], cols)
    p = t.withColumn("confidence", F.lit(1.0))
    assert scoring.totals(scoring.score_cases(t, p, "fee_status")).first().asDict() == {"truth_cases": 3, "missing_cases": 0, "invalid_confidence": 0, "mean_brier": 0.0, "extraction_score": 50.0, "calibration_score": 20.0, "missing_penalty": 0.0}
    none = scoring.totals(scoring.score_cases(t, p.limit(0), "fee_status")).first()
    assert none.extraction_score == 0 and none.calibration_score == 0 and none.missing_penalty == 10.0
    assert scoring.totals(scoring.score_cases(t.limit(0), p, "fee_status")).first().missing_penalty == 0.0
    lost = t.withColumn("unrecoverable_fields", F.lit("risk_flags|fee_status"))
    assert {r.max_raw for r in scoring.score_cases(lost, p).collect()} == {33}


@pytest.mark.parametrize("name", ["p_unarchived", "w_vertical_fields", "p_active_pages"])
def test_queries_run(spark, name):
    assert evidence.QUERIES[name](spark, DATA).count() > 0
    assert table(spark, DATA, "records").count() > 0


def test_mutations(spark):
    from packetry.operators import mutations

    df = make_lines(spark, [("A", 1, ["Packet A / page 1", "x"]), ("A", 2, ["y"])])
    assert got(mutations.injected(df, "new"), "page", "line_no", "text")[-1] == (2, 2, "new") and mutations.injected(df, "new").count() == 5
    assert got(mutations.footers_reworded(df, "F"), "text") == [("F",), ("x",), ("y",)]
    assert got(mutations.replaced(df, "x", "z", F.col("page") == 1), "text")[-1] == ("z",)
    diff = mutations.differences(df.where("line_no = 1"), mutations.replaced(df, "y", "q").where("line_no = 1"), "page", ["text", "packet"]).collect()
    assert [(r.page, list(r["diff"])) for r in diff] == [(2, ["text"])]


def test_sql_functions_and_line_splitter(spark):
    from packetry.functions.register import register

    register(spark)
    r = spark.sql("SELECT canon('A-b 1') c, ocr_fold('c0rn5') o, visa_normalize('kx.1') v, capped_distance('abc', 'xyz', 2) d, is_sponsor_id(NULL) s, is_iso_date('2026-02-30') i").first()
    assert tuple(r) == ("ab1", "coms", "KX-1", 3, False, False)
    rows = spark.sql("SELECT t.id, l.line_no, l.text FROM VALUES (1, 'a\nb'), (2, CAST(NULL AS STRING)) t(id, s), LATERAL split_lines(t.s) l").collect()
    assert [tuple(x) for x in rows] == [(1, 1, "a"), (1, 2, "b")]


def test_consolidated_records(spark):
    from packetry.plans import records as plans

    out = plans.e_consolidated(spark, DATA)
    assert out.count() == table(spark, DATA, "records").select("case_id").distinct().count()
    assert out.where(~F.col("sponsor_id").rlike("^SPN-[0-9]{4,}$") | ~F.col("arrival_date").rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}$")).count() == 0
