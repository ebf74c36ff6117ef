"""Missing values, rejected lines and packed fields: defined results for nulls, ties, repeats, long texts and empty tables."""

import csv
import io
import re
from datetime import date

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import CODE_LIST, DATA, at, got, records
from packetry.functions import lexicon
from packetry.operators import fill, packed, rejects
from packetry.plans import problems
from packetry.runtime import lookup_join, table


def filled(spark, rows, parents=False):
    return got(fill.fill(fill.record_cells(records(spark, rows), CODE_LIST), ("fee_status",), parents), "row_id", "field", "entry", "method")


GOOD = {"case_id": "A", "species_code": "TARN_WEAVER", "home_world": "Velm-12c", "declared_purpose": "ore assay", "fee_status": "paid", "fee_observed": True}


def test_fill_from_other_readings_and_marks(spark):
    rows = [GOOD | {"read_at": at(1)}, GOOD | {"read_at": at(2), "species_code": "[SPECIES BLOTTED]", "home_world": None, "declared_purpose": "tbd", "fee_status": "unknown", "fee_observed": False}]
    assert filled(spark, rows) == [(2, "declared_purpose", 402, "group_mode"), (2, "fee_status", 601, "interval"), (2, "home_world", 201, "group_mode"), (2, "species_code", 101, "group_mode")]


def test_fee_status_holds_in_time(spark):
    fees = [(1, None, False), (2, "unpaid", True), (3, "", False), (3, "unknown", True), (4, "n/a", False), (5, "paid", True), (9, "unknown", False)]
    rows = [GOOD | {"read_at": at(d), "fee_status": f, "fee_observed": o} for d, f, o in fees]
    # before the first the first holds; a status of the same moment holds; an observed unknown is a status; after the last the last holds
    assert [(r, e) for r, f, e, _ in filled(spark, rows) if f == "fee_status"] == [(1, 603), (3, 604), (5, 604), (7, 601)]


def test_fill_is_brute_force_over_days_and_hours(spark):
    import random

    rng = random.Random(3)
    rows = [GOOD | {"case_id": rng.choice("ABC"), "read_at": at(rng.randint(1, 6), rng.randint(0, 23)), "fee_status": rng.choice(["paid", "unpaid", "waived", "?", None]), "fee_observed": True} for _ in range(200)]
    names = {"paid": 601, "waived": 602, "unpaid": 603}
    want = []
    for i, r in enumerate(rows):
        if r["fee_status"] in names:
            continue
        known = [(x["read_at"], j, names[x["fee_status"]]) for j, x in enumerate(rows) if x["case_id"] == r["case_id"] and x["fee_status"] in names]
        before = [k for k in known if k[0] <= r["read_at"]]
        want.append((i + 1, max(before)[2] if before else max(k for k in known if k[0] == min(known)[0])[2]))
    assert sorted((r, e) for r, f, e, _ in filled(spark, rows) if f == "fee_status") == sorted(want)


def test_fill_ties_nulls_repeats_and_parents(spark):
    rows = [GOOD | {"species_code": "VELTHARI"}, GOOD, GOOD | {"species_code": ""}, GOOD | {"species_code": ""}, GOOD | {"case_id": None, "species_code": ""}, GOOD | {"case_id": "B", "species_code": "?"}]
    out = filled(spark, rows, parents=True)
    assert (3, "species_code", 101, "group_mode") in out and (4, "species_code", 101, "group_mode") in out  # a tie goes to the smaller entry
    assert not [x for x in out if x[0] == 5]
    assert [x[3] for x in out if x[0] == 6] == ["parent_mode"]
    assert filled(spark, rows[:0]) == [] and filled(spark, rows[:0], parents=True) == []


def test_values_that_match_no_entry_fill_nothing(spark):
    rows = [GOOD | {"home_world": "Lorn-4b"}, GOOD | {"home_world": ""}]
    assert [x for x in filled(spark, rows) if x[1] == "home_world"] == []


@pytest.mark.parametrize("value,entry", [("TARN WEA.", 101), ("weaver tarn", 101), ("~tarn weaver", 101), ("TWV.", 101), ("T4RN_WEAVER", 0), ("VELTHARl", 102), ("Velm-11c", 0), ("Ve1m-12c", 201), ("second body of velm fourtene", 202), ("[BLOT", None), (None, None), ("", None)])
def test_lexicon(value, entry):
    field = "home_world" if value and re.search("(?i)ve[l1]m", value) else "species_code"
    assert lexicon.Lexicon(CODE_LIST).resolve(field, value) == entry


def test_lexicon_refuses_an_open_list():
    with pytest.raises(ValueError):
        lexicon.Lexicon([(i, "f", f"v{i}", None, None) for i in range(lexicon.MAX_ENTRIES + 1)])


HEADER = ",".join(rejects.FIELDS)
LINE = "MIB-000001,A B,VELTHARI,Velm-12c,KX-1,SPN-0001,2026-01-02,ore assay,none,paid,APPROVED,0.5"


def lines(spark, texts):
    rows = [(0, "f", 1, HEADER, "x")] + [(i + 1, "f", i + 2, t, "x") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "line_id bigint, file_name string, line_no int, raw_text string, f string")  # f clashes with an inner name


def test_rejects(spark):
    texts = [LINE, LINE.replace("A B", '"A, ""x"" B\nC"'), LINE.replace("A B", 'A" B'), LINE + ",", LINE.replace("SPN-0001", '"spn-0001"').replace("0.5", "1.0001"), LINE.replace("2026-01-02", "2026-02-30").replace("paid", "payed"),
             None, "", LINE.replace("0.5", "nan"), LINE.replace("0.5", "1e-1"), LINE.replace("SPN-0001", "SPN-0001\n"), LINE.replace("A B", '"' + "x" * 300_000 + '"')]
    df = lines(spark, texts)
    assert got(rejects.rejects(df), "line_id", "reason") == sorted([(3, "quoting"), (4, "column_count"), (5, "sponsor_id"), (5, "confidence"), (6, "arrival_date"), (6, "fee_status"), (7, "column_count"), (8, "column_count"), (9, "confidence"), (10, "confidence"), (11, "sponsor_id")], key=repr)
    ok = {r["line_id"]: r for r in rejects.accepted(df).collect()}
    assert sorted(ok) == [1, 2, 12] and ok[2]["applicant_name"] == 'A, "x" B\nC' and ok[1]["arrival_date"] == date(2026, 1, 2) and len(ok[12]["applicant_name"]) == 300_000
    assert got(rejects.rejects(df.limit(0)), "line_id", "reason") == []


@settings(max_examples=40, deadline=None)
@given(st.lists(st.lists(st.text(alphabet='ab,"\n é', max_size=6), min_size=12, max_size=12), min_size=1, max_size=5))
def test_sound_lines_split_as_a_csv_writer_wrote_them(spark, rows):
    texts = []
    for r in rows:
        buf = io.StringIO()
        csv.writer(buf, quoting=csv.QUOTE_ALL, lineterminator="").writerow(r)
        texts.append(buf.getvalue())
    parsed = rejects.parse(lines(spark, texts)).orderBy("line_id").collect()
    assert [p["structure"] for p in parsed] == [None] * len(rows) and [list(p["f"]) for p in parsed] == rows


KNOWN = packed.known_values([r for r in CODE_LIST if r[1] == "risk_flags"])


@pytest.mark.parametrize("cell,items", [
    ("orbit_ban|open_summons", ["orbit_ban", "open_summons"]), ('"summons; open", orbit_ban', ["summons; open", "orbit_ban"]), ("summons, open, orbit_ban", ["summons, open", "orbit_ban"]),
    ("['a', 'b']", ["a", "b"]), ("('a', 'b')", ["a", "b"]), ("1) a 2) b", ["a", "b"]), ("a and b & c + d\te\nf", list("abcdef")), ("a; ;b;", ["a", "b"]), ("[orbit_ban | n/a]", ["orbit_ban", "n/a"]),
    ("orbit ban (confirmed) / x", ["orbit ban (confirmed)", "x"]), ("memory_edit orbit_ban", ["memory_edit", "orbit_ban"]), ("none", []), ("-", []), (None, []), ("", []), ('"a', ['"a']), ("a a|a", ["a a", "a"]),
])
def test_split(cell, items):
    assert packed.Segmenter(KNOWN).split(cell) == items


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["memory_edit", "orbit_ban", "odd one", "x (confirmed)", "summons; open", "bärred"]), min_size=2, max_size=6), st.sampled_from([",", "; ", " | ", "\t", "\n", " / "]))
def test_split_round_trip(items, mark):
    assert packed.Segmenter(KNOWN).split(mark.join(f'"{i}"' if ";" in i else i for i in items)) == items


def test_several(spark):
    long = "|".join(["orbit_ban"] * 20_000)
    df = spark.createDataFrame([(1, "a|b", 9), (1, "a|b", 9), (2, None, 9), (3, "none", 9), (4, "a", 9), (5, long, 9)], "record_id bigint, risk_flags string, pos int")
    out = packed.several(df, "risk_flags", "record_id", "records", KNOWN)
    assert got(out.where("row_id < 5"), "in_table", "row_id", "pos", "item") == sorted([("records", 1, 1, "a"), ("records", 1, 2, "b")] * 2)
    assert out.where("row_id = 5").count() == 20_000 and out.where("row_id = 5").agg(F.max("pos")).first()[0] == 20_000
    assert packed.several(df.limit(0), "risk_flags", "record_id", "records", KNOWN).count() == 0


def test_lookup_join_salts_beyond_the_limit(spark):
    left = spark.createDataFrame([(i, "hot" if i % 3 else "cold") for i in range(300)], "id bigint, k string")
    right = spark.createDataFrame([("hot", 1), ("cold", 2)], "k string, v int")
    assert got(lookup_join(left, right, ["k"], limit=0), "id", "v") == got(lookup_join(left, right, ["k"]), "id", "v")
    assert lookup_join(left, right, ["k"], limit=0).count() == 300


def test_queries_have_the_stated_columns(spark):
    assert problems.p1_found(spark, DATA).dtypes == [("record_id", "bigint"), ("field_name", "string"), ("entry_id", "bigint")]
    assert problems.p2_found(spark, DATA).dtypes == [("line_id", "bigint"), ("reason", "string")]
    assert problems.p5_found(spark, DATA).dtypes == [("in_table", "string"), ("row_id", "bigint"), ("pos", "int"), ("item", "string")]
    assert table(spark, DATA, "records").count() > 0
